from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm import edge
from vitrine.llm import brown


def check_counts(rows, got):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, [*(w.translate(edge.LOWER) for w in edge.split(t)), None]) for i, t in rows]
    count = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted(((i, held(i), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 5)) for i, ws in tokens), key=str)
    have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got), key=str)
    assert len(have) == len(want)
    for a, b in zip(have, want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=2e-4)


def test_edges(spark):
    got = brown.score_documents(edge.documents(spark), core=50, sweeps=2, rise=0.05).collect()
    check_counts(edge.texts(), got)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_held_out_gain(spark):
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    got = brown.op4_brown(spark, edge.SF).collect()
    check_counts([(r["doc_id"], r["text"]) for r in docs.collect()], got)
    for held in (False, True):
        part = [r for r in got if r["held_out"] == held]
        assert sum(r["score"] for r in part) > sum(r["base_score"] for r in part)


def test_word_order_matters(spark):
    """Classes that alternate are found, so a shuffled text scores less."""
    import random

    r = random.Random(2)
    first, second = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    rows = [(k, " ".join(r.choice(first) + " " + r.choice(second) for _ in range(50))) for k in range(60)]
    order = [k for k in range(100, 140) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    text = " ".join(r.choice(first) + " " + r.choice(second) for _ in range(50))
    words = text.split()
    r.shuffle(words)
    rows += [(order[0], text), (order[1], " ".join(words))]
    got = {x["doc_id"]: x for x in brown.score_documents(edge.documents(spark, rows)).collect()}
    assert got[order[0]]["score"] > got[order[1]]["score"] + 5
    assert got[order[0]]["score"] > got[order[0]]["base_score"] + 5


def test_words_outside_of_the_core(spark):
    """Words that never stand beside a core word are exchanged too: alternating ones part."""
    import random

    r = random.Random(5)
    first, second = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    held = lambda k: zlib.crc32(str(k).encode()) % 7 == 2
    rows = [(k, "core " * 40 + "x " + " ".join(r.choice(first) + " " + r.choice(second) for _ in range(40)) + " y" + " core" * 40) for k in range(80) if not held(k)]
    hub = brown.Hub(brown.encode(edge.documents(spark, rows)))
    words, of, placed = brown.cluster_core(hub, 1, 1)
    start = brown.first_classes(hub, words, of, placed)

    def classes(values):
        found = {}
        for b in hub.with_values(values, "u1", "words").collect():
            found |= dict(zip(b["words"].split(" "), brown._parts(b["parts"], "u1")[1].tolist()))
        return found

    assert len(words) == 1 and classes(start)["core"] == of[0]
    every = lambda slots, turns: (slots, turns)
    likely = lambda x: brown.likelihood(brown._matrix(brown._pass(hub.with_values(x, "u1", *brown.SENT), "u1", every)))
    end = brown.exchange_all(hub, start)
    assert len({classes(start)[w] for w in first + second}) > 3  # not one heap
    got = classes(end)
    assert not {got[w] for w in first} & {got[w] for w in second}
    assert likely(end) > likely(start) + 0.05


def brute_score(rows, classes, got):
    """Each text's score from its words' classes by the formula of the module."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    end = brown.END
    texts = [(i, [*(w.translate(edge.LOWER) for w in edge.split(t)), None]) for i, t in rows]
    train = [w for i, ws in texts if not held(i) for w in ws]
    count = Counter(train)
    n, v = len(train), len(count)
    of = lambda w: end if w is None else classes[w] if count[w] else brown.OTHER
    moves, once, into = Counter(), Counter(), Counter()
    for a, b in zip([None, *train], train):
        moves[of(a), of(b)] += 1
        into[of(b)] += 1
        once[of(a)] += count[b] == 1
        if a is not None and count[a] == 1:  # after a word seen once, as after an unknown one
            moves[brown.OTHER, of(b)] += 1
            once[brown.OTHER] += count[b] == 1
    out = lambda k: sum(moves[k, c] for c in range(brown.CLASSES + 1))
    rate = max(sum(once[k] for k in range(brown.CLASSES + 1)) / max(n, 1), 1 / (n + v + 1))
    want = []
    for i, ws in texts:
        total, before = 0.0, end
        for w in ws:
            unknown = (once[before] + brown.SMOOTHING * rate) / (out(before) + brown.SMOOTHING)
            if count[w]:
                share = into[of(w)] / n
                follow = (moves[before, of(w)] + brown.SMOOTHING * share) / (out(before) + brown.SMOOTHING)
                total += math.log10((1 - unknown) * follow * count[w] / into[of(w)])
            else:
                total += math.log10(unknown)
            before = of(w)
        want.append((str(i), len(ws), round(total, 4)))
    assert len(got) == len(want)
    for a, b in zip(sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 4)) for r in got), sorted(want)):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-3), (a, b)


def test_scores_by_brute_force(spark, monkeypatch):
    """With the classes that the exchange ends with, every score is recomputed; many blocks and shards."""
    monkeypatch.setattr(brown, "SHARD_WORDS", 64)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{edge.SF}/documents.parquet").filter("doc_id < 60").collect()] + edge.texts()
    kept = {}
    run = brown.exchange_all

    def exchange_all(hub, classes, rise):
        end = run(hub, classes, rise)
        for b in hub.with_values(end, "u1", "words").collect():
            kept.update(zip(b["words"].split(" "), brown._parts(b["parts"], "u1")[1].tolist()))
        return end

    monkeypatch.setattr(brown, "exchange_all", exchange_all)
    encode = brown.encode
    monkeypatch.setattr(brown, "encode", lambda docs: encode(docs, 20_000))
    got = brown.score_documents(edge.documents(spark, rows), core=30, sweeps=1, rise=0.05).collect()
    check_counts(rows, got)
    brute_score(rows, kept, got)


def test_many_shuffle_partitions(spark):
    """The tasks of a turn follow the data, not the number of shuffle partitions; scores are the same."""
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    context, key = spark.sparkContext, "spark.sql.shuffle.partitions"
    scores = lambda: sorted(map(tuple, brown.score_documents(docs, core=30, sweeps=1, rise=0.5).collect()))
    want, before = scores(), spark.conf.get(key)
    spark.conf.set(key, "211")
    context.setJobGroup("many-partitions", "")
    try:
        got = scores()
    finally:
        spark.conf.set(key, before)
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("many-partitions") for s in tracker.getJobInfo(j).stageIds]
    assert len(stages) > 20 and max(s.numTasks for s in stages if s) < 50
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [x for r in got for x in r[5:]] == pytest.approx([x for r in want for x in r[5:]])


def test_blocks_share_tasks(spark):
    """A task of a turn reads some blocks, and their training tokens only; words are hashed once."""
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    size = sum(len((r["text"] or "").encode()) + 64 for r in docs.collect())
    blocks = brown.encode(docs, size // 6)
    assert blocks.count() >= 4 and blocks.select("block").rdd.getNumPartitions() <= 4
    for b in blocks.collect():
        ends, train, n = brown._numbers(b["ends"], "<i8"), brown._tokens(b["ids"]), b["held"].count(False)
        assert b["held"] == sorted(b["held"]) and len(train) == (ends[n - 1] if n else 0)
        assert len(train) + len(brown._tokens(b["held_ids"])) == ends[-1]
        assert (train == 0).sum() == n and (brown._numbers(b["trains"], "<u4") == np.bincount(train, minlength=b["size"] + 1)[1:]).all()
        hashes = brown._hashes([w.encode() for w in b["words"].split(" ")])
        assert (np.frombuffer(b["hashes"], np.uint64).reshape(-1, 2) == hashes).all() and len(hashes) == b["size"]


def test_tokens_pack():
    for top in (1, 1 << 16, 1 << 24, 1 << 32):
        tokens = np.random.default_rng(3).integers(0, top, 1000).astype(np.uint32)
        for part in (tokens, tokens[:1], tokens[:0]):
            assert (brown._tokens(brown._pack_tokens(part)) == part).all()


def test_counts_pack():
    rng = np.random.default_rng(1)
    entries = rng.integers(0, 5, 100)
    slot, n = rng.integers(0, 68, entries.sum()), rng.integers(1, 2**31, entries.sum())
    back = brown._unpack_contexts(brown._pack_contexts(entries, slot, n))
    assert all((a == b).all() for a, b in zip(back, (entries, slot, n)))
    assert (brown._numbers(brown._planes(np.array([-1, 5, 300]), "<i2"), "<i2") == [-1, 5, 300]).all()


def test_probabilities_add_up():
    rng = np.random.default_rng(0)
    of = np.concatenate([rng.integers(0, brown.CLASSES, 200), [brown.END]])
    count = rng.integers(1, 9, 201)
    cells = {}
    tokens = rng.choice(201, 4000, p=count / count.sum())
    count = np.bincount(tokens, minlength=201)
    wide = brown.SLOTS + 1
    before = brown.END
    for t in tokens:
        for cell in [before * wide + of[t]] + ([before * wide + brown.SLOTS] if count[t] == 1 else []):
            cells[cell] = cells.get(cell, 0) + 1
        before = of[t]
    m = brown.ClassModel(cells, len(tokens), int((count > 0).sum()))
    seen = np.flatnonzero(count)
    for h in range(brown.CLASSES + 1):
        p = (1 - m.unknown[h]) * (m.follow[h, of[seen]] * count[seen] / m.mass[of[seen]]).sum() + m.unknown[h]
        assert p == pytest.approx(1)


def test_empty(spark):
    assert brown.score_documents(edge.empty(spark)).collect() == []
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (r,) = brown.score_documents(edge.documents(spark, [(held, "no training text")])).collect()
    assert (r["train_tokens"], r["n_known"], r["score"]) == (0, 0, r["base_score"])
