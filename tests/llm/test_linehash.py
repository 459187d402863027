from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from vitrine.llm import linehash
from vitrine.plans.check import compare

WS = " \t\n\x0b\x0c\r"


def brute(rows, least=10):
    """(doc_id, n_lines, n_dropped, sha256) by definition."""
    split = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda line: line.strip(WS).translate(edge.LOWER)
    order = lambda i: float("inf") if i is None else i
    holders: dict[str, set] = {}
    for i, lines in split:
        for line in lines:
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(order(i))
    out = []
    for i, lines in split:
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def answer(df):
    return sorted(((r[0], r[1], r[2], r[3]) for r in df.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    high, low = (rng.integers(0, 2**64, n, np.uint64) for _ in range(2))
    made = linehash.PerfectHash.build(high, low)
    assert sorted(made.slots(high, low).tolist()) == list(range(n))
    # At most a byte a key, and the copy that was read back agrees.
    assert made.bits.nbytes <= max(16, n)
    again = linehash.PerfectHash(made.sizes, made.bits.tobytes())
    assert (again.slots(high, low) == made.slots(high, low)).all()


def test_strangers_are_known_by_their_fingerprint():
    rng = np.random.default_rng(3)
    high, low = (rng.integers(0, 2**64, 3000, np.uint64) for _ in range(2))
    made = linehash.PerfectHash.build(high[:2000], low[:2000])
    by = np.argsort(made.slots(high[:2000], low[:2000]))
    shard = linehash.Shard(
        made.sizes, made.bits.tobytes(), (low[:2000] >> np.uint64(32)).astype(np.uint32)[by].tobytes(), np.full(2000, 3, np.uint16).tobytes(), np.arange(2000)[by].tobytes()
    )
    count, first = shard.find(high, low)
    assert (count[:2000] == 3).all() and (first[:2000] == np.arange(2000)).all() and (count[2000:] == 0).all()


LINES = [
    (5, "A common line here\nonly in five\n  a COMMON line here\t\n"),
    (3, "x\n\r a common Line here \x0b\nshort\nÉtait une fois là"),
    (9, "short\nshort\nétait une fois là\nÉtait une fois là\na common line here"),
    (4, "ÀÀÀÀÀÀÀÀÀ\nÀÀÀÀÀÀÀÀÀÀ\n\xa0a common line here"),
    (6, "ÀÀÀÀÀÀÀÀÀ\nÀÀÀÀÀÀÀÀÀÀ\n\xa0a common line here\n"),
    (7, "twice in one\ntwice in one"),
    (7, "twice in one"),
    (7, "twice in one\ntwice in one"),
    (None, "no id at all here\ntwice in one"),
    (None, "no id at all here"),
    (8, "\n\n\n"),
    (-2, "only in five\x85\n日本語日本語日本語日\nonly in five"),
    (2**63 - 2, "日本語日本語日本語日\n日本語"),
]


@pytest.mark.parametrize("fan,lines", [(1 << 14, 1 << 17), (2, 3)])
def test_edges(spark, monkeypatch, fan, lines):
    """Also with many shards, and several rounds of merging and parts of probes."""
    monkeypatch.setattr(linehash, "FAN", fan)
    monkeypatch.setattr(linehash, "BLOCK_LINES", 4 if fan == 2 else 1 << 16)
    rows = edge.texts() + LINES + [(k, "A line in every document\nline %d of its own" % k) for k in range(100, 160)]
    assert answer(linehash.drop_repeated_lines(edge.documents(spark, rows), shard_lines=lines)) == brute(rows)


def test_shortest_key(spark):
    rows = LINES[:5]
    for least in (1, 5, 17):
        assert answer(linehash.drop_repeated_lines(edge.documents(spark, rows), least)) == brute(rows, least)


def test_whole_table(spark, duck):
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    got = linehash.op13_lines(spark, edge.SF)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    result = compare(got, duck, linehash.OP13_SQL)
    assert result["values_match"], result


def test_empty(spark):
    assert linehash.drop_repeated_lines(edge.empty(spark)).collect() == []
