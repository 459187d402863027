from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from vitrine.llm import runs, trie
from vitrine.plans.check import compare

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, depth long, v int, _run string, key long"


def brute(rows, every=20, shared=4):
    """One row per node, by definition."""
    own: dict = {}
    md5 = lambda role, text: hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0, md5(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    new = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % shared
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        new[c] = tuple(own.get(base, [])[:h] + x[h:])
    members: dict = {}
    for c, x in new.items():
        for d in range(len(x) + 1):
            members.setdefault(x[:d], []).append(c)
    kids: dict = {}
    for x in members:
        if x:
            kids.setdefault(x[:-1], []).append(x)
    out = []
    for x, m in members.items():
        below = [y for y in members if y[: len(x)] == x]
        saved = sum((len(members[y]) - 1) * len(edge.split(y[-1][1])) for y in below if y)
        ends = ",".join(str(c) for c in sorted(m) if len(new[c]) == len(x))
        out.append((min(m), len(x), min(members[x[:-1]]) if x else None, len(m), len(kids.get(x, [])), sum(y not in kids for y in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)


def answer(df):
    assert df.columns == list(COLUMNS)
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark, duck):
    rows = [tuple(r) for r in spark.read.parquet(f"{edge.SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = trie.op12_trie(spark, edge.SF)
    assert answer(got) == brute(rows)
    result = compare(got, duck, trie.OP12_SQL)
    assert result["values_match"], result


EDGES = [
    (0, 1, "user", "hello there you"), (0, 0, "system", "be kind"), (0, 2, None, None), (0, None, "user", "before all"),
    (1, 5, "user", "one"), (1, 5, "user", "one"), (1, 6, "", ""), (2, 0, "user", "be kind"), (3, 0, "system", "be kind"), (3, 1, "user", "hello there you"),
    (21, 0, "user", None), (22, 1, "user", "x y z"), (41, 0, "use", "r: a"), (42, 0, "user", ": a"), (None, 0, "user", "nobody"), (None, None, None, None),
    (-5, 0, "user", "hello there you"), (-5, 1, "user", "é b\tc"), (-21, 0, "system", "be kind"), (2**62, 0, "user", "late"), (7, 0, "user", "word " * 3000), (8, 0, "user", "word " * 3000),
]


@pytest.mark.parametrize("run_rows,chunk", [(1 << 18, 1 << 18), (3, 2)])
def test_edges(spark, monkeypatch, run_rows, chunk):
    """Also with groups cut into many runs, and the tour into many fragments."""
    monkeypatch.setattr(runs, "RUN_ROWS", run_rows)
    monkeypatch.setattr(trie, "CHUNK_NODES", chunk)
    assert answer(trie.prefix_trie(frame(spark, EDGES))) == brute(EDGES)
    assert answer(trie.prefix_trie(frame(spark, EDGES), shared=1)) == brute(EDGES, shared=1)


def test_hot_groups(spark, monkeypatch):
    """A first turn that most have, one conversation in many copies, and one that holds a third of all turns, with ties."""
    monkeypatch.setattr(runs, "RUN_ROWS", 16)
    monkeypatch.setattr(trie, "CHUNK_NODES", 16)
    r = random.Random(3)
    rows = [(c, t, "user", "welcome all" if t == 0 else r.choice(["yes", "no", "say more"])) for c in range(0, 400, 3) for t in range(r.randint(1, 4))]
    rows += [(c, t, "user", f"copied {t}") for c in range(1, 300, 5) for t in range(4) if c % 3]
    rows += [(1000, r.randint(0, 40), r.choice(["user", None]), r.choice(["a b", "c"])) for _ in range(300)]
    assert answer(trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_contraction():
    """A chunk's own part of a tour: root 0 with children 1 and 2, of which 2 and its child 3 lie here."""
    nxt, head, steps, outside = trie._contract(np.array([3, -1]), np.array([-1, -1]), np.array([0, 2]), np.array([2, 3]))
    assert nxt.tolist() == [6, 7, 1, 5] and head.tolist() == [4, 4, 4, 4] and steps.tolist() == [0, 1, 3, 2] and outside.tolist() == [False, False, True, False]


def test_windows_over_runs(spark, monkeypatch):
    """Sums carried over the runs of a group are those of the whole group, null keys included."""
    monkeypatch.setattr(runs, "RUN_ROWS", 5)
    r = random.Random(1)
    rows = [(r.choice([None, 1, 1, 1, 2, 3]), i, r.randint(0, 9)) for i in range(100)]
    df = runs.in_runs(spark.createDataFrame(rows, "g int, o int, x long"), ["g"], [F.col("o")], len(rows))
    w = runs.within(["g"], [F.col("o")])
    df = runs.carried(df.withColumn("s", F.sum("x").over(w)), ["g"], [F.sum("x").alias("t")], lambda w: [F.sum("t").over(runs.earlier(w)).alias("b")])
    got = {(a["g"], a["o"]): a["s"] + (a["b"] or 0) for a in df.collect()}
    assert got == {(g, o): sum(y for h, p, y in rows if h == g and p <= o) for g, o, x in rows}


def test_empty(spark):
    assert trie.prefix_trie(frame(spark, [])).collect() == []
    assert trie.prefix_trie(frame(spark, [(None, 1, "user", "x")])).collect() == []
