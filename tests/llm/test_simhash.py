from __future__ import annotations

import random

from tests.llm import edge
from vitrine.llm import simhash
from vitrine.llm.components import components


def by_brute_force(rows):
    prints = [edge.fingerprint(t) for _, t in rows]
    of = edge.groups(prints, 3)
    out = []
    for p, g in zip(prints, of):
        ids = [i for (i, _), x in zip(rows, of) if x == g and i is not None]
        out.append((f"{p:016x}", min(ids) if ids else None))
    return out


def check(spark, docs, rows):
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicate_classes(docs).collect()), key=str)
    assert got == sorted(((i, p, c) for (i, _), (p, c) in zip(rows, by_brute_force(rows))), key=str)


def test_edges(spark):
    check(spark, edge.documents(spark), edge.texts())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    check(spark, docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_links_of_dense_groups(spark):
    """Many fingerprints around a few centres, through divided and undivided cells."""
    r = random.Random(3)
    prints = {0}
    for _ in range(4):
        centre = r.getrandbits(64)
        while len(prints) % 60 or len(prints) < 60:
            near = centre
            for _ in range(r.randint(0, 4)):
                near ^= 1 << r.randrange(64)
            prints.add(near)
        prints.add(r.getrandbits(64))
    prints = sorted(prints)
    fps = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    want = edge.groups(prints, 3)
    for block in (4, 1024):
        links = [(a & (2**64 - 1), b & (2**64 - 1)) for a, b in simhash.fingerprint_links(fps, block=block).collect()]
        assert all((a ^ b).bit_count() <= 3 or want[prints.index(a)] == want[prints.index(b)] for a, b in links)
        of = {p: p for p in prints}

        def find(x, of=of):
            while of[x] != x:
                x = of[x]
            return x

        for a, b in links:
            x, y = find(a), find(b)
            of[max(x, y)] = min(x, y)
        assert [find(p) for p in prints] == [prints[g] for g in want]


def test_keep_first(spark):
    docs = edge.documents(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    rows = edge.texts()
    heads = {c for _, c in by_brute_force(rows)}
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(got, key=str) == sorted(heads, key=str)


def test_empty(spark):
    assert simhash.near_duplicate_classes(edge.empty(spark)).collect() == []
    assert simhash.keep_first(edge.empty(spark)).collect() == []


def test_components_of_a_long_path(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1001), (1001, 1000)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
