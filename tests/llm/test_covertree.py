from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from vitrine.llm import covertree
from vitrine.plans.check import compare


def test_matches_sql(spark, duck):
    result = compare(covertree.op3_cover_tree(spark, edge.SF), duck, covertree.OP3_SQL)
    assert result["values_match"], result


def brute(queries, qid, points, ids, k):
    out = []
    for q, i in zip(queries, qid):
        best = sorted(((-int(q @ p), int(j)) for p, j in zip(points, ids) if j != i))[:k]
        out += [(int(i), j, -s) for s, j in best]
    return sorted(out)


@pytest.mark.parametrize("kind", ["spread", "clusters", "equal", "few"])
def test_dual_trees(kind):
    rng = np.random.default_rng(1)
    n = {"few": 5}.get(kind, 700)
    points = {
        "spread": lambda: rng.integers(-9, 9, (n, 8)),
        "clusters": lambda: rng.integers(-60, 60, (6, 8))[rng.integers(0, 6, n)] + rng.integers(-2, 3, (n, 8)),
        "equal": lambda: np.repeat(rng.integers(-5, 5, (2, 8)), n // 2, 0),
        "few": lambda: rng.integers(-9, 9, (n, 8)),
    }[kind]().astype(float)
    ids = rng.permutation(n)
    own = ids % 5 == 0
    a, b, s = covertree.dual_tree_top_k(points[own], ids[own], points, ids, 7)
    assert sorted(zip(ids[own][a].tolist(), ids[b].tolist(), s.tolist())) == brute(points[own], ids[own], points, ids, 7)


def test_edges(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 2), (2, None, 1), (3, [None, 1.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
        (20, [0.5, -0.26], 1), (None, [9.0, 9.0], 1), (40, [1.0], 1), (60, [], 1), (7, [-1.0, 0.0], 1), (8, [1e5, 1e5], 1),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = covertree.top_k(vectors, F.col("vec_id") % 20 == 0, k=3).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert by[0] == [(8, 64 * 6400000 * 3), (1, 64 * 64 * 5), (20, 64 * 32 + 128 * -17)]
    assert [v for v, _ in by[20]] == [8, 0, 1]
    assert 40 not in by and 60 not in by  # nothing else of their length
    assert covertree.top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).collect() == []
