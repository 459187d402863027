from __future__ import annotations

import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from vitrine.llm import whiten


def brute(xs, weights=None, components=4):
    """{x: (n, deviation, whitened, explained)} with the covariance in exact fractions."""
    count = Counter(map(tuple, xs))
    weight = {x: weights(c) if weights else 1 for x, c in count.items()}
    n, dim = sum(weight.values()), len(xs[0])
    sums = [sum(w * x[i] for x, w in weight.items()) for i in range(dim)]
    cov = [[float(Fraction(n * sum(w * x[i] * x[j] for x, w in weight.items()) - sums[i] * sums[j], n * n)) for j in range(dim)] for i in range(dim)]
    e, v = np.linalg.eigh(np.array(cov))
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    return {
        x: (n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), [float(np.dot([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)], v[:, k])) / math.sqrt(max(e[k], 1e-300)) for k in range(len(e))],
            [float(k / np.trace(cov)) for k in e])
        for x in weight
    }


def answer(df):
    out: dict = {}
    for r in df.collect():
        out.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    return out


def agree(got, rows, want):
    """Every row has every component; values agree but for a component's sign, the same for all rows."""
    sign: dict = {}
    for i in {i for i, _ in rows}:
        own = [tuple(x) for j, x in rows if j == i]
        parts = got[i]
        assert sorted(parts) == list(range(1, len(want[own[0]][2]) + 1)) and all(len(p) == len(own) for p in parts.values())
        for k, p in parts.items():
            for r, (n, dev, w, share) in zip(sorted(p, key=lambda r: (r["deviation"], abs(r["whitened"]))), sorted((want[x] for x in own), key=lambda t: (t[1], abs(t[2][k - 1])))):
                assert r["n"] == n and r["deviation"] == dev
                assert r["explained"] == pytest.approx(share[k - 1], rel=1e-9)
                assert r["identity_error"] < 1e-9
                assert abs(r["whitened"]) == pytest.approx(abs(w[k - 1]), rel=1e-7, abs=1e-7)
                if abs(w[k - 1]) > 1e-6:
                    assert sign.setdefault(k, r["whitened"] * w[k - 1] > 0) == (r["whitened"] * w[k - 1] > 0)


def test_whole_table(spark):
    rows = [(r["vec_id"], [math.floor(256 * float(c)) for c in r["embedding"]]) for r in spark.read.parquet(f"{edge.SF}/embeddings.parquet").collect()]
    agree(answer(whiten.op11_whiten(spark, edge.SF)), rows, brute([x for _, x in rows]))


@pytest.mark.parametrize("multiplicity", [False, True])
def test_weights(spark, multiplicity):
    """A third of the rows hold one vector; with multiplicities it weighs as much."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-200, 200, 6).tolist()) for i in range(120)] + [(1000 + i, [900, -3, 5, 7, 11, 13]) for i in range(60)] + [(None, [1, 2, 3, 4, 5, 6])] * 2
    df = spark.createDataFrame(rows, "vec_id long, x array<long>")
    agree(answer(whiten.whiten(df, multiplicity=multiplicity)), rows, brute([x for _, x in rows], (lambda c: c) if multiplicity else None))


def test_far_from_the_origin(spark):
    """Deviations of some units around 10^12: products before centring would lose them."""
    rng = np.random.default_rng(4)
    rows = [(i, (10**12 + rng.integers(-40, 40, 5)).tolist()) for i in range(200)]
    agree(answer(whiten.whiten(spark.createDataFrame(rows, "vec_id long, x array<long>"))), rows, brute([x for _, x in rows]))


def test_edges(spark, tmp_path):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 2.0, -0.25], 1), (1, [1.0, 2.0, -0.25], 2), (1, [0.5, 2.0, 0.001], 2), (2, None, 1), (3, [None, 1.0, 1.0], 1), (4, [nan, 1.0, 1.0], 1), (5, [inf, 1.0, 0.0], 1),
        (6, [-inf, 1.0, 0.0], 1), (None, [-0.0, -0.0009, 0.3], 1), (7, [], 1), (8, [3.0, 1.0, 2.0], 1), (9, [1.0, 1.0], 1), (10, [2.0], 1), (10, [5.0], 1), (11, [1e300, 1.0, 1.0], 1),
    ]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = answer(whiten.op11_whiten(spark, str(tmp_path)))
    assert set(got) == {0, 1, None, 8, 9, 10}
    whole = [(0, [256, 512, -64]), (1, [256, 512, -64]), (1, [128, 512, 0]), (None, [0, -1, 76]), (8, [768, 256, 512])]
    want = brute([x for _, x in whole])
    agree({k: got[k] for k in (0, 1, None, 8)}, whole, want)
    # One vector of its length has no variance, and two on a line one component.
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for k in got[9].values() for r in k] == [(1, 0, None, None, None)] * 2
    assert sorted(r["whitened"] for r in got[10][1]) == pytest.approx([-1, 1]) and list(got[10]) == [1]


def test_rank_deficient(spark):
    """Three vectors span two dimensions: other components are null, the identity is of the two."""
    rows = [(1, [3, 0, 0, 1]), (2, [0, 3, 0, 1]), (3, [0, 0, 3, 1])]
    got = answer(whiten.whiten(spark.createDataFrame(rows, "vec_id long, x array<long>")))
    for parts in got.values():
        assert [parts[k][0]["whitened"] is None for k in (1, 2, 3, 4)] == [False, False, True, True]
        assert parts[1][0]["identity_error"] < 1e-12 and parts[4][0]["explained"] == pytest.approx(0, abs=1e-12)


def test_long_deviations_stay_exact(spark):
    rows = [(1, [2**40, 0]), (2, [-(2**40), 3]), (3, [2**41 + 1, 5])]
    got = answer(whiten.whiten(spark.createDataFrame(rows, "vec_id long, x array<long>")))
    want = brute([x for _, x in rows])
    assert all(int(got[i][1][0]["deviation"]) == want[tuple(x)][1] for i, x in rows)


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>").select("vec_id", whiten.whole(F.col("embedding"), 256).alias("x"))
    assert whiten.whiten(none).collect() == []
