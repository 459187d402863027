from __future__ import annotations

from collections import Counter

import pytest

from tests.llm import edge
from vitrine.llm import mixing
from vitrine.plans.check import compare


def test_matches_sql(spark, duck):
    result = compare(mixing.op1_mix(spark, edge.SF), duck, mixing.OP1_SQL)
    assert result["values_match"], result


def water_fill(sizes: list[int], weights: list[int], most: int = 3) -> list[float]:
    stopped: set[int] = set()
    while True:
        rest = sum(sizes) - sum(most * sizes[i] for i in stopped)
        shared = sum(w for i, w in enumerate(weights) if i not in stopped)
        over = {i for i, w in enumerate(weights) if i not in stopped and w * rest > most * sizes[i] * shared}
        if not over:
            return [most * s if i in stopped else w * rest / shared for i, (s, w) in enumerate(zip(sizes, weights))]
        stopped |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 1000], [1, 2, 4, 8, 1000, 1], [5], [0, 7, 7], [1, 1, 1, 1, 400, 1]])
def test_targets(spark, sizes):
    rows = [(f"s{i:02}", n) for i, n in enumerate(sizes)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert [got[s] for s, _ in rows] == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes))


def test_edges(spark):
    docs = edge.documents(spark)
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(edge.texts())
    for r in plan:
        assert r["size"] == len(edge.split(r["text"]))
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        assert r["source_size"] == sum(x["size"] for x in plan if x["source"] == r["source"])
    same = [r["copies"] for r in plan if r["doc_id"] == 9 and r["source"] == plan[9]["source"]]
    assert len(set(same)) <= 1
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = Counter((r["doc_id"], r["text"], r["source"]) for r in mixed.collect())
    want = Counter()
    for r in plan:
        want[(r["doc_id"], r["text"], r["source"])] += r["copies"]
    assert taken == +want
    again = mixing.mix_plan(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, plan))


def test_empty(spark):
    assert mixing.mix_plan(edge.empty(spark)).collect() == []
    nothing = mixing.mix_plan(edge.documents(spark, [(1, None), (2, "")])).collect()
    assert [(r["target"], r["taken"]) for r in nothing] == [(0.0, 0), (0.0, 0)]
