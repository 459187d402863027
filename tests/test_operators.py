"""Edge cases on hand-made rows (FIXTURES.md section 4)."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import make_listings
from vitrine.functions import plain_decimal_string, ratio_half_even, scaled_half_even
from vitrine.operators import (
    argmax_per_group,
    exact_order_stats,
    inequality_join,
    leave_one_out_mean,
    mode_per_group,
    nest,
    top_k_per_group,
)
from vitrine.plans import analyses as A


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_top_k_and_argmax_ties_break_by_name(spark):
    df = spark.createDataFrame([("x", "b", 2), ("x", "a", 2), ("x", "c", 1), ("y", "z", 5)], "g string, k string, n long")
    top = top_k_per_group(df, ["g"], [("n", "desc"), ("k", "asc")], 1)
    assert _rows(top, "g", "k", "rank") == [("x", "a", 1), ("y", "z", 1)]
    am = argmax_per_group(df, ["g"], [("n", "desc"), ("k", "asc")], ["k", "n"])
    assert _rows(am, "g", "k", "n") == [("x", "a", 2), ("y", "z", 5)]


def test_argmax_desc_puts_nulls_last(spark):
    df = spark.createDataFrame([("x", "a", None), ("x", "b", 1)], "g string, k string, n long")
    am = argmax_per_group(df, ["g"], [("n", "desc"), ("k", "asc")], ["k"])
    assert am.first()["k"] == "b"


def test_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([("g", "red"), ("g", "blue"), ("g", "red"), ("g", "blue"), ("g", "green")], "g string, c string")
    m = mode_per_group(df, ["g"], "c", "color", "n").first()
    assert (m["color"], m["n"]) == ("blue", 2)


def test_leave_one_out_alone_is_null(spark):
    df = spark.createDataFrame([("s", "a", Decimal("10")), ("s", "b", Decimal("20")), ("t", "c", Decimal("5"))], "g string, m string, v decimal(18,2)")
    out = {r["m"]: r["loo"] for r in leave_one_out_mean(df, ["g"], "v", "loo").collect()}
    assert out == {"a": 20.0, "b": 10.0, "c": None}


def test_half_even_rounding_is_exact(spark):
    df = spark.createDataFrame(
        [(Decimal("0.25"), 2), (Decimal("0.27"), 2), (Decimal("-0.25"), 2), (Decimal("2.675"), 1), (Decimal("1"), 0)],
        "s decimal(18,3), n long",
    )
    got = [r[0] for r in df.select(ratio_half_even(F.col("s"), F.col("n"))).collect()]
    assert got == [0.12, 0.14, -0.12, 2.68, None]


def test_percent_text(spark):
    df = spark.createDataFrame([(1, 2), (2, 2), (2, 3), (1, 8), (0, 5)], "s long, n long")
    q = scaled_half_even(F.col("s") * 100, F.col("n"), 2)
    got = [r[0] for r in df.select(plain_decimal_string(q, 2)).collect()]
    assert got == ["50", "100", "66.67", "12.5", "0"]


@pytest.mark.parametrize(
    "values, q, expected",
    [
        ([1, 2, 3, 4], 0.5, 3),
        ([1, 2, 3, 4, 5], 0.25, 2),
        ([5, 1, 4, 2, 3], 0.75, 4),
        ([7], 0.5, 7),
    ],
)
def test_order_stats_index_rule(spark, values, q, expected):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    got = exact_order_stats(df, "x", [q]).first()
    assert got["value"] == expected


def test_order_stats_with_heavy_ties_narrows_exactly(spark):
    vals = [50] * 300 + list(range(200)) + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    qs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = {r["fraction"]: r["value"] for r in exact_order_stats(df, "x", qs, accuracy=20).collect()}
    s = sorted(v for v in vals if v is not None)
    assert got == {q: s[int(len(s) * q)] for q in qs}


@pytest.mark.parametrize(
    "kind, expression, q",
    [
        ("uniform", "id % 100 + 1", 0.25),
        ("few values", "id % 50 + 1", 0.5),
        ("spike", "if(id < 50000, id, 50000)", 0.25),
        ("distinct", "id", 0.75),
        ("negative halves", "cast(-(id % 1000) / 2 as decimal(12,1))", 0.1),
    ],
)
def test_order_stats_rounds_stay_few(spark, kind, expression, q):
    """Every round drops the rows at its probes, so ties do not hold it up. The
    sketch is kept far smaller than the table, as it is at scale."""
    from vitrine.operators import order_stats

    n = 200_000
    df = spark.range(n).selectExpr(f"{expression} AS v")
    got = order_stats(df, "v", [q], accuracy=200, margin=0.02)
    assert got.rounds <= 4, (kind, got.rounds)
    want = df.orderBy("v").offset(int(n * q)).limit(1).first()["v"]
    assert got.values == [want] and got.n == n


@pytest.mark.parametrize("expression", ["id * 7919 % 1000003", "cast(id % 977 / 8 as decimal(18,6))", "if(id % 3 = 0, 12, id)", "cast(-id as smallint)"])
def test_nine_deciles_in_three_scans(spark, monkeypatch, expression):
    """Every scan is one action; the driver's own rows of sketches are not read from the table."""
    from pyspark.sql.classic.dataframe import DataFrame

    from vitrine.operators import order_stats

    df = spark.range(30_000 if "smallint" in expression else 300_000).selectExpr(f"{expression} AS v")
    qs = [i / 10 for i in range(1, 10)]
    scans = []
    for name in ("first", "collect"):
        def action(self, *a, run=getattr(DataFrame, name), **kw):
            if "Range (" in self._jdf.queryExecution().toString():
                scans.append(1)
            return run(self, *a, **kw)

        monkeypatch.setattr(DataFrame, name, action)
    got = order_stats(df, "v", qs)
    monkeypatch.undo()
    values = sorted(r["v"] for r in df.collect())
    assert got.values == [values[int(len(values) * q)] for q in qs]
    assert got.scans <= 3
    # ``first`` is a ``collect`` as well.
    assert len(scans) <= 2 * 3


@pytest.mark.parametrize("margin", [0.0, 1e-5, 0.4])
def test_bounds_that_fail_cost_scans_only(spark, margin):
    """A margin far below the sketch's error: the counts still lead to the right value."""
    from vitrine.operators import order_stats

    df = spark.range(50_000).selectExpr("id * 7919 % 50021 AS v")
    values = sorted(r["v"] for r in df.collect())
    qs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = order_stats(df, "v", qs, accuracy=8, margin=margin)
    assert got.values == [values[min(int(len(values) * q), len(values) - 1)] for q in qs]


def test_order_stats_of_doubles_and_wide_decimals(spark):
    from vitrine.operators import order_stats

    df = spark.range(5000).selectExpr("sqrt(id * 37 % 5003) AS d", "cast(id * 37 % 5003 as decimal(38,3)) * 1000000000000 AS w", "cast(id % 100 as int) - 50 AS i")
    for c in ("d", "w", "i"):
        values = sorted(r[c] for r in df.collect())
        assert order_stats(df, c, [0.25, 0.5]).values == [values[1250], values[2500]]


def test_order_stats_without_values(spark):
    from vitrine.operators import cut_values, order_stats

    none = spark.createDataFrame([(None,), (None,)], "x long")
    assert order_stats(none, "x", [0.5]).n == 0
    assert exact_order_stats(none, "x", [0.5]).collect() == []
    assert cut_values(none, "x", [0.5], ["m"]) == {"m": None}


def test_inequality_join_paths_agree(spark):
    left = spark.createDataFrame([(i, float(i % 7)) for i in range(30)], "l long, lv double")
    right = spark.createDataFrame([(j, float(j % 5) + 0.5) for j in range(40)] + [(99, None)], "r long, rv double")
    brute = {(i, j) for i in range(30) for j in range(40) if (j % 5) + 0.5 < (i % 7)}
    for kw in ({}, {"buckets": 4}, {"buckets": 1000}):
        for op in ("<",):
            got = {(x["l"], x["r"]) for x in inequality_join(left, right, "lv", "rv", op, **kw).collect()}
            assert got == brute
    ge = {(i, j) for i in range(30) for j in range(40) if (j % 5) + 0.5 >= (i % 7)}
    got = {(x["l"], x["r"]) for x in inequality_join(left, right, "lv", "rv", ">=", buckets=3).collect()}
    assert got == ge


def test_nest_orders_members(spark):
    df = spark.createDataFrame([("g", 2, "b"), ("g", 1, "a"), ("h", 1, "c")], "k string, r long, v string")
    out = {r["k"]: [m["v"] for m in r["items"]] for r in nest(df, ["k"], ["r"], ["v"], "items").collect()}
    assert out == {"g": ["a", "b"], "h": ["c"]}


def test_nest_cuts_long_lists_into_chunks(spark):
    df = spark.createDataFrame([("g", i + 1, i * i) for i in range(25)] + [("h", 1, 5)], "k string, r long, v long")
    out = nest(df, ["k"], ["r"], ["v"], "items", position="r", chunk_rows=10).orderBy("k", "chunk").collect()
    assert [(r["k"], r["chunk"], len(r["items"])) for r in out] == [("g", 0, 10), ("g", 1, 10), ("g", 2, 5), ("h", 0, 1)]
    assert [m["v"] for r in out if r["k"] == "g" for m in r["items"]] == [i * i for i in range(25)]


# ----------------------------------------------------------- analyses on edge rows
def test_lead_brand_tie_and_other_earnings(spark):
    df = make_listings(spark, [
        {"brand": "Zed", "earning": 10, "country": "A"},
        {"brand": "Acme", "earning": 3, "country": "A"},
        {"brand": "Mid", "earning": 1, "country": "A"},
        {"brand": "Mid", "earning": 2, "country": "A"},
        {"brand": "Acme", "earning": 4, "country": "A"},
    ])
    r = A.country_lead_brand(df).first()
    assert r["max_brand_name_for_country"] == "Acme"  # tie with Mid at 2, smaller name wins
    assert r["total_seller_earnings_country_max_brand_count_for_country"] == 7.0
    assert r["total_seller_earnings_country_all_other_brands"] == 13.0


def test_fees_null_and_cheaper_countries(spark):
    df = make_listings(spark, [
        {"warehouse_name": "W1", "country": "A", "buyers_fees": 10},
        {"warehouse_name": "W1", "country": "B", "buyers_fees": 2},
        {"warehouse_name": "W1", "country": "B", "buyers_fees": None},
        {"warehouse_name": "W2", "country": "B", "buyers_fees": 1},
        {"warehouse_name": "W2", "country": "C", "buyers_fees": None},
    ])
    counts = {r["warehouse_name"]: r for r in A.warehouse_state_counts(df).collect()}
    assert counts["W1"]["total_sold"] == 2 and counts["W1"]["avg_buyers_fees"] == 6.0
    pairs = {(r["warehouse_name"], r["country"]) for r in A.warehouse_cheaper_countries(df).collect()}
    # W1 mean 6 > B mean 1.5; W2 mean 1 has no cheaper country; C has no fee at all.
    assert pairs == {("W1", "B")}


def test_followers_zero_and_null(spark):
    df = make_listings(spark, [
        {"seller_id": "s0", "username": "zero", "num_followers": 0.0, "like_count": 4},
        {"seller_id": "sn", "username": "none", "num_followers": None, "like_count": 4},
        {"seller_id": "s5", "username": "five", "num_followers": 5.0, "like_count": 4},
    ])
    r = {x["username"]: x["likes_to_followers_ratio"] for x in A.country_seller_ranking(df).collect()}
    assert r == {"zero": 0.0, "none": None, "five": 80.0}


def test_single_material_season_and_unsold(spark):
    df = make_listings(spark, [
        {"season": "S1", "material": "wool", "sold": True},
        {"season": "S2", "material": "wool", "sold": True, "category": "A"},
        {"season": "S2", "material": "silk", "sold": False, "category": "B"},
        {"season": "S3", "material": "wool", "sold": True},
        {"season": "S3", "material": "silk", "sold": True},
    ])
    loo = {(r["season"], r["material"]): r["avg_of_other"] for r in A.season_material_leave_one_out(df).collect()}
    assert loo[("S1", "wool")] is None
    st = {r["season"]: r for r in A.season_sell_through(df).collect()}
    assert st["S1"]["least_sold_category"] is None and st["S1"]["percentage_sold_string"] == "100%"
    assert st["S2"]["least_sold_category"] == "B" and st["S2"]["percentage_sold_string"] == "50%"
    assert st["S2"]["percentage_sold"] == 50.0


def test_outfit_empty_branch(spark):
    df = make_listings(spark, [
        {"name": "black dress", "color": "Black", "price_usd": 30, "material": "silk"},
        {"name": "black dress", "color": "Black", "price_usd": 90, "material": "wool"},
        {"name": "black cap", "color": "Black", "price_usd": 50, "material": "wool"},
    ])
    ext = {r["slot"]: r for r in A.outfit_extremes(df).collect()}
    assert ext["cheapest_shoes"]["product_name"] is None
    assert ext["cheapest_dress"]["product_price"] == 30.0
    assert ext["cheapest_dress"]["cheapest_total"] == 30.0
    assert ext["most_expensive_dress"]["most_expensive_total"] == 90.0
    rng = A.outfit_range_listings(df).collect()
    assert [(r["product_name"], r["product_price"]) for r in rng] == [("black cap", 50.0)]


def test_keywords_whole_and_split(spark):
    df = make_listings(spark, [{"keywords": None}, {"keywords": "boho"}, {"keywords": "a,b,,c"}])
    whole = sorted(r["keyword"] for r in A.keyword_rows(df).collect())
    assert whole == ["a,b,,c", "boho"]
    split = sorted(r["keyword"] for r in A.keyword_rows(df, ",").collect())
    assert split == ["a", "b", "boho", "c"]


def test_null_badge_matches_null(spark):
    df = make_listings(spark, [
        {"seller_id": "s1", "badge": None, "earning": 4, "products_sold": 9},
        {"seller_id": "s2", "badge": "Expert", "earning": 6, "products_sold": 1},
    ])
    rep = {r["badge"]: r for r in A.badge_report(df, 3).collect()}
    assert set(rep) == {None, "Expert"}
    assert rep[None]["seller_username"] == "u1" and rep[None]["count"] == 1


def test_seller_with_two_badges_ranks_under_min(spark):
    df = make_listings(spark, [
        {"seller_id": "s1", "badge": "Trusted", "products_sold": 5},
        {"seller_id": "s1", "badge": "Expert", "products_sold": 7},
    ])
    top = A.badge_top_sellers(df).collect()
    assert [(r["badge"], r["products_sold"]) for r in top] == [("Expert", 7)]
    earn = {r["badge"] for r in A.badge_earnings(df).collect()}
    assert earn == {"Expert"}  # listing badge "Trusted" is carried by no seller


def test_same_username_two_sellers_group_together(spark):
    df = make_listings(spark, [
        {"seller_id": "a", "username": "same", "seller_price": 10, "country": "X"},
        {"seller_id": "b", "username": "same", "seller_price": 20, "country": "X"},
    ])
    r = A.cheapest_sellers_by_material(df, ["X"], 50).collect()
    assert len(r) == 1 and r[0]["avg_price"] == 15.0


def window_rank(df, keys, order):
    """The plain window, which holds a group in one task."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from vitrine.operators import order_columns

    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_columns(order))))


def test_rank_matches_window_with_hot_key(spark):
    from vitrine.operators import rank_per_group

    rows = [("hot", i % 97, i) for i in range(3000)] + [(f"k{j}", j, j) for j in range(50)] + [(None, 1, 7)]
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(8)
    order = [("v", "desc"), ("id", "asc")]
    want = {(r["g"], r["id"]): r["rank"] for r in window_rank(df, ["g"], order).collect()}
    got = {(r["g"], r["id"]): r["rank"] for r in rank_per_group(df, ["g"], order).collect()}
    assert got == want


@pytest.mark.parametrize("batch", [7, 10_000])
def test_rank_over_many_partitions_keeps_the_order(spark, batch):
    """A group over several partitions and batches, null and NaN keys; nothing is sorted or moved again."""
    from vitrine.operators import rank_per_group

    nan = float("nan")
    rows = [("hot", 1.0, i % 97, i) for i in range(3000)] + [(f"k{j}", nan, j, j) for j in range(50)] + [(None, None, 1, 7), (None, None, 1, 8), ("k3", nan, 1, 999)]
    df = spark.createDataFrame(rows, "g string, h double, v long, id long").repartition(8)
    order = [("v", "desc"), ("id", "asc")]
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ranked = rank_per_group(df, ["g", "h"], order)
        assert ranked.rdd.getNumPartitions() > 4
        got = [(r["g"], str(r["h"]), r["v"], r["id"], r["rank"]) for r in ranked.collect()]
        text = ranked._jdf.queryExecution().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {(r["g"], r["id"], str(r["h"])): r["rank"] for r in window_rank(df, ["g", "h"], order).collect()}
    assert {(g, i, h): rank for g, h, _, i, rank in got} == want
    assert got == sorted(got, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[4]))
    assert "Exchange" not in text and "Sort [" not in text


def test_inequality_join_heavy_value_bucket(spark):
    # Half of the right side is one value: it gets its own bucket.
    right = spark.createDataFrame([(j, 5.0) for j in range(200)] + [(1000 + j, float(j % 11)) for j in range(200)], "r long, rv double")
    left = spark.createDataFrame([(i, float(i % 13)) for i in range(60)], "l long, lv double")
    rv = {r["r"]: r["rv"] for r in right.collect()}
    lv = {r["l"]: r["lv"] for r in left.collect()}
    for op, f in (("<", lambda a, b: b < a), ("<=", lambda a, b: b <= a), (">", lambda a, b: b > a)):
        brute = {(i, j) for i in lv for j in rv if f(lv[i], rv[j])}
        got = {(x["l"], x["r"]) for x in inequality_join(left, right, "lv", "rv", op, buckets=8).collect()}
        assert got == brute, op


def test_stored_intermediates_are_scanned(spark):
    from tests.conftest import SF_SMALL
    from vitrine.sources.store import listings

    cube = A.fee_cube(listings(spark, SF_SMALL), store=True)
    assert "LogicalRDD" in cube._jdf.queryExecution().optimizedPlan().toString()


def test_prices_are_rounded_before_they_are_added(spark):
    """Two items at 10.004 cost 10.00 each as reported, 20.00 together."""
    df = make_listings(spark, [
        {"name": "ring a", "price_usd": "10.004"}, {"name": "bolt b", "price_usd": "10.004"},
        {"name": "ring c", "price_usd": "30.005"}, {"name": "bolt d", "price_usd": "30.015"},
        {"name": "red thing", "price_usd": "20.005"},
    ])
    args = ("Women", ("ring", "bolt"))
    rows = A.outfit_extremes(df, args[0], args[1], ("Ring", "Bolt"), "red").collect()
    assert {r["cheapest_total"] for r in rows} == {20.0} and {r["most_expensive_total"] for r in rows} == {60.02}
    assert "red thing" in {r["product_name"] for r in A.outfit_range_candidates(df, *args, "red").collect()}


def test_null_equals_null_in_lookups(spark):
    df = make_listings(spark, [
        {"name": "ring a", "price_usd": 5, "material": None}, {"name": "bolt b", "price_usd": 5, "material": "iron"},
        {"name": "red x", "price_usd": 7, "material": None}, {"name": "red y", "price_usd": 7, "material": "iron"},
    ])
    found = A.outfit_range_candidates(df, "Women", ("ring", "bolt"), "red").collect()
    assert found == []  # both totals are 10
    df = make_listings(spark, [
        {"name": "ring a", "price_usd": 5, "material": None}, {"name": "ring b", "price_usd": 50, "material": None},
        {"name": "bolt c", "price_usd": 5, "material": "iron"},
        {"name": "red x", "price_usd": 17, "material": None}, {"name": "red y", "price_usd": 17, "material": "iron"},
    ])
    assert {r["product_name"] for r in A.outfit_range_candidates(df, "Women", ("ring", "bolt"), "red").collect()} == {"ring b", "red x"}
    df = make_listings(spark, [
        {"category": "C", "seller_id": None, "num_followers": 99, "brand": "B1"}, {"category": "C", "seller_id": "s", "num_followers": 1},
        {"category": "D", "seller_id": None, "brand": "B1"}, {"category": "D", "seller_id": None, "brand": "B2"},
    ])
    got = [(r["brand"], r["total_sold"]) for r in A.top_seller_brands(df, "C", "Expert").collect()]
    assert got == [("B1", 2), ("B2", 1)]
    assert A.top_seller_brands(df, "none", "Expert").collect() == []


def test_inequality_join_with_equality_keys_both_paths(spark):
    left = spark.createDataFrame([(i, f"g{i % 3}", float(i % 7)) for i in range(40)] + [(99, None, 5.0)], "l long, g string, lv double")
    right = spark.createDataFrame([(j, f"g{j % 4}", float(j % 6)) for j in range(50)] + [(98, None, 1.0)], "r long, g string, rv double")
    L = [(r["l"], r["g"], r["lv"]) for r in left.collect()]
    R = [(r["r"], r["g"], r["rv"]) for r in right.collect()]
    brute = {(l, r) for l, lg, lv in L for r, rg, rv in R if lg == rg and rv < lv}
    brute |= {(l, r) for l, lg, lv in L for r, rg, rv in R if lg is None and rg is None and rv < lv}  # null-safe keys
    for kw in ({}, {"buckets": 4}, {"buckets": 1000}):
        out = inequality_join(left, right, "lv", "rv", "<", on=["g"], **kw)
        assert out.columns.count("g") == 1
        assert {(x["l"], x["r"]) for x in out.collect()} == brute


def test_inequality_join_of_millions_of_distinct_values(spark):
    """No value enters the plan, however many there are, and all of it is generated code."""
    right = spark.range(4_000_000).selectExpr("id AS r", "cast(id * 7919 % 4000037 as double) AS rv")
    left = spark.createDataFrame([(i, float(300 * i)) for i in range(40)] + [(99, -1.0), (98, None)], "l long, lv double")
    out = inequality_join(left, right, "lv", "rv", "<")
    text = out._jdf.queryExecution().toString()
    assert len(text) < 60_000 and "4000036" not in text
    got = out.groupBy("l").agg(F.count("*").alias("n"), F.max("rv").alias("top")).collect()
    values = sorted(i * 7919 % 4000037 for i in range(4_000_000))
    for r in got:
        below = [v for v in values[:20_000] if v < 300 * r["l"]]
        assert (r["n"], r["top"]) == (len(below), below[-1])
    assert {r["l"] for r in got} == set(range(1, 40))


def test_inequality_join_of_ties_costs_its_output(spark):
    """A third of both sides are one value: a strict join makes no pair of them on the way."""
    left = spark.range(30_000).selectExpr("id AS l", "if(id % 3 = 0, 5, -1) AS lv")
    right = spark.range(30_000).selectExpr("id AS r", "if(id % 3 = 0, 5, 10 + id) AS rv")
    assert inequality_join(left, right, "lv", "rv", "<").count() == 0
    few = left.where("l < 30")
    assert inequality_join(few, right, "lv", "rv", "<=").count() == 10 * 10_000


def test_null_condition_is_its_own_group(spark):
    df = make_listings(spark, [
        {"condition": None, "type": "T1", "color": "red"},
        {"condition": None, "type": "T1", "color": "red"},
        {"condition": None, "type": "T2", "color": "blue"},
        {"condition": "new", "type": "T1", "color": "blue"},
    ])
    rows = sorted(
        ((r["condition"] or ""), r["product_type"], r["count"], r["color"], r["color_count"])
        for r in A.top_types_and_colors(df).collect()
    )
    assert rows == [("", "T1", 2, "red", 2), ("", "T2", 1, "blue", 1), ("new", "T1", 1, "blue", 1)]
