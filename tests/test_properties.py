"""Property tests: rounding and order statistics against Python, and
invariants of the analyses on the sf0.001 tables."""

from __future__ import annotations

from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vitrine.functions import ratio_half_even
from vitrine.operators import exact_order_stats
from vitrine.plans import analyses as A
from vitrine.sources.store import listings

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**4)), min_size=1, max_size=60))
def test_half_even_matches_decimal(spark, pairs):
    df = spark.createDataFrame([(Decimal(s) / 100, n) for s, n in pairs], "s decimal(18,2), n long")
    got = [r[0] for r in df.select(ratio_half_even(F.col("s"), F.col("n"))).collect()]
    want = [float((Decimal(s) / 100 / Decimal(n)).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN)) for s, n in pairs]
    assert got == want


@SLOW
@given(
    st.lists(st.integers(0, 30), min_size=1, max_size=200),
    st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]), min_size=1, max_size=3, unique=True),
)
def test_order_stats_match_sorting(spark, values, qs):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    got = {r["fraction"]: r["value"] for r in exact_order_stats(df, "x", qs, accuracy=4, margin=0.1).collect()}
    s = sorted(values)
    assert got == {q: s[int(len(s) * q)] for q in qs}


def test_bands_partition_priced_rows(spark):
    df = listings(spark, SF_SMALL)
    n = df.where(F.col("price_usd").isNotNull()).count()
    counts = A.price_quartile_band_counts(df).collect()
    assert sum(r["count"] for r in counts) == n
    assert {r["band"] for r in counts} == {"min_q1", "q1_median", "median_q3", "q3_max"}


def test_country_ranks_are_dense_from_one(spark):
    rows = A.country_seller_ranking(listings(spark, SF_SMALL)).collect()
    by = {}
    for r in rows:
        by.setdefault(r["country"], []).append(r["rank"])
    for ranks in by.values():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))


def test_lead_plus_other_is_country_total(spark):
    df = listings(spark, SF_SMALL)
    tot = {
        r["c"]: float(r["t"])
        for r in df.groupBy(F.col("seller.country").alias("c")).agg(F.sum("seller.earning").alias("t")).collect()
    }
    for r in A.country_lead_brand(df).collect():
        lead = r["total_seller_earnings_country_max_brand_count_for_country"]
        other = r["total_seller_earnings_country_all_other_brands"]
        assert abs(lead + other - tot[r["country_name"]]) < 1e-6


def test_sell_through_counts_bounded_by_rows(spark):
    df = listings(spark, SF_SMALL)
    rows = {r["season"]: r["n"] for r in df.groupBy("season").agg(F.count(F.lit(1)).alias("n")).collect()}
    for r in A.season_sell_through(df).collect():
        assert r["total_sold"] + r["total_not_sold"] <= rows[r["season"]]
        assert r["total_products"] == r["total_sold"] + r["total_not_sold"]


FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@FEW
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 20)), min_size=1, max_size=40),
    st.lists(st.one_of(st.none(), st.integers(0, 20)), min_size=1, max_size=60),
    st.sampled_from(["<", "<=", ">", ">="]),
    st.integers(2, 9),
)
def test_bucketed_inequality_join_matches_brute_force(spark, lvals, rvals, op, buckets):
    import operator

    from vitrine.operators import inequality_join

    left = spark.createDataFrame(list(enumerate(lvals)), "l long, lv long")
    right = spark.createDataFrame(list(enumerate(rvals)), "r long, rv long")
    cmp = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}[op]
    want = {(i, j) for i, a in enumerate(lvals) for j, b in enumerate(rvals) if a is not None and b is not None and cmp(b, a)}
    got = inequality_join(left, right, "lv", "rv", op, buckets=buckets).collect()
    assert {(x["l"], x["r"]) for x in got} == want
    assert len(got) == len(want)


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5)), min_size=1, max_size=120))
def test_rank_matches_window(spark, rows):
    from tests.test_operators import window_rank
    from vitrine.operators import rank_per_group

    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g string, v long, id long").repartition(4)
    order = [("v", "desc"), ("id", "asc")]
    want = {(r["id"], r["rank"]) for r in window_rank(df, ["g"], order).collect()}
    got = {(r["id"], r["rank"]) for r in rank_per_group(df, ["g"], order).collect()}
    assert got == want
