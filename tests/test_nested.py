"""Nested and flat forms hold the same rows, in the documented order."""

from __future__ import annotations

from tests.conftest import SF_SMALL
from vitrine.plans import analyses as A
from vitrine.plans import nested as N
from vitrine.plans import params as P
from vitrine.sources.store import listings


def test_types_and_colors_nested_matches_flat(spark):
    df = listings(spark, SF_SMALL)
    flat = {(r["condition"], r["product_type"], r["count"], r["color"], r["color_count"]) for r in A.top_types_and_colors(df).collect()}
    nested = set()
    for r in N.top_types_and_colors_nested(df).collect():
        counts = [t["count"] for t in r["product_types"]]
        assert counts == sorted(counts, reverse=True)
        for t in r["product_types"]:
            cc = [x["color_count"] for x in t["top_colors"]]
            assert cc == sorted(cc, reverse=True)
            for x in t["top_colors"]:
                nested.add((r["condition"], t["product_type"], t["count"], x["color"], x["color_count"]))
    assert nested == flat


def test_ranking_nested_in_rank_order(spark):
    df = listings(spark, SF_SMALL)
    for r in N.country_seller_ranking_nested(df).collect():
        ranks = [x["rank"] for x in r["rank_by_earnings"]]
        assert ranks == list(range(1, len(ranks) + 1))


def test_other_nested_forms_cover_flat_rows(spark):
    df = listings(spark, SF_SMALL)
    seller = N.top_seller_brands_nested(df, category=P.T1_CATEGORY, badge=P.T1_BADGE).collect()
    assert len(seller) == 1 and len(seller[0]["seller"]["brands"]) == 5
    wh = N.warehouse_fee_comparison_nested(df).collect()
    n_flat = A.warehouse_nearest_types(df).count()
    assert sum(len(t["nearest_product_types"]) for r in wh for t in r["countries_less_buyers_fees"]) == n_flat
    mats = N.season_material_leave_one_out_nested(df).collect()
    assert all(len(r["materials"]) == 5 for r in mats)
    badges = N.badge_report_nested(df).collect()
    assert sum(len(r["top_sellers"]) for r in badges) == A.badge_report(df).count()
    cheap = N.cheapest_sellers_by_material_nested(
        df, countries=P.T5_COUNTRIES, min_pass_rate=P.T5_MIN_PASS_RATE
    ).collect()
    assert all(1 <= len(r["top_sellers"]) <= 3 for r in cheap)


def test_long_ranking_is_cut_into_chunks(spark):
    df = listings(spark, "/root/testdata/sf0.01")
    whole = {(r["country"], x["username"], x["rank"]) for r in N.country_seller_ranking_nested(df).collect() for x in r["rank_by_earnings"]}
    chunks = N.country_seller_ranking_nested(df, chunk_rows=2).collect()
    assert max(len(r["rank_by_earnings"]) for r in chunks) == 2
    assert {(r["country"], x["username"], x["rank"]) for r in chunks for x in r["rank_by_earnings"]} == whole


def test_bands_dataframe_form(spark):
    from vitrine.operators import bands

    df = listings(spark, SF_SMALL)
    b = bands(df, "price_usd", A.QUARTILES, A.BAND_LABELS)
    flat = A.price_quartile_bands(df)
    assert sorted(r["band"] for r in b.select("band").collect()) == sorted(r["band"] for r in flat.select("band").collect())
