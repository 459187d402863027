"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each reads the listing table derived from the driver tables at ``sf_dir``
(stored once per session, see ``vitrine.sources.store``) and runs over all of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrine.plans import analyses as A
from vitrine.plans import params as P
from vitrine.sources.store import listings

Query = Callable[[SparkSession, str], DataFrame]


def _on_listings(fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(listings(spark, sf_dir))

    run.__doc__ = fn.__doc__
    return run


def analysis_queries() -> dict[str, Query]:
    q = _on_listings
    return {
        "top_seller_brands": q(lambda d: A.top_seller_brands(d, P.T1_CATEGORY, P.T1_BADGE, 5)),
        "brand_avg_seller_earnings": q(
            lambda d: A.brand_avg_seller_earnings(d, P.T2_MAX_PRICE, P.T2_MIN_LISTED, P.T2_MIN_SOLD, 10)
        ),
        "badge_top_sellers": q(lambda d: A.badge_top_sellers(d, 3)),
        "badge_earnings": q(A.badge_earnings),
        "badge_report": q(lambda d: A.badge_report(d, 3)),
        "country_seller_ranking": q(A.country_seller_ranking),
        "cheapest_sellers_by_material": q(
            lambda d: A.cheapest_sellers_by_material(d, P.T5_COUNTRIES, P.T5_MIN_PASS_RATE, 3)
        ),
        "season_material_price_profile": q(
            lambda d: A.season_material_price_profile(d, P.J1_GENDER, P.J1_PATTERN, None, 30)
        ),
        "season_material_price_profile_capped": q(
            lambda d: A.season_material_price_profile(d, P.J1_GENDER, P.J1_PATTERN, P.J1_MAX_PRICE, 30)
        ),
        "category_popularity": q(A.category_popularity),
        "season_sell_through": q(A.season_sell_through),
        "popular_keywords_by_condition": q(lambda d: A.popular_keywords_by_condition(d, None)),
        "popular_keywords_split": q(lambda d: A.popular_keywords_by_condition(d, P.J4_SEPARATOR)),
        "outfit_extremes": q(lambda d: A.outfit_extremes(d, P.J5_GENDER, P.J5_KINDS, P.J5_LABELS, P.J5_COLOR)),
        "outfit_range_listings": q(
            lambda d: A.outfit_range_listings(d, P.J5_GENDER, P.J5_KINDS, P.J5_COLOR, 10)
        ),
        "top_types_and_colors": q(lambda d: A.top_types_and_colors(d, 2, 2)),
        "season_material_leave_one_out": q(lambda d: A.season_material_leave_one_out(d, 5)),
        "country_lead_brand": q(A.country_lead_brand),
        "warehouse_state_counts": q(A.warehouse_state_counts),
        "warehouse_cheaper_countries": q(A.warehouse_cheaper_countries),
        "warehouse_nearest_types": q(lambda d: A.warehouse_nearest_types(d, 2)),
        "price_quartile_cuts": q(A.price_quartile_cuts),
        "price_quartile_band_counts": q(A.price_quartile_band_counts),
        "price_quartile_bands": q(A.price_quartile_bands),
    }


def wide_range_queries() -> dict[str, Query]:
    """T4 and M5 again: T4 by its only plan, and M5 with a coarse sketch and
    narrow probes, so that the driver tables need several rounds."""
    q = _on_listings
    return {
        "country_seller_ranking_distributed": q(A.country_seller_ranking),
        "price_quartile_cuts_narrowed": q(lambda d: A.price_quartile_cuts(d, accuracy=50, margin=0.05)),
    }


def all_queries() -> dict[str, Query]:
    from vitrine.plans.operator_queries import operator_queries

    return {**analysis_queries(), **wide_range_queries(), **operator_queries()}
