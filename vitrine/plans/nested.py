"""Nested result documents (N1-N3), built from the flat results.

The flat results are the checked API; these wrap them in the document shape
the reference returns. Lists after a top-k are short; lists of any length (a
country's sellers, a warehouse's cheaper countries) are cut into chunk rows.
M5's product lists (the whole table in four arrays) have no nested form: the
flat bands are the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators import nest, rank_per_group
from vitrine.plans import analyses as A

c = F.col


def top_seller_brands_nested(df: DataFrame, **kw) -> DataFrame:
    """``seller {username, num_followers, brands [{brand, totalSold}]}``."""
    flat = A.top_seller_brands(df, **kw).withColumn("_neg", -c("total_sold"))
    lists = nest(flat, ["username", "num_followers"], ["_neg", "brand"], ["brand", "total_sold"], "brands")
    return lists.select(F.struct("username", "num_followers", "brands").alias("seller"))


def country_seller_ranking_nested(df: DataFrame, chunk_rows: int = 10_000) -> DataFrame:
    """``country, chunk, rankByEarnings [{username, total_earnings, ..., rank}]``.

    A country's sellers are cut into lists of ``chunk_rows``, so the list of a
    country of any size is a few rows rather than one too large.
    """
    flat = A.country_seller_ranking(df)
    fields = ["username", "total_earnings", "avg_likes_per_product", "likes_to_followers_ratio", "rank"]
    return nest(flat, ["country"], ["rank"], fields, "rank_by_earnings", "rank", chunk_rows).orderBy("country", "chunk")


def top_types_and_colors_nested(df: DataFrame, k_types: int = 2, k_colors: int = 2) -> DataFrame:
    """``condition, product_types [{product_type, count, top_colors [{color, count}]}]``."""
    flat = A.top_types_and_colors(df, k_types, k_colors)
    colors = nest(
        flat.withColumn("_neg", -c("color_count")),
        ["condition", "product_type", "count"],
        ["_neg", "color"],
        ["color", "color_count"],
        "top_colors",
    )
    types = nest(
        colors.withColumn("_neg", -c("count")),
        ["condition"],
        ["_neg", "product_type"],
        ["product_type", "count", "top_colors"],
        "product_types",
    )
    return types.orderBy("condition")


def season_material_leave_one_out_nested(df: DataFrame, k: int = 5) -> DataFrame:
    """``season, materials [{material, count, avg_price_usd, avg_of_other, difference}]``."""
    flat = A.season_material_leave_one_out(df, k).withColumn("_neg", -c("count"))
    fields = ["material", "count", "avg_price_usd", "avg_of_other", "difference"]
    return nest(flat, ["season"], ["_neg", "material"], fields, "materials").orderBy("season")


def warehouse_fee_comparison_nested(df: DataFrame, k: int = 2) -> DataFrame:
    """Per warehouse, its counts and mean fee, and each cheaper country
    with its ``k`` nearest types."""
    flat = A.warehouse_nearest_types(df, k)
    types = nest(
        flat.withColumn("_d", c("diff")),
        ["warehouse_name", "total_sold", "total_reserved", "total_available", "avg_buyers_fees", "country",
         "avg_buyers_fees_country"],
        ["_d", "type"],
        ["type", "type_avg_buyers_fees", "diff"],
        "nearest_product_types",
    )
    keys = ["warehouse_name", "total_sold", "total_reserved", "total_available", "avg_buyers_fees"]
    return nest(
        rank_per_group(types, keys, ["country"], "_position"),
        keys,
        ["country"],
        ["country", "avg_buyers_fees_country", "nearest_product_types"],
        "countries_less_buyers_fees",
        "_position",
    ).orderBy("warehouse_name", "chunk")


def badge_report_nested(df: DataFrame, k: int = 3) -> DataFrame:
    """``badge, min/max/avg earnings, count, topSellers [{seller_username, products_sold}]``."""
    flat = A.badge_report(df, k)
    keys = ["badge", "min_earnings", "max_earnings", "avg_earnings", "count"]
    return nest(flat, keys, ["seller_rank"], ["seller_username", "products_sold"], "top_sellers")


def cheapest_sellers_by_material_nested(df: DataFrame, **kw) -> DataFrame:
    """``material, topSellers [{seller, avg_price, pass_rate, seller_country}]``."""
    flat = A.cheapest_sellers_by_material(df, **kw)
    return nest(
        flat, ["material"], ["rank"], ["seller", "avg_price", "pass_rate", "seller_country"], "top_sellers"
    ).orderBy("material")
