"""The typed, nested listing schema and the raw CSV header it comes from."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 6)

# Raw CSV header names, as the reshaping scripts read them.
# (name, required). Optional columns default to null when absent.
RAW_COLUMNS: list[tuple[str, bool]] = [
    ("product_id", True),
    ("product_type", False),
    ("product_name", True),
    ("product_description", True),
    ("product_keywords", True),
    ("product_gender_target", True),
    ("product_category", True),
    ("product_season", True),
    ("product_condition", True),
    ("product_like_count", True),
    ("product_material", True),
    ("product_color", True),
    ("price_usd", True),
    ("brand_id", True),
    ("brand_name", True),
    ("sold", False),
    ("reserved", False),
    ("available", False),
    ("seller_id", True),
    ("seller_username", True),
    ("seller_country", True),
    ("seller_price", True),
    ("seller_earning", True),
    ("seller_products_sold", True),
    ("seller_num_products_listed", True),
    ("seller_community_rank", True),
    ("seller_num_followers", True),
    ("seller_pass_rate", True),
    ("seller_badge", True),
    ("buyers_fees", True),
    ("warehouse_name", True),
]

REQUIRED_COLUMNS = [c for c, req in RAW_COLUMNS if req]
OPTIONAL_COLUMNS = [c for c, req in RAW_COLUMNS if not req]

# All raw values are text; typing happens once, in ``type_listings``.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c, _ in RAW_COLUMNS])

BRAND = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
])
STATE = T.StructType([
    T.StructField("sold", T.BooleanType()),
    T.StructField("reserved", T.BooleanType()),
    T.StructField("available", T.BooleanType()),
])
SELLER = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("price", MONEY),
    T.StructField("earning", MONEY),
    T.StructField("products_sold", T.LongType()),
    T.StructField("num_products_listed", T.LongType()),
    T.StructField("community_rank", T.DoubleType()),
    T.StructField("num_followers", MONEY),
    T.StructField("pass_rate", T.DoubleType()),
    T.StructField("badge", T.StringType()),
])
SHIPPING = T.StructType([
    T.StructField("buyers_fees", MONEY),
    T.StructField("warehouse_name", T.StringType()),
])

LISTING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("keywords", T.StringType()),
    T.StructField("gender_target", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("season", T.StringType()),
    T.StructField("condition", T.StringType()),
    T.StructField("like_count", MONEY),
    T.StructField("material", T.StringType()),
    T.StructField("color", T.StringType()),
    T.StructField("price_usd", MONEY),
    T.StructField("brand", BRAND),
    T.StructField("state", STATE),
    T.StructField("seller", SELLER),
    T.StructField("shipping", SHIPPING),
])
