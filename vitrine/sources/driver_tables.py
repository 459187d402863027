"""The ``products`` listing table derived from the driver's star-schema tables.

One listing per ``lineitem`` row, with the mapping in FIXTURES.md section 2.
The result has the same field paths as the typed CSV ingest (``brand.name``,
``seller.country``, ``shipping.buyers_fees`` ...), so every analysis runs on
either source unchanged.

Join plan. Dimensions are joined to each other first, so the fact table
meets three already-denormalised sides:

    supplier_dim = supplier x nation                   (seller attributes)
    order_dim    = orders x customer x nation x region (condition, category,
                                                        warehouse)
    lineitem x order_dim x part x supplier_dim

No join is hinted: the planner and AQE broadcast from file and runtime sizes
and otherwise sort-merge on the key (splitting skewed keys).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.sources.schema import LISTING_SCHEMA, MONEY

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
]

# The source's own keys, of which a listing's id is made.
KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

# Fixture mapping of return flag to gender and of account
# balance to badge (FIXTURES.md section 2).
GENDER_BY_FLAG = {"N": "Women", "A": "Men", "R": "Unisex"}
BADGE_EXPERT_MIN = 4000
BADGE_TRUSTED_MIN = 1500

MONEY2 = "decimal(18,2)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _gender(flag):
    expr = None
    for k, v in GENDER_BY_FLAG.items():
        expr = (F.when(flag == k, v) if expr is None else expr.when(flag == k, v))
    return expr


def listing_id():
    return F.concat_ws("-", *KEYS)


def listing_view(spark: SparkSession, sf_dir: str, cluster_by=(), share: tuple[int, int] = (0, 1)) -> DataFrame:
    """Nested listing table over the driver tables, a lazy plan.

    With ``cluster_by`` (columns of the joined rows: ``gender_target``, ``color``,
    ``material``, ``l_suppkey``) the rows of each partition are sorted by them, before
    they are typed and nested: a sort holds all rows of its partition, and these are
    less than half as long.

    ``share`` (i, n): only the i-th of n shares of the listings, divided by order, so
    that an order is joined in one share only (the planner infers its filter).
    """
    t = lambda n: read_table(spark, sf_dir, n)
    nation = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    region = t("region").select("r_regionkey", "r_name")
    supplier_dim = t("supplier").join(
        nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("s_country")),
        "s_nationkey",
    ).select("s_suppkey", "s_name", "s_country", "s_acctbal")

    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("c_nationkey"), "r_name"
    )
    customer_dim = t("customer").join(geo, "c_nationkey").select(
        "c_custkey", "c_mktsegment", "r_name"
    )
    order_dim = t("orders").join(
        customer_dim, F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "o_orderpriority", "c_mktsegment", "r_name")

    part = t("part").select("p_partkey", "p_name", "p_brand", "p_type")
    li = t("lineitem")
    i, n = share
    if n > 1:
        li = li.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(n)) == i)

    j = (
        li.join(order_dim, li.l_orderkey == order_dim.o_orderkey)
        .join(part, li.l_partkey == part.p_partkey)
        .join(supplier_dim, li.l_suppkey == supplier_dim.s_suppkey)
    )

    j = j.select(
        *KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate", "o_orderpriority", "c_mktsegment", "r_name", "p_name", "p_brand",
        "p_type", "s_name", "s_country", "s_acctbal",
        _gender(F.col("l_returnflag")).alias("gender_target"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("color"),
        F.when(F.col("l_partkey") % 53 != 0, F.split_part("p_name", F.lit(" "), F.lit(2))).alias("material"),
    )
    if cluster_by:
        j = j.sortWithinPartitions(*cluster_by)

    # A factor and a rate that give prices and fees more than two decimals.
    listed = F.col("l_extendedprice").cast(MONEY2)
    price = (listed * F.lit(Decimal("0.9973"))).cast(MONEY)
    fee = (F.col("l_tax").cast(MONEY2) * F.lit(Decimal("31.7"))).cast(MONEY)
    acct = F.col("s_acctbal")
    listing = j.select(
        *KEYS,
        listing_id().alias("id"),
        F.col("p_type").alias("type"),
        F.col("p_name").alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.col("p_name").alias("keywords"),
        "gender_target",
        F.col("c_mktsegment").alias("category"),
        F.concat(F.lit("Q"), F.quarter("l_shipdate").cast("string")).alias("season"),
        F.col("o_orderpriority").alias("condition"),
        F.col("l_quantity").cast(MONEY).alias("like_count"),
        "material",
        "color",
        price.alias("price_usd"),
        F.struct(F.col("p_brand").alias("id"), F.col("p_brand").alias("name")).alias("brand"),
        F.struct(
            (F.col("l_linestatus") == "F").alias("sold"),
            (F.col("l_returnflag") == "R").alias("reserved"),
            (F.col("l_linestatus") == "O").alias("available"),
        ).alias("state"),
        F.struct(
            F.when(F.col("l_suppkey") % 31 != 0, F.col("l_suppkey").cast("string")).alias("id"),
            F.col("s_name").alias("username"),
            F.col("s_country").alias("country"),
            price.alias("price"),
            (listed * (F.lit(1) - F.col("l_discount").cast(MONEY2))).cast(MONEY).alias("earning"),
            ((F.col("l_suppkey") * 13) % 100).alias("products_sold"),
            ((F.col("l_suppkey") * 37) % 200).alias("num_products_listed"),
            F.lit(None).cast("double").alias("community_rank"),
            F.greatest(acct, F.lit(0.0)).cast(MONEY).alias("num_followers"),
            (F.lit(60) + F.col("l_suppkey") % 41).cast("double").alias("pass_rate"),
            F.when(F.col("l_suppkey") % 23 == 0, F.lit(None).cast("string"))
            .when(acct >= BADGE_EXPERT_MIN, "Expert")
            .when(acct >= BADGE_TRUSTED_MIN, "Trusted")
            .otherwise("Regular")
            .alias("badge"),
        ).alias("seller"),
        F.struct(F.when(F.col("l_tax") != 0, fee).alias("buyers_fees"), F.col("r_name").alias("warehouse_name")).alias("shipping"),
    )
    # The types of the CSV ingest, field by field, after the source's own keys.
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in LISTING_SCHEMA.fields]
    return listing.select(*KEYS, *typed)
