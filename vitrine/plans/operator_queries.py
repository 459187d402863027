"""Single-operator queries over the whole listing table, each with its SQL.

Each exercises one operator from the inventory on real data (filters, group
operators, windows, joins, array expressions, rounding, typed ingest) so it
can be checked alone against DuckDB.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import guarded_ratio, match_ci, plain_decimal_string, ratio_half_even, scaled_half_even, sum0, to_scaled_double
from vitrine.operators import (
    above_scalar,
    argmax_per_group,
    exact_order_stats,
    inequality_join,
    join_on_keys,
    lookup,
    leave_one_out_mean,
    mode_per_group,
    nearest_k,
    rank_per_group,
    top_k_per_group,
)
from vitrine.plans import analyses as A
from vitrine.plans import nested as N
from vitrine.plans import oracle as O
from vitrine.plans import params as P
from vitrine.plans.registry import _on_listings
from vitrine.session import checkpoint_root
from vitrine.sources.ingest import (
    ingest_listings,
    nest_listing,
    quarantine,
    read_listings_json,
    type_listings,
    write_listings_json,
    write_listings_with_quarantine,
)
from vitrine.sources.store import shares

c = F.col

# Text is several times as long as the stored listings: this many are text at a time.
ROWS_AS_TEXT = 10_000_000


# ---------------------------------------------------------------- filters
def filter_or_range(df: DataFrame) -> DataFrame:
    """range plus a disjunction across two fields."""
    return df.where(
        (c("price_usd") <= F.lit(P.T2_MAX_PRICE))
        & ((c("seller.num_products_listed") >= P.T2_MIN_LISTED) | (c("seller.products_sold") >= P.T2_MIN_SOLD))
    ).select(
        "l_orderkey", "l_linenumber", c("brand.name").alias("brand"), c("seller.id").alias("seller_id"),
        c("price_usd").cast("double").alias("price_usd"),
    )


def filter_regex_ci(df: DataFrame) -> DataFrame:
    """equality plus a case-insensitive regex."""
    return df.where((c("gender_target") == P.J1_GENDER) & match_ci("name", P.J1_PATTERN)).select(
        "l_orderkey", "l_linenumber", "name", "gender_target", c("price_usd").cast("double").alias("price_usd")
    )


def filter_not_null(df: DataFrame) -> DataFrame:
    """present and not null (NaN is null after ingest)."""
    return df.where(c("shipping.buyers_fees").isNotNull() & c("price_usd").isNotNull()).select(
        "l_orderkey", "l_linenumber", c("shipping.warehouse_name").alias("warehouse_name"),
        c("shipping.buyers_fees").cast("double").alias("buyers_fees"),
    )


# ---------------------------------------------------------------- groups
def group_conditional_count(df: DataFrame) -> DataFrame:
    """Conditional counts per warehouse."""
    return df.groupBy(c("shipping.warehouse_name").alias("warehouse_name")).agg(
        F.count_if(c("state.sold") == F.lit(True)).alias("sold"),
        F.count_if(c("state.reserved") == F.lit(True)).alias("reserved"),
        F.count_if(c("state.available") == F.lit(True)).alias("available"),
        F.count(F.lit(1)).alias("listings"),
    )


def group_collect_set(df: DataFrame) -> DataFrame:
    """Distinct brands per seller, as sorted text. Pairs are made distinct
    before any set is gathered."""
    pairs = df.select(c("seller.id").alias("seller_id"), c("brand.name").alias("brand")).distinct()
    g = pairs.groupBy("seller_id").agg(F.collect_set("brand").alias("s"))
    return g.select(
        "seller_id",
        F.concat_ws(",", F.array_sort("s")).alias("brands"),
        F.size("s").cast("bigint").alias("n_brands"),
    )


def group_argmax(df: DataFrame) -> DataFrame:
    """Per country, the seller with the highest total earnings."""
    g = A.country_seller_aggregates(df)
    top = argmax_per_group(
        g, ["country"], [("_earn", "desc"), ("username", "asc"), ("seller_id", "asc")], ["username", "_earn"]
    )
    return top.select("country", "username", c("_earn").cast("double").alias("total_earnings"))


def group_mode(df: DataFrame) -> DataFrame:
    """Most common color per (season, material), ties to the smallest."""
    return mode_per_group(df, ["season", "material"], "color", "color", "mode_count")


def top_k_types(df: DataFrame) -> DataFrame:
    """Per condition, the two most listed types."""
    g = df.groupBy("condition", c("type").alias("product_type")).agg(F.count(F.lit(1)).alias("count"))
    return top_k_per_group(g, ["condition"], [("count", "desc"), ("product_type", "asc")], 2, "rank")


def rank_countries(df: DataFrame) -> DataFrame:
    """Per warehouse, seller countries numbered by listing count."""
    g = df.groupBy(
        c("shipping.warehouse_name").alias("warehouse_name"), c("seller.country").alias("country")
    ).agg(F.count(F.lit(1)).alias("listings"))
    return rank_per_group(g, ["warehouse_name"], [("listings", "desc"), ("country", "asc")], "rank")


def leave_one_out(df: DataFrame) -> DataFrame:
    """Per season, each material's total price and the mean total of the
    other materials (exact sums, one division)."""
    g = df.groupBy("season", "material").agg(sum0("price_usd").alias("total"))
    loo = leave_one_out_mean(g, ["season"], "total", "others_mean_total")
    return loo.select("season", "material", c("total").cast("double").alias("total_price"), "others_mean_total")


# ---------------------------------------------------------------- joins
def scalar_subquery_filter(df: DataFrame) -> DataFrame:
    """L4: listings liked more than the global mean, counted per condition."""
    liked = above_scalar(df, "like_count", F.sum("like_count"), F.count("like_count"))
    return liked.groupBy("condition").agg(F.count(F.lit(1)).alias("liked_listings"))


def range_join(df: DataFrame) -> DataFrame:
    """Every listing in the J5 price range (no limit)."""
    return A.outfit_range_candidates(df, P.J5_GENDER, P.J5_KINDS, P.J5_COLOR)


def inequality_join_bucketed(df: DataFrame) -> DataFrame:
    """(country, brand) pairs where the brand's mean earning per listing is below the country's."""
    countries = df.groupBy(c("seller.country").alias("country")).agg(
        A.exact_mean(F.sum("seller.earning"), F.count("seller.earning")).alias("country_avg")
    )
    brands = df.groupBy(c("brand.name").alias("brand")).agg(
        A.exact_mean(F.sum("seller.earning"), F.count("seller.earning")).alias("brand_avg")
    )
    return inequality_join(countries, brands, "country_avg", "brand_avg", "<", buckets=8)


def nearest_join(df: DataFrame) -> DataFrame:
    """Per country, the two types with mean fee nearest the country's."""
    cube = A.fee_cube(df)
    countries = A.country_fees(cube)
    types = cube.groupBy("country", "type").agg(F.sum("fs").alias("fs"), F.sum("fn").alias("fn")).select(
        "country", "type", A.exact_mean(c("fs"), c("fn")).alias("type_avg_buyers_fees")
    )
    return nearest_k(
        join_on_keys(types, countries, ["country"]), ["country"], c("type_avg_buyers_fees"),
        c("avg_buyers_fees_country"), 2, ties=[("type", "asc")],
    )


def lookup_top_brands(df: DataFrame) -> DataFrame:
    """For the two sellers with the most products sold of each badge, the three
    brands that they list most, as a correlated lookup per seller."""
    sellers = top_k_per_group(
        A.seller_profiles(df), ["badge"], [("products_sold", "desc"), ("seller_username", "asc"), ("seller_id", "asc")], 2, "seller_rank"
    ).select("badge", "seller_rank", "seller_id", "seller_username")
    brands = df.groupBy(c("seller.id").alias("of"), c("brand.name").alias("brand")).agg(F.count(F.lit(1)).alias("listings"))
    return lookup(sellers, brands, {"seller_id": "of"}, [("listings", "desc"), ("brand", "asc")], 3)


# ---------------------------------------------------------------- arrays
def explode_keywords(df: DataFrame) -> DataFrame:
    """Keyword counts after splitting the keyword text."""
    return A.keyword_rows(df, P.J4_SEPARATOR).groupBy("keyword").agg(F.count(F.lit(1)).alias("count"))


def posexplode_rank(df: DataFrame) -> DataFrame:
    """Words of the name with their 0-based position, counted."""
    ex = df.select(F.posexplode(F.split(c("name"), " ")).alias("pos", "word"))
    return ex.groupBy(c("pos").cast("bigint").alias("pos"), "word").agg(F.count(F.lit(1)).alias("count"))


def array_transform_filter_reduce(df: DataFrame) -> DataFrame:
    """Per distinct name, upper-cased words longer than three
    letters and their total length."""
    g = df.groupBy("name").agg(F.count(F.lit(1)).alias("listings"))
    words = F.filter(F.transform(F.split(c("name"), " "), lambda w: F.upper(w)), lambda w: F.length(w) > 3)
    return g.select(
        "name",
        "listings",
        F.concat_ws(" ", words).alias("long_words"),
        F.aggregate(words, F.lit(0).cast("bigint"), lambda acc, w: acc + F.length(w)).alias("letters"),
    )


# ---------------------------------------------------------------- scalars
def guarded_ratio_query(df: DataFrame) -> DataFrame:
    """Likes per product and likes-to-followers percent with a zero
    guard, per (country, seller)."""
    g = A.country_seller_aggregates(df)
    return g.select(
        "country",
        "seller_id",
        guarded_ratio(c("_likes"), c("_products")).alias("likes_per_product"),
        A.likes_to_followers(c("_likes"), c("_products"), c("_followers")).alias("likes_to_followers_ratio"),
    )


def percent_string(df: DataFrame) -> DataFrame:
    """Sold percent per (season, category), rounded, and as text."""
    g = df.groupBy("season", "category").agg(
        F.count_if(c("state.sold") == F.lit(True)).alias("s"), F.count(F.lit(1)).alias("n")
    )
    g = g.withColumn("_q", scaled_half_even(c("s") * 100, c("n"), 2))
    return g.select(
        "season", "category",
        to_scaled_double(c("_q"), 2).alias("percentage_sold"),
        F.concat(plain_decimal_string(c("_q"), 2), F.lit("%")).alias("percentage_sold_string"),
    )


def round_half_even(df: DataFrame) -> DataFrame:
    """Mean earning per listing per brand, half to even at two places,
    next to the unrounded mean."""
    g = df.groupBy(c("brand.name").alias("brand")).agg(
        F.sum("seller.earning").alias("s"), F.count("seller.earning").alias("n")
    )
    return g.select(
        "brand", ratio_half_even(c("s"), c("n")).alias("mean_earning_rounded"),
        A.exact_mean(c("s"), c("n")).alias("mean_earning"),
    )


def order_statistics(df: DataFrame) -> DataFrame:
    """Exact deciles of the seller earning (sorted index floor(n*q))."""
    fr = [i / 10 for i in range(1, 10)]
    st = exact_order_stats(df, "seller.earning", fr)
    return st.select("fraction", "idx", c("value").cast("double").alias("value"))


def order_statistics_few_values(df: DataFrame) -> DataFrame:
    """A17 on tied values: quartiles of the like count (50 values)."""
    st = exact_order_stats(df, "like_count", A.QUARTILES, accuracy=20, margin=0.02)
    return st.select("fraction", "idx", c("value").cast("double").alias("value"))


def order_statistics_spike(df: DataFrame) -> DataFrame:
    """A17 on a column that is distinct below its median and constant above."""
    spiked = df.select(F.least(c("price_usd"), F.lit(30000).cast("decimal(18,6)")).alias("x"))
    st = exact_order_stats(spiked, "x", A.QUARTILES, accuracy=50, margin=0.02)
    return st.select("fraction", "idx", c("value").cast("double").alias("value"))


# ---------------------------------------------------------------- ingest
def raw_text(df: DataFrame) -> DataFrame:
    """The listing table as the raw CSV text columns it would be read from."""
    s = lambda x: c(x).cast("string")
    return df.select(
        s("id").alias("product_id"), s("type").alias("product_type"), s("name").alias("product_name"),
        F.lit(None).cast("string").alias("product_description"), s("keywords").alias("product_keywords"),
        s("gender_target").alias("product_gender_target"), s("category").alias("product_category"),
        s("season").alias("product_season"), s("condition").alias("product_condition"),
        s("like_count").alias("product_like_count"), s("material").alias("product_material"),
        s("color").alias("product_color"), s("price_usd").alias("price_usd"), s("brand.id").alias("brand_id"),
        s("brand.name").alias("brand_name"), s("state.sold").alias("sold"), s("state.reserved").alias("reserved"),
        s("state.available").alias("available"), s("seller.id").alias("seller_id"),
        s("seller.username").alias("seller_username"), s("seller.country").alias("seller_country"),
        s("seller.price").alias("seller_price"), s("seller.earning").alias("seller_earning"),
        s("seller.products_sold").alias("seller_products_sold"),
        s("seller.num_products_listed").alias("seller_num_products_listed"),
        s("seller.community_rank").alias("seller_community_rank"),
        s("seller.num_followers").alias("seller_num_followers"), s("seller.pass_rate").alias("seller_pass_rate"),
        s("seller.badge").alias("seller_badge"), s("shipping.buyers_fees").alias("buyers_fees"),
        s("shipping.warehouse_name").alias("warehouse_name"),
    )


def ingest_typed_listings(df: DataFrame) -> DataFrame:
    """Type and nest the raw text of every listing."""
    nested = nest_listing(type_listings(raw_text(df)), "full")
    return nested.select(
        "id",
        c("price_usd").cast("double").alias("price_usd"),
        c("like_count").cast("double").alias("like_count"),
        c("state.sold").alias("sold"),
        c("state.reserved").alias("reserved"),
        c("state.available").alias("available"),
        c("seller.id").alias("seller_id"),
        c("seller.country").alias("seller_country"),
        c("seller.num_followers").cast("double").alias("num_followers"),
        c("seller.pass_rate").alias("pass_rate"),
        c("seller.products_sold").alias("products_sold"),
        c("shipping.buyers_fees").cast("double").alias("buyers_fees"),
        c("shipping.warehouse_name").alias("warehouse_name"),
        F.size("rejected_fields").cast("bigint").alias("rejected"),
    )


def _typed_row(nested: DataFrame, *more) -> DataFrame:
    return nested.select(
        "id", c("price_usd").cast("double").alias("price_usd"), c("state.sold").alias("sold"), c("seller.id").alias("seller_id"),
        c("seller.badge").alias("badge"), "material", c("shipping.buyers_fees").cast("double").alias("buyers_fees"),
        c("shipping.warehouse_name").alias("warehouse_name"), *more,
    )


def _scratch(df: DataFrame, name: str) -> str:
    root = checkpoint_root(df.sparkSession, allow_local=True)
    if root is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root}/vitrine/{name}-{uuid.uuid4().hex[:12]}"


def _through_text(df: DataFrame, name: str, write: Callable[[DataFrame, str], None], read: Callable[[str], DataFrame]) -> DataFrame:
    """Every listing written as text by ``write`` and read back by ``read``, for one share
    of the table after the other: what was read is stored and the text deleted, but for
    the last share, which is read by whoever reads the result."""
    spark = df.sparkSession
    *early, last = shares(df, ROWS_AS_TEXT)
    done = _scratch(df, "rows")
    for share in early:
        path = _scratch(df, name)
        write(share, path)
        read(path).write.mode("append").option("compression", "zstd").parquet(done)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    path = _scratch(df, name)
    write(last, path)
    rows = read(path)
    return spark.read.schema(rows.schema).parquet(done).unionByName(rows) if early else rows


def ingest_csv_by_header(df: DataFrame) -> DataFrame:
    """Every listing written as CSV, half of the files with the columns
    in reverse, some prices unreadable; read back by header and typed."""
    raw = raw_text(df).withColumn("price_usd", F.when(F.split_part("product_id", F.lit("-"), F.lit(3)).cast("long") % 97 == 0, F.lit("n/a")).otherwise(c("price_usd")))
    path = _scratch(df, "csv")
    odd = F.pmod(F.xxhash64("product_id"), F.lit(2)) == 1
    raw.where(odd).write.option("header", True).option("escape", '"').csv(f"{path}/forward")
    raw.where(~odd).select(*raw.columns[::-1]).write.option("header", True).option("escape", '"').csv(f"{path}/reverse")
    nested = ingest_listings(df.sparkSession, f"{path}/*", by_header=True)
    return _typed_row(nested, F.size("rejected_fields").cast("bigint").alias("rejected"))


def ingest_csv_multiline(df: DataFrame) -> DataFrame:
    """Every listing written as CSV with line breaks, commas and quotes inside its
    name and description; read back in parallel and typed."""

    def write(share: DataFrame, path: str) -> None:
        raw = raw_text(share).withColumns({
            "product_name": F.replace("product_name", F.lit(" "), F.lit("\n")),
            "product_description": F.concat(F.lit('says "'), "product_type", F.lit('",\n\nand ends')),
        })
        raw.write.option("header", True).option("escape", '"').csv(path)

    def read(path: str) -> DataFrame:
        nested = ingest_listings(df.sparkSession, path, multiline=True)
        return _typed_row(nested, "name", "description", F.size("rejected_fields").cast("bigint").alias("rejected"))

    return _through_text(df, "csv", write, read)


def ingest_quarantine(df: DataFrame) -> DataFrame:
    """Listings with unreadable prices and follower counts, written once; the rejected
    values come back from the quarantine next to the count that the write observed."""
    number = F.split_part("product_id", F.lit("-"), F.lit(3)).cast("long")
    raw = raw_text(df).withColumns({
        "price_usd": F.when(number % 97 == 0, F.concat(F.lit("EUR "), "price_usd")).otherwise(c("price_usd")),
        "seller_num_followers": F.when(number % 31 == 0, F.lit("many")).when(number % 29 == 0, F.lit("NaN")).otherwise(c("seller_num_followers")),
        "seller_products_sold": F.when(number % 29 == 0, F.lit("NaN")).otherwise(c("seller_products_sold")),
    })
    docs = nest_listing(type_listings(raw, keep_raw=True), "full")
    path = _scratch(df, "quarantine")
    report = write_listings_with_quarantine(docs, path)
    counted = F.create_map(*(F.lit(x) for pair in report.rejects.items() for x in pair)) if report.rejects else F.lit(None).cast("map<string,int>")
    return quarantine(df.sparkSession, path, docs.schema).select("id", "field", "raw", counted[F.col("field")].cast("bigint").alias("counted"))


def ingest_missing_columns(df: DataFrame) -> DataFrame:
    """The optional columns left out are null."""
    raw = raw_text(df).drop("sold", "reserved", "available", "product_type")
    nested = nest_listing(type_listings(raw), "full")
    return nested.select("id", "type", c("state.sold").alias("sold"), c("state.available").alias("available"), "season")


def json_round_trip(df: DataFrame) -> DataFrame:
    """Typed documents written as packed JSON Lines and read back."""

    def write(share: DataFrame, path: str) -> None:
        write_listings_json(nest_listing(type_listings(raw_text(share)), "full").drop("rejected_fields"), path, compression="gzip")

    return _through_text(df, "json", write, lambda path: _typed_row(read_listings_json(df.sparkSession, path)))


def _view(name: str):
    def run(df: DataFrame) -> DataFrame:
        nested = nest_listing(type_listings(raw_text(df)), name)
        flat = []
        for f in nested.schema.fields:
            if f.dataType.typeName() == "struct":
                flat += [c(f"{f.name}.{x.name}").cast(_plain(x.dataType)).alias(f"{f.name}_{x.name}") for x in f.dataType.fields]
            else:
                flat.append(c(f.name).cast(_plain(f.dataType)).alias(f.name))
        return nested.select(*flat)

    run.__doc__ = f"S3-S5: the {name} view of every listing, flattened."
    return run


def _plain(kind) -> str:
    return "double" if kind.typeName() == "decimal" else kind.simpleString()


# ---------------------------------------------------------------- nested results
def seller_brand_lists(df: DataFrame) -> DataFrame:
    """The winner's brands as one ordered list, unwound with positions."""
    n = N.top_seller_brands_nested(df, category=P.T1_CATEGORY, badge=P.T1_BADGE)
    x = n.select(c("seller.username").alias("username"), F.posexplode("seller.brands").alias("pos", "b"))
    return x.select("username", c("pos").cast("bigint").alias("pos"), c("b.brand").alias("brand"), c("b.total_sold").alias("total_sold"))


def country_ranking_lists(df: DataFrame) -> DataFrame:
    """Each country's sellers as lists of at most two, unwound with positions."""
    n = N.country_seller_ranking_nested(df, chunk_rows=2)
    x = n.select("country", "chunk", F.posexplode("rank_by_earnings").alias("pos", "s"))
    return x.select("country", "chunk", c("pos").cast("bigint").alias("pos"), c("s.username").alias("username"), c("s.rank").alias("rank"))


def type_color_lists(df: DataFrame) -> DataFrame:
    """Conditions with lists of types with lists of colors, unwound with positions."""
    n = N.top_types_and_colors_nested(df)
    x = n.select("condition", F.posexplode("product_types").alias("type_pos", "t"))
    x = x.select("condition", "type_pos", c("t.product_type").alias("product_type"), F.posexplode("t.top_colors").alias("color_pos", "k"))
    return x.select(
        "condition", c("type_pos").cast("bigint").alias("type_pos"), "product_type", c("color_pos").cast("bigint").alias("color_pos"),
        c("k.color").alias("color"), c("k.color_count").alias("color_count"),
    )


def material_lists(df: DataFrame) -> DataFrame:
    """Each season's materials of M2 as a list, unwound with positions."""
    x = N.season_material_leave_one_out_nested(df).select("season", F.posexplode("materials").alias("pos", "m"))
    return x.select(
        "season", c("pos").cast("bigint").alias("pos"), c("m.material").alias("material"), c("m.count").alias("count"),
        c("m.avg_price_usd").alias("avg_price_usd"), c("m.avg_of_other").alias("avg_of_other"), c("m.difference").alias("difference"),
    )


def warehouse_country_lists(df: DataFrame) -> DataFrame:
    """M4's warehouses with lists of cheaper countries with lists of types, unwound with positions."""
    n = N.warehouse_fee_comparison_nested(df)
    x = n.select("warehouse_name", "total_sold", "avg_buyers_fees", "chunk", F.posexplode("countries_less_buyers_fees").alias("country_pos", "k"))
    x = x.select("*", F.posexplode("k.nearest_product_types").alias("type_pos", "t"))
    return x.select(
        "warehouse_name", "total_sold", "avg_buyers_fees", "chunk", c("country_pos").cast("bigint").alias("country_pos"), c("k.country").alias("country"),
        c("k.avg_buyers_fees_country").alias("avg_buyers_fees_country"), c("type_pos").cast("bigint").alias("type_pos"), c("t.type").alias("type"),
        c("t.type_avg_buyers_fees").alias("type_avg_buyers_fees"), c("t.diff").alias("diff"),
    )


def badge_seller_lists(df: DataFrame) -> DataFrame:
    """T3's badges, each with its earnings and the list of its top sellers, unwound with positions."""
    x = N.badge_report_nested(df).select("badge", "min_earnings", "max_earnings", "avg_earnings", "count", F.posexplode("top_sellers").alias("pos", "s"))
    return x.select("badge", "min_earnings", "max_earnings", "avg_earnings", "count", c("pos").cast("bigint").alias("pos"), c("s.seller_username").alias("seller_username"), c("s.products_sold").alias("products_sold"))


def material_seller_lists(df: DataFrame) -> DataFrame:
    """T5's materials, each with the list of its cheapest sellers, unwound with positions."""
    n = N.cheapest_sellers_by_material_nested(df, countries=P.T5_COUNTRIES, min_pass_rate=P.T5_MIN_PASS_RATE)
    x = n.select("material", F.posexplode("top_sellers").alias("pos", "s"))
    return x.select("material", c("pos").cast("bigint").alias("pos"), c("s.seller").alias("seller"), c("s.avg_price").alias("avg_price"), c("s.pass_rate").alias("pass_rate"), c("s.seller_country").alias("seller_country"))


def array_access(df: DataFrame) -> DataFrame:
    """E10, E11, E16-E18 on the words of each name: slice, element (null past
    the end), distinct, position, and the largest, sum and mean of the lengths."""
    g = df.groupBy("name").agg(F.count(F.lit(1)).alias("listings"))
    words = F.split("name", " ")
    lengths = F.transform(words, lambda w: F.length(w))
    total = F.aggregate(lengths, F.lit(0), lambda a, x: a + x)
    return g.select(
        "name",
        F.array_join(F.slice(words, 1, 1), " ").alias("first_slice"),
        F.try_element_at(words, F.lit(2)).alias("second"),
        F.try_element_at(words, F.lit(9)).alias("ninth"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(words, words))), ",").alias("distinct_words"),
        F.array_position(words, F.try_element_at(words, F.lit(2))).cast("bigint").alias("position"),
        F.array_max(lengths).cast("bigint").alias("longest"),
        total.cast("bigint").alias("letters"),
        (total.cast("double") / F.size(words).cast("double")).alias("mean_letters"),
    )


_OPS = {
    "ingest_csv_by_header": ingest_csv_by_header,
    "ingest_csv_multiline": ingest_csv_multiline,
    "ingest_quarantine": ingest_quarantine,
    "ingest_missing_columns": ingest_missing_columns,
    "json_round_trip": json_round_trip,
    "view_fulfilment": _view("fulfilment"),
    "view_catalogue": _view("catalogue"),
    "view_seller": _view("seller"),
    "seller_brand_lists": seller_brand_lists,
    "country_ranking_lists": country_ranking_lists,
    "type_color_lists": type_color_lists,
    "material_lists": material_lists,
    "warehouse_country_lists": warehouse_country_lists,
    "badge_seller_lists": badge_seller_lists,
    "material_seller_lists": material_seller_lists,
    "array_access": array_access,
    "order_statistics_few_values": order_statistics_few_values,
    "order_statistics_spike": order_statistics_spike,
    "filter_or_range": filter_or_range,
    "filter_regex_ci": filter_regex_ci,
    "filter_not_null": filter_not_null,
    "group_conditional_count": group_conditional_count,
    "group_collect_set": group_collect_set,
    "group_argmax": group_argmax,
    "group_mode": group_mode,
    "top_k_per_group": top_k_types,
    "rank_per_group": rank_countries,
    "leave_one_out": leave_one_out,
    "scalar_subquery_filter": scalar_subquery_filter,
    "range_join": range_join,
    "inequality_join": inequality_join_bucketed,
    "nearest_join": nearest_join,
    "lookup_top_brands": lookup_top_brands,
    "explode_keywords": explode_keywords,
    "posexplode_rank": posexplode_rank,
    "array_transform_filter_reduce": array_transform_filter_reduce,
    "guarded_ratio": guarded_ratio_query,
    "percent_string": percent_string,
    "round_half_even": round_half_even,
    "order_statistics": order_statistics,
    "ingest_typed_listings": ingest_typed_listings,
}


def operator_queries() -> dict:
    return {name: _on_listings(fn) for name, fn in _OPS.items()}


# ---------------------------------------------------------------- oracle SQL
_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_TYPED = (
    f"{_ID} AS id, CAST(price_usd AS DOUBLE) AS price_usd, sold, seller_id, badge, material, "
    "CAST(buyers_fees AS DOUBLE) AS buyers_fees, warehouse_name"
)
_VIEW_SQL = {
    "fulfilment": f"{_ID} AS id, type, name, brand_name AS brand_id, brand_name, season, condition, material, color, "
    "CAST(price_usd AS DOUBLE) AS price_usd, sold AS state_sold, reserved AS state_reserved, available AS state_available, "
    "CAST(earning AS DOUBLE) AS seller_earning, seller_id, country AS seller_country, "
    "CAST(buyers_fees AS DOUBLE) AS shipping_buyers_fees, warehouse_name AS shipping_warehouse_name",
    "catalogue": f"{_ID} AS id, type, name, CAST(NULL AS VARCHAR) AS description, keywords, gender_target, category, season, condition, "
    "CAST(like_count AS DOUBLE) AS like_count, material, color, CAST(price_usd AS DOUBLE) AS price_usd, sold AS state_sold, "
    "reserved AS state_reserved, seller_id, username AS seller_username, CAST(num_followers AS DOUBLE) AS seller_num_followers",
    "seller": f"{_ID} AS id, brand_name AS brand_id, brand_name, category, condition, CAST(like_count AS DOUBLE) AS like_count, material, "
    "CAST(price_usd AS DOUBLE) AS price_usd, sold AS state_sold, reserved AS state_reserved, CAST(seller_price AS DOUBLE) AS seller_price, "
    "CAST(earning AS DOUBLE) AS seller_earning, seller_id, username AS seller_username, country AS seller_country, "
    "products_sold AS seller_products_sold, num_products_listed AS seller_num_products_listed, CAST(NULL AS DOUBLE) AS seller_community_rank, "
    "CAST(num_followers AS DOUBLE) AS seller_num_followers, pass_rate AS seller_pass_rate, badge AS seller_badge",
}


def operator_sql() -> dict[str, str]:
    w = O._with
    lit = O._lit
    mean = O.mean
    nse = O.nse
    sql = {
        "filter_or_range": w() + (
            "SELECT l_orderkey, l_linenumber, brand_name AS brand, seller_id, CAST(price_usd AS DOUBLE) AS price_usd "
            f"FROM p WHERE price_usd <= {P.T2_MAX_PRICE} AND (num_products_listed >= {P.T2_MIN_LISTED} "
            f"OR products_sold >= {P.T2_MIN_SOLD})"
        ),
        "filter_regex_ci": w() + (
            "SELECT l_orderkey, l_linenumber, name, gender_target, CAST(price_usd AS DOUBLE) AS price_usd FROM p "
            f"WHERE gender_target = {lit(P.J1_GENDER)} AND regexp_matches(name, {O._ci(P.J1_PATTERN)})"
        ),
        "filter_not_null": w() + (
            "SELECT l_orderkey, l_linenumber, warehouse_name, CAST(buyers_fees AS DOUBLE) AS buyers_fees FROM p "
            "WHERE buyers_fees IS NOT NULL AND price_usd IS NOT NULL"
        ),
        "group_conditional_count": w() + (
            "SELECT warehouse_name, CAST(count_if(sold) AS BIGINT) AS sold, CAST(count_if(reserved) AS BIGINT) AS reserved, "
            "CAST(count_if(available) AS BIGINT) AS available, count(*) AS listings FROM p GROUP BY warehouse_name"
        ),
        "group_collect_set": w() + (
            "SELECT seller_id, string_agg(DISTINCT brand_name, ',' ORDER BY brand_name) AS brands, "
            "count(DISTINCT brand_name) AS n_brands FROM p GROUP BY seller_id"
        ),
        "group_argmax": w(
            """g AS (SELECT country, seller_id, min(username) AS username, coalesce(sum(earning), 0) AS earn
      FROM p GROUP BY country, seller_id)"""
        ) + (
            "SELECT country, username, CAST(earn AS DOUBLE) AS total_earnings FROM (SELECT *, row_number() OVER "
            "(PARTITION BY country ORDER BY earn DESC NULLS LAST, username ASC NULLS FIRST, seller_id ASC NULLS FIRST) AS rn "
            "FROM g) WHERE rn = 1"
        ),
        "group_mode": w(
            "g AS (SELECT season, material, color, count(*) AS n FROM p GROUP BY season, material, color)"
        ) + (
            "SELECT season, material, color, n AS mode_count FROM (SELECT *, row_number() OVER (PARTITION BY season, "
            "material ORDER BY n DESC, color ASC NULLS FIRST) AS rn FROM g) WHERE rn = 1"
        ),
        "top_k_per_group": w(
            "g AS (SELECT condition, type AS product_type, count(*) AS count FROM p GROUP BY condition, type)"
        ) + (
            "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY condition ORDER BY count DESC, "
            "product_type ASC NULLS FIRST) AS BIGINT) AS rank FROM g) WHERE rank <= 2"
        ),
        "rank_per_group": w(
            "g AS (SELECT warehouse_name, country, count(*) AS listings FROM p GROUP BY warehouse_name, country)"
        ) + (
            "SELECT *, CAST(row_number() OVER (PARTITION BY warehouse_name ORDER BY listings DESC, "
            "country ASC NULLS FIRST) AS BIGINT) AS rank FROM g"
        ),
        "leave_one_out": w(
            "g AS (SELECT season, material, coalesce(sum(price_usd), 0) AS total FROM p GROUP BY season, material)"
        ) + (
            "SELECT season, material, CAST(total AS DOUBLE) AS total_price, CASE WHEN count(total) OVER w > 1 THEN "
            "CAST(sum(total) OVER w - total AS DOUBLE) / CAST(count(total) OVER w - 1 AS DOUBLE) END AS others_mean_total "
            "FROM g WINDOW w AS (PARTITION BY season)"
        ),
        "scalar_subquery_filter": w(
            "st AS (SELECT sum(like_count) AS s, count(like_count) AS n FROM p)"
        ) + (
            "SELECT condition, count(*) AS liked_listings FROM p, st WHERE p.like_count * st.n > st.s GROUP BY condition"
        ),
        "range_join": O.j5_range(None),
        "inequality_join": w(
            f"co AS (SELECT country, {mean('sum(earning)', 'count(earning)')} AS country_avg FROM p GROUP BY country)",
            f"br AS (SELECT brand_name AS brand, {mean('sum(earning)', 'count(earning)')} AS brand_avg FROM p GROUP BY brand_name)",
        ) + "SELECT co.country, co.country_avg, br.brand, br.brand_avg FROM co JOIN br ON br.brand_avg < co.country_avg",
        "lookup_top_brands": w(
            """pr AS (SELECT seller_id, min(username) AS seller_username, max(products_sold) AS products_sold, min(badge) AS badge FROM p GROUP BY seller_id)""",
            """tp AS (SELECT *, row_number() OVER (PARTITION BY badge ORDER BY products_sold DESC NULLS LAST, seller_username ASC NULLS FIRST,
      seller_id ASC NULLS FIRST) AS seller_rank FROM pr)""",
            """br AS (SELECT seller_id, brand_name AS brand, count(*) AS listings, row_number() OVER (PARTITION BY seller_id ORDER BY count(*) DESC,
      brand_name ASC NULLS FIRST) AS rn FROM p GROUP BY seller_id, brand_name)""",
        ) + (
            "SELECT badge, CAST(seller_rank AS BIGINT) AS seller_rank, tp.seller_id, seller_username, brand, listings FROM tp LEFT JOIN br "
            "ON br.seller_id IS NOT DISTINCT FROM tp.seller_id AND rn <= 3 WHERE seller_rank <= 2"
        ),
        "nearest_join": w(*O._M4) + (
            "SELECT ty.country, ty.type, ty.type_avg_buyers_fees, co.avg_buyers_fees_country, "
            "abs(ty.type_avg_buyers_fees - co.avg_buyers_fees_country) AS diff, CAST(nr.rn AS BIGINT) AS nearest_rank "
            f"FROM nr JOIN ty ON {nse('nr', 'ty', ['country', 'type'])} JOIN co ON {nse('ty', 'co', ['country'])} "
            "WHERE nr.rn <= 2"
        ),
        "explode_keywords": w() + (
            "SELECT keyword, count(*) AS count FROM (SELECT unnest(string_split(keywords, "
            f"{lit(P.J4_SEPARATOR)})) AS keyword FROM p) WHERE keyword <> '' GROUP BY keyword"
        ),
        "posexplode_rank": w() + (
            "SELECT CAST(pos AS BIGINT) AS pos, word, count(*) AS count FROM (SELECT unnest(string_split(name, ' ')) AS word, "
            "unnest(range(len(string_split(name, ' ')))) AS pos FROM p) GROUP BY pos, word"
        ),
        "array_transform_filter_reduce": w(
            "g AS (SELECT name, count(*) AS listings FROM p GROUP BY name)",
            """h AS (SELECT name, listings, list_filter(list_transform(string_split(name, ' '), lambda x: upper(x)),
      lambda x: length(x) > 3) AS ws FROM g)""",
        ) + (
            "SELECT name, listings, array_to_string(ws, ' ') AS long_words, "
            "CAST(list_reduce(list_prepend(0, list_transform(ws, lambda x: length(x))), lambda a, b: a + b) AS BIGINT) "
            "AS letters FROM h"
        ),
        "guarded_ratio": w(
            """g AS (SELECT country, seller_id, coalesce(sum(like_count), 0) AS likes, min(num_followers) AS followers,
      count(*) AS products FROM p GROUP BY country, seller_id)"""
        ) + (
            "SELECT country, seller_id, CASE WHEN products = 0 THEN 0.0 ELSE CAST(likes AS DOUBLE) / CAST(products AS DOUBLE) END "
            "AS likes_per_product, CASE WHEN followers = 0 THEN 0.0 ELSE CAST(likes AS DOUBLE) / CAST(products AS DOUBLE) / "
            "CAST(followers AS DOUBLE) * 100.0 END AS likes_to_followers_ratio FROM g"
        ),
        "percent_string": w(
            f"""g AS (SELECT season, category, {O.half_even_units('count_if(sold) * 100', 'count(*)')} AS q FROM p
      GROUP BY season, category)"""
        ) + (
            f"SELECT season, category, CAST(q AS DOUBLE) / 100.0 AS percentage_sold, {O.units_text('q')} || '%' "
            "AS percentage_sold_string FROM g"
        ),
        "round_half_even": w(
            "g AS (SELECT brand_name AS brand, sum(earning) AS s, count(earning) AS n FROM p GROUP BY brand_name)"
        ) + f"SELECT brand, {O.half_even('s', 'n')} AS mean_earning_rounded, {mean('s', 'n')} AS mean_earning FROM g",
        "order_statistics": w(
            "v AS (SELECT earning FROM p WHERE earning IS NOT NULL)",
            "nn AS (SELECT count(*) AS n FROM v)",
            "rk AS (SELECT earning, row_number() OVER (ORDER BY earning) - 1 AS idx FROM v)",
            "fr AS (SELECT CAST(i AS DOUBLE) / 10 AS fraction FROM range(1, 10) t(i))",
        ) + (
            "SELECT fr.fraction, CAST(rk.idx AS BIGINT) AS idx, CAST(rk.earning AS DOUBLE) AS value "
            "FROM fr, nn, rk WHERE rk.idx = CAST(floor(nn.n * fr.fraction) AS BIGINT)"
        ),
        "ingest_typed_listings": w() + (
            "SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, CAST(price_usd AS DOUBLE) AS price_usd, "
            "CAST(like_count AS DOUBLE) AS like_count, sold, reserved, available, CAST(seller_id AS VARCHAR) AS seller_id, "
            "country AS seller_country, CAST(num_followers AS DOUBLE) AS num_followers, pass_rate, products_sold, "
            "CAST(buyers_fees AS DOUBLE) AS buyers_fees, warehouse_name, CAST(0 AS BIGINT) AS rejected FROM p"
        ),
    }
    sql["ingest_csv_by_header"] = w() + (
        f"SELECT {_TYPED.replace('CAST(price_usd AS DOUBLE)', 'CASE WHEN l_partkey % 97 <> 0 THEN CAST(price_usd AS DOUBLE) END')}, "
        "CAST(l_partkey % 97 = 0 AS BIGINT) AS rejected FROM p"
    )
    sql["ingest_csv_multiline"] = w() + (
        f"SELECT {_TYPED}, replace(name, ' ', chr(10)) AS name, 'says \"' || type || '\",' || chr(10) || chr(10) || 'and ends' AS description, "
        "CAST(0 AS BIGINT) AS rejected FROM p"
    )
    sql["ingest_quarantine"] = w(
        f"bad AS (SELECT {_ID} AS id, 'price_usd' AS field, 'EUR ' || CAST(price_usd AS VARCHAR) AS raw FROM p WHERE l_partkey % 97 = 0 AND price_usd IS NOT NULL "
        f"UNION ALL SELECT {_ID}, 'seller_num_followers', 'many' FROM p WHERE l_partkey % 31 = 0)"
    ) + "SELECT id, field, raw, count(*) OVER (PARTITION BY field) AS counted FROM bad"
    sql["ingest_missing_columns"] = w() + (
        f"SELECT {_ID} AS id, CAST(NULL AS VARCHAR) AS type, CAST(NULL AS BOOLEAN) AS sold, CAST(NULL AS BOOLEAN) AS available, season FROM p"
    )
    sql["json_round_trip"] = w() + f"SELECT {_TYPED} FROM p"
    for name, columns in _VIEW_SQL.items():
        sql[f"view_{name}"] = w() + f"SELECT {columns} FROM p"
    sql["seller_brand_lists"] = (
        "SELECT username, row_number() OVER (ORDER BY total_sold DESC, brand ASC NULLS FIRST) - 1 AS pos, brand, total_sold "
        f"FROM ({O.t1()})"
    )
    sql["country_ranking_lists"] = (
        f"SELECT country, (rank - 1) // 2 AS chunk, (rank - 1) % 2 AS pos, username, rank FROM ({O.t4()})"
    )
    sql["type_color_lists"] = (
        "SELECT condition, dense_rank() OVER (PARTITION BY condition ORDER BY count DESC, product_type ASC NULLS FIRST) - 1 AS type_pos, "
        "product_type, row_number() OVER (PARTITION BY condition, product_type ORDER BY color_count DESC, color ASC NULLS FIRST) - 1 "
        f"AS color_pos, color, color_count FROM ({O.m1()})"
    )
    sql["material_lists"] = (
        "SELECT season, row_number() OVER (PARTITION BY season ORDER BY count DESC, material ASC NULLS FIRST) - 1 AS pos, material, count, "
        f"avg_price_usd, avg_of_other, difference FROM ({O.m2()})"
    )
    sql["warehouse_country_lists"] = (
        "SELECT warehouse_name, total_sold, avg_buyers_fees, CAST(0 AS BIGINT) AS chunk, dense_rank() OVER (PARTITION BY warehouse_name ORDER BY country ASC "
        "NULLS FIRST) - 1 AS country_pos, country, avg_buyers_fees_country, row_number() OVER (PARTITION BY warehouse_name, country ORDER BY diff, "
        f"type ASC NULLS FIRST) - 1 AS type_pos, type, type_avg_buyers_fees, diff FROM ({O.m4_nearest()})"
    )
    sql["badge_seller_lists"] = (
        "SELECT badge, min_earnings, max_earnings, avg_earnings, count, CAST(seller_rank - 1 AS BIGINT) AS pos, seller_username, products_sold "
        f"FROM ({O.t3_report()})"
    )
    sql["material_seller_lists"] = f"SELECT material, CAST(rank - 1 AS BIGINT) AS pos, seller, avg_price, pass_rate, seller_country FROM ({O.t5()})"
    sql["array_access"] = w(
        "g AS (SELECT DISTINCT name, string_split(name, ' ') AS ws FROM p)",
        "h AS (SELECT *, list_transform(ws, lambda x: length(x)) AS ls FROM g)",
    ) + (
        "SELECT name, ws[1] AS first_slice, ws[2] AS second, ws[9] AS ninth, array_to_string(list_sort(list_distinct(ws)), ',') AS distinct_words, "
        "CAST(list_position(ws, ws[2]) AS BIGINT) AS position, CAST(list_max(ls) AS BIGINT) AS longest, CAST(list_sum(ls) AS BIGINT) AS letters, "
        "CAST(list_sum(ls) AS DOUBLE) / CAST(len(ws) AS DOUBLE) AS mean_letters FROM h"
    )
    for name, column in (("few_values", "like_count"), ("spike", "least(price_usd, 30000)")):
        sql[f"order_statistics_{name}"] = w(
            f"v AS (SELECT {column} AS x FROM p)",
            "rk AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS idx FROM v WHERE x IS NOT NULL)",
            "nn AS (SELECT count(x) AS n FROM v)",
        ) + (
            "SELECT CAST(q AS DOUBLE) AS fraction, CAST(rk.idx AS BIGINT) AS idx, CAST(rk.x AS DOUBLE) AS value "
            "FROM (VALUES (0.25), (0.5), (0.75)) f(q), nn, rk WHERE rk.idx = CAST(floor(nn.n * q) AS BIGINT)"
        )
    return sql
