"""The fifteen listing analyses as DataFrame plans (flat results).

Every function takes the listing table (nested: ``brand.name``,
``seller.country``, ``shipping.buyers_fees`` ...) and returns a DataFrame. Those
that need a first answer to go on (T1's winner, J4's mean, J5's bounds, M5's cut
points) or a stored order (T4, M4) run jobs when they are called. Defaults are the reference's own literals; the registry in
``__spark_entry__`` passes the values that fit the driver tables.

Plan shape common to them: a scan with pruned nested columns and pushed
filters (one per analysis, two where a second pass needs the first's answer),
a partial (map-side) aggregate on the finest grouping the analysis needs, then
every further step (re-aggregation, windows, joins of aggregates) on that
small result. Raw rows never meet a window and are never collected.

Determinism: the reference leaves ties to storage order. Here every ordering
ends in columns that make it total, so results do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions import (
    exact_mean,
    match_ci,
    plain_decimal_string,
    ratio_half_even,
    scaled_half_even,
    sum0,
    to_scaled_double,
)
from vitrine.operators import (
    above_scalar,
    argmax_expr,
    band_expr,
    cut_values,
    join_on_keys,
    leave_one_out_in_list,
    nearest_k,
    one_row,
    order_stats,
    pairs_below,
    place_by_value,
    rank_per_group,
    reuse,
    top_k_per_group,
)

c = F.col

# The reference's literal parameters, used as defaults.
REF_T1_CATEGORY = "Women Clothing"
REF_T1_BADGE = "Expert"
REF_T2_MAX_PRICE = 1000
REF_T2_MIN_LISTED = 50
REF_T2_MIN_SOLD = 25
REF_T5_COUNTRIES = ("Australia", "United Kingdom", "United States")
REF_T5_MIN_PASS_RATE = 85
REF_J1_GENDER = "Women"
REF_J1_PATTERN = "jeans"
REF_J5_GENDER = "Women"
REF_J5_KINDS = ("dress", "shoes")
REF_J5_LABELS = ("Dress", "Shoes")
REF_J5_COLOR = "Black"
QUARTILES = (0.25, 0.5, 0.75)
BAND_LABELS = ("min_q1", "q1_median", "median_q3", "q3_max")


def _money(x: Column) -> Column:
    """A decimal money value as the double the reference reports, rounded
    half to even at two places on the exact decimal."""
    return F.bround(x, 2).cast("double")


# --------------------------------------------------------------------- T1
def top_seller_brands(
    df: DataFrame, category: str = REF_T1_CATEGORY, badge: str = REF_T1_BADGE, k: int = 5
) -> DataFrame:
    """Most-followed seller in one category and badge, and that seller's
    ``k`` most listed brands over all categories.

    The winner is one row of an aggregate; as a literal its id reaches the
    Parquet scan of the second pass. A null seller id is a seller like any
    other (null equals null, D12).
    """
    sellers = (
        df.where((c("category") == category) & (c("seller.badge") == badge))
        .groupBy(c("seller.id").alias("seller_id"))
        .agg(
            F.min("seller.username").alias("username"),
            F.max("seller.num_followers").cast("double").alias("num_followers"),
        )
    )
    top = sellers.orderBy(
        c("num_followers").desc_nulls_last(), c("username").asc_nulls_first(), c("seller_id").asc_nulls_first()
    ).take(1)
    kinds = sellers.schema
    won = top[0].asDict() if top else dict.fromkeys(sellers.columns)
    winner = {k: F.lit(won[k]).cast(kinds[k].dataType) for k in won}
    of_winner = c("seller.id").isNull() if won["seller_id"] is None else c("seller.id") == winner["seller_id"]
    brands = (
        df.where(of_winner if top else F.lit(False))
        .groupBy(c("brand.name").alias("brand"))
        .agg(F.count(F.lit(1)).alias("total_sold"))
    )
    return brands.orderBy(c("total_sold").desc(), c("brand").asc_nulls_first()).limit(k).select(
        winner["username"].alias("username"), winner["num_followers"].alias("num_followers"), "brand", "total_sold"
    )


# --------------------------------------------------------------------- T2
def brand_avg_seller_earnings(
    df: DataFrame,
    max_price: float = REF_T2_MAX_PRICE,
    min_listed: int = REF_T2_MIN_LISTED,
    min_sold: int = REF_T2_MIN_SOLD,
    k: int = 10,
) -> DataFrame:
    """Mean of per-seller earnings per brand, affordable listings from
    active sellers, top ``k`` by the rounded mean."""
    f = df.where(
        (c("price_usd") <= F.lit(max_price))
        & ((c("seller.num_products_listed") >= min_listed) | (c("seller.products_sold") >= min_sold))
    )
    per_seller = f.groupBy(c("brand.name").alias("brand"), c("seller.id").alias("seller_id")).agg(
        sum0("seller.earning").alias("total")
    )
    per_brand = per_seller.groupBy("brand").agg(F.sum("total").alias("s"), F.count("total").alias("n"))
    out = per_brand.select("brand", ratio_half_even(c("s"), c("n")).alias("average_earnings"))
    return out.orderBy(c("average_earnings").desc_nulls_last(), c("brand").asc_nulls_first()).limit(k)


# --------------------------------------------------------------------- T3
def seller_profiles(df: DataFrame) -> DataFrame:
    """One row per seller: username, most products sold, badge.

    The reference takes an arbitrary first username and badge; the smallest
    is used here so the answer is stable."""
    return df.groupBy(c("seller.id").alias("seller_id")).agg(
        F.min("seller.username").alias("seller_username"),
        F.max("seller.products_sold").alias("products_sold"),
        F.min("seller.badge").alias("badge"),
    )


def badge_grains(df: DataFrame) -> DataFrame:
    """The two grains of T3 from one scan: rows per seller (``_badge_row`` false, ``badge``
    is the one the seller carries) and rows per listing badge (true).

    The raw rows are hash-aggregated at (seller, badge, username), where every buffer
    has a fixed width; grouping sets then roll that up to both grains at once, about a
    row per seller in and out, so nothing is stored and nothing is scanned twice.
    """
    fine = df.groupBy(c("seller.id").alias("seller_id"), c("seller.badge").alias("badge"), c("seller.username").alias("seller_username")).agg(
        F.max("seller.products_sold").alias("products_sold"),
        F.min("seller.earning").alias("mn"),
        F.max("seller.earning").alias("mx"),
        F.sum("seller.earning").alias("s"),
        F.count("seller.earning").alias("n"),
        F.count(F.lit(1)).alias("cnt"),
    )
    sets = fine.withColumn("_carried", c("badge")).groupingSets([["seller_id"], ["badge"]], "seller_id", "badge")
    grains = sets.agg(
        F.grouping("seller_id").alias("_g"),
        F.min("_carried").alias("_carried"),
        F.min("seller_username").alias("seller_username"),
        F.max("products_sold").alias("products_sold"),
        F.min("mn").alias("mn"),
        F.max("mx").alias("mx"),
        F.sum("s").alias("s"),
        F.sum("n").alias("n"),
        F.sum("cnt").alias("cnt"),
    )
    per_badge = c("_g") == 1
    key = F.when(per_badge, c("badge")).otherwise(c("_carried"))
    return grains.withColumns({"_badge_row": per_badge, "badge": key}).drop("_g", "_carried")


def _top_sellers(profiles: DataFrame, k: int) -> DataFrame:
    top = top_k_per_group(
        profiles,
        ["badge"],
        [("products_sold", "desc"), ("seller_username", "asc"), ("seller_id", "asc")],
        k,
        "seller_rank",
    )
    return top.select("badge", "seller_rank", "seller_username", "products_sold")


def badge_top_sellers(df: DataFrame, k: int = 3) -> DataFrame:
    """T3 (part 1): per badge, the ``k`` sellers with the most products sold."""
    return _top_sellers(seller_profiles(df), k)


def badge_earnings(df: DataFrame) -> DataFrame:
    """T3 (part 2): per listing badge, min/max/mean earning and listing count,
    for the badges that some seller carries. One scan (``badge_grains``)."""
    return badge_report(df, 1).select("badge", "min_earnings", "max_earnings", "avg_earnings", "count")


def badge_report(df: DataFrame, k: int = 3) -> DataFrame:
    """T3 combined: earnings of each badge next to its top ``k`` sellers, from one scan
    (``badge_grains``) and without a join: a badge's own row comes before its sellers in
    the ranking, of which each task sends the first ``k + 1``, and then hands them its
    earnings. A badge that no seller carries has no seller row, and drops out."""
    order = [(c("_badge_row").cast("int"), "desc"), ("products_sold", "desc"), ("seller_username", "asc"), ("seller_id", "asc")]
    top = top_k_per_group(badge_grains(df), ["badge"], order, k + 1, "_r")
    of_badge = Window.partitionBy("badge")
    own = {x: F.max(F.when(c("_badge_row"), c(x))).over(of_badge) for x in ("mn", "mx", "s", "n", "cnt")}
    return top.withColumns(own).where(~c("_badge_row")).select(
        "badge",
        _money(c("mn")).alias("min_earnings"),
        _money(c("mx")).alias("max_earnings"),
        ratio_half_even(c("s"), c("n")).alias("avg_earnings"),
        c("cnt").cast("bigint").alias("count"),
        (c("_r") - 1).alias("seller_rank"),
        "seller_username",
        "products_sold",
    )


# --------------------------------------------------------------------- T4
def country_seller_aggregates(df: DataFrame) -> DataFrame:
    return df.groupBy(c("seller.country").alias("country"), c("seller.id").alias("seller_id")).agg(
        F.min("seller.username").alias("username"),
        sum0("seller.earning").alias("_earn"),
        sum0("like_count").alias("_likes"),
        F.min("seller.num_followers").alias("_followers"),
        F.count(F.lit(1)).alias("_products"),
    )


def likes_per_product(likes: Column, products: Column) -> Column:
    return likes.cast("double") / products.cast("double")


def likes_to_followers(likes: Column, products: Column, followers: Column) -> Column:
    """Percent of followers, 0 for a seller with no followers, null if unknown."""
    return F.when(followers == 0, F.lit(0.0)).otherwise(
        likes_per_product(likes, products) / followers.cast("double") * F.lit(100.0)
    )


def country_seller_ranking(df: DataFrame) -> DataFrame:
    """T4: per country, sellers ranked by total earnings (1..n), with likes
    per product and likes-to-followers percent, in order of country and rank."""
    g = country_seller_aggregates(df).select(
        "country",
        "seller_id",
        "username",
        c("_earn").cast("double").alias("total_earnings"),
        likes_per_product(c("_likes"), c("_products")).alias("avg_likes_per_product"),
        likes_to_followers(c("_likes"), c("_products"), c("_followers")).alias("likes_to_followers_ratio"),
    )
    ranked = rank_per_group(g, ["country"], [("total_earnings", "desc"), ("username", "asc"), ("seller_id", "asc")], "rank")
    # Already in order of country and rank.
    return ranked.select("country", "username", "total_earnings", "avg_likes_per_product", "likes_to_followers_ratio", "rank")


# --------------------------------------------------------------------- T5
def cheapest_sellers_by_material(
    df: DataFrame,
    countries: Sequence[str] = REF_T5_COUNTRIES,
    min_pass_rate: float = REF_T5_MIN_PASS_RATE,
    k: int = 3,
) -> DataFrame:
    """T5: per material, the ``k`` sellers (by username) with the lowest mean
    seller price, among chosen countries above a pass rate."""
    f = df.where(c("seller.country").isin(list(countries)) & (c("seller.pass_rate") > F.lit(min_pass_rate)))
    g = f.groupBy("material", c("seller.username").alias("seller")).agg(
        F.sum("seller.price").alias("_s"),
        F.count("seller.price").alias("_n"),
        F.max("seller.pass_rate").cast("double").alias("pass_rate"),
        F.min("seller.country").alias("seller_country"),
    )
    g = g.withColumn("avg_price", exact_mean(c("_s"), c("_n")))
    top = top_k_per_group(g, ["material"], [("avg_price", "asc"), ("seller", "asc")], k, "rank")
    return top.select("material", "seller", "avg_price", "pass_rate", "seller_country", "rank").orderBy(
        c("material").asc_nulls_first(), "rank"
    )


# --------------------------------------------------------------------- J1
def season_material_price_profile(
    df: DataFrame,
    gender: str = REF_J1_GENDER,
    pattern: str = REF_J1_PATTERN,
    max_price: float | None = None,
    k: int = 30,
) -> DataFrame:
    """Per (season, material) of matching listings: mean/min/max price and
    the most common color; the ``k`` groups with the highest mean.

    ``max_price=None`` reproduces the reference as written (its price cap is
    overwritten by a later key in the same object); a value applies it.
    One partial aggregate at (season, material, color) feeds both the price
    statistics and the mode.
    """
    cond = (c("gender_target") == gender) & match_ci("name", pattern) & c("price_usd").isNotNull()
    if max_price is not None:
        cond = cond & (c("price_usd") <= F.lit(max_price))
    by_color = df.where(cond).groupBy("season", "material", "color").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price_usd").alias("s"),
        F.min("price_usd").alias("mn"),
        F.max("price_usd").alias("mx"),
    )
    g = by_color.groupBy("season", "material").agg(
        F.sum("n").alias("n"),
        F.sum("s").alias("s"),
        F.min("mn").alias("mn"),
        F.max("mx").alias("mx"),
        argmax_expr(c("color"), [("n", "desc"), ("color", "asc")]).alias("most_common_color"),
    )
    top = g.orderBy(
        exact_mean(c("s"), c("n")).desc_nulls_last(), c("season").asc_nulls_first(), c("material").asc_nulls_first()
    ).limit(k)
    return top.select(
        F.concat(c("season"), F.lit(" - "), c("material")).alias("season_material"),
        "most_common_color",
        ratio_half_even(c("s"), c("n")).alias("average_price"),
        _money(c("mn")).alias("min_price"),
        _money(c("mx")).alias("max_price"),
    )


# --------------------------------------------------------------------- J2
def category_popularity(df: DataFrame) -> DataFrame:
    """Per category, total followers over its listings and the type that
    contributes most."""
    g = df.groupBy("category", "type").agg(sum0("seller.num_followers").alias("t"))
    out = g.groupBy("category").agg(
        F.sum("t").alias("total"),
        argmax_expr(c("type"), [("t", "desc"), ("type", "asc")]).alias("most_popular_type"),
    )
    return out.select(
        "category", c("total").cast("double").alias("total_followers"), "most_popular_type"
    ).orderBy(c("total_followers").desc_nulls_last(), c("category").asc_nulls_first())


# --------------------------------------------------------------------- J3
def season_sell_through(df: DataFrame) -> DataFrame:
    """Per season, sold / unsold counts, percent sold (and as text), and
    the category with the most unsold listings (null if none is unsold)."""
    g = df.groupBy("season", "category").agg(
        F.count_if(c("state.sold") == F.lit(True)).alias("s"),
        F.count_if(c("state.sold") == F.lit(False)).alias("u"),
    )
    per = g.groupBy("season").agg(
        F.sum("s").alias("total_sold"),
        F.sum("u").alias("total_not_sold"),
        F.min_by(
            c("category"),
            F.when(c("u") > 0, F.struct((-c("u")).alias("a"), c("category").alias("b"))),
        ).alias("least_sold_category"),
    )
    total = c("total_sold") + c("total_not_sold")
    # The rounded percent (exact hundredths) is its own column, so the two
    # outputs below reference it instead of each repeating its expression.
    q = F.when(total > 0, scaled_half_even(c("total_sold") * 100, total, 2)).otherwise(F.lit(0).cast("decimal(38,0)"))
    out = per.withColumn("_q", q).select(
        "season",
        c("total_sold").cast("bigint").alias("total_sold"),
        c("total_not_sold").cast("bigint").alias("total_not_sold"),
        total.cast("bigint").alias("total_products"),
        to_scaled_double(c("_q"), 2).alias("percentage_sold"),
        F.concat(plain_decimal_string(c("_q"), 2), F.lit("%")).alias("percentage_sold_string"),
        "least_sold_category",
    )
    return out.orderBy(c("percentage_sold").desc_nulls_last(), c("season").asc_nulls_first())


# --------------------------------------------------------------------- J4
def keyword_rows(df: DataFrame, sep: str | None = None) -> DataFrame:
    """One row per (listing, keyword). ``sep=None`` keeps the whole keyword
    text as one keyword, as unwinding a plain string does; a separator splits
    it (empty pieces dropped). Null keywords give no row."""
    if sep is None:
        return df.where(c("keywords").isNotNull()).withColumn("keyword", c("keywords"))
    import re

    parts = F.filter(F.split(c("keywords"), re.escape(sep)), lambda x: x != "")
    return df.withColumn("keyword", F.explode(parts))


def popular_keywords_by_condition(df: DataFrame, sep: str | None = None) -> DataFrame:
    """Among listings liked more than average, per condition: the most
    frequent keyword, its count, and its most frequent material. Equal keyword
    texts are counted before they are split."""
    liked = above_scalar(df, "like_count", F.sum("like_count"), F.count("like_count"))
    by_text = liked.groupBy("condition", "keywords", "material").agg(F.count(F.lit(1)).alias("m"))
    by_mat = keyword_rows(by_text, sep).groupBy("condition", "keyword", "material").agg(F.sum("m").alias("n"))
    by_kw = by_mat.groupBy("condition", "keyword").agg(
        F.sum("n").alias("cnt"),
        argmax_expr(c("material"), [("n", "desc"), ("material", "asc")]).alias("top_material"),
    )
    best = by_kw.groupBy("condition").agg(
        argmax_expr(
            F.struct(c("keyword"), c("top_material"), c("cnt")), [("cnt", "desc"), ("keyword", "asc")]
        ).alias("b")
    )
    return best.select(
        "condition",
        c("b.keyword").alias("top_keyword"),
        c("b.top_material").alias("top_material"),
        c("b.cnt").cast("bigint").alias("count"),
    ).orderBy(c("condition").asc_nulls_first())


# --------------------------------------------------------------------- J5
def _outfit_extremes_row(
    df: DataFrame, gender: str, kinds: Sequence[str], color: str
) -> DataFrame:
    """One pass, one row: cheapest and dearest listing of each of two kinds.

    The reference runs four sub-pipelines over the collection; here each is
    a conditional ``min_by`` in a single aggregate. Ties go to the smaller
    name, then material. The totals add the prices as reported, each rounded
    half to even at two places.
    """
    k1, k2 = match_ci("name", kinds[0]), match_ci("name", kinds[1])
    base = df.where(
        (c("gender_target") == gender) & (c("color") == color) & c("price_usd").isNotNull() & (k1 | k2)
    )
    item = F.struct(c("name").alias("name"), c("price_usd").alias("price"), c("material").alias("material"))
    up = F.struct(c("price_usd"), c("name"), c("material"))
    down = F.struct((-c("price_usd")).alias("p"), c("name"), c("material"))

    def pick(kind: Column, key: Column) -> Column:
        return F.min_by(F.when(kind, item), F.when(kind, key))

    row = base.agg(
        pick(k1, up).alias("cheap1"),
        pick(k2, up).alias("cheap2"),
        pick(k1, down).alias("dear1"),
        pick(k2, down).alias("dear2"),
    )
    zero = F.lit(0).cast("decimal(18,2)")
    shown = lambda item: F.coalesce(F.bround(c(f"{item}.price"), 2), zero)
    return row.select("*", (shown("cheap1") + shown("cheap2")).alias("lo"), (shown("dear1") + shown("dear2")).alias("hi"))


def outfit_extremes(
    df: DataFrame,
    gender: str = REF_J5_GENDER,
    kinds: Sequence[str] = REF_J5_KINDS,
    labels: Sequence[str] = REF_J5_LABELS,
    color: str = REF_J5_COLOR,
) -> DataFrame:
    """J5 (part 1): the four extreme items, one row each, with both totals."""
    row = _outfit_extremes_row(df, gender, kinds, color)
    slots = [
        ("cheapest", "cheap1", 0, True),
        ("cheapest", "cheap2", 1, False),
        ("most_expensive", "dear1", 0, True),
        ("most_expensive", "dear2", 1, False),
    ]
    items = F.array(*[
        F.struct(
            F.lit(f"{side}_{kinds[i]}").alias("slot"),
            F.lit(labels[i]).alias("type"),
            F.lit(color).alias("color"),
            c(f"{col}.name").alias("product_name"),
            _money(c(f"{col}.price")).alias("product_price"),
            (c(f"{col}.material") if with_mat else F.lit(None).cast("string")).alias("material"),
        )
        for side, col, i, with_mat in slots
    ])
    return row.select(
        F.explode(items).alias("it"),
        _money(c("lo")).alias("cheapest_total"),
        _money(c("hi")).alias("most_expensive_total"),
    ).select("it.*", "cheapest_total", "most_expensive_total")


def outfit_range_candidates(
    df: DataFrame,
    gender: str = REF_J5_GENDER,
    kinds: Sequence[str] = REF_J5_KINDS,
    color: str = REF_J5_COLOR,
) -> DataFrame:
    """J5 range join (L5): listings of the color and of the dearest first-kind
    item's material (null if it has none), priced strictly between the two totals.

    The bounds come from a one-row aggregate, run once; as literals they push
    down into the Parquet scan (price range, color and material), where the
    clustered row groups let most of the table be skipped. No join.
    """
    b = one_row(_outfit_extremes_row(df, gender, kinds, color).select("lo", "hi", c("dear1.material").alias("mat")))
    return df.where(
        (c("price_usd") > F.lit(b["lo"]))
        & (c("price_usd") < F.lit(b["hi"]))
        & (c("color") == color)
        & (c("material").isNull() if b["mat"] is None else c("material") == F.lit(b["mat"]))
    ).select(
        c("name").alias("product_name"),
        _money(c("price_usd")).alias("product_price"),
        c("color").alias("product_color"),
        c("gender_target").alias("product_gender"),
        c("material").alias("product_material"),
    )


def outfit_range_listings(
    df: DataFrame,
    gender: str = REF_J5_GENDER,
    kinds: Sequence[str] = REF_J5_KINDS,
    color: str = REF_J5_COLOR,
    k: int = 10,
) -> DataFrame:
    """J5 (part 2): the ``k`` cheapest listings of the price range."""
    cand = outfit_range_candidates(df, gender, kinds, color)
    return cand.orderBy(
        c("product_price").asc_nulls_first(), c("product_name").asc_nulls_first(), c("product_gender").asc_nulls_first()
    ).limit(k)


def outfit_price_range(
    df: DataFrame,
    gender: str = REF_J5_GENDER,
    kinds: Sequence[str] = REF_J5_KINDS,
    labels: Sequence[str] = REF_J5_LABELS,
    color: str = REF_J5_COLOR,
    k: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """The four extreme items with totals, and the listings in range."""
    return outfit_extremes(df, gender, kinds, labels, color), outfit_range_listings(df, gender, kinds, color, k)


# --------------------------------------------------------------------- M1
def top_types_and_colors(df: DataFrame, k_types: int = 2, k_colors: int = 2) -> DataFrame:
    """M1: per condition the ``k_types`` most listed types, each with its
    ``k_colors`` most listed colors.

    One count at (condition, type, color), from which grouping sets make the type
    totals as well (the reference re-scans the collection once per top type). A
    type's total comes before its colors in their ranking and is handed to the few
    that stay, so the types are ranked by it without a join.
    """
    tc = df.groupBy("condition", c("type").alias("product_type"), "color").agg(F.count(F.lit(1)).alias("n"))
    keys = ["condition", "product_type"]
    sets = tc.groupingSets([keys, [*keys, "color"]], *keys, "color").agg(F.grouping("color").alias("_g"), F.sum("n").alias("n"))
    colors = top_k_per_group(sets, keys, [("_g", "desc"), ("n", "desc"), ("color", "asc")], k_colors + 1, "_r")
    total = F.max(F.when(c("_g") == 1, c("n"))).over(Window.partitionBy(*keys))
    types = Window.partitionBy("condition").orderBy(c("count").desc(), c("product_type").asc_nulls_first())
    top = colors.withColumn("count", total).withColumn("_t", F.dense_rank().over(types)).where(c("_t") <= k_types)
    out = top.where(c("_g") == 0).withColumn("color_count", c("n"))
    return out.select("condition", "product_type", "count", "color", "color_count").orderBy(
        c("condition").asc_nulls_first(), c("count").desc(), c("product_type").asc_nulls_first(),
        c("color_count").desc(), c("color").asc_nulls_first(),
    )


# --------------------------------------------------------------------- M2
def season_material_leave_one_out(df: DataFrame, k: int = 5) -> DataFrame:
    """M2: per season the ``k`` most listed materials, their mean price, the
    mean of the other top materials' means, and the difference.

    The mean divides by all listings of the group, priced or not, as the
    reference does. The leave-one-out runs on the ``k``-row list per season.
    """
    g = df.groupBy("season", "material").agg(
        F.count(F.lit(1)).alias("count"), sum0("price_usd").alias("_total")
    )
    top = top_k_per_group(g, ["season"], [("count", "desc"), ("material", "asc")], k, "_r")
    top = top.withColumn("avg_price_usd", exact_mean(c("_total"), c("count")))
    loo = leave_one_out_in_list(top, ["season"], "material", "avg_price_usd", "avg_of_other", carry=["count"])
    return loo.select(
        "season",
        "material",
        "count",
        "avg_price_usd",
        "avg_of_other",
        (c("avg_price_usd") - c("avg_of_other")).alias("difference"),
    ).orderBy(c("season").asc_nulls_first(), c("count").desc(), c("material").asc_nulls_first())


# --------------------------------------------------------------------- M3
def country_lead_brand(df: DataFrame) -> DataFrame:
    """M3: per seller country, the most listed brand, its seller earnings, and
    the earnings of every other brand (country total minus the lead)."""
    g = df.groupBy(c("seller.country").alias("country_name"), c("brand.name").alias("brand")).agg(
        sum0("seller.earning").alias("e"), F.count(F.lit(1)).alias("n")
    )
    per = g.groupBy("country_name").agg(
        argmax_expr(F.struct("brand", "n", "e"), [("n", "desc"), ("brand", "asc")]).alias("lead"),
        F.sum("e").alias("total"),
    )
    return per.select(
        "country_name",
        c("lead.brand").alias("max_brand_name_for_country"),
        c("lead.n").alias("max_brand_count_for_country"),
        c("lead.e").cast("double").alias("total_seller_earnings_country_max_brand_count_for_country"),
        (c("total") - c("lead.e")).cast("double").alias("total_seller_earnings_country_all_other_brands"),
    ).orderBy(c("country_name").asc_nulls_first())


# --------------------------------------------------------------------- M4
def fee_cube(df: DataFrame, store: bool = False) -> DataFrame:
    """Listings with a fee, counted once at (warehouse, country, type); the
    three grains of M4 are roll-ups of this one aggregate. Its size is
    warehouses x countries x types, independent of the row count. With
    ``store`` it is written once to the checkpoint folder, so the roll-ups do
    not each rescan the table."""
    f = df.where(c("shipping.buyers_fees").isNotNull())
    cube = f.groupBy(
        c("shipping.warehouse_name").alias("warehouse_name"), c("seller.country").alias("country"), "type"
    ).agg(
        F.count_if(c("state.sold") == F.lit(True)).alias("s"),
        F.count_if(c("state.reserved") == F.lit(True)).alias("r"),
        F.count_if(c("state.available") == F.lit(True)).alias("a"),
        F.sum("shipping.buyers_fees").alias("fs"),
        F.count("shipping.buyers_fees").alias("fn"),
    )
    return reuse(cube) if store else cube


def warehouse_state_counts(df: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """M4 (part 1): per warehouse, sold/reserved/available counts and mean fee."""
    cube = cube if cube is not None else fee_cube(df)
    w = cube.groupBy("warehouse_name").agg(
        F.sum("s").alias("s"), F.sum("r").alias("r"), F.sum("a").alias("a"),
        F.sum("fs").alias("fs"), F.sum("fn").alias("fn"),
    )
    return w.select(
        "warehouse_name",
        c("s").cast("bigint").alias("total_sold"),
        c("r").cast("bigint").alias("total_reserved"),
        c("a").cast("bigint").alias("total_available"),
        exact_mean(c("fs"), c("fn")).alias("avg_buyers_fees"),
    )


def country_fees(cube: DataFrame) -> DataFrame:
    g = cube.groupBy("country").agg(F.sum("fs").alias("fs"), F.sum("fn").alias("fn"))
    return g.select("country", exact_mean(c("fs"), c("fn")).alias("avg_buyers_fees_country"))


def fee_grains(df: DataFrame) -> DataFrame:
    """The three grains of M4 from one scan: ``grain`` is warehouse, country or type (of a
    country), with its mean fee; state counts and sums as in ``fee_cube``, which grouping
    sets roll up to all three at once."""
    cube = fee_cube(df).withColumnRenamed("type", "product_type")
    sets = cube.groupingSets([["warehouse_name"], ["country"], ["country", "product_type"]], "warehouse_name", "country", "product_type")
    sums = sets.agg(F.grouping("country").alias("_w"), F.grouping("product_type").alias("_c"), *(F.sum(x).alias(x) for x in ("s", "r", "a", "fs", "fn")))
    grain = F.when(c("_w") == 1, F.lit("warehouse")).when(c("_c") == 1, F.lit("country")).otherwise(F.lit("type"))
    return sums.select("warehouse_name", "country", c("product_type").alias("type"), grain.alias("grain"), "s", "r", "a", exact_mean(c("fs"), c("fn")).alias("mean"))


def _placed_fees(df: DataFrame) -> DataFrame:
    """The grains in order of their means, stored once: the ranges that warehouses and
    countries are merged in must be the same for both (the types come along)."""
    is_country = F.when(c("grain") == "country", F.lit(True)).when(c("grain") == "warehouse", F.lit(False))
    return place_by_value(fee_grains(df), "mean", is_country)


def _cheaper_countries(placed: DataFrame) -> DataFrame:
    means = placed.where(c("mean").isNotNull())
    pairs = pairs_below(means.where(c("grain") == "warehouse"), means.where(c("grain") == "country"))
    return pairs.select(
        c("_a.warehouse_name").alias("warehouse_name"),
        c("_a.s").cast("bigint").alias("total_sold"),
        c("_a.r").cast("bigint").alias("total_reserved"),
        c("_a.a").cast("bigint").alias("total_available"),
        c("_a.mean").alias("avg_buyers_fees"),
        c("_b.country").alias("country"),
        c("_b.mean").alias("avg_buyers_fees_country"),
    )


def warehouse_cheaper_countries(df: DataFrame) -> DataFrame:
    """M4 (part 2): every (warehouse, country) where the country's mean fee is
    below the warehouse's. Warehouses with no cheaper country drop out."""
    return _cheaper_countries(_placed_fees(df))


def warehouse_nearest_types(df: DataFrame, k: int = 2) -> DataFrame:
    """M4 (full): each cheaper country with its ``k`` types whose mean fee is
    nearest the country mean (L7). Nearest types depend on the country only,
    so they are found once per country and joined to the pairs."""
    placed = _placed_fees(df)
    countries = placed.where(c("grain") == "country").select("country", c("mean").alias("avg_buyers_fees_country"))
    types = placed.where(c("grain") == "type").select("country", "type", c("mean").alias("type_avg_buyers_fees"))
    near = nearest_k(
        join_on_keys(types, countries, ["country"]),
        ["country"],
        c("type_avg_buyers_fees"),
        c("avg_buyers_fees_country"),
        k,
        ties=[("type", "asc")],
    ).drop("avg_buyers_fees_country")
    out = join_on_keys(_cheaper_countries(placed), near, ["country"])
    return out.select(
        "warehouse_name", "total_sold", "total_reserved", "total_available", "avg_buyers_fees",
        "country", "avg_buyers_fees_country", "type", "type_avg_buyers_fees", "diff",
    ).orderBy("warehouse_name", "country", "nearest_rank")


warehouse_fee_comparison = warehouse_nearest_types


# --------------------------------------------------------------------- M5
def price_quartile_cuts(df: DataFrame, **kw) -> DataFrame:
    """M5 (cut points): ``n, min_q1, q1_median, median_q3, q3_max, max_price``
    (sorted index ``floor(n * q)``), all from the passes of ``order_stats``."""
    st = order_stats(df, "price_usd", QUARTILES, **kw)
    kind = df.schema["price_usd"].dataType
    cuts = dict(zip(BAND_LABELS[1:], st.values)) if st.n else dict.fromkeys(BAND_LABELS[1:])
    shown = {"min_q1": st.minimum, **cuts, "max_price": st.maximum}
    row = df.sparkSession.range(1).select(F.lit(st.n).cast("bigint").alias("n"), *[F.lit(v).cast(kind).alias(k) for k, v in shown.items()])
    return row.select("n", *[_money(c(k)).alias(k) for k in shown])


def price_quartile_bands(df: DataFrame, **kw) -> DataFrame:
    """M5 (bands): every priced listing with its quartile band (whole table).
    The three cut points are computed once and applied as literals."""
    names = list(BAND_LABELS[1:])
    cut = cut_values(df, "price_usd", QUARTILES, names, **kw)
    band = band_expr(c("price_usd"), [F.lit(cut[n]) for n in names], BAND_LABELS)
    return df.where(c("price_usd").isNotNull()).select(
        band.alias("band"), "name", "type", _money(c("price_usd")).alias("price_usd")
    )


def price_quartile_band_counts(df: DataFrame, **kw) -> DataFrame:
    """M5 (summary): per band, listing count and lowest/highest price."""
    b = price_quartile_bands(df, **kw)
    return b.groupBy("band").agg(
        F.count(F.lit(1)).alias("count"), F.min("price_usd").alias("lower"), F.max("price_usd").alias("upper")
    ).orderBy("band")
