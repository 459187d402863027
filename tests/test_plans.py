"""Physical-plan properties: no Python in the plans, top-k pushed into the
shuffle, filters and nested pruning reaching the scan, no cartesian product."""

from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL
from vitrine.plans.registry import all_queries

QUERIES = all_queries()


def plan_text(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_text(fn(spark, SF_SMALL)) for name, fn in QUERIES.items()}


def test_no_python_in_any_plan(plans):
    """But, on Arrow batches, for cutting multi-line CSV into records and for numbering sorted rows."""
    numbered = {"ingest_csv_multiline", "rank_per_group", "country_ranking_lists", "warehouse_country_lists"}
    for name, text in plans.items():
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in text, (name, node)
        assert ("MapInArrow" in text) == (name in numbered or name.startswith("country_seller_ranking")), name


def test_ranking_is_one_range_exchange(plans):
    """The sort that is stored; the ranking itself moves nothing."""
    for name in ("country_seller_ranking", "rank_per_group"):
        assert "Exchange" not in plans[name] and "Sort" not in plans[name], name


def test_no_cartesian_product(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name


def test_no_nested_loop_join(plans):
    for name, text in plans.items():
        assert "BroadcastNestedLoopJoin" not in text, name


def test_no_row_or_byte_threshold_in_the_operators():
    """Plans do not switch on sizes: that is left to Spark."""
    import pathlib

    import vitrine

    root = pathlib.Path(vitrine.__file__).parent
    for part in ("operators", "plans", "sources"):
        for f in (root / part).glob("*.py"):
            code = f.read_text()
            for word in ("broadcast(", "sizeInBytes", "_MIN_BYTES", "max_group_rows", "max_sort_rows", "max_broadcast_rows", "max_members"):
                assert word not in code, (f, word)


@pytest.mark.parametrize(
    "name",
    ["top_types_and_colors", "cheapest_sellers_by_material", "badge_top_sellers", "season_material_leave_one_out"],
)
def test_top_k_uses_window_group_limit(plans, name):
    text = plans[name]
    assert "WindowGroupLimit" in text
    assert "Partial" in text and "Final" in text


def test_filters_and_nested_pruning_reach_scan(plans):
    text = plans["cheapest_sellers_by_material"]
    assert "PushedFilters: [IsNotNull(seller.pass_rate), In(seller.country" in text
    scan = text.split("ReadSchema:")[1].splitlines()[0]
    assert "warehouse_name" not in scan and "earning" not in scan and "badge" not in scan


def test_aggregation_is_partial_before_exchange(plans):
    for name in ("country_lead_brand", "category_popularity", "warehouse_state_counts"):
        assert "partial_sum" in plans[name] or "partial_count" in plans[name], name


def test_every_window_has_a_partition_key(plans):
    import re

    node = re.compile(r"\(\d+\) Window\nInput \[\d+\]: \[.*?\]\nArguments: (.*)\n")
    seen = 0
    for name, text in plans.items():
        for args in node.findall(text):
            # Arguments: [window expressions], [partition keys], [order keys]
            assert "], [], [" not in args, (name, args)
            assert "windowspecdefinition(" in args
            seen += 1
    assert seen >= 10


def test_grains_come_from_one_scan(plans):
    """T3 and M1 read the table once and store nothing; M4 reads what it stored in order."""
    for name in ("badge_report", "badge_earnings", "top_types_and_colors"):
        first = plans[name].split("\n\n(1)")[0]
        assert first.count("Scan parquet") == 1 and "ExistingRDD" not in plans[name] and "Expand" in first, name
    assert "Scan parquet" not in plans["warehouse_nearest_types"]


def test_lookup_is_a_ranking_and_an_equi_join(plans):
    text = plans["lookup_top_brands"]
    assert "WindowGroupLimit" in text and ("SortMergeJoin" in text or "BroadcastHashJoin" in text)


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    """A seller's listings lie in a few row groups: the others are not read."""
    from vitrine.sources.store import materialise

    rows = spark.range(200_000).selectExpr("struct(concat('seller ', id * 7919 % 200003) AS id) AS seller", "id AS price", "cast(id % 3 as string) AS color")
    read = {}
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.files.maxPartitionBytes": str(1 << 30)}
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("parquet.block.size", 1 << 17)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        for looked_up in ((), ("seller.id",)):
            path = materialise(rows.repartition(4), str(tmp_path), "t", ("color",), looked_up)
            found = spark.read.parquet(path).where("seller.id = 'seller 7919'")
            assert [r["price"] for r in found.collect()] == [1]
            plan = found._jdf.queryExecution().executedPlan()
            read[looked_up] = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    finally:
        spark.conf.unset("parquet.block.size")
        for k, v in before.items():
            spark.conf.set(k, v)
    assert read[("seller.id",)] < read[()] / 5, read


def test_build_sorts_narrow_rows_in_bounded_partitions(spark, monkeypatch):
    """What a task of the build sorts is not nested yet, and does not grow with the table."""
    from vitrine.sources import store
    from vitrine.sources.driver_tables import listing_view

    view = listing_view(spark, SF_SMALL, store.CLUSTER_BY)
    node = view._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Sort":
        node = node.children().head()
    kinds = node.schema().catalogString()
    assert kinds.count("struct<") == 1 and "decimal" not in kinds, kinds
    rows = lambda df: sorted(df.collect(), key=str)
    assert rows(view) == rows(listing_view(spark, SF_SMALL))

    own = store.build_session(spark, 100 * store.ROWS_PER_PARTITION)
    assert own.conf.get("spark.sql.shuffle.partitions") == "100"
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    # With nothing broadcast or put together, the stored files are numbered up to that.
    monkeypatch.setattr(store, "ROWS_PER_PARTITION", 200)
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    store.forget(spark)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        files = store.listings(spark, SF_SMALL).inputFiles()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        store.forget(spark)
    assert max(int(f.rsplit("/part-", 1)[1][:5]) for f in files) >= 8, files


def test_build_in_shares_leaves_no_shuffle_files(spark, monkeypatch):
    """A share has its own orders only, and its shuffles are deleted when it is stored."""
    from vitrine.sources import store
    from vitrine.sources.driver_tables import listing_view

    def shuffle_files() -> set[str]:
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        return {f for f in iter(lambda: found.next().getName() if found.hasNext() else "", "") if f.startswith("shuffle_")}

    shares = [listing_view(spark, SF_SMALL, share=(i, 3)) for i in range(3)]
    assert all(x._jdf.queryExecution().optimizedPlan().toString().count("(pmod(xxhash64(") == 2 for x in shares)
    rows = lambda df: sorted(df.collect(), key=str)
    whole = rows(listing_view(spark, SF_SMALL))
    assert sorted((r for x in shares for r in x.collect()), key=str) == whole

    monkeypatch.setattr(store, "ROWS_PER_SHARE", 2_500)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    store.forget(spark)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        kept = shuffle_files()
        table = store.listings(spark, SF_SMALL)
        left = shuffle_files() - kept
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        store.forget(spark)
    assert not left, left
    assert table.columns == listing_view(spark, SF_SMALL).columns and rows(table) == whole


def test_one_row_lookups_are_pushed_literals(plans):
    text = plans["outfit_range_listings"]
    pushed = text.split("PushedFilters:")[1].splitlines()[0]
    for f in ("GreaterThan(price_usd,", "LessThan(price_usd,", "EqualTo(color,"):
        assert f in pushed, pushed
    assert "EqualTo(material," in pushed or "IsNull(material)" in pushed, pushed
    for name in ("popular_keywords_by_condition", "popular_keywords_split"):
        assert "GreaterThan(like_count," in plans[name], name
    assert "EqualTo(seller.id," in plans["top_seller_brands"] or "IsNull(seller.id)" in plans["top_seller_brands"]
    for name in ("outfit_range_listings", "popular_keywords_by_condition", "price_quartile_bands", "price_quartile_cuts"):
        assert "Subquery" not in plans[name], name
