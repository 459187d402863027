"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL
from vitrine.plans.check import compare
from vitrine.plans.operator_queries import operator_sql
from vitrine.plans.oracle import analysis_sql
from vitrine.plans.registry import all_queries, analysis_queries

QUERIES = all_queries()
SQL = {**analysis_sql(), **operator_sql()}


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(SQL) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    r = compare(df, duck, SQL[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", sorted(analysis_queries()))
def test_analyses_agree_on_the_typed_text(spark, duck, name, monkeypatch):
    """The same SQL holds for listings that went through text and the typed ingest."""
    from vitrine.plans import registry
    from vitrine.plans.operator_queries import raw_text
    from vitrine.sources.ingest import nest_listing, type_listings
    from vitrine.sources.store import listings

    typed = nest_listing(type_listings(raw_text(listings(spark, SF_SMALL))), "full")
    monkeypatch.setattr(registry, "listings", lambda spark, sf_dir: typed)
    r = compare(QUERIES[name](spark, SF_SMALL), duck, SQL[name])
    assert r["values_match"], r


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["condition", "product_type", "count", "color", "color_count"]
