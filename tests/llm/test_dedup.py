"""Substring deduplication over bytes (op5) and over words (op9)."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import edge
from vitrine.llm import anchors, bwt, suffixes
from vitrine.plans.check import compare


def rows_of(df, names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("hot", [2, 1024])
def test_bytes_edges(spark, hot):
    rows = edge.texts()
    # Rows that share a null id are ordered by their texts' hashes.
    got = rows_of(suffixes.remove_duplicate_spans(edge.documents(spark), 100, hot=hot), BYTES)
    assert got == sorted(edge.byte_dedup(rows, 100), key=str)


@pytest.mark.parametrize("hot", [3, 1024])
def test_bytes_whole_table(spark, hot):
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(suffixes.remove_duplicate_spans(docs, hot=hot), BYTES) == sorted(edge.byte_dedup(rows, 100), key=str)


def test_bytes_random(spark):
    """A small alphabet makes repeats at every distance."""
    r = random.Random(5)
    rows = [(k, "".join(r.choice("ab") for _ in range(r.randint(0, 400)))) for k in range(40)]
    rows += [(100 + k, "ab" * 150 + "x" * k) for k in range(5)]
    docs = edge.documents(spark, rows)
    assert rows_of(suffixes.remove_duplicate_spans(docs, 12), BYTES) == sorted(edge.byte_dedup(rows, 12), key=str)


def test_kept_text(spark):
    docs = edge.documents(spark)
    out = suffixes.dedup_text(docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    got = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    assert len(out.collect()) == len(edge.texts())
    assert got[1]["text"] == "" and got[6]["text"] == edge.texts()[5][1] and got[13]["n_chars"] == len(got[13]["text"])
    assert got[8]["lang"] == "en" and got[4]["lang"] is None


def test_common_prefixes():
    rng = np.random.default_rng(0)
    for n, sigma, length in ((50, 2, 5), (400, 3, 8), (300, 2, 40), (7, 1, 3)):
        symbols = rng.integers(0, sigma, n).astype(np.uint16)
        order, cls = bwt.common_prefix_classes(symbols, length)
        assert sorted(order) == list(range(n))
        twice = np.concatenate([symbols] * (2 + length // n))
        prefix = [tuple(twice[i : i + length]) for i in order]
        for a in range(1, n):
            assert (cls[a] == cls[a - 1]) == (prefix[a] == prefix[a - 1]) and prefix[a - 1] <= prefix[a]


def test_words_edges(spark):
    assert rows_of(anchors.remove_repeats(edge.documents(spark)), WORDS) == sorted(edge.word_dedup(edge.texts(), 35), key=str)


def test_words_whole_table(spark):
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(anchors.op9_anchors(spark, edge.SF), WORDS) == sorted(edge.word_dedup(rows, 35), key=str)


@pytest.mark.parametrize("window", [1, 2, 5, 8])
def test_words_random(spark, window):
    r = random.Random(window)
    rows = [(k, " ".join(r.choice("abc") for _ in range(r.randint(0, 60)))) for k in range(30)]
    assert rows_of(anchors.remove_repeats(edge.documents(spark, rows), window), WORDS) == sorted(edge.word_dedup(rows, window), key=str)


def test_match_sql(spark, duck):
    for query, sql in ((suffixes.op5_suffixes, suffixes.OP5_SQL), (anchors.op9_anchors, anchors.OP9_SQL)):
        result = compare(query(spark, edge.SF), duck, sql)
        assert result["values_match"], result


def test_empty(spark):
    assert suffixes.remove_duplicate_spans(edge.empty(spark)).collect() == []
    assert suffixes.dedup_text(edge.empty(spark)).collect() == []
    assert anchors.remove_repeats(edge.empty(spark)).collect() == []
