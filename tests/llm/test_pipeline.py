"""Each stage against brute force on its own input."""

from __future__ import annotations

import re
import shutil
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm import edge
from vitrine.llm import mixing, quality
from vitrine.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, edge.SF), name)
        out.append(docs)
    return out


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_names_and_columns(steps):
    assert len(corpus_pipeline.STAGES) == 5
    for df in steps[:-1]:
        assert df.columns == COLUMNS


def test_quality(spark, steps):
    scored = quality.score_documents(steps[0], spark.read.parquet(f"{edge.SF}/labels.parquet"))
    good = {r["doc_id"] for r in scored.filter("predicted = 1").collect()}
    assert rows(steps[1]) == [r for r in rows(steps[0]) if r[0] in good] and len(good) > 100


def test_near_dedup(steps):
    before = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    of = edge.groups([edge.fingerprint(t) for _, t in before], 3)
    heads = {min(before[i][0] for i in range(len(before)) if of[i] == g) for g in set(of)}
    assert rows(steps[2]) == [r for r in rows(steps[1]) if r[0] in heads]


def test_substring_dedup(steps):
    before = [(r["doc_id"], r["text"]) for r in steps[2].collect()]
    want = {i: removed for i, _, removed, _, _ in edge.byte_dedup(before, 100)}
    after = {r["doc_id"]: r["text"] for r in steps[3].collect()}
    assert len(after) == len(before)
    for i, t in before:
        if want[i] == 0:
            assert after[i] == t
        else:  # cut characters may lose up to three bytes at each edge of a span
            assert len(t.encode()) - want[i] - len(after[i].encode()) >= 0 and after[i] != t


def test_decontamination(spark, steps):
    norm = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    items = [norm(r["text"]) for r in spark.read.parquet(f"{edge.SF}/benchmark.parquet").collect()]
    clean = [r for r in rows(steps[3]) if not any(x in norm(r[1]) for x in items)]
    assert rows(steps[4]) == clean


def test_mixing(steps):
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(steps[4]).collect()}
    assert Counter(r["doc_id"] for r in steps[5].collect()) == +Counter(plan)


def test_run(spark, steps):
    assert rows(corpus_pipeline.run(spark, edge.SF)) == rows(steps[5])


def test_awkward_documents(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows; and no documents at all."""
    for name in ("labels", "benchmark"):
        shutil.copy(f"{edge.SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    edge.documents(spark).select(*COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert set(corpus_pipeline.run(spark, str(tmp_path)).columns) == set(COLUMNS)
    corpus_pipeline.run(spark, str(tmp_path)).collect()
    edge.empty(spark).select(*COLUMNS).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
