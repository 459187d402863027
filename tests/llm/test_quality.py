from __future__ import annotations

import zlib

import numpy as np

from tests.llm import edge
from vitrine.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = quality.op7_quality(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97


def test_density_difference():
    """The factors give the log densities of the shrunk normal distributions."""
    rng = np.random.default_rng(0)
    d = len(quality.STATISTICS)
    data = {c: rng.normal(c, 1 + c, (200, d)) @ rng.normal(size=(d, d)) for c in (0, 1)}
    m = quality.Discriminant({c: (len(x), x.sum(0), x.T @ x) for c, x in data.items()}, shrinkage=0.0, ridge=0.0)
    x = rng.normal(0.5, 2, (20, d))
    log = []
    for c in (0, 1):
        cov, mean = np.cov(data[c].T, bias=True), data[c].mean(0)
        dist = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        log.append(-0.5 * dist - 0.5 * np.linalg.slogdet(cov)[1])
    want = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
    assert np.allclose(m.score(x), want, atol=1e-6)


def test_edges(spark):
    labels = spark.createDataFrame([(6, 1, 0), (7, 1, 0), (8, 1, 0), (10, 0, 0), (11, 0, 0), (2, 0, 1), (9, None, 1), (None, 1, 1), (12, 5, 0), (6, 1, 0)], "doc_id long, quality int, text int")
    got = quality.score_documents(edge.documents(spark), labels).collect()
    assert len(got) == len(edge.texts()) and all(0 <= r["score"] <= 1 for r in got)
    kept = quality.keep_good(edge.documents(spark), labels)
    assert kept.columns == edge.documents(spark).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((r["doc_id"] for r in got if r["predicted"]), key=str)
    none = labels.limit(0)
    assert {r["score"] for r in quality.score_documents(edge.documents(spark), none).collect()} == {1.0}
    assert quality.score_documents(edge.empty(spark), labels).collect() == []
