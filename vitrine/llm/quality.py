"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a few transformed statistics. Per class, the mean and the
covariance come from sums over all labelled training rows; a covariance is
shrunk towards the pooled one and a multiple of the identity. The score is the
probability of label 1 from the difference of the two log densities, computed
with Mahalanobis distances from Cholesky factors that are found once and sent
along with the scoring function.

Defined cases: a null or empty text has all statistics zero and is scored like
any other; labels other than 0 and 1 are ignored; a document with several
labels counts once per label; without training rows of both labels every score
is 1.0 (nothing is known against any text); rows that repeat are scored alike;
an empty table gives no rows. Labels, ids, languages and sources are not inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.anchors import word_hashes
from vitrine.llm.common import stored, text_bytes, word_bounds

THRESHOLD = 0.7
SHRINKAGE = 0.5
RIDGE = 0.01
STATISTICS = (
    "log_bytes", "upper", "digits", "symbols", "bars", "exclamations", "stops", "repeated", "distinct",
    "word_length", "word_spread", "line_words", "entropy", "wide",
)

_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LETTER = _UPPER | ((_CODES >= 97) & (_CODES <= 122))
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_SYMBOL = (_CODES > 32) & (_CODES < 127) & ~_LETTER & ~_DIGIT & ~np.isin(_CODES, [ord(c) for c in ".,;:!?'\"-()|"])


def statistics(text: str | None) -> np.ndarray:
    """Shares are taken to their square roots, counts to logarithms."""
    data = text_bytes(text)
    start, end = word_bounds(data)
    words = len(start)
    if not words:
        return np.zeros(len(STATISTICS))
    count = np.bincount(data, minlength=256).astype(float)
    size = float(len(data))
    letters = max(1.0, count[_LETTER].sum())
    length = (end - start).astype(float)
    hashes = word_hashes(data, start, end)
    p = count[count > 0] / size
    share = lambda x, of=size: np.sqrt(x / of)
    return np.array(
        [
            np.log1p(size) / 10,
            share(count[_UPPER].sum(), letters),
            share(count[_DIGIT].sum()),
            share(count[_SYMBOL].sum()),
            share(count[ord("|")]),
            share(count[ord("!")]),
            share(count[ord(".")]),
            share(float((hashes[1:] == hashes[:-1]).sum()), words),
            np.log1p(len(np.unique(hashes))) / np.log1p(words),
            np.log1p(length.mean()),
            np.log1p(length.std()),
            np.log1p(words / (1 + count[10])) / 10,
            -(p * np.log2(p)).sum() / 8,
            share(count[128:].sum()),
        ]
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x (array of statistics) per row of ``docs``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "x": [statistics(t) for t in b["text"]]})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = rows.mapInPandas(run, "doc_id string, x array<double>")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


class Discriminant:
    """Means, inverse Cholesky factors and constants of the two log densities."""

    def __init__(self, moments: dict[int, tuple[int, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE, ridge: float = RIDGE):
        self.known = all(moments.get(c, (0,))[0] > 1 for c in (0, 1))
        if not self.known:
            return
        total = sum(moments[c][0] for c in (0, 1))
        cov = {c: xx / n - np.outer(s / n, s / n) for c, (n, s, xx) in moments.items()}
        pooled = sum(moments[c][0] * cov[c] for c in (0, 1)) / total
        scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
        self.mean, self.factor, self.constant = {}, {}, {}
        for c in (0, 1):
            n, s, _ = moments[c]
            shrunk = ((1 - shrinkage) * cov[c] + shrinkage * pooled) / np.outer(scale, scale)
            shrunk += ridge * np.trace(shrunk) / len(scale) * np.eye(len(scale))
            low = np.linalg.cholesky(shrunk)
            self.mean[c] = s / n
            self.factor[c] = (np.linalg.inv(low) / scale).T
            self.constant[c] = np.log(n / total) - np.log(np.diag(low)).sum()

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.ones(len(x))
        log = {c: self.constant[c] - 0.5 * (((x - self.mean[c]) @ self.factor[c]) ** 2).sum(1) for c in (0, 1)}
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(stats: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> Discriminant:
    """One aggregate of counts, sums and sums of products per class. ``labels`` has doc_id and quality."""
    d = len(STATISTICS)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    train = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "quality")
    rows = stats.join(train, "doc_id").select("quality", "x")
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i, j in pairs]
    moments = {}
    for r in rows.groupBy("quality").agg(F.count("*").alias("n"), *sums, *products).collect():
        xx = np.zeros((d, d))
        for i, j in pairs:
            xx[i, j] = xx[j, i] = r[f"p{i}_{j}"]
        moments[int(r["quality"])] = (r["n"], np.array([r[f"s{i}"] for i in range(d)]), xx)
    return Discriminant(moments, shrinkage, ridge)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""
    stats = stored(document_statistics(docs), "statistics")
    model = fit(stats, labels)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x)) if len(x) else np.zeros(0))

    scored = stats.withColumn("score", score("x"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that the classifier rejects. Only statistics are
    joined with the labels; texts are scored where they are read, so none is shuffled."""
    model = fit(stored(document_statistics(docs), "statistics"), labels)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([statistics(t) for t in text])) if len(text) else np.zeros(0))

    return docs.filter(score("text") >= threshold)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
