"""Embedding whitening over weighted distinct vectors.

Equal vectors are one row of the fit, weighted by how often they occur or by
one. The mean and the deviations from it are whole numbers divided by the
weight's sum, so the covariance is centred before it is multiplied: every task
adds up the products of its centred vectors, and Spark adds these sums entry by
entry. The driver sees one number per pair of dimensions and their eigenvectors,
never a vector. Each distinct vector is whitened once, and joined back to the
rows that have it.

Defined cases: rows whose vector is null, empty, or holds a null or a component
that is not finite or not below 2^63 after scaling take no part; a null id and
repeated rows are rows like others; vectors of different lengths are fits of
their own (``dim`` tells them apart); an eigenvalue that is zero to double
precision leaves ``whitened`` null, and is not in ``identity_error``; a fit
without variance has null ``explained`` and ``identity_error``; an empty table
gives no rows; other columns are not read. Signs: the largest entry of an
eigenvector is positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import stored

SCALE = 256
COMPONENTS = 4
_BATCH = 4096


def whole(embedding: Column, scale: int) -> Column:
    """floor(scale * c) of each component as long; null unless all are finite and fit."""
    scaled = lambda v: F.lit(float(scale)) * v.cast("double")
    good = F.forall(embedding, lambda v: F.coalesce(~F.isnan(v) & (F.abs(scaled(v)) < F.lit(2.0**63)), F.lit(False)))
    return F.when(good & (F.size(embedding) > 0), F.transform(embedding, lambda v: F.floor(scaled(v)).cast("long")))


def distinct_vectors(rows: DataFrame, multiplicity: bool) -> DataFrame:
    """x, dim, weight of each distinct x of ``rows``, stored. Equal vectors are
    combined before the shuffle, so one that fills a third of the rows is no hot group."""
    weight = F.count("*") if multiplicity else F.lit(1).cast("long")
    return stored(rows.groupBy("x").agg(weight.alias("weight")).withColumn("dim", F.size("x")), "distinct-vectors")


def moments(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per vector length: sum of the weights, and the weighted sum of each dimension, both
    exact. A task adds up its own vectors, and Spark the tasks' sums as decimals."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, list[int]] = {}
        for b in batches:
            weight = b["weight"].to_numpy(np.int64)
            for dim, at, x in _groups(b, "x"):
                w = weight[at, None]
                fits = max(abs(int(x.max())), abs(int(x.min()))) * int(w.sum()) < 2**62
                sums = [int(w.sum()), *((x if fits else x.astype(object)) * w).sum(0).tolist()]
                total[dim] = [p + q for p, q in zip(total[dim], sums)] if dim in total else sums
        for dim, sums in total.items():
            yield pd.DataFrame({"dim": dim, "at": np.arange(-1, dim), "s": [str(v) for v in sums]})

    parts = fit.select("dim", "weight", "x").mapInPandas(run, "dim int, at int, s string")
    out: dict[int, dict[int, int]] = {}
    for r in parts.groupBy("dim", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        out.setdefault(r["dim"], {})[r["at"]] = int(r["s"])
    return {dim: (s[-1], [s[i] for i in range(dim)]) for dim, s in out.items()}


def _reach(x: np.ndarray, n: int, sums: list[int]) -> int:
    """A bound of |n*x - S|."""
    return n * (1 + max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) + max(map(abs, sums))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: the whole numbers n*x - S are exact, so only the division rounds."""
    if _reach(x, n, sums) < 2**62:
        return (np.int64(n) * x - np.array(sums, np.int64)) / n
    return np.array([[(n * v - s) / n for v, s in zip(row, sums)] for row in x.tolist()], np.float64).reshape(x.shape)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[str]:
    """The sum of the squares of n*x - S, exact at any size."""
    if _reach(x, n, sums) ** 2 * len(sums) < 2**62:
        return ((np.int64(n) * x - np.array(sums, np.int64)) ** 2).sum(1).astype(str).tolist()
    return [str(sum((n * v - s) ** 2 for v, s in zip(row, sums))) for row in x.tolist()]


def _groups(batch: pd.DataFrame, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) of a batch's vectors of each length, in bounded pieces."""
    dims = batch["dim"].to_numpy()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        for i in range(0, len(at), _BATCH):
            part = at[i : i + _BATCH]
            yield int(dim), part, np.stack(batch[column].iloc[part].to_list()).reshape(len(part), -1)


def _products(fit: DataFrame, column: str, centre) -> dict[int, dict[tuple[int, int], float]]:
    """Per vector length: the weighted sum of the products of each pair of entries of
    ``centre(dim, matrix)``, from one matrix product per batch. A task sends the upper triangle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            weight = b["weight"].to_numpy(np.float64)
            for dim, at, x in _groups(b, column):
                y = centre(dim, x)
                product = (y * weight[at, None]).T @ y
                total[dim] = total[dim] + product if dim in total else product
        for dim, m in total.items():
            i, j = np.triu_indices(len(m))
            yield pd.DataFrame({"dim": dim, "i": i, "j": j, "s": m[i, j]})

    sums = fit.select("dim", "weight", column).mapInPandas(run, "dim int, i int, j int, s double").groupBy("dim", "i", "j").agg(F.sum("s").alias("s"))
    out: dict[int, dict[tuple[int, int], float]] = {}
    for r in sums.collect():
        out.setdefault(r["dim"], {})[r["i"], r["j"]] = r["s"]
    return out


def _symmetric(cells: dict[tuple[int, int], float], size: int, n: int) -> np.ndarray:
    m = np.zeros((size, size))
    for (i, j), s in cells.items():
        m[i, j] = m[j, i] = s / n
    return m


class Fit:
    """Mean, eigenvectors by falling eigenvalue (as columns) and eigenvalues of one vector length."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int):
        self.n, self.sums, dim = n, sums, len(sums)
        values, vectors = np.linalg.eigh(covariance)
        self.trace = float(np.trace(covariance))
        top = np.argsort(-values, kind="stable")[:components]
        self.values, vectors = values[top], vectors[:, top]
        lead = vectors[np.abs(vectors).argmax(0), np.arange(len(top))]
        self.vectors = vectors * np.where(lead < 0, -1.0, 1.0)
        # An eigenvalue below the rounding of the largest one is zero.
        self.able = self.values > dim * np.finfo(float).eps * max(abs(float(values[-1])), 0.0)
        self.scale = np.where(self.able, 1 / np.sqrt(np.where(self.able, self.values, 1.0)), np.nan)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums) @ self.vectors * self.scale


def whiten(rows: DataFrame, components: int = COMPONENTS, multiplicity: bool = False) -> DataFrame:
    """``rows`` has x (array<long>, no nulls in it) and other columns, which stay.
    A row per row and component: component, dim, n (the weights' sum), deviation
    (sum over dimensions of (n*x - S)^2, decimal(38,0)), whitened, explained,
    identity_error. ``multiplicity``: equal vectors count as often as they occur
    in the fit, else once."""
    fit = distinct_vectors(rows, multiplicity)
    mean = moments(fit)
    centre = lambda dim, x: _centred(x, *mean[dim])
    fits = {dim: Fit(*mean[dim], _symmetric(cells, dim, mean[dim][0]), components) for dim, cells in _products(fit, "x", centre).items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, at, x in _groups(b, "x"):
                own = fits[dim]
                out = b[["x", "dim", "weight"]].iloc[at].assign(deviation=_deviations(x, own.n, own.sums))
                out["whitened"] = list(own.whiten(x))
                yield out

    schema = "x array<long>, dim int, weight long, deviation string, whitened array<double>"
    done = stored(fit.mapInPandas(run, schema), "whitened")
    # The whitened covariance, from the whitened values themselves: their sums are one more moment.
    gaps = _identity_errors(done, fits)
    said = [(dim, k + 1, f.n, float(f.values[k] / f.trace) if f.trace > 0 else None, gaps[dim]) for dim, f in fits.items() for k in range(len(f.values))]
    spark = rows.sparkSession
    facts = spark.createDataFrame(said, "dim int, component int, n long, explained double, identity_error double")
    per = facts.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("component", "n", "explained", "identity_error"))).alias("_facts"))
    values = F.transform("_facts", lambda f, k: f.withField("whitened", F.when(~F.isnan(F.get("whitened", k)), F.get("whitened", k))))
    # Broadcast: one row per vector length that occurs.
    each = done.join(F.broadcast(per), "dim").select("x", "dim", F.col("deviation").cast("decimal(38,0)").alias("deviation"), values.alias("_facts"))
    back = rows.join(each, "x").select(*(rows[c] for c in rows.columns if c != "x"), "dim", "deviation", F.explode("_facts").alias("_f"))
    return back.select("*", "_f.component", "_f.n", "_f.whitened", "_f.explained", "_f.identity_error").drop("_f")


def _identity_errors(done: DataFrame, fits: dict[int, Fit]) -> dict[int, float | None]:
    """Per vector length, the largest absolute entry of the whitened values' covariance minus the identity."""
    cells = done.select("dim", "weight", F.posexplode("whitened").alias("at", "w")).filter("w IS NOT NULL AND NOT isnan(w)")
    mean: dict[int, np.ndarray] = {dim: np.zeros(len(f.values)) for dim, f in fits.items()}
    for r in cells.groupBy("dim", "at").agg(F.sum(F.col("weight") * F.col("w")).alias("s")).collect():
        mean[r["dim"]][r["at"]] = r["s"] / fits[r["dim"]].n
    able = {dim: f.able for dim, f in fits.items()}
    products = _products(done, "whitened", lambda dim, w: (w - mean[dim])[:, able[dim]])
    out: dict[int, float | None] = {}
    for dim, f in fits.items():
        size = int(f.able.sum())
        gap = np.abs(_symmetric(products.get(dim, {}), size, f.n) - np.eye(size))
        out[dim] = float(gap.max()) if size else None
    return out


def op11_whiten(spark, sf_dir: str) -> DataFrame:
    """Each distinct vector counts once. A deviation beyond a long is an error, not a wrong number."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = vectors.select("vec_id", whole(F.col("embedding"), SCALE).alias("x")).filter("x IS NOT NULL")
    out = whiten(rows)
    return out.select("vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error")
