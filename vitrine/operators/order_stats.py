"""Exact order statistics at index ``floor(n * q)`` and banding by cut points.

The reference sorts every row into one array and indexes it (A17). That puts
the table in one place. Here all targets are found in three scans:

1. ``n``, the range, and one KLL sketch of the values. The target index is
   ``k = floor(n * q)`` (0-based). The sketch's rank error has a known bound
   (``rank_error``), so it gives each target two values that enclose it.
2. Exact counts of the rows below, at and between these two values, and one KLL
   sketch of the rows in between. A target at one of the two is found; another
   gets two closer values from the inner sketch.
3. The rows between those are counted by value; with the count of the rows below
   them, the running sum reaches the target's index at its value.

The counts are exact, so a bound that fails (it holds with a probability, and a
caller may ask for a narrower one) only costs more scans: the target is then in
a known region, which gets a sketch of its own. Of n rows, about ``(2 * margin)^2``
reach the last step, some millionths by default, and only one row per value leaves
the tasks. All passes are scans with partial aggregation and filters that reach
the Parquet scan; the driver sees sketches of some 100 KB and a few numbers.

KLL sketches are made of longs: whole numbers, and decimals of up to 18 digits by
their unscaled value. Other types (doubles, wide decimals) are narrowed by probes
instead, at two scans a round: each target keeps an *open* interval of values and
the number of rows below it; a round probes it at three values around the
target's rank (``percentile_approx`` over the interval's rows) and counts the rows
below, at and between the probes. Every round drops the rows at its probes, so a
spike of ties leaves at once, and a round leaves about ``2 * margin`` of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_K = 8192
PROBE_MARGIN = 0.002  # of the narrowing by probes


@dataclass
class _Interval:
    """Rows with ``lo < v < hi`` (None: unbounded); ``below`` rows have ``v <= lo``."""

    k: int
    lo: object
    hi: object
    below: int
    inside: int
    probes: list
    answer: object = None
    solved: bool = False
    sketch: bytes | None = None

    def holds(self, x: Column) -> Column:
        cond = F.lit(True)
        if self.lo is not None:
            cond = cond & (x > F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (x < F.lit(self.hi))
        return cond

    def counts(self, x: Column, i: int) -> list[Column]:
        """The counts that ``narrow`` takes, as ``c{i}_0``, ``c{i}_1`` ..."""
        aggs = []
        edges = [None, *self.probes, None]
        for j, (lo, hi) in enumerate(zip(edges, edges[1:])):
            between = self.holds(x)
            if lo is not None:
                between = between & (x > F.lit(lo))
            if hi is not None:
                between = between & (x < F.lit(hi))
            aggs.append(F.count_if(between).alias(f"c{i}_{2 * j}"))
            if hi is not None:
                aggs.append(F.count_if(x == F.lit(hi)).alias(f"c{i}_{2 * j + 1}"))
        return aggs

    def narrow(self, counts: list[int]) -> None:
        """``counts``: below the first probe, at it, up to the second, at it, ... above the last."""
        edges = [self.lo, *self.probes, self.hi]
        at = self.below
        for i, n in enumerate(counts):
            if at <= self.k < at + n:
                if i % 2:
                    self.answer, self.solved = self.probes[i // 2], True
                else:
                    self.lo, self.hi, self.below, self.inside = edges[i // 2], edges[i // 2 + 1], at, n
                return
            at += n
        raise AssertionError("the target is always in one of the classes")


@dataclass
class OrderStats:
    """Size and range of the non-null values, and the answer per fraction."""

    n: int
    minimum: object
    maximum: object
    indices: list[int]
    values: list
    rounds: int
    scans: int


def rank_error(k: int) -> float:
    """Bound of a KLL sketch's error of a rank, as a share of the rows, at 99% confidence."""
    return 2.296 / k**0.9723


def _long_code(kind: T.DataType) -> tuple[Callable[[Column], Column], Callable[[int], object]] | None:
    """How values of an exact type become longs in the same order, and back."""
    if isinstance(kind, T.IntegralType):
        return lambda x: x.cast("bigint"), int
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        unit = F.lit(Decimal(10) ** kind.scale)
        return lambda x: (x * unit).cast("bigint"), lambda v: Decimal(v).scaleb(-kind.scale)
    return None


def order_stats(
    df: DataFrame, value: str | Column, fractions: Sequence[float], *, accuracy: int = SKETCH_K, margin: float | None = None
) -> OrderStats:
    """Exact values at the 0-based sorted index ``floor(n * q)`` of the non-null ``value``.

    ``accuracy`` is the sketch's size (KLL's k, 8 to 65535) and ``margin`` how far around
    a target's relative rank the enclosing values lie, by default three times the
    sketch's error bound. Both only decide how many scans it takes."""
    col = F.col(value) if isinstance(value, str) else value
    v = df.select(col.alias("v")).where(F.col("v").isNotNull())
    code = _long_code(v.schema["v"].dataType)
    if code is None:
        return _by_probes(v, fractions, max(accuracy, 100), PROBE_MARGIN if margin is None else margin)
    k = min(max(accuracy, 8), 65535)
    return _by_sketches(v, fractions, k, 3 * rank_error(k) if margin is None else margin, *code)


def _target(n: int, q: float) -> int:
    return min(max(int(math.floor(n * q)), 0), n - 1)


def _by_sketches(v: DataFrame, fractions: Sequence[float], k: int, margin: float, code, decode) -> OrderStats:
    x = F.col("v")
    spark = v.sparkSession
    sketch = lambda rows: F.kll_sketch_agg_bigint(F.when(rows, code(x)), k)
    first = v.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"), sketch(F.lit(True)).alias("s")).first()
    n, scans = first["n"], 1
    if not n:
        return OrderStats(0, None, None, [], [], 0, scans)
    todo = [_Interval(_target(n, q), None, None, 0, n, [], sketch=first["s"]) for q in fractions]
    while active := [t for t in todo if not t.solved]:
        if blank := [t for t in active if t.sketch is None]:
            # Regions that a bound wrongly left out.
            row = v.where(reduce(or_, [t.holds(x) for t in blank])).agg(*(sketch(t.holds(x)).alias(f"s{i}") for i, t in enumerate(blank))).first()
            scans += 1
            for i, t in enumerate(blank):
                t.sketch = row[f"s{i}"]
        _enclose(spark, active, margin, decode)
        between = [t.holds(x) & (x > F.lit(t.probes[0])) & (x < F.lit(t.probes[-1])) for t in active]
        aggs = [a for i, t in enumerate(active) for a in t.counts(x, i)]
        aggs += [sketch(b).alias(f"s{i}") for i, b in enumerate(between)]
        row = v.where(reduce(or_, [t.holds(x) for t in active])).agg(*aggs).first()
        scans += 1
        for i, t in enumerate(active):
            lo, hi = t.probes[0], t.probes[-1]
            t.narrow([row[f"c{i}_{j}"] for j in range(2 * len(t.probes) + 1)])
            t.sketch = row[f"s{i}"] if (t.lo, t.hi) == (lo, hi) else None
        if inner := [t for t in active if not t.solved and t.sketch is not None]:
            _enclose(spark, inner, margin, decode)
            _settle(v, inner)
            scans += 1
    return OrderStats(n, first["mn"], first["mx"], [t.k for t in todo], [t.answer for t in todo], scans - 1, scans)


def _enclose(spark: SparkSession, targets: list[_Interval], margin: float, decode) -> None:
    """One or two values around each target, from its interval's sketch (no scan: one row of sketches)."""
    made = spark.createDataFrame([tuple(bytes(t.sketch) for t in targets)], ", ".join(f"s{i} binary" for i in range(len(targets))))
    ends = []
    for i, t in enumerate(targets):
        p = (t.k - t.below + 0.5) / t.inside
        ranks = F.array(F.lit(max(0.0, p - margin)), F.lit(min(1.0, p + margin)))
        ends.append(F.kll_sketch_get_quantile_bigint(f"s{i}", ranks))
    for t, e in zip(targets, made.select(*ends).collect()[0]):
        t.probes = [decode(v) for v in sorted(set(e))]


def _settle(v: DataFrame, targets: list[_Interval]) -> None:
    """Count the rows of each target's enclosing values by value, and those of its interval
    below them in one sum. The running count that passes the target's rank is its value's."""
    x = F.col("v")
    kind = v.schema["v"].dataType
    reach = [t.holds(x) & (x <= F.lit(t.probes[-1])) for t in targets]
    cells = [F.when(r, F.struct(F.lit(i).alias("i"), F.when(x >= F.lit(t.probes[0]), x).cast(kind).alias("v"))) for i, (t, r) in enumerate(zip(targets, reach))]
    rows = v.where(reduce(or_, reach)).select(F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c")).select("c.i", "c.v")
    counted = rows.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy("i").orderBy(x.asc_nulls_first())
    counted = counted.withColumns({"upto": F.sum("n").over(up_to), "all": F.sum("n").over(Window.partitionBy("i"))})
    rank = F.create_map(*(F.lit(z) for i, t in enumerate(targets) for z in (i, t.k - t.below)))[F.col("i")]
    hit = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
    last = F.col("upto") == F.col("all")
    found = {(r["i"], r["hit"]): r for r in counted.select("i", "v", "n", "upto", hit.alias("hit")).where(F.col("hit") | last).collect()}
    for i, t in enumerate(targets):
        lo, hi = t.probes[0], t.probes[-1]
        t.sketch = None
        if (i, True) in found:
            r = found[i, True]
            if r["v"] is not None:
                t.answer, t.solved = r["v"], True
            else:  # below the values thought to enclose it
                t.hi, t.inside = lo, r["n"]
        else:  # above them
            seen = found[i, False]["upto"] if (i, False) in found else 0
            t.lo, t.below, t.inside = hi, t.below + seen, t.inside - seen


def _by_probes(v: DataFrame, fractions: Sequence[float], accuracy: int, margin: float) -> OrderStats:
    x = F.col("v")

    def ranks(p: float) -> list[float]:
        return [max(0.0, p - margin), p, min(1.0, p + margin)]

    sketch = F.percentile_approx("v", [r for q in fractions for r in ranks(min(1.0, max(0.0, q)))], accuracy)
    first = v.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"), sketch.alias("ps")).first()
    n = first["n"]
    if not n:
        return OrderStats(0, None, None, [], [], 0, 1)
    todo = [_Interval(_target(n, q), None, None, 0, n, sorted(set(first["ps"][3 * i : 3 * i + 3]))) for i, q in enumerate(fractions)]
    rounds = 0
    while active := [t for t in todo if not t.solved]:
        rounds += 1
        if rounds > 1:
            aggs = [
                F.percentile_approx(F.when(t.holds(x), x), ranks((t.k - t.below + 0.5) / t.inside), accuracy).alias(f"p{i}")
                for i, t in enumerate(active)
            ]
            row = v.where(reduce(or_, [t.holds(x) for t in active])).agg(*aggs).first()
            for i, t in enumerate(active):
                t.probes = sorted(set(row[f"p{i}"]))
        aggs = [a for i, t in enumerate(active) for a in t.counts(x, i)]
        row = v.where(reduce(or_, [t.holds(x) for t in active])).agg(*aggs).first()
        for i, t in enumerate(active):
            t.narrow([row[f"c{i}_{j}"] for j in range(2 * len(t.probes) + 1)])
    return OrderStats(n, first["mn"], first["mx"], [t.k for t in todo], [t.answer for t in todo], rounds, 2 * rounds)


def exact_order_stats(df: DataFrame, value: str | Column, fractions: Sequence[float], **kw) -> DataFrame:
    """One row per fraction: ``fraction, idx, value`` (none without non-null values)."""
    col = F.col(value) if isinstance(value, str) else value
    kind = df.select(col.alias("v")).schema["v"].dataType.simpleString()
    found = order_stats(df, value, fractions, **kw)
    rows = [(float(q), k, a) for q, k, a in zip(fractions, found.indices, found.values)]
    return df.sparkSession.createDataFrame(rows, f"fraction double, idx bigint, value {kind}")


def band_expr(v: Column, cuts: Sequence[Column], labels: Sequence[str]) -> Column:
    """Label of the half-open band ``[cut_i, cut_i+1)`` holding ``v``.

    ``labels`` has one more entry than ``cuts``: below the first cut, between
    each pair, and at or above the last. Null ``v`` gets null.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cut points")
    expr = F.when(v.isNull(), F.lit(None).cast("string"))
    for c, lab in zip(cuts, labels[:-1]):
        expr = expr.when(v < c, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def bands(
    df: DataFrame,
    value: str,
    fractions: Sequence[float],
    labels: Sequence[str],
    band_col: str = "band",
    **kw,
) -> DataFrame:
    """Every row with a non-null ``value`` and its band.

    Cut points are the exact order statistics at ``fractions``, computed once
    and applied as literals; ``labels`` has one more entry than
    ``fractions``.
    """
    if len(labels) != len(fractions) + 1:
        raise ValueError("need one more label than fractions")
    names = [f"c{i}" for i in range(len(fractions))]
    cut = cut_values(df, value, fractions, names, **kw)
    v = F.col(value)
    return df.where(v.isNotNull()).withColumn(band_col, band_expr(v, [F.lit(cut[n]) for n in names], labels))


def cut_values(df: DataFrame, value: str, fractions: Sequence[float], names: Sequence[str], **kw) -> dict:
    """The exact order statistics as a small dict ``name -> value`` (nulls if there are no values)."""
    found = order_stats(df, value, fractions, **kw)
    return dict(zip(names, found.values)) if found.n else {name: None for name in names}
