"""Windows over groups of any size.

Rows are range-partitioned by group and order; a run is what one partition
holds of the table. A window over (group, run) holds a run at most. The few
groups that reach over several runs carry on from one run to the next: a run
has at most one such group that came in and one that goes on, so what the
earlier runs add up to is a table of at most two rows per run, which is
broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from vitrine.llm.common import n_buckets, stored

RUN_ROWS = 1 << 18


def in_runs(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int) -> DataFrame:
    """``df`` with its run as ``_run``, stored. ``rows``: how many it has. ``order``
    is total, so that a group is cut anywhere."""
    n = max(n_buckets(df.sparkSession), -(-rows // RUN_ROWS))
    dealt = df.repartitionByRange(n, *(F.col(k).asc_nulls_first() for k in keys), *order)
    return stored(dealt.withColumn("_run", F.spark_partition_id()), "runs")


def within(keys: Sequence[str], order: Sequence[Column]) -> WindowSpec:
    """The window of a group's rows of one run, up to the current one."""
    return Window.partitionBy(*keys, "_run").orderBy(*order)


def spanning(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """(keys, _run, aggregates) of the groups that have rows in several runs: at
    most two rows per run. Such a group is the last of one run and the first of
    the next, so it is found among the runs' ends."""
    group = F.struct(*keys)
    ends = df.groupBy("_run").agg(F.min(group).alias("low"), F.max(group).alias("high"))
    ends = ends.select("_run", F.explode(F.array("low", "high")).alias("_g"))
    several = ends.groupBy("_g").agg(F.min("_run").alias("a"), F.max("_run").alias("b")).filter("a < b")
    several = F.broadcast(several.select(*(F.col(f"_g.{k}").alias(f"_{k}") for k in keys)))
    held = [df[k].eqNullSafe(several[f"_{k}"]) for k in keys]
    return df.join(several, _all(held), "left_semi").groupBy(*keys, "_run").agg(*aggregates)


def carried(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], carry: Callable[[WindowSpec], Sequence[Column]]) -> DataFrame:
    """``df`` with the columns that ``carry`` makes, from the window of a group's runs in
    order, out of the group's aggregates; null where a group lies within one run."""
    parts = spanning(df, keys, aggregates)
    made = carry(Window.partitionBy(*keys).orderBy("_run"))
    small = F.broadcast(parts.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_run").alias("_r"), *made))
    out = df.join(small, _all([df[k].eqNullSafe(small[f"_{k}"]) for k in keys]) & (df["_run"] == small["_r"]), "left")
    return out.drop(*(f"_{k}" for k in keys), "_r")


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def earlier(w: WindowSpec) -> WindowSpec:
    """Of the window of a group's runs: those before the current one."""
    return w.rowsBetween(Window.unboundedPreceding, -1)
