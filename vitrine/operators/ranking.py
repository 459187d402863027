"""Top-k, rank, argmax and mode per group.

Scale notes
-----------
* ``top_k_per_group`` filters ``row_number() <= k`` directly on the window, so
  Catalyst inserts ``WindowGroupLimit`` on both sides of the shuffle: each map
  task keeps at most k rows per key before anything moves, so a hot key
  cannot pile its raw rows into one task.
* ``argmax_per_group`` and ``mode_per_group`` are aggregates (``min_by`` over
  a struct key) with a partial step on the map side: one small row per key and
  task crosses the shuffle. A struct buffer is not fixed-width, so Spark runs
  them as sort aggregates; they are applied to aggregates, not raw rows.
* ``rank_per_group`` sorts globally and adds per-partition offsets, so no
  group, whatever its size, is sorted in one task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The numbering goes to the executors by value, which so need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Order = Sequence[Column | str | tuple[str | Column, str]]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def order_columns(order: Order) -> list[Column]:
    """``[("count", "desc"), "name"]`` -> sort columns. Ascending puts nulls
    first and descending puts them last, as both Spark and the document store
    do by default."""
    out: list[Column] = []
    for o in order:
        if isinstance(o, tuple):
            c, d = _col(o[0]), o[1].lower()
            out.append(c.desc_nulls_last() if d == "desc" else c.asc_nulls_first())
        else:
            out.append(_col(o).asc_nulls_first())
    return out


def top_k_per_group(
    df: DataFrame, keys: Sequence[str | Column], order: Order, k: int, rank_col: str = "rank"
) -> DataFrame:
    """Keep the first ``k`` rows of each group under ``order``.

    ``rank_col`` holds 1..k as bigint. ``order`` must end in columns that make
    it total inside a group, or ties fall arbitrarily.
    """
    w = Window.partitionBy(*[_col(k_) for k_ in keys]).orderBy(*order_columns(order))
    ranked = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))


def rank_per_group(df: DataFrame, keys: Sequence[str], order: Order, rank_col: str = "rank") -> DataFrame:
    """Number every row of its group 1..n under ``order`` (W2); ties get
    distinct numbers (``order`` should make the order total). The rows come in
    order of (keys, ``order``).

    One plan for every size; no group is held in one task.

    1. Sort globally by (keys, order): range partitioning cuts a hot key
       into many partitions. The sorted result is stored (reliable
       checkpoint), which pins each row's partition and place.
    2. Count rows per (partition, key). At most one group of a partition began
       in an earlier one; how many rows it had there is its offset, one number
       per partition.
    3. Run over each sorted partition on Arrow batches and count from the
       group's start, or on from the offset. Nothing moves, so the order stays.
    """
    from vitrine.operators.materialize import reuse

    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + order_columns(order)
    ordered = reuse(df.orderBy(*sort_cols)).withColumn("_pid", F.spark_partition_id())
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = ordered.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"))
    went_on = counts.withColumn("_off", F.sum("_n").over(before)).where("_off > 0").select("_pid", "_off")
    offsets = {r["_pid"]: r["_off"] for r in went_on.collect()}  # at most one row per partition
    out = T.StructType([*df.schema.fields, T.StructField(rank_col, T.LongType(), True)])
    return ordered.mapInArrow(_numbering(list(keys), df.columns, offsets, rank_col), out)


def _numbering(keys: list[str], columns: list[str], offsets: dict[int, int], rank_col: str):
    """Number the rows of one sorted partition's batches by runs of equal keys."""

    def differs(a: pa.Array, b: pa.Array) -> np.ndarray:
        other = pc.fill_null(pc.not_equal(a, b), False)
        if pa.types.is_floating(a.type):  # a NaN is the same key as another
            other = pc.and_not(other, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        return pc.or_(other, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None
        count = 0  # rows so far of the run at the end of the last batch
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for k in keys:
                column = batch.column(k)
                new[1:] |= differs(column.slice(1), column.slice(0, n - 1))
                if last is not None:
                    new[0] |= bool(differs(column.slice(0, 1), last.column(k))[0])
            if last is None:
                count = offsets.get(batch.column("_pid")[0].as_py(), 0)
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))
            rank = np.where(start >= 0, at - start + 1, at + 1 + count)
            count, last = int(rank[-1]), batch.slice(n - 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(rank, pa.int64())], names=[*columns, rank_col])

    return run


def _ascending_key(order: Order) -> Column:
    """A struct whose ascending order equals ``order``.

    Descending numeric columns are negated; a leading null flag keeps their
    nulls last. Descending text has no such trick and is refused.
    """
    fields: list[Column] = []
    for i, o in enumerate(order):
        c, d = (_col(o[0]), o[1].lower()) if isinstance(o, tuple) else (_col(o), "asc")
        if d == "desc":
            fields.append(c.isNull().alias(f"n{i}"))
            fields.append((-c).alias(f"v{i}"))
        else:
            fields.append(c.alias(f"v{i}"))
    return F.struct(*fields)


def argmax_expr(value: Column, order: Order) -> Column:
    """Aggregate: ``value`` of the first row under ``order``."""
    return F.min_by(value, _ascending_key(order))


def argmax_per_group(
    df: DataFrame, keys: Sequence[str], order: Order, values: Sequence[str], extra_aggs: Sequence[Column] = ()
) -> DataFrame:
    """Per group, the ``values`` of its first row under ``order``.

    One aggregate: ``min_by(struct(values), key)`` combines partially on the
    map side, so skewed keys stay cheap.
    """
    pick = argmax_expr(F.struct(*[F.col(v) for v in values]), order).alias("_pick")
    out = df.groupBy(*keys).agg(pick, *extra_aggs)
    others = [a for a in out.columns if a not in keys and a != "_pick"]
    return out.select(*keys, *[F.col(f"_pick.{v}").alias(v) for v in values], *others)


def mode_per_group(
    df: DataFrame, keys: Sequence[str], value: str | Column, name: str = "mode", count_name: str = "mode_count"
) -> DataFrame:
    """Most frequent ``value`` per group, ties to the smallest.

    Two aggregates (per value, then argmax per group) instead of a per-group
    hash map, so memory does not grow with the number of distinct values.
    """
    v = _col(value)
    counted = df.groupBy(*keys, v.alias(name)).agg(F.count(F.lit(1)).alias(count_name))
    return argmax_per_group(counted, keys, [(count_name, "desc"), (name, "asc")], [name, count_name])
