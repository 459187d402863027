"""Joins the reference expresses as lookups: scalar, range, inequality, nearest.

No cross joins and no broadcast hints. A one-row side (a global aggregate)
runs once and its values enter the plan as literals (``one_row``). An
inequality join merges both sides in order and is an equi-join on places at every
size; which equi-joins are broadcast is left to the planner and AQE.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.operators.ranking import Order, order_columns, top_k_per_group


def one_row(agg: DataFrame):
    """The single row of a global aggregate (a few values, never data).

    Used for the reference's scalar lookups (L4, L5, the quartile cut
    points): the aggregate runs once as its own distributed job and its
    values enter the main plan as literals, which (unlike a scalar subquery
    result) push down into the Parquet scan.
    """
    rows = agg.take(2)
    if len(rows) != 1:
        raise ValueError(f"expected one row, got {len(rows)}")
    return rows[0]


def above_scalar(df: DataFrame, value: str, total: Column, count: Column) -> DataFrame:
    """Rows whose column ``value`` exceeds the mean of ``value`` over all of ``df``.

    ``sum`` and ``n`` come from one global aggregate (L4, F9): one extra scan,
    run once. On an exact type (decimal, integer) the comparison is exact: the
    mean is rounded down to the type's own step, and a value of that type
    exceeds the mean if and only if it exceeds the rounded one. As a plain
    comparison with a literal it reaches the Parquet scan. On a double the
    literal is the quotient of the two.
    """
    st = one_row(df.agg(total.alias("s"), count.alias("n")))
    kind = df.select(F.col(value).alias("v")).schema["v"].dataType
    if not st["n"]:
        return df.where(F.lit(False))
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return df.where(F.col(value) > F.lit(st["s"] / st["n"]))
    units = int(Decimal(st["s"]).scaleb(scale)) // st["n"]  # floor: the sum is exact
    bound = F.lit(Decimal(units).scaleb(-scale)).cast(kind) if scale else F.lit(units).cast(kind)
    return df.where(F.col(value) > bound)


def inequality_join(
    left: DataFrame,
    right: DataFrame,
    left_value: str,
    right_value: str,
    op: str = "<",
    *,
    on: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """All pairs with ``right[right_value] <op> left[left_value]``.

    Nulls never match. ``on`` adds equality keys present on both sides (null is
    a key like others).

    Both sides are merged in order of their values (``place_by_value``), so each
    right row gets its number among the right rows of its keys and each left row
    the number of right rows that it pairs with: the first so many. Pairs then
    come from an equi-join (``pairs_below``). No value enters the plan.
    ``buckets`` is the number of ranges, by default Spark's.
    """
    if op not in ("<", "<=", ">", ">="):
        raise ValueError(f"unsupported operator {op!r}")
    sign = 1 if op in ("<", "<=") else -1
    lkey, rkey = F.lit(sign) * F.col(left_value), F.lit(sign) * F.col(right_value)  # now "rkey < lkey" (or <=)
    keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(on)]
    others = [c for c in right.columns if c not in on]
    a = left.select(*keys, lkey.alias("_v"), F.lit(False).alias("_right"), F.struct(*left.columns).alias("_l"))
    b = right.select(*keys, rkey.alias("_v"), F.lit(True).alias("_right"), F.struct(*others).alias("_r"))
    rows = a.unionByName(b, allowMissingColumns=True).where("_v IS NOT NULL")
    names = [f"_k{i}" for i in range(len(on))]
    placed = place_by_value(rows, "_v", F.col("_right"), strict=op in ("<", ">"), on=names, ranges=buckets)
    pairs = pairs_below(placed.where(~F.col("_right")), placed.where("_right"), names)
    return pairs.select(F.col("_a._l.*"), F.col("_b._r.*"))


def place_by_value(
    rows: DataFrame, value: str, is_right: Column, *, strict: bool = True, on: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """``rows`` of both sides of an inequality join, stored, with ``_at``: how many right
    rows of the same ``on`` have a smaller ``value`` (unless ``strict``, or the same one). For a
    right row this counts itself, and numbers it from 1. Where ``is_right`` is null a row
    belongs to neither side.

    One range partitioning of all rows cuts both sides at the same bounds. A range counts
    its own right rows in order, and adds those of the earlier ranges (a row per range and
    key). Ties are cut like other rows, as their order among themselves does not matter."""
    from vitrine.operators.materialize import reuse

    right = F.coalesce(is_right, F.lit(False))
    side = right.cast("int") if strict else (~right).cast("int")
    # Without keys, ``_one`` is the one group of the windows; once stored, it is a column like others.
    held = rows.withColumns({"_side": side, "_is": right.cast("bigint"), "_one": F.lit(0), "_tie": F.xxhash64(*rows.columns)})
    order = [F.col(value).asc_nulls_first(), F.col("_side"), F.col("_tie")]
    by = [*(F.col(k).asc_nulls_first() for k in on), *order]
    held = held.repartitionByRange(ranges, *by) if ranges else held.repartitionByRange(*by)
    held = reuse(held.withColumn("_range", F.spark_partition_id()))
    group = [*on, "_one"]
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = held.groupBy(*group, "_range").agg(F.sum("_is").alias("_n"))
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    here = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = held.withColumn("_here", F.sum("_is").over(here))
    placed = join_on_keys(counted, sums, [*group, "_range"]).withColumn("_at", (F.col("_here") + F.col("_before")).cast("bigint"))
    return placed.drop("_side", "_is", "_one", "_tie", "_range", "_here", "_before")


# Right rows that a left row pairs with as a block: 2^8.
_BITS = 8


def pairs_below(left: DataFrame, right: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """(_a, _b): each row of ``left`` with the first ``_at`` right rows of the same ``on``,
    where ``_at`` comes from ``place_by_value``.

    A left row asks for whole blocks of right rows by number, and for the rows of the last
    block one by one, so every key that it joins on has its answers: the work is the output
    plus the two sides."""
    at = F.col("_at")
    none = F.lit(-1).cast("bigint")
    whole, rest = F.shiftright(at, _BITS), at % (1 << _BITS)
    upto = lambda n, make: F.when(n > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), n), make)).otherwise(F.array().cast("array<struct<block:bigint,row:bigint>>"))
    key = lambda block, row: F.struct(block.alias("block"), row.cast("bigint").alias("row"))
    asked = F.concat(upto(whole, lambda i: key(i - 1, none)), upto(rest, lambda i: key(whole, i)))
    place = at - 1
    block = F.shiftright(place, _BITS)
    held = F.array(key(block, none), key(block, place % (1 << _BITS) + 1))
    a = left.select(*on, F.struct(*left.columns).alias("_a"), F.explode(asked).alias("_key")).select(*on, "_a", "_key.block", "_key.row")
    b = right.select(*on, F.struct(*right.columns).alias("_b"), F.explode(held).alias("_key")).select(*on, "_b", "_key.block", "_key.row")
    return join_on_keys(a, b, [*on, "block", "row"]).select("_a", "_b")


def nearest_k(
    joined: DataFrame,
    keys: Sequence[str],
    value: Column,
    target: Column,
    k: int,
    ties: Order = (),
    diff_name: str = "diff",
    rank_col: str = "nearest_rank",
) -> DataFrame:
    """Per ``keys``, the ``k`` rows whose ``value`` is closest to ``target``.

    ``joined`` is already the equi-join of candidates with their target.
    """
    d = joined.withColumn(diff_name, F.abs(value - target))
    return top_k_per_group(d, keys, [(diff_name, "asc"), *ties], k, rank_col)


def lookup(left: DataFrame, right: DataFrame, on: dict[str, str], order: Order, k: int, how: str = "left") -> DataFrame:
    """Per row of ``left``, the first ``k`` rows of ``right`` under ``order`` whose columns
    equal the row's (L1, W6): ``on`` maps columns of ``left`` to columns of ``right``, null
    equals null. ``how`` = "left" keeps rows without any, "inner" drops them.

    A lateral join, whose sub-plan is written as for one outer row. Spark turns it into a
    ranking of ``right`` by these columns, of which each task sends ``k`` rows per key, and an
    equi-join. ``right`` is usually an aggregate; ``order`` must make its order total."""
    same = [F.col(r).eqNullSafe(F.col(name).outer()) for name, r in on.items()]
    found = right.where(reduce(and_, same)).orderBy(*order_columns(order)).limit(k)
    return left.lateralJoin(found.select(*[c for c in right.columns if c not in on.values()]), None, how)


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where null keys match each other (``$expr`` equality treats
    null as equal to null); the right copies of the keys are dropped."""
    cond = [left[k].eqNullSafe(right[k]) for k in keys]
    return left.join(right, cond, how).drop(*[right[k] for k in keys])
