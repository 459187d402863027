"""Leave-one-out means, sums excluding a member, and nested result lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def leave_one_out_mean(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "loo_mean"
) -> DataFrame:
    """Mean of ``value`` over the other rows of the group (W3); null when alone.

    ``(group sum - own value) / (group count - 1)``. With an exact ``value``
    (decimal or integer) the sum is exact and the one division is the only
    rounding. Group sums are a partial hash aggregate joined back on the keys
    (null-safe), so no group has to fit in one task.
    """
    from vitrine.operators.joins import join_on_keys

    sums = df.groupBy(*keys).agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    v = F.col(value)
    out = join_on_keys(df, sums, keys).withColumn(
        name, F.when(v.isNotNull() & (F.col("_c") > 1), (F.col("_s") - v).cast("double") / (F.col("_c") - 1).cast("double"))
    )
    return out.drop("_s", "_c")


def leave_one_out_in_list(
    df: DataFrame,
    keys: Sequence[str],
    member: str,
    value: str,
    name: str = "loo_mean",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Mean of the other members' ``value`` inside a bounded group.

    The reference's own method: gather the group into a list, drop the
    member, average the rest. Sums run left to right in ``member`` order, so
    the floating result is reproducible. Only for groups already cut to a
    known size (after a top-k): each group becomes one row. ``carry`` columns
    ride along unchanged.
    """
    packed = F.struct(
        F.col(member).alias("m"), F.col(value).alias("v"), *[F.col(c).alias(c) for c in carry]
    )
    gathered = df.groupBy(*keys).agg(F.array_sort(F.collect_list(packed)).alias("_g"))

    def others_mean(m: Column) -> Column:
        rest = F.filter(F.col("_g"), lambda x: ~x["m"].eqNullSafe(m) & x["v"].isNotNull())
        total = F.aggregate(rest, F.lit(0.0).cast("double"), lambda acc, x: acc + x["v"].cast("double"))
        return F.when(F.size(rest) > 0, total / F.size(rest).cast("double"))

    # Map over the members and add the result inside each one (transform +
    # withField), then unwind the list back to rows.
    marked = gathered.select(*keys, F.transform("_g", lambda x: x.withField("loo", others_mean(x["m"]))).alias("_g"))
    ex = marked.select(*keys, F.explode("_g").alias("_x"))
    return ex.select(
        *keys,
        F.col("_x.m").alias(member),
        F.col("_x.v").alias(value),
        *[F.col(f"_x.{c}").alias(c) for c in carry],
        F.col("_x.loo").alias(name),
    )


def nest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    name: str,
    position: str | None = None,
    chunk_rows: int = 10_000,
) -> DataFrame:
    """Group rows into an ordered list of structs.

    ``order`` columns lead the struct so ``array_sort`` orders the list, then
    ``transform`` keeps only ``fields``. A group whose size is bounded (after a
    top-k) becomes one row. For groups of any size, ``position`` names a column
    that numbers the rows of a group from 1 in this order; the list is then cut
    into rows ``(keys, chunk, list)`` of ``chunk_rows`` members, ``chunk`` from 0.
    """
    lead = [F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    packed = F.struct(*lead, *[F.col(f).alias(f) for f in fields])
    by = list(keys)
    if position is not None:
        df = df.withColumn("chunk", F.floor((F.col(position) - 1) / F.lit(chunk_rows)).cast("bigint"))
        by.append("chunk")
    out = df.groupBy(*by).agg(F.array_sort(F.collect_list(packed)).alias(name))
    return out.withColumn(
        name, F.transform(F.col(name), lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    )
