"""Mixing sources to target weights (DataFrame functions only).

Sources in code-point order, nulls last, take the weights of a repeating
cycle. Their targets share all words by weight, but none exceeds ``max_rate``
times its source's words; what is above is shared again by weight. A source's
target over its words is its repetition rate: every document is taken
floor(rate) times, plus once more when a hash of the document falls below the
fraction.

Defined cases: a null text has no words; a source without words has target 0
and its documents are taken 0 times; null is a source of its own; rows that
repeat id and text get the same decision; an empty table gives no rows. Other
columns pass through ``mix``; the columns that ``mix_plan`` adds replace input
columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitrine.llm.common import WORD, n_buckets, stored, word_count

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = "mix-1"


def _source_weights(docs: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """One row per source with its words and weight. The rank of a source is its
    place inside its range partition plus the sizes of the partitions before."""
    spark = docs.sparkSession
    totals = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = totals.repartitionByRange(n_buckets(spark), F.col("source").isNull(), F.col("source"))
    placed = ordered.sortWithinPartitions(F.col("source").isNull(), F.col("source")).withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed, "sources").withColumns(
        {"part": F.shiftright("at", 33), "place": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    # One row per range partition, so the window's input is bounded by their number.
    before = placed.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.orderBy("part")) - F.col("n")
    )
    rank = F.col("place") + F.col("before")
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights)).cast("int") + 1)
    return placed.join(before, "part").select("source", "source_size", weight.cast("long").alias("weight"))


def source_targets(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """source, source_size, target for every source of ``docs`` (source, size).

    Each round gives the sources that are not yet at their limit equal words
    per weight; those that would pass the limit stop there. Rounds end when
    none passes it. A round is one aggregate over the table of sources."""
    sources = stored(_source_weights(docs, weights), "weights")
    limit = F.col("source_size") * max_rate
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    rest, shared = total, None
    while True:
        # A source is at its limit when limit <= weight * rest / shared.
        at_limit = F.lit(False) if shared is None else limit * shared <= F.col("weight") * F.lit(rest)
        row = sources.agg(
            F.coalesce(F.sum(F.when(at_limit, limit)), F.lit(0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~at_limit, F.col("weight"))), F.lit(0)).alias("shared"),
        ).first()
        new = (total - row["stopped"], row["shared"])
        if new == (rest, shared) or not row["shared"]:
            break
        rest, shared = new
    if not shared:
        return sources.select("source", "source_size", F.lit(0.0).alias("target"))
    fair = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(shared))
    target = F.when(limit * shared <= F.col("weight") * F.lit(rest), limit.cast("double")).otherwise(fair)
    return sources.select("source", "source_size", target.alias("target"))


def _draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken per document."""
    # The row travels as one column, so that no column of its can clash.
    rows = docs.select(F.struct(*docs.columns).alias("row"), word_count(F.col("text")).alias("size"))
    targets = source_targets(rows.select("row.source", "size"), weights, max_rate)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (_draw(F.col("row.doc_id"), F.col("row.text"), seed) < rate - F.floor(rate)).cast("long")
    planned = rows.join(targets, F.col("row.source").eqNullSafe(F.col("source"))).withColumn("copies", copies)
    added = ["size", "source_size", "target", "copies"]
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return planned.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in [*added, "taken"]), *added, taken)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs`` repeated as often as it is taken."""
    row = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", "source")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mix_plan(row, weights, max_rate, seed).filter("copies > 0").select("row", copy).select("row.*")


def op1_mix(spark, sf_dir: str) -> DataFrame:
    plan = mix_plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


_W = "CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END"
OP1_CTES = f"""
sized AS (SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM {{docs}}),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
wts AS (SELECT source, source_size, ({_W})::BIGINT AS weight FROM src),
run AS (SELECT *,
  coalesce(sum(3 * source_size) OVER w, 0) AS stopped, coalesce(sum(weight) OVER w, 0) AS used,
  sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM wts WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
-- The first source, by limit per weight, that stays below its limit fixes the level of all later ones.
lvl AS (SELECT total - stopped AS rest, weights - used AS shared FROM run
  WHERE 3 * source_size * (weights - used) > weight * (total - stopped)
  ORDER BY source_size::DOUBLE / weight, source IS NULL, source LIMIT 1),
tgt AS (SELECT w.source, w.source_size,
  CASE WHEN l.shared IS NULL THEN 0.0::DOUBLE
       WHEN 3 * w.source_size * l.shared <= w.weight * l.rest THEN (3 * w.source_size)::DOUBLE
       ELSE (w.weight * l.rest)::DOUBLE / l.shared::DOUBLE END AS target
  FROM wts w LEFT JOIN lvl l ON true),
rated AS (SELECT s.*, t.source_size, t.target,
  CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
  FROM sized s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (SELECT *, (floor(rate) + CASE WHEN
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT::DOUBLE
  / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM rated)
"""
OP1_SQL = f"WITH {OP1_CTES.format(docs='documents')} SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM mixed"
