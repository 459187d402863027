"""Incremental listing ingest: new CSV files in a folder become typed,
nested Parquet rows, exactly once.

The batch path (``vitrine.sources.ingest``) and this one share every step:
the same text schema, ``type_listings`` and ``nest_listing``. Structured
Streaming adds the file bookkeeping and the checkpoint, so a restarted or
failed job resumes where it stopped instead of re-reading the folder.

Streaming file sources need the schema up front, so files must carry the full
header in the standard column order (``RAW_COLUMNS``); the batch reader also
accepts files that omit optional columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vitrine.session import checkpoint_root
from vitrine.sources.ingest import ABSENT, MALFORMED, nest_listing, type_listings
from vitrine.sources.schema import RAW_SCHEMA


def read_listing_stream(
    spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None, *, multiline: bool = False
) -> DataFrame:
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(MALFORMED, T.StringType(), True)])
    reader = (
        spark.readStream.schema(schema)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)
        .option("header", True)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", ABSENT)
        .option("enforceSchema", False)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source_dir)


def stream_listings_csv(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    *,
    checkpoint: str | None = None,
    view: str = "full",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    multiline: bool = False,
) -> StreamingQuery:
    """Start the stream. ``available_now`` drains what is there and stops;
    otherwise it keeps polling the folder.

    The checkpoint defaults to a folder under the cluster's
    ``spark.checkpoint.dir``; there is no machine-local fallback.
    """
    if checkpoint is None:
        root = checkpoint_root(spark)
        if root is None:
            raise ValueError("no checkpoint given and spark.checkpoint.dir is unset")
        checkpoint = f"{root}/vitrine/streams/listings"
    docs = nest_listing(type_listings(read_listing_stream(spark, source_dir, max_files_per_trigger, multiline=multiline)), view)
    writer = (
        docs.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", sink_dir)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
