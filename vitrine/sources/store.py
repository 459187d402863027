"""The stored ``products`` table: derive once, then every analysis scans it.

The reference loads its documents into one collection and runs every pipeline
against it. The Spark equivalent is one Parquet table. Deriving it from the
driver tables costs three large joins; doing that per query would repeat the
biggest shuffle of the whole workload fifteen times, so the table is written
once per session to the shared folder named by ``spark.checkpoint.dir`` (it
survives executor loss, unlike a cache) and read back with column pruning and
filter pushdown into the nested structs.

A local session without that setting writes to a scratch folder of its own. A
failed write fails the query. The table is kept per session and path; after
replacing data under the same path, call ``forget``.
"""

from __future__ import annotations

import math
import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import checkpoint_root
from vitrine.sources.driver_tables import KEYS, listing_id, listing_view, read_table

_WRITTEN: dict[tuple[str, str], DataFrame] = {}
_LOCK = threading.Lock()


# Columns the selective analyses filter on by equality (J1, J5: gender and
# color; the J5 range: color and material). Clustering each written file by
# them gives Parquet row groups narrow min/max ranges, so those scans skip
# most row groups; low-cardinality leading columns also compress better. A seller's
# listings follow each other where these agree, and so does what is written from them.
CLUSTER_BY = ("gender_target", "color", "material", "l_suppkey")
MAX_RECORDS_PER_FILE = 20_000_000
# Columns with many values in which one is looked up (T1's second pass: its winner's
# listings), and that the order above does not cluster. Row groups without any of the
# value's rows are skipped by their Bloom filters, or by their dictionary where a row
# group has few enough values for one.
LOOKED_UP = ("seller.id",)
# What a task of the build sorts, whatever the size of the tables: about this many rows
# (some 150 MB), and as many bytes of a shuffle. Beyond MAX_PARTITIONS the session's own
# ``spark.sql.shuffle.partitions`` decides.
ROWS_PER_PARTITION = 400_000
BYTES_PER_PARTITION = "16m"
MAX_PARTITIONS = 10_000
# The joins shuffle every listing three times, some 200 bytes of disk each, beside 30
# bytes that are stored. They are made of shares of about this many rows, one after the
# other, and a share's shuffles are deleted before the next.
ROWS_PER_SHARE = 20_000_000
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, root: str, name: str, cluster_by=(), looked_up=()) -> str:
    """Write ``df`` as Parquet under the shared folder and return its path.

    Each task sorts its own rows by ``cluster_by`` (no extra shuffle) and
    splits its output past ``MAX_RECORDS_PER_FILE`` rows. Row groups have a Bloom
    filter of the columns ``looked_up``, as large as the values that occur need.
    """
    path = f"{root}/vitrine/{name}-{uuid.uuid4().hex[:12]}"
    if cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    _write(df, path, "errorifexists", looked_up)
    return path


def _write(df: DataFrame, path: str, mode: str, looked_up) -> None:
    writer = df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", "zstd")
    for column in looked_up:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
    writer.option("parquet.bloom.filter.adaptive.enabled", True).parquet(path)


def build_session(spark: SparkSession, rows: int) -> SparkSession:
    """A session with the settings of ``spark``, but partitions that a task can sort in
    memory for a table of ``rows`` listings."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    wanted = min(math.ceil(rows / ROWS_PER_PARTITION), MAX_PARTITIONS)
    for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"):
        now = own.conf.get(key, None)
        if now is not None:
            own.conf.set(key, str(max(int(now), wanted)))
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", BYTES_PER_PARTITION)
    own.conf.set(CLEAN_UP, "true")
    return own


def build(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Store the listings of ``sf_dir``, share by share, and return the path. ``id`` is
    left out: it is made of the stored keys."""
    rows = read_table(spark, sf_dir, "lineitem").count()
    shares = max(1, math.ceil(rows / ROWS_PER_SHARE))
    own = build_session(spark, math.ceil(rows / shares))
    path = f"{root}/vitrine/listings-{uuid.uuid4().hex[:12]}"
    for i in range(shares):
        _write(listing_view(own, sf_dir, CLUSTER_BY, (i, shares)).drop("id"), path, "append" if i else "errorifexists", LOOKED_UP)
    return path


def listings(spark: SparkSession, sf_dir: str, *, stored: bool = True) -> DataFrame:
    """The listing table for ``sf_dir``, stored as Parquet (or, unless ``stored``, the lazy view)."""
    if not stored:
        return listing_view(spark, sf_dir)
    root = checkpoint_root(spark, allow_local=True)
    if root is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _LOCK:  # queries started from several threads derive the table once
        table = _WRITTEN.get(key)
        if table is None:
            # One DataFrame per session: the file listing and footer are
            # read once, not per query.
            stored = spark.read.parquet(build(spark, sf_dir, root))
            table = stored.select(*KEYS, listing_id().alias("id"), *(c for c in stored.columns if c not in KEYS))
            _WRITTEN[key] = table
    return table


def shares(table: DataFrame, rows: int) -> list[DataFrame]:
    """A table read from files, in shares of whole files that have about as many rows each,
    ``rows`` at most but for one file. A share's scan opens its own files only. What is
    not read from files is one share."""
    if not table.inputFiles():
        return [table]
    file = F.col("_metadata.file_path")
    counts = sorted(table.groupBy(file.alias("file")).count().collect())  # a row per file
    total = sum(n for _, n in counts)
    n_shares = math.ceil(total / rows)
    if n_shares < 2:
        return [table]
    groups: list[list[str]] = [[]]
    held = 0
    for name, n in counts:
        if groups[-1] and held + n > total / n_shares:
            groups.append([])
            held = 0
        groups[-1].append(name)
        held += n
    return [table.where(file.isin(g)) for g in groups]


def forget(spark: SparkSession | None = None) -> None:
    """Drop the per-session registry (the files stay in the shared folder)."""
    if spark is None:
        _WRITTEN.clear()
        return
    app = spark.sparkContext.applicationId
    for k in [k for k in _WRITTEN if k[0] == app]:
        del _WRITTEN[k]
