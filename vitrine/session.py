"""Spark session settings and the shared folder for materialised tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every plan in this package. AQE re-plans joins from
# runtime sizes (a size-checked broadcast with sort-merge as the fallback),
# coalesces small shuffle partitions and splits skewed ones.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    # Delete checkpoint files of intermediates once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "vitrine",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster leave ``master`` as None so spark-submit decides. Shuffle
    partitions default to Spark's own value; AQE coalesces them at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    return d or None


def checkpoint_root(spark: SparkSession, allow_local: bool = False) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Returns None when it is unset, unless ``allow_local`` is true and the
    session runs in local mode (tests): then a fresh scratch folder is made and
    registered, since a single machine is all there is.
    """
    d = _configured_checkpoint_dir(spark)
    if d:
        return d.rstrip("/")
    if allow_local and spark.sparkContext.master.startswith("local"):
        d = tempfile.mkdtemp(prefix="vitrine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(d)
        return d
    return None
