"""Helpers shared by the corpus operators.

Intermediates that are read more than once are written as Parquet under the
folder the cluster names in ``spark.checkpoint.dir`` (``stored``), which cuts
the lineage and survives lost executors.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import checkpoint_root

WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_serial = itertools.count()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, unique within the application."""
    root = checkpoint_root(spark, allow_local=True)
    if root is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    return f"{root}/vitrine-llm/{app}/{next(_serial)}-{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the reader of that table."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the path, for ``discard``. For packed columns: they are not compressed again."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "uncompressed").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str | None) -> None:
    """Delete an intermediate that nothing reads any more."""
    if path:
        place, inner = file_system(path)
        place.delete_dir(inner)


def bucketed(df: DataFrame, n: int, column: str, name: str) -> DataFrame:
    """Write ``df`` as a table of n buckets by ``column``, as its partitions come: joins and
    groupings by the column then move the other side only."""
    spark = df.sparkSession
    table_name = f"vitrine_blocks_{uuid.uuid4().hex}"
    df.write.bucketBy(n, column).option("path", shared_path(spark, name)).option("compression", "zstd").saveAsTable(table_name)
    return spark.table(table_name)


def release(spark: SparkSession) -> None:
    """Delete this application's intermediates, when no result that reads them is needed any more."""
    folder = shared_path(spark, "").rsplit("/", 1)[0]
    own = folder.rsplit("/", 2)[1] + "/" + folder.rsplit("/", 2)[2]
    for t in spark.catalog.listTables():
        if t.name.startswith("vitrine_blocks_"):
            said = spark.sql(f"DESCRIBE TABLE EXTENDED `{t.name}`").where("col_name = 'Location'").collect()
            if any(f"/{own}/" in r["data_type"] for r in said):
                spark.sql(f"DROP TABLE `{t.name}`")
    place, path = file_system(folder)
    if place.get_file_info(path).type != fs.FileType.NotFound:
        place.delete_dir(path)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI (file, HDFS, S3, ...) and the path in it."""
    return fs.FileSystem.from_uri(re.sub("^(file:)?/+", "file:///", uri))


def words(text: Column) -> Column:
    """All runs of bytes other than space and the controls 9 to 13."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


def doc_key(text: Column) -> Column:
    """With doc_id, names a document: rows equal in both are one document."""
    return F.xxhash64(text)


def n_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# -- 64-bit rolling hashes over numpy arrays (arithmetic modulo 2^64) ---------


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    @staticmethod
    def _grow(have: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(have) < n:
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        return have

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = self._grow(self.up, self.base, n)
            self.down = self._grow(self.down, self.inverse, n)
        return self.up[:n], self.down[:n]


BASE_1 = Powers(0x9E3779B97F4A7C15)
BASE_2 = Powers(0xD6E8FEB86659FD93)


def prefix_sums(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Prefix sums of values[i] * base^i, one longer than ``values``."""
    up, _ = powers.get(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of values[start:end] for every pair, independent of the position."""
    _, down = powers.get(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start])


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def word_bounds(data: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word of a UTF-8 text; ``gaps`` marks the bytes between words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = gaps[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([[0], edge])
    if not gap[-1]:
        edge = np.concatenate([edge, [len(data)]])
    return edge[0::2], edge[1::2]


def text_bytes(text: str | None, fold: bool = False) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return _FOLD[data] if fold else data


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans: sorted, disjoint and not touching."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    first = np.concatenate([[True], s[1:] > e[:-1]])
    last = np.concatenate([first[1:], [True]])
    return s[first], e[last]


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Cut batches that are sorted by ``keys`` so that no group is divided.
    Holds one batch and the group at its end."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = np.ones(len(batch), bool)
        for k in keys:
            last &= (batch[k] == batch[k].iloc[-1]).to_numpy()
        cut = int(last.argmax())
        if cut == 0 and held and all(held[-1][k].iloc[-1] == batch[k].iloc[0] for k in keys):
            held.append(batch)
            continue
        done = pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
        held = [batch.iloc[cut:]]
        if len(done):
            yield done
    if held:
        yield pd.concat(held, ignore_index=True)


def table(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    """A batch of plain Python values, where None is null."""
    return pd.DataFrame(rows, columns=columns, dtype=object)


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in arrays sorted by all ``keys``."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
