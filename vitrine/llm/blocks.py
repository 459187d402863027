"""Texts in blocks, and the exchange that tells each block which of its hashes
occur elsewhere.

A block is a row of whole documents of a bounded size (one longer document is
a block of its own). A block sends every distinct hash it has once, packed by
bucket; the task of a bucket sees all hashes of that bucket and replies to each
block. What is hot in the corpus arrives once per block, pre-counted, and no
row is made per word or per byte.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import group_starts, n_buckets, shared_path, stored, table, whole_groups

BLOCK_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max


def text_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None, bucketed: bool = False) -> DataFrame:
    """(block, doc_id array, texts array, rests array), stored. Ids are read as
    long; rests are the columns to ``keep`` as JSON (null if there are none).
    ``bucketed``: as a table bucketed by block, so that joins on the block move
    the other side only; the texts are shuffled once, for the writing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0
        for b in batches:
            for i, t, r in zip(b["doc_id"], b["text"], b["rest"]):
                held.append((None if i is None else int(i), t, r))
                size += len(t or "") + 64
                if size >= block_bytes:
                    yield table([(block, *map(list, zip(*held)))], ["block", "doc_id", "texts", "rests"])
                    block, held, size = block + 1, [], 0
        if held:
            yield table([(block, *map(list, zip(*held)))], ["block", "doc_id", "texts", "rests"])

    rest = F.to_json(F.struct(*keep)) if keep else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text", rest.alias("rest"))
    made = rows.mapInPandas(run, "block long, doc_id array<long>, texts array<string>, rests array<string>")
    if not bucketed:
        return stored(made, "blocks")
    spark = docs.sparkSession
    n, path = n_buckets(spark), shared_path(spark, "blocks")
    name = f"vitrine_blocks_{uuid.uuid4().hex}"
    made.repartition(n, "block").write.bucketBy(n, "block").option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


PACKET = "bucket int, block long, hashes binary, counts binary, marked binary, ids binary, keys binary, rows binary"
REPLY = "block long, hashes binary, totals binary, first binary"


def fold(hashes: np.ndarray, buckets: int, short: bool) -> np.ndarray:
    """The value a hash is compared by. Short ones keep the bucket and 32 bits."""
    if not short:
        return hashes
    bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
    return (bucket << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def packets(
    block: int,
    hashes: np.ndarray,
    buckets: int,
    short: bool = False,
    marked: np.ndarray | None = None,
    order: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
    by_key: bool = False,
) -> pd.DataFrame:
    """A block's hashes by bucket, each once, with its count. ``marked``: which of
    them count as indexed (all, if None). ``order``: document id, text key and
    row of each hash; the smallest of a hash goes along."""
    values = fold(hashes, buckets, short)
    if order is not None:
        same = [values, order[1]] if by_key else [values]
        at = np.lexsort((order[2], order[1], order[0], *same[::-1]))
        first = group_starts(*(x[at] for x in same))
        values = values[at]
        unique, counts = values[first], np.diff(np.append(first, len(values)))
        ids, keys, rows = (o[at][first] for o in order)
    else:
        unique, counts = np.unique(values, return_counts=True)
    mark = None if marked is None else np.isin(unique, np.unique(values[marked] if marked.dtype == bool else marked))
    bucket = ((unique >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    by = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[by])) + 1
    kind = np.uint32 if short else np.uint64
    counts = np.minimum(counts, 65535).astype(np.uint16)
    out = []
    for part in np.split(by, cut):
        if not len(part):
            continue
        pick = lambda a: a[part].tobytes()  # noqa: E731, B023
        out.append(
            (
                int(bucket[part[0]]),
                block,
                unique[part].astype(kind).tobytes(),
                b"" if (counts[part] == 1).all() else pick(counts),
                b"" if mark is None else np.packbits(mark[part]).tobytes(),
                *((pick(ids), pick(keys), pick(rows)) if order is not None else (b"", b"", b"")),
            )
        )
    return pd.DataFrame(out, columns=["bucket", "block", "hashes", "counts", "marked", "ids", "keys", "rows"])


def _reply(short: bool, ordered: bool, by_key: bool):
    kind = np.uint32 if short else np.uint64

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["bucket"]):
            for bucket, part in rows.groupby("bucket", sort=False):
                values = [np.frombuffer(x, kind) for x in part["hashes"]]
                size = np.array([len(v) for v in values])
                every = np.concatenate(values)
                counts = np.concatenate([np.frombuffer(c, np.uint16) if c else np.ones(n, np.uint16) for c, n in zip(part["counts"], size)])
                first = np.zeros(len(every), bool)
                if ordered:
                    ids, keys, at = (np.concatenate([np.frombuffer(x, np.int64) for x in part[c]]) for c in ("ids", "keys", "rows"))
                    same = [every, keys] if by_key else [every]
                    order = np.lexsort((at, keys, ids, *same[::-1]))
                    lead = group_starts(*(x[order] for x in same))
                    first[order[lead]] = True
                    inverse = np.empty(len(every), np.int64)
                    inverse[order] = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(every))))
                    n_unique = len(lead)
                else:
                    unique, inverse = np.unique(every, return_inverse=True)
                    n_unique = len(unique)
                total = np.bincount(inverse, weights=counts, minlength=n_unique).astype(np.int64)
                again = total >= 2
                if (part["marked"].str.len() > 0).any():
                    mark = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool) if m else np.zeros(n, bool) for m, n in zip(part["marked"], size)])
                    again &= np.bincount(inverse, weights=mark, minlength=n_unique) > 0
                hit = again[inverse]
                out = []
                for block, e, n in zip(part["block"], np.cumsum(size), size):
                    got = np.flatnonzero(hit[e - n : e]) + e - n
                    if len(got):
                        value = every[got].astype(np.uint64)
                        if short:
                            value |= np.uint64(bucket) << np.uint64(32)
                        out.append((block, value.tobytes(), np.minimum(total[inverse[got]], 2**31 - 1).astype(np.int32).tobytes(), first[got].tobytes()))
                yield pd.DataFrame(out, columns=["block", "hashes", "totals", "first"])

    return run


def repeated(
    rows: DataFrame, send: Callable[[Iterator[pd.DataFrame], int], Iterator[pd.DataFrame]], short: bool = False, ordered: bool = False, by_key: bool = False
) -> tuple[DataFrame, int]:
    """Run ``send`` (batches of ``rows``, number of buckets -> packets) and gather
    the replies: one row (block, replies: array of hashes, totals, first) per
    block that has a hash that occurs again. Also returns the number of buckets.
    ``ordered``: the packets tell the order, and the reply whether the block holds
    the first. ``by_key``: only hashes with the same text key are the same."""
    n = n_buckets(rows.sparkSession)
    buckets = 2 * n
    sent = rows.mapInPandas(lambda batches: send(batches, buckets), PACKET)
    met = sent.repartition(n, "bucket").sortWithinPartitions("bucket")
    replies = stored(met.mapInPandas(_reply(short, ordered, by_key), REPLY), "replies")
    return replies.groupBy("block").agg(F.collect_list(F.struct("hashes", "totals", "first")).alias("replies")), buckets


class Replies:
    """A block's replies, for looking up its hashes."""

    def __init__(self, replies):
        parts = list(replies) if replies is not None else []
        one = lambda k, kind: np.concatenate([np.frombuffer(p[k], kind) for p in parts]) if parts else np.zeros(0, kind)
        values, total, first = one("hashes", np.uint64), one("totals", np.int32), one("first", bool)
        order = np.argsort(values)
        self.values, self.total, self.first = values[order], total[order], first[order]

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which values are hits, and their places among the replies (where they are)."""
        if not len(self.values):
            return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        return self.values[at] == values, at


def row_number(block: int, index: int) -> int:
    """A document's place by block and index: 24 bits for the partition, 20 for
    the block in it, 19 for the document in the block."""
    block, index = int(block), int(index)
    return ((block >> 32) << 39) | ((block & 0xFFFFF) << 19) | index
