"""Line dedup by a sharded minimal perfect hash.

Each document's lines become keys (white space stripped at both ends, A-Z
lower-cased), and each key of at least ``min_chars`` code points a 128-bit hash.
The distinct hashes are dealt into shards by range. A shard is indexed by a
minimal perfect hash, which gives each of its n hashes a slot of its own below
n, and by three arrays in order of the slots: a fingerprint, the number of
documents that hold the line, and the smallest doc_id that does. Documents do
not meet each other's lines: a block of documents sends its distinct hashes to
the shards, which look them up and tell where another document comes first.

Defined cases: a null or empty text is one empty line; rows that repeat a
doc_id are one document, rows without doc_id are one document after all others
(as the id 2^63 - 1); a key that only one document holds keeps its lines; an
empty table gives no rows; other columns are not read. Two keys are the same if
their 128-bit hashes are.

No task holds more than a shard: their number grows with the lines. A line that
is everywhere is sent once per block, blocks are merged ``FAN`` at a time, and
the lookups of a shard are dealt to one task per ``FAN`` blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import doc_key, group_starts, mix64, n_buckets, stored, table, whole_groups

MIN_CHARS = 10
SHARD_LINES = 1 << 17
BLOCK_CHARS = 4 << 20
BLOCK_LINES = 1 << 16
FAN = 1 << 14
NO_ID = np.iinfo(np.int64).max
_STRIP = b"\x20\x09\x0a\x0b\x0c\x0d"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# -- the minimal perfect hash ---------------------------------------------------


def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix64(high + mix64(low + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF))) % np.uint64(size)


class PerfectHash:
    """Levels of bits: a hash that is alone at its place of a level is settled
    there, the others go on to the next level, half as dense. Its slot is the
    number of set bits before its own, over all levels."""

    GAMMA = 2

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes = sizes
        self.bits = np.frombuffer(bits, np.uint8)
        # Set bits before each byte of the levels.
        self.rank = np.concatenate([[0], np.cumsum(_SET_BITS[self.bits], dtype=np.int64)])

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        """Of distinct pairs (high, low) of 64 bits."""
        sizes, parts = [], []
        while len(high):
            size = -(-cls.GAMMA * len(high) // 8) * 8
            at = _place(high, low, len(sizes), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(alone))
            left = ~alone[at]
            high, low = high[left], low[left]
        return cls(sizes, np.concatenate(parts).tobytes() if parts else b"")

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each pair. Of one that was not built in, any slot, or -1."""
        out = np.full(len(high), -1, np.int64)
        todo, start = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            at = start + _place(high[todo], low[todo], level, size).astype(np.int64)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            here = (self.bits[byte] >> (7 - bit)) & 1 == 1
            before = self.bits[byte[here]] >> (8 - bit[here].astype(np.uint16))
            out[todo[here]] = self.rank[byte[here]] + _SET_BITS[before]
            todo, start = todo[~here], start + size
        return out


_SET_BITS = np.array([i.bit_count() for i in range(256)], np.int64)


# -- digests of blocks ----------------------------------------------------------


def line_hashes(text: str | None, min_chars: int) -> tuple[int, list[int], list[bytes]]:
    """Number of lines, and number and hash of each line whose key counts."""
    lines = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(b"\n")
    at, hashes = [], []
    for i, line in enumerate(lines):
        key = line.strip(_STRIP)
        # A code point has at most four bytes.
        if len(key) >= 4 * min_chars or (len(key) >= min_chars and len(key.decode("utf-8", "surrogatepass")) >= min_chars):
            at.append(i)
            hashes.append(xxhash.xxh3_128_digest(key))
    return len(lines), at, hashes


DIGEST = "block long, ids array<string>, keys array<long>, n_lines array<int>, n_hashes array<int>, places binary, hashes binary, n long"


def digests(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Blocks of whole documents, stored: ids (as text, since an array of longs with
    nulls reaches Python as floats), text keys, and the lines' hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, rows, chars, found = TaskContext.get().partitionId() << 32, [], 0, 0

        def done() -> pd.DataFrame:
            ids, keys, lines, places, hashes = zip(*rows)
            every = b"".join(h for part in hashes for h in part)
            at = np.array([p for part in places for p in part], np.int32).tobytes()
            return table([(block, list(ids), list(keys), list(lines), [len(h) for h in hashes], at, every, found)], DIGEST_NAMES)

        for b in batches:
            for i, key, text in zip(b["doc_id"], b["text_key"], b["text"]):
                lines, places, hashes = line_hashes(text, min_chars)
                rows.append((i, key, lines, places, hashes))
                chars, found = chars + len(text or ""), found + len(hashes)
                if chars >= BLOCK_CHARS or found >= BLOCK_LINES:
                    yield done()
                    block, rows, chars, found = block + 1, [], 0, 0
        if rows:
            yield done()

    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), doc_key(F.col("text")).alias("text_key"), "text")
    return stored(rows.mapInPandas(run, DIGEST), "digests")


DIGEST_NAMES = [c.split()[0] for c in DIGEST.split(", ")]


def _split(hashes: bytes) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(hashes, ">u8").astype(np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _owners(ids, n_hashes) -> np.ndarray:
    """The id of the document of each hash of a block."""
    return np.repeat(np.array([NO_ID if i is None else int(i) for i in ids], np.int64), n_hashes)


def _shards(high: np.ndarray, n: int) -> np.ndarray:
    """Shards by range, so that they are in order where the hashes are."""
    return ((high >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _cuts(high: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(shard, begin, end) of the shards that sorted hashes fall in."""
    shard = _shards(high, n).astype(np.int64)
    begin = group_starts(shard)
    return list(zip(shard[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(shard)]))


def _merge(high, low, first, last, count) -> tuple[np.ndarray, ...]:
    """One entry per distinct hash: smallest and largest holder, number of holders."""
    by = np.lexsort((low, high))
    at = group_starts(high[by], low[by])
    if not len(at):
        return high, low, first, last, count
    return high[by][at], low[by][at], np.minimum.reduceat(first[by], at), np.maximum.reduceat(last[by], at), np.add.reduceat(count[by], at)


# -- the index -------------------------------------------------------------------

ENTRY = ("high", "low", "first", "last", "count")
PACKET = "shard int, part long, " + ", ".join(f"{c} binary" for c in ENTRY)
KINDS = (np.uint64, np.uint64, np.int64, np.int64, np.int64)
INDEX = "shard int, n int, sizes array<int>, bits binary, fingerprints binary, counts binary, firsts binary"


def _read(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate([np.frombuffer(x, k) for x in rows[c]]) for c, k in zip(ENTRY, KINDS))


def index_lines(digest: DataFrame, n_shards: int, n_blocks: int) -> DataFrame:
    """A row per shard: its perfect hash and the arrays, stored."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block, ids, n_hashes, hashes in zip(b["block"], b["ids"], b["n_hashes"], b["hashes"]):
                high, low = _split(hashes)
                own = _owners(ids, n_hashes)
                # A document that repeats a line holds it once.
                by = np.lexsort((own, low, high))
                once = by[group_starts(high[by], low[by], own[by])]
                high, low, own = high[once], low[once], own[once]
                entry = _merge(high, low, own, own, np.ones(len(own), np.int64))
                yield table([(s, block, *(x[a:e].tobytes() for x in entry)) for s, a, e in _cuts(entry[0], n_shards)], ["shard", "part", *ENTRY])

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["shard", "part"]):
            for (shard, part), group in rows.groupby(["shard", "part"], sort=False):
                yield table([(shard, part, *(x.tobytes() for x in _merge(*_read(group))))], ["shard", "part", *ENTRY])

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["shard"]):
            for shard, group in rows.groupby("shard", sort=False):
                high, low, first, last, count = _merge(*_read(group))
                made = PerfectHash.build(high, low)
                by = np.argsort(made.slots(high, low))
                # Rows of one doc_id in two blocks are one holder.
                count = np.where(first == last, 1, np.clip(count, 2, 65535)).astype(np.uint16)
                arrays = ((low >> np.uint64(32)).astype(np.uint32), count, first)
                yield table([(shard, len(by), made.sizes, made.bits.tobytes(), *(x[by].tobytes() for x in arrays))], INDEX_NAMES)

    n = n_buckets(digest.sparkSession)
    packets, parts = digest.select("block", "ids", "n_hashes", "hashes").mapInPandas(send, PACKET), n_blocks
    while parts > FAN:
        parts = -(-parts // FAN)
        packets = packets.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(parts)))
        packets = packets.repartition(max(n, n_shards), "shard", "part").sortWithinPartitions("shard", "part").mapInPandas(merge, PACKET)
    return stored(packets.repartition(max(n, n_shards), "shard").sortWithinPartitions("shard").mapInPandas(build, INDEX), "line-index")


INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]


class Shard:
    """One row of the index, for looking up hashes."""

    def __init__(self, sizes, bits: bytes, fingerprints: bytes, counts: bytes, firsts: bytes):
        self.hash = PerfectHash([int(s) for s in sizes], bits)
        self.fingerprints = np.frombuffer(fingerprints, np.uint32)
        self.counts, self.firsts = np.frombuffer(counts, np.uint16), np.frombuffer(firsts, np.int64)

    def find(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of documents that hold each line (0 if its fingerprint is not at its slot), and the first."""
        if not len(self.counts):
            return np.zeros(len(high), np.uint16), np.zeros(len(high), np.int64)
        slot = self.hash.slots(high, low)
        known = (slot >= 0) & (self.fingerprints[slot] == (low >> np.uint64(32)).astype(np.uint32))
        return np.where(known, self.counts[slot], 0), self.firsts[slot]


# -- the documents probe it ---------------------------------------------------------


def dropped_lines(digest: DataFrame, index: DataFrame, n_shards: int, n_blocks: int) -> DataFrame:
    """(doc_id, text_key, dropped array<boolean> by line) of the documents that
    lose a line: one that at least two documents hold, this not being the first."""
    parts = -(-n_blocks // FAN)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block, hashes in zip(b["block"], b["hashes"]):
                high, low = _distinct(hashes)[:2]
                yield table(
                    [(s, int(block) % parts, block, a, high[a:e].tobytes(), low[a:e].tobytes()) for s, a, e in _cuts(high, n_shards)],
                    ["shard", "part", "block", "begin", "high", "low"],
                )

    def look_up(probes: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(probes) and len(shard):
            own = Shard(*(shard[c].iloc[0] for c in INDEX_NAMES[2:]))
            for block, begin, high, low in zip(probes["block"], probes["begin"], probes["high"], probes["low"]):
                count, first = own.find(np.frombuffer(high, np.uint64), np.frombuffer(low, np.uint64))
                at = np.flatnonzero(count >= 2)
                if len(at):
                    out.append((block, (at + begin).astype(np.int32).tobytes(), first[at].tobytes()))
        return pd.DataFrame(out, columns=["block", "at", "first"])

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for ids, keys, n_lines, n_hashes, places, hashes, replies in zip(*(b[c] for c in ("ids", "keys", "n_lines", "n_hashes", "places", "hashes", "replies"))):
                high, _, inverse = _distinct(hashes)
                first, shared = np.zeros(len(high), np.int64), np.zeros(len(high), bool)
                for r in replies:
                    at = np.frombuffer(r["at"], np.int32)
                    shared[at], first[at] = True, np.frombuffer(r["first"], np.int64)
                drop = shared[inverse] & (first[inverse] != _owners(ids, n_hashes))
                place, end, out = np.frombuffer(places, np.int32), np.cumsum(n_hashes), []
                for i, key, lines, e, n in zip(ids, keys, n_lines, end, n_hashes):
                    if drop[e - n : e].any():
                        line = np.zeros(lines, bool)
                        line[place[e - n : e]] = drop[e - n : e]
                        out.append((i, key, line.tolist()))
                yield table(out, ["doc_id", "text_key", "dropped"])

    probes = digest.select("block", "hashes").mapInPandas(send, "shard int, part long, block long, begin int, high binary, low binary")
    copies = index.select(*INDEX_NAMES, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))
    n = max(n_buckets(digest.sparkSession), n_shards)
    met = probes.repartition(n, "shard", "part").groupBy("shard", "part").cogroup(copies.repartition(n, "shard", "part").groupBy("shard", "part"))
    replies = met.applyInPandas(look_up, "block long, at binary, first binary").groupBy("block").agg(F.collect_list(F.struct("at", "first")).alias("replies"))
    marked = digest.drop("n").join(replies, "block").mapInPandas(mark, "doc_id string, text_key long, dropped array<boolean>")
    return marked.withColumn("doc_id", F.col("doc_id").cast("long"))


def _distinct(hashes: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's distinct hashes in order, and the place of each hash among them."""
    high, low = _split(hashes)
    by = np.lexsort((low, high))
    begin = group_starts(high[by], low[by])
    inverse = np.empty(len(high), np.int64)
    inverse[by] = np.repeat(np.arange(len(begin)), np.diff([*begin.tolist(), len(high)]))
    return high[by][begin], low[by][begin], inverse


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, shard_lines: int = SHARD_LINES) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped and kept (the other lines); a row per row of ``docs``."""
    digest = digests(docs, min_chars)
    size = digest.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lines"), F.count("*").alias("blocks")).first()
    n_blocks = max(1, size["blocks"])
    n_shards = max(n_buckets(docs.sparkSession), -(-size["lines"] // shard_lines))
    index = index_lines(digest, n_shards, n_blocks)
    # Rows that repeat id and text get one answer.
    drops = stored(dropped_lines(digest, index, n_shards, n_blocks).groupBy("doc_id", "text_key").agg(F.any_value("dropped").alias("dropped")), "dropped-lines")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", doc_key(F.col("text")).alias("text_key"))
    same = d["doc_id"].eqNullSafe(drops["doc_id"]) & (d["text_key"] == drops["text_key"])
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    rows = d.join(drops, same, "left").select(d["doc_id"], lines.alias("lines"), "dropped")
    kept = F.filter("lines", lambda line, i: ~F.coalesce(F.get("dropped", i), F.lit(False)))
    rows = rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(kept).alias("kept"))
    return rows.select("doc_id", "n_lines", (F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("kept"))


def op13_lines(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {NO_ID}) AS own, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, own, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(own) AS holder FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT own) > 1),
m AS (SELECT r, pos, line, coalesce(f.holder <> own, false) AS gone FROM k LEFT JOIN f USING (key)),
t AS (SELECT r, count_if(gone)::BIGINT AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM m GROUP BY r)
SELECT doc_id, len(lines)::BIGINT AS n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN t USING (r)
"""
