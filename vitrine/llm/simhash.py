"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is cut into segments so that two fingerprints within
the distance differ by at most one bit in some segment. Every distinct
fingerprint is indexed under its segments and probes, for each segment, the
values that have one more bit set: of two segments that differ in one bit, one
probes the other, and equal segments meet in the index. What meets under a
segment value is verified on all 64 bits.

Copies collapse to one fingerprint before anything is compared. A segment
value with many fingerprints is dealt out as cells of bounded blocks; a cell
returns a spanning forest of its links, never all its pairs. The components
come from alternating star rounds over these links.

Defined cases: a null or wordless text has fingerprint 0, which links like any
other; a null doc_id is last when the smallest doc_id of a component is taken
(null if all are); rows that repeat id and text share one class; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import SPACE, doc_key, group_starts, n_buckets, stored, text_bytes, whole_groups, word_bounds
from vitrine.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
BLOCK = 1024
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is set when over half of the shingles' XXH64 have it set."""
    data = text_bytes(text, fold=True)
    start, end = word_bounds(data)
    if not len(start):
        return 0
    # The words joined by single spaces, and where each begins and ends there.
    length = end - start
    right = np.cumsum(length + 1) - 1
    left = right - length
    joined = np.full(right[-1], 32, np.uint8)
    inside = np.ones(right[-1], bool)
    inside[right[:-1]] = False
    joined[inside] = data[~SPACE[data]]
    raw = joined.tobytes()
    k = min(shingle_words, len(left))
    left, right = left[: len(left) - k + 1], right[k - 1 :]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(left), _CHUNK):
        pairs = zip(left[at : at + _CHUNK].tolist(), right[at : at + _CHUNK].tolist())
        hashes = np.array([digest(raw[a:b], 42) for a, b in pairs], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(left)).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_key, fp) per row of ``docs``; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [_signed(fingerprint(t, shingle_words)) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_key": b["text_key"], "fp": np.array(found, np.int64)})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(doc_key(F.col("text")), F.lit(0)).alias("text_key"), "text")
    made = rows.mapInPandas(run, "doc_id string, text_key long, fp long")
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of so many segments that one of them differs in at most one bit."""
    n = max_bits // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _raised(key: Column, shift: int, width: int) -> Column:
    """All values of a segment with one more bit set."""
    zero = F.filter(F.array(*(F.lit(np.int64(_signed(1 << (shift + b))).item()) for b in range(width))), lambda bit: key.bitwiseAND(bit) == 0)
    return F.transform(zero, lambda bit: key.bitwiseOR(bit))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A link to its component's first node for every other node, given the pairs (a, b) of n nodes."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    rest = np.flatnonzero(label != np.arange(n))
    return rest, label[rest]


def _verify(max_bits: int):
    def links(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forest over left and right of the pairs between them (of left, if right is empty)."""
        found = []
        both = np.concatenate([left, right])
        for other, at in ((left, 0), (right, len(left))):
            for i in range(0, len(other), BLOCK):
                near = np.bitwise_count(left[:, None] ^ other[None, i : i + BLOCK]) <= max_bits
                x, y = np.nonzero(near)
                found.append((x, y + at + i))
        x, y = (np.concatenate(z) for z in zip(*found))
        u, v = _forest(x, y, len(both))
        return both[u], both[v]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["seg", "key", "cell"]):
            seg, key, cell, side = (rows[c].to_numpy() for c in ("seg", "key", "cell", "side"))
            fp = rows["fp"].to_numpy().view(np.uint64)
            start = group_starts(seg, key, cell)
            end = np.append(start[1:], len(key))
            # The index rows (sides 0 and 1) come first in a cell.
            live = np.flatnonzero((end - start > 1) & (side[start] < 2))
            out_a, out_b = [], []
            for s, e in zip(start[live].tolist(), end[live].tolist()):
                one, two = s + int(np.searchsorted(side[s:e], 1)), s + int(np.searchsorted(side[s:e], 2))
                # Side 0 and side 1 are two blocks of the index, side 2 probes.
                a, b = links(fp[s:one] if one > s else fp[s:two], fp[(one if one > s else two) : e])
                out_a.append(a)
                out_b.append(b)
            if out_a:
                a, b = np.concatenate(out_a), np.concatenate(out_b)
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links whose components are those of all pairs within the distance.
    ``fps`` holds distinct fingerprints (fp) and is read several times."""
    spark = fps.sparkSession
    segs = list(enumerate(_segments(max_bits)))
    mask = [np.int64(_signed(((1 << w) - 1) << s)).item() for _, (s, w) in segs]
    index = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(i).alias("seg"), F.col("fp").bitwiseAND(F.lit(mask[i])).alias("key")) for i, _ in segs))).alias("_")).select("fp", "_.*")

    def probes(i: int, shift: int, width: int) -> Column:
        raised = _raised(F.col("fp").bitwiseAND(F.lit(mask[i])), shift, width)
        return F.transform(raised, lambda key: F.struct(F.lit(i).alias("seg"), key.alias("key")))

    probe = fps.select("fp", F.explode(F.concat(*(probes(i, s, w) for i, (s, w) in segs))).alias("_")).select("fp", "_.*")

    # Blocks of the values that hold many fingerprints, or that many probe.
    full = stored(index.groupBy("seg", "key").agg(F.count("*").alias("n")).filter(F.col("n") > block), "full")
    around = [full.filter(F.col("seg") == i).select("seg", F.explode(_raised(F.col("key"), s, w)).alias("key"), F.lit(0).cast("long").alias("i"), F.col("n").alias("p")) for i, (s, w) in segs]
    load = full.select("seg", "key", F.col("n").alias("i"), F.lit(0).cast("long").alias("p"))
    for x in around:
        load = load.union(x)
    load = stored(
        load.groupBy("seg", "key").agg(
            F.greatest(F.lit(1), F.ceil(F.sum("i") / block)).cast("int").alias("ni"), F.greatest(F.lit(1), F.ceil(F.sum("p") / block)).cast("int").alias("np")
        ),
        "blocks",
    )

    def dealt(rows: DataFrame, is_probe: bool) -> DataFrame:
        rows = rows.join(load, ["seg", "key"], "left").fillna(1, ["ni", "np"])
        mine = F.pmod(F.xxhash64("fp"), F.col("np" if is_probe else "ni")).cast("int")
        rows = rows.withColumn("mine", mine).withColumn("wide", F.col("ni") + F.col("np"))
        cell = lambda a, b, side: F.struct((a * F.col("wide") + b).alias("cell"), side.cast("int").alias("side"))
        blocks = F.sequence(F.lit(0), F.col("ni") - 1)
        if is_probe:
            cells = F.transform(blocks, lambda a: cell(a, F.col("ni") + F.col("mine"), F.lit(2)))
        else:
            me = F.col("mine")
            pairs = F.transform(blocks, lambda x: cell(F.least(me, x), F.greatest(me, x), (me > x).cast("int")))
            with_probes = F.transform(F.sequence(F.lit(0), F.col("np") - 1), lambda s: cell(me, F.col("ni") + s, F.lit(0)))
            cells = F.concat(pairs, with_probes)
        # Undivided values need one cell.
        cells = F.when(F.col("wide") == 2, F.array(cell(F.lit(0), F.lit(0), F.lit(2 if is_probe else 0)))).otherwise(cells)
        return rows.select("fp", "seg", "key", F.explode(cells).alias("_")).select("fp", "seg", "key", "_.*")

    met = dealt(index, False).union(dealt(probe, True))
    met = met.repartition(n_buckets(spark), "seg", "key", "cell").sortWithinPartitions("seg", "key", "cell", "side")
    return met.mapInPandas(_verify(max_bits), "a long, b long")


def near_duplicate_classes(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_key, fingerprint, component_id, keeper) per row of ``docs``.

    component_id is the smallest doc_id reachable; keeper marks the rows of the
    component's first document (by doc_id, then text_key)."""
    rows = stored(fingerprints(docs, shingle_words), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    fps = stored(rows.groupBy("fp").agg(first), "distinct-fingerprints")
    member = stored(components(stored(fingerprint_links(fps.select("fp"), max_bits), "near-links")), "members")
    placed = fps.join(member, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("component"), "first")
    placed = stored(placed, "placed")
    heads = stored(placed.groupBy("component").agg(F.min("first").alias("head")), "heads")
    classes = stored(placed.select("fp", "component").join(heads, "component").select("fp", "head"), "classes")
    return rows.join(classes, "fp").select(
        "doc_id",
        "text_key",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("head.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_key") == F.col("head.text_key"))).alias("keeper"),
    )


def keep_first(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without near-duplicates: one document of each component stays."""
    keepers = near_duplicate_classes(docs, shingle_words, max_bits).filter("keeper").select("doc_id", "text_key").distinct()
    keepers = stored(keepers, "kept")
    key = F.coalesce(doc_key(F.col("text")), F.lit(0))
    # The row travels as one column, so that no column of its can clash.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), key.alias("key"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    return rows.join(keepers, same, "left_semi").dropDuplicates(["id", "key"]).select("row.*")


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicate_classes(docs).select("doc_id", "fingerprint", "component_id")
