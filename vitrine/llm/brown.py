"""Class-based n-grams: a word's class follows the class before it, and the
class emits the word.

Documents are encoded once into blocks (one row each: its distinct words in the
order of their hashes, and the tokens as numbers of these), stored by block. The
blocks' words meet once: a shard (a range of hashes) numbers its words and keeps,
stored by shard, where each block's words are among them. From then on no word is
sent again. Numbers per word (its class, its count) go down from the shards to the
blocks as arrays in the words' order, and a word's counts of neighbouring classes go
up from the blocks as one packed row per block and shard; only these are shuffled.

Classes come from exchange clustering on the class-bigram likelihood. A core of the
most frequent words starts in frequency order; every sweep counts, over all training
tokens, which classes stand before and after each core word, and the words then move
one by one to the class that raises the likelihood most. All other words get a first
class by their neighbours in the core. That is where the exchange of all words starts:
in turns, every word of one half (by a hash) moves to the class that raises the
likelihood most, given the classes of all its neighbours, until neither half's turn
raises the likelihood any more (by ``RISE`` per token). A turn reads the tokens once:
for the class bigrams, which tell what the last turn brought, and for the contexts of
the words that are next. The driver holds only the counts of class bigrams. With the
best classes the texts are scored.

P(word | class before) = (1 - u) P(class | class before) P(word | class), where u
is the chance of an unknown word after that class, estimated from words seen
once. The probabilities of all known words and of the one unknown type add up
to one. A text begins after an end token.

Defined cases: a null or empty text is its end token alone; a null doc_id is
training; rows that repeat are texts of their own, in counts and in results;
with no training documents the score is the base score; an empty table gives
no rows; other columns are not read. Two words are the same if their 128-bit
hashes are.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import bucketed, discard, group_starts, n_buckets, stored, stored_at, table, whole_groups

CLASSES = 32
CORE = 4096
SWEEPS = 4
RISE = 1e-3
FOLDS, HELD = 7, 2
SMOOTHING = 5.0
BLOCK_BYTES = 8 << 20
BUCKET_BLOCKS = 2  # a bucket's blocks, which one task reads in every turn
SHARD_WORDS = 1 << 19  # a shard's words, counted once per block
SHARD_LEAST = 1 << 19  # no more shards than of so many, whatever the number of shuffle partitions
END = CLASSES  # the end token is a class of its own
OTHER = CLASSES + 1  # in the core's sweeps: words outside of the core
SLOTS = CLASSES + 2
BITS = 7  # of a context: slot after, or SLOTS + slot before


def _planes(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers as compressed byte planes: most are small."""
    width = np.dtype(kind).itemsize
    planes = np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _numbers(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_tokens(tokens: np.ndarray) -> bytes:
    """Tokens as their low 16 bits, the rest in a byte each (or in two, which the last byte tells)."""
    rest = "<u2" if len(tokens) and tokens.max() >= 1 << 24 else "<u1"
    data = tokens.astype("<u2").tobytes() + (tokens >> 16).astype(rest).tobytes() + bytes([np.dtype(rest).itemsize])
    return zstandard.ZstdCompressor(level=1).compress(data)


def _tokens(raw: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(raw)
    n = len(data) // (2 + data[-1])
    tokens = np.frombuffer(data, f"<u{data[-1]}", n, 2 * n).astype("<u4")
    tokens <<= 16
    tokens |= np.frombuffer(data, "<u2", n)
    return tokens


def _hashes(words: list[bytes]) -> np.ndarray:
    """A 128-bit hash of each word, as two columns."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").astype(np.uint64).reshape(-1, 2)


BLOCK = (
    "block long, doc_id array<string>, held array<boolean>, ends binary, ids binary, held_ids binary, "
    "words string, hashes binary, trains binary, turns binary, size int"
)
BLOCK_ARROW = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.list_(pa.string())), ("held", pa.list_(pa.bool_())), ("ends", pa.binary()), ("ids", pa.binary()), ("held_ids", pa.binary())]
    + [("words", pa.string()), ("hashes", pa.binary()), ("trains", pa.binary()), ("turns", pa.binary()), ("size", pa.int32())]
)


def encode(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks: doc_id and held per document (training documents first), ends of the
    documents among the tokens, ids (the training documents' tokens, 0 is the end
    token, i the ith distinct word), held_ids (the others' tokens), words
    (space-joined, in the order of their hashes), hashes (of these words), trains
    (their counts in training documents), turns (the half that each word is exchanged
    with) and size (how many they are). Stored by block, so that joins on the block
    move the other side only. Ids are text, since an array of longs with nulls
    reaches Python as floats."""

    def block_row(block: int, rows: pa.Table) -> pa.RecordBatch:
        # Training documents first, so that their tokens are a slice.
        held = rows["held"].to_numpy()
        order = np.argsort(held, kind="stable")
        rows, held = rows.take(order).combine_chunks(), held[order]
        lists = pc.ascii_split_whitespace(pc.ascii_lower(rows["text"].combine_chunks().fill_null("")))
        coded = lists.flatten().dictionary_encode()
        # Spaces at the ends of a text leave empty words.
        full = pc.binary_length(coded.dictionary).to_numpy() > 0
        code = coded.indices.to_numpy()
        is_word = full[code]
        doc = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())[is_word]
        code = (np.cumsum(full) - 1)[code[is_word]]
        names = coded.dictionary.filter(pa.array(full))
        pairs = _hashes(names.cast(pa.binary()).to_pylist())
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        place = np.empty(len(names), np.uint32)
        place[order] = np.arange(1, len(names) + 1)
        tokens = np.zeros(len(code) + len(lists), np.uint32)
        tokens[np.arange(len(code)) + doc] = place[code]  # an end token after each document's words
        ends = np.flatnonzero(tokens == 0).astype(np.int64) + 1
        n = int(ends[(~held).sum() - 1]) if not held.all() else 0
        counts = np.bincount(tokens[:n], minlength=len(names) + 1)[1:]
        pairs = np.ascontiguousarray(pairs[order])
        words = pc.binary_join(pa.ListArray.from_arrays([0, len(names)], names.take(pa.array(order))), " ")
        turns = np.packbits((pairs[:, 1] & np.uint64(1)).astype(bool)).tobytes()
        one = [block], [rows["doc_id"].to_pylist()], [held.tolist()], [_planes(ends, "<i8")], [_pack_tokens(tokens[:n])], [_pack_tokens(tokens[n:])]
        one += words, [pairs.tobytes()], [_planes(counts, "<u4")], [turns], [len(names)]
        return pa.record_batch([x if x is words else pa.array(x, f.type) for x, f in zip(one, BLOCK_ARROW)], schema=BLOCK_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        rows: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            ends = np.cumsum(pc.binary_length(b["text"]).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
            begin, before = 0, 0
            while begin < len(ends):
                end = int(np.searchsorted(ends, before + block_bytes - size)) + 1  # with the row that fills the block
                rows.append(b.slice(begin, end - begin))
                if end > len(ends):
                    size += int(ends[-1]) - before
                    break
                yield block_row(block, pa.Table.from_batches(rows))
                block, rows, size = block + 1, [], 0
                begin, before = end, int(ends[end - 1])
        if rows:
            yield block_row(block, pa.Table.from_batches(rows))

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), held.alias("held"), "text")
    # Buckets of some blocks: every turn has a task for each of them.
    size = docs.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64), F.lit(0))).first()[0]
    n = max(1, min(n_buckets(docs.sparkSession), -(-size // (BUCKET_BLOCKS * block_bytes))))
    # A task writes a file per block: nothing is shuffled.
    return bucketed(rows.mapInArrow(run, BLOCK), n, "block", "encoded")


def _contexts(tokens: np.ndarray, slots: np.ndarray, rows: int) -> np.ndarray:
    """Counts (rows x 2 SLOTS) of the class-slots after (first SLOTS) and before
    (last SLOTS) the training tokens, which are the given words (-1: no word of interest).
    Documents are joined by their end tokens, which all are in one class."""
    wide = 2 * SLOTS
    total = np.zeros((rows + 1) * wide, np.int64)
    # Held-out documents are left out whole, so what follows an end is a beginning.
    if len(tokens):
        at = np.where(tokens < 0, rows, tokens).astype(np.int64) * wide
        total += np.bincount(at[:-1] + slots[1:], minlength=len(total))
        total += np.bincount(at[1:] + SLOTS + slots[:-1], minlength=len(total))
        total[at[0] + SLOTS + END] += 1
    return total.reshape(rows + 1, wide)[:rows]


# -- the words meet: shards above blocks ---------------------------------------------

HUB = "shard int, block long, at binary, counts binary, low binary"
HUB_NAMES = [c.split()[0] for c in HUB.split(", ")]


class Hub:
    """The shards, stored: per shard a row (block -1) with the training counts of its words
    and the low bits of their hashes, and a row per block with the places of the block's
    words (those of the shard's range, in order) among them."""

    def __init__(self, blocks: DataFrame):
        spark = blocks.sparkSession
        entries = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        self.blocks = blocks
        # Every block sends a row to every shard in every turn, so shards are not made for few words.
        self.shards = shards = max(1, min(n_buckets(spark), -(-entries // SHARD_LEAST)), -(-entries // SHARD_WORDS))

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for block, hashes, trains in zip(b["block"], b["hashes"], b["trains"]):
                    pairs, count = np.frombuffer(hashes, np.uint64).reshape(-1, 2), _numbers(trains, "<u4")
                    yield table([(s, block, pairs[a:e].tobytes(), _planes(count[a:e], "<u4")) for s, a, e in _cuts(pairs[:, 0], shards)], ["shard", "block", "hashes", "counts"])

        def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in whole_groups(batches, ["shard"]):
                for shard, part in rows.groupby("shard", sort=False):
                    pairs = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in part["hashes"]]
                    size = np.cumsum([0, *map(len, pairs)])
                    every, count = np.concatenate(pairs), np.concatenate([_numbers(x, "<u4") for x in part["counts"]])
                    order = np.lexsort((every[:, 1], every[:, 0]))
                    first = group_starts(every[order, 0], every[order, 1])
                    at = np.empty(len(every), np.int64)
                    at[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(every))))
                    totals = np.bincount(at, weights=count, minlength=len(first)).astype(np.int64)
                    own = [(shard, -1, None, _planes(totals, "<i8"), (every[order, 1][first] & np.uint64(0xFFFF)).astype("<u2").tobytes())]
                    # Places rise, so their steps are small.
                    own += [(shard, block, _planes(np.diff(at[a:e], prepend=0), "<u4"), None, None) for block, a, e in zip(part["block"], size, size[1:])]
                    yield table(own, HUB_NAMES)

        packets = blocks.select("block", "hashes", "trains").mapInPandas(send, "shard int, block long, hashes binary, counts binary")
        numbered = packets.repartition(shards, "shard").sortWithinPartitions("shard").mapInPandas(number, HUB)
        # The partitions are the table's buckets: a file each.
        self.table = bucketed(numbered, shards, "shard", "hub")

    def per_shard(self, make, schema: str) -> DataFrame:
        """``make(shard, counts, low)`` -> columns of a row per shard."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [make(int(s), _numbers(c, "<i8"), np.frombuffer(low, "<u2")) for s, c, low in zip(b["shard"], b["counts"], b["low"])]
                yield pd.concat(rows, ignore_index=True) if rows else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

        return self.table.where("block < 0").select("shard", "counts", "low").mapInPandas(run, schema)

    def values(self, make, kind: str) -> DataFrame:
        """(shard, v): an array of numbers for each shard's words, from ``make(shard, counts, low)``."""
        return self.per_shard(lambda s, c, low: table([(s, _planes(make(s, c, low), kind))], ["shard", "v"]), "shard int, v binary")

    def _pieces(self, values: DataFrame, kind: str) -> DataFrame:
        """(block, shard, v): to each block the numbers of its words, a row for each shard."""

        def pick(links: pd.DataFrame, value: pd.DataFrame) -> pd.DataFrame:
            if not len(value):
                return table([], ["block", "shard", "v"])
            v = _numbers(value["v"].iloc[0], kind)
            return table([(b, s, _planes(v[np.cumsum(_numbers(at, "<u4"))], kind)) for s, b, at in zip(links["shard"], links["block"], links["at"])], ["block", "shard", "v"])

        links = self.table.where("block >= 0").select("shard", "block", "at")
        return links.groupBy("shard").cogroup(values.groupBy("shard")).applyInPandas(pick, "block long, shard int, v binary")

    def down(self, values: DataFrame, kind: str) -> DataFrame:
        """(block, parts): to each block the numbers of its words, by shard."""
        return self._pieces(values, kind).groupBy("block").agg(F.collect_list(F.struct("shard", "v")).alias("parts"))

    def with_values(self, values: DataFrame, kind: str, *columns: str) -> DataFrame:
        """The blocks' columns, and the parts of ``values``."""
        return self.blocks.select("block", *columns).join(self.down(values, kind), "block", "left")

    def each_block(self, values: DataFrame, kind: str, columns: tuple[str, ...], make, schema: str) -> DataFrame:
        """``make`` of each row that ``with_values`` has, in the blocks' own buckets: the numbers
        go to the blocks straight from the shards, in one shuffle."""

        def run(sent: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            parts = [{"shard": s, "v": v} for s, v in zip(sent["shard"], sent["v"])]
            return make(next(own.assign(parts=[parts]).itertuples(index=False)))

        blocks = self.blocks.select("block", *columns).groupBy("block")
        return self._pieces(values, kind).groupBy("block").cogroup(blocks).applyInPandas(run, schema)

    def up(self, rows: DataFrame, classes: DataFrame, choose) -> DataFrame:
        """``rows`` (shard, block, data: contexts as ``_pack_contexts`` has them) meet by shard.
        ``choose(shard, word, slot, n, slots, counts, low)`` -> the new slots, from the sums (word,
        slot, n) of the contexts in order, most words having few. (shard, v), as ``values``."""

        def run(sent: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            if not len(own):
                return table([], ["shard", "v"])
            head = own[own["block"] < 0].iloc[0]
            counts, low = _numbers(head["counts"], "<i8"), np.frombuffer(head["low"], "<u2")
            place = {b: at for b, at in zip(own["block"], own["at"]) if b >= 0}
            cells, amounts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            slots = np.full(len(counts), OTHER, np.uint8)
            for block, data in zip(sent["block"], sent["data"]):
                if block < 0:
                    slots = _numbers(data, "u1")
                    continue
                entries, slot, n = _unpack_contexts(data)
                cells.append(np.repeat(np.cumsum(_numbers(place[block], "<u4"), dtype=np.int64) << BITS, entries) | slot)
                amounts.append(n)
            cell, n = _summed(np.concatenate(cells), np.concatenate(amounts))
            new = choose(int(head["shard"]), cell >> BITS, cell & ((1 << BITS) - 1), n, slots, counts, low)
            return table([(int(head["shard"]), _planes(new, "u1"))], ["shard", "v"])

        both = rows.select("shard", "block", "data").unionByName(classes.select("shard", F.lit(-1).cast("long").alias("block"), F.col("v").alias("data")))
        return both.groupBy("shard").cogroup(self.table.groupBy("shard")).applyInPandas(run, "shard int, v binary")


def _cuts(high: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """(shard, begin, end) of the ranges that sorted hashes fall in."""
    shard = (((high >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
    begin = group_starts(shard)
    return list(zip(shard[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(shard)]))


def _summed(cell: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each cell once, in order, with the sum of its counts."""
    if not len(cell):
        return cell, n.astype(float)
    low = int(n.max()).bit_length()
    if int(cell.max()).bit_length() + low < 63:  # both in one number, which sorts faster than an order is found
        both = np.sort((cell << low) | n)
        cell, n = both >> low, both & ((1 << low) - 1)
    else:
        by = np.argsort(cell)
        cell, n = cell[by], n[by]
    first = group_starts(cell)
    return cell[first], np.add.reduceat(n, first).astype(float)


def _pack_contexts(entries: np.ndarray, slot: np.ndarray, n: np.ndarray) -> bytes:
    """Per word the number of its contexts; their slots and counts, of which few pass a byte."""
    large = np.flatnonzero(n >= 255)
    head = np.array([len(entries), len(slot), len(large)], "<u4").tobytes()
    parts = (entries.astype(np.uint8), slot.astype(np.uint8), np.minimum(n, 255).astype(np.uint8), large.astype("<u4"), n[large].astype("<u4"))
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(x.tobytes() for x in parts))


def _unpack_contexts(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(raw)
    words, size, large = np.frombuffer(data, "<u4", 3).tolist()
    entries, slot, n = (np.frombuffer(data, np.uint8, k, o) for k, o in ((words, 12), (size, 12 + words), (size, 12 + words + size)))
    rest = np.frombuffer(data, "<u4", 2 * large, 12 + words + 2 * size)
    n = n.astype(np.int64)
    n[rest[:large]] = rest[large:]
    return entries, slot, n


def _parts(parts, kind: str) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(shard, number of words) of a block's parts, and all their numbers."""
    got = sorted(((int(p["shard"]), _numbers(p["v"], kind)) for p in parts), key=lambda p: p[0]) if parts is not None else []
    return [(s, len(v)) for s, v in got], np.concatenate([np.zeros(0, kind), *(v for _, v in got)])


# -- the core ----------------------------------------------------------------------------


def core_words(hub: Hub, core: int = CORE) -> list[tuple[int, int]]:
    """(shard, place) of the most frequent words, ties by hash. A histogram of the counts
    tells from which count on there are enough; only these words are compared."""
    grain = 8  # steps of the histogram per doubling

    def steps(counts: np.ndarray) -> np.ndarray:
        return np.floor(grain * np.log2(counts)).astype(np.int64)

    def histogram(shard: int, counts: np.ndarray, _) -> pd.DataFrame:
        step, n = np.unique(steps(counts[counts > 0]), return_counts=True)
        return pd.DataFrame({"step": step, "n": n})

    least, found = 0, 0
    sizes = hub.per_shard(histogram, "step long, n long").groupBy("step").agg(F.sum("n").alias("n"))
    for r in sorted(sizes.collect(), reverse=True):  # bounded by the logarithm of the largest count
        if found < core:
            least, found = r["step"], found + r["n"]

    def top(shard: int, counts: np.ndarray, _) -> pd.DataFrame:
        at = np.flatnonzero(counts > 0)
        at = at[steps(counts[at]) >= least]
        at = at[np.argsort(-counts[at], kind="stable")[:core]]
        return pd.DataFrame({"shard": shard, "at": at, "n": counts[at]})

    best = hub.per_shard(top, "shard int, at long, n long").orderBy(F.col("n").desc(), "shard", "at").limit(core)
    return [(r["shard"], r["at"]) for r in best.collect()]


def core_places(hub: Hub, words: list[tuple[int, int]]) -> DataFrame:
    """(block, parts): the number of each word in the core, or -1. Stored."""
    of: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, (shard, at) in enumerate(words):
        of[shard].append((at, i))

    def make(shard: int, counts: np.ndarray, _) -> np.ndarray:
        place = np.full(len(counts), -1, np.int16)
        for at, i in of.get(shard, []):
            place[at] = i
        return place

    return stored(hub.down(hub.values(make, "<i2"), "<i2"), "core-places")


def _sweep_counts(blocks: DataFrame, of: np.ndarray) -> np.ndarray:
    """Class contexts of the core words over all training tokens: (core + 1) x 2 SLOTS; the last
    row is the end token. ``blocks`` with the ``parts`` of ``core_places``."""
    size = len(of) + 1
    slots = np.concatenate([of, [END, OTHER]]).astype(np.int64)  # -1 is the last

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, 2 * SLOTS), np.int64)
        for b in batches:
            for ids, parts in zip(b["ids"], b["parts"]):
                word = np.concatenate([[size - 1], _parts(parts, "<i2")[1]]).astype(np.int64)[_tokens(ids)]
                total += _contexts(word, slots[word], size)
        total = total.ravel()
        cell = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cell, "n": total[cell]})

    counted = blocks.select("ids", "parts").mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(size * 2 * SLOTS)
    for r in counted.collect():  # bounded by the core's size and the classes
        out[r["cell"]] = r["n"]
    return out.reshape(size, 2 * SLOTS)


def exchange(counts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """One sweep: each core word, the most frequent first, is taken out of its class
    and put into the one with the greatest likelihood, counts kept up to date."""
    of = of.copy()
    after, before = counts[:, :SLOTS], counts[:, SLOTS:]
    matrix = np.zeros((SLOTS, SLOTS))
    np.add.at(matrix, of, after[: len(of)])
    matrix[END] += after[len(of)]
    np.add.at(matrix[OTHER], of, before[: len(of), OTHER])
    for w in range(len(of)):
        a, b = after[w], before[w]
        matrix[of[w]] -= a
        matrix[:, of[w]] -= b
        np.maximum(matrix, 0, out=matrix)
        pair = np.log(matrix + 0.5)
        rows, cols = np.log(matrix.sum(1) + 0.5 * SLOTS)[:CLASSES], np.log(matrix.sum(0) + 0.5 * SLOTS)[:CLASSES]
        gain = pair[:CLASSES] @ a + b @ pair[:, :CLASSES] - a.sum() * rows - b.sum() * cols
        of[w] = int(gain.argmax())
        matrix[of[w]] += a
        matrix[:, of[w]] += b
    return of


def cluster_core(hub: Hub, core: int = CORE, sweeps: int = SWEEPS) -> tuple[list[tuple[int, int]], np.ndarray, DataFrame]:
    """The core words, their classes, and the blocks with the core's places."""
    words = core_words(hub, core)
    placed = hub.blocks.select("block", *SENT).join(core_places(hub, words), "block", "left")
    of = np.arange(len(words)) % CLASSES
    for _ in range(sweeps):
        of = exchange(_sweep_counts(placed, of), of)
    return words, of, placed


# -- all words ---------------------------------------------------------------------------


def _gains(matrix: np.ndarray) -> np.ndarray:
    """Context slots times this matrix give a word's likelihood in each class."""
    pair = np.log(matrix + 0.5)
    rows, cols = np.log(matrix.sum(1) + 0.5 * SLOTS)[:CLASSES], np.log(matrix.sum(0) + 0.5 * SLOTS)[:CLASSES]
    return np.concatenate([pair[:CLASSES].T - rows, pair[:, :CLASSES] - cols])


def _groups(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word's contexts begin, and the number among the words of each context's word."""
    first = group_starts(word)
    return first, np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))


def _choose(likely: np.ndarray, first, of, slot, n, own=None, stay=None) -> np.ndarray:
    """Each word's best class, where its ``own`` counts as ``stay``. By matrix products
    over some thousand words at a time."""
    best, edge = np.empty(len(first), np.int64), np.append(first, len(of))
    for g in range(0, len(first), 4096):
        z = min(g + 4096, len(first))
        a, e = edge[g], edge[z]
        seen = np.zeros((z - g, 2 * SLOTS))
        seen[of[a:e] - g, slot[a:e]] = n[a:e]
        score = seen @ likely
        if own is not None:
            score[np.arange(z - g), own[g:z]] = stay[g:z]
        best[g:z] = score.argmax(1)
    return best


def _stay(matrix: np.ndarray, own: np.ndarray, of: np.ndarray, slot: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Likelihood of each word in its own class, the word's counts taken out of it."""
    mine, after = own[of], slot < SLOTS
    there = np.where(after, matrix[mine, np.minimum(slot, SLOTS - 1)], matrix[np.maximum(slot - SLOTS, 0), mine])
    total = lambda x: np.bincount(of, weights=x, minlength=len(own))
    a, b = total(n * after), total(n * ~after)
    rows, cols = np.maximum(matrix.sum(1)[own] - a, 0), np.maximum(matrix.sum(0)[own] - b, 0)
    return total(n * np.log(np.maximum(there - n, 0) + 0.5)) - a * np.log(rows + 0.5 * SLOTS) - b * np.log(cols + 0.5 * SLOTS)


PASSED = "shard int, block long, data binary, bigrams array<long>"


def _pass_block(r, kind: str, slots_of) -> pd.DataFrame:
    """One pass over the tokens of a block with parts. ``slots_of(numbers, turns)`` -> the slots of
    the block's words and which of these send their contexts. Rows (shard, block, data) with the contexts, and one
    with the block's counts of class bigrams and no shard (-1)."""
    word = _tokens(r.ids)
    turns = np.unpackbits(np.frombuffer(r.turns, np.uint8), count=r.size).astype(bool)
    sizes, numbers = _parts(r.parts, kind)
    of, moves = slots_of(numbers, turns)
    of = np.concatenate([[END], of]).astype(np.uint8)
    slot = of[word]
    before, after = np.roll(slot, 1), np.roll(slot, -1)
    if len(slot):
        before[0] = after[-1] = END
    matrix = np.bincount(before.astype(np.uint16) * np.uint16(SLOTS) + slot, minlength=SLOTS * SLOTS)
    # Contexts of the words that send, as sorted numbers of word and slot.
    moving = np.concatenate([[False], moves])
    whole = np.int32 if r.size < (1 << 24) else np.int64
    row = (np.cumsum(moving) - 1).astype(whole) << whole(BITS)
    sent = np.flatnonzero(moving[word])  # no end token, so there is one after it
    at = row[word[sent]]
    cell = np.concatenate([at + after[sent], at + (before[sent] + np.uint8(SLOTS))])
    cell.sort()
    first = group_starts(cell)
    n = np.diff(np.append(first, len(cell)))
    cell = cell[first]
    entries = np.bincount(np.flatnonzero(moves)[cell >> BITS], minlength=r.size)
    edge = np.concatenate([[0], np.cumsum(entries)])
    slot = (cell & whole((1 << BITS) - 1)).astype(np.uint8)
    out = [(-1, r.block, None, matrix.tolist())]
    begin = 0
    for shard, size in sizes:
        end = begin + size
        a, e = edge[begin], edge[end]
        if e > a:
            out.append((shard, r.block, _pack_contexts(entries[begin:end], slot[a:e], n[a:e]), None))
        begin = end
    return table(out, ["shard", "block", "data", "bigrams"])


def _pass(blocks: DataFrame, kind: str, slots_of) -> DataFrame:
    """``_pass_block`` of all blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                yield _pass_block(r, kind, slots_of)

    return blocks.mapInPandas(run, PASSED)


def _matrix(rows: DataFrame) -> np.ndarray:
    """The sum of the class bigrams of a pass's blocks."""
    counted = rows.where("shard < 0").select(F.posexplode("bigrams").alias("cell", "n")).where("n > 0").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(SLOTS * SLOTS)
    for r in counted.collect():  # bounded by the classes
        out[r["cell"]] = r["n"]
    return out.reshape(SLOTS, SLOTS)


SENT = ("ids", "turns", "size")


def first_classes(hub: Hub, words: list[tuple[int, int]], of: np.ndarray, placed: DataFrame) -> DataFrame:
    """(shard, v), stored: the first slots of all words. Those of the core as given, of others by
    their neighbours in the core, or by a hash if they have none; OTHER if training lacks them."""
    slots = np.concatenate([of, [OTHER]]).astype(np.int64)  # -1 is the last
    counts = _sweep_counts(placed, of)
    matrix = np.zeros((SLOTS, SLOTS))
    np.add.at(matrix, of, counts[:-1, :SLOTS])
    matrix[END] += counts[-1, :SLOTS]
    # Of words outside of the core as neighbours nothing is known yet.
    likely = _gains(matrix)
    core: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for (shard, at), k in zip(words, of.tolist()):
        core[shard].append((at, k))

    def slots_of(place: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return slots[place], place < 0  # the classes of the core are known

    def choose(shard: int, word, slot, n, _, counts: np.ndarray, low: np.ndarray) -> np.ndarray:
        known = (slot != OTHER) & (slot != SLOTS + OTHER)
        best = ((low >> 1) % CLASSES).astype(np.int64)
        first, of = _groups(word[known])
        best[word[known][first]] = _choose(likely, first, of, slot[known], n[known])
        best[counts == 0] = OTHER
        for place, k in core.get(shard, []):
            best[place] = k
        return best

    none = hub.values(lambda s, c, low: np.full(len(c), OTHER), "u1")
    return stored(hub.up(_pass(placed, "<i2", slots_of).where("shard >= 0"), none, choose), "classes")


def likelihood(matrix: np.ndarray) -> float:
    """Of the class bigrams, per token, beyond that of the words by themselves."""
    share = matrix / max(matrix.sum(), 1)
    alone = np.outer(share.sum(1), share.sum(0))
    at = share > 0
    return float((share[at] * np.log(share[at] / alone[at])).sum())


def exchange_all(hub: Hub, classes: DataFrame, rise: float = RISE) -> DataFrame:
    """The classes of all words, exchanged until the likelihood stops rising."""

    def read(current: DataFrame, turn: int) -> tuple[DataFrame, str, np.ndarray]:
        # Only words whose turn it is need their contexts.
        of = lambda slots, turns: (slots, (turns == bool(turn % 2)) & (slots < CLASSES))
        passed = hub.each_block(current, "u1", SENT, lambda r: _pass_block(r, "u1", of), PASSED)
        rows, path = stored_at(passed, "contexts")
        return rows, path, _matrix(rows)

    def moved(rows: DataFrame, current: DataFrame, matrix: np.ndarray, turn: int) -> tuple[DataFrame, str]:
        likely = _gains(matrix)

        def choose(shard: int, word, slot, n, slots: np.ndarray, counts: np.ndarray, low: np.ndarray) -> np.ndarray:
            # Only words whose turn it is sent contexts.
            first, of = _groups(word)
            own = slots[word[first]].astype(np.int64)
            new = slots.copy()
            new[word[first]] = _choose(likely, first, of, slot, n, own, _stay(matrix, own, of, slot, n))
            return new

        return stored_at(hub.up(rows.where("shard >= 0"), current, choose), "classes")

    spark = hub.blocks.sparkSession
    best, best_path, current, current_path = classes, None, classes, None
    level, idle = -np.inf, 0
    for turn in itertools.count():
        rows, path, matrix = read(current, turn)
        now = likelihood(matrix)
        if turn:
            idle = 0 if now > level + rise else idle + 1
        if now > level:
            if best_path and best_path != current_path:
                discard(spark, best_path)
            best, best_path, level = current, current_path, now
        if idle == 2:
            discard(spark, path)
            return best
        if current is not best:  # the turn brought nothing: go on from before it
            discard(spark, path)
            discard(spark, current_path)
            current, current_path = best, best_path
            rows, path, matrix = read(current, turn)
        current, current_path = moved(rows, current, matrix, turn)
        discard(spark, path)


class ClassModel:
    """Bounded by the classes: transitions, word mass per class, unknown words."""

    def __init__(self, cells: dict[int, int], n: int, v: int):
        self.n, self.v = n, v
        wide = SLOTS + 1
        full = np.zeros((SLOTS, wide))
        for cell, count in cells.items():
            full[cell // wide, cell % wide] = count
        # Row OTHER: after words seen once, for unknown words. Last column: into words seen once.
        moves, once = full[:, : CLASSES + 1], full[:, -1]
        seen = moves[: CLASSES + 1]
        share = seen.sum(0) / max(seen.sum(), 1)
        self.follow = (moves + SMOOTHING * share) / (moves.sum(1, keepdims=True) + SMOOTHING)
        rate = max(once[: CLASSES + 1].sum() / max(n, 1), 1 / (n + v + 1))
        self.unknown = (once + SMOOTHING * rate) / (moves.sum(1) + SMOOTHING)
        self.mass = seen.sum(0)

    def score(self, tokens: np.ndarray, count: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: log10 probability, base log10 probability, known."""
        c, k = count[tokens], of[tokens]
        known = c > 0
        base = np.log10((c + 1) / (self.n + self.v + 1))
        if not self.n:
            return base, base, known
        before = np.concatenate([[END], k[:-1]])
        cls = np.where(known, np.minimum(k, CLASSES), 0)
        p = (1 - self.unknown[before]) * self.follow[before, cls] * c / np.maximum(self.mass[cls], 1)
        return np.log10(np.where(known, p, self.unknown[before])), base, known


def _lexicon(counts, classes, end_count: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and class of a block's tokens 0, 1, ...; those that training lacks are OTHER."""
    return np.concatenate([[end_count], _parts(counts, "<i8")[1]]), np.concatenate([[END], _parts(classes, "u1")[1]]).astype(np.int64)


def class_model(encoded: DataFrame, end_count: int, n: int, v: int) -> ClassModel:
    wide = SLOTS + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SLOTS * wide, np.int64)
        for b in batches:
            for ids, counts, classes in zip(*(b[x] for x in ("ids", "counts", "classes"))):
                tokens = _tokens(ids)  # whole documents, so each still begins after an end
                count, of = _lexicon(counts, classes, end_count)
                cls, single = of[tokens], count[tokens] == 1
                before = np.concatenate([[END], cls[:-1]])
                total += np.bincount(before * wide + cls, minlength=len(total))
                total += np.bincount(before[single] * wide + SLOTS, minlength=len(total))
                after = np.flatnonzero(single[:-1]) + 1
                total += np.bincount(OTHER * wide + cls[after], minlength=len(total))
                total += np.bincount(OTHER * wide + np.full(int(single[after].sum()), SLOTS), minlength=len(total))
        cell = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cell, "n": total[cell]})

    counted = encoded.select("ids", "counts", "classes").mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    return ClassModel({r["cell"]: r["n"] for r in counted.collect()}, n, v)


RESULT = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, core: int = CORE, sweeps: int = SWEEPS, rise: float = RISE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs``."""
    blocks = encode(docs)
    hub = Hub(blocks)
    classes = exchange_all(hub, first_classes(hub, *cluster_core(hub, core, sweeps)), rise)
    end_count = blocks.agg(F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()[0]
    sums = hub.per_shard(lambda s, c, low: pd.DataFrame({"n": [int(c.sum())], "v": [int((c > 0).sum())]}), "n long, v long")
    known = sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()
    n, v = end_count + known["n"], int(end_count > 0) + known["v"]
    counts = hub.down(hub.values(lambda s, c, low: c, "<i8"), "<i8").withColumnRenamed("parts", "counts")
    lexicon = stored(counts.join(hub.down(classes, "u1").withColumnRenamed("parts", "classes"), "block"), "lexicon")
    encoded = blocks.select("block", "doc_id", "held", "ends", "ids", "held_ids").join(lexicon, "block", "left")
    model = class_model(encoded, end_count, n, v)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc_id, ids, held_ids, ends, held, c, k in zip(*(b[x] for x in ("doc_id", "ids", "held_ids", "ends", "held", "counts", "classes"))):
                tokens, end = np.concatenate([_tokens(ids), _tokens(held_ids)]), _numbers(ends, "<i8")
                score, base, known = model.score(tokens, *_lexicon(c, k, end_count))
                begin = np.concatenate([[0], end[:-1]])
                out = {"doc_id": list(doc_id), "held_out": list(held), "n_tokens": end - begin}
                out |= {"n_known": np.add.reduceat(known.astype(np.int64), begin), "train_tokens": n}
                out |= {"base_score": np.add.reduceat(base, begin), "score": np.add.reduceat(score, begin)}
                yield pd.DataFrame(out)

    return encoded.drop("block").mapInPandas(run, RESULT).withColumn("doc_id", F.col("doc_id").cast("long"))


def op4_brown(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
