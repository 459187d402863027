"""Exact substring deduplication over bytes.

A byte goes when it lies in a string of ``length`` bytes that also starts
earlier: in a document that comes first by (doc_id, text hash, row), or earlier
in its own.

Windows of equal content have the same 32-byte gram with the smallest hash. So
the windows of a document are cut into runs by that gram's place; runs whose
gram occurs nowhere else are settled at once. The other runs meet by gram. There equal runs
collapse onto the first, and what differs is compared by interval expansion on
a Burrows-Wheeler transform (``bwt.py``) in pieces of bounded size. A gram with
more than ``HOT`` occurrences is not gathered: the windows of its runs are
hashed one by one, once per block, and the buckets of the block exchange
settle which document holds the first.

Defined cases: a null text has no bytes; a null doc_id comes last; rows that
repeat id and text are documents of their own, the first of which is kept;
texts shorter than ``length`` keep all bytes; an empty table gives no rows. The
kept text drops bytes that are no longer whole UTF-8 characters; the digest
covers all kept bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.blocks import NO_ID, Replies, packets, repeated, row_number, text_blocks
from vitrine.llm.bwt import common_prefix_classes
from vitrine.llm.common import BASE_1, BASE_2, group_starts, merge_spans, n_buckets, prefix_sums, span_hashes, stored, table, text_bytes, whole_groups

LENGTH = 100
GRAM = 32
HOT = 1024
_CHUNK = 1 << 18
_PIECE = 2000
_PLACE = np.uint64((1 << 19) - 1)


def gram_runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, windows) of the runs of windows whose smallest gram,
    the leftmost of equals, is at one place. Equal windows choose the same gram
    at the same distance, so they are never in one run."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    out = []
    span = length - gram + 1
    for i in range(0, n, _CHUNK):
        m = min(_CHUNK, n - i)
        prefix = prefix_sums(data[i : i + m + length - 1].astype(np.uint64) + np.uint64(1), BASE_1)
        at = np.arange(m + span - 1)
        h = span_hashes(prefix, at, at + gram, BASE_1)
        # Compared by the upper bits, then by place.
        value = (h & ~_PLACE) | at.astype(np.uint64)
        # Sliding minimum from running minima to both sides of every span-th place.
        grid = np.concatenate([value, np.full(-len(h) % span, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, span)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        low = np.minimum(behind[:m], ahead[span - 1 : span - 1 + m])
        start = group_starts(low)
        out.append((h[low[start] & _PLACE], start + i, np.diff(np.append(start, m))))
    return tuple(np.concatenate(x) for x in zip(*out))


def _text_key(data: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(data.tobytes()) >> 1


def _text_hash(text: str) -> tuple[int, int]:
    """Two hashes of a text; the second is its key."""
    raw = text.encode("utf-8", "surrogatepass")
    return xxhash.xxh3_64_intdigest(raw), xxhash.xxh64_intdigest(raw) >> 1


def _doc(doc_id) -> int:
    return NO_ID if doc_id is None or pd.isna(doc_id) else int(doc_id)


def _later_copies(block: int, ids, texts, length: int, known: Replies) -> frozenset[int]:
    """Documents of a block whose whole text, of ``length`` bytes at least, is that of an earlier document."""
    found = [(k, *_text_hash(t), _doc(i)) for k, (i, t) in enumerate(zip(ids, texts)) if len((t or "").encode("utf-8", "surrogatepass")) >= length]
    if not found:
        return frozenset()
    k, h, key, did = (np.array(x) for x in zip(*found))
    h = h.astype(np.uint64)
    hit, at = known.find(h)
    order = np.lexsort((k, did, key, h))
    lead = np.zeros(len(k), bool)
    lead[order[group_starts(h[order], key[order])]] = True
    return frozenset(k[hit & ~(lead & known.first[at])].tolist()) if hit.any() else frozenset()


COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "rest"]
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, rest string"


def _finish(doc_id, data: np.ndarray, start: np.ndarray, end: np.ndarray, rest, with_text: bool) -> tuple:
    s, e = merge_spans(start, end)
    if len(s):
        edge = np.zeros(len(data) + 1, np.int8)
        edge[s], edge[e] = 1, -1
        kept = data[np.cumsum(edge[:-1]) == 0]
    else:
        kept = data
    raw = kept.tobytes()
    return doc_id, len(data), len(data) - len(kept), len(s), hashlib.sha256(raw).hexdigest(), raw.decode("utf-8", "ignore") if with_text else None, rest


# What is known of a block's runs that occur elsewhere: document, gram, first
# window, windows, whether the gram is hot; and spans that are settled already.
FOUND = "block long, doc binary, gram binary, start binary, size binary, hot binary, gone_doc binary, gone_start binary, gone_end binary"
_KINDS = {"doc": np.int32, "gram": np.uint64, "start": np.int64, "size": np.int64, "hot": bool, "gone_doc": np.int32, "gone_start": np.int64, "gone_end": np.int64}


def _read(row, names: tuple[str, ...]) -> list[np.ndarray]:
    """Columns of a joined row as arrays; empty where the block has no row."""
    return [np.frombuffer(row[n], _KINDS[n]) if row[n] is not None else np.zeros(0, _KINDS[n]) for n in names]


class _Docs:
    """The documents of a block, encoded when they are asked for."""

    def __init__(self, block: int, ids, texts):
        self.block, self.ids, self.texts = block, ids, texts
        self._known: dict[int, tuple] = {}

    def get(self, k: int) -> tuple[bytes, tuple[int, int, int]]:
        """Bytes, and the document's place in the order of documents."""
        if k not in self._known:
            raw = (self.texts[k] or "").encode("utf-8", "surrogatepass")
            self._known[k] = raw, (_doc(self.ids[k]), xxhash.xxh64_intdigest(raw) >> 1, row_number(self.block, k))
        return self._known[k]

    def cut(self, doc: np.ndarray, start: np.ndarray, size: np.ndarray, length: int) -> tuple[list[bytes], np.ndarray]:
        """The runs' bytes and the order of their documents (3 x runs)."""
        text = [self.get(k)[0][s : s + n + length - 1] for k, s, n in zip(doc.tolist(), start.tolist(), size.tolist())]
        whose = np.array([self.get(k)[1] for k in doc.tolist()], np.int64).reshape(-1, 3).T
        return text, whose


def _hot_windows(data: np.ndarray, start: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of every window of the given runs."""
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out = np.empty(len(at), np.uint64)
    for i in range(0, len(at), _CHUNK):
        p = at[i : i + _CHUNK]
        values = data[p[0] : p[-1] + length].astype(np.uint64) + np.uint64(1)
        out[i : i + _CHUNK] = span_hashes(prefix_sums(values, BASE_2), p - p[0], p - p[0] + length, BASE_2)
    return out, at


RUNS = "bucket int, data binary"
_FIELDS = ("gram", "did", "key", "row", "start", "size")


def _run_packets(gram, whose, start, size, text: list[bytes], buckets: int) -> pd.DataFrame:
    """A block's runs by bucket of their gram, compressed."""
    bucket = ((gram >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    by = np.argsort(bucket, kind="stable")
    fields = [x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64) for x in (gram, *whose, start, size)]
    out = []
    zip_ = zstandard.ZstdCompressor(level=3)
    for part in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
        if len(part):
            raw = b"".join([len(part).to_bytes(8, "little"), *(f[part].tobytes() for f in fields), *(text[i] for i in part.tolist())])
            out.append((int(bucket[part[0]]), zip_.compress(raw)))
    return table(out, ["bucket", "data"])


def _unpack_runs(data: list[bytes], length: int) -> pd.DataFrame:
    """All runs of a bucket, sorted by gram."""
    columns, text = [], []
    unzip = zstandard.ZstdDecompressor()
    for x in data:
        raw = unzip.decompress(x)
        n = int.from_bytes(raw[:8], "little")
        fields = np.frombuffer(raw, np.int64, 6 * n, 8).reshape(6, n)
        columns.append(fields)
        at = 8 + 48 * n
        end = at + np.cumsum(fields[5] + length - 1)
        text += [raw[a:z] for a, z in zip([at, *end[:-1].tolist()], end.tolist())]
    rows = pd.DataFrame(dict(zip(_FIELDS, np.concatenate(columns, axis=1))))
    return rows.assign(text=text).sort_values("gram", kind="stable", ignore_index=True)


def _settle(length: int):
    """Per gram: spans (block, idx, s, e) of the windows that start earlier elsewhere."""

    def marks(rows: pd.DataFrame) -> pd.DataFrame | None:
        gram, did, key, row, start, size = (rows[c].to_numpy() for c in ("gram", "did", "key", "row", "start", "size"))
        text = rows["text"].to_numpy()
        same, _ = pd.factorize(rows["text"])
        by_doc = np.lexsort((row, key, did))
        rank = np.empty(len(rows), np.int64)
        rank[by_doc] = np.cumsum(np.concatenate([[0], (np.diff(row[by_doc]) != 0) | (np.diff(key[by_doc]) != 0) | (np.diff(did[by_doc]) != 0)]))
        place = (rank << 32) | start
        order = np.lexsort((place, same))
        lead = group_starts(same[order])
        first = np.zeros(len(rows), bool)
        first[order[lead]] = True
        later = np.flatnonzero(~first)
        out = [(row[later], start[later], start[later] + size[later] - 1 + length)]
        # Different runs of one gram.
        of_gram, n_gram = np.unique(gram[first], return_inverse=True, return_counts=True)[1:]
        reps = np.flatnonzero(first)[n_gram[of_gram] > 1]
        if len(reps):
            raw = [np.frombuffer(text[r], np.uint8) for r in reps]
            sizes = np.array([len(x) + 1 for x in raw])
            whole = np.zeros(int(sizes.sum()), np.int64)
            begin = np.cumsum(sizes) - sizes
            joined = np.concatenate(raw).astype(np.int64) + 1
            inside = np.ones(len(whole), bool)
            inside[begin + sizes - 1] = False
            whole[inside] = joined
            symbols = np.unique(whole, return_inverse=True)[1].astype(np.uint16)
            suffix, cls = common_prefix_classes(symbols, length)
            owner = np.repeat(np.arange(len(reps)), sizes)
            offset = np.arange(len(whole)) - begin[owner]
            o = owner[suffix]
            window = offset[suffix] < size[reps][o]
            suffix, cls, o = suffix[window], cls[window], o[window]
            where = place[reps][o] + offset[suffix]
            lead = group_starts(cls)
            low = np.repeat(np.minimum.reduceat(where, lead), np.diff(np.append(lead, len(cls))))
            late = where > low
            at = np.sort(suffix[late])
            if len(at):
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(at) != 1) | (owner[at][1:] != owner[at][:-1])
                f = np.flatnonzero(new)
                last = at[np.append(f[1:], len(at)) - 1]
                r = reps[owner[at[f]]]
                out.append((row[r], start[r] + offset[at[f]], start[r] + offset[last] + length))
        row, s, e = (np.concatenate(x) for x in zip(*out))
        if not len(row):
            return None
        block = ((row >> 39) << 32) | ((row >> 19) & 0xFFFFF)
        # The spans of a document that touch are one.
        by = np.lexsort((s, row))
        row, block, s, e = row[by], block[by], s[by], e[by]
        return pd.DataFrame({"block": block, "idx": (row & 0x7FFFF).astype(np.int32), "s": s, "e": e})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for packets_ in whole_groups(batches, ["bucket"]):
            for _, part in packets_.groupby("bucket", sort=False):
                rows = _unpack_runs(list(part["data"]), length)
                # Pieces of whole grams that fit a processor's cache.
                edges = np.append(group_starts(rows["gram"].to_numpy()), len(rows))
                at = 0
                while at < len(rows):
                    end = int(edges[min(np.searchsorted(edges, at + _PIECE), len(edges) - 1)])
                    found = marks(rows.iloc[at:end])
                    if found is not None:
                        yield found
                    at = end

    return run


def remove_duplicate_spans(docs: DataFrame, length: int = LENGTH, with_text: bool = False, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, and with ``with_text`` the kept text and, as JSON in ``rest``,
    the other columns."""
    spark = docs.sparkSession
    gram = min(GRAM, length)
    keep = [c for c in docs.columns if c not in ("doc_id", "text")] if with_text else []
    blocks = text_blocks(docs, keep=keep, bucketed=True)

    def send_grams(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block, texts in zip(b["block"], b["texts"]):
                found = [np.zeros(0, np.uint64)]
                for t in texts:
                    found.append(gram_runs(text_bytes(t), length, gram)[0])
                yield packets(block, np.concatenate(found), buckets)

    hits, _ = repeated(blocks.select("block", "texts"), send_grams)

    def send_texts(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block, ids, texts in zip(b["block"], b["doc_id"], b["texts"]):
                found = [(*_text_hash(t), _doc(i), row_number(block, k)) for k, (i, t) in enumerate(zip(ids, texts)) if len((t or "").encode("utf-8", "surrogatepass")) >= length]
                if found:
                    h, key, did, row = zip(*found)
                    yield packets(block, np.array(h, np.uint64), buckets, order=(np.array(did), np.array(key), np.array(row)), by_key=True)

    copies, _ = repeated(blocks.select("block", "doc_id", "texts"), send_texts, ordered=True, by_key=True)

    def find_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block, ids, texts, replies, twins in zip(*(b[c] for c in ("block", "doc_id", "texts", "replies", "twins"))):
                if replies is None:
                    continue
                known, docs_ = Replies(replies), _Docs(block, ids, texts)
                later = _later_copies(block, ids, texts, length, Replies(twins)) if twins is not None else frozenset()
                parts, gone = [], [(k, 0, len(docs_.get(k)[0])) for k in sorted(later)]
                for k, t in enumerate(texts):
                    if k not in later:
                        g, s, n = gram_runs(text_bytes(t), length, gram)
                        hit, at = known.find(g)
                        if hit.any():
                            parts.append((np.full(int(hit.sum()), k, np.int32), g[hit], s[hit], n[hit], known.total[at[hit]] > hot))
                doc, g, s, n, is_hot = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, _KINDS[c]) for c in ("doc", "gram", "start", "size", "hot"))
                # Of equal runs in the block, the first goes on; the others start later for certain.
                text, whose = docs_.cut(doc, s, n, length)
                same = pd.factorize(np.array(text, object))[0] if text else np.zeros(0, np.int64)
                order = np.lexsort((s, whose[2], whose[1], whose[0], same))
                first = np.zeros(len(same), bool)
                first[order[group_starts(same[order])]] = True
                on = first | is_hot
                gone += list(zip(doc[~on].tolist(), s[~on].tolist(), (s[~on] + n[~on] + (length - 1)).tolist()))
                gd, gs, ge = (np.array(x) for x in zip(*gone)) if gone else (np.zeros(0),) * 3
                values = dict(doc=doc[on], gram=g[on], start=s[on], size=n[on], hot=is_hot[on], gone_doc=gd, gone_start=gs, gone_end=ge)
                yield table([(block, *(values[c].astype(_KINDS[c]).tobytes() for c in _KINDS))], ["block", *_KINDS])

    met = blocks.select("block", "doc_id", "texts").join(hits, "block", "left").join(copies.withColumnRenamed("replies", "twins"), "block", "left")
    found = stored(met.mapInPandas(find_runs, FOUND), "runs")

    buckets = 2 * n_buckets(spark)
    with_runs = blocks.select("block", "doc_id", "texts").join(found, "block")

    def send_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, r in b.iterrows():
                doc, g, s, n, is_hot = _read(r, ("doc", "gram", "start", "size", "hot"))
                doc, g, s, n = (x[~is_hot] for x in (doc, g, s, n))
                if len(doc):
                    text, whose = _Docs(r["block"], r["doc_id"], r["texts"]).cut(doc, s, n, length)
                    yield _run_packets(g, whose, s, n, text, buckets)

    runs = with_runs.mapInPandas(send_runs, RUNS).repartition(n_buckets(spark), "bucket").sortWithinPartitions("bucket")
    spans = runs.mapInPandas(_settle(length), "block long, idx int, s long, e long")
    spans = spans.groupBy("block").agg(F.collect_list(F.struct("idx", "s", "e")).alias("spans"))

    def hot_of(r):
        """hash, doc_id, text key, row, place of the hot windows of a block."""
        doc, s, n, is_hot = _read(r, ("doc", "start", "size", "hot"))
        docs_, out = _Docs(r["block"], r["doc_id"], r["texts"]), []
        for k in np.unique(doc[is_hot]).tolist():
            mine = is_hot & (doc == k)
            raw, whose = docs_.get(k)
            h, at = _hot_windows(np.frombuffer(raw, np.uint8), s[mine], n[mine], length)
            out.append((h, *(np.full(len(h), x, np.int64) for x in whose), at))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else None

    def send_hot(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, r in b.iterrows():
                windows = hot_of(r)
                if windows is not None:
                    yield packets(r["block"], windows[0], buckets, order=windows[1:4])

    again, _ = repeated(with_runs, send_hot, ordered=True)

    def close_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, r in b.iterrows():
                who, s, e = _read(r, ("gone_doc", "gone_start", "gone_end"))
                if r["spans"] is not None:
                    more = np.array([(x["idx"], x["s"], x["e"]) for x in r["spans"]], np.int64).reshape(-1, 3).T
                    who, s, e = (np.concatenate(x) for x in zip((who, s, e), more))
                windows = hot_of(r) if r["replies"] is not None else None
                if windows is not None:
                    known = Replies(r["replies"])
                    h, did, key, number, at = windows
                    hit, where = known.find(h)
                    order = np.lexsort((at, number, key, did, h))
                    lead = np.zeros(len(h), bool)
                    lead[order[group_starts(h[order])]] = True
                    late = hit & ~(lead & known.first[where])
                    who = np.concatenate([who, number[late] & 0x7FFFF])
                    s, e = np.concatenate([s, at[late]]), np.concatenate([e, at[late] + length])
                by = np.argsort(who, kind="stable")
                who, s, e = who[by], s[by], e[by]
                out = []
                for k, (i, t, rest) in enumerate(zip(r["doc_id"], r["texts"], r["rests"])):
                    a, z = np.searchsorted(who, [k, k + 1])
                    out.append(_finish(None if i is None or pd.isna(i) else int(i), text_bytes(t), s[a:z], e[a:z], rest, with_text))
                yield table(out, COLUMNS)

    ended = blocks.join(found, "block", "left").join(spans, "block", "left").join(again, "block", "left")
    return ended.mapInPandas(close_documents, RESULT)


def dedup_text(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the duplicate spans taken out of the text; n_chars, if there is one, follows."""
    found = remove_duplicate_spans(docs, length, with_text=True)
    others = [f for f in docs.schema.fields if f.name not in ("doc_id", "text")]
    rest = F.from_json("rest", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)) if others else None
    columns = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept")}
    for f in others:
        columns[f.name] = F.length("kept").cast(f.dataType) if f.name == "n_chars" else rest[f.name]
    return found.select(*(columns[c].alias(c) for c in docs.columns))


def op5_suffixes(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_duplicate_spans(docs).drop("kept", "rest")


# Every window as a row: for small tables.
OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, p, b[p:p + {LENGTH - 1}] AS seq FROM (SELECT r, b, unnest(range(1, octet_length(b) - {LENGTH - 2})) AS p FROM d WHERE octet_length(b) >= {LENGTH})),
late AS (SELECT r, p FROM (SELECT r, p, row_number() OVER (PARTITION BY seq ORDER BY r, p) AS n FROM w) WHERE n > 1),
y AS (SELECT r, p, substr(h, 2 * p - 1, 2) AS byte FROM (SELECT r, hex(b) AS h, unnest(range(1, octet_length(b) + 1)) AS p FROM d)),
c AS (SELECT r, p, byte, max((late.p IS NOT NULL)::INTEGER) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN {LENGTH - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM y LEFT JOIN late USING (r, p)),
e AS (SELECT *, gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY r ORDER BY p), 0) = 0 AS opens FROM c),
k AS (SELECT r, sum(gone)::BIGINT AS n_removed, count_if(opens)::BIGINT AS n_spans, string_agg(byte, '' ORDER BY p) FILTER (WHERE gone = 0) AS kept FROM e GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""
