"""Repeated passages by fixed-block anchors.

A window of n words always holds one of the non-overlapping reference blocks
of (n + 1) // 2 words, whatever its alignment. The blocks of all documents are
the index; every rolling window of that many words probes it. Around the hits,
the passages are extended to all windows of n words that hold a hit; of these,
the ones whose whole word sequence occurs again are the repeats, and their
union is the maximal exact repeats.

Defined cases: a null, empty or shorter text has no window and keeps all its
words; rows that repeat id and text are documents of their own (so they repeat
each other); an empty table gives no rows; other columns are not read. Sequences
are compared by 64-bit hashes of word hashes, dealt into buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.blocks import Replies, fold, packets, repeated, text_blocks
from vitrine.llm.common import BASE_1, BASE_2, WORD, prefix_sums, span_hashes, stored, table, text_bytes, word_bounds

WINDOW_WORDS = 35
_CHUNK = 1 << 18


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word, computed in chunks of words."""
    out = np.empty(len(start), np.uint64)
    for i in range(0, len(start), _CHUNK):
        s, e = start[i : i + _CHUNK], end[i : i + _CHUNK]
        prefix = prefix_sums(data[s[0] : e[-1]].astype(np.uint64) + np.uint64(1), BASE_1)
        out[i : i + _CHUNK] = span_hashes(prefix, s - s[0], e - s[0], BASE_1) + (e - s).astype(np.uint64)
    return out


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for i in range(0, n, _CHUNK):
        m = min(_CHUNK, n - i)
        prefix = prefix_sums(hashes[i : i + m + k - 1], BASE_2)
        at = np.arange(m)
        out[i : i + m] = span_hashes(prefix, at, at + k, BASE_2)
    return out


def _text_hashes(text: str | None) -> np.ndarray:
    data = text_bytes(text)
    return word_hashes(data, *word_bounds(data))


def _covered(hit: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in [p, p + width) of a place p that is hit."""
    edge = np.zeros(n + 1, np.int64)
    edge[: len(hit)] += hit
    edge[width : width + len(hit)] -= hit
    return np.cumsum(edge)[:n] > 0


def _windows_around(hit: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """Which windows hold an anchor that is hit."""
    if not len(hit):
        return hit
    total = np.concatenate([[0], np.cumsum(hit)])
    n, span = len(hit) - (window - anchor), window - anchor + 1
    return total[span : span + n] > total[:n]


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _finish(text: str | None, drop: np.ndarray | None, with_text: bool) -> tuple:
    found = (text or "").encode("utf-8", "surrogatepass").split()
    kept = found if drop is None else [w for w, d in zip(found, drop.tolist()) if not d]
    raw = b" ".join(kept)
    return len(found), len(found) - len(kept), hashlib.sha256(raw).hexdigest(), raw.decode("utf-8", "replace") if with_text else None


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one
    space) and, if asked for, those words as ``kept``; a row per row of ``docs``."""
    anchor = (window + 1) // 2
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    blocks = text_blocks(docs)

    def send_anchors(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block, texts in zip(b["block"], b["texts"]):
                probes, index = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
                for t in texts:
                    grams = rolling(_text_hashes(t), anchor)
                    if len(grams) > window - anchor:
                        probes.append(grams)
                        index.append(grams[::anchor])
                yield packets(block, np.concatenate(probes), buckets, True, fold(np.concatenate(index), buckets, True))

    hits, buckets = repeated(blocks, send_anchors, short=True)

    def open_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block, ids, texts, replies in zip(b["block"], b["doc_id"], b["texts"], b["replies"]):
                found = Replies(replies)
                rows, left = [], []
                for i, t in zip(ids, texts):
                    h = _text_hashes(t) if len(found.values) else np.zeros(0, np.uint64)
                    hit, _ = found.find(fold(rolling(h, anchor), buckets, True))
                    near = _windows_around(hit, window, anchor) if len(h) >= window else np.zeros(0, bool)
                    if near.any():
                        left.append((i, t, np.packbits(near).tobytes()))
                    else:
                        rows.append((i, *_finish(t, None, with_text), None, None, None, None))
                if left:
                    rows.append((None, None, None, None, None, block, *map(list, zip(*left))))
                yield table(rows, [*columns, "block", "ids", "texts", "near"])

    state = stored(
        blocks.join(hits, "block", "left").mapInPandas(open_documents, f"{RESULT}, block long, ids array<long>, texts array<string>, near array<binary>"),
        "opened",
    )
    closed = state.filter("texts IS NULL").select(*columns)
    left = state.filter("texts IS NOT NULL").select("block", "ids", "texts", "near")

    def windows(text: str | None, near: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        h = _text_hashes(text)
        at = np.flatnonzero(np.unpackbits(np.frombuffer(near, np.uint8), count=len(h) - window + 1))
        return rolling(h, window)[at], at, len(h)

    def send_windows(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block, texts, near in zip(b["block"], b["texts"], b["near"]):
                yield packets(block, np.concatenate([windows(t, n)[0] for t, n in zip(texts, near)]), buckets)

    again, _ = repeated(left, send_windows)

    def close_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for ids, texts, near, replies in zip(b["ids"], b["texts"], b["near"], b["replies"]):
                found = Replies(replies)
                out = []
                for i, t, n in zip(ids, texts, near):
                    h, at, words = windows(t, n)
                    hit = np.zeros(words - window + 1, bool)
                    hit[at] = found.find(h)[0]
                    out.append((i, *_finish(t, _covered(hit, window, words), with_text)))
                yield table(out, columns)

    return closed.union(left.join(again, "block", "left").mapInPandas(close_documents, RESULT))


def op9_anchors(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP9_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
w AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM d),
g AS (SELECT r, p, word, count(*) OVER f AS n, string_agg(word, ' ') OVER f AS seq FROM w
  WINDOW f AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND {WINDOW_WORDS - 1} FOLLOWING)),
again AS (SELECT seq FROM g WHERE n = {WINDOW_WORDS} GROUP BY seq HAVING count(*) > 1),
c AS (SELECT r, p, word, max((n = {WINDOW_WORDS} AND again.seq IS NOT NULL)::INTEGER) OVER
  (PARTITION BY r ORDER BY p ROWS BETWEEN {WINDOW_WORDS - 1} PRECEDING AND CURRENT ROW) AS gone FROM g LEFT JOIN again USING (seq)),
k AS (SELECT r, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""
