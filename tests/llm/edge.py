"""Small document tables with every awkward case, and plain brute-force answers."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import xxhash
from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
# Extra columns whose names clash with what operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, copies long, fp long, "
    "component_id long, score double, block long, text_key long, kept string, rest string, x int, _doc_id long, _copy int, n long, class int"
)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    passage = prose(60, 1)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b "),
        (4, "one"),
        (5, "one two"),
        (6, f"{prose(30, 2)} {passage} {prose(20, 3)}"),
        (7, f"{prose(25, 4)}\n{passage}\t{prose(20, 5)}"),
        (8, prose(120, 6)),
        (9, prose(120, 6)),
        (9, prose(120, 6)),
        (10, "spam " * 500),
        (11, "é" * 400 + " ü " + "日本語" * 60),
        (12, prose(30_000, 7)),
        (None, prose(50, 8)),
        (None, prose(50, 8)),
        (None, None),
        (13, prose(118, 6) + " zebra yak"),
        (14, "ONE Two\rthree " + passage),
        (15, "日本語" * 60),
    ]


def documents(spark: SparkSession, rows=None) -> DataFrame:
    sources = ["a", "b", None, "", "a"]
    rows = texts() if rows is None else rows
    full = [(i, t, None if k % 7 == 3 else "en", sources[k % 5], None if t is None else len(t), *([None] * 14)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text: str | None) -> int:
    w = split((text or "").translate(LOWER))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[int], bits: int) -> list[int]:
    """Index of the first member of each one's group."""
    first = list(range(len(prints)))

    def find(x: int) -> int:
        while first[x] != x:
            x = first[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                first[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(prints))]


def byte_dedup(rows: list[tuple], length: int) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, sha256) in order of doc_id, nulls last, by definition."""
    out, seen = [], set()
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode()) >> 1)):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for j in range(len(raw) - length + 1):
            if raw[j : j + length] in seen:
                gone[j : j + length] = b"\1" * length
            else:
                seen.add(raw[j : j + length])
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out.append((i, len(raw), len(raw) - len(kept), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def word_dedup(rows: list[tuple], window: int) -> list[tuple]:
    """(doc_id, n_words, n_removed, sha256) by definition."""
    words = [(i, split(t)) for i, t in rows]
    count = Counter(tuple(w[j : j + window]) for _, w in words for j in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = set()
        for j in range(len(w) - window + 1):
            if count[tuple(w[j : j + window])] > 1:
                gone.update(range(j, j + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
