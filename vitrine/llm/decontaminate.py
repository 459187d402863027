"""Benchmark decontamination by latent semantic retrieval.

Benchmark items and windows of documents are TF-IDF vectors over the items'
words (document frequencies counted over all documents). A randomised SVD of the
items gives a latent space. Every document is cut into overlapping windows of each
width that items need. A window and an item of its width are candidates from a
cosine of ``COSINE`` in the latent space on; the cosine is taken wherever a window
holds enough of the words of the item's answer (its last sentence, or the last third
of a single one), as no other could pass. Words outside the items' vocabulary have
no part in the space, so rare words around an item do not lower its cosine.
Candidates are verified by the longest common subsequence of words: a paraphrase has
a share of ``LOOSE`` of the item's words, and ``ANSWER`` of its answer's.

A threshold on a cosine can lose copies whose words are all common. So windows with
enough of an item's rarest words, which every window with a share of ``ALIKE`` of
the item's words has, are compared too, whatever their cosine; a share of ``SAME``
marks the document, and one of ``ALIKE`` does with the answer.

Words are runs of letters, digits and non-ASCII bytes of the lower-cased text, so
case, spacing and punctuation make no difference; in scripts that are written
without spaces every character is a word. The items are taken in blocks of bounded
size; each block is a pass over the documents.

Defined cases: null or empty texts and items match nothing; items of fewer than
``MIN_WORDS`` words are found by the exact sequence of all their words, answer
included (a part of one occurs by chance), with shares and cosine of 1; items that
repeat are found under each item_id; rows that repeat are one document; empty
tables give no matches; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.anchors import word_hashes
from vitrine.llm.common import group_starts, stored, table, text_bytes, word_bounds

RANK = 128
COSINE = 0.6
SAME = 0.8
ALIKE = 0.6
LOOSE = 0.4
ANSWER = 0.8
MIN_WORDS = 8
HITS = 4
ANSWER_HITS = 2
PIECE = 1 << 16
ROWS = 1 << 9
ITEM_BYTES = 1 << 20

_CODES = np.arange(256)
_GAPS = ~((_CODES >= 128) | ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 97) & (_CODES <= 122)))


# Thai, Lao, Burmese, Khmer, kana and Han characters.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def tokens(text: str | None) -> np.ndarray:
    text = (text or "").lower()
    data = text_bytes(text)
    if len(data) and data.max() >= 0xE0:  # a character of three bytes or more
        data = text_bytes(_UNSPACED.sub(r" \1 ", text))
    return word_hashes(data, *word_bounds(data, _GAPS))


def answer_words(text: str) -> int:
    """How many words at the end of an item are its answer."""
    parts = [n for n in (len(tokens(p)) for p in re.split(r"[.?!]\s", text)) if n]
    total = sum(parts)
    return parts[-1] if len(parts) > 1 and 3 <= parts[-1] < total else max(1, total // 3)


def _places(a: list[int]) -> dict[int, int]:
    """A bit per place of each word."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    return at


def _lcs(at: dict[int, int], n: int, b: list[int]) -> int:
    """Length of the longest common subsequence with n words at these places, bit-parallel over them."""
    full = (1 << n) - 1
    v = full
    for x in b:
        if x in at:
            u = v & at[x]
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def lcs(a: list[int], b: list[int]) -> int:
    return _lcs(_places(a), len(a), b)


def _weights(ids: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a bag of words and their weights: the count times idf."""
    term, count = np.unique(ids, return_counts=True)
    return term, count * idf[term]


def _least(length: int, share: float) -> int:
    """The fewest shared words that are such a share of an item's."""
    return next(n for n in range(length + 1) if n / length >= share)


class Short:
    """Items of fewer than ``MIN_WORDS`` words, found where all their words stand in sequence."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items: dict[int, dict[bytes, list[int]]] = {}
        for item_id, words in items:
            self.items.setdefault(len(words), {}).setdefault(words.tobytes(), []).append(item_id)
        self.mixed = {n: np.unique([self._mix(np.frombuffer(w, np.uint64), n)[0] for w in same]) for n, same in self.items.items()}

    @staticmethod
    def _mix(words: np.ndarray, n: int) -> np.ndarray:
        """A number for every run of n words; the words of equal numbers are compared."""
        out = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(out)].astype(np.uint64)
        return out

    def matches(self, found: np.ndarray) -> set[int]:
        held: set[int] = set()
        for n, same in self.items.items():
            if len(found) >= n:
                for p in np.flatnonzero(np.isin(self._mix(found, n), self.mixed[n])).tolist():
                    held.update(same.get(found[p : p + n].tobytes(), ()))
        return held


class Rare:
    """Lists of words (items, then their answers) by the rarest words of each.

    A list of L words that shares at least ``least`` of them with a span shares
    ``hits`` of its L - least + hits rarest ones too, as no more than L - least are
    missing. So every span that shares so many has as many of these."""

    def __init__(self, lists: list[tuple[np.ndarray, float, int]], idf: np.ndarray):
        words = [w for w, _, _ in lists]
        least = [_least(len(w), share) for w, share, _ in lists]
        self.hits = np.array([min(hits, n) for n, (_, _, hits) in zip(least, lists)])
        rare = [np.unique(w[np.argsort(-idf[w], kind="stable")[: len(w) - n + h]]) for w, n, h in zip(words, least, self.hits.tolist())]
        term, item = np.concatenate(rare), np.repeat(np.arange(len(rare)), [len(r) for r in rare])
        # Those of word t are holds[first[t] : first[t + 1]].
        self.holds = item[np.argsort(term, kind="stable")]
        self.first = np.searchsorted(np.sort(term), np.arange(len(idf) + 1))


class Model:
    """The latent space of one block of items, and the items' rarest words: by those of
    an answer a window is compared in the latent space, by those of an item directly, so
    that no share of ``ALIKE`` is lost, however common the words are."""

    def __init__(self, items: list[tuple[int, str]], vocabulary: np.ndarray, idf: np.ndarray, space: np.ndarray, short: list[tuple[int, np.ndarray]] = ()):
        self.short = Short(short)
        self.item_ids = [i for i, _ in items]
        if not items:
            return
        self.vocabulary, self.idf = vocabulary, idf
        self.space = (space * idf[:, None]).astype(np.float32)
        self.words = [np.searchsorted(vocabulary, tokens(t)) for _, t in items]
        self.answers = [answer_words(t) for _, t in items]
        self.places = [(_places(w.tolist()), _places(w[-n:].tolist())) for w, n in zip(self.words, self.answers)]
        self.latent = np.stack([self._project(w) for w in self.words])
        # Widths grow by half, each item belongs to the first that holds it.
        length = np.array([len(w) for w in self.words])
        widths = [MIN_WORDS]
        while widths[-1] < length.max():
            widths.append(widths[-1] + widths[-1] // 2)
        self.width = np.array(widths)[np.searchsorted(widths, length)]
        self.step = self.width // 4
        # The window and half an item to both sides of it.
        self.span = self.width + 3 * self.step
        self.sizes = [np.tile(x, 2) for x in (self.width, self.step, self.span)]
        answers = [w[-n:] for w, n in zip(self.words, self.answers)]
        self.rare = Rare([(w, ALIKE, HITS) for w in self.words] + [(w, ANSWER, ANSWER_HITS) for w in answers], idf)

    def _project(self, ids: np.ndarray) -> np.ndarray:
        y = self.space[ids].sum(axis=0, dtype=np.float64)
        return (y / max(float(np.sqrt((y**2).sum())), 1e-12)).astype(np.float32)

    def _similar(self, ids: np.ndarray, item: np.ndarray, window: np.ndarray) -> Iterator[tuple[int, int]]:
        """Those of the pairs (item, window) whose cosine is ``COSINE`` or more."""
        order = np.argsort(window * self.step[item], kind="stable")
        at = np.flatnonzero(ids >= 0)
        for low in range(0, len(order), ROWS):
            j, k = item[order[low : low + ROWS]], window[order[low : low + ROWS]]
            begin, end = (np.searchsorted(at, x) for x in self._bounds(j, k, len(ids)))
            # Running sums over the words of the items from the first window to the last.
            first, last = begin.min(), end.max()
            total = np.zeros((last - first + 1, self.space.shape[1]), np.float32)
            np.cumsum(self.space[ids[at[first:last]]], axis=0, out=total[1:])
            y = total[end - first]
            y -= total[begin - first]
            length = np.sqrt(np.einsum("ij,ij->i", y, y))
            near = np.einsum("ij,ij->i", y, self.latent[j]) >= COSINE * np.maximum(length, 1e-12)
            yield from zip(j[near].tolist(), k[near].tolist())

    def _bounds(self, item, window, n: int):
        """Where a window of an item's width begins and ends in a text of n words."""
        begin = window * self.step[item]
        return begin, np.minimum(begin + self.step[item] + self.width[item], n)

    def _holding(self, ids: np.ndarray, n: int, begin: int) -> tuple[np.ndarray, np.ndarray]:
        """(item, window) of the windows of a text of n words that hold enough rare words
        of an item, or of answer i as item number ``len(items) + i``; ``ids`` are the
        text's words from ``begin`` on."""
        rare, (width, step, span) = self.rare, self.sizes
        at = np.flatnonzero(ids >= 0)
        low, count = rare.first[ids[at]], rare.first[ids[at] + 1] - rare.first[ids[at]]
        item = rare.holds[np.arange(count.sum()) + np.repeat(low - np.cumsum(count) + count, count)]
        at = np.repeat(at + begin, count)
        order = np.argsort(item, kind="stable")
        item, at = item[order], at[order]
        # Hits that have enough others of their item within a span.
        near = np.zeros(len(at), bool)
        for hits in np.unique(rare.hits).tolist():
            last = np.arange(hits - 1, len(at))
            start = last - (hits - 1)
            full = start[(rare.hits[item[start]] == hits) & (item[start] == item[last]) & (at[last] - at[start] < span[item[start]])]
            for i in range(hits):
                near[full + i] = True
        item, at = item[near], at[near]
        step = step[item]
        low = np.maximum((at - width[item] - 2 * step) // step + 1, 0)
        high = np.minimum(at // step + 1, (np.maximum(1, n - step) - 1) // step)
        count = np.maximum(high - low + 1, 0)
        window = np.arange(count.sum()) + np.repeat(low - np.cumsum(count) + count, count)
        # Sorted by item and place, so nearly sorted by window: cheap to sort.
        key = np.sort(np.repeat(item, count) * (n + 1) + window, kind="stable")
        first = group_starts(key)
        key, found = key[first], np.diff(first, append=len(key))
        key = key[found >= rare.hits[key // (n + 1)]]
        return key // (n + 1), key % (n + 1)

    def _verify(self, ids: np.ndarray, j: int, k: int, share: float, best: dict[int, tuple[float, float, float]]) -> None:
        """Compare window k with item j, and keep the item's best (lcs share, answer share, cosine)."""
        b, e = map(int, self._bounds(j, k, len(ids)))
        step, (places, tail) = int(self.step[j]), self.places[j]
        span = ids[max(0, b - step) : e + step].tolist()
        shared = _lcs(places, len(self.words[j]), span) / len(self.words[j])
        if shared < share:
            return
        answer = _lcs(tail, self.answers[j], span) / self.answers[j]
        if shared >= SAME or answer >= ANSWER:
            bag = ids[b:e]
            cosine = float(self.latent[j] @ self._project(bag[bag >= 0]))
            best[j] = max(best.get(j, (0.0, 0.0, -1.0)), (shared, answer, cosine))

    def matches(self, text: str | None) -> list[tuple[int, float, float, float]]:
        """(item_id, cosine, lcs share, answer share) of the items that a text holds."""
        found = tokens(text)
        held = [(i, 1.0, 1.0, 1.0) for i in self.short.matches(found)]
        if not self.item_ids or len(found) < MIN_WORDS * LOOSE:
            return held
        ids = np.searchsorted(self.vocabulary, found)
        ids[ids == len(self.vocabulary)] = 0
        ids = np.where(self.vocabulary[ids] == found, ids, -1)
        best: dict[int, tuple[float, float, float]] = {}
        # Pieces of a text overlap by a span, so each span is whole in one of them.
        for piece in range(0, len(ids), PIECE):
            part = ids[piece : piece + PIECE + int(self.span.max())]
            item, window = self._holding(part, len(ids), piece)
            cut = int(np.searchsorted(item, len(self.item_ids)))
            for j, k in zip(item[:cut].tolist(), window[:cut].tolist()):
                self._verify(ids, j, k, ALIKE, best)
            for j, k in self._similar(ids, item[cut:] - len(self.item_ids), window[cut:]):
                self._verify(ids, j, k, LOOSE, best)
        return held + [(self.item_ids[j], c, s, a) for j, (s, a, c) in best.items()]


def _space(items: DataFrame, vocabulary: np.ndarray, idf: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors of the items' TF-IDF matrix A by a randomised range
    finder: an orthonormal basis Q of A'A's action on random directions, then the
    eigenvectors of (AQ)'(AQ). Each sum over items is a pass of Spark tasks that
    return one small matrix each; its size is bounded by the block of items."""
    size = len(vocabulary)
    width = min(rank + 10, size)

    def add_up(f, shape: tuple[int, int]) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(shape)
            for b in batches:
                for t in b["text"]:
                    term, weight = _weights(np.searchsorted(vocabulary, tokens(t)), idf)
                    f(total, term, weight / max(np.sqrt((weight**2).sum()), 1e-12))
            yield pd.DataFrame({"m": [total.tobytes()]})

        out = np.zeros(shape)
        for r in items.mapInPandas(run, "m binary").toLocalIterator():
            out += np.frombuffer(r["m"]).reshape(shape)
        return out

    def sketch(total: np.ndarray, term: np.ndarray, weight: np.ndarray) -> None:
        total[term] += np.outer(weight, weight @ directions[term])

    directions = np.random.default_rng(7).standard_normal((size, width))
    directions = np.linalg.qr(add_up(sketch, (size, width)))[0]  # one power iteration
    basis = np.linalg.qr(add_up(sketch, (size, width)))[0]

    def gram(total: np.ndarray, term: np.ndarray, weight: np.ndarray) -> None:
        y = weight @ basis[term]
        total += np.outer(y, y)

    value, vector = np.linalg.eigh(add_up(gram, (width, width)))
    return basis @ vector[:, ::-1][:, :rank]


def models(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> Iterator[Model]:
    """A model per block of items."""
    items = benchmark.filter("text IS NOT NULL AND item_id IS NOT NULL").select("item_id", "text").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    n = -(-size // ITEM_BYTES)
    items = stored(items.withColumn("b", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n))).cast("int")), "items")
    for block in range(n):
        part = items.filter(F.col("b") == block)
        rows = [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]
        brief = [(i, w) for i, w in ((i, tokens(t)) for i, t in rows) if 0 < len(w) < MIN_WORDS]
        rows = [r for r in rows if len(tokens(r[1])) >= MIN_WORDS]
        if not rows:
            if brief:
                none = np.zeros(0)
                yield Model([], none, none, none, brief)
            continue
        vocabulary = np.unique(np.concatenate([tokens(t) for _, t in rows]))

        def frequencies(batches: Iterator[pd.DataFrame], vocabulary=vocabulary) -> Iterator[pd.DataFrame]:
            count, n_docs = np.zeros(len(vocabulary), np.int64), 0
            for b in batches:
                for t in b["text"]:
                    found = tokens(t)
                    at = np.searchsorted(vocabulary, found)
                    at[at == len(vocabulary)] = 0
                    count[np.unique(at[vocabulary[at] == found])] += 1
                    n_docs += 1
            at = np.flatnonzero(count)
            yield pd.DataFrame({"term": np.append(at, -1), "n": np.append(count[at], n_docs)})

        df = {r["term"]: r["n"] for r in docs.select("text").mapInPandas(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
        n_docs = df.get(-1, 0)
        seen = np.array([df.get(i, 0) for i in range(len(vocabulary))])
        idf = np.log((n_docs + 1) / (np.maximum(seen, 1))) + 1e-3
        searched = part.filter(F.col("text").isNotNull())
        short = MIN_WORDS

        def long_enough(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b[[len(tokens(t)) >= short for t in b["text"]]]

        space = _space(searched.select("text").mapInPandas(long_enough, "text string"), vocabulary, idf, rank)
        yield Model(rows, vocabulary, idf, space, brief)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, lcs, answer: a row per document and benchmark item that it holds."""
    schema = "doc_id string, item_id string, cosine double, lcs double, answer double"
    found = docs.sparkSession.createDataFrame([], schema)
    for model in models(docs, benchmark):

        def run(batches: Iterator[pd.DataFrame], model=model) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [(i, str(item), c, s, a) for i, t in zip(b["doc_id"], b["text"]) for item, c, s, a in model.matches(t)]
                yield table(rows, ["doc_id", "item_id", "cosine", "lcs", "answer"])

        found = found.union(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, schema))
    best = found.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"), F.max("answer").alias("answer"))
    return best.withColumns({"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "item_id": F.col("item_id").cast(benchmark.schema["item_id"].dataType)})


def _clean(model: Model):
    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        return pd.Series([not model.matches(t) for t in text], dtype=bool)

    return clean


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark item."""
    kept = docs
    for model in models(docs, benchmark):
        kept = kept.filter(_clean(model)("text"))
    return kept


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
