from __future__ import annotations

import random
import re

import numpy as np

from tests.llm import edge
from vitrine.llm import decontaminate as d

SF = "/root/testdata/sf0.01"


def test_planted_passages(spark):
    """Every document that holds an item word by word is found, and no other."""
    norm = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    items = [(r["item_id"], norm(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], norm(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {(i, k) for i, t in docs for k, x in items if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in d.op10_decontaminate(spark, SF).collect()}
    assert want and want <= got
    # What is found beyond that shares at least ALIKE of the item's words, in order.
    text, item = dict(docs), dict(items)
    for i, k in got - want:
        words = item[k].split()
        assert d.lcs([hash(w) for w in words], [hash(w) for w in text[i].split()]) >= d.ALIKE * len(words)


def fixture(spark):
    r = random.Random(4)
    items = [(k, edge.prose(30, 100 + k) + ". " + edge.prose(8, 200 + k) + ".") for k in range(30)]
    words = items[3][1].split()
    near = [w if r.random() > 0.08 else "other" for w in words]
    reworded = [w for k, w in enumerate(words) if k >= 30 or k % 3]  # a third of the question gone, the answer whole
    no_answer = words[:24] + edge.prose(14, 9).split()
    rows = [
        (1, edge.prose(80, 1) + " " + items[3][1] + " " + edge.prose(200, 2)),
        (2, edge.prose(80, 3) + " " + " ".join(near).upper() + " " + edge.prose(10, 4)),
        (3, edge.prose(300, 5) + " " + " ".join(reworded)),
        (4, edge.prose(50, 6) + " " + " ".join(no_answer) + " " + edge.prose(50, 7)),
        (5, edge.prose(400, 8)),
    ]
    return items, rows


def test_paraphrases(spark):
    items, rows = fixture(spark)
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "too short to search"), (93, items[3][1])], "item_id long, text string")
    docs = edge.documents(spark, [*edge.texts(), *[(100 + i, t) for i, t in rows], (101, rows[0][1])])
    got = {(r["doc_id"], r["item_id"]): r for r in d.contaminated(docs, bench).collect()}
    assert set(got) == {(100 + i, k) for i in (1, 2, 3) for k in (3, 93)}
    assert got[(101, 3)]["lcs"] == 1.0 and d.ALIKE <= got[(103, 3)]["lcs"] < d.SAME
    clean = d.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert sorted((r["doc_id"] for r in clean.collect()), key=str) == sorted([i for i, _ in edge.texts()] + [104, 105], key=str)


def test_case_beyond_ascii(spark):
    item = "Éai éonleeau pour an éonqueê aivi ai, éenaitreoiaux éoiré anvitre èenreré èèequepaè. Oueuxoi les laèèleré."
    docs = edge.documents(spark, [(1, edge.prose(60, 1) + " " + item.upper() + "!! " + edge.prose(60, 2)), (2, edge.prose(100, 3))])
    found = d.contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"], r["lcs"]) for r in found] == [(1, 7, 1.0)]


def test_common_words_in_a_large_corpus(spark):
    """An item of words that every document has is found between words that no item has."""
    item = "the state of the water in the well is known to the men who draw from it every day"
    words = item.split()
    r = random.Random(3)
    rows = [(k, " ".join(r.sample(words, len(words)))) for k in range(400)]
    rare = " ".join(f"rare{i}" for i in range(60))
    rows.append((1000, f"{rare} {item} {rare}"))
    bench = spark.createDataFrame([(1, item), (2, edge.prose(30, 5))], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["lcs"] for x in d.contaminated(edge.documents(spark, rows), bench).collect()}
    assert got.get((1000, 1)) == 1.0


def test_no_candidate_is_lost(monkeypatch):
    """Every window that shares enough of an item, in order, is found, in pieces too."""
    r = random.Random(11)
    names = [f"w{i}" for i in range(60)]
    pick = lambda n: [names[min(int(r.expovariate(0.12)), 59)] for _ in range(n)]
    items = [(k, " ".join(pick(r.randrange(8, 45)))) for k in range(25)]
    vocabulary = np.unique(np.concatenate([d.tokens(t) for _, t in items]))
    idf = np.array([r.random() * 5 for _ in vocabulary])
    model = d.Model(items, vocabulary, idf, np.eye(len(vocabulary)))
    monkeypatch.setattr(d, "PIECE", 50)
    place = {w: int(np.searchsorted(vocabulary, d.tokens(w)[0])) for w in names if d.tokens(w)[0] in vocabulary}

    def cosine(a, b):
        u, v = np.zeros(len(vocabulary)), np.zeros(len(vocabulary))
        for x, words in ((u, a), (v, b)):
            for w in words:
                k = place.get(w)
                if k is not None:
                    x[k] += idf[k]
        return u @ v / max(np.sqrt((u @ u) * (v @ v)), 1e-12)

    hits = latent = 0
    for _ in range(60):
        text = pick(r.randrange(1, 150)) + [w for w in r.choice(items)[1].split() if r.random() > 0.25] + pick(r.randrange(1, 150))
        text = [w if r.random() > 0.1 else f"x{r.randrange(99)}" for w in text]
        want = {}
        for j, (item_id, item) in enumerate(items):
            words, step = item.split(), int(model.step[j])
            tail = words[-model.answers[j] :]
            for b in range(0, max(1, len(text) - step), step):
                span = text[max(0, b - step) : min(b + step + int(model.width[j]), len(text)) + step]
                shared, answer = d.lcs(words, span) / len(words), d.lcs(tail, span) / len(tail)
                near = cosine(words, text[b : min(b + step + int(model.width[j]), len(text))]) >= d.COSINE
                latent += near and d.LOOSE <= shared < d.ALIKE and answer >= d.ANSWER
                if shared >= d.SAME or (shared >= (d.LOOSE if near else d.ALIKE) and answer >= d.ANSWER):
                    want[item_id] = max(want.get(item_id, (0, 0)), (shared, answer))
        assert {i: (s, a) for i, _, s, a in model.matches(" ".join(text))} == want
        hits += len(want)
    assert hits > 60 and latent > 10


def test_reworded_and_reordered(spark):
    """Paraphrases that share less than ALIKE in order, with the whole answer, planted in real documents:
    those that brute force finds by LCS and answer alone are found by the latent search."""
    r = random.Random(5)
    split = lambda t: re.findall(r"\w+", t or "")
    items = {x["item_id"]: x["text"] for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    hosts = [x["text"] for x in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()]
    hosts = [split(t)[:600] for t in hosts if len(split(t)) > 60]
    rows, want = [], set()
    for k, (item_id, text) in enumerate(list(items.items()) * 5):
        words, n = split(text), d.answer_words(text)
        question = [w if r.random() > 0.25 else r.choice(r.choice(hosts)) for w in words[:-n]]
        for b in range(0, len(question), 5):
            part = question[b : b + 5]
            r.shuffle(part)
            question[b : b + 5] = part
        host = r.choice(hosts)
        cut = r.randrange(len(host))
        rows.append((k, " ".join([*host[:cut], *question, *words[-n:], *host[cut:]])))
        if d.LOOSE <= d.lcs(words, question + words[-n:]) / len(words) < 0.55:
            want.add((k, item_id))
    docs = edge.documents(spark, rows)
    got = {(x["doc_id"], x["item_id"]): x for x in d.contaminated(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert len(want) >= 20
    assert len(want & set(got)) >= 0.9 * len(want)
    assert all(got[k]["cosine"] >= d.COSINE for k in want & set(got))
    clean = {x["doc_id"] for x in d.keep_clean(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert clean == {k for k, _ in rows} - {k for k, _ in got}


def test_unspaced_scripts(spark):
    """Every Han or kana character is a word."""
    item = "水は何度で沸騰するか。答えは百度である。"
    other = "山川草木日月火水木金土天地人東西南北春夏秋冬"
    r = random.Random(2)
    fill = lambda n: "".join(r.choice(other) for _ in range(n))
    docs = edge.documents(spark, [(1, fill(80) + item + fill(50)), (2, fill(200)), (3, edge.prose(60, 3))])
    found = d.contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(x["doc_id"], x["item_id"], x["lcs"]) for x in found] == [(1, 7, 1.0)]


def test_short_items(spark):
    """All words in sequence, the answer among them; with longer items in the block and without."""
    short = [(1, "Who wrote Quixote? Cervantes."), (2, "zanzibar"), (4, "zanzibar"), (3, "")]
    rows = [
        (1, edge.prose(40, 1) + " who  wrote QUIXOTE: Cervantes! " + edge.prose(40, 2)),
        (2, edge.prose(40, 3) + " who wrote Quixote? Avellaneda. " + edge.prose(40, 4)),
        (3, "Zanzibar"),
        (4, edge.prose(40, 5)),
    ]
    docs = edge.documents(spark, rows)
    for items in (short, [*short, (9, edge.prose(30, 6))]):
        bench = spark.createDataFrame(items, "item_id long, text string")
        got = {(r["doc_id"], r["item_id"], r["lcs"], r["answer"]) for r in d.contaminated(docs, bench).collect()}
        assert got == {(1, 1, 1.0, 1.0), (3, 2, 1.0, 1.0), (3, 4, 1.0, 1.0)}
        assert sorted(r["doc_id"] for r in d.keep_clean(docs, bench).collect()) == [2, 4]


def test_blocks_of_items(spark, monkeypatch):
    items, rows = fixture(spark)
    monkeypatch.setattr(d, "ITEM_BYTES", 2000)
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), edge.documents(spark, rows)
    assert {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, bench).collect()} == {(1, 3), (2, 3), (3, 3)}


def test_subsequence():
    r = random.Random(0)
    for _ in range(200):
        a, b = ([r.randrange(5) for _ in range(r.randrange(1, 12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert d.lcs(a, b) == table[-1, -1]


def test_singular_vectors(spark):
    """The randomised range finder spans the items' space: all of it when the rank allows."""
    items = [(k, edge.prose(20, k)) for k in range(12)]
    df = spark.createDataFrame(items, "item_id long, text string")
    vocabulary = np.unique(np.concatenate([d.tokens(t) for _, t in items]))
    idf = np.ones(len(vocabulary))
    space = d._space(df.select("text"), vocabulary, idf, 12)
    a = np.zeros((12, len(vocabulary)))
    for k, t in items:
        term, w = d._weights(np.searchsorted(vocabulary, d.tokens(t)), idf)
        a[k, term] = w / np.sqrt((w**2).sum())
    assert np.allclose(a @ space @ space.T, a, atol=1e-6)


def test_empty(spark):
    items, rows = fixture(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert d.contaminated(edge.empty(spark), bench).collect() == []
    assert d.contaminated(edge.documents(spark), bench.limit(0)).collect() == []
    assert d.keep_clean(edge.documents(spark), bench.limit(0)).count() == len(edge.texts())
