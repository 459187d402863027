from __future__ import annotations

import hashlib
import random

import numpy as np
import pandas as pd

from tests.llm import edge
from vitrine.llm import common
from vitrine.llm.blocks import Replies, fold, packets, repeated, text_blocks


def test_release(spark):
    table = common.stored(spark.range(3).toDF("a"), "three")
    blocks = text_blocks(edge.documents(spark), bucketed=True)
    assert table.count() == 3 and blocks.selectExpr("sum(size(texts))").first()[0] == len(edge.texts())
    place, path = common.file_system(common.shared_path(spark, "x").rsplit("/", 1)[0])
    common.release(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("vitrine_blocks_")]
    assert place.get_file_info(path).type.name == "NotFound"
    common.release(spark)


def test_word_bounds():
    r = random.Random(0)
    for _ in range(300):
        text = "".join(r.choice("aZé \t\n\x0b\x0c\r") for _ in range(r.randint(0, 12)))
        data = common.text_bytes(text)
        raw = data.tobytes()
        assert [raw[s:e] for s, e in zip(*common.word_bounds(data))] == raw.split()


def test_merge_spans():
    r = random.Random(1)
    for _ in range(200):
        spans = [(a := r.randint(0, 30), a + r.randint(1, 8)) for _ in range(r.randint(0, 6))]
        inside = {i for a, b in spans for i in range(a, b)}
        s, e = common.merge_spans(*(np.array(x, int) for x in (zip(*spans) if spans else ((), ()))))
        assert {i for a, b in zip(s, e) for i in range(a, b)} == inside
        assert all(b < a for a, b in zip(s[1:], e[:-1]))


def test_whole_groups():
    r = random.Random(2)
    keys = sorted(r.randint(0, 9) for _ in range(100))
    frame = pd.DataFrame({"k": keys, "i": range(100)})
    for size in (1, 3, 7, 100):
        got = list(common.whole_groups((frame.iloc[i : i + size] for i in range(0, 100, size)), ["k"]))
        assert [i for g in got for i in g["i"]] == list(range(100))
        ends = [set(g["k"]) for g in got]
        assert all(not a & b for a, b in zip(ends, ends[1:]))


def test_hashes_occurring_elsewhere(spark):
    """The exchange between blocks against counting, with short hashes, marks and order."""
    r = random.Random(3)
    rows = [(b, [r.randint(0, 60) << 32 | r.randint(0, 1) for _ in range(40)]) for b in range(9)]
    df = spark.createDataFrame(rows, "block long, h array<long>")
    for short in (False, True):

        def send(batches, buckets, short=short):
            for b in batches:
                for block, h in zip(b["block"], b["h"]):
                    values = np.array(h, np.uint64)
                    yield packets(block, values, buckets, short)

        replies, buckets = repeated(df, send, short)
        got = {x["block"]: Replies([y.asDict() for y in x["replies"]]) for x in replies.collect()}
        for block, h in rows:
            values = fold(np.array(h, np.uint64), buckets, short)
            often = [sum(fold(np.array(g, np.uint64), buckets, short).tolist().count(v) for _, g in rows) for v in values.tolist()]
            hit, at = got[block].find(values)
            assert hit.tolist() == [n > 1 for n in often]
            assert got[block].total[at[hit]].tolist() == [n for n in often if n > 1]
