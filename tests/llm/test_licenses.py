from __future__ import annotations

from tests.llm import edge
from vitrine.llm import licenses
from vitrine.plans.check import compare

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


def test_matches_sql(spark, duck):
    result = compare(licenses.op6_licenses(spark, edge.SF), duck, licenses.OP6_SQL)
    assert result["values_match"], result


def test_no_python_in_the_plan(spark):
    plan = licenses.op6_licenses(spark, edge.SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_inheritance(spark):
    body = edge.prose(40, 1)
    rows = [
        ("p/LICENSE", MIT, 1), ("p/a/x.txt", body, 1), ("p/a/b/c/y.txt", body, 1), ("p/a/b/LICENSE.md", GPL, 1), ("p/q.txt", f"{body}\n{GPL}\n{body}", 1),
        ("p/a/b/c/y.txt", body, 1), ("other/z.txt", body, 1), ("other/z2.txt", None, 1), (None, body, 1), (None, MIT, 1), ("o/empty", "", 1), ("root.txt", body, 1),
        ("k/license-free.txt", "a licence is a thing that lawyers write about at length", 1), ("m/one.txt", f"{body}. Licensed under cc by-nc 4.0. {body}", 1),
    ]
    got = sorted(((r["path"], r["license"], r["basis"], r["origin"]) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string, license int")).collect()), key=str)
    want = [
        ("p/LICENSE", "MIT", "file", None), ("p/a/x.txt", "MIT", "inherited", "p"), ("p/a/b/c/y.txt", "GPL-3.0", "inherited", "p/a/b"), ("p/a/b/c/y.txt", "GPL-3.0", "inherited", "p/a/b"),
        ("p/a/b/LICENSE.md", "GPL-3.0", "file", None), ("p/q.txt", "GPL-3.0", "header", None), ("other/z.txt", None, None, None), ("other/z2.txt", None, None, None), ("o/empty", None, None, None),
        ("root.txt", None, None, None), ("k/license-free.txt", None, None, None), ("m/one.txt", "CC-BY-NC-4.0", "header", None),
    ]
    assert [g for g in got if g[0] is not None] == sorted(want, key=str)
    assert len(got) == len(rows)


def test_edges(spark):
    docs = edge.documents(spark).withColumnRenamed("source", "path")
    assert licenses.scan(docs).count() == len(edge.texts())
    assert licenses.scan(edge.empty(spark).withColumnRenamed("source", "path")).collect() == []


def test_query_with_null_ids(spark, tmp_path):
    rows = [(1, MIT, "en", "a"), (None, MIT, "en", "b"), (None, "nothing to see", None, None), (3, None, "fr", "a/b")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r["doc_id"], r["license"]) for r in licenses.op6_licenses(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, "MIT"), (None, "MIT"), (None, None), (3, None)], key=str)
