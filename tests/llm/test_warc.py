from __future__ import annotations

import hashlib

from pyarrow import fs

from tests.llm import edge
from vitrine.llm import warc
from vitrine.llm.common import file_system
from vitrine.plans.check import compare


def test_matches_sql(spark, duck):
    result = compare(warc.op8_warc(spark, edge.SF), duck, warc.OP8_SQL)
    assert result["values_match"], result


def files_of(uri):
    place, root = file_system(uri)
    return {f.base_name: hashlib.sha1(place.open_input_file(f.path).read()).hexdigest() for f in place.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.File}


def pages(spark):
    long = edge.prose(400, 1)
    rows = [
        (1, "http://a/1", long, 0), (5, "http://a/5", long, 0), (3, "http://a/3\r\nX: y", long, 0), (4, None, None, 0), (6, "", "", 0), (7, "http://b", "short", 0), (8, "http://b", "short", 0),
        (9, "http://b/é", "é日本" * 500, 0), (10, "http://b/é", "é日本" * 500 + " ", 0), (None, "http://n", long, 0), (None, None, edge.prose(300, 2), 0), (1 << 61, "http://far", "x", 0),
        (5, "http://a/5", long, 0), (-4, "http://minus", "\x00\r\n\r\nWARC/1.1\r\n", 0),
    ]
    rows += [(1000 + k, f"http://c/{k}", edge.prose(200, k), 0) for k in range(60)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, revisit int")


def test_round_trip_and_rolling(spark, tmp_path):
    rows, df = pages(spark)
    uri = f"file://{tmp_path}/one"
    manifest = warc.write_archive(df, uri, shard_bytes=20_000, file_bytes=3_000).collect()
    assert len(manifest) > 5 and sum(r["records"] for r in manifest) == len(rows)
    assert files_of(uri) == {r["file"]: r["sha1"] for r in manifest}
    got = warc.read_archive(spark, uri).collect()
    long = rows[0][2]
    want = []
    for i, u, h, _ in rows:
        revisit = h == long and i != 5
        payload = (h or "").encode()
        want.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", 5 if revisit else None, None if revisit else h or ""))
    have = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload"]) for r in got]
    # The null id among long payloads revisits, as does every id but the largest.
    assert sorted(have, key=str) == sorted(want, key=str)
    assert {r["url"] for r in got if r["page_id"] == 3} == {"http://a/3%0D%0AX:%20y"}


def test_same_bytes_again(spark, tmp_path):
    _, df = pages(spark)
    for name, parts in (("a", 1), ("b", 7)):
        warc.write_archive(df.repartition(parts), f"file://{tmp_path}/{name}", shard_bytes=20_000, file_bytes=3_000)
    assert files_of(f"file://{tmp_path}/a") == files_of(f"file://{tmp_path}/b")


def test_files_outside_the_manifest_are_ignored(spark, tmp_path):
    _, df = pages(spark)
    uri = f"file://{tmp_path}/c"
    warc.write_archive(df, uri)
    before = warc.read_archive(spark, uri).count()
    (tmp_path / "c" / "part-999999-00000.warc.gz").write_bytes(warc.record(1, "u", b"left over", None, False))
    (tmp_path / "c" / "_temporary-1").write_bytes(b"half")
    assert warc.read_archive(spark, uri).count() == before


def test_empty(spark, tmp_path):
    _, df = pages(spark)
    uri = f"file://{tmp_path}/none"
    assert warc.write_archive(df.limit(0), uri).collect() == []
    assert warc.read_archive(spark, uri).collect() == []
