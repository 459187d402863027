"""CSV scan, defaults, typing with rejects, nesting views, JSON sink, streaming."""

from __future__ import annotations

import csv
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vitrine.sources import (
    MissingColumnError,
    RAW_COLUMNS,
    ingest_listings,
    nest_listing,
    read_listings_csv,
    read_listings_json,
    reject_counts,
    rejected_row_count,
    type_listings,
    write_listings_json,
)
from vitrine.streaming import stream_listings_csv

HEADER = [c for c, _ in RAW_COLUMNS]


def _row(**kw):
    base = {c: "" for c in HEADER}
    base.update({
        "product_id": "p1", "product_type": "Dress", "product_name": "Black dress",
        "product_description": "nice", "product_keywords": "dress", "product_gender_target": "Women",
        "product_category": "Women Clothing", "product_season": "Autumn", "product_condition": "Good",
        "product_like_count": "3", "product_material": "Wool", "product_color": "Black", "price_usd": "120.5",
        "brand_id": "b1", "brand_name": "Acme", "sold": "True", "reserved": "False", "available": "True",
        "seller_id": "s1", "seller_username": "ann", "seller_country": "France", "seller_price": "100",
        "seller_earning": "80.25", "seller_products_sold": "12", "seller_num_products_listed": "60",
        "seller_community_rank": "0.5", "seller_num_followers": "40", "seller_pass_rate": "91",
        "seller_badge": "Expert", "buyers_fees": "7.5", "warehouse_name": "Paris",
    })
    base.update(kw)
    return base


def _write_csv(path, rows, header=HEADER, quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, fieldnames=header, quoting=quoting, extrasaction="ignore")
        w.writeheader()
        for r in rows:
            w.writerow(r)


def test_multiline_and_doubled_quote(spark, tmp_path):
    p = tmp_path / "a.csv"
    _write_csv(p, [_row(product_description='line one\nline "two"'), _row(product_id="p2")])
    df = read_listings_csv(spark, str(p), multiline=True)
    rows = df.orderBy("product_id").collect()
    assert len(rows) == 2
    assert rows[0]["product_description"] == 'line one\nline "two"'


def test_rejects_and_nan(spark, tmp_path):
    p = tmp_path / "b.csv"
    rows = [
        _row(product_id="ok"),
        _row(product_id="abc", price_usd="abc"),
        _row(product_id="empty", price_usd=""),
        _row(product_id="nan", buyers_fees="NaN"),
        _row(product_id="badbool", sold="maybe"),
        _row(product_id="absent", seller_community_rank=""),
    ]
    _write_csv(p, rows)
    # The empty price must be a quoted "" (present but empty), not an
    # absent value: write that one row with every field quoted.
    with open(p) as f:
        lines = f.read().splitlines()
    import io
    buf = io.StringIO()
    csv.DictWriter(buf, fieldnames=HEADER, quoting=csv.QUOTE_ALL).writerow(rows[2])
    lines[3] = buf.getvalue().rstrip("\r\n")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    typed = type_listings(read_listings_csv(spark, str(p)))
    by_id = {r["product_id"]: r for r in typed.collect()}
    assert by_id["ok"]["rejected_fields"] == []
    assert by_id["ok"]["price_usd"] == Decimal("120.5")
    assert by_id["ok"]["sold"] is True and by_id["ok"]["reserved"] is False
    assert by_id["abc"]["price_usd"] is None and by_id["abc"]["rejected_fields"] == ["price_usd"]
    assert by_id["empty"]["rejected_fields"] == ["price_usd"]
    assert by_id["nan"]["buyers_fees"] is None and by_id["nan"]["rejected_fields"] == []
    assert by_id["badbool"]["sold"] is None and by_id["badbool"]["rejected_fields"] == ["sold"]
    assert by_id["absent"]["seller_community_rank"] is None and by_id["absent"]["rejected_fields"] == []
    counts = {r["field"]: r["count"] for r in reject_counts(typed).collect()}
    assert counts == {"price_usd": 2, "sold": 1}
    assert rejected_row_count(typed).first()["rejected_rows"] == 3


def test_nan_in_whole_numbers_is_no_reject(spark, tmp_path):
    p = tmp_path / "n.csv"
    _write_csv(p, [_row(seller_products_sold="NaN", seller_num_products_listed=" nan "), _row(product_id="p2", seller_products_sold="1.5"), _row(product_id="p3", seller_products_sold="12.0")])
    got = {r["product_id"]: (r["seller_products_sold"], r["rejected_fields"]) for r in type_listings(read_listings_csv(spark, str(p))).collect()}
    assert got == {"p1": (None, []), "p2": (None, ["seller_products_sold"]), "p3": (12, [])}


def test_quarantine_is_counted_by_the_write(spark, tmp_path):
    """The source is gone after the write: counts and raw values come from that one pass."""
    from vitrine.sources import quarantine, write_listings_with_quarantine

    p, out = tmp_path / "q.csv", str(tmp_path / "out")
    rows = [_row(product_id=f"p{i}", price_usd="abc" if i % 4 == 0 else "5", sold="maybe" if i % 10 == 0 else "True") for i in range(100)]
    _write_csv(p, rows)
    with open(p, "a") as f:
        f.write("short,T,N\n")
    docs = ingest_listings(spark, str(p), keep_raw=True)
    report = write_listings_with_quarantine(docs, out)
    p.unlink()
    bad = [(r["id"], r["field"], r["raw"]) for r in quarantine(spark, out, docs.schema).collect()]
    want = [(f"p{i}", "price_usd", "abc") for i in range(0, 100, 4)] + [(f"p{i}", "sold", "maybe") for i in range(0, 100, 10)]
    assert sorted(x for x in bad if x[0] != "short") == sorted(want)
    assert ("short", "malformed_row", "short,T,N") in bad
    assert report.rows == 101 and report.rejected_rows == len({i for i, _, _ in bad})
    assert sum(report.rejects.values()) == len(bad) and report.rejects["price_usd"] == 25 and report.rejects["sold"] == 10
    assert spark.read.parquet(out).count() == 101
    # Nothing rejected: an empty quarantine.
    _write_csv(p, [_row()])
    docs = ingest_listings(spark, str(p), keep_raw=True)
    report = write_listings_with_quarantine(docs, out + "2")
    assert (report.rows, report.rejected_rows, report.rejects) == (1, 0, {})
    assert quarantine(spark, out + "2", docs.schema).collect() == []


def test_missing_optional_columns_default_to_null(spark, tmp_path):
    header = [c for c in HEADER if c not in ("sold", "reserved", "available", "product_type")]
    p = tmp_path / "c.csv"
    _write_csv(p, [_row()], header)
    doc = ingest_listings(spark, str(p)).first()
    assert doc["type"] is None
    assert doc["state"]["sold"] is None and doc["state"]["available"] is None


def test_missing_required_column_raises(spark, tmp_path):
    header = [c for c in HEADER if c != "price_usd"]
    p = tmp_path / "d.csv"
    _write_csv(p, [_row()], header)
    with pytest.raises(MissingColumnError):
        ingest_listings(spark, str(p))


def test_files_with_other_column_orders(spark, tmp_path):
    _write_csv(tmp_path / "a.csv", [_row(product_id="a", warehouse_name="Paris")])
    _write_csv(tmp_path / "b.csv", [_row(product_id="b", warehouse_name="Rome", product_description="x, \"y\"")], HEADER[::-1])
    few = [c for c in HEADER if c not in ("sold", "available")]
    _write_csv(tmp_path / "c.csv", [_row(product_id="c")], few)
    docs = {r["id"]: r for r in ingest_listings(spark, f"{tmp_path}/*.csv", by_header=True).collect()}
    assert {k: (r["shipping"]["warehouse_name"], r["state"]["sold"]) for k, r in docs.items()} == {"a": ("Paris", True), "b": ("Rome", True), "c": ("Paris", None)}
    assert docs["b"]["description"] == 'x, "y"' and docs["b"]["rejected_fields"] == []
    with pytest.raises(Exception, match="(?i)header"):
        ingest_listings(spark, f"{tmp_path}/[ab].csv").collect()
    with pytest.raises(MissingColumnError):
        ingest_listings(spark, f"{tmp_path}/none*.csv", by_header=True) if (tmp_path / "none.csv").write_text("x\n") else None


def test_short_and_long_rows_are_rejects(spark, tmp_path):
    p = tmp_path / "m.csv"
    _write_csv(p, [_row(product_id="ok"), _row(product_id="bad", price_usd="abc")])
    with open(p, "a") as f:
        f.write("short,T,N\n")
        f.write(",".join(["long"] + ["1"] * (len(HEADER) + 2)) + "\n")
    typed = type_listings(read_listings_csv(spark, str(p)))
    by_id = {r["product_id"]: r["rejected_fields"] for r in typed.collect()}
    assert by_id["ok"] == [] and by_id["bad"] == ["price_usd"]
    assert "malformed_row" in by_id["short"] and "malformed_row" in by_id["long"]
    # Also when a query needs few columns.
    assert rejected_row_count(typed).first()["rejected_rows"] == 3
    counts = {r["field"]: r["count"] for r in reject_counts(typed).collect()}
    assert counts["malformed_row"] == 2


def test_one_file_is_split(spark, tmp_path):
    p = tmp_path / "big.csv"
    _write_csv(p, [_row(product_id=f"p{i}") for i in range(4000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        docs = ingest_listings(spark, str(p))
        assert docs.rdd.getNumPartitions() > 4
        assert docs.select("id").distinct().count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_views_keep_their_projection(spark, tmp_path):
    p = tmp_path / "e.csv"
    _write_csv(p, [_row()])
    typed = type_listings(read_listings_csv(spark, str(p)))
    ful = nest_listing(typed, "fulfilment")
    assert ful.columns == [
        "id", "type", "name", "brand", "season", "condition", "material", "color", "price_usd", "state",
        "seller", "shipping",
    ]
    assert ful.schema["seller"].dataType.fieldNames() == ["earning", "id", "country"]
    cat = nest_listing(typed, "catalogue")
    assert cat.schema["seller"].dataType.fieldNames() == ["id", "username", "num_followers"]
    sel = nest_listing(typed, "seller")
    assert len(sel.schema["seller"].dataType.fieldNames()) == 11
    with pytest.raises(ValueError):
        nest_listing(typed, "nope")


def test_json_sink_round_trip(spark, tmp_path):
    p = tmp_path / "f.csv"
    _write_csv(p, [_row(product_id="a"), _row(product_id="b", buyers_fees="NaN")])
    docs = ingest_listings(spark, str(p)).drop("rejected_fields")
    out = str(tmp_path / "json")
    write_listings_json(docs, out)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".json"))
    lines = [json.loads(x) for x in text.splitlines() if x.strip()]
    assert len(lines) == 2
    b = next(x for x in lines if x["id"] == "b")
    assert "buyers_fees" not in b["shipping"]  # null fields omitted
    back = read_listings_json(spark, out)
    assert sorted(r["id"] for r in back.collect()) == ["a", "b"]
    assert back.where(F.col("id") == "a").first()["seller"]["earning"] == Decimal("80.25")


def test_packed_json_sink_is_small_and_read_in_parallel(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("vitrine.sources.ingest.ROWS_PER_PACKED_FILE", 200)
    p = tmp_path / "f.csv"
    _write_csv(p, [_row(product_id=f"p{i}", buyers_fees="NaN" if i % 2 else "1.5") for i in range(1_000)])
    docs = ingest_listings(spark, str(p)).drop("rejected_fields").coalesce(1)
    sizes = {}
    for compression in ("none", "gzip"):
        out = str(tmp_path / compression)
        write_listings_json(docs, out, compression=compression)
        parts = [os.path.join(out, f) for f in os.listdir(out) if f.startswith("part-")]
        sizes[compression] = len(parts), sum(map(os.path.getsize, parts))
        assert sorted(read_listings_json(spark, out).collect(), key=str) == sorted(docs.collect(), key=str)
    assert sizes["gzip"][0] == 5 and sizes["gzip"][1] < sizes["none"][1] / 5, sizes


def test_json_round_trip_writes_packed_files(spark, tmp_path):
    from vitrine.plans import operator_queries as Q
    from vitrine.sources.store import listings

    seen = Q._scratch(listings(spark, "/root/testdata/sf0.001"), "json").rsplit("/", 1)[0].removeprefix("file:")
    before = set(os.listdir(seen)) if os.path.isdir(seen) else set()
    assert Q.json_round_trip(listings(spark, "/root/testdata/sf0.001")).count() == 6_000
    (new,) = [f for f in set(os.listdir(seen)) - before if f.startswith("json-")]
    parts = [f for f in os.listdir(f"{seen}/{new}") if f.startswith("part-")]
    assert parts and all(f.endswith(".json.gz") for f in parts)


def _in_files(spark, tmp_path, n):
    """The listings of sf0.001 as a table of n files, and where queries on it put their text."""
    from vitrine.plans import operator_queries as Q
    from vitrine.sources.store import listings, materialise

    table = spark.read.parquet(materialise(listings(spark, "/root/testdata/sf0.001").repartition(n, "id"), str(tmp_path), "t"))
    return table, Q._scratch(table, "x").rsplit("/", 1)[0].removeprefix("file:")


def test_json_round_trip_holds_a_share_as_text(spark, tmp_path, monkeypatch):
    from vitrine.plans import operator_queries as Q

    table, folder = _in_files(spark, tmp_path, 6)
    whole = sorted(Q.json_round_trip(table).collect(), key=str)
    before, seen, write = set(os.listdir(folder)), [], Q.write_listings_json

    def watched(df, path, **options):
        seen.append((df.count(), [f for f in set(os.listdir(folder)) - before if f.startswith("json-")]))
        write(df, path, **options)

    monkeypatch.setattr(Q, "write_listings_json", watched)
    monkeypatch.setattr(Q, "ROWS_AS_TEXT", 2_500)
    got = Q.json_round_trip(table)
    assert len(seen) >= 3 and sum(n for n, _ in seen) == 6_000 and all(n <= 2_500 and not other for n, other in seen), seen
    assert sorted(got.collect(), key=str) == whole and len(whole) == 6_000
    (_,) = [f for f in set(os.listdir(folder)) - before if f.startswith("json-")]


def test_csv_multiline_holds_a_share_as_text(spark, tmp_path, monkeypatch):
    from vitrine.plans import operator_queries as Q

    table, folder = _in_files(spark, tmp_path, 6)
    whole = sorted(Q.ingest_csv_multiline(table).collect(), key=str)
    before, seen, read = set(os.listdir(folder)), [], Q.ingest_listings

    def watched(spark, path, **options):
        seen.append([f for f in set(os.listdir(folder)) - before if f.startswith("csv-")])
        return read(spark, path, **options)

    monkeypatch.setattr(Q, "ingest_listings", watched)
    monkeypatch.setattr(Q, "ROWS_AS_TEXT", 2_500)
    got = Q.ingest_csv_multiline(table)
    assert len(seen) >= 3 and all(len(text) == 1 for text in seen) and len({text[0] for text in seen}) == len(seen), seen
    assert sorted(got.collect(), key=str) == whole and len(whole) == 6_000


def test_shares_open_their_own_files_only(spark, tmp_path):
    from vitrine.sources.store import shares

    table, _ = _in_files(spark, tmp_path, 6)
    assert shares(table, 6_000) == [table]
    parts = shares(table.select("id", "seller.badge"), 2_000)
    opened = []
    for x in parts:
        plan = x._jdf.queryExecution().executedPlan()
        x.collect()
        opened.append(plan.collectLeaves().head().metrics().apply("numFiles").value())
    assert len(parts) > 2 and sum(opened) == 6, opened
    assert sorted(r["id"] for x in parts for r in x.collect()) == sorted(r["id"] for r in table.collect())


def test_streaming_ingest(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _write_csv(src / "1.csv", [_row(product_id="s1"), _row(product_id="s2", price_usd="x")])
    sink = str(tmp_path / "out")
    q = stream_listings_csv(spark, str(src), sink, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    rows = {r["id"]: r for r in got.collect()}
    assert set(rows) == {"s1", "s2"}
    assert rows["s2"]["price_usd"] is None and rows["s2"]["rejected_fields"] == ["price_usd"]
    # A second run finds nothing new: the checkpoint records the processed file.
    q2 = stream_listings_csv(spark, str(src), sink, checkpoint=str(tmp_path / "ckpt"))
    q2.awaitTermination(120)
    assert spark.read.parquet(sink).count() == 2


def test_read_documents_in_script_format(spark, tmp_path):
    from vitrine.sources import read_listing_documents

    # Written the way the reshaping scripts do it: one JSON array, indent=4,
    # every value a string, one view's subset of fields.
    docs = [
        {"id": "p1", "type": "", "name": "Black dress", "brand": {"id": "b1", "name": "Acme"},
         "season": "Autumn", "condition": "Good", "material": "Wool", "color": "Black", "price_usd": "120.5",
         "state": {"sold": "True", "reserved": "", "available": "False"},
         "seller": {"earning": "80.25", "id": "s1", "country": "France"},
         "shipping": {"buyers_fees": "NaN", "warehouse_name": "Paris"}},
        {"id": "p2", "type": "Shoes", "name": "Red shoes", "brand": {"id": "b2", "name": "Zed"},
         "season": "Spring", "condition": "New", "material": "Leather", "color": "Red", "price_usd": "oops",
         "state": {"sold": "False", "reserved": "True", "available": "True"},
         "seller": {"earning": "10", "id": "s2", "country": "Spain"},
         "shipping": {"buyers_fees": "3.5", "warehouse_name": "Madrid"}},
    ]
    p = tmp_path / "products.json"
    with open(p, "w", encoding="utf-8") as f:
        f.write("[\n" + ",\n".join(json.dumps(d, indent=4) for d in docs) + "\n]")
    got = {r["id"]: r for r in read_listing_documents(spark, str(p), multiline=True).collect()}
    assert set(got) == {"p1", "p2"}
    a, b = got["p1"], got["p2"]
    assert a["type"] is None and a["price_usd"] == Decimal("120.5")
    assert a["state"]["sold"] is True and a["state"]["reserved"] is None and a["state"]["available"] is False
    assert a["shipping"]["buyers_fees"] is None and a["rejected_fields"] == []
    assert a["seller"]["username"] is None  # not in this view
    assert b["price_usd"] is None and b["rejected_fields"] == ["price_usd"]
    assert b["shipping"]["buyers_fees"] == Decimal("3.5")


def test_streaming_ingest_picks_up_new_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    sink, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write_csv(src / "1.csv", [_row(product_id="a1")])
    stream_listings_csv(spark, str(src), sink, checkpoint=ckpt).awaitTermination(120)
    _write_csv(src / "2.csv", [_row(product_id="b1"), _row(product_id="b2")])
    stream_listings_csv(spark, str(src), sink, checkpoint=ckpt).awaitTermination(120)
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == ["a1", "b1", "b2"]


def test_read_documents_json_lines(spark, tmp_path):
    from vitrine.sources import read_listing_documents

    p = tmp_path / "docs.jsonl"
    with open(p, "w", encoding="utf-8") as f:
        f.write(json.dumps({"id": "x", "price_usd": "5", "seller": {"id": "s", "num_followers": "12"}}) + "\n")
        f.write(json.dumps({"id": "y", "price_usd": "7.25", "state": {"sold": "1"}}) + "\n")
    got = {r["id"]: r for r in read_listing_documents(spark, str(p), multiline=False).collect()}
    assert got["x"]["seller"]["num_followers"] == 12.0 and got["x"]["price_usd"] == Decimal("5")
    assert got["y"]["state"]["sold"] is True and got["y"]["seller"]["id"] is None
