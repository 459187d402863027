"""Deterministic sharded WARC archives.

Records are sorted by page id and cut into shards by id ranges that hold about
``SHARD_BYTES`` of payload; a task writes its shard as gzip members, one per
record, and begins a new file when the compressed size passes ``FILE_BYTES``.
Ranges, order, headers and dates depend on the rows alone, so a task that runs
again writes the same bytes. A file is written under a temporary name of its
attempt and then renamed; the manifest, written last, lists the files with size
and digest, and readers open only what it lists. Headers and digests are made
anew from the payload when an archive is written and verified when it is read.

Of the records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one
with the largest page id is the response and the others revisit it.

Defined cases: a null payload is empty; a null page id sorts first, never is
referred to if another id has the payload, and reads back as null; a null url
becomes an empty target; rows that repeat id and payload are written as often
as they occur, all with the same type; an empty table gives an archive without
files; other columns are not written. Line breaks in a url are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import file_system, shared_path, stored, table

REVISIT_BYTES = 1000
SHARD_BYTES = 32 << 20
FILE_BYTES = 8 << 20
DATE = "2000-01-01T00:00:00Z"
_PIECE = 1 << 14


def _slot(ends: list[int]):
    """Column function: index of the first of the sorted ``ends`` that is not below an id (0 for null)."""
    limits = np.array(ends, np.int64)

    @F.pandas_udf("long")
    def slot(page_id: pd.Series) -> pd.Series:
        ids = page_id.fillna(np.iinfo(np.int64).min).astype(np.int64)
        return pd.Series(np.searchsorted(limits, ids.to_numpy()))

    return slot


def _shards(rows: DataFrame, shard_bytes: int) -> list[int]:
    """Upper page ids of the shards. Each round counts the bytes in equal slices
    of the id ranges that are too heavy, until none is, or it is one id. A range
    gets four slices per shard that it is worth (256 at least), so what the driver sees grows
    with the number of shards only."""
    rows = rows.filter("page_id IS NOT NULL")
    weight = F.sum(F.col("payload_bytes") + 512).alias("bytes")
    head = rows.agg(F.min("page_id").alias("lo"), F.max("page_id").alias("hi"), weight).first()
    if head["lo"] is None:
        return []
    done: list[tuple[int, int]] = []
    heavy = [(head["lo"], head["hi"], head["bytes"])]
    while heavy:
        slices: list[tuple[int, int, bool]] = []
        at = None
        for lo, hi, size in sorted(heavy):
            if at is not None and at < lo - 1:
                slices.append((at + 1, lo - 1, False))  # between heavy ranges
            step = max(1, (hi - lo + 1) // max(256, 4 * size // shard_bytes))
            slices += [(x, min(hi, x + step - 1), True) for x in range(lo, hi + 1, step)]
            at = hi
        slot = _slot([hi for _, hi, _ in slices])
        held = rows.filter(F.col("page_id").between(slices[0][0], slices[-1][1]))
        found = {r["k"]: r["bytes"] for r in held.groupBy(slot("page_id").alias("k")).agg(weight).collect()}
        heavy = []
        for k, (lo, hi, ours) in enumerate(slices):
            if ours and k in found:
                if found[k] > shard_bytes and hi > lo:
                    heavy.append((lo, hi, found[k]))
                else:
                    done.append((hi, found[k]))
    # Neighbouring slices share a shard while they fit.
    ends: list[int] = []
    total = 0
    for hi, size in sorted(done):
        if ends and total + size <= shard_bytes:
            ends[-1], total = hi, total + size
        else:
            ends.append(hi)
            total = size
    return ends


def _header(fields: list[tuple[str, str]], body: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def _urn(page_id: int | None, occurrence: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{occurrence}:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member."""
    sha = hashlib.sha1(payload)
    base32 = base64.b32encode(sha.digest()).decode()
    body = b"" if revisit else payload
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id, sha.hexdigest())),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{base32}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(body).digest()).decode()}"),
        ("WARC-Identified-Payload-Length", str(len(payload))),
        ("WARC-Page-ID", "" if page_id is None else str(page_id)),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _urn(refers_to, sha.hexdigest())),
            ("WARC-Refers-To-Page-ID", str(refers_to)),
        ]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(_header(fields, body)) + z.flush()


def records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes, revisit, refers_to per row of ``pages``."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(html, 256).alias("content"))
    shared = rows.filter(F.col("payload_bytes") >= revisit_bytes).groupBy("content").agg(F.max("page_id").alias("head"), F.count("*").alias("n"))
    shared = stored(shared.filter("n > 1").select(F.col("content").alias("_content"), "head"), "shared-payloads")
    joined = rows.join(shared, F.col("content") == F.col("_content"), "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("head")) & F.col("head").isNotNull(), F.lit(False))
    return joined.select("page_id", "url", "html", "payload_bytes", revisit.alias("revisit"), F.when(revisit, F.col("head")).alias("refers_to"))


def write_archive(pages: DataFrame, uri: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``uri`` and return the manifest:
    file, records, bytes, sha1."""
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("long")
    ends = _shards(stored(pages.select(F.col("page_id").cast("long").alias("page_id"), size.alias("payload_bytes")), "sizes"), shard_bytes)
    rows = records(pages, revisit_bytes)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, root = file_system(uri)
        shard, number, out, count, size, digest, name = None, 0, None, 0, 0, None, ""

        def close() -> pd.DataFrame:
            out.close()
            final = f"part-{shard:06d}-{number:05d}.warc.gz"
            place.move(f"{root}/{name}", f"{root}/{final}")
            return table([(final, count, size, digest.hexdigest())], ["file", "records", "bytes", "sha1"])

        for b in batches:
            for s, page_id, url, html, revisit, refers_to in zip(*(b[c] for c in ("shard", "page_id", "url", "html", "revisit", "refers_to"))):
                if out is not None and (s != shard or size >= file_bytes):
                    yield close()
                    number = number + 1 if s == shard else 0
                    out = None
                if out is None:
                    shard, count, size, digest = s, 0, 0, hashlib.sha1()
                    name = f"_temporary-{uuid.uuid4().hex}"
                    out = place.open_output_stream(f"{root}/{name}")
                one = lambda x: None if x is None else int(x)
                raw = record(one(page_id), url, html.encode("utf-8", "surrogatepass"), one(refers_to), bool(revisit))
                out.write(raw)
                digest.update(raw)
                count, size = count + 1, size + len(raw)
        if out is not None:
            yield close()

    place, root = file_system(uri)
    place.create_dir(root, recursive=True)
    dealt = rows.select(_slot(ends)("page_id").alias("shard"), F.col("page_id").cast("string").alias("page_id"), "url", "html", "revisit", F.col("refers_to").cast("string").alias("refers_to"), F.col("page_id").alias("_id"))
    order = [F.col("shard"), F.col("_id").isNotNull(), F.col("_id"), F.col("url"), F.col("html")]
    # More partitions than shards, so that few tasks hold two; a shard is never divided.
    files = dealt.repartition(max(1, 2 * len(ends)), "shard").sortWithinPartitions(*order).mapInPandas(write, "file string, records long, bytes long, sha1 string")
    manifest = stored(files, "manifest-rows")
    manifest.orderBy("file").coalesce(1).write.mode("overwrite").json(f"{uri}/_manifest")
    return manifest


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload string"


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a file, digests checked."""
    view, at = memoryview(content), 0
    while at < len(view):
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            piece = view[at : at + _PIECE]
            if not piece:
                raise ValueError("the last record is cut off")
            out.append(z.decompress(piece))
            at += len(piece) - len(z.unused_data)
        raw = b"".join(out)
        head, _, tail = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC/1.1 record")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        body = tail[: int(fields["Content-Length"])]
        if fields["WARC-Block-Digest"] != f"sha1:{base64.b32encode(hashlib.sha1(body).digest()).decode()}":
            raise ValueError(f"digest of {fields['WARC-Record-ID']} does not match its block")
        yield fields, body


def read_archive(spark: SparkSession, uri: str, with_payload: bool = True) -> DataFrame:
    """The records of an archive, of the files in its manifest."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                out = []
                for f, body in parse(content):
                    digest = base64.b32decode(f["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    refers = f.get("WARC-Refers-To-Page-ID")
                    text = body.decode("utf-8", "surrogatepass") if with_payload and f["WARC-Type"] == "response" else None
                    out.append((int(f["WARC-Page-ID"]) if f["WARC-Page-ID"] else None, int(f["WARC-Identified-Payload-Length"]), digest, f["WARC-Type"], int(refers) if refers else None, f["WARC-Target-URI"], text))
                    if len(out) >= 1000:
                        yield table(out, [c.split()[0] for c in READ.split(", ")])
                        out = []
                if out:
                    yield table(out, [c.split()[0] for c in READ.split(", ")])

    manifest = spark.read.schema("file string, records long, bytes long, sha1 string").json(f"{uri}/_manifest")
    listed = manifest.select(F.col("file").alias("_file"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(uri)
    files = files.withColumn("_name", F.element_at(F.split("path", "/"), -1)).join(listed, F.col("_name") == F.col("_file"), "left_semi")
    return files.select("content").mapInPandas(read, READ)


def op8_warc(spark, sf_dir: str) -> DataFrame:
    uri = shared_path(spark, "archive")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), uri)
    return read_archive(spark, uri, with_payload=False).drop("url", "payload")


OP8_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT html, max(page_id) AS head FROM p WHERE strlen(html) >= {REVISIT_BYTES} GROUP BY html)
SELECT p.page_id, strlen(p.html)::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN s.head IS NULL OR s.head IS NOT DISTINCT FROM p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN s.head IS DISTINCT FROM p.page_id THEN s.head END AS refers_to
FROM p LEFT JOIN s ON p.html = s.html
"""
