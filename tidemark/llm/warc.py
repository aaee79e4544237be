"""WARC archives: records with segmentation, chunked transfer framing and revisits, written and read by
Spark's text files, in which the start of a record is the line separator."""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: bytes of a block after which a record continues in another, and of a transfer chunk
SEGMENT_BYTES, CHUNK_BYTES = 1 << 20, 1 << 16
#: records in a file, at most
FILE_RECORDS = 2000
#: a record's first line; what ends each record; and what thus stands between two
VERSION = b"WARC/1.1"
END = "\r\n\r\n"
SEPARATOR = END + VERSION.decode() + "\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_chunks(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP/1.1 chunked transfer coding. A chunk also ends inside whatever reads as a version line, so that in
    archives of this writer one stands only at a record's start."""
    cuts = {*range(0, len(payload), size), *(m.start() + 4 for m in re.finditer(re.escape(VERSION), payload)), len(payload)}
    cuts = sorted(cuts)
    out = [b"%x\r\n%b\r\n" % (e - s, payload[s:e]) for s, e in zip(cuts, cuts[1:])]
    return b"".join([*out, b"0\r\n\r\n"])


def decode_chunks(body: bytes) -> bytes | None:
    """The payload of a chunked body, extensions and trailers left out; None if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            return None
        try:
            size = int(body[at:line].split(b";")[0].strip(), 16)
        except ValueError:
            return None
        if not size:
            return b"".join(out)
        at = line + 2 + size
        if body[at:at + 2] != b"\r\n":
            return None
        out.append(body[line + 2:at])
        at += 2


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), value)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block


def segments(block: bytes, size: int) -> list[bytes]:
    """A block in parts of ``size`` bytes."""
    return [block[i:i + size] for i in range(0, len(block), size)] or [b""]


def records_of(row: dict, number: str, segment_bytes: int) -> list[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    ident = f"<urn:page:{row['page_id']}:{number}>"
    url = [("WARC-Target-URI", _clean(row["url"]))] if row["url"] else []
    payload = (row["payload"] or "").encode("utf-8", "surrogatepass")
    page = [("X-Page-Id", "" if row["page_id"] is None else str(row["page_id"])), ("X-Payload-Length", str(len(payload))),
            ("WARC-Payload-Digest", "sha1:" + digest(payload))]
    date = ("WARC-Date", "1970-01-01T00:00:00Z")
    if row["refers_to"] is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", ident), date, *url, *page,
                  ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                  ("X-Refers-To-Page", str(row["refers_to"])), ("Content-Type", "application/http;msgtype=response")]
        return [_record(fields, b"HTTP/1.1 200 OK\r\n\r\n")]
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
             + encode_chunks(payload))
    parts = segments(block, segment_bytes)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", ident), date, *url, *page,
             ("Content-Type", "application/http;msgtype=response")]
    if len(parts) == 1:
        return [_record(first, block)]
    out = [_record([*first, ("WARC-Segment-Number", "1")], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if k == len(parts) else []
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{row['page_id']}:{number}:{k}>"),
                            date, *url, ("WARC-Segment-Origin-ID", ident), ("WARC-Segment-Number", str(k)), *last], part))
    return out


def write(pages: DataFrame, to: str, min_revisit: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Writes a record per row of ``pages(page_id, url, html)`` into gzip files at ``to``.

    The payload is the html in UTF-8, a null one empty, a null url no target. Of rows with equal payloads of
    at least ``min_revisit`` bytes those with the largest page_id are responses and the others revisits of
    it; rows that are repeated with that page_id are all responses, and a null page_id is smaller than all.
    A block longer than ``segment_bytes`` is segmented. Equal payloads are told by SHA-256 and length and found by
    an aggregate of one row per payload; the pages join it by shuffle, and adaptive execution splits a payload that many share. An
    empty table gives an empty archive; other columns are not read."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("payload")).withColumn("sha", F.unhex(F.sha2(F.col("payload").cast("binary"), 256)))
    twice = (rows.where(F.octet_length("payload") >= min_revisit).groupBy("sha")
             .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "last"))
    told = (rows.join(twice, "sha", "left")
            .select("page_id", "url", "payload",
                    F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"),
                    F.monotonically_increasing_id().alias("number")))

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 200):
                out = [r for row in batch.slice(s, 200).to_pylist() for r in records_of(row, str(row["number"]), segment_bytes)]
                yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    (told.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(to))


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


RECORD = ("record_id string, kind string, url string, page_id long, refers_to long, payload_length long, payload_digest string, "
          "origin string, number long, total long, length_ok boolean, block binary")
_KINDS = [pa.string()] * 3 + [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2 + [pa.bool_(), pa.binary()]


def _number(value: str | None) -> int | None:
    return int(value) if value and value.lstrip("-").isdigit() else None


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files at ``path`` (plain or gzip), a row each with its block. Records are told apart
    by the version line after an empty line; ``length_ok`` is false where that disagrees with Content-Length, as it
    does for cut files and for foreign blocks that hold a record's start."""
    raw = spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("value").cast("binary").alias("value"))

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 200):
                rows = []
                for raw in batch.slice(s, 200).column(0).to_pylist():
                    if raw.startswith(VERSION + b"\r\n"):
                        raw = raw[len(VERSION) + 2:]
                    head, _, block = raw.partition(b"\r\n\r\n")
                    f = _fields(head)
                    if "warc-type" not in f:
                        continue
                    size = _number(f.get("content-length"))
                    if size is not None and len(block) == size + 4 and block.endswith(b"\r\n\r\n"):
                        block = block[:size]  # the last record of a file
                    rows.append((f.get("warc-record-id"), f["warc-type"], f.get("warc-target-uri"), _number(f.get("x-page-id")),
                                 _number(f.get("x-refers-to-page")), _number(f.get("x-payload-length")),
                                 f.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                                 f.get("warc-segment-origin-id"), _number(f.get("warc-segment-number")),
                                 _number(f.get("warc-segment-total-length")), len(block) == size, block))
                cols = list(zip(*rows)) if rows else [[]] * len(_KINDS)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, _KINDS)], [c.split()[0] for c in RECORD.split(", ")])

    return raw.mapInArrow(run, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: ``record_id, kind, url, page_id, refers_to, payload_length, payload_digest, complete, block``.

    Continuations join the record that their origin identifier names, in order of segment number; of a number
    that comes twice the least block counts. ``complete`` says that the numbers run from 1 without a gap, every part has its
    stated length, and the total length stated by the last is that of all. An origin without its first
    record gives no row. Only segmented records are shuffled; a record's segments meet in one row, as its block does."""
    kept = ["record_id", "kind", "url", "page_id", "refers_to", "payload_length", "payload_digest"]
    whole = (records.where("number IS NULL AND origin IS NULL")
             .select(*kept, F.col("length_ok").alias("complete"), "block"))
    parts = records.where("number IS NOT NULL OR origin IS NOT NULL").withColumn("of", F.coalesce("origin", "record_id"))
    once = parts.groupBy("of", "number").agg(
        F.min("block").alias("block"), F.bool_and("length_ok").alias("length_ok"), F.max("total").alias("total"),
        F.max(F.when(F.col("origin").isNull(), F.struct(*kept))).alias("first"))
    joined = once.groupBy("of").agg(
        F.max("first").alias("first"), F.max("total").alias("total"), F.bool_and("length_ok").alias("length_ok"),
        F.count(F.lit(1)).alias("n"), F.max("number").alias("last"), F.min("number").alias("least"),
        F.sort_array(F.collect_list(F.struct("number", F.col("block").cast("string").alias("part")))).alias("parts"))
    block = F.array_join(F.transform("parts", lambda p: p["part"]), "").cast("binary")
    full = joined.where("first IS NOT NULL").withColumn("block", block)
    ok = (F.col("length_ok") & (F.col("least") == 1) & (F.col("last") == F.col("n"))
          & F.coalesce(F.col("total") == F.octet_length("block"), F.lit(False)))
    return whole.unionByName(full.select("first.*", ok.alias("complete"), "block"))


def pages_of(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, url, digest_ok, payload`` of reassembled responses
    and revisits. A response's payload is decoded from its transfer coding, counted and digested anew; a revisit has no
    payload and states those of its response. ``digest_ok`` is false where a record is incomplete or broken or the stated digest is another."""
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
              "digest_ok boolean, payload binary")

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 200):
                rows = []
                for r in batch.slice(s, 200).to_pylist():
                    if r["kind"] == "revisit":
                        rows.append((r["page_id"], r["payload_length"], r["payload_digest"], "revisit", r["refers_to"], r["url"],
                                     r["complete"], None))
                        continue
                    head, _, body = r["block"].partition(b"\r\n\r\n")
                    chunked = b"chunked" in head.lower().partition(b"transfer-encoding:")[2].split(b"\r\n")[0]
                    payload = decode_chunks(body) if chunked else body
                    got = digest(payload or b"")
                    ok = r["complete"] and payload is not None and r["payload_digest"] in (None, got)
                    rows.append((r["page_id"], len(payload or b""), got, "response", None, r["url"], ok, payload))
                kinds = [pa.int64()] * 2 + [pa.string()] * 2 + [pa.int64(), pa.string(), pa.bool_(), pa.binary()]
                cols = list(zip(*rows)) if rows else [[]] * len(kinds)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], [c.split()[0] for c in schema.split(", ")])

    cols = ["page_id", "kind", "url", "refers_to", "payload_length", "payload_digest", "complete", "block"]
    return records.where("kind IN ('response', 'revisit')").select(*cols).mapInArrow(run, schema)


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Writes ``pages`` as archives into the session's shared folder and reads them back."""
    spark = pages.sparkSession
    to = scratch_path(spark, "warc")
    write(pages, to, segment_bytes=segment_bytes)
    return pages_of(reassemble(read_records(spark, to)))
