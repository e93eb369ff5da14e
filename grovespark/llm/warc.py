"""WARC archives: written and read by Spark, with segments, revisits and chunked transfer framing.

Writing: each page becomes one record, an HTTP response whose body is framed in chunks. A block longer than
``segment`` bytes is cut into a first record and continuation records. Of equal payloads of at least ``min_bytes``, the
one with the largest page_id is the response and the others are revisit records without a payload. A record ends with
two line breaks, which is what the text writer puts after each row, so the files are plain WARC files in any store.

Reading: every file is parsed record by record; whole records are decoded at once; continuation records are grouped by
the identifier of their origin, ordered by segment number, checked against the total length, and then decoded. A
segment is at most ``segment`` bytes and a file at most ``RECORDS`` records, so a file's size is bounded.

A record's identifier is made of its page_id and payload digest, so that a revisit names the record that it repeats.

Defined cases: a null html is an empty payload; a null url has no target line; a null page_id is kept as such, is the
smallest of all, and is a response where no row with an id has its payload; rows that repeat both page_id and payload of
a response are that response written again, under the same identifier (segments are put together once, and count as often
as they were written); a record whose segments are missing or don't add up, or that is cut off or damaged, has ``status``
incomplete and a null payload, and reading goes on at the next record; an empty table gives no record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm.common import Workspace, rebatch, spread_join, table

SEGMENT, CHUNK, RECORDS = 32_768, 4_096, 512
END = "\r\n\r\n"
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def _cut(data: bytes, size: int) -> Iterator[bytes]:
    """Pieces of at most ``size`` bytes that don't cut a UTF-8 character."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in fields), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def identifier(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def records(page_id, url, html, keeper, segment: int) -> Iterator[bytes]:
    """The records of one page, without the two line breaks after each."""
    payload = (html or "").encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    own = identifier(page_id, digest)
    again = keeper is not None and keeper != page_id
    common = [("WARC-Record-ID", f"{own[:-1]}:{uuid.uuid4().hex}>" if again else own), ("WARC-Date", "2024-01-01T00:00:00Z")]
    if url is not None:
        common.append(("WARC-Target-URI", "".join(c if c >= " " else " " for c in url)))
    common.append(("WARC-Payload-Digest", "sha1:" + digest))
    if again:
        yield _record([("WARC-Type", "revisit"), *common, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", identifier(keeper, digest))], b"")
        return
    block = HEAD + b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in _cut(payload, CHUNK)) + b"0\r\n\r\n"
    kind = ("Content-Type", "application/http;msgtype=response")
    if len(block) <= segment:
        yield _record([("WARC-Type", "response"), *common, kind], block)
        return
    parts = list(_cut(block, segment))
    yield _record([("WARC-Type", "response"), *common, kind, ("WARC-Segment-Number", 1)], parts[0])
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if k == len(parts) else []
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}/{k}>"), common[1], ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k), *last], part)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 1, segment: int = SEGMENT, work: Workspace | None = None) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files under ``path``."""
    work = work or Workspace(pages.sparkSession, "warc")
    # A payload of too few bytes has no key and meets nothing.
    key = F.when(F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes, F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    rows = pages.select("page_id", "url", "html", key.alias("digest"))
    # Only payloads that occur more than once are joined back: one row each, however often a payload occurs.
    same = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    same = work.save(same, "equal")
    joined = spread_join(rows, same.select("digest", "keeper"), ["digest"], "left", counts=same.select("digest", "n"), by=["page_id", "url"]).select("page_id", "url", "html", "keeper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rebatch(batches, 2):
            out, held = [], 0
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for r in records(*row, segment):
                    out.append(r)
                    held += len(r)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    joined.mapInArrow(run, "value string").write.option("lineSep", END).option("maxRecordsPerFile", RECORDS).text(path)


def dechunk(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        n = int(body[at:line].split(b";")[0], 16)
        if not n:
            return b"".join(out)
        out.append(body[line + 2 : line + 2 + n])
        if len(out[-1]) != n or body[line + 2 + n : line + 4 + n] != b"\r\n":
            raise ValueError("a chunk is cut off")
        at = line + 4 + n


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(fields, block) of every record of a file; the block is None where the record is cut off or its head is damaged."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        head = data[at : end if end >= 0 else len(data)]
        fields = {}
        for line in head.split(b"\r\n")[1:]:
            k, _, v = line.partition(b":")
            fields[k.decode("utf-8", "replace").lower()] = v.decode("utf-8", "replace").strip()
        n = fields.get("content-length", "")
        stop = end + 4 + int(n) if end >= 0 and n.isdecimal() and head.startswith(b"WARC/") else len(data) + 1
        if stop <= len(data) and (stop == len(data) or data[stop : stop + 4] == b"\r\n\r\n"):
            yield fields, data[end + 4 : stop]
            at = stop + 4
        else:
            yield fields, None
            again = data.find(b"\r\n\r\nWARC/", at + 1)
            at = again + 4 if again >= 0 else len(data)


PARSED = "page_id bigint, record_type string, refers_to bigint, digest string, origin string, segment int, total bigint, block binary, payload binary, status string"


def _page(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").rstrip(">").split(":")[0]
    return int(text) if text.removeprefix("-").isdecimal() else None


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isdecimal() else None


def _decoded(block: bytes, total: int | None = None) -> tuple[bytes | None, str]:
    try:
        return (payload_of(block), "ok") if total is None or total == len(block) else (None, "incomplete")
    except ValueError:
        return None, "incomplete"


def _parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in PARSED.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.string()]
    for b in batches:
        for data in b.column(0):
            rows, held = [], 0

            def flush() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

            for f, block in parse(data.as_py()):
                kind, digest = f.get("warc-type"), f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                origin = f.get("warc-segment-origin-id", f.get("warc-record-id"))
                page, refers, nth = _page(origin), _page(f.get("warc-refers-to")), _number(f.get("warc-segment-number"))
                if origin and nth and kind in ("response", "continuation"):
                    rows.append((page, kind, None, digest, origin, nth, _number(f.get("warc-segment-total-length")), block, None, None))
                elif block is None or kind not in ("response", "revisit"):
                    rows.append((page, kind, refers, digest, None, None, None, None, None, "incomplete"))
                elif kind == "revisit":
                    rows.append((page, kind, refers, digest, None, None, None, None, None, "ok"))
                else:
                    rows.append((page, kind, None, digest, None, None, None, None, *_decoded(block)))
                held += len(block or b"")
                if held > 4 << 20:
                    yield flush()
                    rows, held = [], 0
            if rows:
                yield flush()


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, times, parts) to (page_id, times, digest, payload, status); parts have each segment number once."""
    for b in batches:
        out = []
        for page, times, parts in zip(*(c.to_pylist() for c in b.columns), strict=True):
            parts.sort(key=lambda p: p["segment"])
            whole = [p["segment"] for p in parts] == list(range(1, len(parts) + 1)) and parts[-1]["total"] is not None and all(p["block"] is not None for p in parts)
            payload, status = _decoded(b"".join(p["block"] for p in parts), parts[-1]["total"]) if whole else (None, "incomplete")
            out.append((page, times, parts[0]["digest"], payload, status))
        cols = list(zip(*out, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["page_id", "times", "digest", "payload", "status"])


def base32_of_hex(digest: Column) -> Column:
    """RFC 4648 base32 of 40 hexadecimal digits: five of them are four letters."""
    parts = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def read_records(spark: SparkSession, path: str, *measures: Column, work: Workspace | None = None) -> DataFrame:
    """(page_id, record_type, refers_to, digest, status, *measures): ``measures`` are columns over ``payload``."""
    work = work or Workspace(spark, "warc")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    parsed = files.mapInArrow(_parse_files, PARSED)
    parsed = work.save(parsed.select("page_id", "record_type", "refers_to", "digest", "origin", "segment", "total", "block", "status", *measures), "records")
    names = parsed.columns[9:]
    whole = parsed.where("origin IS NULL").select("page_id", "record_type", "refers_to", "digest", "status", *names)
    # Each segment once, before anything is gathered: a record that was written many times is no larger than one.
    parts = parsed.where("origin IS NOT NULL").groupBy("origin", "segment").agg(F.first("page_id").alias("page_id"), F.count("*").alias("times"), F.max("total").alias("total"), F.max("digest").alias("digest"), F.first("block", ignorenulls=True).alias("block"))
    groups = parts.groupBy("origin").agg(F.first("page_id").alias("page_id"), F.max(F.when(F.col("segment") == 1, F.col("times")).otherwise(1)).alias("times"), F.collect_list(F.struct("segment", "total", "digest", "block")).alias("parts"))
    joined = groups.select("page_id", "times", "parts").mapInArrow(_reassemble, "page_id bigint, times bigint, digest string, payload binary, status string")
    joined = joined.select("page_id", "times", "digest", "status", *measures).withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return whole.union(joined.select("page_id", F.lit("response"), F.lit(None).cast("bigint"), "digest", "status", *names))


def round_trip(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Write ``pages`` as archives, read them back and resolve the revisits."""
    spark = pages.sparkSession
    work = Workspace(spark, "warc")
    path = work.path("archives")
    write_archives(pages, path, min_bytes, work=work)
    got = work.save(read_records(spark, path, F.octet_length("payload").cast("long").alias("payload_bytes"), base32_of_hex(F.sha1("payload")).alias("payload_digest"), work=work), "read")
    work.drop(path)
    responses = got.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("bigint").alias("refers_to"))
    again = got.where("record_type = 'revisit'").select("page_id", "refers_to", F.col("digest").alias("payload_digest"), "record_type")
    key = ["refers_to", "payload_digest"]
    counts = work.save(again.groupBy(*key).agg(F.count("*").alias("n")), "revisited")
    kept = responses.withColumn("refers_to", F.col("page_id")).join(counts, key, "left_semi").groupBy(*key).agg(F.max("payload_bytes").alias("payload_bytes"))
    again = spread_join(again, work.save(kept, "responses"), key, "left", counts=counts)
    return responses.union(again.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), min_bytes=0)
