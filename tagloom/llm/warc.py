"""WARC archives: writing pages with segmented records, reading them back whole.

Writing: a page becomes an HTTP response record; of equal payloads of at least ``min_revisit``
bytes the smallest page id is the response and the others are revisit records (HTTP header only).
Payloads above ``chunk_chars`` use chunked transfer framing. A block longer than ``segment_bytes``
is continued in continuation records, which may lie in other files. Records are UTF-8 text as
the pages are, so Spark's text writer makes the archives, with at most ``records_per_file`` records each;
records and files are bounded whatever a page's length.

Reading: archives come through Spark's binary file reader and are cut by Content-Length. Whole
records are decoded where they are; segments alone are shuffled, grouped by origin id, ordered by
number, checked against the total length, then chunked framing is taken off, and the payload's SHA-256 is
compared with the declared one. A record that fails a check has its reason in ``error`` and a null payload; the
others of its archive are read all the same. Bytes that are no record, or a record that does not end at
its length, give one row with an ``error``, and reading goes on at the next line ``WARC/`` behind an empty line
(which may be a line of the damaged record's own text). So does an archive that is cut short or whose
compression is damaged: what could be unpacked is read.

Ids of any type stand in a header field, percent-encoded; :func:`read_warc` casts them to ``id_type``.
Null html is an empty payload, null ids and urls are left out of the header. Repeated rows each
make a record (equal id and payload: all responses). Ties: of equal payloads the smallest id is the response, a null
id never. Very long payloads are chunked and segmented. An empty table gives no records. Extra columns of
the input are not carried, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import small, written

MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
_COLUMNS = ["record_id", "record_type", "target_uri", "refers_to", "declared_digest", "declared_bytes", "origin",
            "segment", "total", "payload", "error", "page_id", "refers_to_page"]
_SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, declared_digest string, "
           "declared_bytes bigint, origin string, segment int, total bigint, payload binary, error string, page_id string, refers_to_page string")


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
                  min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(id, url, payload, digest, n, first): ``first`` is the response's id for revisits, else null."""
    p = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(text_col), F.lit("")).alias("payload"))
    p = p.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn("n", F.octet_length("payload").cast("long"))
    firsts = (p.where(F.col("n") >= min_revisit).groupBy(F.col("digest").alias("_d"))
              .agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_k")).where("_k > 1 AND _first IS NOT NULL").drop("_k"))
    joined = p.join(small(written(firsts, "warc_repeated")), (F.col("digest") == F.col("_d")) & (F.col("n") >= min_revisit), "left")
    return joined.select("id", "url", "payload", "digest", "n",
                         F.when(~F.col("id").eqNullSafe(F.col("_first")), F.col("_first")).alias("first"))


def _cut(data: bytes, size: int) -> list[bytes]:
    """Parts of at most ``size`` bytes that begin at characters."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and end > at + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[at:end])
        at = end
    return out


def http_block(payload: bytes, chunk_bytes: int) -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if len(payload) <= chunk_bytes:
        return head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    chunks = [b"%x\r\n%s\r\n" % (len(c), c) for c in _cut(payload, chunk_bytes)]
    return head + b"Transfer-Encoding: chunked\r\n\r\n" + b"".join(chunks) + b"0\r\n\r\n"


def _record(fields: list[tuple[str, object]], block: bytes) -> str:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    # the writer ends the row with the last line feed
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n" + block.decode() + "\r\n\r"


def _named(page_id) -> str:
    return "" if page_id is None else quote(str(page_id), safe="")


def page_records(page_id, row, url, payload: str, digest: str, first, chunk_bytes: int, segment_bytes: int) -> Iterator[str]:
    name = f"<urn:x-page:{_named(page_id)}:{row}>"
    uri = None if url is None else re.sub(r"[\r\n]", lambda m: "%%%02X" % ord(m[0]), url)
    fields = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", name), ("WARC-Date", DATE),
              ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("X-Page-ID", None if page_id is None else _named(page_id)), ("Content-Type", "application/http;msgtype=response")]
    body = payload.encode()
    if first is not None:
        fields += [("WARC-Refers-To", f"<urn:x-page:{_named(first)}>"), ("X-Refers-To-Page-ID", _named(first)),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        yield _record(fields, b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body))
        return
    block = http_block(body, chunk_bytes)
    if len(block) <= segment_bytes:
        yield _record(fields, block)
        return
    parts = _cut(block, segment_bytes)
    yield _record([*fields, ("WARC-Segment-Number", 1)], parts[0])
    for k, part in enumerate(parts[1:], 2):
        total = len(block) if k == len(parts) else None
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{k}>"), ("WARC-Date", DATE),
                       ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total)], part)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
               min_revisit: int = MIN_REVISIT, chunk_bytes: int = 8192, segment_bytes: int = 1 << 16,
               records_per_file: int = 2000, compression: str = "gzip") -> None:
    """Write one record (or one and its continuations) per page to archives in ``path``."""
    rows = with_revisits(pages, id_col, url_col, text_col, min_revisit).select(
        F.col("id").cast("string"), F.monotonically_increasing_id().alias("row"), "url", "payload", "digest", F.col("first").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for values in zip(*[c.to_pylist() for c in batch.columns]):
                for r in page_records(*values, chunk_bytes, segment_bytes):
                    out.append(r)
                    size += len(r)
                    if size > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                        out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    rows.mapInArrow(run, "value string").write.option("compression", compression).option(
        "maxRecordsPerFile", records_per_file).text(path)


# ---- reading -----------------------------------------------------------------------------------


def split_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """(fields by lower-case name, block, error) of each record of an uncompressed archive."""
    at = 0
    while at < len(data):
        fields, block, error, after = {}, b"", None, None
        end = data.find(b"\r\n\r\n", at)
        head = data[at : max(end, at)].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not head[0].startswith("WARC/"):
            error = f"no record at byte {at}"
        else:
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
            length = fields.get("content-length", "")
            if not (length.isascii() and length.isdigit()):
                error = f"record at byte {at} has no length"
            else:
                start, stop = end + 4, end + 4 + int(length)
                if data[stop : stop + 4] != b"\r\n\r\n":
                    error = f"record at byte {at} does not end at its length"
                else:
                    block, after = data[start:stop], stop + 4
        yield fields, block, error
        if after is None:
            found = data.find(b"\r\n\r\nWARC/", at)
            after = len(data) if found < 0 else found + 4
        at = after


def unpacked(data: bytes) -> tuple[bytes, str | None]:
    """An archive's bytes without compression, and what is wrong with it."""
    import zlib

    if data[:2] != b"\x1f\x8b":
        return data, None
    members = []
    while data:
        z = zlib.decompressobj(31)
        try:
            members.append(z.decompress(data))
        except zlib.error as e:
            return b"".join(members), f"compression is damaged: {e}"
        if not z.eof:
            return b"".join(members), "archive is cut short"
        data = z.unused_data
    return b"".join(members), None


def dechunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunks have no end")
        size = int(body[at:end].split(b";")[0], 16)
        start = end + 2
        if size < 0:
            raise ValueError("chunk of negative length")
        if not size:
            return b"".join(out)
        if body[start + size : start + size + 2] != b"\r\n":
            raise ValueError("chunk does not end at its length")
        out.append(body[start : start + size])
        at = start + size + 2


def http_payload(block: bytes) -> tuple[bytes, int | None]:
    """(payload without transfer framing, declared Content-Length)."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    length = int(fields[b"content-length"]) if b"content-length" in fields else None
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        return dechunk(body), length
    return body, length


def _decoded(block: bytes, is_revisit: bool, digest: str | None) -> tuple:
    """(declared bytes, payload, error)"""
    try:
        payload, length = http_payload(block)
    except ValueError as e:
        return None, None, str(e)
    if is_revisit:
        return length, None, None
    if length is not None and length != len(payload):
        return length, None, "payload differs from Content-Length"
    if digest and digest != sha256(payload).hexdigest():
        return length, None, "payload differs from its digest"
    return length, payload, None


def _head(f: dict[str, str]) -> dict:
    digest = f.get("warc-payload-digest", "")
    page, other = f.get("x-page-id"), f.get("x-refers-to-page-id")
    return {"record_id": f.get("warc-record-id"), "record_type": f.get("warc-type"), "target_uri": f.get("warc-target-uri"),
            "refers_to": f.get("warc-refers-to"), "declared_digest": digest.removeprefix("sha256:") if digest.startswith("sha256:") else None,
            "page_id": page if page is None else unquote(page), "refers_to_page": other if other is None else unquote(other)}


def _read_record(f: dict[str, str], block: bytes, error: str | None, segments: bool) -> dict | None:
    """A row of ``_SCHEMA``; None if the record belongs to the other kind (a faulty one counts as whole)."""
    number, total = f.get("warc-segment-number"), f.get("warc-segment-total-length")
    origin = f.get("warc-segment-origin-id", f.get("warc-record-id"))
    if error is None and number is not None and not (number.isdigit() and (total or "0").isdigit() and origin):
        error = "segment without number or origin"
    if (error is None and number is not None) != segments:
        return None
    row = dict.fromkeys(_COLUMNS) | _head(f) | {"error": error}
    if segments:
        row |= {"origin": origin, "segment": int(number), "total": total and int(total), "payload": block}
    elif error is None:
        row["declared_bytes"], row["payload"], row["error"] = _decoded(block, row["record_type"] == "revisit", row["declared_digest"])
    return row


def _records(spark: SparkSession, path: str, segments: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data, fault = unpacked(batch.column(0)[k].as_py())
                rows = [r for f, block, error in split_records(data) if (r := _read_record(f, block, error, segments))]
                if fault and not segments:
                    rows.append(dict.fromkeys(_COLUMNS) | {"error": fault})
                del data
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _SCHEMA.split(", ")])
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _SCHEMA)


def reassemble(pdf: pd.DataFrame) -> pd.DataFrame:
    """One record from all segments of an origin, or the reason why not."""
    pdf = pdf.sort_values("segment", kind="stable")
    first = pdf.iloc[0]
    block = b"".join(pdf["payload"])
    totals = [int(t) for t in pdf["total"] if not pd.isna(t)]
    payload, length, error = None, None, None
    if list(pdf["segment"]) != list(range(1, len(pdf) + 1)):
        error = "segments are missing or repeated"
    elif totals != [len(block)]:
        error = "segments differ from the total length"
    else:
        length, payload, error = _decoded(block, False, first["declared_digest"])
    return pd.DataFrame([(first["record_id"], first["record_type"], first["target_uri"], first["refers_to"],
                          first["declared_digest"], length, first["origin"], None, len(block), payload, error, first["page_id"], first["refers_to_page"])], columns=_COLUMNS)


def read_warc(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """All records of the archives in ``path``, segments put together. A group is one record's parts."""
    whole = _records(spark, path, False)
    parts = _records(spark, path, True).groupBy("origin").applyInPandas(reassemble, _SCHEMA)
    both = whole.unionByName(parts).drop("segment", "total", "origin")
    return both.withColumns({c: F.col(c).try_cast(id_type) for c in ("page_id", "refers_to_page")})
