"""WARC archives: writing with segments and revisits, and reassembly.

Each page becomes an HTTP response with chunked transfer framing. A block above ``segment_bytes`` is cut into a
``response`` record with ``WARC-Segment-Number: 1`` and ``continuation`` records that name its record id as
``WARC-Segment-Origin-ID``, the last with ``WARC-Segment-Total-Length``. Of pages with equal payloads of at least
``min_revisit_bytes`` bytes the one with the least id is a response; the others are ``revisit`` records without a
payload, which carry its digest and length and refer to it. Which digests occur twice or more is found on ids and
digests alone; payloads are shuffled only where there are too many such digests to broadcast. Archives are written by
Spark's text sink, whose line separator is the end of a WARC record, so that a lost executor leaves no torn files. A
record is at most a segment long, so a number of records for each archive keeps all below ``archive_bytes``.

Reading parses each archive by ``Content-Length`` as a stream, groups continuations by their origin, orders them by
segment number, checks that each number is there once and that the whole has the length that the last segment states,
and decodes the chunked framing. Only records in several segments are shuffled.

Defined cases: a null payload counts as empty; null URLs are left out of the record; null ids pass through, are
never referred to and refer to a least id if there is one; rows equal in id and payload are all responses if their
id is the least; an empty table writes no record. A damaged record (segments that lack or repeat, a wrong length or
digest) fails the read, or with ``strict`` False gives a row with its ``error`` and without a payload.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import new_path, picked, rowwise, spread_join, written

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
#: An archive has at most about this many bytes before compression; a record's headers take up to ``HEADER_BYTES``.
ARCHIVE_BYTES = 64 << 20
HEADER_BYTES = 2 << 10
#: Repeated digests up to this number (some 100 bytes each) are broadcast.
BROADCAST_DIGESTS = 100_000
MIN_REVISIT_BYTES = 100
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The date is a parameter of the archive, not the clock, so that a repeated task writes the same bytes.
DATE = "2024-01-01T00:00:00Z"


# --- framing -----------------------------------------------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP/1.1 chunked framing; chunks end between characters of UTF-8."""
    out, at = [], 0
    while at < len(payload):
        end = boundary(payload, min(at + size, len(payload)))
        out.append(b"%x\r\n%b\r\n" % (end - at, payload[at:end]))
        at = end
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError on wrong framing."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk doesn't end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def boundary(data: bytes, at: int) -> int:
    """The next end of a character at or after ``at``."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def record(headers: list[tuple[str, str]], block: bytes) -> str:
    """A record without the two line ends that close it."""
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"])
    return f"{head}\r\n\r\n{block.decode()}"


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(key.encode()).hexdigest())}>"


def page_records(key: str, page_id: object, url: str | None, payload: bytes, digest: str, refers: object, segment_bytes: int, refers_key: str | None = None) -> list[str]:
    """The records of one page; ``key`` tells its record from all others, ``refers_key`` that of the page it refers to."""
    named = record_id(key)
    common = [("WARC-Record-ID", named), ("WARC-Date", DATE), *([("WARC-Target-URI", clean)] if (clean := "".join((url or "").split())) else [])]
    common += [("WARC-Payload-Digest", f"sha256:{digest}"), *([("X-Page-ID", str(page_id))] if page_id is not None else [])]
    if refers is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        head = [("WARC-Type", "revisit"), *common, ("WARC-Profile", PROFILE), ("X-Refers-To-Page", str(refers)), *([("WARC-Refers-To", record_id(refers_key))] if refers_key else [])]
        return [record([*head, ("Content-Type", "application/http;msgtype=response")], block)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    pieces, at = [], 0
    while at < len(block):
        end = boundary(block, min(at + segment_bytes, len(block)))
        pieces.append(block[at:end])
        at = end
    head = [("WARC-Type", "response"), *common, ("Content-Type", "application/http;msgtype=response")]
    if len(pieces) == 1:
        return [record(head, block)]
    out = [record([*head, ("WARC-Segment-Number", "1")], pieces[0])]
    for k, piece in enumerate(pieces[1:], 2):
        own = record_id(f"{key}/{k}")
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", named), ("WARC-Segment-Number", str(k))]
        if k == len(pieces):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record(more, piece))
    return out


def inflated(archive: bytes, at_once: int = 1 << 20) -> Iterator[bytes]:
    """An archive's bytes in pieces; gzip files may have several members."""
    if archive[:2] != b"\x1f\x8b":
        yield from (archive[k : k + at_once] for k in range(0, len(archive), at_once))
        return
    rest = archive
    while rest:
        member = zlib.decompressobj(31)
        while not member.eof:
            piece = member.decompress(rest, at_once)
            rest = member.unconsumed_tail
            if piece:
                yield piece
            elif not rest and not member.eof:
                raise ValueError("an archive ends inside a gzip member")
        rest = member.unused_data


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, plain or gzipped: headers in lower case, block. Holds one record at a time."""
    pieces, data, at = inflated(archive), bytearray(), 0

    def more() -> bool:
        nonlocal data, at
        piece = next(pieces, None)
        if piece is None:
            return False
        del data[:at]
        at = 0
        data += piece
        return True

    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if len(data) - at < 2:
            if more():
                continue
            if len(data) > at:
                raise ValueError("an archive ends inside a record")
            return
        seen = at
        while (end := data.find(b"\r\n\r\n", max(at, seen - 3))) < 0:
            seen = len(data) - at
            if not more():
                raise ValueError("an archive ends inside a record")
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("no record where one should begin")
        headers = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        size, at = int(headers["content-length"]), end + 4
        while len(data) - at < size:
            if not more():
                raise ValueError("an archive ends inside a record")
        yield headers, bytes(data[at : at + size])
        at += size


def payload_of(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers in lower case and the decoded body of a block."""
    end = block.index(b"\r\n\r\n")
    headers = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in block[:end].decode().split("\r\n")[1:])}
    body = block[end + 4 :]
    return headers, unchunked(body) if "chunked" in headers.get("transfer-encoding", "").lower() else body


# --- writing -----------------------------------------------------------------------------------------


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    compressed: bool = True,
    archive_bytes: int = ARCHIVE_BYTES,
    broadcast_digests: int = BROADCAST_DIGESTS,
) -> None:
    """Write a record for each page, and continuations, as archives below ``path``.

    Up to ``broadcast_digests`` digests that occur twice or more are broadcast.
    """
    rows = picked(pages, id=id_col, url=url_col, payload=payload_col).select(
        "id", "url", F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload")
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # least id of each payload that occurs twice or more: digests and ids only. A count says whether the least id has it once
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.col("count").alias("same")))
    shared = rows.filter(F.length("payload") >= min_revisit_bytes).groupBy("digest", "id").count()
    shared = shared.groupBy("digest").agg(least.alias("least"), F.sum("count").alias("copies")).filter("copies > 1")
    shared, _ = written(shared.select("digest", F.col("least.id").alias("least"), (F.col("least.same") == 1).alias("once"), "copies"), "shared-digests")
    n, copies, most = shared.agg(F.count("*"), F.sum("copies"), F.max("copies")).first()
    names = ("id", "url", "payload", "digest")
    if n <= broadcast_digests:
        marked = rows.join(F.broadcast(shared.drop("copies")), "digest", "left").select(*names, "least", "once")
    else:
        alone = rows.join(shared.select("digest"), "digest", "left_anti").select(*names, F.lit(None).cast(rows.schema["id"].dataType).alias("least"), F.lit(None).cast("boolean").alias("once"))
        marked = spread_join(rows, shared, "digest", copies, most).select(*names, "least", "once").unionByName(alone)
    refers = F.when(F.col("least").eqNullSafe(F.col("id")), F.lit(None)).otherwise(F.col("least"))
    marked = marked.select(*names, refers.alias("refers"), "once", F.monotonically_increasing_id().alias("serial"))
    schema = T.StructType([T.StructField("value", T.StringType())])

    def step(b):
        out = []
        for i, u, p, d, r, once, serial in zip(*(c.to_pylist() for c in b.columns)):
            # a response that others refer to is named by what they know of it
            key = f"{i}/{d}" if once and r is None else f"{i}/{d}/{serial}"
            out += page_records(key, i, u, p, d, r, segment_bytes, f"{r}/{d}" if once and r is not None else None)
        return {"value": out}

    writer = rowwise(marked, schema, lambda: step).write.option("lineSep", "\r\n\r\n")
    writer = writer.option("maxRecordsPerFile", max(1, archive_bytes // (segment_bytes + HEADER_BYTES)))
    (writer.option("compression", "gzip") if compressed else writer).text(path)


# --- reading -----------------------------------------------------------------------------------------

_PIECE = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("segment", T.IntegerType()),
        T.StructField("total", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("refers", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("block", T.BinaryType()),
    ]
)
_PAGE = T.StructType(
    [
        T.StructField("page", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("segments", T.IntegerType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """The response, revisit and continuation records of all archives below ``path``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    import pyarrow as pa

    arrow = to_arrow_schema(_PIECE)
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter("length > 0").select("content")

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                out, size = [], 0
                for h, block in parse(content.as_py()):
                    kind = h.get("warc-type")
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    out.append(
                        {
                            "origin": h.get("warc-segment-origin-id", h["warc-record-id"]),
                            "segment": int(h.get("warc-segment-number", 0)),
                            "total": int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None,
                            "kind": kind,
                            "page": h.get("x-page-id"),
                            "refers": h.get("x-refers-to-page"),
                            "digest": h.get("warc-payload-digest"),
                            "block": block,
                        }
                    )
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema=arrow)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return stored.mapInArrow(run, _PIECE)


def assembled(kind: str | None, digest: str | None, segments: list[tuple[int, bytes]], total: int | None) -> tuple[int, str, bytes | None]:
    """Payload's length, digest and the payload of a page's ordered (segment number, block); ValueError if damaged.

    A record that isn't segmented has the number 0.
    """
    numbers, block = [n for n, _ in segments], b"".join(b for _, b in segments)
    if numbers != [0]:
        if numbers != list(range(1, len(numbers) + 1)):
            raise ValueError(f"segments {numbers} lack or repeat some")
        if total is None:
            raise ValueError("the last segment lacks")
        if len(block) != total:
            raise ValueError(f"segments have {len(block)} bytes in all, not {total}")
    http, payload = payload_of(block)
    if kind == "revisit":
        return int(http["content-length"]), (digest or "").removeprefix("sha256:"), None
    got = hashlib.sha256(payload).hexdigest()
    if digest and digest != f"sha256:{got}":
        raise ValueError("the payload doesn't have the record's digest")
    return len(payload), got, payload


def read_warc(spark: SparkSession, path: str, keep_payload: bool = True, strict: bool = True) -> DataFrame:
    """A row for each page of the archives below ``path``; ``keep_payload`` False leaves payloads null.

    ``strict`` False gives damaged records a row with an ``error`` where they would fail the read.
    """
    pieces = read_pieces(spark, path)
    one = F.struct("segment", "block")
    whole = pieces.filter("segment = 0").select("kind", "page", "refers", "digest", F.array(one).alias("segments"), F.lit(None).cast("long").alias("total"))
    grouped = (
        pieces.filter("segment > 0")
        .groupBy("origin")
        .agg(
            *(F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("kind", "page", "refers", "digest")),
            F.array_sort(F.collect_list(one)).alias("segments"),
            F.max("total").alias("total"),
        )
        .drop("origin")
    )

    def step(b):
        out = []
        for r in b.to_pylist():
            segments, error = [(s["segment"], s["block"]) for s in r["segments"]], None
            try:
                size, digest, payload = assembled(r["kind"], r["digest"], segments, r["total"])
            except (ValueError, KeyError) as e:
                if strict:
                    raise ValueError(f"page {r['page']}: {e}") from e
                size, digest, payload, error = None, None, None, str(e)
            out.append((r["page"], size, digest, r["kind"], r["refers"], len(segments), payload if keep_payload else None, error))
        return {f.name: [x[k] for x in out] for k, f in enumerate(_PAGE.fields)}

    columns = ("kind", "page", "refers", "digest", "segments", "total")
    return rowwise(whole.select(*columns).unionByName(grouped.select(*columns)), _PAGE, lambda: step)


def warc_roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", path: str | None = None) -> DataFrame:
    """Write ``pages`` and read the archives back, a row for each page without its payload."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_warc(pages, path, id_col, url_col, payload_col)
    kind = pages.schema[id_col].dataType
    return read_warc(spark, path, keep_payload=False).select(
        F.col("page").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "segments"
    )
