"""WARC archives: writing pages as records, and a reader that salvages damaged archives."""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcohort.llm.common import arrow_schema, cut, map_arrow, new_path

MIN_SHARED = 1_000  # payloads of fewer bytes are always stored in full
ARCHIVE_BYTES = 16_000_000  # payload of an archive, about
VERSION, END, MAGIC = b"WARC/1.", b"\r\n\r\n", b"\x1f\x8b\x08"
EMPTY_MEMBER = gzip.compress(b"", 6, mtime=0)  # written between members: it adds nothing to what is read


def plan_records(pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to of every row of ``pages``.

    Of records with equal payloads of at least ``min_shared`` bytes, that with the
    largest page_id is the response and the others revisit it. Digests held by
    several pages are counted first and written; where they are few, Spark
    broadcasts them and no page is shuffled, and where they are many, AQE splits
    the join at a payload that is shared by very many pages.

    NULL html is an empty payload. Pages without an id are revisits where a page
    with an id has their payload. Repeated rows of the largest id are all responses.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(F.encode(html, "UTF-8")).alias("payload_digest"))
    shared = rows.filter(F.col("payload_bytes") >= min_shared).groupBy(F.col("payload_digest").alias("d"))
    shared = shared.agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("d", "first")
    rows = rows.join(cut(shared, "digests"), (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") >= min_shared), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select("page_id", "url", "html", "payload_bytes", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"))


def _record_text(date: str):
    """The record of a planned row, as text without its closing empty lines."""
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes"), F.lit("\r\n\r\n"))
    block = F.when(F.col("record_type") == "revisit", head).otherwise(F.concat(head, "html"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Target-URI", url), line("WARC-Date", F.lit(date)),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        F.when(F.col("record_type") == "revisit", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n").otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(F.encode(block, "UTF-8")))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block), F.lit("\r\n\r\n"), block,
    )


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [gzip.compress(r.encode() + END, 6, mtime=0) for r in batch.column(0).to_pylist()]
        yield pa.record_batch([pa.array(out, pa.binary())], names=["member"])


def write_warc(pages: DataFrame, path: str | None = None, compress: bool = True, min_shared: int = MIN_SHARED, archive_bytes: int = ARCHIVE_BYTES, date: str = "2024-01-01T00:00:00Z") -> str:
    """Write a record per row of ``pages`` (page_id, url, html) to archives in a folder; returns the folder.

    Spark's own writer commits the files, so a lost executor leaves no half of an
    archive and any file system will do. Each task writes the pages that it has
    read, rolled over at about ``archive_bytes``. Compressed archives hold one gzip
    member a record, as is usual.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    planned = plan_records(pages, min_shared)
    size = pages.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("html")).alias("b")).first()
    per_file = max(1, int(size["n"] * archive_bytes / max(1, size["b"] or 0)))
    records = planned.select(_record_text(date).alias("record"))
    if compress:
        members = map_arrow(records, _members, "member binary").select(F.col("member").cast("string"))
        writer = members.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
    else:
        writer = records.write.option("lineSep", END.decode())
    writer.option("maxRecordsPerFile", per_file).text(path)
    return path


class Damaged(Exception):
    """A record that fails a check; ``end``: where its declared end is sure, else None."""

    def __init__(self, why: str, end: int | None = None):
        super().__init__(why)
        self.end = end


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``, all checks passed."""
    stop = data.find(END, at) if data.startswith(VERSION, at) else -1
    if stop < 0:
        raise Damaged("no header")
    try:
        lines = data[at:stop].decode().split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        length = int(head["content-length"])
    except (ValueError, KeyError):
        raise Damaged("header") from None
    start, end = stop + 4, stop + 4 + length
    if length < 0 or data[end:end + 4] != END:
        raise Damaged("length")
    after = data[end + 4:end + 4 + len(VERSION)]
    sure = end + 4 if after in (b"", VERSION) or after.startswith(MAGIC) else None
    block = data[start:end]
    if (want := head.get("warc-block-digest")) and want != "sha1:" + hashlib.sha1(block).hexdigest():
        raise Damaged("block digest", sure)
    return head, block, end + 4


def records_in(data: bytes, base: int = 0) -> Iterator[tuple]:
    """("record", start, end, headers, block) and ("gap", start, end, why) of plain record bytes."""
    at, gap, why = 0, None, ""
    while at < len(data):
        try:
            head, block, end = parse_record(data, at)
        except Damaged as bad:
            if gap is None:
                gap, why = at, str(bad)
            if bad.end:
                at = bad.end
            else:
                found = data.find(VERSION, at + 1)
                at = found if found >= 0 else len(data)
            continue
        if gap is not None:
            yield "gap", base + gap, base + at, why
            gap = None
        yield "record", base + at, base + end, head, block
        at = end
    if gap is not None:
        yield "gap", base + gap, base + len(data), why


def _member(data: memoryview, at: int, step: int = 1 << 15) -> tuple[bytes, int]:
    """What the gzip member at ``at`` holds, and its end; fed in steps, so that no rest of the archive is copied."""
    z, out, pos = zlib.decompressobj(31), [], at
    while not z.eof:
        if pos >= len(data):
            raise Damaged("truncated member")
        try:
            out.append(z.decompress(data[pos:pos + step]))
        except zlib.error as e:
            raise Damaged(f"member: {str(e)[:60]}") from None
        pos += step
    return b"".join(out), min(pos, len(data)) - len(z.unused_data)


def _piece(data: bytes, view: memoryview, at: int) -> tuple[Iterator[tuple], int]:
    """What the gzip member or the plain record at ``at`` holds, and its end; at least one record, or an empty member."""
    if data.startswith(VERSION, at):
        head, block, end = parse_record(data, at)
        return iter([("record", at, end, head, block)]), end
    if not data.startswith(MAGIC, at):
        raise Damaged("no header")
    raw, end = _member(view, at)
    found = records_in(raw)
    first = next(found, None)
    if first is None:
        return iter(()), end
    if first[0] == "gap" and first[2] == len(raw):
        raise Damaged(first[3], end)
    return ((x[0], at, end, *x[3:]) for x in chain([first], found)), end


def salvage(data: bytes) -> Iterator[tuple]:
    """As :func:`records_in`, of an archive of plain records, gzip members or both, whichever follows.

    After a failed check the next valid member or version line is searched; the
    bytes passed over are a gap, as are members that hold no record.
    """
    view, at, gap, why = memoryview(data), 0, None, ""
    following = {MAGIC: 0, VERSION: 0}  # where each occurs next; searched again only when passed
    while at < len(data):
        try:
            found, end = _piece(data, view, at)
        except Damaged as bad:
            if gap is None:
                gap, why = at, str(bad)
            at = bad.end or at + 1
            for mark, place in following.items():
                if place < at:
                    place = data.find(mark, at)
                    following[mark] = place if place >= 0 else len(data)
            if not bad.end:
                at = min(following.values())
            continue
        if gap is not None:
            yield "gap", gap, at, why
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield "gap", gap, len(data), why


_OUT = "kind string, archive string, start long, end long, why string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _urn(value: str | None) -> int | None:
    digits = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def _row(x: tuple, archive: str, payloads: bool) -> dict:
    out = {"kind": x[0], "archive": archive, "start": x[1], "end": x[2]}
    if x[0] == "gap":
        return out | {"why": x[3]}
    head, block = x[3], x[4]
    top, _, payload = block.partition(END)
    kind = head.get("warc-type")
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    size = len(payload)
    if kind == "revisit":  # its payload is in the record it refers to; here are its length and digest
        size = next((int(v) for k, v in (h.split(":", 1) for h in top.decode("latin-1").split("\r\n")[1:]) if k.lower() == "content-length"), 0)
    else:
        digest = hashlib.sha1(payload).hexdigest()
    out |= {"page_id": _urn(head.get("warc-record-id")), "url": head.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": _urn(head.get("warc-refers-to"))}
    return out | ({"payload": payload} if payloads else {})


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Rows of kind record, and of kind gap for the bytes that could not be read, with archive, start, end and why.

    One archive is read at a time; ``payloads`` adds the bytes of each. An empty
    folder gives no rows. Files of any name are archives, but for those that Spark
    takes for hidden (a leading ``_`` or ``.``).
    """
    schema = _OUT + (", payload binary" if payloads else "")
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                name, rows, held = batch.column(0)[i].as_py(), [], 0
                for x in salvage(batch.column(1)[i].as_buffer().to_pybytes()):
                    rows.append(_row(x, name, payloads))
                    held += x[2] - x[1]
                    if held > 4_000_000 or len(rows) >= 4_096:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return map_arrow(files, read, schema)
