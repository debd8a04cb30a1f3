"""WARC archives: written by Spark, read back by a reader that salvages damaged ones.

Writing. A record is header lines, a block, and two line ends; the text source writes
one record per row with those two line ends as its separator, so that archives are plain
WARC 1.1 files, written and committed by Spark on any file system. Of records with
equal payloads one is a response and the others revisit it. Digests are computed
without Python. Equal payloads meet by digest in an equi-join against one row per
repeated payload, whose large partitions Spark splits; a filter of the repeated digests
keeps the other payloads out of that shuffle.

Reading. An archive (plain records, or gzip members of one record or more) is read
from its first byte. A record that fails a check - version line, header, length, end
mark, digest - begins a gap. The reader looks for the next version line or member
mark from which a valid record can be read, goes on there, and reports the bytes
between as quarantined. Inside a member it does the same over the inflated bytes, which
it reads in pieces, whatever their number; of a member that is cut off or fails a check
it keeps the records inflated before that. If such a member holds wrong bytes (and is
not only cut off), records count that their block digest proves. An archive is one row
for one task; writers bound its size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bits
from ledgerloom.llm.common import forget_at_exit, importable, staged
from ledgerloom.shared import scratch_path

ARCHIVE_BYTES = 16 << 20  # about; what a reading task holds
END = b"\r\n\r\n"
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
PIECE = 1 << 14  # compressed bytes that are inflated at a time
CUT_OFF = "member does not end"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: 20 bits are 4 digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, least_bytes: int) -> DataFrame:
    """One row per page with the text of its record."""
    plain = pages.select(
        F.col("`page_id`").cast("long").alias("page_id"),
        F.col("`url`").cast("string").alias("url"),
        F.coalesce(F.col("`html`").cast("string"), F.lit("")).alias("payload"),
    )
    marked = plain.withColumns({"size": F.octet_length("payload").cast("long"), "digest": base32_sha1(F.col("payload").cast("binary"))})
    groups = (
        marked.filter(F.col("size") >= least_bytes).groupBy("digest", "size")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").drop("n")
    )
    groups = staged(groups, "warc-repeats")
    own = F.xxhash64("digest", "size")
    likely = bits.prefilter(groups.select(own.alias("h")), "h", groups.count()).holds(own)
    met = marked.filter(likely).join(groups, ["digest", "size"], "left")
    met = met.unionByName(marked.filter(~likely).withColumn("first", F.lit(None).cast("long")))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit("\r\n"))

    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    built = met.withColumn("revisit", revisit).withColumn("block", block)
    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("block").cast("binary")))),
        F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first"), F.lit(">"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
    )
    return built.select(text.alias("value"))


def write_archives(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> str:
    """Write a record per page; return the folder of the archives.

    Of records with equal payloads of ``least_bytes`` or more, that with the largest
    page_id is the response (all rows that repeat it, too) and the others revisit it. A
    null payload is an empty one; a null id is never revisited, and a url may be null.
    """
    spark = pages.sparkSession
    if path is None:
        path = scratch_path(spark, "archives")
        forget_at_exit(spark, path)
    size = pages.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.col("`html`").cast("string"))).alias("bytes")).first()
    each = max(1, int(ARCHIVE_BYTES * max(1, size["n"]) / max(1, (size["bytes"] or 0) + 700 * size["n"])))
    records(pages, least_bytes).write.option("lineSep", END.decode()).option("maxRecordsPerFile", each).text(path)
    return path


@dataclass
class Found:
    """A record, or a gap, of an archive: bytes [begin, end) of the file, and [inner_begin,
    inner_end) of what they inflate to, if they are a gzip member."""

    begin: int
    end: int
    header: dict[str, str] | None = None
    block: bytes = b""
    reason: str = ""
    inner_begin: int | None = None
    inner_end: int | None = None


class Short(Exception):
    """The data at hand ends before the record can be told."""


def parse(data: bytes, at: int, size: int | None = None, proven: bool = False) -> Found:
    """The record at ``at`` of uncompressed data; ValueError with the check it fails.
    ``data`` may be the first part of ``size`` bytes: Short, if more of them are needed.
    ``proven``: a record without a block digest that can be checked fails."""
    size = len(data) if size is None else size
    version = _VERSION.match(data, at)
    if not version:
        if len(data) - at < 10 and len(data) < size:
            raise Short
        raise ValueError("no version line")
    header: dict[str, str] = {}
    begin = version.end()
    while True:  # line by line, so that most of what is no header is told early
        stop = data.find(b"\r\n", begin)
        if stop < 0:
            if len(data) < size:
                raise Short
            raise ValueError("header does not end")
        line, begin = data[begin:stop], stop + 2
        if not line:
            break
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without a name")
        header[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not header.get("warc-type") or not header.get("warc-record-id"):
        raise ValueError("a mandatory field is missing")
    length = header.get("content-length", "")
    if not length.isdigit():
        raise ValueError("no length")
    end = begin + int(length)
    if len(data) < end + 4 <= size:
        raise Short
    if data[end : end + 4] != END:
        raise ValueError("record does not end where its length says")
    block = data[begin:end]
    digest = header.get("warc-block-digest", "")
    if digest.startswith("sha1:"):
        if digest[5:] != base32_of(block):
            raise ValueError("block digest differs")
    elif proven:
        raise ValueError("no digest to check a record of a damaged member by")
    return Found(at, end + 4, header, block)


def base32_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def pieces(data: bytes, at: int) -> Iterator[tuple[bytes, int]]:
    """What the gzip member at ``at`` inflates to, piece by piece, each with the place in
    ``data`` after it. All that can be inflated comes before the ValueError."""
    inflate = zlib.decompressobj(31)
    for place in range(at, len(data), PIECE):
        chunk, saved = data[place : place + PIECE], inflate.copy()
        try:
            out = inflate.decompress(chunk)
        except zlib.error as bad:
            reason = f"member: {bad}"
        else:
            yield out, place + len(chunk) - len(inflate.unused_data)
            if inflate.eof:
                return
            continue
        for i in range(len(chunk)):  # byte by byte up to the damage
            try:
                out = saved.decompress(chunk[i : i + 1])
            except zlib.error:
                break
            yield out, place + i + 1
        raise ValueError(reason)
    raise ValueError(CUT_OFF)


def place_of(data: bytes, at: int, wanted: int) -> int:
    """The place after the bytes that the first ``wanted`` inflated ones need."""
    inflate = zlib.decompressobj(31)
    for place in range(at, len(data), PIECE):
        chunk, saved = data[place : place + PIECE], inflate.copy()
        try:
            made = len(inflate.decompress(chunk))
        except zlib.error:
            made = wanted
        if made < wanted:
            wanted -= made
            continue
        for i in range(len(chunk)):
            wanted -= len(saved.decompress(chunk[i : i + 1]))
            if wanted <= 0:
                return place + i + 1
    return len(data)


def inside(data: bytes, at: int, end: int, size: int, proven: bool) -> Iterator[Found]:
    """Records and gaps of the first ``size`` bytes that the member [at, end) inflates to.
    Held in memory: a record, and the pieces it lies in."""
    source = (piece for piece, _ in pieces(data, at))
    held, base, here, gap, reason = b"", 0, 0, None, ""  # held[here] is inner byte base + here
    while base + here < size:
        try:
            one = parse(held, here, size - base, proven)
        except Short:
            more, wanted = [held[here:]], max(1, len(held) - here)
            while wanted > 0 and base + here + sum(map(len, more)) < size:
                more.append(next(source))
                wanted -= len(more[-1])
            base, here = base + here, 0
            held = b"".join(more)[: size - base]
            continue
        except ValueError as failed:
            if gap is None:
                gap, reason = base + here, str(failed)
            mark = _VERSION.search(held, here + 1)
            if mark:
                here = mark.start()
            else:  # its last bytes may begin a version line
                here = max(here + 1, len(held) - 9) if base + len(held) < size else len(held)
            continue
        if gap is not None:
            yield Found(at, end, reason=reason, inner_begin=gap, inner_end=base + here)
            gap = None
        yield Found(at, end, one.header, one.block, "", base + here, base + one.end)
        here = one.end
    if gap is not None:
        yield Found(at, end, reason=reason, inner_begin=gap, inner_end=size)


def read(data: bytes, at: int) -> tuple[Iterable[Found], int, Found | None]:
    """What lies at ``at``: records (and gaps inside a member), the place after them, and
    what is wrong with the rest of a damaged member (its end is not known). ValueError if
    no record can be read."""
    if data[at : at + 3] != b"\x1f\x8b\x08":
        one = parse(data, at)
        return [one], one.end, None
    size, end, reason = 0, at, ""
    try:
        for piece, end in pieces(data, at):
            size += len(piece)
    except ValueError as failed:
        reason = str(failed)
    proven = reason not in ("", CUT_OFF)
    last = next((f.inner_end for f in inside(data, at, end, size, proven) if f.header), None)
    if last is None:
        raise ValueError(reason or ("no record in the member" if size else "empty member"))
    if not reason:
        return inside(data, at, end, size, False), end, None
    for one in inside(data, at, end, size, proven):
        last = one.inner_end if one.header else last
    end = place_of(data, at, last)
    return inside(data, at, end, last, proven), end, Found(end, end, reason=reason, inner_begin=last, inner_end=size)


def salvage(data: bytes) -> Iterator[Found]:
    """Records and gaps of an archive, in order; together they cover every byte."""
    at, known = 0, None
    while at < len(data):
        try:
            found, after, rest = known or read(data, at)
        except ValueError as failed:
            found, after, rest = [], at + 1, Found(at, at, reason=str(failed))
        yield from found
        known = None
        if rest:
            after, start = len(data), after
            for mark in _START.finditer(data, start):
                try:
                    known = read(data, mark.start())
                except ValueError:
                    continue
                after = mark.start()
                break
            rest.end = after
            yield rest
        at = after


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record or gap of the archives in a folder.

    Records: archive, begin, end, kind 'record', record_type, record_id, target_uri,
    refers_to, payload (null for revisits), payload_bytes and payload_digest (of the
    payload itself, or as a revisit states them). Gaps: archive, begin, end, kind 'gap'
    and the reason. In a gzip member, begin and end are the member's, and inner_begin and
    inner_end the place in what it inflates to. An empty file gives no rows.
    """
    importable(spark)
    schema = (
        "archive string, begin long, end long, kind string, reason string, record_type string, record_id string, "
        "target_uri string, refers_to string, payload binary, payload_bytes long, payload_digest string, inner_begin long, inner_end long"
    )
    names = [c.strip().split()[0] for c in schema.split(",")]
    kinds = [pa.string(), pa.int64(), pa.int64()] + [pa.string()] * 6 + [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def row(archive: str, one: Found) -> tuple:
        if one.header is None:
            return (archive, one.begin, one.end, "gap", one.reason) + (None,) * 7 + (one.inner_begin, one.inner_end)
        get = one.header.get
        head, split, body = one.block.partition(END)
        stated = re.search(rb"(?im)^content-length:\s*(\d+)", head) if split else None
        payload = body if one.block.startswith(b"HTTP/") and split else one.block
        if get("warc-type") == "revisit":
            payload, size = None, int(stated[1]) if stated else None
            digest = (get("warc-payload-digest") or "").removeprefix("sha1:") or None
        else:
            size, digest = len(payload), base32_of(payload)
        return (archive, one.begin, one.end, "record", None, get("warc-type"), get("warc-record-id"), get("warc-target-uri"), get("warc-refers-to"), payload, size, digest, one.inner_begin, one.inner_end)

    def step(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, held = [], 0
                for one in salvage(content.as_py()):
                    rows.append(row(archive, one))
                    held += len(one.block)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(step, schema)


def number(urn: Column) -> Column:
    """The id in <urn:page:ID>; null for one that is no number."""
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages, read the archives back: page_id, payload_bytes, payload_digest,
    record_type, refers_to of every record. An empty table gives no rows."""
    found = read_archives(pages.sparkSession, write_archives(pages, None, least_bytes)).filter("kind = 'record'")
    return found.select(
        number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )
