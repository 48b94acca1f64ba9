"""Web archives: one record per page, and a reader that salvages what damage leaves.

Pages are written as records, each a gzip member of its own; a page whose payload another page
has becomes a revisit of that one. Spark's text sink writes the bytes, with a zero byte after
each member, which gzip readers skip as padding; so archives are committed like any other output.

The reader checks each member, its version line, lengths and digests of known algorithm and
encoding. After a failed check it looks for the next place where a valid member or version line
starts, also in the content of a member, goes on there, and logs the bytes in between as a gap.

Defined cases: a null payload is empty, a null address is left out; a null id is read back as
null, and is the response only if no page with an id has its payload; repeated rows are written
as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.shared import BATCH_ROWS, batch_rows, same, table
from eventmart.session import Workspace, settle

ARCHIVE_BYTES = 16 * 1024 * 1024
DATE = "1970-01-01T00:00:00Z"
PADDING = "\u0000"
STEP = 1 << 16

# What the format writes.
VERSION = b"WARC/1.1\r\n"
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
LINE = re.compile(rb"WARC/1\.[01]\r\n")
HEAD = re.compile(rb"WARC/1\.[01]\r\n((?:[^\r\n]+\r\n)*)\r\n")
ALGORITHMS = ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")
PAGE = re.compile(r"<urn:page:(-?\d*)>")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers: int | None = None) -> bytes:
    """A response record, or a revisit of the record of page ``refers``."""
    body = b"" if refers is not None else payload
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + body
    fields = {
        "WARC-Type": "response" if refers is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page is None else page}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else re.sub(r"[\r\n]", "", url) or None,
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "WARC-Profile": None if refers is None else PROFILE,
        "WARC-Refers-To": None if refers is None else f"<urn:page:{refers}>",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return VERSION + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as one gzip member; the same bytes on every run."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


@dataclass
class Record:
    start: int  # place of the record, or of its member, in the archive
    end: int
    fields: dict[str, str]
    payload: bytes
    payload_bytes: int  # of the full payload, also for a revisit


@dataclass
class Gap:
    start: int
    end: int
    reason: str


def _differs(digest: str | None, data: bytes) -> bool:
    """Whether a digest that can be checked, by its algorithm and encoding, is not that of ``data``."""
    algorithm, _, value = (digest or "").partition(":")
    algorithm = algorithm.strip().lower().replace("-", "")
    if algorithm not in ALGORITHMS:
        return False
    value = value.strip().rstrip("=")
    right = hashlib.new(algorithm, data).digest()
    if len(value) == 2 * len(right):
        return value.lower() != right.hex()
    if len(value) == -(-8 * len(right) // 5):
        return value.upper() != base64.b32encode(right).decode().rstrip("=")
    if len(value) == -(-8 * len(right) // 6):
        plain = value.replace("-", "+").replace("_", "/")
        return plain != base64.b64encode(right).decode().rstrip("=")
    return False


def parse(data: bytes, at: int = 0) -> tuple[Record, int] | str:
    """The record at ``at`` and where it ends, or why there is no valid one."""
    head = HEAD.match(data, at)
    if head is None:
        return "no version line or headers"
    lines = head[1].decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}
    length = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        return "no length"
    end = head.end() + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        return "cut short or of another length"
    block = data[head.end() : end]
    if _differs(fields.get("warc-block-digest"), block):
        return "block differs from its digest"
    http, payload = b"", block
    kind = fields.get("content-type")
    # without a type the content may tell
    if block.startswith(b"HTTP/") if kind is None else kind.lower().startswith("application/http"):
        http, parted, rest = block.partition(b"\r\n\r\n")
        payload = rest if parted else block
    size = len(payload)
    if fields.get("warc-type") == "revisit":
        known = re.search(rb"(?im)^content-length:\s*([0-9]{1,18})\s*$", http)
        size = int(known[1]) if known else 0
    elif _differs(fields.get("warc-payload-digest"), payload):
        return "payload differs from its digest"
    return Record(at, end + 4, fields, payload, size), end + 4


def _unpacked(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """The content of the gzip member at ``at``, where it ends, and what is wrong with it.

    A broken member gives what unpacks before the error, and ``at`` as its end.
    """
    unpack, out, view, read, step = zlib.decompressobj(31), [], memoryview(data), at, STEP
    while not unpack.eof and read < len(data):
        before = unpack.copy() if step > 1 else None
        try:
            out.append(unpack.decompress(view[read : read + step]))
            read += step
        except zlib.error as error:
            if before is None:
                return b"".join(out), at, f"broken member: {error}"
            unpack, step = before, 1  # byte by byte, to lose nothing before the error
    if not unpack.eof:
        return b"".join(out), at, "member cut short"
    return b"".join(out), min(read, len(data)) - len(unpack.unused_data), None


def _packed_end(data: bytes, at: int, size: int) -> int:
    """Where in the archive the first ``size`` bytes of the content of the member at ``at`` end."""
    unpack, view, read = zlib.decompressobj(31), memoryview(data), at
    left = size - 1  # an error behind the last byte would be met together with it
    while left > 0:
        part = view[read : read + STEP]
        left -= len(unpack.decompress(part, left))
        read += len(part) - len(unpack.unconsumed_tail)
    return read


def _found_at(data: bytes, at: int, packed: bool) -> tuple[list[Record | Gap], int, str | None]:
    """Records of the member or the plain record at ``at``, with the gaps between those of a
    member; where to go on; and why that place or what follows is not valid."""
    if not (packed and data.startswith(MAGIC, at)):
        parsed = parse(data, at)
        return ([], at, parsed) if isinstance(parsed, str) else ([parsed[0]], parsed[1], None)
    content, end, broken = _unpacked(data, at)
    inside = list(salvage(content, packed=False))
    good = [f for f in inside if isinstance(f, Record)]
    if not good:
        return [], end, broken or (inside[0].reason if inside else "empty member")
    if broken:  # the rest of the content belongs to the gap that begins there
        end = _packed_end(data, at, good[-1].end)
        inside = inside[: inside.index(good[-1]) + 1]
    found: list[Record | Gap] = []
    for f in inside:
        if isinstance(f, Gap):
            found.append(Gap(at, end, f"{f.reason}, bytes {f.start} to {f.end} of the content"))
        else:
            found.append(Record(at, end, f.fields, f.payload, f.payload_bytes))
    if broken and end == len(data):
        found.append(Gap(at, end, broken))
    return found, end, broken


def salvage(data: bytes, packed: bool = True) -> Iterator[Record | Gap]:
    """Valid records of an archive in order, and the gaps between them.

    Of a member with several records each valid one is given, also of a broken member those
    before the error; they have the place of the member. ``packed`` is whether there are members.
    """
    starts = START if packed else LINE
    at, lost, reason = 0, None, ""
    while at < len(data):
        if lost is None and data[at] == 0:  # padding between members
            at += 1
            continue
        found, end, wrong = _found_at(data, at, packed)
        if found and lost is not None:
            yield Gap(lost, at, reason)
            lost = None
        yield from found
        if wrong is not None:
            if lost is None:
                lost, reason = (end if found else at), wrong
            if end == at:
                following = starts.search(data, at + 1)
                end = following.start() if following else len(data)
        at = end
    if lost is not None and lost < len(data):
        yield Gap(lost, len(data), reason)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write (page_id, url, html, refers_to) as archives of about ``archive_bytes`` each.

    Pages stay in their tasks; a task starts a new archive when one is full.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, number = 0, 0
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)))
            members, numbers = [], []
            for page, url, payload, refers in rows:
                members.append(member(record(page, url, payload or b"", refers)))
                numbers.append(number)
                size += len(members[-1])
                if size >= archive_bytes:
                    size, number = 0, number + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(members, pa.binary())],
                names=["archive", "member"],
            )

    rows = pages.select("page_id", "url", F.col("html").cast("binary"), "refers_to")
    made = rows.mapInArrow(run, "archive int, member binary")
    value = F.col("member").cast("string").alias("value")  # the bytes as they are
    made.select("archive", value).write.partitionBy("archive").option("lineSep", PADDING).text(folder)


RECORDS = (
    "archive string, start long, end long, gap string, type string, record_id string, uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """A row per record and per gap of all archives below a folder.

    ``gap`` says why bytes from ``start`` to ``end`` were left out, and is null for records. An
    archive is read whole by one task, so its size bounds the memory that a task needs.
    """

    def row(path: str, found: Record | Gap) -> tuple:
        if isinstance(found, Gap):
            return (path, found.start, found.end, found.reason, *[None] * 7)
        f = found.fields
        return (
            path, found.start, found.end, None, f.get("warc-type"), f.get("warc-record-id"),
            f.get("warc-target-uri"), f.get("warc-refers-to"), f.get("warc-payload-digest"),
            found.payload_bytes, found.payload if payload else None,
        )

    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[p.split()[1]]) for n, p in zip(names, RECORDS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows = []
                for found in salvage(content.as_py()):
                    rows.append(row(path.as_py(), found))
                    if len(rows) == BATCH_ROWS:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                        )
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                    )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInArrow(run, RECORDS)


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, refers_to): of pages with equal payloads all but that of the largest
    id refer to it. Only payloads that occur more than once meet the pages again."""
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    rows = pages.select("page_id", "url", "html", digest.alias("digest"))
    copies = rows.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    copies = settle(copies.where("n > 1 AND first IS NOT NULL").select("digest", "first"))
    joined = rows.join(copies, same(rows, copies, ["digest"]), "left")
    other = ~F.coalesce(F.col("page_id") == F.col("first"), F.lit(False))
    return joined.select("page_id", "url", "html", F.when(other, F.col("first")).alias("refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back."""
    spark = pages.sparkSession
    with Workspace(spark) as space:
        folder = f"{space.folder}/archives"
        write_archives(with_revisits(pages), folder)
        rows = read_archives(spark, folder, payload=False)

        def page(column: str):
            number = F.regexp_extract(column, PAGE.pattern, 1)
            return F.when(number != "", number.cast("long"))

        found = rows.where("gap IS NULL").select(
            page("record_id").alias("page_id"),
            "payload_bytes",
            F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
            F.col("type").alias("record_type"),
            page("refers_to").alias("refers_to"),
        )
        with batch_rows(spark, 1):  # a row is a whole archive
            return settle(found)


def op7_round_trip_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as its archive gives it back."""
    return round_trip(table(spark, folder, "pages", "page_id", "url", "html"))


SQL = """
WITH hashed AS (
    SELECT page_id, sha1(coalesce(html, '')) AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
    FROM pages
), grouped AS (
    SELECT *, max(page_id) OVER (PARTITION BY h) AS response FROM hashed
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM grouped
"""
