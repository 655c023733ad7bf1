"""Web archives: writing and reading ARC of both versions and WARC, and the conversion of the first into the second.

Archives are real files, gzipped, in folders that Spark's own readers and writers reach. A task cuts its records into
archives of a set number of bytes, so none is larger than that or its one record; the writer puts each
into a file of its own. Records are found by the lengths that their headers declare, never by searching
for what may as well stand in a payload.

ARC has no identifiers, no record types and no digests. The conversion makes them: identifiers from the archive's
name and the record's place, 14-digit dates in the form WARC wants, the type from what the record holds, digests
from the bytes. Of records with equal payloads one stays, the others become revisits of it; to find it only
digests are shuffled.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.llm.base import query, slices, table
from pagemart.operators.joins import salted_lookup
from pagemart.session import materialise, scratch_path

#: Bytes of one archive before compression.
ARCHIVE_BYTES = 8_000_000
#: Payloads shorter than this are never revisits.
MIN_REVISIT = 100
#: Up to so many revisits are sent to all tasks; more are joined by a shuffle.
BROADCAST_ROWS = 20_000
EPOCH = "19700101000000"
# Fixed values of the formats: names of the header fields of a record line, by version, the length always last.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_HEADER, REFERS_HEADER = "X-Row-Id", "X-Refers-To-Row-Id"


@dataclass
class Record:
    """One captured response: where it lies, its header values, the response's own header, and the payload."""

    offset: int
    url: str
    ip: str
    date: str
    mime: str
    head: bytes
    body: bytes
    truncated: bool = False

    @property
    def row_id(self) -> str | None:
        return id_read(header_value(self.head, ID_HEADER))


def id_read(value: str | None) -> str | None:
    return None if value is None else unquote(value)


def header_value(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def plain_field(value: str | None, empty: str = "-") -> str:
    """A value without blanks, line ends or signs beyond ASCII, as a space-separated header line needs it."""
    return quote(value or "", safe="!#$%&'()*+,-./:;=?@[]_~") or empty


def split_response(block: bytes) -> tuple[bytes, bytes]:
    """(header with its empty line, payload); a block that is no HTTP response has no header."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, gap, body = block.partition(b"\r\n\r\n")
    return (head + gap, body) if gap else (b"", block)


def unzipped(content: bytes) -> bytes:
    """The bytes of an archive, gzipped as a whole, by record, or not at all."""
    if not content.startswith(b"\x1f\x8b"):
        return content
    parts = []
    while content:
        member = zlib.decompressobj(wbits=31)
        parts.append(member.decompress(content))
        content = member.unused_data
    return b"".join(parts)


# ---- ARC


def arc_header(name: str, version: int, date: str) -> bytes:
    """The version block an ARC file begins with."""
    fields = " ".join(ARC_FIELDS[version])
    body = f"{version} 0 pagemart\n{fields}\n".encode()
    middle = "" if version == 1 else f"200 - - 0 {name} "
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {middle}{len(body)}\n".encode() + body + b"\n"


def arc_record(record: Record, version: int, name: str, offset: int) -> bytes:
    """Header line and block, without the line end that follows every record."""
    block = record.head + record.body
    status = record.head[9:12].decode("ascii", "replace") if record.head else "-"
    more = "" if version == 1 else f"{status} {zlib.crc32(record.body):08x} - {offset} {name} "
    return f"{record.url} {record.ip} {record.date} {record.mime} {more}{len(block)}\n".encode() + block


def read_arc(content: bytes) -> Iterator[Record]:
    """The records of one ARC file after its version block.

    The version block says which fields a header line has; the version number alone decides if the names are
    missing. A record cut off by the end of the file is given as far as it goes, marked as truncated.
    """
    at, fields = 0, None
    while at < len(content):
        if content[at : at + 1] in b"\r\n":  # line ends between records
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at : len(content) if end < 0 else end].rstrip(b"\r").decode("utf-8", "replace")
        values = line.split(" ")
        if not values[-1].isdigit() or len(values) < 5:
            raise ValueError(f"no ARC header line at byte {at}: {line[:100]!r}")
        length = int(values[-1])
        begin = len(content) if end < 0 else end + 1
        block = content[begin : begin + length]
        if fields is None:
            if not line.startswith("filedesc://"):
                raise ValueError(f"an ARC file begins with filedesc, not with {line[:100]!r}")
            first, _, rest = block.partition(b"\n")
            names = tuple(rest.split(b"\n")[0].decode("ascii", "replace").split())
            version = int(first.split()[0] or 0) if first.split() and first.split()[0].isdigit() else 0
            fields = names if len(names) >= 5 else ARC_FIELDS.get(version)
            if fields is None:
                raise ValueError(f"unknown ARC version block {block[:60]!r}")
        else:
            if len(values) < len(fields):
                raise ValueError(f"{len(values)} values for the fields {fields} at byte {at}")
            # A URL with blanks in it, as some writers left it, has more words than there are fields.
            spare = len(values) - len(fields)
            own = dict(zip(fields, [" ".join(values[: spare + 1]), *values[spare + 1 :]], strict=True))
            head, body = split_response(block)
            yield Record(at, own["URL"], own["IP-address"], own["Archive-date"], own["Content-type"], head, body, len(block) < length)
        at = begin + length


# ---- WARC


def warc_date(date: str) -> str:
    """A 14-digit date, or one cut short after the day, the hour or the minute, as WARC writes it."""
    if not re.fullmatch(r"\d{8}(\d\d){0,3}", date):
        date = EPOCH
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_urn(archive: str, offset: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}').urn}>"


def warc_block(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends that follow it."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in (*fields, ("Content-Length", str(len(block)))))
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block


def warc_info(name: str) -> bytes:
    text = b"software: pagemart\r\nformat: WARC File Format 1.1\r\nconformsTo: http://iipc.github.io/warc-specifications/\r\n"
    return warc_block(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_urn(name, 0)), ("WARC-Date", warc_date(EPOCH)),
         ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], text,
    )


def warc_record(record: Record, archive: str, refers: dict | None) -> bytes:
    """The WARC record of an ARC record: a response, a revisit of ``refers``, or a resource if it is no HTTP response."""
    kind = "revisit" if refers else "response" if record.head else "resource"
    block = record.head if refers else record.head + record.body
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_urn(archive, record.offset)), ("WARC-Date", warc_date(record.date)),
        ("WARC-Target-URI", record.url), ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(record.body).hexdigest()}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response" if record.head else record.mime),
    ]
    if record.ip not in ("-", "0.0.0.0"):
        fields.append(("WARC-IP-Address", record.ip))
    if record.truncated:
        fields.append(("WARC-Truncated", "unspecified"))
    if refers:
        fields += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_urn(refers["archive"], refers["offset"])),
            ("WARC-Refers-To-Target-URI", refers["url"]), ("WARC-Refers-To-Date", warc_date(refers["date"])),
        ]
        if refers["row_id"] is not None:
            fields.append((REFERS_HEADER, quote(refers["row_id"], safe="")))
    return warc_block(fields, block)


def read_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record of a WARC file."""
    at = 0
    while at < len(content):
        if content[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = content.find(b"\r\n\r\n", at)
        lines = content[at : max(end, at)].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        if not lines[0].startswith("WARC/") or not fields.get("content-length", "").isdigit():
            raise ValueError(f"no WARC record at byte {at}: {content[at : at + 60]!r}")
        begin, length = end + 4, int(fields["content-length"])
        if begin + length > len(content):
            raise ValueError(f"the record at byte {at} declares {length} bytes, {len(content) - begin} are left")
        yield fields, content[begin : begin + length]
        at = begin + length


# ---- Spark


def write_archives(chunks: DataFrame, path: str, end: str) -> str:
    """Each row of ``content`` as a gzipped file; ``end`` follows an archive's last record."""
    text = chunks.select(F.col("content").cast("string"))
    text.write.option("lineSep", end).option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)
    return path


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(archive, content): the files of a folder."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"), "content")


def cut(records: Iterator[bytes], start: bytes, end: bytes, most: int) -> Iterator[bytes]:
    """Records joined into archives of about ``most`` bytes, each after ``start``."""
    held, size = [start], len(start)
    for record in records:
        if size + len(record) > most and size > len(start):
            yield b"".join(held)
            held, size = [start], len(start)
        held.append(record + end)
        size += len(held[-1])
    if size > len(start):
        yield b"".join(held)


def _contents(chunks: Iterator[bytes], end: bytes) -> Iterator[pa.RecordBatch]:
    for chunk in chunks:  # the writer adds the last record's end
        yield pa.RecordBatch.from_arrays([pa.array([chunk[: len(chunk) - len(end)]], pa.binary())], names=["content"])


def write_arc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    date: str = EPOCH, versions: tuple[int, ...] = (1, 2), archive_bytes: int = ARCHIVE_BYTES,
) -> str:
    """Pages as ARC files, one HTTP response a row; tasks take the ``versions`` in turn.

    A null body is an empty payload, a null URL a dash, a null id leaves the row without its header field.
    """
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(body_col).cast("string").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = versions[TaskContext.get().partitionId() % len(versions)]
        name = f"{TaskContext.get().partitionId()}.arc"

        def records() -> Iterator[bytes]:
            place = 0
            for batch in slices(batches, "body"):
                columns = (batch.column(0), batch.column(1), batch.column(2).cast(pa.binary()))
                for row_id, url, body in zip(*(c.to_pylist() for c in columns), strict=True):
                    body = body or b""
                    own = "" if row_id is None else f"{ID_HEADER}: {quote(row_id, safe='')}\r\n"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n{own}\r\n"
                    yield arc_record(Record(0, plain_field(url), "0.0.0.0", date, "text/html", head.encode(), body), version, name, place)
                    place += 1

        yield from _contents(cut(records(), arc_header(name, version, date), b"\n", archive_bytes), b"\n")

    return write_archives(rows.mapInArrow(run, "content binary"), path, "\n")


def arc_records(spark: SparkSession, path: str, with_body: bool) -> DataFrame:
    """(archive, offset, row_id, url, date, bytes, digest), or with the whole record in place of the last two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                columns: list[list] = [[], [], [], [], [], [], []]
                size = 0
                for r in read_arc(unzipped(content.as_py())):
                    last = ((r.mime, r.ip, r.truncated), (r.head, r.body)) if with_body else (len(r.body), hashlib.sha256(r.body).digest())
                    for column, value in zip(columns, (archive, r.offset, r.row_id, r.url, r.date, *last), strict=True):
                        column.append(value)
                    size += len(r.body)
                    if with_body and size > 2_000_000:
                        yield _records(columns, with_body)
                        columns, size = [[], [], [], [], [], [], []], 0
                yield _records(columns, with_body)

    ddl = "archive string, offset long, row_id string, url string, date string, "
    files = archive_files(spark, path)
    return files.mapInArrow(run, ddl + ("mime string, ip string, truncated boolean, head binary, body binary" if with_body else "bytes long, digest binary"))


def _records(columns: list[list], with_body: bool) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = ["archive", "offset", "row_id", "url", "date"]
    first, last = columns[:5], columns[5:]
    if with_body:
        last = [*([v[k] for v in last[0]] for k in range(3)), *([v[k] for v in last[1]] for k in range(2))]
        kinds += [pa.string(), pa.string(), pa.bool_(), pa.binary(), pa.binary()]
        names += ["mime", "ip", "truncated", "head", "body"]
    else:
        kinds += [pa.int64(), pa.binary()]
        names += ["bytes", "digest"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*first, *last], kinds, strict=True)], names=names)


def revisits(index: DataFrame, min_revisit: int = MIN_REVISIT, id_type: str = "long") -> DataFrame:
    """(archive, offset, refers) of the records whose payload another one keeps: that with the smallest id, nulls last."""
    long_ones = index.where(F.col("bytes") >= min_revisit)
    order = F.struct(F.col("row_id").isNull(), F.col("row_id").cast(id_type), "archive", "offset")
    keeper = F.struct("archive", "offset", "url", "date", "row_id")
    kept = long_ones.groupBy("digest").agg(F.count(F.lit(1)).alias("count"), F.min_by(keeper, order).alias("refers")).where("count > 1")
    kept = materialise(kept, "kept-payloads")
    copies = long_ones.select("archive", "offset", "digest").join(kept.select("digest"), "digest", "left_semi")
    both = salted_lookup(copies, kept.drop("count"), "digest", F.struct("archive", "offset"), "inner", counts=kept.select("digest", "count"))
    return both.where("archive != refers.archive or offset != refers.offset").select("archive", "offset", "refers")


def arc_to_warc(
    spark: SparkSession, arc_path: str, warc_path: str, min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES,
    id_type: str = "long", broadcast_rows: int = BROADCAST_ROWS,
) -> str:
    """All ARC files of a folder as WARC files in another, one record each, copies as revisits.

    The archives are read twice: once for the digests, once for the records themselves, which are not shuffled
    as long as there are at most ``broadcast_rows`` revisits.
    """
    index = materialise(arc_records(spark, arc_path, False), "arc-index")
    known = materialise(revisits(index, min_revisit, id_type), "revisits")
    known = F.broadcast(known) if known.count() <= broadcast_rows else known.hint("shuffle_hash")
    rows = arc_records(spark, arc_path, True).join(known, ["archive", "offset"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in slices(batches, "body", 4_000_000):
                for r in batch.to_pylist():
                    record = Record(r["offset"], r["url"], r["ip"], r["date"], r["mime"], r["head"], r["body"], r["truncated"])
                    yield warc_record(record, r["archive"], r["refers"])

        name, end = f"{TaskContext.get().partitionId()}.warc", b"\r\n\r\n"
        yield from _contents(cut(records(), warc_info(name) + end, end, archive_bytes), end)

    return write_archives(rows.mapInArrow(run, "content binary"), warc_path, "\r\n\r\n")


WARC_DDL = "row_id string, record_id string, record_type string, url string, date string, payload_bytes long, payload_digest string, refers_to string"


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per response, resource or revisit of a folder of WARC files, without the payloads.

    A revisit has the bytes and the digest of the payload it stands for. A payload that does not have its record's
    digest raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                columns: list[list] = [[] for _ in range(8)]
                for fields, block in read_warc(unzipped(content.as_py())):
                    if (kind := fields["warc-type"]) not in ("response", "resource", "revisit"):
                        continue
                    head, body = (block, b"") if kind == "revisit" else split_response(block)
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
                    if kind != "revisit" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"record {fields.get('warc-record-id')} does not have the digest {digest}")
                    size = int(header_value(head, "Content-Length") or 0) if kind == "revisit" else len(body)
                    values = (
                        id_read(header_value(head, ID_HEADER)), fields["warc-record-id"], kind, fields["warc-target-uri"], fields["warc-date"],
                        size, digest, id_read(fields.get(REFERS_HEADER.lower())),
                    )
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                kinds = [pa.int64() if k == 5 else pa.string() for k in range(8)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in WARC_DDL.split(", ")])

    return archive_files(spark, path).mapInArrow(run, WARC_DDL)


def archived(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_revisit: int = MIN_REVISIT,
    archive_bytes: int = ARCHIVE_BYTES, broadcast_rows: int = BROADCAST_ROWS, versions: tuple[int, ...] = (1, 2),
) -> DataFrame:
    """Rows as ARC files, converted to WARC files, read back: (id, payload_bytes, payload_digest, record_type, refers_to).

    A null body is an empty payload, a null URL a dash. Of equal payloads of ``min_revisit`` bytes or more that
    with the smallest id is the response, a null id comes after all others, and of repeated rows one is it.
    An empty table gives no rows; other columns are not read, whatever their names.
    """
    spark, kind = pages.sparkSession, dict(pages.dtypes)[id_col]
    arc = write_arc(pages, scratch_path(spark, "arc"), id_col, url_col, body_col, versions=versions, archive_bytes=archive_bytes)
    warc = arc_to_warc(spark, arc, scratch_path(spark, "warc"), min_revisit, archive_bytes, kind, broadcast_rows)
    return warc_records(spark, warc).select(
        F.col("row_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


ORACLE = f"""
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
kept AS (SELECT payload_digest, min(page_id) AS keeper FROM payloads WHERE payload_bytes >= {MIN_REVISIT} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM payloads LEFT JOIN kept USING (payload_digest)"""


@query("op12_arc_to_warc", ORACLE)
def op12_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))
