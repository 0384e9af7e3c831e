"""WARC archives: written with an index of their records, read back by coalesced byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.llm.common import stored
from rowtide.session import scratch

RESPONSE, REVISIT = "response", "revisit"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# A fixed date, so that equal input gives equal archives.
_DATE = "1970-01-01T00:00:00Z"
_INDEX = (
    "file string, offset long, length long, url string, digest string, record_type string, "
    "page string, refers string"
)
_BATCH_BYTES = 4_000_000
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # RFC 4648


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digest_of(payload: Column) -> Column:
    """The bare base32 SHA-1 of a binary column, by Spark's functions."""
    text = F.sha1(payload)
    signs = []
    # Five hexadecimal digits are twenty bits, four signs in base 32.
    for low in range(1, 41, 5):
        value = F.conv(F.substring(text, low, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            signs.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*signs)


# ---------------------------------------------------------------------------- records


def record(kind: str, page: str, url: str, payload: bytes, digest: str, refers: str | None) -> bytes:
    """One record as a gzip member of its own. A revisit has the payload's length, not the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if kind == RESPONSE else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {_one_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if kind == REVISIT:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    lines.append(f"Content-Length: {len(block)}")
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def _one_line(text: str) -> str:
    return " ".join(text.split())


def _fields(lines: bytes) -> dict[str, str]:
    found = {}
    for line in lines.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        found[name.decode().lower()] = value.strip().decode()
    return found


def parse(member: bytes) -> dict:
    """The parts of a record, read from its gzip member."""
    whole = zlib.decompress(member, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("no WARC record at this offset")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(_fields(http)["content-length"])
    if kind == RESPONSE and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("payload does not match its length or digest")
    return {
        "page": fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">"),
        "record_type": kind,
        "url": fields["warc-target-uri"],
        "payload": payload if kind == RESPONSE else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers": fields["warc-refers-to"].removeprefix("<urn:page:").removesuffix(">")
        if kind == REVISIT
        else None,
    }


# ---------------------------------------------------------------------------- writing


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    ident: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Writes a record for each page and returns the written index of the records.

    ``file, offset, length, url, digest, record_type, page, refers`` (ids as text). Of pages with
    equal payloads of at least ``least_bytes``, that with the smallest id is the response and the
    others revisit it; rows that repeat that id are responses too, and where no row of a payload
    has an id all are. Null html is an empty payload, null urls and ids are written as empty
    text. Payloads move once, with their digest, so that a payload that very many pages have is
    spread by the skew join and never gathered.

    Each task writes an archive of its own, under a name that no other attempt has; the index
    is a table that Spark commits, so files of failed attempts are named nowhere and not read.
    """
    narrow = pages.select(
        F.col(ident).alias("id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", digest_of(F.col("payload")))
    first = narrow.select("digest", "id").groupBy("digest").agg(F.min("id").alias("first"))
    joined = narrow.join(first, "digest")
    again = (F.length("payload") >= least_bytes) & ~F.coalesce(F.col("id").eqNullSafe(F.col("first")), F.lit(True))
    rows = joined.select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("page"),
        "url",
        "digest",
        F.when(again, F.col("first").cast("string")).alias("refers"),
        "payload",
    )

    def write(batches):
        out = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                files, path = pafs.FileSystem.from_uri(folder)
                files.create_dir(path, recursive=True)
                name = f"{path}/pages-{uuid.uuid4().hex}.warc.gz"
                out, offset = files.open_output_stream(name, compression=None), 0
                named = f"{folder}/{name.rpartition('/')[2]}"
            found = []
            for row in batch.to_pylist():
                kind = RESPONSE if row["refers"] is None else REVISIT
                member = record(kind, row["page"], row["url"], row["payload"], row["digest"], row["refers"])
                out.write(member)
                found.append(
                    {
                        "file": named,
                        "offset": offset,
                        "length": len(member),
                        "url": row["url"],
                        "digest": row["digest"],
                        "record_type": kind,
                        "page": row["page"],
                        "refers": row["refers"],
                    }
                )
                offset += len(member)
            yield pa.RecordBatch.from_pylist(found, schema=_index_schema())
        if out is not None:
            out.close()

    return stored(rows.mapInArrow(write, _INDEX), "warc-index")


def _index_schema() -> pa.Schema:
    text, number = pa.string(), pa.int64()
    kinds = (text, number, number, text, text, text, text, text)
    names = [part.split()[0] for part in _INDEX.split(", ")]
    return pa.schema(list(zip(names, kinds, strict=True)))


# ---------------------------------------------------------------------------- reading


def coalesced(spans: list[tuple[int, int]], gap: int, most: int) -> Iterator[tuple[int, int, list[int]]]:
    """Sorted byte ranges joined where at most ``gap`` bytes lie between, up to ``most`` bytes.

    Gives offset and length of each read and the numbers of the ranges in it. A range longer
    than ``most`` is read alone.
    """
    start = stop = 0
    members: list[int] = []
    for number, (offset, length) in enumerate(spans):
        if members and (offset - stop > gap or offset + length - start > most):
            yield start, stop - start, members
            members = []
        if not members:
            start = stop = offset
        stop = max(stop, offset + length)
        members.append(number)
    if members:
        yield start, stop - start, members


def read_records(
    index: DataFrame, *, payloads: bool = True, gap: int = 65_536, most: int = 8_000_000
) -> DataFrame:
    """The records that the index's rows select, read from the archives.

    ``page, record_type, url, payload, payload_bytes, payload_digest, refers``. Rows are dealt by
    stretches of a file and sorted, and neighbouring records are fetched with one read of at most
    ``most`` bytes. Each record's payload is checked against its digest. ``payload`` is null for
    revisits, and for all if ``payloads`` is false. No index rows give no records.
    """
    schema = pa.schema(
        [
            ("page", pa.string()),
            ("record_type", pa.string()),
            ("url", pa.string()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("refers", pa.string()),
        ]
    )

    def read(batches):
        handle, opened = None, None
        for batch in batches:
            rows = batch.to_pylist()
            for file, group in _by_file(rows):
                if file != opened:
                    files, path = pafs.FileSystem.from_uri(file)
                    handle, opened = files.open_input_file(path), file
                spans = [(r["offset"], r["length"]) for r in group]
                for start, size, members in coalesced(spans, gap, most):
                    data = memoryview(handle.read_at(size, start))
                    found, held = [], 0
                    for number in members:
                        offset, length = spans[number]
                        each = parse(data[offset - start : offset - start + length])
                        if not payloads:
                            each["payload"] = None
                        held += len(each["payload"] or b"")
                        found.append(each)
                        if held > _BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(found, schema=schema)
                            found, held = [], 0
                    if found:
                        yield pa.RecordBatch.from_pylist(found, schema=schema)

    stretch = F.floor(F.col("offset") / F.lit(4 * most))
    # The count is given, as Spark would count the few bytes of the index and not those it leads to.
    files, held = index.agg(F.countDistinct("file"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(files, -(-held // (4 * most)), 1)
    selected = (
        index.select("file", "offset", "length")
        .repartition(tasks, "file", stretch)
        .sortWithinPartitions("file", "offset")
    )
    return selected.mapInArrow(
        read,
        "page string, record_type string, url string, payload binary, payload_bytes long, "
        "payload_digest string, refers string",
    )


def _by_file(rows: list[dict]) -> Iterator[tuple[str, list[dict]]]:
    """Rows that follow each other and name the same file."""
    first = 0
    for at in range(1, len(rows) + 1):
        if at == len(rows) or rows[at]["file"] != rows[first]["file"]:
            yield rows[first]["file"], rows[first:at]
            first = at


def archive_and_read(
    pages: DataFrame,
    *,
    ident: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Writes the pages to archives and reads all records back.

    ``ident, payload_bytes, payload_digest, record_type, refers_to``, the ids in their own type.
    """
    spark = SparkSession.getActiveSession()
    folder = scratch(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    index = write_archives(pages, folder, ident=ident, url=url, html=html, least_bytes=least_bytes)
    kind = pages.schema[ident].dataType
    return read_records(index, payloads=False).select(
        F.nullif(F.col("page"), F.lit("")).cast(kind).alias(ident)
        if not isinstance(kind, T.StringType)
        else F.col("page").alias(ident),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers").cast(kind).alias("refers_to"),
    )
