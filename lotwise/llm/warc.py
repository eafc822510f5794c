"""WARC archives: written by tasks, read back by byte ranges.

Every record is a gzip member of its own. A reading task gets a byte range of an archive,
looks for the gzip magic, takes a place for a record only if it decompresses and its
header is one of a WARC record, and owns the records that start inside its range, however
far the last one reaches. So archives of any size are read in parallel without an index.

Archives lie in a folder that all executors share. Each attempt of a writing task has
files of its own, and only files named by the committed manifest are read, so a task that
is lost and run again leaves no record twice.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.workspace import new_path, stored, stored_lookup

MAGIC = b"\x1f\x8b\x08"
LEAST_SHARED = 1_000  # bytes from which equal payloads are stored once
ARCHIVE = 256 << 20  # bytes after which a task starts another file
SPLIT = 8 << 20  # bytes of a range that is read in one go
TASK_BYTES = 64 << 20  # bytes of a reading task on large archives
_CHUNK = 1 << 20  # bytes read at once
_FEED = 16 << 10  # bytes decompressed at once
_MANIFEST = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as executors without Spark's settings need it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and "file://" not in full else full


# ---- one record


def record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """A response record, or a revisit of ``refers_to`` with the HTTP header alone, as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if refers_to is None else http
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=';/?:@&=+$,#%!*()[]~.-_')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    press = zlib.compressobj(4, zlib.DEFLATED, 31)
    return press.compress(whole) + press.flush()


def _name(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _number(name: str | None):
    text = name.removeprefix("<urn:page:").removesuffix(">") if name else "none"
    return None if text == "none" else int(text)


@dataclass(frozen=True)
class Record:
    fields: dict[str, str]
    body: bytes

    @property
    def payload(self) -> bytes:
        return self.body.partition(b"\r\n\r\n")[2]

    @property
    def payload_length(self) -> int:
        head = self.body.partition(b"\r\n\r\n")[0].decode("latin-1")
        lengths = [x.partition(":")[2] for x in head.split("\r\n") if x.lower().startswith("content-length:")]
        return int(lengths[0]) if lengths else len(self.payload)


def parsed(member: bytes) -> Record | None:
    """The WARC record in a decompressed member; None if it is not a whole one."""
    head, mark, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = fields.get("content-length", "")
    if "warc-type" not in fields or not length.isdigit() or len(rest) < int(length):
        return None
    return Record(fields, rest[: int(length)])


def members(file, start: int, end: int) -> Iterator[bytes]:
    """Decompressed members of ``file`` that start in [start, end) and hold a WARC header."""
    held, base, ended = b"", start, False  # held: bytes of the file from base on

    def more(keep: int) -> None:
        """Read on; bytes before place ``keep`` are let go."""
        nonlocal held, base, ended
        held, base = held[keep:], base + keep
        file.seek(base + len(held))
        read = file.read(_CHUNK)
        ended = not read
        held += read

    at = 0  # place in held
    while True:
        found = held.find(MAGIC, at)
        if found < 0:
            at = max(at, len(held) - len(MAGIC) + 1)
            if ended or base + at >= end:
                return
            more(at)
            at = 0
            continue
        if base + found >= end:
            return
        unpack = zlib.decompressobj(31)
        parts, used = [], found
        try:
            while not unpack.eof:
                if used == len(held):
                    if ended:
                        break
                    more(found)
                    used, found = used - found, 0
                    continue
                parts.append(unpack.decompress(memoryview(held)[used : used + _FEED]))
                used = min(len(held), used + _FEED)
                if len(parts) == 1 and len(parts[0]) >= 5 and not parts[0].startswith(b"WARC/"):
                    break
        except zlib.error:
            pass
        if unpack.eof and (whole := b"".join(parts)).startswith(b"WARC/"):
            at = used - len(unpack.unused_data)
            yield whole
        else:
            at = found + 1  # these bytes only look like a member


# ---- tables


def with_revisits(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """(page_id, url, payload, refers_to): null ``refers_to`` marks a response.

    Of equal payloads of ``least`` bytes or more that with the largest id is the response.
    Rows that share this id are responses alike; rows without an id revisit it, or are
    responses if no equal payload has an id. A null html is an empty payload.
    """
    c = F.col
    rows = pages.select(
        c("page_id").cast("bigint").alias("page_id"),
        c("url").cast("string").alias("url"),
        F.coalesce(c("html"), F.lit("")).cast("binary").alias("payload"),
    )
    digest = F.unhex(F.sha1("payload"))
    large = F.octet_length("payload") >= least
    narrow = rows.select("page_id", digest.alias("d"), F.octet_length("payload").alias("n")).filter(c("n") >= least)
    shared = narrow.groupBy("d", "n").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("k"))
    shared = stored_lookup(shared.filter("k > 1").select("d", "n", "first"), "shared_payloads")
    keyed = rows.withColumns({"d_": F.when(large, digest), "n_": F.octet_length("payload")})
    met = keyed.join(shared, (c("d_") == c("d")) & (c("n_") == c("n")), "left")
    refers = F.when(~c("page_id").eqNullSafe(c("first")), c("first"))
    return met.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z", least: int = LEAST_SHARED
) -> DataFrame:
    """Write all pages as WARC archives; the manifest (path, bytes, records) of the files.

    An empty table writes no archive. Without ``folder`` the session's shared one is used.
    """
    spark = pages.sparkSession
    target = qualified(spark, folder or new_path(spark, "warc"))

    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(target)
        out, path, size, n = None, "", 0, 0

        def row() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{target}/{path}"]), pa.array([size]), pa.array([n])], schema=_MANIFEST
            )

        for batch in stream:
            for page_id, url, payload, refers_to in zip(*(x.to_pylist() for x in batch.columns)):
                if out is not None and size >= ARCHIVE:
                    yield row()
                    out = None
                if out is None:
                    path, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{path}", compression=None)
                data = record(page_id, url, payload, refers_to, date)
                out.write(data)
                size += len(data)
                n += 1
        if out is not None:
            yield row()

    made = with_revisits(pages, least).mapInArrow(write, "path string, bytes bigint, records bigint")
    return stored(made, "manifest")


_RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"


def _read_tasks(manifest: DataFrame, split: int) -> int:
    """Tasks that read the archives: a stated number, as adaptive execution would put all
    ranges, of a few bytes each in the table that lists them, into one task.

    One for each ``TASK_BYTES``, or several for each core if that is more, and no more than
    there are ranges.
    """
    found = manifest.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.ceil(F.col("bytes") / split)), F.lit(0)).alias("ranges"),
    ).first()
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    return max(1, min(found["ranges"], max(4 * cores, found["bytes"] // TASK_BYTES)))


def read_archives(manifest: DataFrame, split: int = SPLIT, payloads: bool = False) -> DataFrame:
    """One row for each record of the manifest's archives.

    ``payload_digest`` is SHA-1 in lower-case hex: worked out anew for a response, and
    checked against its header, from the header for a revisit. ``payloads`` adds the
    payload (null for a revisit).
    """
    c = F.col
    ranges = manifest.filter("bytes > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("bigint"), c("bytes") - 1, F.lit(split).cast("bigint"))).alias("start")
    )
    ranges = ranges.repartition(_read_tasks(manifest, split))
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    kinds += [("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    schema = pa.schema(kinds + [("payload", pa.binary())] * payloads)

    def row(r: Record) -> tuple:
        f = r.fields
        digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
        revisit = f["warc-type"] == "revisit"
        if not revisit:
            true = hashlib.sha1(r.payload).hexdigest()
            if true != digest:
                raise ValueError(f"payload of {f['warc-record-id']} does not match its digest")
        known = (
            *(_number(f["warc-record-id"]), f.get("warc-target-uri"), f["warc-type"]),
            *(_number(f.get("warc-refers-to")), r.payload_length, digest),
        )
        return (*known, None if revisit else r.payload) if payloads else known

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(zip(*rows), schema)], schema=schema)

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in stream:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    for member in members(file, start, start + split):
                        found = parsed(member)
                        if found is None:
                            continue
                        rows.append(row(found))
                        size += len(member)
                        if size > 16 << 20 or len(rows) > 20_000:
                            yield packed(rows)
                            rows, size = [], 0
        if rows:
            yield packed(rows)

    return ranges.mapInArrow(read, _RECORDS + ", payload binary" * payloads)
