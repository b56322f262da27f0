"""Web archives: a writer of one gzip member per record, and a splittable reader.

The reader's tasks take byte ranges. A task looks for gzip magic from the start of its
range, decodes the beginning of each candidate to see a WARC header there, and then
owns every record that starts inside its range, also where it ends beyond it.

Archives of other writers are read as well: field names in any case, several records in a member, records without some
fields. What is cut off or cannot be told apart is reported in the row's ``fault``.

Archives are written and read through Arrow's file systems, so the folder may be any
that all executors reach (a local path, hdfs://, s3://, gs://).
"""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

MAGIC = b"\x1f\x8b\x08"
# A new file is begun beyond this size.
FILE_BYTES = 1 << 28
SPLIT_BYTES = 1 << 24
_READ = 1 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _place(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _qualified(spark, path: str) -> str:
    """The path with the file system that Spark takes it to be in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = str(place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place))
    return found.replace("file:/", "file:///", 1) if found.startswith("file:/") and not found.startswith("file://") else found


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, own: str, url: str, payload: bytes, refers: str | None, date: str) -> bytes:
    """One record as a gzip member. A revisit keeps the payload's size and digest only."""
    clean = "".join(c if c.isprintable() and c != " " else "%" + c.encode().hex("%").upper() for c in url)
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{own}>", f"WARC-Date: {date}", f"WARC-Target-URI: {clean}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
    ]
    block = _HTTP
    if refers is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    else:
        block += payload
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def roles(pages: DataFrame, id: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """``pages`` (id, url, payload as binary) with ``first``, the smallest id with an equal payload, or null where there is no other row with it.

    Payloads are compared by SHA-256. Only digests are grouped; pages meet the repeated
    ones by a join whose hot keys Spark splits.
    """
    keyed = pages.withColumn("_digest", F.sha2(payload, 256))
    repeated = (
        keyed.where(F.length(payload) >= least_bytes).groupBy("_digest")
        .agg(F.min(id).alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    )
    return keyed.join(written(repeated, "repeated"), "_digest", "left").drop("_digest")


def write_warc(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` to files in the folder ``path``; return the table of files (``path, bytes, records``).

    The payload is ``html`` in UTF-8 (null: empty). Of rows with equal payloads of at
    least ``least_bytes`` bytes, those with the smallest id are responses and the others
    revisit it; a row without an id is a response. A task that runs again writes a new file; only files in the table count.
    """
    path = _qualified(pages.sparkSession, path)
    rows = pages.select(
        F.col(id).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = roles(rows, "id", "payload", least_bytes)
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "payload", F.when(F.col("first") < F.col("id"), F.col("first")).cast("string").alias("refers"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _place(path)
        system.create_dir(folder, recursive=True)
        files: list[tuple[str, int, int]] = []
        out, name, size, count = None, "", 0, 0

        def close():
            out.close()
            files.append((f"{path.rstrip('/')}/{name}", size, count))

        for batch in batches:
            for own, address, payload, refers in zip(*(batch.column(k) for k in ("id", "url", "payload", "refers")), strict=True):
                if out is None:
                    name, size, count = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{folder}/{name}", compression=None)
                refers = refers.as_py()
                record = _record("response" if refers is None else "revisit", own.as_py() or "", address.as_py(), payload.as_py(), refers, date)
                out.write(record)
                size, count = size + len(record), count + 1
                if size >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in files], pa.string()), pa.array([f[1] for f in files], pa.int64()), pa.array([f[2] for f in files], pa.int64())],
            names=["path", "bytes", "records"],
        )

    return written(rows.mapInArrow(write, "path string, bytes bigint, records bigint"), "archives")


def _decoded(reader, at: int) -> tuple[bytes | None, int, bool]:
    """The member at ``at``, where it ends and whether it is whole; None if it is none that holds a record."""
    reader.seek(at)
    unpack, parts, read, seen = zlib.decompressobj(31), [], 0, b""
    ended = False
    try:
        while not unpack.eof:
            chunk = reader.read(_READ if read else 4096)
            if not chunk:
                ended = True
                break
            read += len(chunk)
            parts.append(unpack.decompress(chunk))
            if len(seen) < 5:
                seen += parts[-1][:5]
                if not b"WARC/".startswith(seen[:5]):
                    return None, at, False
    except zlib.error:
        ended = True
    whole = b"".join(parts)
    return (whole if whole.startswith(b"WARC/") else None), at + read - len(unpack.unused_data), not ended


def found(reader, start: int, end: int) -> Iterator[tuple[bytes, bool]]:
    """Members that hold records and start in ``start <= place < end``, and whether they are whole."""
    at = start
    while at < end:
        reader.seek(at)
        window = reader.read(min(_READ, end - at) + len(MAGIC) - 1)
        hit = window.find(MAGIC)
        if hit < 0 or at + hit >= end:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        member, after, whole = _decoded(reader, at + hit)
        if member is not None:
            yield member, whole
        # What follows a broken member may be another one.
        at = after if member is not None and whole else at + hit + 1


def members(reader, start: int, end: int) -> Iterator[bytes]:
    """Whole members whose start lies in ``start <= place < end``."""
    return (member for member, whole in found(reader, start, end) if whole)


def _fields(head: bytes) -> dict[str, str]:
    """Named fields of a header by lower-cased name; a line that begins with a space goes on with the one before."""
    fields: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def _cut(data: bytes) -> tuple[bytes, bytes]:
    """Header and what follows its empty line."""
    ends = [(at, size) for at, size in ((data.find(b"\r\n\r\n"), 4), (data.find(b"\n\n"), 2)) if at >= 0]
    if not ends:
        return data, b""
    at, size = min(ends)
    return data[:at], data[at + size :]


def records(member: bytes, whole: bool = True) -> Iterator[dict]:
    """The records of a member, one after the other."""
    while member.startswith(b"WARC/"):
        fields = _fields(_cut(member)[0])
        rest = _cut(member)[1]
        length = fields.get("content-length", "")
        known = length.isascii() and length.isdigit()
        block = rest[: int(length)] if known else rest
        fault = "no length" if not known else "cut off" if len(block) < int(length) else None
        yield _record_fields(fields, block, fault)
        member = rest[len(block) :].lstrip(b"\r\n") if known else b""
    if member and not whole:
        yield _record_fields({}, b"", "cut off")
    elif member:
        yield _record_fields({}, b"", "no record")


def _record_fields(fields: dict[str, str], block: bytes, fault: str | None) -> dict:
    kind = fields.get("warc-type")
    own = lambda value: value.removeprefix("<").removesuffix(">").removeprefix("urn:page:") if value else None
    http = fields.get("content-type", "").lower().startswith("application/http")
    payload = _cut(block)[1] if http else block
    said = fields.get("warc-payload-digest")
    size = fields.get("x-payload-length", "")
    revisit = kind == "revisit"
    return {
        "id": own(fields.get("warc-record-id")) or None, "url": fields.get("warc-target-uri"), "record_type": kind,
        "refers_to": own(fields.get("warc-refers-to")),
        "payload": None if revisit else payload,
        "payload_bytes": (int(size) if size.isascii() and size.isdigit() else None) if revisit else len(payload),
        "payload_digest": (said and said.removeprefix("sha1:")) if revisit else digest(payload),
        "fault": fault,
    }


def parsed(record: bytes) -> dict:
    """Named fields of the first record of a member and its payload (None for a revisit)."""
    return next(records(record))


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """The records of the archives in ``files`` (``path, bytes``): ``id, url, record_type, refers_to, payload_bytes,
    payload_digest, fault`` and, if asked for, ``payload``.

    Size and digest are those of the full payload; a revisit's come from its header (null where it does not say), a
    response's are computed from what was read. The payload of an HTTP record is what follows its header; of another record, all of it.
    ``fault`` is null for a whole record, else ``cut off`` (the archive or member ends in it, or its length says more than there is), ``no length`` or
    ``no record`` (a member goes on with something else).
    """
    ends = F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))
    splits = files.where("bytes > 0").select("path", "bytes", F.explode(ends).alias("start"))
    splits = splits.select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"))
    many = splits.count()
    names = ["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "fault"] + ["payload"] * payload
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.string()] + [pa.binary()] * payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                system, name = _place(split["path"])
                with system.open_input_file(name) as reader:
                    rows, held = [], 0
                    for member, whole in found(reader, split["start"], split["end"]):
                        for fields in records(member, whole):
                            rows.append([fields[n] for n in names])
                            held += len(fields["payload"] or b"") if payload else 0
                            if held > 1 << 24 or len(rows) >= 10_000:
                                yield _batch(rows, names, kinds)
                                rows, held = [], 0
                    if rows:
                        yield _batch(rows, names, kinds)

    schema = "id string, url string, record_type string, refers_to string, payload_bytes bigint, payload_digest string, fault string" + ", payload binary" * payload
    # Splits are dealt out one by one; a task takes a few of them.
    return splits.repartition(max(1, min(many, 20_000)), "path", "start").mapInArrow(read, schema)


def _batch(rows: list[list], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
