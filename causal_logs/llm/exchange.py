"""Texts stored in batches, and values sent from batches to buckets and answered.

Counting hundreds of values per text row by row would cost a row of shuffle for each.
Here a batch (about ``BATCH_BYTES`` of text) sends every bucket one block of bytes with
what belongs there; a bucket sees the blocks of all batches and answers each
with one block. A batch names a value once, so no value, however frequent, holds more
than one entry per batch of any bucket.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rows

BATCH_BYTES = 1 << 21
# Bytes of blocks that a bucket is meant to hold.
BUCKET_BYTES = 1 << 23
# Compression of stored texts.
_TEXT_LEVEL = 6
# Stands for a missing id: larger than every other.
NO_ID = np.iinfo(np.int64).max


def packed(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed block; ``unpacked`` gives them back."""
    head = b"".join(f"{a.dtype.str}:{len(a)};".encode() for a in arrays) + b"\n"
    whole = head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(whole).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(whole, asbytes=True)


def unpacked(block: bytes) -> list[np.ndarray]:
    whole = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), "zstd", asbytes=True)
    head, _, body = whole.partition(b"\n")
    out, at = [], 0
    for part in head.decode().split(";")[:-1]:
        kind, n = part.split(":")
        out.append(np.frombuffer(body, np.dtype(kind), int(n), at))
        at += out[-1].nbytes
    return out


def ipc(columns: list[pa.Array], names: list[str]) -> bytes:
    batch = pa.RecordBatch.from_arrays(columns, names=names)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def own_rows(others: bytes) -> tuple[pa.Array, pa.Array]:
    """The carried columns of a batch's rows as structs, and whether each text is null."""
    table = pa.ipc.open_stream(others).read_all().combine_chunks()
    whole = lambda c: c.chunk(0) if c.num_chunks else pa.array([], c.type)
    return whole(table.column("own")), whole(table.column("none"))


def batches(docs: DataFrame, id: str, text: str, name: str, carry: list[str] | None = None) -> DataFrame:
    """Write the texts to the shared folder in batches: ``batch``, ``block`` (ids, ends, bytes) and ``bytes``.

    Ids are taken as bigint, a missing one as ``NO_ID``; null texts are empty. The columns ``carry`` of the rows
    come along in ``others`` (see ``own_rows``), so that rows need not be found again by id.
    """

    def gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def block():
            sizes = np.concatenate([h[1] for h in held])
            data = np.concatenate([h[2] for h in held])
            # Texts are stored for longer than other blocks.
            own = packed(np.concatenate([h[0] for h in held]), np.cumsum(sizes), data, level=_TEXT_LEVEL)
            columns = [pa.array([number], pa.int64()), pa.array([own], pa.binary()), pa.array([len(data)], pa.int64())]
            if carry:
                others = ipc([pa.concat_arrays([h[3] for h in held]), pa.array(np.concatenate([h[4] for h in held]))], ["own", "none"])
                columns.append(pa.array([others], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["batch", "block", "bytes"] + ["others"] * bool(carry))

        for part in rows.texts(parts, "text", BATCH_BYTES):
            ids = part.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            held.append((ids, np.diff(part.starts), part.data, *([part.column("own"), part.missing] if carry else [])))
            if sum(len(h[2]) for h in held) >= BATCH_BYTES // 2:
                yield block()
                number += 1
                held.clear()
        if held:
            yield block()

    # Not a global of this module, which travels to the executors: they do not have that part of the library.
    from ..session import new_path

    own = [F.struct(*carry).alias("own")] if carry else []
    slim = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"), *own)
    spark, path = docs.sparkSession, new_path(docs.sparkSession, name)
    # Small row groups: a reader holds one of them.
    out = slim.mapInArrow(gather, "batch bigint, block binary, bytes bigint" + ", others binary" * bool(carry)).write.option("parquet.block.size", 1 << 23).option("compression", "uncompressed")
    out.parquet(path)
    return spark.read.parquet(path)


def bucket_count(total_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    return max(1, -(-total_bytes // bucket_bytes))


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 64-bit hash by its upper half; ascending for ascending hashes."""
    return ((values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def cuts(bucket: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the buckets that an ascending array of bucket numbers has."""
    at = np.searchsorted(bucket, np.arange(buckets + 1))
    return [(b, int(at[b]), int(at[b + 1])) for b in range(buckets) if at[b] < at[b + 1]]


def blocks(found: list[tuple]) -> pa.RecordBatch:
    """Rows (bucket, batch, block) as a record batch."""
    return pa.RecordBatch.from_arrays(
        [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.binary())],
        names=["bucket", "batch", "block"],
    )


BLOCKS = "bucket bigint, batch bigint, block binary"


def answered(table: DataFrame, answers: DataFrame, name: str = "answers") -> DataFrame:
    """``table`` (batch, block, ...) with the column ``name``: the (bucket, block) sent to each batch."""
    own = answers.groupBy("batch").agg(F.collect_list(F.struct("bucket", "block")).alias(name))
    return table.join(own, "batch", "left")
