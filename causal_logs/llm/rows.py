"""Texts of a table as numpy arrays, a few at a time."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Bytes of text worked on at a time; one longer text is worked on alone.
PART_BYTES = 1 << 21


class Texts(NamedTuple):
    """Texts laid end to end: ``data[starts[i]:starts[i + 1]]`` is the i-th, in UTF-8. ``index`` are its rows in ``batch``."""

    batch: pa.RecordBatch
    index: slice
    data: np.ndarray
    starts: np.ndarray
    missing: np.ndarray

    def column(self, name: str) -> pa.Array:
        return self.batch.column(name)[self.index]

    def __len__(self) -> int:
        return len(self.starts) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i + 1]].tobytes()


def texts(batches: Iterator[pa.RecordBatch], name: str, part_bytes: int = PART_BYTES) -> Iterator[Texts]:
    """The column ``name`` of the batches, cut into runs of rows of about ``part_bytes``; nulls count as empty."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(name)
        kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
        missing = np.asarray(pc.is_null(column))
        filled = column.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
        ends = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
        data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)
        row = 0
        while row < len(filled):
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + part_bytes, "right")) - 1)
            starts = ends[row : stop + 1] - ends[row]
            yield Texts(batch, slice(row, stop), data[ends[row] : ends[stop]], starts, missing[row:stop])
            row = stop


def schema(df: DataFrame, columns: list[str], added: str) -> StructType:
    """The type of some columns of ``df`` followed by new ones, given as DDL."""
    return StructType([*df.select(*columns).schema.fields, *StructType.fromDDL(added).fields])


def crc_mod(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo ``n``; 0 marks the rows held out of training."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def held_out(doc_id: Column) -> Column:
    """True for rows never learnt from. A missing id has no remainder and counts as held out."""
    return F.coalesce(crc_mod(doc_id) == 0, F.lit(True))


def sampled(df: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows of ``df``, chosen by the hash of ``key``; all of them if there are no more."""
    rows = df.agg(F.count(F.lit(1))).first()[0]
    if rows <= most:
        return df
    share = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30))
    return df.where(share < int(most / rows * (1 << 30)))


def sampled_by(df: DataFrame, key: str, group: str, most: int, groups: int) -> DataFrame:
    """About ``most`` rows of ``df``, evenly from its groups (a group with fewer gives all), chosen by the hash of ``key``. More than ``groups`` groups are an error."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).limit(groups + 1).collect()
    if len(counts) > groups:
        raise ValueError(f"more than {groups} different values of {group}")
    each = max(1, most // max(1, len(counts)))
    shares = {r[0]: min(1 << 30, int(each / r["n"] * (1 << 30))) for r in counts}
    if all(s == 1 << 30 for s in shares.values()):
        return df
    bound = F.create_map(*[F.lit(x) for name, share in shares.items() for x in (name, share)])[F.col(group)]
    return df.where(F.pmod(F.xxhash64(F.lit(group), F.col(key)), F.lit(1 << 30)) < bound)
