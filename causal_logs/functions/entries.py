"""Whole log entries: display text, canonical JSON, metadata."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MAX_METADATA
from . import clocks


def time_text(ts_ms="ts_ms") -> Column:
    """``2024-06-29 08:00:00.000`` in the session time zone."""
    ts_ms = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    return F.date_format(F.timestamp_millis(ts_ms), "yyyy-MM-dd HH:mm:ss.SSS")


def ascii_only(text) -> Column:
    """Drop every byte but printable ASCII, newline and tab."""
    return F.regexp_replace(text, r"[^\x20-\x7E\n\t]", "")


def truncate_bytes(text, limit: int) -> Column:
    """The first ``limit`` bytes of UTF-8 text, without a torn last character."""
    text = F.col(text) if isinstance(text, str) else text
    cut = F.make_valid_utf8(F.substring(text.cast("binary"), 1, limit).cast("string"))
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.rtrim(cut, F.lit("�")))


def to_json(message="message", names: list[str] | None = None) -> Column:
    """Canonical record: fixed key order, metadata only when there is some."""
    message = F.col(message) if isinstance(message, str) else message
    return F.to_json(
        F.struct(
            F.col("node_id"),
            clocks.to_map("vc", names).alias("vector_clock"),
            F.col("ts_ms").alias("timestamp"),
            F.col("level"),
            message.alias("message"),
            F.when(F.size("metadata") > 0, F.col("metadata")).alias("metadata"),
        )
    )


def add_metadata(metadata, key, value, limit: int | None = None) -> Column:
    """Add one pair. An existing key keeps its first value; a NULL key or value
    adds nothing; with ``limit`` (the record format allows 8) a full map stays."""
    metadata = F.col(metadata) if isinstance(metadata, str) else metadata
    key = F.lit(key) if isinstance(key, str) else key
    value = F.lit(value) if isinstance(value, str) else value
    present = F.coalesce(metadata, F.expr("cast(map() as map<string,string>)"))
    keep = key.isNull() | value.isNull() | F.map_contains_key(present, F.coalesce(key, F.lit("")))
    if limit is not None:
        keep = keep | (F.size(present) >= limit)
    return F.when(keep, metadata).otherwise(F.map_concat(present, F.create_map(key, value)))


def get_metadata(metadata, key) -> Column:
    """First value under ``key``, NULL when absent."""
    key = F.lit(key) if isinstance(key, str) else key
    return F.try_element_at(metadata, key)


def first_metadata(metadata, limit: int | None = None) -> Column:
    """Distinct keys in order, first value of each; at most ``limit`` pairs, if given."""
    metadata = F.col(metadata) if isinstance(metadata, str) else metadata
    keys = F.array_distinct(F.map_keys(metadata))
    fits = F.size(keys) == F.size(metadata)
    if limit is not None:
        keys = F.slice(keys, 1, limit)
        fits = fits & (F.size(metadata) <= limit)
    firsts = F.map_from_arrays(keys, F.transform(keys, lambda k: F.try_element_at(metadata, k)))
    return F.when(fits | metadata.isNull(), metadata).otherwise(firsts)
