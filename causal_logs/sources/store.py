"""The log store: JSON-Lines text in one folder per arrival day."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks, entries
from ..schema import LOG_SCHEMA
from . import jsonl


def export_jsonl(
    log: DataFrame,
    ascii_only: bool = False,
    max_record_bytes: int | None = None,
    names: list[str] | None = None,
) -> DataFrame:
    """Add ``line``, the canonical record, and the display texts ``vc_text``, ``ts_text``.

    ``ascii_only`` drops other bytes from messages. With ``max_record_bytes``
    (older stores allow 4095) longer records are left to ``export_jsonl_rejects``.
    """
    out = _exported(log, ascii_only, names)
    return out if max_record_bytes is None else out.where(F.octet_length("line") <= max_record_bytes)


def export_jsonl_rejects(
    log: DataFrame, max_record_bytes: int, ascii_only: bool = False, names: list[str] | None = None
) -> DataFrame:
    """The rows whose record is longer than ``max_record_bytes``, with ``line`` and ``reason``."""
    out = _exported(log, ascii_only, names).where(F.octet_length("line") > max_record_bytes)
    return out.withColumn("reason", F.lit("too_long"))


def _exported(log: DataFrame, ascii_only: bool, names: list[str] | None) -> DataFrame:
    message = entries.ascii_only(F.col("message")) if ascii_only else F.col("message")
    return (
        log.withColumn("line", entries.to_json(message, names))
        .withColumn("vc_text", clocks.to_text("vc"))
        .withColumn("ts_text", entries.time_text("ts_ms"))
    )


def write_jsonl(log: DataFrame, path: str, files_per_day: int | None = None) -> None:
    """Append to the store, one folder ``log_date=YYYY-MM-DD`` per arrival day.

    ``log_date`` defaults to the day of the write. Without ``files_per_day``
    every task appends its own files and nothing is shuffled; with it, each day
    is spread over that many files, whatever its share of the rows.
    """
    lines = with_log_date(export_jsonl(log)).select("log_date", F.col("line").alias("value"))
    if files_per_day is not None:
        spread = F.pmod(F.xxhash64("value"), F.lit(files_per_day))
        lines = lines.repartition("log_date", spread)
    lines.write.mode("append").partitionBy("log_date").text(path)


def with_log_date(log: DataFrame) -> DataFrame:
    return log if "log_date" in log.columns else log.withColumn("log_date", F.current_date())


def read_store(spark: SparkSession, path: str, **options) -> DataFrame:
    """Typed rows of a store; a filter on ``log_date`` reads only those folders."""
    return jsonl.ingest_jsonl(jsonl.read_jsonl(spark, path), **options)


def conform(log: DataFrame) -> DataFrame:
    """The columns of the typed log with their types and in their order, NULL
    where absent; further columns follow."""
    typed = [
        (F.col(f.name) if f.name in log.columns else F.lit(None)).cast(f.dataType.simpleString()).alias(f.name)
        for f in LOG_SCHEMA
    ]
    return log.select(*typed, *[c for c in log.columns if c not in LOG_SCHEMA.names])


def write_table(log: DataFrame, path: str) -> None:
    """The typed log as Parquet in daily folders, for repeated queries."""
    conform(with_log_date(log)).write.mode("append").partitionBy("log_date").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The typed log; a filter on ``log_date`` reads only those folders."""
    return spark.read.parquet(path)
