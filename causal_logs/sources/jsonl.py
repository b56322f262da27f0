"""JSON-Lines records to typed rows, with a quarantine."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks, entries, levels
from ..plans.barrier import settled
from ..schema import WIRE_SCHEMA

_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Stored text records with the day of their partition folder, if there is one."""
    return spark.read.text(path).withColumnRenamed("value", "line")


_FIELDS = ["node_id", "vc", "ts_ms", "level", "message", "metadata", "reason"]


def decode(
    lines: DataFrame,
    node_names: list[str] | None = None,
    node_count: int | None = None,
    max_metadata: int | None = None,
    line: str = "line",
    where: Column | None = None,
) -> DataFrame:
    """Decode every record; bad ones get a ``reason`` instead of an error.

    Adds ``node_id, vc, ts_ms, level, message, metadata, reason``. Unknown fields
    are ignored; a missing or unknown level is INFO. Reasons: ``malformed``,
    ``missing_node_id``, ``bad_timestamp``, ``bad_clock``, ``bad_clock_key``,
    ``clock_too_wide``. Serves tables and streams; ``where`` may use the fields.
    """
    parsed = lines.withColumn("_r", F.from_json(line, WIRE_SCHEMA, _OPTIONS))
    staged = parsed.withColumn("_clock", F.col("_r.vector_clock"))
    staged = clocks.with_decoded(staged, "_clock", node_names, node_count, "vc", "_clock_error")
    stamp = F.col("_r.timestamp")
    broken = F.col("_r").isNull() | F.col("_r._corrupt_record").isNotNull() | ~F.ltrim(line, F.lit(" \t\r\n")).startswith("{")
    reason = (
        F.when(broken, "malformed")
        .when(F.col("_r.node_id").isNull(), "missing_node_id")
        .when(F.col("ts_ms").isNull(), "bad_timestamp")
        .otherwise(F.col("_clock_error"))
    )
    fields = (
        staged.withColumn("ts_ms", F.when(stamp.rlike(r"^\d+$"), stamp.try_cast("bigint")))
        .withColumn("reason", reason)
        .withColumn("node_id", F.col("_r.node_id"))
        .withColumn("level", levels.normalize(F.col("_r.level")))
        .withColumn("message", F.coalesce(F.col("_r.message"), F.lit("")))
        .withColumn("metadata", entries.first_metadata(F.col("_r.metadata"), max_metadata))
    )
    return settled(fields, _FIELDS, ["_r", "_clock", "_clock_error"], where)


def ingest_jsonl(lines: DataFrame, line: str = "line", **options) -> DataFrame:
    """The good records as typed rows."""
    return decode(lines, line=line, where=F.col("reason").isNull(), **options).drop("reason", line)


def ingest_jsonl_rejects(lines: DataFrame, **options) -> DataFrame:
    """The other records, as received, with ``reason``."""
    return decode(lines, where=F.col("reason").isNotNull(), **options).select(*lines.columns, "reason")
