"""Continuous intake: landing files to stamped log rows.

Queries with their own checkpoints, all append to file sinks and so take
every line exactly once:

* ``start_landing`` reads closed text files, parses the lines and stores them.
  It keeps no state.
* ``start_rejects``, where wanted, stores the lines that cannot be entries.
* ``start_ticking`` follows that table and numbers the entries of each node. It
  only looks at how many entries each block of a file holds: the counts are made
  inside the tasks, and the state function, which hands out the first tick of
  each block and remembers the next one per node, sees one row per block. A node
  that writes most of the log is therefore no bottleneck.

``read_stamped`` puts both together: first number of the block plus place within.
One task reads a block and writes its entries in order, so the place is the row
index in the stored Parquet file.

``start_intake`` does all of it in one query, and appends the stamped records to the daily store. A batch
parses its files, numbers its blocks from the counters that the batch before left, and writes its records to
``log_date=YYYY-MM-DD/batch=<n>``. Nothing but one counter per node outlives a batch. The files of a batch are fixed
by the query's checkpoint, and a batch that is run again, after a failure, replaces what it wrote; so the
store holds every line once, and reading it needs no join.
"""

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.ingest import checked_nodes, fresh_clock, ingest_stats, parse_lines
from ..plans.folders import numbered, remove
from ..sources import jsonl, store

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_BLOCK = ["node_id", "file", "block"]
_PARSED = (
    "node_id string, file string, block bigint, "
    "level string, ts_ms bigint, message string, log_date date"
)
_COUNTS = "node_id string, file string, block bigint, n bigint"
_FIRSTS = "node_id string, file string, block bigint, first_seq bigint, n bigint"


def read_landing(
    spark: SparkSession, path: str, since_ms: int | None = None, max_files: int | None = None
) -> DataFrame:
    """Stream of raw lines from ``path/<node id>/<file>`` (or ``node_id=<node id>/``).

    Files must be complete when they appear (write elsewhere, then rename), and
    names must sort in writing order. Files last written before ``since_ms`` are left
    out. It is part of the query: a restart has to name the same time, and then
    also takes what landed while nothing ran.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    written = F.col("_metadata.file_modification_time")
    raw = reader.load(path).select(
        F.regexp_extract("_metadata.file_path", r"(?:node_id=)?([^/]+)/[^/]+$", 1).alias("node_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.unix_millis(written).alias("ingest_ts"),
        F.to_date(written).alias("log_date"),
        F.col("value").alias("line"),
    )
    if since_ms is not None:
        raw = raw.where(F.col("ingest_ts") >= since_ms)
    return raw


def parse_stream(raw: DataFrame, grammar: str = "documented") -> DataFrame:
    """Typed entries of a stream of raw lines; a line without a time gets the
    time its file was written, so a repeated batch gives the same rows."""
    parsed = parse_lines(raw, F.col("ingest_ts"), grammar, F.col("ts_ms").isNotNull())
    return parsed.select("node_id", "file", "block", "level", "ts_ms", "message", "log_date")


def start_landing(
    raw: DataFrame, path: str, grammar: str = "documented", trigger: dict | None = None
) -> StreamingQuery:
    """Store parsed entries under ``path/parsed``."""
    return (
        parse_stream(raw, grammar).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{path}/_checkpoints/parsed")
        .trigger(**(trigger or {"availableNow": True}))
        .start(f"{path}/parsed")
    )


def start_rejects(
    raw: DataFrame, path: str, grammar: str = "documented", trigger: dict | None = None
) -> StreamingQuery:
    """Store the lines with an impossible date, as received, under ``path/rejects``."""
    rejected = parse_lines(raw, F.col("ingest_ts"), grammar, F.col("ts_ms").isNull())
    return (
        rejected.select("node_id", "file", "block", "line", "log_date", F.lit("bad_timestamp").alias("reason"))
        .writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{path}/_checkpoints/rejects")
        .trigger(**(trigger or {"availableNow": True}))
        .start(f"{path}/rejects")
    )


def _count_blocks(batches):
    for batch in batches:
        yield batch.groupby(_BLOCK, as_index=False, sort=False).size().rename(columns={"size": "n"})


def _hand_out_ticks(key, batches, state: GroupState):
    """First sequence number of each block of one node, in file and block order."""
    blocks = pd.concat(list(batches)).groupby(_BLOCK, as_index=False)["n"].sum()
    blocks = blocks.sort_values(["file", "block"], ignore_index=True)
    following = state.get[0] if state.exists else 0
    state.update((following + int(blocks["n"].sum()),))
    blocks["first_seq"] = following + blocks["n"].cumsum() - blocks["n"]
    yield blocks[[*_BLOCK, "first_seq", "n"]]


def start_ticking(spark: SparkSession, path: str, trigger: dict | None = None) -> StreamingQuery:
    """Number the blocks of ``path/parsed``, continuing each node's count, and
    store their first numbers under ``path/firsts``."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    parsed = spark.readStream.schema(_PARSED).parquet(f"{path}/parsed").select(*_BLOCK)
    firsts = (
        parsed.mapInPandas(_count_blocks, _COUNTS)
        .groupBy("node_id")
        .applyInPandasWithState(_hand_out_ticks, _FIRSTS, "following bigint", "append", GroupStateTimeout.NoTimeout)
    )
    return (
        firsts.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{path}/_checkpoints/firsts")
        .trigger(**(trigger or {"availableNow": True}))
        .start(f"{path}/firsts")
    )


def read_stamped(spark: SparkSession, path: str, nodes: DataFrame, node_count: int) -> DataFrame:
    """Typed rows with ``node_idx``, ``seq`` and ``vc`` of everything numbered so far."""
    parsed = spark.read.schema(_PARSED).parquet(f"{path}/parsed")
    firsts = spark.read.schema(_FIRSTS).parquet(f"{path}/firsts").select(*_BLOCK, "first_seq")
    placed = parsed.select("*", F.col("_metadata.file_name").alias("_part"), F.col("_metadata.row_index").alias("_row"))
    inside = Window.partitionBy(*_BLOCK).orderBy("_part", "_row")
    stamped = (
        placed.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(firsts, _BLOCK)
        .withColumn("seq", F.col("first_seq") + F.col("_inside"))
        .join(checked_nodes(nodes), "node_id", "left")
    )
    return stamped.withColumn("vc", fresh_clock(node_count, F.col("node_idx"), F.col("seq") + 1)).drop(
        "block", "first_seq", "_part", "_row", "_inside"
    )


def ingest_available(
    spark: SparkSession, landing: str, path: str, grammar: str = "documented", max_files: int | None = None
) -> None:
    """Take in everything that has landed so far, then stop."""
    raw = read_landing(spark, landing, max_files=max_files)
    start_landing(raw, path, grammar).awaitTermination()
    start_rejects(raw, path, grammar).awaitTermination()
    start_ticking(spark, path).awaitTermination()


def _numbered_blocks(rows: DataFrame, counters: DataFrame) -> DataFrame:
    """Blocks of a batch with their first sequence number and the mark of their first row."""
    blocks = rows.groupBy(*_BLOCK).agg(F.count(F.lit(1)).alias("n"), F.min("mark").alias("first_mark"))
    # One row per block of a file, whatever the block holds.
    before = Window.partitionBy("node_id").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(before), F.lit(0))
    known = F.broadcast(counters.select("node_id", "following"))
    return blocks.withColumn("_inside", inside).join(known, "node_id", "left").select(
        *_BLOCK, "n", "first_mark", (F.col("_inside") + F.coalesce("following", F.lit(0))).alias("first_seq")
    )


def start_intake(
    raw: DataFrame,
    path: str,
    store_path: str,
    nodes: DataFrame,
    node_count: int,
    grammar: str = "documented",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Landing lines (``read_landing``) to stamped records in the daily store at ``store_path``.

    ``path`` keeps the checkpoint, the counters and, under ``rejects``, the lines with an impossible date. ``nodes`` and
    ``node_count`` fix the clocks; nodes not listed get zero clocks, as in ``stamp_clocks``. The store is read with
    ``store.read_store``; no other query writes to it.
    """
    listed = checked_nodes(nodes)

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now, work = F.col("ingest_ts"), f"{path}/work/batch={number}"
        bad = parse_lines(batch, now, grammar, F.col("ts_ms").isNull())
        bad.select("node_id", "file", "block", "line", "log_date", F.lit("bad_timestamp").alias("reason")).write.mode("overwrite").parquet(
            f"{path}/rejects/batch={number}"
        )
        # A task reads a block in order, so rows of a block have rising marks without gaps.
        parsed = parse_lines(batch, now, grammar, F.col("ts_ms").isNotNull()).withColumn("mark", F.monotonically_increasing_id())
        parsed.select(*_BLOCK, "level", "ts_ms", "message", "log_date", "mark").write.mode("overwrite").parquet(f"{work}/rows")
        rows = spark.read.schema(f"{_PARSED}, mark bigint").parquet(f"{work}/rows")

        earlier = [n for n in numbered(spark, f"{path}/counters", "batch") if n < number]
        counters = spark.createDataFrame([], "node_id string, following bigint")
        if earlier:
            counters = spark.read.schema("node_id string, following bigint").parquet(f"{path}/counters/batch={max(earlier)}")
        _numbered_blocks(rows, counters).write.mode("overwrite").parquet(f"{work}/blocks")
        blocks = spark.read.parquet(f"{work}/blocks")
        counted = blocks.groupBy("node_id").agg(F.sum("n").alias("following")).unionByName(counters)
        # At most a row per node.
        counted.groupBy("node_id").agg(F.sum("following").alias("following")).coalesce(1).write.mode("overwrite").parquet(f"{path}/counters/batch={number}")

        seq = F.col("first_seq") + F.col("mark") - F.col("first_mark")
        stamped = rows.join(blocks.drop("n"), _BLOCK).withColumn("seq", seq).join(listed, "node_id", "left")
        stamped = stamped.withColumn("vc", fresh_clock(node_count, F.col("node_idx"), F.col("seq") + 1))
        records = store.export_jsonl(stamped.withColumn("metadata", F.lit(None).cast("map<string,string>")))
        (
            records.select("log_date", F.lit(number).alias("batch"), F.col("line").alias("value"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("log_date", "batch").text(store_path)
        )
        # Only this batch can be run again, and that needs the counters before it.
        remove(spark, [work, *[f"{path}/counters/batch={n}" for n in earlier if n < max(earlier)]])

    return (
        raw.writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{path}/_checkpoints/intake")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_records(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of JSON-Lines records as text, with their day of arrival."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    arrived = F.to_date(F.col("_metadata.file_modification_time"))
    return reader.load(path).select(F.col("value").alias("line"), arrived.alias("log_date"))


def start_store(log: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream of typed rows to the store, one folder per day."""
    out = store.with_log_date(store.export_jsonl(log)).select("log_date", F.col("line").alias("value"))
    return (
        out.writeStream.format("text").outputMode("append").partitionBy("log_date")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def stream_stats(records: DataFrame, keys: list[str]) -> DataFrame:
    """Running intake counters per ``keys``; write with ``outputMode("update")``."""
    return ingest_stats(jsonl.decode(records), keys)


def observed(decoded: DataFrame, name: str = "intake") -> DataFrame:
    """The stream itself, reporting its counters with every batch (``observedMetrics``)."""
    bad = F.col("reason").isNotNull()
    return decoded.observe(
        name,
        F.count(F.lit(1)).alias("received"),
        F.count_if(~bad).alias("stored"),
        F.count_if(bad).alias("errors"),
        F.coalesce(F.sum(F.octet_length("line").cast("bigint")), F.lit(0)).alias("bytes"),
    )
