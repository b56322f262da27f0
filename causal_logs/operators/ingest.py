"""Raw lines to stamped, typed log rows, and intake counters."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import entries, lines
from ..plans.barrier import settled
from ..plans.scan import CHUNK_ROWS, chunk_of, number_rows
from ..schema import MAX_NODES


_PARTS = ["level", "ts_ms", "message"]


def parse_lines(raw: DataFrame, now: Column, grammar: str = "documented", where: Column | None = None) -> DataFrame:
    """Lines that are not empty, with ``level``, ``ts_ms`` (NULL for an impossible
    date) and ``message``; serves tables and streams."""
    return settled(lines.with_parsed(raw.where(~lines.is_blank("line")), now, "line", grammar), _PARTS, where=where)


def _now(ingest_ts: str | None) -> Column:
    return F.col(ingest_ts) if ingest_ts else F.unix_millis(F.current_timestamp())


def ingest_raw_lines(
    raw: DataFrame,
    grammar: str = "documented",
    ingest_ts: str | None = None,
    max_message_bytes: int | None = None,
) -> DataFrame:
    """Parse ``line`` into ``level``, ``ts_ms`` and ``message``; other columns stay.

    Empty lines are dropped. Lines without a time get the column ``ingest_ts``
    (ms), or the time of the query. Lines with an impossible date are left to
    ``ingest_raw_lines_rejects``. Projections only, no shuffle.
    """
    parsed = parse_lines(raw, _now(ingest_ts), grammar, F.col("ts_ms").isNotNull()).drop("line")
    if max_message_bytes is None:
        return parsed
    return parsed.withColumn("message", entries.truncate_bytes("message", max_message_bytes))


def ingest_raw_lines_rejects(
    raw: DataFrame, grammar: str = "documented", ingest_ts: str | None = None
) -> DataFrame:
    """The lines whose date cannot exist, with ``reason``."""
    rejected = parse_lines(raw, _now(ingest_ts), grammar, F.col("ts_ms").isNull())
    return rejected.drop(*_PARTS).withColumn("reason", F.lit("bad_timestamp"))


def node_dimension(rows: DataFrame) -> DataFrame:
    """``(node_id, node_idx)``: the distinct node ids, numbered in byte order.

    At most 32 rows, whatever the table holds; more nodes are an error.
    """
    ids = rows.where(F.col("node_id").isNotNull()).groupBy("node_id").agg(F.count(F.lit(1)).alias("n"))
    found = [r["node_id"] for r in ids.select("node_id").limit(MAX_NODES + 1).collect()]
    if len(found) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes")
    pairs = [(node, i) for i, node in enumerate(sorted(found, key=lambda s: s.encode()))]
    return rows.sparkSession.createDataFrame(pairs, "node_id string, node_idx int")


def checked_nodes(nodes: DataFrame) -> DataFrame:
    """``nodes`` for a broadcast, after making sure there are at most 32."""
    if nodes.limit(MAX_NODES + 1).count() > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes")
    return F.broadcast(nodes.select("node_id", "node_idx"))


def stamp_clocks(
    parsed: DataFrame, nodes: DataFrame, node_count: int, rows: int = CHUNK_ROWS
) -> DataFrame:
    """Number the entries of each node and write the tick into its clock.

    Adds ``node_idx``, ``seq`` (0-based by file and line) and ``vc``, zero but
    for the own component. Entries of a node that ``nodes`` does not list keep a
    NULL ``node_idx`` and a zero clock. Numbering goes by stretches of lines
    within a file, so one node may hold most of the rows.
    """
    named = parsed.withColumn("node_id", F.coalesce("node_id", F.lit("")))
    placed = named.join(checked_nodes(nodes), "node_id", "left")
    numbered = number_rows(
        placed.withColumn("_block", chunk_of("line_no", rows)),
        ["node_id"], ["file", "_block"], ["line_no"], "seq",
    ).drop("_block")
    return numbered.withColumn("vc", fresh_clock(node_count, F.col("node_idx"), F.col("seq") + 1))


def place_rows(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows that carry clocks, such as decoded records, with ``node_idx``, ``seq`` (own tick - 1) and ``reason``.

    ``reason`` is NULL for rows that can be ordered; ``unlisted_node`` where ``nodes`` lacks the
    node, ``no_own_tick`` where the clock has no tick of it.
    """
    placed = rows.drop("node_idx", "seq").join(checked_nodes(nodes), "node_id", "left")
    tick = F.coalesce(F.expr("get(vc, node_idx)"), F.lit(0).cast("bigint"))
    reason = F.when(F.col("node_idx").isNull(), "unlisted_node").when(tick <= 0, "no_own_tick")
    return placed.withColumn("seq", F.when(tick > 0, tick - 1)).withColumn("reason", reason)


def typed_log(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows that can be ordered; no shuffle."""
    return place_rows(rows, nodes).where("reason IS NULL").drop("reason")


def typed_log_rejects(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The others, with ``reason``."""
    return place_rows(rows, nodes).where("reason IS NOT NULL")


def fresh_clock(node_count: int, node_idx: Column, tick: Column) -> Column:
    """A clock that knows only its own node."""
    zero = F.lit(0).cast("bigint")
    return F.array(*[F.when(node_idx == i, tick).otherwise(zero) for i in range(node_count)])


def ingest_stats(decoded: DataFrame, keys: list[str], error: str = "reason", line: str = "line") -> DataFrame:
    """Per ``keys``: records received, stored and rejected, and bytes received.

    The same aggregation serves a stream in update mode.
    """
    bad = F.col(error).isNotNull()
    return decoded.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(~bad).alias("stored"),
        F.count_if(bad).alias("errors"),
        F.sum(F.octet_length(line).cast("bigint")).alias("bytes"),
    )
