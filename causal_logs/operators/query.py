"""Filtered reads of the log, and metadata."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import entries, levels
from ..plans.frontier import components
from ..schema import LEVELS
from .order import causal_first, causal_order


def log_query(
    log: DataFrame,
    min_level: str | None = None,
    nodes: list[str] | None = None,
    since_ms: int | None = None,
    until_ms: int | None = None,
    dates: tuple[str, str] | None = None,
    metadata: dict[str, str] | None = None,
    order: str | None = None,
    node_count: int | None = None,
    limit: int | None = None,
    tie_break: str = "event_id",
) -> DataFrame:
    """Entries at ``min_level`` or above, of ``nodes``, in ``[since_ms, until_ms)``,
    in the days ``dates`` (both included), with the given metadata.

    ``order`` is ``"time"`` or ``"causal"`` (adds ``pos``, the place in the whole
    log). With ``limit`` only the first entries in that order are kept, by a
    partial sort in every task; the causal order then ranks only entries that can come before them (``order.causal_first``). Conditions on level, node, time and day are plain column
    predicates, so they reach the scan; ``dates`` prunes the folders of a stored log. Metadata
    is looked up in the rows that pass.
    """
    wanted = F.lit(True)
    if dates is not None:
        wanted &= F.col("log_date").between(F.lit(dates[0]).cast("date"), F.lit(dates[1]).cast("date"))
    if min_level is not None:
        wanted &= F.col("level").isin(*LEVELS[LEVELS.index(min_level.upper()):])
    if nodes is not None:
        wanted &= F.col("node_id").isin(*nodes)
    if since_ms is not None:
        wanted &= F.col("ts_ms") >= since_ms
    if until_ms is not None:
        wanted &= F.col("ts_ms") < until_ms
    for key, value in (metadata or {}).items():
        wanted &= entries.get_metadata("metadata", key) == value
    if order == "causal" and limit is not None:
        return causal_first(log, node_count, limit, wanted, tie_break)
    found = (causal_order(log, node_count, tie_break) if order == "causal" else log).where(wanted)
    if order is not None:
        keys = ["pos"] if order == "causal" else ["ts_ms", "node_id", tie_break]
        found = found.orderBy(*keys)
    return found if limit is None else found.limit(limit)


def with_level_rank(log: DataFrame) -> DataFrame:
    return log.withColumn("level_rank", levels.rank("level"))


def add_metadata(log: DataFrame, key: str, value, limit: int | None = None) -> DataFrame:
    return log.withColumn("metadata", entries.add_metadata("metadata", key, value, limit))


def metadata_lookup(log: DataFrame, keys: list[str]) -> DataFrame:
    """Add one column ``meta_<key>`` per key, NULL where absent."""
    return log.select("*", *[entries.get_metadata("metadata", k).alias(f"meta_{k}") for k in keys])


def metadata_pairs(log: DataFrame, event_id: str = "event_id") -> DataFrame:
    """``(event, key, value)``, one row per pair."""
    return log.select(event_id, F.explode("metadata").alias("key", "value"))


def metadata_groups(log: DataFrame, key: str, node_count: int) -> DataFrame:
    """Per value of one metadata key: entries, time span, merged clock."""
    names = components(node_count)
    flat = log.select(
        entries.get_metadata("metadata", key).alias("value"), "ts_ms",
        *[F.get("vc", F.lit(i)).alias(c) for i, c in enumerate(names)],
    )
    grouped = flat.where(F.col("value").isNotNull()).groupBy("value").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ts_ms").alias("first_ms"),
        F.max("ts_ms").alias("last_ms"),
        *[F.max(c).alias(c) for c in names],
    )
    merged = F.filter(F.array(*names), lambda x: x.isNotNull())
    return grouped.select("value", "n", "first_ms", "last_ms", merged.alias("merged"))
