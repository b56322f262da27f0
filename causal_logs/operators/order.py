"""Causal order, time order, and the audit of an order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clocks
from ..plans import dominance, frontier
from ..plans.scan import CHUNK_ROWS, rank_rows
from ..session import written


_KEYS = ["eff_ts", "vc_sum", "ts_ms", "node_id", "seq"]


def _ordered_columns(log: DataFrame) -> DataFrame:
    return log.withColumn("tick", clocks.own_tick()).withColumn("node_idx", F.col("node_idx").cast("int"))


def _moments(log: DataFrame, node_count: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """The tick table, and ``(node_idx, tick, _eff)``: the latest wall time in each tick's past or its own."""
    ticks = frontier.tick_table(log, node_count, {"ts_ms": F.max("ts_ms")}, rows)
    past = frontier.past_max(ticks, "ts_ms", "_past_ts", rows)
    # Copies of one entry count as one moment.
    return ticks, past.select("node_idx", "tick", F.greatest("_past_ts", "ts_ms").alias("_eff"))


def effective_time(log: DataFrame, node_count: int, rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``eff_ts``, the latest wall time in the causal past or the row's own,
    and ``vc_sum``, the sum of the clock."""
    return _timed(log, *_moments(log, node_count, rows))


def _timed(log: DataFrame, ticks: DataFrame, moment: DataFrame) -> DataFrame:
    timed = frontier.attach(_ordered_columns(log), ticks, moment)
    return (
        timed.withColumn("eff_ts", F.greatest("ts_ms", "_eff"))
        .withColumn("vc_sum", F.coalesce(clocks.total("vc"), F.lit(0).cast("bigint")))
        .drop("_eff", "tick")
    )


def causal_order(
    log: DataFrame,
    node_count: int,
    tie_break: str = "event_id",
    well_formed: bool = True,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``pos`` 1..N, a total order that never contradicts causality.

    Comparing two entries by clock and, when concurrent, by wall time is not
    transitive, so no sort can use it. This order is a linear extension of
    happens-before instead: by ``(eff_ts, vc_sum, ts_ms, node_id, seq)``, where
    ``eff_ts`` never decreases along happens-before and ``vc_sum`` always grows.
    Where wall clocks agree with causality it is time order. Entries with equal
    clocks come in time order, then by node.

    All columns of ``log`` travel through the sort; pass those you need.

    ``eff_ts`` rests on well-formed clocks (``MalformedClocks`` is raised otherwise); with
    ``well_formed=False`` the order is by ``vc_sum`` first and needs no premise.
    """
    if well_formed:
        keyed = effective_time(log, node_count, rows)
        keys = [*_KEYS, tie_break]
    else:
        keyed = log.withColumn("vc_sum", F.coalesce(clocks.total("vc"), F.lit(0).cast("bigint")))
        keys = ["vc_sum", "ts_ms", "node_id", "seq", tie_break]
    return rank_rows(keyed, keys)


def causal_first(
    log: DataFrame, node_count: int, limit: int, wanted: Column, tie_break: str = "event_id", rows: int = CHUNK_ROWS
) -> DataFrame:
    """The first ``limit`` rows with ``wanted`` in causal order, with the ``pos`` that ``causal_order`` gives them.

    The whole log is not sorted. The latest past of every tick comes from the narrow tick table; a partial sort of the wanted
    rows finds the first ones and with them a bound on ``eff_ts``. As no row's ``eff_ts`` lies before its own time, rows
    later than the bound come after all of them, and only the others are ranked.
    """
    ticks, moment = _moments(log, node_count, rows)
    moment = written(moment, "moments")
    keys = [*_KEYS, tie_break]
    first = _timed(log.where(wanted), ticks, moment).select(*keys).orderBy(*keys).limit(limit)
    # Rows without any time come first, so the bound is theirs if there are no others.
    bound = first.agg(F.max("eff_ts")).first()[0]
    possible = lambda c: F.col(c).isNull() | (F.col(c) <= bound) if bound is not None else F.col(c).isNull()
    keyed = _timed(log.where(possible("ts_ms")).withColumn("_wanted", wanted), ticks, moment).where(possible("eff_ts"))
    return rank_rows(keyed, keys).where("_wanted").drop("_wanted").orderBy("pos").limit(limit)


def time_order(log: DataFrame, tie_break: str = "event_id") -> DataFrame:
    """Add ``pos`` 1..N by wall time, then node id (byte order)."""
    return rank_rows(log, ["ts_ms", "node_id", tie_break])


def order_audit(
    ordered: DataFrame, node_count: int, pos: str = "pos", rows: int = CHUNK_ROWS, well_formed: bool = True
) -> DataFrame:
    """Rows that ``pos`` places before something in their causal past.

    ``latest_past_pos`` is the last position among the row's past. No rows
    means the order is causal. Clocks that are not well formed raise ``MalformedClocks``; with
    ``well_formed=False`` the past is told by whole clocks, whatever they hold.
    """
    if not well_formed:
        found = dominance.of_clocks(ordered, node_count, pos).withColumnRenamed("best", "latest_past_pos")
        return found.where(F.col("latest_past_pos") > F.col(pos)).select(*ordered.columns, "latest_past_pos")
    ticks = frontier.tick_table(ordered, node_count, {"_pos": F.max(pos)}, rows)
    past = frontier.past_max(ticks, "_pos", "latest_past_pos", rows).drop("_pos")
    checked = frontier.attach(_ordered_columns(ordered), ticks, past)
    return checked.where(F.col("latest_past_pos") > F.col(pos)).drop("tick")
