"""Whether stored clocks can be trusted: gaps, copies, broken ticking."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clocks
from ..plans.frontier import components, knowledge
from ..plans.scan import CHUNK_ROWS, chunk_of, with_previous
from ..session import written


def _own(log: DataFrame) -> DataFrame:
    tick = F.coalesce(clocks.own_tick(), F.lit(0).cast("bigint"))
    return log.withColumn("tick", tick)


def clock_audit(
    log: DataFrame, node_count: int, seq: str = "seq", tie_break: str = "event_id", rows: int = CHUNK_ROWS
) -> DataFrame:
    """One row per node, and one for the entries of unlisted nodes (NULL): what is wrong.

    ``entries``; ``max_tick``; ``missing_ticks`` (numbers up to ``max_tick`` that
    are not stored); ``duplicate_ticks`` (entries beyond the first of a tick);
    ``not_rising`` (entries whose tick does not exceed that of the entry before
    in ``seq``); ``above_owner`` (entries that know more of a node than that node
    ever wrote); ``bad_size`` (clock missing, too long, or not of
    ``node_count``); ``knowledge_falls`` (entries that know less of another node than the
    stored tick before); ``knowledge_incomplete`` (entries that have just heard of a
    node up to some tick, without what its last stored entry up to there knew). Several
    clocks of one tick are merged for the last two. Nothing but zeros in the last seven: what
    is stored is what nodes write that tick their own component and pass on all they know.

    The log is read twice: folded to its distinct clocks, and in the order of ``seq``.
    """
    names = components(node_count)
    owned = _own(log)
    kinds = written(owned.groupBy("node_idx", "tick", "vc").agg(F.count(F.lit(1)).alias("copies")), "clocks")
    merged = [F.max(clocks.component("vc", j)).alias(c) for j, c in enumerate(names)]
    per_tick = written(kinds.groupBy(F.col("node_idx").cast("int").alias("node_idx"), "tick").agg(F.sum("copies").alias("copies"), *merged), "ticks")
    real = F.col("tick") > 0
    ticked = per_tick.groupBy("node_idx").agg(
        F.sum("copies").alias("entries"),
        F.max("tick").alias("max_tick"),
        (F.max("tick") - F.count_if(real)).alias("missing_ticks"),
        F.sum(F.when(real, F.col("copies") - 1).otherwise(0)).alias("duplicate_ticks"),
    )

    in_turn = with_previous(owned.select("node_idx", seq, tie_break, "tick"), ["node_idx"], [seq, tie_break], ["tick"], rows)
    rising = in_turn.groupBy("node_idx").agg(F.count_if(F.col("tick") <= F.col("prev_tick")).alias("not_rising"))

    own_max = [F.coalesce(F.max(F.when(F.col("node_idx") == j, F.col("tick"))), F.lit(0)).alias(f"m{j}") for j in range(node_count)]
    tops = per_tick.agg(F.struct(*own_max).alias("tops")).scalar()
    above = reduce(
        lambda x, y: x | y, [clocks.component("vc", j) > F.col("_tops")[f"m{j}"] for j in range(node_count)]
    )
    sized = clocks.is_valid("vc") & (F.size("vc") == node_count)
    counted = lambda flag: F.sum(F.when(flag, F.col("copies")).otherwise(0))
    known = kinds.withColumn("_tops", tops).groupBy("node_idx").agg(
        counted(above).alias("above_owner"), counted(~sized).alias("bad_size")
    )
    told = knowledge(per_tick.where(real & F.col("node_idx").isNotNull()), node_count, rows).groupBy("node_idx").agg(
        counted(F.col("falls")).alias("knowledge_falls"), counted(F.col("incomplete")).alias("knowledge_incomplete")
    )
    whole = _beside(_beside(ticked, rising), known).join(told, "node_idx", "left")
    return whole.fillna(0, ["knowledge_falls", "knowledge_incomplete"])


def _beside(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join per-node rows, the one of unlisted nodes (NULL) as well."""
    named = b.withColumnRenamed("node_idx", "_node")
    return a.join(named, F.col("node_idx").eqNullSafe(F.col("_node"))).drop("_node")


def missing_ticks(log: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """``(node_idx, first_missing, last_missing)``: every stretch of lost entries."""
    ticks = _own(log).where(F.col("tick") > 0).groupBy("node_idx", "tick").agg(F.count(F.lit(1)).alias("copies"))
    ticks = ticks.withColumn("_chunk", chunk_of("tick", rows))
    tops = ticks.groupBy("node_idx", "_chunk").agg(F.max("tick").alias("_top"))
    by_chunk = Window.partitionBy("node_idx").orderBy("_chunk")
    carry = tops.select("node_idx", "_chunk", F.lag("_top").over(by_chunk).alias("_carry"))
    inside = ticks.withColumn("_in", F.lag("tick").over(Window.partitionBy("node_idx", "_chunk").orderBy("tick")))
    last = F.coalesce("_in", "_carry", F.lit(0).cast("bigint"))
    return (
        inside.join(carry, ["node_idx", "_chunk"])
        .where(F.col("tick") - last > 1)
        .select("node_idx", (last + 1).alias("first_missing"), (F.col("tick") - 1).alias("last_missing"))
    )
