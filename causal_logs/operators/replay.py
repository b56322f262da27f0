"""Vector clocks for events that only say who sent what to whom."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.frontier import components
from ..plans.scan import CHUNK_ROWS, chunk_of, number_rows
from ..plans.skew import HEAVY_ROWS, lookup
from ..session import written

MAX_ROUNDS = 64


def replay_clocks(
    events: DataFrame, messages: DataFrame, node_count: int, rows: int = CHUNK_ROWS, max_rounds: int = MAX_ROUNDS,
    lost: bool = False,
) -> DataFrame:
    """``(event, node_idx, seq, vc)`` from ``events (event, node_idx, seq)`` and
    ``messages (send_event, recv_event)``.

    Every event ticks its node; a receiver merges the sender's clock. ``seq``
    counts each node's events from 0; a gap, or a message of an unknown event, raises
    ``ValueError``. With ``lost`` both are taken as events that were not kept: numbers stay as they are, a message
    counts if both its ends are there, and a clock holds, per node, the last tick of a kept event that it
    can be traced back to. Each round an event merges the
    clocks of all the events its own clock points at, not just those of its
    direct senders, so the number of hops covered (messages, and steps into the
    next chunk of a node) doubles: a chain of h hops takes about log2(h) rounds.
    Rounds are written tables. Messages that form a circle raise ``ValueError``.
    """
    _check(events, messages, lost)
    names = components(node_count)
    placed = _placed(events, rows)
    own = [f"if(node_idx = {i}, tick, 0L) as {c}" for i, c in enumerate(names)]
    state = placed.selectExpr(*_PLACE, *own)
    told = _first_hop(placed, messages, names)
    for _ in range(max_rounds):
        state = _advance(state.select(*_PLACE, *names), told, names, rows)
        grew, circular = state.agg(F.max("grew"), F.max("circular")).first()
        if circular:
            raise ValueError("messages form a circle")
        if not grew:
            return placed.join(state, ["node_idx", "tick"]).selectExpr(
                "event", "node_idx", "tick - 1 as seq", f"array({', '.join(names)}) as vc"
            )
        told = _second_hand(state, names, rows)
    raise ValueError(f"no fixpoint within {max_rounds} rounds")


# Of an event: its node, its tick, its place among the node's kept events, and the tick of the kept event before (0: none).
_PLACE = ["node_idx", "tick", "place", "before"]


def _placed(events, rows):
    """Events with their place; chunks are cut by place, so they are as full after losses as without."""
    ticked = events.selectExpr("event", "cast(node_idx as int) as node_idx", "seq + 1 as tick")
    numbered = number_rows(ticked.withColumn("_range", chunk_of("tick", rows)), ["node_idx"], ["_range"], ["tick"], "place").drop("_range")
    chunked = numbered.withColumn("_chunk", chunk_of("place", rows))
    tops = chunked.groupBy("node_idx", "_chunk").agg(F.max("tick").alias("_top"))
    carry = tops.selectExpr("node_idx", "_chunk", "lag(_top) over (partition by node_idx order by _chunk) as _carry")
    stepped = chunked.withColumn("_in", F.expr("lag(tick) over (partition by node_idx, _chunk order by tick)"))
    joined = stepped.join(carry, ["node_idx", "_chunk"]).withColumn("before", F.coalesce("_in", "_carry", F.lit(0).cast("bigint")))
    return written(joined.select("event", *_PLACE), "events")


def _check(events, messages, lost):
    """Sequence numbers without repeats and gaps, and messages between known events only."""
    stored = events.groupBy("node_idx", "seq").agg(F.count(F.lit(1)).alias("n")).groupBy("node_idx").agg(
        F.max("n").alias("n"), F.count(F.lit(1)).alias("kept"), F.min("seq").alias("low"), F.max("seq").alias("high")
    )
    whole = (F.col("n") == 1) & (F.col("low") >= 0)
    if not lost:
        whole = whole & (F.col("low") == 0) & (F.col("kept") == F.col("high") + 1)
    broken = [r.node_idx for r in stored.where(~whole).select("node_idx").limit(33).collect()]
    if broken:
        raise ValueError(f"sequence numbers of nodes {sorted(broken)} have gaps or repeat" if not lost else f"sequence numbers of nodes {sorted(broken)} repeat")
    if lost:
        return
    ends = messages.select(F.explode(F.array("send_event", "recv_event")).alias("event"))
    unknown = ends.join(events.select("event"), "event", "left_anti").count()
    if unknown:
        raise ValueError(f"{unknown} ends of messages are unknown events")


def _first_hop(placed, messages, names):
    """What each receiver learns from its direct senders, folded per receiver."""
    busy = messages.groupBy(F.col("send_event").alias("event")).count().where(F.col("count") >= HEAVY_ROWS)
    sends = lookup(
        messages.withColumnRenamed("send_event", "event"),
        placed.selectExpr("event", "node_idx as from_node", "tick as from_tick"),
        ["event"], busy,
    )
    learned = [F.expr(f"max(if(from_node = {i}, from_tick, null)) as {c}") for i, c in enumerate(names)]
    folded = sends.groupBy(F.col("recv_event").alias("event")).agg(*learned)
    return placed.join(folded, "event").select("node_idx", "tick", *names)


def _second_hand(state, names, rows):
    """The clocks of the events a clock points at.

    Only components that moved since the row before are followed (all of them at
    the start of a chunk, and there the row before itself), so one sender's tick
    is asked for once per node and chunk, however many entries know it.
    """
    earlier = "over (partition by node_idx, _chunk order by tick)"
    stepped = state.withColumn("_chunk", chunk_of("place", rows)).selectExpr(
        "node_idx", "tick", "before", *names,
        f"lag(tick) {earlier} is null and before > 0 as _first",
        *[f"coalesce(lag({c}) {earlier}, 0L) as _was_{c}" for c in names],
    )
    moved = [
        f"case when node_idx = {j} then if(_first, named_struct('j', {j}, 'k', before), null) "
        f"when {c} > _was_{c} then named_struct('j', {j}, 'k', {c}) end"
        for j, c in enumerate(names)
    ]
    asks = stepped.selectExpr(
        "node_idx as to_node", "tick as to_tick", f"inline(array_compact(array({', '.join(moved)})))"
    )
    known = state.selectExpr("node_idx as j", "tick as k", *names)
    return (
        asks.join(known, ["j", "k"])
        .groupBy(F.col("to_node").alias("node_idx"), F.col("to_tick").alias("tick"))
        .agg(*[F.expr(f"max({c}) as {c}") for c in names])
    )


def _advance(state, told, names, rows):
    """Merge what was told into the rows and carry it along each chunk of a node."""
    told = told.selectExpr("node_idx", "tick", *[f"{c} as t_{c}" for c in names])
    # Whoever an event hears of must not know that event already.
    circular = " or ".join(f"(node_idx = {j} and t_{c} >= tick)" for j, c in enumerate(names))
    merged = state.join(told, ["node_idx", "tick"], "left").selectExpr(
        *_PLACE, *names, *[f"greatest({c}, t_{c}) as got_{c}" for c in names],
        f"coalesce({circular}, false) as circular",
    )
    so_far = (
        "over (partition by node_idx, _chunk order by tick rows between unbounded preceding and current row)"
    )
    carried = merged.withColumn("_chunk", chunk_of("place", rows)).selectExpr(
        *_PLACE, *[f"{c} as old_{c}" for c in names],
        *[f"max(got_{c}) {so_far} as {c}" for c in names], "circular",
    )
    grew = " or ".join(f"{c} > old_{c}" for c in names)
    return written(carried.selectExpr(*_PLACE, *names, f"{grew} as grew", "circular"), "replay")
