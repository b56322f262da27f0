"""The causal past of every event, without forming pairs.

For well-formed clocks (own component = place in the own node's history,
knowledge passed on completely) an event a of node i lies in the past of b
exactly when ``vc_b[i] >= tick_a``. So the past of b is one prefix of every
node's history, and a question about it is one as-of lookup per node.

Most of these lookups repeat: along a node, a component changes only when the
node hears something new. The tick table therefore lists, per row, only the
components that changed since the row before (all of them on the first row of a
chunk). Running values along the node put the rest back together.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .scan import CHUNK_ROWS, as_of, chunk_of
from .skew import HEAVY_ROWS, lookup


def components(node_count: int) -> list[str]:
    return [f"c{i}" for i in range(node_count)]


def _move(j: int, k: str, c: str) -> str:
    return f"named_struct('j', {j}, 'k', {k}, 'was', _was_{c})"


def tick_table(
    log: DataFrame,
    node_count: int,
    values: dict[str, Column] | None = None,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row per (node_idx, tick): copies, values, clock, changed components.

    Columns: ``node_idx, tick, copies``, the aggregates in ``values``,
    ``prev_tick`` (NULL at the start of a chunk), ``c0..``, and ``news``, an
    array of ``(j, k, was)`` for the components j that moved from ``was`` to
    ``k``. Copies of an entry are folded before the shuffle. The table is
    written once, since every later step reads some of its columns.

    Raises ``MalformedClocks`` where the prefix property cannot hold: entries that know
    something but never ticked their own component, entries of one tick with
    different clocks, and knowledge that falls along a node.
    """
    names = components(node_count)
    ticked = log.withColumn("tick", F.expr("coalesce(get(vc, node_idx), 0L)"))
    knowing = "node_idx is not null and (tick > 0 or exists(vc, x -> x > 0))"
    narrow = ticked.where(knowing).selectExpr(
        "*", "cast(node_idx as int) as _node", *[f"coalesce(get(vc, {i}), 0L) as {c}" for i, c in enumerate(names)]
    )
    ticks = narrow.groupBy(F.col("_node").alias("node_idx"), "tick").agg(
        F.expr("count(1) as copies"),
        *[agg.alias(name) for name, agg in (values or {}).items()],
        *[F.expr(f"max({c}) as {c}") for c in names],
        F.expr(" or ".join(f"max({c}) <> min({c})" for c in names)).alias("_several"),
    )
    before = "over (partition by node_idx, _chunk order by tick)"
    ticks = ticks.withColumn("_chunk", chunk_of("tick", rows)).selectExpr(
        "*", f"lag(tick) {before} as prev_tick", *[f"coalesce(lag({c}) {before}, 0L) as _was_{c}" for c in names]
    )
    moves = [
        f"case when node_idx = {j} then if(prev_tick is null and tick > 1, {_move(j, 'tick - 1', c)}, null) "
        f"when {c} > _was_{c} then {_move(j, c, c)} end"
        for j, c in enumerate(names)
    ]
    ticks = ticks.withColumn("news", F.expr(f"array_compact(array({', '.join(moves)}))"))
    falls = " or ".join(f"(node_idx <> {j} and {c} < _was_{c})" for j, c in enumerate(names))
    ticks = ticks.withColumn("fault", F.expr(
        "case when tick <= 0 then 'own component not ticked' when _several then 'one tick, several clocks' "
        f"when prev_tick is not null and ({falls}) then 'knowledge falls' end"
    ))
    stored = written(ticks.drop("_chunk", "_several", *[f"_was_{c}" for c in names]), "ticks")
    faults = {r.fault: r.n for r in stored.where("fault is not null").groupBy("fault").agg(F.sum("copies").alias("n")).collect()}
    fallen = _falls_between(stored, names, rows)
    if fallen:
        faults["knowledge falls"] = faults.get("knowledge falls", 0) + fallen
    if faults:
        raise MalformedClocks("; ".join(f"{fault}: {n} entries" for fault, n in sorted(faults.items())))
    return stored.where("tick > 0").drop("fault")


def _falls_between(ticks: DataFrame, names: list[str], rows: int) -> int:
    """Entries at the start of a chunk that know less than the last tick of the node's chunk before."""
    clock = f"struct({', '.join(names)})"
    ends = ticks.withColumn("_chunk", chunk_of("tick", rows)).groupBy("node_idx", "_chunk").agg(
        F.expr(f"min_by(struct({clock} as clock, copies, fault), tick) as first"), F.expr(f"max_by({clock}, tick) as last")
    )
    # One row per chunk.
    before = "over (partition by node_idx order by _chunk)"
    falls = " or ".join(f"(node_idx <> {j} and first.clock.{c} < _was.{c})" for j, c in enumerate(names))
    paired = ends.selectExpr("node_idx", "first", f"lag(last) {before} as _was")
    return paired.where(f"first.fault is null and _was is not null and ({falls})").agg(F.sum("first.copies")).first()[0] or 0


def knowledge(ticks: DataFrame, node_count: int, rows: int = CHUNK_ROWS) -> DataFrame:
    """``(node_idx, tick, copies, falls, incomplete)`` of any table ``(node_idx, tick, copies, c0..)`` with a row per tick.

    ``falls``: some component is less than at the node's stored tick before. ``incomplete``: of a node that the row has
    just heard of up to tick k, the last stored clock up to k knows more than the row does. Needs no premise.
    """
    names = components(node_count)
    clock = f"struct({', '.join(names)})"
    chunked = ticks.withColumn("_chunk", chunk_of("tick", rows))
    tops = chunked.groupBy("node_idx", "_chunk").agg(F.expr(f"max_by({clock}, tick) as _top"))
    carry = tops.selectExpr("node_idx", "_chunk", "lag(_top) over (partition by node_idx order by _chunk) as _carry")
    before = f"lag({clock}) over (partition by node_idx, _chunk order by tick)"
    stepped = chunked.withColumn("_in", F.expr(before)).join(carry, ["node_idx", "_chunk"]).selectExpr(
        "node_idx", "tick", "copies", *names, "coalesce(_in, _carry) as _was"
    )
    falls = " or ".join(f"(node_idx <> {j} and {c} < _was.{c})" for j, c in enumerate(names))
    news = [f"if(node_idx <> {j} and {c} > coalesce(_was.{c}, 0L), named_struct('j', {j}, 'k', {c}), null)" for j, c in enumerate(names)]
    stored = written(stepped.selectExpr(
        "node_idx", "tick", "copies", f"{clock} as clock", f"coalesce({falls}, false) as falls", f"array_compact(array({', '.join(news)})) as news"
    ), "knowledge")
    asks = stored.selectExpr("node_idx as to_node", "tick as to_tick", "clock as own", "inline(news)").selectExpr("j as node_idx", "k as tick", "to_node", "to_tick", "own")
    told = as_of(stored.selectExpr("node_idx", "tick", "struct(tick, clock) as sent"), asks, "sent", F.max, rows)
    more = " or ".join(f"sent.clock.{c} > own.{c}" for c in names)
    lacking = told.where(more).groupBy(F.col("to_node").alias("node_idx"), F.col("to_tick").alias("tick")).agg(F.lit(True).alias("_lacks"))
    return stored.join(lacking, ["node_idx", "tick"], "left").select("node_idx", "tick", "copies", "falls", F.coalesce("_lacks", F.lit(False)).alias("incomplete"))


class MalformedClocks(ValueError):
    """The clocks are not those of nodes that tick their own component and pass on what they know."""


def _along_node(ticks: DataFrame, answers: DataFrame, value: str, combine, out: str, rows: int) -> DataFrame:
    """Combine answers and the values of earlier rows along each node.

    A row sees the answers to its own questions and everything before it in its
    chunk, but not its own value.
    """
    at_tick = ticks.selectExpr("node_idx", "tick", "1 as _kind", f"{value} as _v")
    told = answers.selectExpr("to_node as node_idx", "to_tick as tick", "0 as _kind", "_v")
    w = (
        Window.partitionBy("node_idx", "_chunk").orderBy("tick", "_kind")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        at_tick.unionByName(told)
        .withColumn("_chunk", chunk_of("tick", rows))
        .withColumn(out, combine("_v").over(w))
        .where(F.col("_kind") == 1)
        .select("node_idx", "tick", F.col("_v").alias(value), out)
    )


def _news(ticks: DataFrame) -> DataFrame:
    return ticks.selectExpr("node_idx as to_node", "tick as to_tick", "inline(news)")


def past_max(ticks: DataFrame, value: str, out: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """``(node_idx, tick, value, out)``: largest ``value`` in the strict causal past."""
    asks = _news(ticks).selectExpr("j as node_idx", "k as tick", "to_node", "to_tick")
    answers = as_of(ticks, asks, value, F.max, rows).withColumn("_v", F.col(value))
    return _along_node(ticks, answers, value, F.max, out, rows)


def past_count(ticks: DataFrame, out: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """``(node_idx, tick, copies, out)``: number of stored rows in the strict causal past."""
    both = "inline(array(named_struct('tick', k, 'sign', 1), named_struct('tick', was, 'sign', -1)))"
    asks = _news(ticks).selectExpr("j as node_idx", "to_node", "to_tick", both).where("tick > 0")
    answers = as_of(ticks, asks, "copies", F.sum, rows).withColumn("_v", F.col("copies") * F.col("sign"))
    counted = _along_node(ticks, answers, "copies", F.sum, out, rows)
    return counted.withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("bigint")))


def known_by(ticks: DataFrame, node_count: int, out: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """``(node_idx, tick, out)``: number of stored rows whose clock has reached the tick.

    That is the row's own copies and everything after it. Counted from the
    histogram of each component, not from pairs.
    """
    cells = [f"named_struct('node_idx', {j}, 'tick', {c})" for j, c in enumerate(components(node_count))]
    reached = (
        ticks.selectExpr("copies", f"inline(array({', '.join(cells)}))")
        .groupBy("node_idx", "tick").agg(F.sum("copies").alias("_n"))
    )
    everyone = ticks.agg(F.sum("copies").alias("_all")).scalar()
    asks = ticks.select("node_idx", (F.col("tick") - 1).alias("tick"))
    below = as_of(reached, asks, "_n", F.sum, rows)
    return below.select("node_idx", (F.col("tick") + 1).alias("tick"), (everyone - F.col("_n")).alias(out))


def attach(rows: DataFrame, ticks: DataFrame, per_tick: DataFrame) -> DataFrame:
    """Left join ``per_tick`` values to log rows by (node_idx, tick)."""
    heavy = ticks.where(F.col("copies") >= HEAVY_ROWS)
    return lookup(rows, per_tick, ["node_idx", "tick"], heavy)
