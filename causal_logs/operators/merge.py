"""Merged clocks: per group, and along each node."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clocks
from ..plans.frontier import components
from ..plans.scan import CHUNK_ROWS, running


def _spread(log: DataFrame, node_count: int, *keep) -> DataFrame:
    cells = [f"get(vc, {i}) as {c}" for i, c in enumerate(components(node_count))]
    return log.select(*keep, *map(F.expr, cells))


def _gathered(names: list[str]):
    """A clock from its components, as long as the highest one present."""
    return F.array_compact(F.array(*names))


def merge_clocks(log: DataFrame, keys: list, node_count: int) -> DataFrame:
    """Per group: ``merged``, the component-wise maximum, and ``n`` entries.

    One hash aggregate over plain numbers, combined before the shuffle. The
    result is as long as the longest clock of the group.
    """
    spread = _spread(log, node_count, *keys)
    groups = spread.columns[: len(keys)]
    merged = spread.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), *[F.expr(f"max({c}) as {c}") for c in components(node_count)]
    )
    return merged.select(*groups, _gathered(components(node_count)).alias("merged"), "n")


def running_frontier(
    log: DataFrame, node_count: int, key: str = "node_id", order: str = "seq", rows: int = CHUNK_ROWS
) -> DataFrame:
    """``(key, order, frontier)``: merge of everything up to ``order`` under ``key``.

    Entries of one place in the order are folded first, then the running
    maximum is taken inside stretches of the order and carried over them.
    """
    names = components(node_count)
    placed = _spread(log, node_count, key, order).groupBy(key, order).agg(*[F.expr(f"max({c}) as {c}") for c in names])
    ran = running(placed, [key], order, {f"m{i}": c for i, c in enumerate(names)}, rows)
    return ran.select(key, order, _gathered([f"m{i}" for i in range(node_count)]).alias("frontier"))
