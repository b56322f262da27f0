"""Vector clocks as column expressions over ``array<bigint>``."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CONCURRENT, EQUAL, HAPPENS_AFTER, HAPPENS_BEFORE, MAX_NODES

_CLOCK_JSON = "map<string,bigint>"


def zeros(n) -> Column:
    """A clock of ``n`` zeros; empty when ``n`` is outside 1..32."""
    n = n if isinstance(n, Column) else F.lit(n)
    empty = F.expr("cast(array() as array<bigint>)")
    return F.when(n.between(1, MAX_NODES), F.array_repeat(F.lit(0).cast("bigint"), n)).otherwise(empty)


def component(vc, i) -> Column:
    """Component ``i`` as a number; missing ones count as 0."""
    return F.coalesce(F.get(vc, i if isinstance(i, Column) else F.lit(i)), F.lit(0).cast("bigint"))


def increment(vc, i) -> Column:
    """Tick component ``i``; an index outside the clock changes nothing."""
    i = i if isinstance(i, Column) else F.lit(i)
    return F.transform(vc, lambda x, pos: F.when(pos == i, x + 1).otherwise(x))


def merge(a, b) -> Column:
    """Component-wise maximum, as long as the longer clock."""
    return F.zip_with(a, b, lambda x, y: F.greatest(x, y))


def own_tick(vc="vc", node_idx="node_idx") -> Column:
    return F.get(F.col(vc), F.col(node_idx))


def total(vc) -> Column:
    """Sum of all components; grows strictly along happens-before."""
    return F.aggregate(vc, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def is_valid(vc) -> Column:
    return F.coalesce(F.size(vc).between(1, MAX_NODES), F.lit(False))


def _all_le(a, b, width):
    if width is not None:
        return reduce(and_, (component(a, i) <= component(b, i) for i in range(width)))
    zero = F.lit(0).cast("bigint")
    return F.forall(
        F.zip_with(a, b, lambda x, y: F.coalesce(x, zero) <= F.coalesce(y, zero)), lambda ok: ok
    )


def relation(a, b, width: int | None = None) -> Column:
    """EQUAL, HAPPENS_BEFORE, HAPPENS_AFTER or CONCURRENT.

    A missing component counts as 0 and a NULL clock is concurrent with
    everything. With ``width`` (at least the length of every clock) the
    comparison is unrolled and stays inside generated code.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    le, ge = _all_le(a, b, width), _all_le(b, a, width)
    return (
        F.when(a.isNull() | b.isNull(), CONCURRENT)
        .when(le & ge, EQUAL)
        .when(le, HAPPENS_BEFORE)
        .when(ge, HAPPENS_AFTER)
        .otherwise(CONCURRENT)
    )


def to_text(vc) -> Column:
    """``[1, 2, 3]``"""
    vc = F.col(vc) if isinstance(vc, str) else vc
    return F.concat(F.lit("["), F.array_join(vc.cast("array<string>"), ", "), F.lit("]"))


def to_map(vc, names: list[str] | None = None) -> Column:
    """Map from node key to count in index order; default keys are ``node-<i>``."""
    vc = F.col(vc) if isinstance(vc, str) else vc
    if names is None:
        keys = F.transform(vc, lambda _, i: F.concat(F.lit("node-"), i.cast("string")))
    else:
        keys = F.slice(F.array(*map(F.lit, names)), 1, F.size(vc))
    return F.map_from_arrays(keys, vc)


def to_json(vc, names: list[str] | None = None) -> Column:
    return F.to_json(to_map(vc, names))


def _index(key, names):
    if names is None:
        return F.regexp_extract(key, r"^node-(\d{1,9})$", 1).try_cast("int")
    place = F.array_position(F.array(*map(F.lit, names)), key).cast("int")
    return F.when(place > 0, place - 1)


def with_decoded(
    df: DataFrame,
    text: str,
    names: list[str] | None = None,
    node_count: int | None = None,
    vc: str = "vc",
    error: str = "clock_error",
) -> DataFrame:
    """Decode the clock JSON in column ``text`` into ``vc`` and ``error``.

    Keys are ``node-<i>`` or members of ``names``; the last of duplicated keys
    wins. The clock is as long as ``node_count`` or ``names`` say, else as the
    highest index asks for. ``error`` is ``bad_clock`` (no object of counts),
    ``bad_clock_key`` or ``clock_too_wide``, and then ``vc`` is NULL.

    Clocks whose keys are complete and in order, as this package writes them,
    are taken as they are; only others are looked up key by key. One projection
    per step, so that the JSON is parsed once per row; callers that filter on
    the result settle it first (``plans.barrier``).
    """
    width = node_count or (len(names) if names else None)
    counts, keys, slots = F.col("_counts"), F.map_keys("_counts"), F.col("_slots")
    if names is None:
        wanted = F.transform(keys, lambda _, i: F.concat(F.lit("node-"), i.cast("string")))
    else:
        wanted = F.array(*map(F.lit, names))
    complete = (keys == wanted) & (F.size(keys) == width if width else F.size(keys) <= MAX_NODES)
    size = F.lit(width) if width else F.coalesce(F.array_max(F.transform(slots, lambda s: s["i"])) + 1, F.lit(0))
    dense = F.transform(
        F.array_repeat(F.lit(0).cast("bigint"), F.col("_size")),
        lambda zero, i: F.coalesce(
            F.try_element_at(F.filter(slots, lambda s: s["i"] == i), F.lit(-1))["n"], zero
        ),
    )
    reason = (
        F.when(counts.isNull() | F.exists(F.map_values(counts), lambda n: n.isNull() | (n < 0)), "bad_clock")
        .when(F.exists(slots, lambda s: s["i"].isNull()), "bad_clock_key")
        .when((F.col("_size") > MAX_NODES) | F.exists(slots, lambda s: s["i"] >= F.col("_size")), "clock_too_wide")
    )
    listed = F.transform(
        F.map_entries("_counts"),
        lambda e: F.struct(_index(e["key"], names).alias("i"), e["value"].alias("n")),
    )
    return (
        df.withColumn("_counts", F.from_json(text, _CLOCK_JSON))
        .withColumn("_complete", F.coalesce(complete, F.lit(False)))
        .withColumn("_slots", F.when(~F.col("_complete"), listed))
        .withColumn("_size", size)
        .withColumn(error, reason)
        .withColumn(vc, F.when(F.col(error).isNull(), F.when(F.col("_complete"), F.map_values("_counts")).otherwise(dense)))
        .drop("_counts", "_complete", "_slots", "_size")
    )
