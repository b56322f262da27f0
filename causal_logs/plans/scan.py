"""Positions and running values over ordered keys, in bounded tasks.

A window over one node or over the whole table is one task per node, or one
task in all. The helpers here cut every ordered run into chunks whose size does
not depend on how the rows are spread over keys, work inside the chunks, and
combine one row per chunk afterwards.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

# Rows of one run that share a chunk.
CHUNK_ROWS = 1 << 16
# Partition counts up to this are broadcast (two numbers each).
MAX_BROADCAST_PARTITIONS = 200_000

_ROW_BITS = 33
_ALL_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def chunk_of(position, rows: int = CHUNK_ROWS) -> Column:
    position = F.col(position) if isinstance(position, str) else position
    return F.call_function("div", position, F.lit(rows))


def number_rows(
    df: DataFrame, keys: list[str], chunk: list[str], order: list[str], out: str
) -> DataFrame:
    """0-based ``out`` within ``keys`` by ``(chunk, order)``.

    The caller picks ``chunk`` so that one (keys, chunk) group is bounded, for
    instance a number range of a unique column. Rows are shuffled once, by
    chunk; the chunk sizes are aggregated map-side. NULLs count as values, and come first.
    """
    placed = df.withColumn("_at", F.struct(*keys, *chunk))
    sizes = placed.groupBy("_at").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*_of("_at", keys)).orderBy(*_of("_at", chunk)).rowsBetween(*_ALL_BEFORE)
    offsets = sizes.select("_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_at").orderBy(*order)
    return (
        placed.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(offsets, "_at")
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_offset", "_inside", "_at")
    )


def _of(struct: str, fields: list[str]) -> list[Column]:
    """Fields of a struct; unlike columns, structs with NULL fields are equal to each other in a join."""
    return [F.col(struct)[f] for f in fields]


def rank_rows(df: DataFrame, order: list[str], out: str = "pos") -> DataFrame:
    """Positions 1..N of the whole table by ``order``.

    ``order`` should end in a unique column; then any bunch of equal leading
    values is still split evenly by the range partitioning of the sort. The
    sorted rows are written once; each partition then adds the row count of
    those before it.
    """
    tagged = written(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_row", _ROW_BITS)
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort, whatever the size of the table.
    before = Window.orderBy("_part").rowsBetween(*_ALL_BEFORE)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    if sort_partitions(df) <= MAX_BROADCAST_PARTITIONS:
        offsets = F.broadcast(offsets)
    inside = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        tagged.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(out, F.col("_offset") + inside + 1)
        .drop("_part", "_row", "_offset")
    )


def sort_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_previous(df: DataFrame, keys: list[str], order: list[str], columns: list[str], rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``prev_<column>`` from the row before within ``keys``; NULL on the first.

    Rows are ranked by ``(keys, order)`` and cut into equal chunks. The last row
    of a chunk is handed to the next one as well, so no chunk needs its
    neighbour and a key of any size is spread over many tasks.
    """
    ranked = rank_rows(df, [*keys, *order], "_pos").withColumn("_chunk", chunk_of("_pos", rows))
    last = F.pmod(F.col("_pos"), F.lit(rows)) == rows - 1
    copies = F.when(last, F.array("_chunk", F.col("_chunk") + 1)).otherwise(F.array("_chunk"))
    spread = ranked.withColumn("_at", F.explode(copies))
    w = Window.partitionBy("_at").orderBy("_pos")
    same = F.lit(True)
    for key in keys:
        same = same & F.lag(key).over(w).eqNullSafe(F.col(key))
    previous = [F.when(same, F.lag(c).over(w)).alias(f"prev_{c}") for c in columns]
    return (
        spread.select("*", *previous)
        .where(F.col("_at") == F.col("_chunk"))
        .drop("_pos", "_chunk", "_at")
    )


def running(
    df: DataFrame, keys: list[str], order: str, values: dict[str, str], rows: int = CHUNK_ROWS
) -> DataFrame:
    """Running maximum per ``keys`` along the dense number ``order``.

    ``values`` maps output to input columns. ``(keys, order)`` must be unique,
    so that a chunk of ``order`` holds a bounded number of rows.
    """
    by = ", ".join(f"_at.{k}" for k in keys)
    chunked = df.withColumn("_chunk", chunk_of(order, rows)).withColumn("_at", F.struct(*keys, "_chunk"))
    tops = chunked.groupBy("_at").agg(*[F.expr(f"max({v}) as _top_{k}") for k, v in values.items()])
    before = f"over (partition by {by} order by _at._chunk rows between unbounded preceding and 1 preceding)"
    carry = tops.selectExpr("_at", *[f"max(_top_{k}) {before} as _carry_{k}" for k in values])
    so_far = f"over (partition by _at order by {order} rows between unbounded preceding and current row)"
    inside = chunked.selectExpr("*", *[f"max({v}) {so_far} as _in_{k}" for k, v in values.items()])
    joined = inside.join(carry, "_at")
    others = [c for c in df.columns if c not in values]
    return joined.selectExpr(*others, *[f"greatest(_in_{k}, _carry_{k}) as {k}" for k in values])


def as_of(stops: DataFrame, asks: DataFrame, value: str, combine, rows: int = CHUNK_ROWS) -> DataFrame:
    """For every ask ``(node_idx, tick, ...)`` the values at or before that tick.

    ``stops`` holds ``(node_idx, tick, value)``; ``combine`` is ``F.max`` or
    ``F.sum``. Both sides meet in chunks of ticks; what lies in earlier chunks
    arrives as one carried value per chunk. Adds ``value`` to the asks.
    """
    at_stop = stops.select("node_idx", "tick", F.lit(0).alias("_kind"), F.col(value))
    both = at_stop.unionByName(asks.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn("_chunk", chunk_of("tick", rows))
    so_far = Window.partitionBy("node_idx", "_chunk").orderBy("tick", "_kind").rowsBetween(*_SO_FAR)
    inside = both.withColumn("_in", combine(value).over(so_far)).where(F.col("_kind") == 1)

    touched = stops.select("node_idx", chunk_of("tick", rows).alias("_chunk"), F.col(value)).unionByName(
        asks.select("node_idx", chunk_of("tick", rows).alias("_chunk")), allowMissingColumns=True
    )
    tops = touched.groupBy("node_idx", "_chunk").agg(combine(value).alias("_top"))
    before = Window.partitionBy("node_idx").orderBy("_chunk").rowsBetween(*_ALL_BEFORE)
    carry = tops.select("node_idx", "_chunk", combine("_top").over(before).alias("_carry"))

    joined = inside.join(carry, ["node_idx", "_chunk"])
    if combine is F.sum:
        zero = F.lit(0).cast("bigint")
        answer = F.coalesce("_in", zero) + F.coalesce("_carry", zero)
    else:
        answer = F.greatest("_in", "_carry")
    return joined.withColumn(value, answer).drop("_kind", "_chunk", "_in", "_carry")
