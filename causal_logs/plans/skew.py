"""Joins of log rows to small facts per key, when a few keys hold most rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows under one key from which the key counts as heavy.
HEAVY_ROWS = 1 << 20
# Heavy keys are at most (rows of the table / HEAVY_ROWS); beyond this many the
# shuffle join is used for all of them.
MAX_HEAVY_KEYS = 100_000
_SPREAD = 1 << 16


def lookup(rows: DataFrame, facts: DataFrame, on: list[str], heavy: DataFrame) -> DataFrame:
    """Left join ``facts`` (unique on ``on``) to ``rows``.

    All rows of a heavy key would meet in one join task. ``heavy`` lists these
    keys; their facts are broadcast, and their rows go through the shuffle spread
    by a second key that matches nothing.
    """
    columns = [c for c in facts.columns if c not in on]
    found = heavy.select(*on).limit(MAX_HEAVY_KEYS + 1).count()
    if found == 0 or found > MAX_HEAVY_KEYS:
        return rows.join(facts, on, "left").select(*rows.columns, *columns)
    few = facts.join(F.broadcast(heavy.select(*on)), on, "left_semi").select(
        *[F.col(k).alias(f"_h_{k}") for k in on],
        *[F.col(c).alias(f"_h_{c}") for c in columns],
        F.lit(True).alias("_heavy"),
    )
    matches = [F.col(k) == F.col(f"_h_{k}") for k in on]
    spread = 1 + F.pmod(F.xxhash64(*rows.columns), F.lit(_SPREAD))
    marked = rows.join(F.broadcast(few), matches, "left")
    marked = marked.withColumn("_side", F.when(F.col("_heavy"), spread).otherwise(F.lit(0).cast("bigint")))
    joined = marked.join(facts.withColumn("_side", F.lit(0).cast("bigint")), [*on, "_side"], "left")
    filled = [F.coalesce(c, f"_h_{c}").alias(c) for c in columns]
    return joined.select(*rows.columns, *filled)
