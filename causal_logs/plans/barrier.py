"""Computed columns that later filters cannot unfold."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, columns: list[str], drop: list[str] = [], where: Column | None = None) -> DataFrame:
    """Fix ``columns`` as they are, optionally keeping only rows with ``where``.

    A filter on a computed column is normally pushed below the projections that
    compute it, with their expressions copied into it: parsing a line once per
    use. Columns that come out of a generator stay where they are. One-row
    generators run inside generated code and shuffle nothing.
    """
    row = F.array(F.struct(*[F.col(c).alias(c) for c in columns]))
    if where is not None:
        row = F.when(where, row)
    others = [c for c in df.columns if c not in columns and c not in drop]
    return df.select(*others, F.inline(row))
