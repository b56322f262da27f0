"""Log levels as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DEFAULT_LEVEL, LEVELS


def _col(level) -> Column:
    return F.col(level) if isinstance(level, str) else level


def normalize(level) -> Column:
    """Upper-case level name; anything unknown or NULL becomes INFO."""
    upper = F.upper(_col(level))
    return F.when(upper.isin(*LEVELS), upper).otherwise(DEFAULT_LEVEL)


def rank(level) -> Column:
    """0 for DEBUG up to 4 for FATAL, NULL for other text."""
    place = F.array_position(F.array(*map(F.lit, LEVELS)), F.upper(_col(level)))
    return F.when(place > 0, (place - 1).cast("int"))


def label(level_rank) -> Column:
    return F.coalesce(F.get(F.array(*map(F.lit, LEVELS)), _col(level_rank)), F.lit("UNKNOWN"))
