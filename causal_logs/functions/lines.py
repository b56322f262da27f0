"""Raw log lines to level, time and message, as column expressions.

Two grammars read the same four shapes: ``date time LEVEL message`` with or
without a fraction of a second, ``[LEVEL] message``, ``LEVEL: message``, and
plain text. The *documented* grammar follows the described format. The
*observed* grammar gives the rows that stores written so far contain: it needs
the fraction, reads its digits as milliseconds, takes any word as a level, and
cuts whatever stands before a colon.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import LEVELS
from . import levels

# Fixed patterns of the line format. Possessive quantifiers: a number, once
# read, is never given back to make a later part fit.
_CLOCK_TIME = (
    r"^\s*+([+-]?\d++)-\s*+([+-]?\d++)-\s*+([+-]?\d++)"
    r"\s*+([+-]?\d++):\s*+([+-]?\d++):\s*+([+-]?\d++)"
)
_KNOWN = "((?i:" + "|".join(LEVELS) + "))"
TIMED = _CLOCK_TIME + r"(?:\.(\d++))?+\s++(?=\S)([^\n]*+)"
LEADING_LEVEL = "^" + _KNOWN + r"(?![^\s])\s*+([^\n]*+)"
BRACKET = r"^\s*+\[\s*+" + _KNOWN + r"\s*+\]\s*+([^\n]++)"
COLON = r"^\s*+" + _KNOWN + r"\s*+:\s*+([^\n]++)"
OBSERVED_TIMED = _CLOCK_TIME + r"\.\s*+([+-]?\d++)\s*+(\S{1,15}+)\s*+([^\n]*+)"
OBSERVED_BRACKET = r"^\[([^\]]{1,15}+)\]\s*+([^\n]++)"
OBSERVED_COLON = r"^([^:]{1,15}+):\s*+([^\n]++)"

_MARK = "\x01"


def _captures(text, pattern: str, n: int) -> Column:
    """All ``n`` groups of one match as an array, NULL without a match."""
    groups = _MARK.join(f"${i}" for i in range(1, n + 1))
    joined = F.regexp_replace(text, pattern + r"[\s\S]*+$", groups)
    return F.when(text.rlike(pattern), F.split(joined, _MARK, n))


def _int(text) -> Column:
    return text.try_cast("int")


def _documented(df: DataFrame, line: Column, now: Column) -> DataFrame:
    timed, named = F.col("_timed"), F.col("_named")
    parts = [_int(timed[i]) for i in range(6)]
    millis = F.rpad(F.substring(timed[6], 1, 3), 3, "0").cast("int")
    # An out-of-range part gives a NULL time, which the caller sets aside.
    at = F.unix_millis(F.try_make_timestamp(*parts)) + millis
    return (
        df.withColumn("_timed", _captures(line, TIMED, 8))
        .withColumn(
            "_named",
            F.when(timed.isNotNull(), _captures(timed[7], LEADING_LEVEL, 2)).otherwise(
                F.coalesce(_captures(line, BRACKET, 2), _captures(line, COLON, 2))
            ),
        )
        .withColumn("level", levels.normalize(named[0]))
        .withColumn("ts_ms", F.when(timed.isNotNull(), at).otherwise(now))
        .withColumn("message", F.coalesce(named[1], timed[7], F.rtrim(line, F.lit("\n"))))
    )


def _observed(df: DataFrame, line: Column, now: Column) -> DataFrame:
    timed, named = F.col("_timed"), F.col("_named")
    year, month, day, hour, minute, second, millis = (_int(timed[i]) for i in range(7))
    # Parts out of range roll over into the next larger unit.
    first = F.try_make_timestamp(
        year + F.floor((month - 1) / 12).cast("int"), F.pmod(month - 1, F.lit(12)) + 1,
        F.lit(1), F.lit(0), F.lit(0), F.lit(0),
    )
    days = day.cast("bigint") - 1
    seconds = ((days * 24 + hour) * 60 + minute) * 60 + second
    at = F.unix_millis(first) + seconds * 1000 + millis
    return (
        df.withColumn("_timed", _captures(line, OBSERVED_TIMED, 9))
        .withColumn(
            "_named",
            F.when(timed.isNotNull(), F.array(timed[7], timed[8])).otherwise(
                F.coalesce(_captures(line, OBSERVED_BRACKET, 2), _captures(line, OBSERVED_COLON, 2))
            ),
        )
        .withColumn("level", levels.normalize(named[0]))
        .withColumn("ts_ms", F.when(timed.isNotNull(), at).otherwise(now))
        .withColumn("message", F.coalesce(named[1], F.rtrim(line, F.lit("\n"))))
    )


_GRAMMARS = {"documented": _documented, "observed": _observed}


def with_parsed(df: DataFrame, now: Column, line: str = "line", grammar: str = "documented") -> DataFrame:
    """Add ``level``, ``ts_ms`` and ``message``; lines without a time get ``now`` (ms).

    Every pattern is applied once per line; callers that filter on the result
    settle it first (``plans.barrier``).
    """
    return _GRAMMARS[grammar](df, F.col(line), now).drop("_timed", "_named")


def is_blank(line) -> Column:
    """Only truly empty lines count; a line of blanks is an entry."""
    return F.substring(line, 1, 1).isin("", "\n")
