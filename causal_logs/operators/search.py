"""Inverted index over messages and keyword search."""

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..plans.folders import escaped, remove

# Postings in a bucket of a stored index; a search opens the buckets of its keywords.
BUCKET_ROWS = 4_000_000
# Files a bucket is spread over, once there are so many buckets, so that a frequent token is not one task.
SPREAD = 8


def build_inverted_index(log: DataFrame, event_id: str = "event_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(token, event_id, tf)`` postings of whole messages.

    Counted by (token, event), which no frequent token can skew; a message's
    repeated tokens are folded before the shuffle.
    """
    words = log.select(event_id, *keep, F.explode(tokens("message")).alias("token")).where(F.col("token") != "")
    return words.groupBy("token", event_id, *keep).agg(F.count(F.lit(1)).alias("tf"))


def bucket_of(token, buckets) -> Column:
    token = F.col(token) if isinstance(token, str) else token
    return F.pmod(F.xxhash64(token), buckets).cast("int")


def write_index(
    postings: DataFrame, path: str, event_id: str = "event_id", day: str | None = None, bucket_rows: int = BUCKET_ROWS
) -> None:
    """Append postings to a stored index, by token bucket and sorted by token.

    The number of buckets follows from the postings written, and is stored beside them. With
    ``day``, a column of ``postings`` (see ``keep``), it follows from each day's postings, there are folders per
    day (one for postings without a day), and writing the same day again replaces it. Otherwise postings are appended, each only
    once. The files of a bucket split its postings by event, so frequent tokens are spread.
    """
    folders = [day] if day else []
    # As a struct, a missing day is equal to itself in the join.
    placed = postings.withColumn("_day", F.struct(F.col(day))) if day else postings
    sizes = placed.groupBy(*["_day"] * bool(day)).agg(F.ceil(F.count(F.lit(1)) / bucket_rows).cast("int").alias("buckets"))
    sized = placed.join(sizes, "_day").drop("_day") if day else postings.withColumn("buckets", F.lit(sizes.first()[0] or 1))
    if day:
        # A day's folders may be others than before, so all of them go first. At most a row per day.
        days = [r[0] for r in sizes.select(F.col("_day")[day].cast("string")).collect()]
        remove(postings.sparkSession, [f"{path}/{day}={escaped(postings.sparkSession, d)}" for d in days])
    spread = F.least(F.lit(SPREAD), F.col("buckets"))
    (
        sized.withColumn("bucket", bucket_of("token", F.col("buckets")))
        .repartition(*folders, "bucket", F.pmod(F.xxhash64(event_id), spread))
        .sortWithinPartitions(*folders, "bucket", "token")
        .write.mode("append").partitionBy(*folders, "buckets", "bucket").parquet(path)
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _keywords(keywords: list[str]) -> list[str]:
    """The tokens of all keywords; a keyword with separators asks for each of its parts."""
    unique = list(dict.fromkeys(w for k in keywords for w in re.findall(r"[^\W_]+", k.lower())))
    if not unique:
        raise ValueError("no keyword with a letter or digit")
    return unique


def keyword_hits(
    index: DataFrame, keywords: list[str], mode: str = "and", event_id: str = "event_id"
) -> DataFrame:
    """``(event_id, matched, tf)`` of messages with all ("and") or any ("or") keywords.

    The filter on ``token`` reaches the scan; on a stored index only the
    keywords' buckets are opened.
    """
    words = _keywords(keywords)
    postings = index.where(F.col("token").isin(*words))
    if "bucket" in index.columns:
        postings = postings.where(reduce(or_, [F.col("bucket") == bucket_of(F.lit(w), F.col("buckets")) for w in words]))
    # Tokens, not postings, are counted: a day indexed twice changes no match.
    matched = F.size(F.collect_set("token")).cast("bigint")
    hits = postings.groupBy(event_id).agg(matched.alias("matched"), F.sum("tf").alias("tf"))
    return hits.where(F.col("matched") == len(words)) if mode == "and" else hits


def keyword_search(
    log: DataFrame, index: DataFrame, keywords: list[str], mode: str = "and", event_id: str = "event_id"
) -> DataFrame:
    """The matching log rows, by way of the index."""
    hits = keyword_hits(index, keywords, mode, event_id).select(event_id)
    return log.join(hits, event_id, "left_semi")


def keyword_scan(log: DataFrame, keywords: list[str], mode: str = "and") -> DataFrame:
    """The matching log rows without an index: one pass, no shuffle.

    A cheap substring test comes first; only rows that pass are split into
    tokens.
    """
    words = _keywords(keywords)
    combine = and_ if mode == "and" else or_
    lowered = F.lower("message")
    maybe = reduce(combine, [F.contains(lowered, F.lit(w)) for w in words])
    sure = reduce(combine, [F.array_contains("_tokens", w) for w in words])
    return (
        log.where(maybe).withColumn("_tokens", tokens("message")).where(sure).drop("_tokens")
    )
