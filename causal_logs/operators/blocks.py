"""Keyword index in blocks of postings: fewer bytes and rows than one posting a row.

A block holds the postings of one token in one span of event ids: sorted offsets and their counts as
arrays, which Parquet stores as small differences, with the first and last offset beside them. Spans are the same for all tokens,
so messages with several keywords are looked for only in spans that have a block of each, and there only where
the blocks overlap; the others are skipped by their first and last offsets alone.

An index is written in parts, such as days. The parts in force are listed by number of version; many small parts are merged
into one by writing it and listing it instead of them. One writer at a time.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.folders import escaped, numbered, remove
from .search import BUCKET_ROWS, _keywords, bucket_of

# Event ids of a block.
SPAN = 1 << 17

_BLOCK = ["token", "span"]


def packed(postings: DataFrame, event_id: str = "event_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(token, span, n, first, last, offsets, tfs)`` from ``(token, event_id, tf)``; event ids are numbers, each once per token.

    A group is one token in one span, so it has ``SPAN`` postings at most and a frequent token is many groups.
    """
    offset = F.pmod(F.col(event_id), F.lit(SPAN))
    span = F.call_function("div", F.col(event_id) - offset, F.lit(SPAN))
    one = F.struct(offset.cast("int").alias("o"), F.col("tf").cast("int").alias("t"))
    grouped = postings.select(*keep, "token", span.alias("span"), one.alias("p")).groupBy(*keep, *_BLOCK)
    return _as_blocks(grouped.agg(F.sort_array(F.collect_list("p")).alias("p")), keep)


def _as_blocks(sorted_: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    offsets = F.transform("p", lambda x: x["o"])
    return sorted_.select(*keep, *_BLOCK, F.size("p").alias("n"), offsets.alias("offsets"), F.transform("p", lambda x: x["t"]).alias("tfs")).select(
        *keep, *_BLOCK, "n", F.get("offsets", F.lit(0)).alias("first"), F.get("offsets", F.col("n") - 1).alias("last"), "offsets", "tfs"
    )


def _listed(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """The last version of an index, and the folders of its parts by name."""
    found = numbered(spark, f"{path}/_parts", "version")
    if not found:
        return 0, {}
    return found[-1], {r.part: r.folder for r in spark.read.parquet(f"{path}/_parts/version={found[-1]}").collect()}


def _list(spark: SparkSession, path: str, version: int, folders: dict[str, str], gone: list[str]) -> None:
    """Put a new list of parts in force, then remove the folders that it no longer names."""
    names = spark.createDataFrame(sorted(folders.items()), "part string, folder string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{path}/_parts/version={version}")
    remove(spark, [f"{path}/folder={escaped(spark, f)}" for f in gone])


def _store(blocks: DataFrame, path: str, bucket_rows: int) -> None:
    """Blocks with their ``folder``, by bucket of their token and sorted."""
    sizes = blocks.groupBy("folder").agg(F.ceil(F.sum("n") / bucket_rows).cast("int").alias("buckets"))
    (
        blocks.join(sizes, "folder").withColumn("bucket", bucket_of("token", F.col("buckets")))
        .repartition("folder", "bucket").sortWithinPartitions("folder", "bucket", *_BLOCK)
        # Sorted offsets become differences of a few bits.
        .write.mode("append").option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "false")
        .partitionBy("folder", "buckets", "bucket").parquet(path)
    )


def write_blocks(postings: DataFrame, path: str, part: str, event_id: str = "event_id", bucket_rows: int = BUCKET_ROWS) -> None:
    """Write parts of an index, each instead of the one of that name if there is one; the column ``part`` of ``postings`` names them (NULL: ``none``)."""
    spark = postings.sparkSession
    version, folders = _listed(spark, path)
    named = postings.withColumn("_part", F.coalesce(F.col(part).cast("string"), F.lit("none")))
    new = {r["_part"]: f"{r['_part']}@{version + 1}" for r in named.select("_part").distinct().collect()}
    remove(spark, [f"{path}/folder={escaped(spark, f)}" for f in new.values()])
    placed = named.select(F.concat("_part", F.lit(f"@{version + 1}")).alias("folder"), "token", event_id, "tf")
    _store(packed(placed, event_id, ("folder",)), path, bucket_rows)
    _list(spark, path, version + 1, {**folders, **new}, [folders[p] for p in new if p in folders])


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    places = [f"{path}/folder={escaped(spark, f)}" for f in folders]
    return spark.read.option("basePath", path).parquet(*places).withColumn("part", F.regexp_replace("folder", r"@\d+$", ""))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of the parts in force, and which ``part`` each is from."""
    return _read(spark, path, list(_listed(spark, path)[1].values()))


def merge_parts(spark: SparkSession, path: str, parts: list[str], into: str, bucket_rows: int = BUCKET_ROWS) -> None:
    """Make one part of several: blocks of one token and span become one, and small files few.

    The new part is whole before the list names it, so a search sees either the old parts or the new one; after a failure the
    merge can be run again. The old parts' files are removed last. No event may have its postings in two of the parts.
    """
    version, folders = _listed(spark, path)
    if into in folders or not set(parts) <= set(folders):
        raise ValueError("parts to merge must be listed, and the new one not")
    folder = f"{into}@{version + 1}"
    remove(spark, [f"{path}/folder={escaped(spark, folder)}"])
    one = F.transform(F.arrays_zip("offsets", "tfs"), lambda x: F.struct(x["offsets"].alias("o"), x["tfs"].alias("t")))
    merged = _read(spark, path, [folders[p] for p in parts]).groupBy(*_BLOCK).agg(F.sort_array(F.flatten(F.collect_list(one))).alias("p"))
    _store(_as_blocks(merged).withColumn("folder", F.lit(folder)), path, bucket_rows)
    _list(spark, path, version + 1, {**{p: f for p, f in folders.items() if p not in parts}, into: folder}, [folders[p] for p in parts])


def block_hits(blocks: DataFrame, keywords: list[str], mode: str = "and", event_id: str = "event_id") -> DataFrame:
    """``(event_id, matched, tf)`` of messages with all ("and") or any ("or") keywords.

    Only the keywords' buckets are opened, and of these the row groups with their tokens.
    """
    words = _keywords(keywords)
    found = blocks.where(F.col("token").isin(*words))
    if "bucket" in blocks.columns:
        found = found.where(reduce(or_, [F.col("bucket") == bucket_of(F.lit(w), F.col("buckets")) for w in words]))
    if mode == "and" and len(words) > 1:
        # Spans with a block of every keyword, and the stretch in which they overlap. Parts may share a span.
        ends = found.groupBy("span", "token").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        shared = ends.groupBy("span").agg(F.count(F.lit(1)).alias("k"), F.max("first").alias("low"), F.min("last").alias("high"))
        shared = shared.where((F.col("k") == len(words)) & (F.col("low") <= F.col("high"))).drop("k")
        found = found.join(shared, "span").where("last >= low and first <= high")
        inside: Column = F.filter(F.arrays_zip("offsets", "tfs"), lambda x: x["offsets"].between(F.col("low"), F.col("high")))
    else:
        inside = F.arrays_zip("offsets", "tfs")
    hits = found.select("token", "span", F.inline(inside)).select("token", (F.col("span") * SPAN + F.col("offsets")).alias(event_id), F.col("tfs").alias("tf"))
    counted = hits.groupBy(event_id).agg(F.count(F.lit(1)).alias("matched"), F.sum("tf").alias("tf"))
    return counted.where(F.col("matched") == len(words)) if mode == "and" else counted
