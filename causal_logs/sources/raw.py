"""Text log files with line numbers."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scan import number_rows


def read_raw_lines(spark: SparkSession, path: str, node_id: Column | None = None) -> DataFrame:
    """``(node_id, file, line_no, line)`` from closed text files.

    Large files are split; a line's number is its place in its split plus the
    line counts of the splits before, so no file is read by one task. The node
    defaults to the name of the directory the file is in.
    """
    name = F.col("_metadata.file_path")
    scanned = spark.read.text(path).select(
        name.alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_place"),
        F.col("value").alias("line"),
    )
    numbered = number_rows(scanned, ["file"], ["_start"], ["_place"], "line_no")
    node = node_id if node_id is not None else F.regexp_extract("file", r"(?:node_id=)?([^/]+)/[^/]+$", 1)
    return numbered.select(node.alias("node_id"), "file", (F.col("line_no") + 1).alias("line_no"), "line")
