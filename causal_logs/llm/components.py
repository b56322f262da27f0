"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for the ends of ``links`` (a, b).

    Every round, a node takes the smallest label around it and then that label's own
    label, so long chains shorten by half. Labels are tables; only a count reaches the driver.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    for _ in range(MAX_ROUNDS):
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        nearest = labels.join(near, "node").select("node", F.least("component", "near").alias("mid"), F.col("component").alias("old"))
        own = labels.select(F.col("node").alias("mid"), F.col("component").alias("further"))
        new = written(nearest.join(own, "mid").select("node", F.least("mid", "further").alias("component"), "old"), "labels")
        labels = new.drop("old")
        if new.where(F.col("component") != F.col("old")).limit(1).count() == 0:
            return labels
    raise RuntimeError(f"components are not settled after {MAX_ROUNDS} rounds")
