"""The causal graph: each event with its immediate predecessors."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans import frontier
from ..plans.scan import CHUNK_ROWS, as_of, chunk_of


def causal_graph(
    log: DataFrame, node_count: int, event_id: str = "event_id", rows: int = CHUNK_ROWS
) -> DataFrame:
    """``(src_event, dst_event, src_node, dst_node)``, the transitive reduction.

    Only the last known entry of each node can be an immediate predecessor, and
    only if the row before on the same node did not know it already. So an entry
    that heard nothing new has one edge, from the row before it; the others
    compare at most one candidate per node with each other. Copies of an entry
    are one vertex, named by the smallest event id.
    """
    ticks = frontier.tick_table(log, node_count, {event_id: F.min(event_id)}, rows)
    clock = F.array(*frontier.components(node_count))
    vertices = ticks.select(
        "node_idx", "tick", event_id, "news",
        F.struct("tick", F.col(event_id).alias("event"), clock.alias("clock")).alias("src"),
    )
    w = Window.partitionBy("node_idx", "_chunk").orderBy("tick")
    placed = vertices.withColumn("_chunk", chunk_of("tick", rows)).withColumn("_before", F.lag("src").over(w))

    quiet = placed.where((F.size("news") == 0) & F.col("_before").isNotNull()).select(
        F.col("_before.event").alias("src_event"), F.col(event_id).alias("dst_event"),
        F.col("node_idx").alias("src_node"), F.col("node_idx").alias("dst_node"),
    )

    asks = vertices.select(
        F.col(event_id).alias("dst_event"), F.col("node_idx").alias("dst_node"), F.inline("news")
    ).select(F.col("j").alias("node_idx"), F.col("k").alias("tick"), "dst_event", "dst_node")
    heard = as_of(vertices, asks, "src", F.max, rows).select(
        "dst_event", "dst_node", F.col("node_idx").alias("src_node"), "src"
    )
    previous = placed.where((F.size("news") > 0) & F.col("_before").isNotNull()).select(
        F.col(event_id).alias("dst_event"), F.col("node_idx").alias("dst_node"),
        F.col("node_idx").alias("src_node"), F.col("_before").alias("src"),
    )
    # At most one candidate per node, so a group has at most 32 members.
    candidates = (
        heard.where(F.col("src").isNotNull()).unionByName(previous)
        .groupBy("dst_event", "dst_node").agg(F.collect_list(F.struct("src_node", "src")).alias("all"))
    )
    direct = F.filter(
        "all",
        lambda x: ~F.exists(
            F.col("all"),
            lambda d: (d["src_node"] != x["src_node"])
            & (F.get(d["src"]["clock"], x["src_node"]) >= x["src"]["tick"]),
        ),
    )
    noisy = candidates.select("dst_event", "dst_node", F.explode(direct).alias("x")).select(
        F.col("x.src.event").alias("src_event"), "dst_event",
        F.col("x.src_node").alias("src_node"), "dst_node",
    )
    return quiet.unionByName(noisy)
