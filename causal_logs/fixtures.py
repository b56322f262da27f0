"""Log tables derived from the given parquet tables.

``causal_log`` turns ``events`` into a log of four nodes with well-formed
clocks: node i has heard of everything node j wrote ``LAG * |i - j|`` hours
before. Wall clocks are skewed, so that time contradicts causality.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import entries
from .plans.barrier import settled
from .plans.scan import chunk_of, number_rows

# Fixed values of the derived tables.
NODES = 4
LAG_HOURS = 6
SKEW_HOURS = (0, -12, 6, 18)
HOUR_MS = 3_600_000
TRACE_NODES = 8
LEVEL_OF = {"error": "ERROR", "signup": "WARN", "purchase": "INFO", "view": "INFO", "click": "DEBUG"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = " ".join(f"when '{k}' then '{v}'" for k, v in LEVEL_OF.items())
    return table(spark, sf_dir, "events").selectExpr(
        "*",
        "unix_millis(cast(ts as timestamp)) as at_ms",
        f"unix_millis(cast(ts as timestamp)) div {HOUR_MS} as hour",
        f"cast(pmod(user_id, {NODES}) as int) as node_idx",
        f"concat('node-', cast(pmod(user_id, {NODES}) as string)) as node_id",
        f"case event_type {level} end as level",
        "concat(event_type, ' value=', cast(value as string)) as text",
    )


def _hourly_clocks(events: DataFrame) -> DataFrame:
    """``(node_idx, hour, c0..c3)``: what a node knows of each node in that hour.

    Works on totals per node and hour, never on pairs of events.
    """
    hours = events.groupBy("node_idx", "hour").agg(F.count(F.lit(1)).alias("n"))
    stops = hours.selectExpr("node_idx", "hour as at", "0 as kind", "n")
    lags = ", ".join(f"struct({j} as j, hour - {LAG_HOURS} * abs(node_idx - {j}) as at)" for j in range(NODES))
    asks = hours.selectExpr("node_idx as to_node", "hour", "1 as kind", f"inline(array({lags}))")
    seen = "over (partition by node_idx order by at, kind rows between unbounded preceding and current row)"
    answers = (
        stops.unionByName(asks.withColumnRenamed("j", "node_idx"), allowMissingColumns=True)
        .selectExpr("*", f"coalesce(sum(n) {seen}, 0L) as known")
        .where("kind = 1")
    )
    cells = [F.expr(f"max(if(node_idx = {j}, known, null)) as c{j}") for j in range(NODES)]
    return answers.groupBy(F.col("to_node").alias("node_idx"), "hour").agg(*cells)


def causal_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    numbered = number_rows(
        events.withColumn("block", chunk_of("event_id")), ["node_idx"], ["hour", "block"], ["event_id"], "seq"
    )
    vc = ", ".join(f"if(node_idx = {j}, seq + 1, c{j})" for j in range(NODES))
    skew = ", ".join(f"{h * HOUR_MS}L" for h in SKEW_HOURS)
    log = numbered.join(_hourly_clocks(events), ["node_idx", "hour"]).selectExpr(
        "event_id",
        "user_id",
        "node_id",
        "node_idx",
        f"array({vc}) as vc",
        f"at_ms + get(array({skew}), node_idx) as ts_ms",
        "level",
        "text as message",
        "map('trace_id', cast(user_id as string), 'k', get_json_object(props, '$.k')) as metadata",
        "seq",
        "to_date(ts) as log_date",
    )
    return settled(log, ["vc"])


def lossy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The causal log after losing every tenth entry: clocks have gaps."""
    return causal_log(spark, sf_dir).where(F.pmod("event_id", F.lit(10)) != 3)


def restamped_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The causal log as written by nodes that all tick component 0."""
    clock = F.array(F.col("seq") + 1, *[F.lit(0).cast("bigint")] * (NODES - 1))
    return causal_log(spark, sf_dir).withColumn("vc", clock)


def incomplete_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The causal log where node 2 forgets a hundred entries of node 1 at times, and node 0 leaves out what it heard of node 3 on some days."""
    forgets = "if(event_id % 40 = 6, greatest(vc[1] - 100, 0L), vc[1])"
    deaf = "if(day(log_date) % 3 = 0, 0L, vc[3])"
    vc = f"case node_idx when 2 then array(vc[0], {forgets}, vc[2], vc[3]) when 0 then array(vc[0], vc[1], vc[2], {deaf}) else vc end"
    return settled(causal_log(spark, sf_dir).withColumn("vc", F.expr(vc)), ["vc"])


def unlisted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The causal log with the last node unknown, and with every fiftieth clock cut short."""
    log = causal_log(spark, sf_dir)
    short = F.when(F.pmod("event_id", F.lit(50)) == 7, F.slice("vc", 1, NODES - 1)).otherwise(F.col("vc"))
    return log.withColumns({"node_idx": F.when(F.col("node_idx") < NODES - 1, F.col("node_idx")), "vc": short})


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw line per event in six shapes, one file per node and day."""
    at = F.timestamp_millis("at_ms")
    shapes = [
        F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(" "), "level", F.lit("  "), "text"),
        F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" "), F.lower("level"), F.lit(" "), "text"),
        F.concat(F.lit("["), "level", F.lit("] "), "text"),
        F.concat("level", F.lit(": "), "text"),
        F.col("text"),
        F.lit(""),
    ]
    shape = F.pmod("event_id", F.lit(len(shapes)))
    line = F.coalesce(*[F.when(shape == i, text) for i, text in enumerate(shapes)])
    raw = _events(spark, sf_dir).select(
        "event_id",
        "node_id",
        F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(".log")).alias("file"),
        F.col("event_id").alias("line_no"),
        line.alias("line"),
        (F.col("at_ms") + 1000).alias("ingest_ts"),
    )
    return settled(raw, ["line"])


def node_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(node_id, node_idx)`` of the nodes that occur."""
    return _events(spark, sf_dir).groupBy("node_id", "node_idx").agg(F.count(F.lit(1)).alias("n")).drop("n")


def jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical JSON text of the causal log, every 17th record damaged."""
    log = causal_log(spark, sf_dir).withColumn("good", entries.to_json())
    good = F.col("good")
    damaged = [
        F.expr("substring(good, 1, length(good) - 20)"),
        F.concat(F.lit("not json "), good),
        F.regexp_replace(good, r'"timestamp":\d+', '"timestamp":9223372036854775808'),
        F.regexp_replace(good, r'"vector_clock":\{[^}]*\}', '"vector_clock":"lost"'),
        F.regexp_replace(good, r'"vector_clock":\{', '"vector_clock":{"node-0":0,'),
        F.regexp_replace(good, r'"vector_clock":\{', '"vector_clock":{"peer-0":1,'),
        F.regexp_replace(good, r'^\{', '{"host":"h1",'),
        F.regexp_replace(good, r'"level":"[A-Z]+",', ""),
    ]
    kind = F.pmod(F.call_function("div", F.col("event_id"), F.lit(17)), F.lit(len(damaged))).cast("int")
    hurt = F.coalesce(*[F.when(kind == i, text) for i, text in enumerate(damaged)])
    line = F.when(F.pmod("event_id", F.lit(17)) == 0, hurt).otherwise(good)
    damaged_log = log.select("event_id", F.col("node_id").alias("source_node"), "log_date", line.alias("line"))
    return settled(damaged_log, ["line"])


def message_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as events of eight nodes, numbered per node."""
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("event"),
        F.pmod(F.col("conv_id") + 3 * F.col("turn"), F.lit(TRACE_NODES)).cast("int").alias("node_idx"),
        "turn",
        "conv_id",
    )
    numbered = number_rows(
        turns.withColumn("block", chunk_of("conv_id")), ["node_idx"], ["turn", "block"], ["conv_id"], "seq"
    )
    return numbered.select("event", "node_idx", "seq")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn is a message to the next turn of its conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    sent = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.lit(1).alias("sent"))
    event = F.col("conv_id") * 1000 + F.col("turn")
    return turns.join(sent, ["conv_id", "turn"]).select((event - 1).alias("send_event"), event.alias("recv_event"))


def search_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), F.col("text").alias("message"))
