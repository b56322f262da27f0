"""Table schemas and the fixed values of the log data model."""

from pyspark.sql import types as T

# Fixed values of the data model.
LEVELS = ("DEBUG", "INFO", "WARN", "ERROR", "FATAL")
DEFAULT_LEVEL = "INFO"
MAX_NODES = 32
MAX_METADATA = 8
MAX_MESSAGE_BYTES = 1023
MAX_RECORD_BYTES = 4095
EQUAL = "EQUAL"
HAPPENS_BEFORE = "HAPPENS_BEFORE"
HAPPENS_AFTER = "HAPPENS_AFTER"
CONCURRENT = "CONCURRENT"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.StringType()),
        T.StructField("node_idx", T.IntegerType()),
        T.StructField("vc", T.ArrayType(T.LongType(), False)),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("seq", T.LongType()),
        T.StructField("log_date", T.DateType()),
    ]
)

# Numbers and the clock stay text here, so that a bad one can be told from a
# broken record; see sources.jsonl.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.StringType()),
        T.StructField("vector_clock", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
