"""Session defaults and the shared folder for intermediate tables."""

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
# Where ``collected`` keeps the paths handed out, by thread of control.
_COLLECTED: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("collected", default=())


def local_session(cores: int | str = "*", app: str = "causal_logs", **conf) -> SparkSession:
    """A local session with the settings the jobs assume (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Longer generated methods are not compiled by the JVM.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Call sites of every column cost a round trip to the JVM each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, one per application.

    ``spark.checkpoint.dir`` names it. Only a local session may leave that
    unset; it then gets a temporary folder.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/causal_logs-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="causal_logs-")
    return _LOCAL_DIRS[app]


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _COLLECTED.get():
        paths.append(path)
    return path


@contextlib.contextmanager
def collected() -> Iterator[list[str]]:
    """The paths that ``new_path`` hands out inside, in order; for ``release``."""
    paths: list[str] = []
    token = _COLLECTED.set((*_COLLECTED.get(), paths))
    try:
        yield paths
    finally:
        _COLLECTED.reset(token)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the stored table.

    Used where several branches of a plan read the same result: each of them
    then scans only its own columns, no branch recomputes the rest, and a lost
    executor costs a re-read.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: list[str], *keep: DataFrame) -> None:
    """Remove what lies at ``paths`` (see ``collected``), but for what ``keep`` reads.

    For use once the results that rest on it are stored elsewhere or no longer wanted.
    """
    read = [f for df in keep for f in df.inputFiles()]
    for path in paths:
        if not any(f"/{path.rsplit('/', 1)[1]}/" in f for f in read):
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
