"""Folders of numbered results, by the file system that holds them."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the folders ``path/name=n`` that hold a finished write."""
    place, files = _at(spark, path)
    if not files.exists(place):
        return []
    found = [str(s.getPath().getName()) for s in files.listStatus(place) if s.isDirectory()]
    numbers = [int(f.split("=", 1)[1]) for f in found if f.startswith(f"{name}=")]
    return sorted(n for n in numbers if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}={n}/_SUCCESS")))


def remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place, files = _at(spark, path)
        files.delete(place, True)


def escaped(spark: SparkSession, value: str | None) -> str:
    """A value as it stands in the name of a partition's folder."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
