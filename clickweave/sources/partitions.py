"""Picking the newest ``dt=/hour=`` partition; order is text order.

Where the folder is known, the file system is listed and no data file is opened to find the newest one.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_partitioned(spark: SparkSession, path: str, schema: str, keys: tuple[str, ...] = ("dt", "hour")) -> DataFrame:
    """Partition columns are read as text, so '07' stays '07'; marker files are skipped by the scan."""
    fields = [*T.DataType.fromDDL(schema).fields, *[T.StructField(k, T.StringType()) for k in keys]]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def latest_partition(df: DataFrame, dt: str = "dt", hour: str | None = "hour") -> DataFrame:
    """Largest date, then the largest hour inside it; only partition columns are read to find them."""
    last_dt = df.agg(F.max(dt)).first()[0]
    if last_dt is None:
        raise ValueError("no partition found")
    day = df.where(F.col(dt) == last_dt)
    if hour is None:
        return day
    last_hour = day.agg(F.max(hour)).first()[0]
    return day if last_hour is None else day.where(F.col(hour) == last_hour)


def latest_partition_by_key(df: DataFrame, dt: str = "dt", hour: str = "hour") -> DataFrame:
    """The older rule: date and hour of the largest key, found in one aggregation."""
    top = df.agg(F.max(F.struct(dt, hour)).alias("k")).first()["k"]
    if top is None:
        raise ValueError("no partition found")
    return df.where((F.col(dt) == top[0]) & (F.col(hour) == top[1]))


def list_folders(spark: SparkSession, path: str, key: str) -> dict[str, str]:
    """Value of ``key=value`` -> its folder, as the session's file system lists them."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    out = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(key + "="):
            out[unquote(name[len(key) + 1 :])] = status.getPath().toString()
    return out


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a data file lies in the folder or below; markers and files being written do not count."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")) and (not status.isDirectory() or has_files(spark, status.getPath().toString())):
            return True
    return False


def read_newest(spark: SparkSession, path: str, schema: str, keys: tuple[str, ...] = ("dt", "hour")) -> DataFrame:
    """The newest partition, key by key: the largest date, then the largest hour inside it. Empty folders are passed over."""
    folder = path
    for key in keys:
        found = list_folders(spark, folder, key)
        newest = next((v for v in sorted(found, reverse=True) if has_files(spark, found[v])), None)
        if newest is None:
            if folder == path:
                raise ValueError(f"no {key}= folder under {path}")
            break
        folder = found[newest]
    fields = [*T.DataType.fromDDL(schema).fields, *[T.StructField(k, T.StringType()) for k in keys]]
    return spark.read.schema(T.StructType(fields)).option("basePath", path).parquet(folder)
