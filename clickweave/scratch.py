"""Shared scratch tables: cut lineage by writing to the cluster's checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: While a table is written: the shuffles behind it go when the write ends, since the table replaces them, and batches for
#: Python workers are bounded by their bytes (rows alone bound nothing where texts are long).
WRITING = {CLEANUP: "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for local masters."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        _local_roots[app] = tempfile.mkdtemp(prefix="clickweave-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str = "t") -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame, name: str = "t") -> DataFrame:
    """Write once to shared storage and read back: short lineage, real size statistics."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = {name: spark.conf.get(name, None) for name in WRITING}
    try:
        for setting, value in WRITING.items():
            spark.conf.set(setting, value)
        df.write.mode("error").parquet(path)
    finally:
        for setting, was in before.items():
            spark.conf.set(setting, was) if was is not None else spark.conf.unset(setting)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[id(out)] = (weakref.ref(out), path)
    return out


_paths: dict[int, tuple[weakref.ref, str]] = {}


def release(*pinned: DataFrame) -> None:
    """Drop the files of tables that ``pin`` gave and that no later plan reads."""
    for df in pinned:
        known, path = _paths.pop(id(df), (lambda: None, ""))
        if known() is df:
            jvm = df.sparkSession.sparkContext._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
