"""Versioned learner state: a base table and small per-batch deltas.

A batch rewrites only the keys it touched. Reading the state for a batch first
keeps the keys of that batch (broadcast when their number passes the size check)
and then takes the newest version of each, so the full state is scanned but
never shuffled or rewritten. A replayed batch overwrites its own version.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.joins import fits_broadcast

SCHEMA = "key string, w double, z double, n double, v array<double>, zf array<double>, nf double"
BIAS = "__bias__"


class LearnerState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _read(self, kind: str) -> DataFrame:
        schema = f"{SCHEMA}, version bigint"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def base_version(self, before: int) -> int:
        row = self._read("base").where(F.col("version") < before).agg(F.max("version")).first()
        return -1 if row[0] is None else row[0]

    def as_of(self, before: int, keys: DataFrame | None = None, fits: bool | None = None) -> DataFrame:
        """Newest value of each key among versions below ``before``; ``fits`` if ``keys`` are known to be few."""
        base = self.base_version(before)
        rows = self._read("base").where(F.col("version") == base)
        deltas = self._read("delta").where((F.col("version") > base) & (F.col("version") < before))
        every = rows.unionByName(deltas)
        if keys is not None:
            small = keys.select("key")
            fits = fits_broadcast(small) if fits is None else fits
            every = every.join(F.broadcast(small) if fits else small, ["key"], "left_semi")
        cols = ["w", "z", "n", "v", "zf", "nf"]
        newest = every.groupBy("key").agg(F.max_by(F.struct(*cols), "version").alias("s"))
        return newest.select("key", *[F.col(f"s.{c}").alias(c) for c in cols])

    def write(self, version: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/delta/version={version}")

    def compact(self, through: int) -> None:
        """New base holding everything up to and with version ``through``."""
        full = self.as_of(through + 1)
        full.write.mode("overwrite").parquet(f"{self.path}/base/version={through}")

    def latest(self) -> DataFrame:
        return self.as_of(1 << 62)
