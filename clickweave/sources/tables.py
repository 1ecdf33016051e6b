"""Readers, writers and stores: files in, files out, nothing on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.sources.partitions import has_files, list_folders


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.DataType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True, sep: str = ",", **options
) -> DataFrame:
    """Declared types, no inference pass; quotes are doubled inside quoted text, blanks are kept."""
    reader = spark.read.schema(_schema(schema)).option("header", header).option("sep", sep)
    reader = reader.option("quote", '"').option("escape", '"')
    return reader.options(**options).csv(path)


def read_headless_csv(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",") -> DataFrame:
    return read_csv(spark, path, schema, header=False, sep=sep)


def read_tsv(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = False) -> DataFrame:
    return read_csv(spark, path, schema, header=header, sep="\t")


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(_schema(schema))
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_records(
    spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, label: str | None = None, strict: bool = True
) -> DataFrame:
    """Fixed-length records: every declared column present in each row, the label last.

    With ``strict`` a missing value is an error raised where it is read.
    """
    want = _schema(schema)
    df = read_parquet(spark, paths, want)
    names = [f.name for f in want.fields if f.name != label] + ([label] if label else [])
    if not strict:
        return df.select(*names)
    return df.select(
        *[
            F.when(F.col(n).isNotNull(), F.col(n)).otherwise(F.raise_error(F.lit(f"record without {n}"))).alias(n)
            for n in names
        ]
    )


def feed(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """What a model is fed: the features, and the label when there is one."""
    return df.select(*features, *([label] if label else []))


def flatten_rows(df: DataFrame, column: str) -> DataFrame:
    """Lists of row structs to rows."""
    return df.select(F.inline(column))


def sample_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First rows in a stated order (a partial top-n per task)."""
    return df.orderBy(*order).limit(n)


def write_store(df: DataFrame, path: str, version: str, partition_by: Sequence[str] = ()) -> str:
    """One folder per version; writing a version again replaces only it."""
    target = f"{path.rstrip('/')}/version={version}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target) if partition_by else df.write.mode(
        "overwrite"
    ).parquet(target)
    return target


def read_store(spark: SparkSession, path: str, schema: str | T.StructType, version: str | None = None) -> DataFrame:
    """Rows of one version; by default the newest: the largest number where all versions are numbers, else the last text."""
    if version is None:
        # listed, not read: no data file is opened to find the newest version
        found = {v: f for v, f in list_folders(spark, path, "version").items() if has_files(spark, f)}
        if not found:
            raise ValueError(f"no version under {path}")
        version = max(found, key=int) if all(v.lstrip("-").isdigit() for v in found) else max(found)
        return spark.read.schema(_schema(schema)).parquet(found[version])
    want = T.StructType([*_schema(schema).fields, T.StructField("version", T.StringType())])
    return spark.read.schema(want).parquet(path).where(F.col("version") == version).drop("version")


def write_predictions(df: DataFrame, path: str, partition_by: Sequence[str] = ("dt", "hour")) -> None:
    """Scores by date and hour, few files each; only the partitions in ``df`` are replaced.

    The rebalance hint brings rows of a partition together and lets adaptive
    execution split a partition that is too large for one task.
    """
    out = df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(*partition_by).parquet(path)
