"""Impression and behaviour tables built from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickweave.operators.joins import BROADCAST_ROWS

# fixed values: the fields of the click model on the test tables
SPARSE = ["p_brand", "p_type", "c_mktsegment", "o_orderpriority", "o_orderstatus", "n_name"]
DENSE = ["l_quantity", "l_discount", "o_totalprice"]
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
LINE = [*KEY, "l_quantity", "l_discount", "l_returnflag", "l_linestatus"]
PART = ["p_brand", "p_type"]
GROUPS = {
    "item": ["p_brand", "p_type"],
    "user": ["c_mktsegment"],
    "context": ["o_orderpriority", "o_orderstatus", "n_name"],
}


_schemas: dict[str, StructType] = {}
_counts: dict[str, int] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The file's schema is read once; later scans declare it and start no footer job."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def rows_of(spark: SparkSession, sf_dir: str, table: str) -> int:
    """Row count from the Parquet footers, kept per folder."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _counts:
        _counts[path] = read(spark, sf_dir, table).count()
    return _counts[path]


def spread(df: DataFrame, key: list[str]) -> DataFrame:
    """Input with fewer splits than cores (one unsplittable row group) is dealt out by its key.

    A large table has more splits than cores and is left where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *key)


def impressions(spark: SparkSession, sf_dir: str, extra: list[str] | None = None) -> DataFrame:
    """One row per line item with its fields and both labels.

    Only declared columns are selected, so each scan reads just those. A dimension
    whose row count (from the footers) is below the broadcast bound is broadcast;
    a larger one is joined by shuffle, where adaptive execution splits skewed keys.
    """

    def dimension(df: DataFrame, table: str) -> DataFrame:
        return F.broadcast(df) if rows_of(spark, sf_dir, table) <= BROADCAST_ROWS else df

    line = spread(read(spark, sf_dir, "lineitem").select(*LINE), KEY)
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    part = dimension(read(spark, sf_dir, "part").select("p_partkey", *PART, *(extra or [])), "part")
    customer = dimension(read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "customer")
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = dimension(read(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "nation")
    sellers = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    sellers = dimension(sellers, "supplier")
    buyers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    buyers = dimension(buyers, "orders")
    return (
        line.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            *KEY,
            *SPARSE,
            *DENSE,
            (F.col("l_returnflag") == "R").cast("int").alias("label"),
            (F.col("l_linestatus") == "O").cast("int").alias("label2"),
            *(extra or []),
        )
    )
