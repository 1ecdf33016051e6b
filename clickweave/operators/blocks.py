"""Global order without a global window: range blocks, then small offsets.

A window over a whole table, or over one hot group, is one task. Here the rows
are range partitioned on the full order key, each block is written once, and
only per-block totals are windowed. Block and position are stored columns, so a
lost executor or a second reader sees the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.scratch import pin

# position inside a task, as documented for monotonically_increasing_id
_LOW_BITS = (1 << 33) - 1


def block_count(df: DataFrame) -> int:
    """``clickweave.blocks`` of the session, else enough blocks for every core.

    Set it so that a block of the sorted table fits a task (rows / 10 million, say).
    """
    spark = df.sparkSession
    asked = spark.conf.get("clickweave.blocks", None)
    if asked:
        return int(asked)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def ordered_blocks(df: DataFrame, order: list[Column], blocks: int | None = None) -> DataFrame:
    """Rows with ``_block`` (range block in global order) and ``_pos`` (0.. within it)."""
    if {"_block", "_pos"} & set(df.columns):
        raise ValueError("_block and _pos are added here")
    n = blocks or block_count(df)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = ranged.withColumn("_block", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))
    )
    return pin(placed, "blocks")


def with_prefix(blocked: DataFrame, totals: dict[str, Column], group: list[str] | None = None) -> DataFrame:
    """Add, per block and group, the sums of ``totals`` over all earlier blocks.

    Groups are declared names (fields, tasks) that lead the order key: the table
    of totals has at most blocks + groups rows, and its window runs per group
    over blocks only.
    """
    group = group or []
    per_block = blocked.groupBy(*group, "_block").agg(*[F.sum(c).alias(f"_sum_{k}") for k, c in totals.items()])
    w = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        *group,
        "_block",
        *[F.coalesce(F.sum(f"_sum_{k}").over(w), F.lit(0)).alias(f"_before_{k}") for k in totals],
    )
    return blocked.join(F.broadcast(offsets), [*group, "_block"])


def global_rank(
    df: DataFrame,
    order: list[Column],
    name: str,
    group: list[str] | None = None,
    blocks: int | None = None,
    few_groups: bool = True,
) -> DataFrame:
    """0-based rank in ``order``, within ``group`` if given.

    ``few_groups`` says that groups are declared names (fields, tasks), so the
    table of starts has at most blocks + groups rows and is broadcast.
    """
    blocked = ordered_blocks(df, [*[F.col(g) for g in group or []], *order], blocks)
    return rank_in_blocks(blocked, name, group, few_groups)


def rank_in_blocks(blocked: DataFrame, name: str, group: list[str] | None = None, few_groups: bool = True) -> DataFrame:
    """``global_rank`` of rows that ``ordered_blocks`` has put in order of their group and the order key."""
    if not group:
        ranked = with_prefix(blocked, {"rows": F.lit(1)})
        return ranked.withColumn(name, F.col("_before_rows") + F.col("_pos")).drop("_block", "_pos", "_before_rows")
    # first position of each group in each block, then rank inside the block by subtraction
    firsts = blocked.groupBy(*group, "_block").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    w = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = firsts.select(
        *group, "_block", (F.coalesce(F.sum("_rows").over(w), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    starts = F.broadcast(starts) if few_groups else starts
    return (
        blocked.join(starts, [*group, "_block"])
        .withColumn(name, F.col("_pos") + F.col("_shift"))
        .drop("_block", "_pos", "_shift")
    )


def key_at(df: DataFrame, order: list[str], position: int) -> tuple | None:
    """The order key found at a 0-based global position.

    Only key columns are sorted. One count per block tells which block holds the
    position, and only that block is read again.
    """
    blocked = ordered_blocks(df.select(*order), [F.col(c) for c in order])
    before = 0
    for r in blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).orderBy("_block").collect():
        if position < before + r["n"]:
            here = (F.col("_block") == r["_block"]) & (F.col("_pos") == position - before)
            return tuple(blocked.where(here).select(*order).first())
        before += r["n"]
    return None
