"""Evaluation: everything is one or two aggregations, ranks included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.scalars import clip, log_loss_term
from clickweave.operators.blocks import ordered_blocks, with_prefix

LOOSE_EPS = 1e-7


def _avg(term: Column, weight: Column | None) -> Column:
    return F.avg(term) if weight is None else F.sum(term * weight) / F.sum(weight)


def log_loss(y: Column, p: Column, eps: float = 1e-15, weight: Column | None = None) -> Column:
    return _avg(log_loss_term(y, p, eps), weight)


def mse(y: Column, p: Column, weight: Column | None = None) -> Column:
    return _avg((y - p) * (y - p), weight)


def mae(y: Column, p: Column, weight: Column | None = None) -> Column:
    return _avg(F.abs(y - p), weight)


def accuracy(y: Column, p: Column, weight: Column | None = None) -> Column:
    """Exactly 0.5 counts as negative."""
    return _avg(((p > 0.5).cast("int") == y).cast("double"), weight)


def calibration(y: Column, p: Column) -> list[Column]:
    return [
        F.avg(p).alias("prediction_mean"),
        F.avg(y.cast("double")).alias("label_mean"),
        (F.avg(p) / F.avg(y.cast("double"))).alias("ratio"),
    ]


def roc_auc(
    df: DataFrame, y: str, p: str, group: Sequence[str] = (), weight: str | None = None, blocks: int | None = None
) -> DataFrame:
    """Exact area under the curve, ties counting a half; one row per group.

    Scores are counted first (a score shared by any number of rows is one row
    after the map side), then ordered in range blocks, so neither one score nor
    one group is a single task. Null when a class is missing; rows without a label
    are of neither class.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    counts = df.groupBy(*group, F.col(p).alias("_p")).agg(
        F.sum(F.when(F.col(y) == 1, w).otherwise(F.lit(0.0))).alias("_hits"),
        F.sum(F.when(F.col(y) != 1, w).otherwise(F.lit(0.0))).alias("_miss"),
    )
    order = [F.col(g) for g in group] + [F.col("_p")]
    placed = with_prefix(ordered_blocks(counts, order, blocks), {"miss": F.col("_miss")}, list(group))
    inside = Window.partitionBy(*group, "_block").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_before_miss") + F.coalesce(F.sum("_miss").over(inside), F.lit(0.0))
    area = placed.withColumn("_below", below).groupBy(*group).agg(
        F.sum(F.col("_hits") * (F.col("_below") + 0.5 * F.col("_miss"))).alias("_area"),
        F.sum("_hits").alias("_np"),
        F.sum("_miss").alias("_nn"),
    )
    return area.select(*group, F.try_divide(F.col("_area"), F.col("_np") * F.col("_nn")).alias("auc"))


def threshold_auc(df: DataFrame, y: str, p: str, thresholds: int = 200, group: Sequence[str] = ()) -> DataFrame:
    """Area from a fixed number of thresholds: a histogram and its trapezoids, no sort of scores.

    Thresholds are ``-eps, 1/(n-1), ..., 1+eps``; a row is positive above a threshold.
    """
    n = thresholds
    # number of thresholds strictly below the score, thresholds in ascending order
    bin_ = F.when(F.col(p) <= 0, F.lit(1)).when(F.col(p) >= 1, F.lit(n - 1)).otherwise(
        F.ceil(F.col(p) * (n - 1)).cast("int")
    )
    hist = df.groupBy(*group, bin_.alias("_bin")).agg(
        F.sum((F.col(y) == 1).cast("bigint")).alias("_pos"), F.sum((F.col(y) != 1).cast("bigint")).alias("_neg")
    )
    # at most `thresholds` rows per group from here on
    w = Window.partitionBy(*group).orderBy("_bin")
    up = w.rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(up), F.lit(0))
    area = hist.withColumn("_below", below).groupBy(*group).agg(
        F.sum(F.col("_pos") * (F.col("_below") + 0.5 * F.col("_neg"))).alias("_area"),
        F.sum("_pos").alias("_np"),
        F.sum("_neg").alias("_nn"),
    )
    return area.select(*group, F.try_divide(F.col("_area"), F.col("_np") * F.col("_nn")).alias("auc"))


def loss_per_sample(df: DataFrame, y: str, p: str, penalty: float, batch_size: int) -> DataFrame:
    """Summed loss plus one penalty per batch, divided by the samples."""
    n = F.count(F.lit(1))
    batches = F.ceil(n / F.lit(float(batch_size)))
    total = F.sum(log_loss_term(F.col(y), F.col(p)))
    return df.agg(((total + batches * F.lit(float(penalty))) / n).alias("loss"))


def mean_of_batches(df: DataFrame, batch: str | Column, metrics: dict[str, Column]) -> DataFrame:
    """Unweighted mean over batches: a short last batch counts as much as a full one."""
    key = F.col(batch) if isinstance(batch, str) else batch
    per = df.groupBy(key.alias("_batch")).agg(*[m.alias(k) for k, m in metrics.items()])
    return per.agg(*[F.avg(k).alias(k) for k in metrics])


def task_metrics(df: DataFrame, tasks: dict[str, tuple[str, str]], blocks: int | None = None) -> DataFrame:
    """``task, log_loss, auc`` for several (label, score) pairs of one table."""
    entries = F.array(
        *[
            F.struct(F.lit(t).alias("task"), F.col(y).cast("int").alias("y"), F.col(p).cast("double").alias("p"))
            for t, (y, p) in tasks.items()
        ]
    )
    long = df.select(F.inline(entries))
    losses = long.groupBy("task").agg(log_loss(F.col("y"), F.col("p")).alias("log_loss"))
    return losses.join(F.broadcast(roc_auc(long, "y", "p", ["task"], blocks=blocks)), "task")


def evaluate(df: DataFrame, y: str, p: str, blocks: int | None = None) -> dict[str, float]:
    """All metrics as a dict: one wide aggregation and one ranked one."""
    a, b = F.col(y), F.col(p)
    row = df.agg(
        log_loss(a, b).alias("log_loss"),
        log_loss(a, b, LOOSE_EPS).alias("log_loss_loose"),
        mse(a, b).alias("mse"),
        mae(a, b).alias("mae"),
        accuracy(a, b).alias("accuracy"),
        *calibration(a, b),
    ).first()
    return {**row.asDict(), "auc": roc_auc(df, y, p, blocks=blocks).first()["auc"]}


def penalties(weights: DataFrame, strengths: DataFrame) -> DataFrame:
    """``weights(name, value)`` and ``strengths(name, l1, l2)`` to the penalty per name."""
    sums = weights.groupBy("name").agg(
        F.sum(F.abs("value")).alias("_a"), F.sum(F.col("value") * F.col("value")).alias("_q")
    )
    return sums.join(strengths, "name").select(
        "name", (F.col("l1") * F.col("_a") + F.col("l2") * F.col("_q")).alias("penalty")
    )


__all__ = [
    "LOOSE_EPS", "accuracy", "calibration", "clip", "evaluate", "log_loss", "loss_per_sample", "mae",
    "mean_of_batches", "mse", "penalties", "roc_auc", "task_metrics", "threshold_auc",
]
