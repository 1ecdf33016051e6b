import math
import random

import pytest
from pyspark.sql import functions as F

from clickweave.operators import metrics as M


def brute_auc(rows):
    pos = [p for y, p in rows if y]
    neg = [p for y, p in rows if not y]
    return sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / (len(pos) * len(neg))


def one(df, c):
    return df.agg(c).first()[0]


def test_fixture_values(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.8), (1, 0.6), (0, 0.2)], "y int, p double")
    assert M.roc_auc(df, "y", "p").first()["auc"] == 0.625
    half = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, p double")
    assert one(half, M.accuracy(F.col("y"), F.col("p"))) == 0.5
    assert one(half, M.log_loss(F.col("y"), F.col("p"))) == pytest.approx(math.log(2))
    sure = spark.createDataFrame([(1, 0.0)], "y int, p double")
    assert one(sure, M.log_loss(F.col("y"), F.col("p"), M.LOOSE_EPS)) == pytest.approx(-math.log(1e-7))


@pytest.mark.parametrize("blocks", [1, 3, 16])
def test_auc_with_ties_and_a_heavy_score(spark, blocks):
    rng = random.Random(1)
    rows = [(int(rng.random() < 0.4), 0.5 if i % 3 == 0 else round(rng.random(), 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "y int, p double")
    assert M.roc_auc(df, "y", "p", blocks=blocks).first()["auc"] == pytest.approx(brute_auc(rows))


def test_auc_per_group_and_missing_class(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.2), ("b", 0, 0.4), ("c", 1, 0.3)]
    df = spark.createDataFrame(rows, "g string, y int, p double")
    assert {r["g"]: r["auc"] for r in M.roc_auc(df, "y", "p", ["g"], blocks=3).collect()} == {"a": 1.0, "b": 0.0, "c": None}


def test_threshold_auc_is_near_the_exact_one(spark):
    rng = random.Random(2)
    rows = [(int(rng.random() < p), p) for p in (rng.random() for _ in range(2000))]
    df = spark.createDataFrame(rows, "y int, p double")
    assert M.threshold_auc(df, "y", "p").first()["auc"] == pytest.approx(brute_auc(rows), abs=2e-3)
    coarse = [(y, float(math.ceil(p * 199))) for y, p in rows]
    assert M.threshold_auc(df, "y", "p").first()["auc"] == pytest.approx(brute_auc(coarse))


def test_weighted_metrics_equal_repeated_rows(spark):
    df = spark.createDataFrame([(1, 0.7, 3.0), (0, 0.4, 1.0)], "y int, p double, w double")
    rep = spark.createDataFrame([(1, 0.7)] * 3 + [(0, 0.4)], "y int, p double")
    y, p, w = F.col("y"), F.col("p"), F.col("w")
    for m in (M.log_loss, M.mse, M.mae, M.accuracy):
        assert one(df, m(y, p, weight=w)) == pytest.approx(one(rep, m(y, p)))
    assert M.roc_auc(df, "y", "p", weight="w").first()[0] == M.roc_auc(rep, "y", "p").first()[0]


def test_batch_means_and_penalty(spark):
    df = spark.createDataFrame([(0, 1, 0.5), (0, 1, 0.5), (1, 1, 1.0)], "b int, y int, p double")
    got = M.mean_of_batches(df, "b", {"mse": M.mse(F.col("y"), F.col("p"))}).first()["mse"]
    assert got == pytest.approx((0.25 + 0.0) / 2)
    loss = M.loss_per_sample(df, "y", "p", 0.3, 2).first()[0]
    assert loss == pytest.approx((2 * math.log(2) + 2 * 0.3) / 3, abs=1e-9)
    w = spark.createDataFrame([("a", -2.0), ("a", 1.0)], "name string, value double")
    s = spark.createDataFrame([("a", 0.1, 0.01)], "name string, l1 double, l2 double")
    assert M.penalties(w, s).first()["penalty"] == pytest.approx(0.35)


def test_evaluate_returns_everything(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.8), (1, 0.6), (0, 0.2)], "y int, p double")
    got = M.evaluate(df, "y", "p")
    assert got["auc"] == 0.625 and got["accuracy"] == 0.75 and got["ratio"] == pytest.approx(0.6 / 0.5)
    tasks = M.task_metrics(df.withColumn("z", 1 - F.col("y")), {"a": ("y", "p"), "b": ("z", "p")})
    assert {r["task"]: r["auc"] for r in tasks.collect()} == {"a": 0.625, "b": 0.375}


def test_auc_leaves_out_rows_without_a_label(spark):
    rows = [("a", 1, 0.9), ("a", None, 0.95), ("a", 0, 0.1), ("b", None, 0.5)]
    df = spark.createDataFrame(rows, "g string, y int, p double")
    assert {r["g"]: r["auc"] for r in M.roc_auc(df, "y", "p", ["g"]).collect()} == {"a": 1.0, "b": None}
