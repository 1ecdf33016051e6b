"""Registered queries: evaluation, penalties, fits and run logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.functions.scalars import rounded
from clickweave.operators import metrics as M
from clickweave.operators.embedding import attach, deep_input
from clickweave.plans import training as TR
from clickweave.plans.catalog import ENC, IMP, r6, register, sql_weight, stored_model
from clickweave.plans.impressions import DENSE, SPARSE, impressions, read
from clickweave.scratch import pin

PRED = """pr AS (SELECT l.doc_id, quality AS y, toxic AS y2, n_chars / (n_chars + 500e0) AS p, CAST(n_chars % 7 + 1 AS DOUBLE) AS wt
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def predictions(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "n_chars")
    df = read(spark, sf, "labels").join(d, "doc_id")
    return df.select(
        "doc_id", F.col("quality").alias("y"), F.col("toxic").alias("y2"),
        (F.col("n_chars") / (F.col("n_chars") + 500.0)).alias("p"), (F.col("n_chars") % 7 + 1).cast("double").alias("wt"),
    )


def _clip(eps: str) -> str:
    return f"least(greatest(p, {eps}), 1e0 - {eps})"


def _ll(y: str = "y", eps: str = "1e-15") -> str:
    return f"-({y}*ln({_clip(eps)}) + (1-{y})*ln(1e0-{_clip(eps)}))"


LOOSE = _ll(eps="1e-7")
TOXIC = _ll("y2")


def auc_sql(y: str, source: str = "pr", p: str = "p") -> str:
    return (
        f"(SELECT (sum(CASE WHEN {y} = 1 THEN rk END) - sum({y}) * (sum({y}) + 1) / 2e0) / (sum({y}) * sum(1 - {y})) FROM "
        f"(SELECT {y}, rank() OVER (ORDER BY {p}) + (count(*) OVER (PARTITION BY {p}) - 1) / 2e0 AS rk FROM {source}))"
    )


@register("m1_log_loss", f"WITH {PRED} SELECT {r6(f'avg({_ll()})')} AS log_loss, {r6(f'avg({LOOSE})')} AS loose FROM pr")
def m1(spark, sf):
    y, p = F.col("y"), F.col("p")
    return predictions(spark, sf).agg(rounded(M.log_loss(y, p)).alias("log_loss"), rounded(M.log_loss(y, p, M.LOOSE_EPS)).alias("loose"))


@register("m2_roc_auc", f"WITH {PRED} SELECT {r6(auc_sql('y'))} AS auc")
def m2(spark, sf):
    return M.roc_auc(predictions(spark, sf), "y", "p").select(rounded(F.col("auc")).alias("auc"))


@register("m2_roc_auc_impressions", f"WITH {IMP} SELECT {r6(auc_sql('label', 'imp', 'o_totalprice'))} AS auc")
def m2_impressions(spark, sf):
    df = impressions(spark, sf).select("label", "o_totalprice")
    return M.roc_auc(df, "label", "o_totalprice").select(rounded(F.col("auc")).alias("auc"))


@register(
    "m3_threshold_auc",
    f"WITH {PRED}, b AS (SELECT y, CASE WHEN p <= 0 THEN 1 WHEN p >= 1 THEN 199 ELSE ceil(p * 199) END AS bin FROM pr) SELECT {r6(auc_sql('y', 'b', 'bin'))} AS auc",
)
def m3(spark, sf):
    return M.threshold_auc(predictions(spark, sf), "y", "p").select(rounded(F.col("auc")).alias("auc"))


@register("m4_mse_mae", f"WITH {PRED} SELECT {r6('avg((y-p)*(y-p))')} AS mse, {r6('avg(abs(y-p))')} AS mae FROM pr")
def m4(spark, sf):
    y, p = F.col("y"), F.col("p")
    return predictions(spark, sf).agg(rounded(M.mse(y, p)).alias("mse"), rounded(M.mae(y, p)).alias("mae"))


@register("m5_accuracy", f"WITH {PRED} SELECT {r6('avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1e0 ELSE 0e0 END)')} AS accuracy FROM pr")
def m5(spark, sf):
    return predictions(spark, sf).agg(rounded(M.accuracy(F.col("y"), F.col("p"))).alias("accuracy"))


@register("m6_calibration", f"WITH {PRED} SELECT {r6('avg(p)')} AS prediction_mean, {r6('avg(y)')} AS label_mean, {r6('avg(p)/avg(y)')} AS ratio FROM pr")
def m6(spark, sf):
    df = predictions(spark, sf).agg(*M.calibration(F.col("y"), F.col("p")))
    return df.select(*[rounded(F.col(c)).alias(c) for c in df.columns])


@register("m7_loss_per_sample", f"WITH {PRED} SELECT {r6(f'(sum({_ll()}) + ceil(count(*)/64e0)*0.25e0)/count(*)')} AS loss FROM pr")
def m7(spark, sf):
    return M.loss_per_sample(predictions(spark, sf), "y", "p", 0.25, 64).select(rounded(F.col("loss")).alias("loss"))


@register(
    "m8_mean_of_batch_metrics",
    f"WITH {PRED}, b AS (SELECT doc_id // 64 AS batch, avg({_ll()}) AS ll, avg((y-p)*(y-p)) AS mse FROM pr GROUP BY 1) SELECT {r6('avg(ll)')} AS log_loss, {r6('avg(mse)')} AS mse FROM b",
)
def m8(spark, sf):
    y, p = F.col("y"), F.col("p")
    df = M.mean_of_batches(predictions(spark, sf), F.floor(F.col("doc_id") / 64), {"log_loss": M.log_loss(y, p), "mse": M.mse(y, p)})
    return df.select(*[rounded(F.col(c)).alias(c) for c in df.columns])


@register(
    "m9_multi_task_metrics",
    f"WITH {PRED} SELECT 'quality' AS task, {r6(f'avg({_ll()})')} AS log_loss, {r6(auc_sql('y'))} AS auc FROM pr UNION ALL "
    f"SELECT 'toxic' AS task, {r6(f'avg({TOXIC})')} AS log_loss, {r6(auc_sql('y2'))} AS auc FROM pr",
)
def m9(spark, sf):
    df = M.task_metrics(predictions(spark, sf), {"quality": ("y", "p"), "toxic": ("y2", "p")})
    return df.select("task", rounded(F.col("log_loss")).alias("log_loss"), rounded(F.col("auc")).alias("auc"))


@register(
    "m10_evaluate",
    f"WITH {PRED}, a AS (SELECT {r6(f'avg({_ll()})')} AS log_loss, {r6('avg((y-p)*(y-p))')} AS mse, "
    f"{r6('avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1e0 ELSE 0e0 END)')} AS accuracy, {r6(auc_sql('y'))} AS auc FROM pr) "
    "SELECT 'log_loss' AS metric, log_loss AS value FROM a UNION ALL SELECT 'mse', mse FROM a UNION ALL SELECT 'accuracy', accuracy FROM a UNION ALL SELECT 'auc', auc FROM a",
)
def m10(spark, sf):
    got = M.evaluate(predictions(spark, sf), "y", "p")
    rows = [(k, got[k]) for k in ("log_loss", "mse", "accuracy", "auc")]
    return spark.createDataFrame(rows, "metric string, value double").select("metric", rounded(F.col("value")).alias("value"))


# ---- penalties, weights, logs, fits ------------------------------------

_pen = " UNION ALL ".join(
    f"SELECT '{c}' AS name, sum(abs(w))*0.01e0 + sum(w*w)*{(f + 1) / 100}e0 AS s FROM (SELECT {sql_weight('idx', f)} AS w FROM (SELECT DISTINCT i{f} AS idx FROM enc UNION SELECT max(i{f}) + 1 FROM enc))"
    for f, c in enumerate(SPARSE)
)


@register("t4_penalty_report", f"WITH {ENC}, t AS ({_pen}) SELECT name, {r6('s')} AS penalty FROM t")
def t4(spark, sf):
    m = stored_model(spark, sf, 8)
    strengths = spark.createDataFrame([(c, 0.01, (f + 1) / 100) for f, c in enumerate(SPARSE)], "name string, l1 double, l2 double")
    out = M.penalties(m.table.select(F.col("feature").alias("name"), F.col("w").alias("value")), strengths)
    return out.select("name", rounded(F.col("penalty")).alias("penalty"))


@register(
    "t5_row_weights",
    f"WITH {PRED} SELECT {r6(f'sum(wt*({_ll()}))/sum(wt)')} AS log_loss, {r6('sum(wt*(y-p)*(y-p))/sum(wt)')} AS mse, {r6('sum(CASE WHEN (p > 0.5) = (y = 1) THEN wt ELSE 0e0 END)/sum(wt)')} AS accuracy FROM pr",
)
def t5(spark, sf):
    y, p, w = F.col("y"), F.col("p"), F.col("wt")
    return predictions(spark, sf).agg(
        rounded(M.log_loss(y, p, weight=w)).alias("log_loss"), rounded(M.mse(y, p, w)).alias("mse"), rounded(M.accuracy(y, p, w)).alias("accuracy")
    )


# a run per order status and an "epoch" per month: the metric is the mean price
LOG = "lg AS (SELECT o_orderstatus AS run, CAST(dense_rank() OVER (ORDER BY strftime(o_orderdate, '%Y%m')) AS INTEGER) AS epoch, avg(o_totalprice) AS metric FROM orders GROUP BY o_orderstatus, strftime(o_orderdate, '%Y%m'))"


def _run_log(spark, sf):
    from clickweave.operators.encode import fit_vocabulary

    orders = read(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
    vocab = fit_vocabulary(orders, ["month"])
    months = vocab.select(F.col("category").alias("month"), (F.col("idx") + 1).alias("epoch"))
    per = orders.groupBy(F.col("o_orderstatus").alias("run"), "month").agg(F.avg("o_totalprice").alias("metric"))
    return per.join(F.broadcast(months), "month").select("run", "epoch", "metric")


@register("t6_best_epoch", f"WITH {LOG} SELECT run, arg_max(epoch, metric) AS best_epoch, {r6('max(metric)', 3)} AS best FROM lg GROUP BY run")
def t6_best(spark, sf):
    return TR.best_epoch(_run_log(spark, sf), "run", "epoch", "metric").select("run", "best_epoch", rounded(F.col("best"), 3).alias("best"))


@register(
    "t6_patience_stop",
    f"""WITH {LOG}, b AS (SELECT *, min(metric) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier, row_number() OVER (PARTITION BY run ORDER BY epoch) AS rn FROM lg),
i AS (SELECT *, CASE WHEN earlier IS NULL OR metric < earlier THEN 1 ELSE 0 END AS improved FROM b),
w AS (SELECT *, rn - max(CASE WHEN improved = 1 THEN rn END) OVER (PARTITION BY run ORDER BY epoch) AS wait FROM i)
SELECT run, epoch, improved, CAST(wait AS INTEGER) AS wait, CASE WHEN max(wait) OVER (PARTITION BY run ORDER BY epoch) >= 5 THEN 1 ELSE 0 END AS stopped FROM w""",
)
def t6_stop(spark, sf):
    out = TR.stop_epochs(_run_log(spark, sf), "run", "epoch", "metric", 5)
    return out.select("run", "epoch", "improved", F.col("wait").cast("int").alias("wait"), "stopped")


def _train_table(spark, sf):
    return impressions(spark, sf).withColumns({c: F.col(c) / s for c, s in zip(DENSE, (50.0, 0.1, 500000.0))})


def _judged(got, label: str, losses: list[float]):
    """Rows by label, and whether the fit is calibrated (within 5 %) and no worse than it began."""
    told = got.agg(F.sum(label).alias("y"), F.sum("score").alias("p")).first()
    by_label = got.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    near = abs(told["p"] - told["y"]) <= 0.05 * told["y"]
    return by_label.withColumns({"calibrated": F.lit(near), "improved": F.lit(losses[-1] <= losses[0])})


@register("t1_linear_fit", f"WITH {IMP}\nSELECT label, count(*) AS n, TRUE AS calibrated, TRUE AS improved FROM imp GROUP BY label")
def t1(spark, sf):
    """A logistic fit of first-order weights per class, and what it predicts."""
    df = pin(_train_table(spark, sf), "train")
    model = TR.fit_linear(df, SPARSE, DENSE, "label", epochs=6, step=0.01)
    return _judged(model.transform(df), "label", model.losses)


@register(
    "t2_fm_fit",
    f"WITH {IMP},\nu AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category FROM imp" for c in SPARSE)
    + ") SELECT feature, count(DISTINCT category) AS classes, 4::INTEGER AS width, TRUE AS moved, TRUE AS improved FROM u GROUP BY feature",
)
def t2(spark, sf):
    """Learned weights and factors: one row per class, every field moved, the loss down."""
    model = TR.fit_fm(_train_table(spark, sf), SPARSE, DENSE, "label2", factors=4, epochs=6, step=0.01)
    found = model.table.groupBy("feature").agg(
        F.count(F.lit(1)).alias("classes"), F.max(F.size("vec")).alias("width"), (F.max(F.abs("w")) > 0).alias("moved")
    )
    return found.withColumn("improved", F.lit(model.losses[-1] < model.losses[0]))


@register("t3_tower_fit", f"WITH {IMP}\nSELECT label2, count(*) AS n, TRUE AS calibrated, TRUE AS improved FROM imp GROUP BY label2")
def t3(spark, sf):
    """A small tower over the stored vectors and the numbers."""
    m = stored_model(spark, sf, 4)
    met = attach(_train_table(spark, sf), SPARSE, m.lookup)
    numbers = [F.col(c) for c in DENSE]
    df = pin(met.select("label2", deep_input([F.col(f"{f}__v") for f in SPARSE], numbers).alias("x")), "tower-train")
    model = TR.fit_tower(df, "x", "label2", hidden=(8,), rounds=15)
    return _judged(model.transform(df, "x"), "label2", model.losses)
