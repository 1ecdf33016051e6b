import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.functions.towers import Tower
from clickweave.operators import embedding as emb
from clickweave.operators.encode import apply_vocabulary, fit_vocabulary
from clickweave.plans import scoring as SC
from clickweave.plans import training as TR
from clickweave.scratch import pin, scratch_root
from clickweave.sources import partitions as PT
from clickweave.sources import tables as T


def test_csv_quotes_blanks_and_tabs(spark, tmp_path):
    (tmp_path / "a.csv").write_text('movie,title\n1,"Toy, the ""best"""\n2,\n')
    got = T.read_csv(spark, str(tmp_path / "a.csv"), "movie int, title string").orderBy("movie").collect()
    assert [tuple(r) for r in got] == [(1, 'Toy, the "best"'), (2, None)]
    (tmp_path / "b.csv").write_text("73, Never married\n")
    assert T.read_headless_csv(spark, str(tmp_path / "b.csv"), "age int, status string").first()[1] == " Never married"
    (tmp_path / "c.tsv").write_text("1\t2\n")
    assert tuple(T.read_tsv(spark, str(tmp_path / "c.tsv"), "a int, b int").first()) == (1, 2)


def test_twenty_digit_ids_survive(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,click\n10000371904215119486,1\n")
    row = T.read_csv(spark, str(tmp_path / "a.csv"), "id decimal(20,0), click int").first()
    assert str(row["id"]) == "10000371904215119486"


def test_records_without_a_value_fail(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.createDataFrame([(1, 0.5), (None, 0.25)], "a int, y double").write.parquet(path)
    with pytest.raises(Exception, match="record without a"):
        T.read_records(spark, path, "a int, y double", "y").collect()
    assert T.read_records(spark, path, "y double, a int", "y", strict=False).columns == ["a", "y"]


def test_latest_partition_rules(spark, tmp_path):
    rows = [("20241029", "23", 1), ("20241030", "07", 2), ("20241030", "08", 3)]
    path = str(tmp_path / "p")
    T.write_predictions(spark.createDataFrame(rows, "dt string, hour string, v int"), path)
    (tmp_path / "p" / "_SUCCESS").touch()
    df = PT.read_partitioned(spark, path, "v int")
    assert [tuple(r) for r in PT.latest_partition(df).select("dt", "hour", "v").collect()] == [("20241030", "08", 3)]
    assert [r["v"] for r in PT.latest_partition_by_key(df).collect()] == [3]
    assert sorted(r["v"] for r in PT.latest_partition(df, hour=None).collect()) == [2, 3]
    with pytest.raises(ValueError):
        PT.latest_partition(df.where("dt = 'x'"))
    plan = PT.latest_partition(df)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan


def test_newest_folder_is_found_by_listing(spark, tmp_path):
    path = tmp_path / "p"
    rows = [("20241029", "23", 1), ("20241030", "07", 2), ("20241030", "08", 3)]
    T.write_predictions(spark.createDataFrame(rows, "dt string, hour string, v int"), str(path))
    for n in range(3000):  # older folders whose files no reader could open
        (path / f"dt=2023{n:04d}" / "hour=00").mkdir(parents=True)
        (path / f"dt=2023{n:04d}" / "hour=00" / "part-0.parquet").write_bytes(b"no parquet")
    (path / "dt=20241031" / "hour=00").mkdir(parents=True)
    (path / "dt=20241031" / "hour=00" / "_SUCCESS").touch()
    got = PT.read_newest(spark, str(path), "v int")
    assert [tuple(r) for r in got.select("v", "dt", "hour").collect()] == [(3, "20241030", "08")] and got.columns == ["v", "dt", "hour"]
    assert sorted(r["v"] for r in PT.read_newest(spark, str(path), "v int, hour string", ("dt",)).collect()) == [2, 3]
    with pytest.raises(ValueError):
        PT.read_newest(spark, str(tmp_path / "none"), "v int")


def test_versioned_store(spark, tmp_path):
    path = str(tmp_path / "s")
    for v in ("1", "2", "1"):
        T.write_store(spark.createDataFrame([(int(v),)], "x int"), path, v)
    assert [r["x"] for r in T.read_store(spark, path, "x int").collect()] == [2]
    assert [r["x"] for r in T.read_store(spark, path, "x int", "1").collect()] == [1]


def test_scratch_reads_the_session_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == shared
    pinned = pin(spark.range(3), "x")
    assert shared in pinned.inputFiles()[0] and pinned.count() == 3


def model(spark):
    df = spark.range(60).select("id", (F.col("id") % 4).cast("string").alias("a"), (F.col("id") % 3).cast("string").alias("b"), (F.col("id") / 60.0).alias("x"))
    vocab = fit_vocabulary(df, ["a", "b"])
    table = emb.formula_table(vocab.select("feature", "idx"), ["a", "b"], lambda i, p: F.array(i * 0.1, p - 0.3), lambda i, p: i * 0.2)
    return df, emb.compose(vocab, table)


@pytest.mark.parametrize("fields, numbers", [(["a", "b"], ["x"]), (["a"], []), ([], ["x"]), (["a", "b"], [])])
def test_scoring_grid(spark, fields, numbers):
    df, lookup = model(spark)
    out = SC.score_fm(df, fields, numbers, lookup, 2, [0.7] * len(numbers), bias=0.1).orderBy("id").collect()
    for r in out:
        va, vb = np.array([int(r["a"]) * 0.1, -0.3]), np.array([int(r["b"]) * 0.1, 0.7])
        z = 0.1 + ("x" in numbers) * 0.7 * r["x"] + ("a" in fields) * int(r["a"]) * 0.2 + ("b" in fields) * int(r["b"]) * 0.2
        z += float(va @ vb) if len(fields) == 2 else 0.0
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)))


def test_deep_scoring_and_tasks(spark):
    df, lookup = model(spark)
    rng = np.random.default_rng(7)
    w, b, k = rng.normal(size=(5, 3)), rng.normal(size=3), rng.normal(size=3)
    tower = Tower([(w, b)])
    got = SC.score_deep_fm(df, ["a", "b"], ["x"], lookup, 2, [0.7], tower, k).orderBy("id").collect()
    tasks = SC.score_tasks(df, ["a", "b"], ["x"], lookup, None, [tower, tower], [k, -k]).orderBy("id").collect()
    for r, t in zip(got, tasks):
        va, vb = np.array([int(r["a"]) * 0.1, -0.3]), np.array([int(r["b"]) * 0.1, 0.7])
        deep = float(np.maximum(np.concatenate([va, vb, [r["x"]]]) @ w + b, 0) @ k)
        z = 0.7 * r["x"] + (int(r["a"]) + int(r["b"])) * 0.2 + float(va @ vb) + deep
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)))
        assert t["ctr"] == pytest.approx(1 / (1 + np.exp(-deep))) and t["ctcvr"] == pytest.approx(t["ctr"] * t["cvr"])


def test_batched_and_user_models(spark):
    df = spark.range(1000).select("id", (F.col("id") * 2.0).alias("x"))
    got = SC.predict_batches(df, ["id"], ["x"], lambda m: m[:, 0] + 1, batch_size=64)
    assert got.where("score <> id * 2 + 1").count() == 0 and got.count() == 1000

    def load():
        return lambda x: x * 3.0

    assert df.withColumn("s", SC.user_model(load, batch_size=100)(F.col("x"))).where("s <> id * 6").count() == 0


def test_linear_fit_finds_planted_weights(spark):
    df = spark.range(3000).select(
        (F.col("id") % 3).cast("int").alias("a"), (F.rand(3) - 0.5).alias("x"), F.rand(4).alias("u")
    )
    z = F.when(F.col("a") == 2, 2.0).otherwise(-1.0) + 3.0 * F.col("x")
    df = df.withColumn("y", (F.col("u") < 1 / (1 + F.exp(-z))).cast("double"))
    lr = TR.fit_linear(df, ["a"], ["x"], "y", step=1.0, epochs=14)
    w = {r["category"]: r["w"] for r in lr.table.collect()}
    assert 2.3 < lr.kernel[0] < 3.7 and 2.3 < w["2"] - w["0"] < 3.7 and lr.losses[-1] < lr.losses[0]
    reg = TR.fit_linear(df.withColumn("t", 2.0 * F.col("x") + F.col("a")), ["a"], ["x"], "t", task="regression", step=1.0, epochs=14)
    assert reg.kernel[0] == pytest.approx(2.0, abs=0.1) and reg.losses[-1] < 0.01


def test_round_equals_plain_gradients(spark):
    """One step of the keyed table against the formulas in NumPy, broadcast and shuffled, with weights and odd rows."""
    rng = np.random.default_rng(11)
    rows = [(rng.choice(["u", "v", None]), rng.choice(["p", "q", "r"]), float(rng.normal()), float(rng.integers(2)), float(rng.integers(1, 4))) for _ in range(60)]
    odd = [("u", "p", None, 1.0, 1.0), ("u", "p", 0.5, None, 1.0)]
    df = spark.createDataFrame(rows + odd, "a string, b string, x double, y double, s double").repartition(3)
    how = dict(factors=2, l2=0.01, step=0.5, std=0.3, weight="s")
    start = TR.fit_fm(df, ["a", "b"], ["x"], "y", epochs=0, **how)
    init = {(r["feature"], r["category"]): np.array([r["w"], *r["vec"]]) for r in start.table.collect()}
    n = sum(r[4] for r in rows)
    grads, gk, gb, loss = {k: np.zeros(3) for k in init}, 0.0, 0.0, 0.0
    for a, b, x, y, s in rows:
        ka, kb = ("a", a or "nan"), ("b", b)
        z = start.bias + float(init[ka][1:] @ init[kb][1:])
        p = 1 / (1 + math.exp(-z))
        loss -= s * (y * math.log(p) + (1 - y) * math.log(1 - p))
        g = s * (p - y)
        grads[ka] += [g, *(g * init[kb][1:])]
        grads[kb] += [g, *(g * init[ka][1:])]
        gk, gb = gk + g * x, gb + g
    for limit in (None, 0):
        one = TR.fit_fm(df, ["a", "b"], ["x"], "y", epochs=1, limit=limit, **how)
        for r in one.table.collect():
            k = (r["feature"], r["category"])
            g = grads[k] / n + 0.01 * init[k]
            assert [r["w"], *r["vec"]] == pytest.approx((init[k] - 0.5 * g / (np.abs(g) + 1e-10)).tolist(), abs=1e-9)
        assert one.kernel[0] == pytest.approx(-0.5 * math.copysign(1, gk)) and one.bias == pytest.approx(start.bias - 0.5 * math.copysign(1, gb), abs=1e-6)
        assert one.losses == [pytest.approx(loss / n)]


def test_fm_fit_separates_an_interaction(spark):
    # the label depends on the pair of classes only, so a linear part cannot find it
    df = spark.range(2000).select((F.col("id") % 2).cast("int").alias("a"), (F.floor(F.col("id") / 2) % 2).cast("int").alias("b"))
    df = df.withColumn("y", (F.col("a") == F.col("b")).cast("double"))
    m = TR.fit_fm(df, ["a", "b"], [], "y", factors=4, epochs=12, step=0.5, std=0.1)
    assert m.transform(df).where("(score > 0.5) = (y = 1)").count() == 2000
    table = TR.fm_table(m)
    assert table.where("feature = 'a'").count() == 2 and len(table.first()["vec"]) == 4
    unseen = spark.createDataFrame([(7, 0)], "a int, b int")
    assert 0 < m.transform(unseen).first()["score"] < 1


def test_tower_gradient_and_fit(spark):
    rng = np.random.default_rng(1)
    widths, x, s = [3, 4, 1], rng.normal(size=(20, 3)), rng.uniform(1, 2, 20)
    flat = rng.normal(size=3 * 4 + 4 + 4 + 1)
    for task, y in (("binary", rng.integers(0, 2, 20).astype(float)), ("regression", rng.normal(size=20))):
        grad, _ = TR.tower_gradient(flat, widths, x, y, s, task)
        for i in range(len(flat)):
            up, down = flat.copy(), flat.copy()
            up[i], down[i] = up[i] + 1e-6, down[i] - 1e-6
            slope = (TR.tower_gradient(up, widths, x, y, s, task)[1] - TR.tower_gradient(down, widths, x, y, s, task)[1]) / 2e-6
            assert grad[i] == pytest.approx(slope, abs=1e-4)
    df = spark.range(800).select((F.col("id") % 2).alias("a"), (F.floor(F.col("id") / 2) % 2).alias("b"))
    df = df.select(F.array(F.col("a").cast("double"), F.col("b").cast("double")).alias("x"), (F.col("a") == F.col("b")).cast("double").alias("y"))
    m = TR.fit_tower(df, "x", "y", hidden=(8,), rounds=40, step=0.1)
    assert m.transform(df, "x").where("(score > 0.5) = (y = 1)").count() == 800 and m.losses[-1] < 0.2
    with pytest.raises(ValueError):
        TR.fit_tower(df.limit(0), "x", "y")


def test_run_log_rules(spark):
    log = spark.createDataFrame([("r", e, v) for e, v in enumerate([0.9, 0.7, 0.8, 0.75, 0.6], 1)], "run string, epoch int, loss double")
    assert tuple(TR.best_epoch(log, "run", "epoch", "loss", "min").first()) == ("r", 5, 0.6)
    got = TR.stop_epochs(log, "run", "epoch", "loss", 2).orderBy("epoch").collect()
    assert [r["wait"] for r in got] == [0, 0, 1, 2, 0] and [r["stopped"] for r in got] == [0, 0, 0, 1, 1]
    assert [r["best"] for r in got] == [0.9, 0.7, 0.7, 0.7, 0.6]


def test_newest_version_is_the_largest_number(spark, tmp_path):
    path = str(tmp_path / "s")
    for v in ("9", "10"):
        T.write_store(spark.createDataFrame([(int(v),)], "x int"), path, v)
    assert [r["x"] for r in T.read_store(spark, path, "x int").collect()] == [10]
    T.write_store(spark.createDataFrame([(1,)], "x int"), path, "a")
    assert [r["x"] for r in T.read_store(spark, path, "x int").collect()] == [1]


def test_predictions_of_other_hours_stay(spark, tmp_path):
    path = str(tmp_path / "p")
    for hour, v in (("00", 1), ("01", 2), ("01", 3)):
        T.write_predictions(spark.createDataFrame([("20240101", hour, v)], "dt string, hour string, v int"), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_prediction_sink_is_read_back(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [(1, "2024-10-29 01:00:00", 1.5), (2, "2024-10-29 13:00:00", 2.0), (3, "2024-10-29 02:00:00", 0.25), (4, "2024-10-30 00:00:00", None)]
    events = spark.createDataFrame(rows, "event_id bigint, t string, value double")
    events.select("event_id", F.to_timestamp_ntz("t").alias("ts"), "value").write.parquet(str(tmp_path / "events.parquet"))
    got = {tuple(r) for r in entry.queries()["s14_prediction_sink"](spark, str(tmp_path)).collect()}
    assert got == {("20241029", "00", 2, 1.75), ("20241029", "12", 1, 2.0), ("20241030", "00", 1, None)}
