import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.operators.prepare import long_form
from clickweave.streaming import online as O
from clickweave.streaming.sessions import session_counts, start_sessions
from clickweave.streaming.state import BIAS, LearnerState

ROWS = O.Rows("seq", ("age", "brand"), ("cnt",), "y")


def data(n=60, seed=5):
    rng = random.Random(seed)
    return [(i, str(20 + 5 * rng.randrange(3)), "a" if rng.random() < 0.4 else rng.choice("bc"), rng.random(), rng.randrange(2)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "seq long, age string, brand string, cnt double, y int")


def cells(row):
    return {f"age={row[1]}": 1.0, f"brand={row[2]}": 1.0, "cnt": row[3]}


def sequential(batches, start_v, s):
    """Plain loop over rows and keys, the yardstick of the parallel fold."""
    st, losses, preds = {BIAS: dict(w=0.0, z=0.0, n=0.0, v=np.zeros(0), zf=np.zeros(0))}, [], {}
    for batch in batches:
        for r in batch:
            for k in cells(r):
                st.setdefault(k, dict(w=0.0, z=0.0, n=0.0, v=np.array(start_v[k]), zf=np.zeros(s.k)))
        ps = []
        for r in batch:
            t = st[BIAS]["w"]
            for k, x in cells(r).items():
                q = float(st[k]["v"] @ st[k]["v"])
                t += st[k]["w"] * x + 0.5 * (q - q * q) * x
            ps.append(1 / (1 + math.exp(-t)))
        losses.append(-np.mean([math.log(p) if r[4] else math.log(1 - p) for r, p in zip(batch, ps)]))
        for r, p in zip(batch, ps):
            preds[r[0]] = p
            for k, x in {BIAS: 1.0, **cells(r)}.items():
                c, e = st[k], r[4] - p
                pull = s.l1 * np.sign(c["w"])
                c["z"] += e * x - pull - s.l2 * c["w"]
                c["n"] += 1
                c["w"] = (c["z"] - pull) / (s.beta + math.sqrt(c["n"]))
                c["zf"] = c["zf"] + e * c["v"] * x
                c["v"] = (c["zf"] - s.l1 * np.sign(c["v"])) / (s.beta + math.sqrt(c["n"]))
    return st, losses, preds


def start_vectors(spark, rows, s):
    feats = long_form(frame(spark, rows), ["seq"], ROWS.texts, ROWS.numbers)
    return {r["key"]: r["v"] for r in O.keys_with_state(feats, O.empty_state(spark), s).collect()}


def same_state(got, want):
    got = {r["key"]: r for r in got.collect()}
    assert set(got) == set(want)
    for k, c in want.items():
        for f in ("w", "z", "n"):
            assert got[k][f] == pytest.approx(c[f], abs=1e-9), (k, f)
        if k != BIAS:
            assert np.allclose(got[k]["v"], c["v"], atol=1e-9) and np.allclose(got[k]["zf"], c["zf"], atol=1e-9)


@pytest.mark.parametrize("l1, l2, fold_rows", [(0.0, 0.0, 10**6), (0.01, 0.02, 10**6), (0.01, 0.02, 7), (0.0, 0.0, 7)])
def test_batches_match_a_sequential_loop(spark, tmp_path, l1, l2, fold_rows):
    s = O.FtrlSettings(k=3, l1=l1, l2=l2, fold_rows=fold_rows)
    rows = data(50)
    batches = [rows[:20], rows[20:]]
    want, losses, _ = sequential(batches, start_vectors(spark, rows, s), s)
    store = LearnerState(spark, str(tmp_path / "state"))
    got = [O.learn_batch(frame(spark, b), n, store, ROWS, s) for n, b in enumerate(batches)]
    assert got == pytest.approx(losses)
    same_state(store.latest(), want)


def test_replayed_batch_and_compaction_change_nothing(spark, tmp_path):
    s = O.FtrlSettings(k=2)
    rows = data(30)
    store = LearnerState(spark, str(tmp_path / "state"))
    for n, b in enumerate((rows[:10], rows[10:])):
        O.learn_batch(frame(spark, b), n, store, ROWS, s)
    before = sorted(store.latest().collect())
    O.learn_batch(frame(spark, rows[10:]), 1, store, ROWS, s)
    assert sorted(store.latest().collect()) == before
    store.compact(1)
    assert sorted(store.latest().collect()) == before
    assert store.base_version(2) == 1 and store.base_version(1) == -1


def test_hand_values(spark):
    s = O.FtrlSettings(k=1)
    key = spark.createDataFrame([("a", 0.0, 0.0, 0.0, [0.1], [0.0], 0.0)], O._schema())
    pairs = spark.createDataFrame([("a", 0, 1.0, 0.5), ("a", 1, 1.0, -0.25)], "key string, seq long, x double, e double")
    r = O.fold(pairs, key, s).first()
    assert r["z"] == 0.25 and r["n"] == 2 and r["w"] == pytest.approx(0.25 / (1 + math.sqrt(2)))
    one = O.fold(pairs.where("seq = 0"), key, s).first()
    assert one["zf"][0] == pytest.approx(0.05) and one["v"][0] == pytest.approx(0.025)
    feats = spark.createDataFrame([(0, "a", 1.0)], "seq long, feature string, x double")
    keys = spark.createDataFrame([("a", 0.0, 0.0, 0.0, [0.1, 0.2], [0.0, 0.0], 0.0)], O._schema())
    assert O.predict(feats, keys, ["seq"], 0.0, O.FtrlSettings(k=2)).first()["p"] == pytest.approx(0.505937, abs=1e-6)


def test_sums_equal_the_fold_without_penalties(spark):
    s = O.FtrlSettings(k=2)
    rng = random.Random(9)
    rows = [("hot" if i % 3 == 0 else f"k{i % 5}", i, rng.random(), rng.random() - 0.5) for i in range(200)]
    pairs = spark.createDataFrame(rows, "key string, seq long, x double, e double")
    keys = O.keys_with_state(pairs.select(F.col("key").alias("feature")), O.empty_state(spark), s)
    a = {r["key"]: r for r in O.fold(pairs, keys, s).collect()}
    for r in O.closed_form_weights(pairs, keys, s).collect():
        assert r["w"] == pytest.approx(a[r["key"]]["w"]) and r["z"] == pytest.approx(a[r["key"]]["z"])
    with pytest.raises(ValueError):
        O.closed_form_weights(pairs, keys, O.FtrlSettings(k=2, l1=0.1))


def test_stream_equals_batches_and_scores(spark, tmp_path):
    s = O.FtrlSettings(k=2, l1=0.005)
    rows = data(40)
    src = tmp_path / "in"
    schema = frame(spark, rows).schema
    for n in range(2):
        frame(spark, rows[n * 20 : n * 20 + 20]).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    store, losses = LearnerState(spark, str(tmp_path / "state")), []
    O.start_learner(stream, store, ROWS, s, str(tmp_path / "c1"), losses).awaitTermination()
    want, ref, _ = sequential([rows[:20], rows[20:]], start_vectors(spark, rows, s), s)
    assert [x for _, x in losses] == pytest.approx(ref)
    same_state(store.latest(), want)
    again = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    O.start_scorer(again, store, ROWS, s, str(tmp_path / "out"), str(tmp_path / "c2")).awaitTermination()
    streamed = {r["seq"]: r["p"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {r["seq"]: r["p"] for r in O.score_rows(frame(spark, rows), store.latest(), ROWS, s).collect()}
    assert streamed == pytest.approx(batch) and len(streamed) == 40


def test_stream_sessions_equal_batch_and_drop_late_rows(spark, tmp_path):
    base = [(u, 1_700_000_000 + u + t * 100, float(t)) for u in (1, 2) for t in (0, 1, 2, 50, 51)]
    to_df = lambda rows: spark.createDataFrame(rows, "u long, s long, value double").select("u", F.timestamp_seconds("s").alias("ts"), "value")
    closing = [(3, 1_700_000_000 + 100_000, 0.0)]
    late = [(1, 1_700_000_000 + 150, 99.0), (3, 1_700_000_000 + 200_000, 0.0)]
    src = str(tmp_path / "in")
    for part in (base, closing, late):
        to_df(part).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(to_df(base).schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = str(tmp_path / "out")
    start_sessions(stream, "u", "ts", "10 minutes", "1 minute", out, str(tmp_path / "c")).awaitTermination()
    cols = ["u", "session_start", "n_events", "total"]
    got = {tuple(r) for r in spark.read.parquet(out).where("u < 3").select(*cols).collect()}
    want = {tuple(r) for r in session_counts(to_df(base), "u", "ts", "10 minutes", "1 minute").select(*cols).collect()}
    assert got == want and len(got) == 4


def test_train_and_predict_rows(spark):
    df = frame(spark, data(3))
    assert O.split_columns(df, ["age"], "y").columns == ["age", "y"]
    assert O.split_columns(df, ["age"], "y", train=False).columns == ["age"]


@pytest.mark.parametrize("fold_rows", [100, 2])
def test_null_values_teach_nothing_and_untouched_keys_stay_away(spark, fold_rows):
    s = O.FtrlSettings(k=2, fold_rows=fold_rows)
    rows = [("a", 1, 1.0, 0.5), ("a", 2, None, 0.5), ("a", 3, 0.5, None), ("b", 4, None, 0.1), ("a", 5, 2.0, 0.25)]
    pairs = spark.createDataFrame(rows, "key string, seq long, x double, e double")
    keys = O.keys_with_state(spark.createDataFrame([("a",), ("b",), ("c",)], "feature string"), O.empty_state(spark), s)
    got = O.fold_in_rounds(pairs, keys, len(rows), s).collect()
    assert [(r["key"], r["z"], r["n"]) for r in got] == [("a", 1.0, 2.0)]
    assert [(r["key"], r["z"], r["n"]) for r in O.closed_form_weights(pairs, keys, s).collect()] == [("a", 1.0, 2.0)]


@pytest.mark.parametrize("l1, l2", [(0.01, 0.02), (0.0, 0.0)])
def test_many_fold_ranges_take_one_job_and_keep_the_order(spark, l1, l2):
    rows = [("k" if i % 3 else f"rare{i % 2}", (7 * i) % 400, ((i * 13) % 17) / 17 - 0.4, ((i * 5) % 11) / 11 - 0.5) for i in range(800)]
    rows += [("k", None, 0.5, 0.5), ("only_null", None, 1.0, 1.0), (None, 3, 1.0, 1.0), ("k", 3, None, 1.0), ("stateless", 1, 1.0, 1.0)]
    pairs = spark.createDataFrame(rows, "key string, seq long, x double, e double")
    start = [(k, 0.1, 0.2, 1.0, [0.3, -0.1], [0.2, 0.0], 1.0) for k in ("k", "rare0", "rare1", "only_null", "untouched")]
    start += [("k", -0.3, 0.1, 2.0, [0.1, 0.4], [0.0, 0.1], 2.0), (None, 0.1, 0.2, 1.0, [0.3, -0.1], [0.2, 0.0], 1.0)]
    keys = spark.createDataFrame(start, O._schema())
    whole = O.fold(pairs.where("seq is not null"), keys, O.FtrlSettings(k=2, l1=l1, l2=l2)).collect()
    whole += keys.where("key = 'only_null'").collect()
    spark.sparkContext.setJobGroup("ranges", "ranges")
    got = O.fold_in_rounds(pairs, keys, len(rows), O.FtrlSettings(k=2, l1=l1, l2=l2, fold_rows=3))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("ranges")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 10  # not one or more a range
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole))


def test_a_key_of_many_pairs_is_folded_by_products_in_all_tasks(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice(("hot", "hot", "warm", f"k{i % 9}")), (7 * i) % 1500, rng.uniform(-1, 3), rng.uniform(-1, 1)) for i in range(2400)]
    rows += [("turn", 1, 1.0, 0.5)] + [("turn", i, 1.0, -2.0 if i == 7 else 0.1) for i in range(2, 350)]  # one factor is below zero
    rows += [("stop", i, 1.0, -3.0 if i == 4 else 0.1) for i in range(350)]  # after four pairs the rate is 3
    rows += [("hot", None, 0.5, 0.5), (None, 3, 1.0, 1.0), ("hot", 3, None, 1.0), ("hot", 3, 0.5, None), *[("stateless", i, 1.0, 0.1) for i in range(350)]]
    pairs = spark.createDataFrame(rows, "key string, seq long, x double, e double")
    names = ["hot", "warm", "turn", "untouched", *[f"k{i}" for i in range(9)]]
    start = [(k, 0.1, 0.2, 1.0, [0.3, -0.1], [0.2, 0.0], 1.0) for k in names]
    start += [("hot", -0.3, 0.1, 2.0, [0.1, 0.0], [0.0, 0.0], 5.0), ("stop", 0.0, 0.0, 0.0, [0.3, -0.1], [0.0, 0.0], 0.0)]
    keys = spark.createDataFrame(start, O._schema())
    seen = []
    streams = O._fold_streams
    monkeypatch.setattr(O, "_fold_streams", lambda p, k, s: seen.append({r["key"]: r["count"] for r in p.groupBy("key").count().collect()}) or streams(p, k, s))
    s = O.FtrlSettings(k=2, fold_rows=3, spread_rows=300)
    got = sorted(O.fold_in_rounds(pairs, keys, len(rows), s).collect(), key=lambda r: (r["key"], r["nf"]))
    want = sorted(O.fold(pairs.where("seq is not null"), keys, O.FtrlSettings(k=2)).collect(), key=lambda r: (r["key"], r["nf"]))
    assert len(seen) == 1 and max(seen[0].values()) <= 300 and not {"hot", "warm", "turn", "stop"} & set(seen[0])
    assert [r["key"] for r in got] == [r["key"] for r in want] and len(got) == 14
    for a, b in zip(got, want):
        for c in O.VALUES:
            assert np.allclose(a[c], b[c], rtol=1e-9, atol=0), (a["key"], c, a[c], b[c])
    assert {tuple(r["zf"]) for r in got if r["key"] == "stop"} == {(0.0, 0.0)}
    with pytest.raises(ValueError):
        O.fold_by_products(pairs, keys, keys.select("key"), O.FtrlSettings(k=2, l2=0.1))


def test_products_do_not_overflow_on_the_way(spark):
    """Some 1,600 factors of 2 and as many of 1/2: the whole is moderate, its parts are not."""
    s = O.FtrlSettings(k=1, fold_rows=3, spread_rows=100)
    rate = [1 + math.sqrt(i) for i in range(3200)]
    rows = [("a", i, 1.0, 0.5 if i == 0 else rate[i] if i % 3200 < 1600 else -rate[i] / 2) for i in range(3200)]
    pairs = spark.createDataFrame(rows, "key string, seq long, x double, e double")
    keys = spark.createDataFrame([("a", 0.0, 0.0, 0.0, [0.25], [0.0], 0.0)], O._schema())
    (got,) = O.fold_in_rounds(pairs, keys, len(rows), s).collect()
    assert got["zf"][0] == pytest.approx(0.125 / 2, rel=1e-9)


def test_a_state_travels_as_text_without_loss():
    state = {"w": 0.1, "z": -1e-300, "n": 3.0, "v": [1e22, 1 / 3], "zf": [], "nf": 2.0}
    assert O._state(json.dumps(state)) == state
    odd = O._state('{"w":"NaN","z":"-Infinity","n":1.0E10,"v":[null,"Infinity"]}')
    assert math.isnan(odd["w"]) and odd["z"] == -math.inf and odd["n"] == 1e10 and odd["v"] == [None, math.inf] and odd["zf"] is None
