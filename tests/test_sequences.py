import random

import pytest
from pyspark.sql import functions as F

from clickweave.operators import history as H
from clickweave.operators import multivalue as M


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "idx int, vec array<double>")


def pooled(df, table, mode, **how):
    return [r["pooled"] for r in M.pool(df, "ids", table, 2, mode, **how).orderBy("id").collect()]


def test_split_vocabulary_and_padding(spark):
    df = spark.createDataFrame([(0, "Comedy|Drama"), (1, "Action|Thriller"), (2, "Drama|Romance")], "id int, g string")
    df = df.withColumn("t", M.split_values(F.col("g")))
    for rows in (10, 0):
        vocab = M.sequence_vocabulary(df, "t", ["id"], window_rows=rows)
        ids = M.tokens_to_ids(df, "t", vocab, "ids").orderBy("id").select(M.pad(F.col("ids"), 3)).collect()
        assert [r[0] for r in ids] == [[1, 2, 0], [3, 4, 0], [2, 5, 0]]
    kept = spark.createDataFrame([([1, 2, 3, 4],), ([],)], "a array<int>").select(M.pad(F.col("a"), 3)).collect()
    assert [r[0] for r in kept] == [[2, 3, 4], [0, 0, 0]]


@pytest.mark.parametrize("maxlen", [None, 3])
def test_pooling_fixtures(spark, table, maxlen):
    df = spark.createDataFrame([(0, [1, 2, 0]), (1, [0, 0, 0])], "id int, ids array<int>")
    assert pooled(df, table, "sum", maxlen=maxlen) == [[4.0, 6.0], [0.0, 0.0]]
    assert pooled(df, table, "mean", maxlen=maxlen)[0] == pytest.approx([2.0, 3.0], abs=1e-7)
    assert pooled(df, table, "mean", maxlen=maxlen)[1] == [0.0, 0.0]
    assert pooled(df, table, "max", maxlen=maxlen) == [[3.0, 4.0], [None, None]]
    assert pooled(df, table, "max", maxlen=maxlen, empty_max=M.MASKED)[1] == [-1e9, -1e9]


@pytest.mark.parametrize("mode", ["sum", "mean", "max"])
def test_pooling_is_the_same_in_every_plan(spark, table, mode):
    """Null and equal keys, whole equal rows, empty, null and over-long sequences."""
    rows = [(1, [1, 2], [0.5, 2.0]), (1, [2, 0], [1.0, 1.0]), (None, [1, 1], [1.0, 3.0]), (None, [1, 1], [1.0, 3.0]), (2, [1, 2, 2], [9.0, 1.0, 1.0])]
    rows += [(3, [], []), (4, None, None), (5, [0, 0], [1.0, 1.0]), (6, [7, 1], [1.0, 1.0]), (7, [2], [1.0])]
    df = spark.createDataFrame(rows, "id int, ids array<int>, w array<double>").repartition(3)
    for weights in (None, F.col("w")):
        plans = [dict(maxlen=2), dict(maxlen=2, fits=False), dict(maxlen=2, fits=True)]
        found = [sorted(map(str, M.pool(df, "ids", table, 2, mode, weights=weights, **how).collect())) for how in plans]
        assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    capped = df.withColumn("n", F.size("ids"))
    by_length = [sorted(map(str, M.pool(capped, "ids", table, 2, mode, length="n", maxlen=2, fits=f).collect())) for f in (True, False)]
    assert by_length[0] == by_length[1]
    one = M.pool(df.where("id = 2"), "ids", table, 2, "sum", maxlen=2).first()["pooled"]
    assert one == [6.0, 8.0]  # the last two of three


def test_taken_apart_rows_come_back_whole(spark, table):
    rows = [(1, ["a", "b"]), (1, ["b"]), (None, ["zz", "a"]), (None, ["zz", "a"]), (2, []), (3, None), (4, [None, "a"])]
    df = spark.createDataFrame(rows, "id int, t array<string>").repartition(3)
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "token string, idx int")
    got = M.tokens_to_ids(df, "t", vocab, "ids")
    want = [(i, t, [{"a": 1, "b": 2}.get(x, 0) for x in t or []]) for i, t in rows]
    assert sorted(map(str, [tuple(r) for r in got.collect()])) == sorted(map(str, want))
    seqs = M.sequence_vectors(got, "ids", table, "keys").select("id", "ids", "keys")
    vec = {1: [1.0, 2.0], 2: [3.0, 4.0]}
    assert sorted(map(str, [tuple(r) for r in seqs.collect()])) == sorted(str((i, ids, [vec.get(x) for x in ids])) for i, _, ids in want)
    named = table.withColumn("feature", F.lit("t"))
    many = M.pool_many(got, {"ids": ("t", "sum")}, named, 2).collect()
    assert sorted(str(r["ids__v"]) for r in many) == sorted(str([sum(vec.get(x, [0.0, 0.0])[d] for x in ids) + 0.0 for d in (0, 1)]) for _, _, ids in want)


def test_pooling_by_length_and_shuffled_join(spark, table):
    df = spark.createDataFrame([(0, [1, 2, 1], 2), (1, [2, 2, 2], 0)], "id int, ids array<int>, n int")
    want = [[4.0, 6.0], [0.0, 0.0]]
    assert pooled(df, table, "sum", length="n") == want
    assert pooled(df, table, "sum", length="n", maxlen=3) == want
    assert pooled(df, table, "sum", length="n", fits=False) == want


def test_sequence_weights(spark, table):
    df = spark.createDataFrame([(0, [1, 2], [0.0, 0.0]), (1, [1, 0], [5.0, 9.0]), (2, [0, 0], [1.0, 1.0])], "id int, ids array<int>, w array<double>")
    soft = M.sequence_weights(F.col("w"), M.valid_by_zero(F.col("ids")))
    assert [r[0] for r in df.orderBy("id").select(soft).collect()] == [[0.5, 0.5], [1.0, 0.0], [0.0, 0.0]]
    assert pooled(df, table, "sum", weights=soft) == [[2.0, 3.0], [1.0, 2.0], [0.0, 0.0]]
    assert pooled(df, table, "sum", weights=soft, maxlen=2) == [[2.0, 3.0], [1.0, 2.0], [0.0, 0.0]]
    raw = M.sequence_weights(F.col("w"), M.valid_by_zero(F.col("ids")), normalise=False)
    assert [r[0] for r in df.orderBy("id").select(raw).collect()] == [[0.0, 0.0], [5.0, 0.0], [0.0, 0.0]]


def test_equal_weights_under_sum_are_the_mean(spark, table):
    df = spark.createDataFrame([(0, [1, 2, 2], [0.3] * 3)], "id int, ids array<int>, w array<double>")
    soft = M.sequence_weights(F.col("w"), M.valid_by_zero(F.col("ids")))
    assert pooled(df, table, "sum", weights=soft)[0] == pytest.approx(pooled(df, table, "mean")[0], abs=1e-6)


def test_pool_many_matches_single_pools(spark, table):
    df = spark.createDataFrame([(0, [1, 2], [2, 2]), (1, [0, 0], [1, 0])], "id int, ids array<int>, other array<int>")
    named = table.withColumn("feature", F.lit("t"))
    got = M.pool_many(df, {"ids": ("t", "sum"), "other": ("t", "max")}, named, 2).orderBy("id").collect()
    assert [r["ids__v"] for r in got] == pooled(df, table, "sum")
    assert [r["other__v"] for r in got] == [[3.0, 4.0], [1.0, 2.0]]


def test_k_max(spark):
    assert spark.range(1).select(M.k_max(F.expr("array(1, 5, 2, 4)"), 2)).first()[0] == [5, 4]


def test_attention_pool_ignores_padding(spark, table):
    df = spark.createDataFrame([(0, [1, 2, 0])], "id int, ids array<int>")
    df = M.sequence_vectors(df, "ids", table, "keys").withColumn("s", F.expr("array(1D, 2D, 9D)"))
    valid = M.valid_by_zero(F.col("ids"))
    got = df.select(M.attention_pool(M.attention_weights(F.col("s"), valid), F.col("keys"), 2)).first()[0]
    assert got == [7.0, 10.0]


def random_events(n=400, users=4, seed=3):
    """A third of the events belong to user 0."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        u = 0 if rng.random() < 0.34 else rng.randrange(1, users)
        rows.append((i, u, rng.randrange(0, 3000), rng.randrange(1, 9)))
    return rows


@pytest.fixture(scope="module")
def events(spark):
    df = spark.createDataFrame(random_events(), "event_id long, user_id long, sec long, item int")
    return df.withColumn("ts", F.timestamp_seconds("sec"))


@pytest.mark.parametrize("hot_rows", [10**9, 100, 0])
@pytest.mark.parametrize("m", [1, 3, 70])
def test_history_against_brute_force(events, hot_rows, m):
    got = H.behaviour_history(events, "user_id", ["ts", "event_id"], "item", m, hot_rows=hot_rows)
    got = {r["event_id"]: r["hist"] for r in got.collect()}
    want, seen = {}, {}
    for e, u, s, item in sorted(random_events(), key=lambda r: (r[2], r[0])):
        want[e] = seen.get(u, [])[-m:]
        seen.setdefault(u, []).append(item)
    assert got == want


@pytest.mark.parametrize("hot_rows", [10**9, 100, 0])
@pytest.mark.parametrize("gap", [5, 60, 10**6])
def test_sessions_against_brute_force(events, hot_rows, gap):
    got = H.divide_sessions(events, "user_id", "ts", "event_id", gap, hot_rows=hot_rows)
    got = {r["event_id"]: r["session_no"] for r in got.collect()}
    want, last = {}, {}
    for e, u, s, item in sorted(random_events(), key=lambda r: (r[2], r[0])):
        t, no = last.get(u, (None, 0))
        no += t is None or s - t > gap
        want[e], last[u] = no, (s, no)
    assert got == want


def test_last_sessions(spark):
    rows = [(u, n, t, 10 * n + t) for u, total in ((1, 7), (2, 2)) for n in range(1, total + 1) for t in range(3)]
    df = spark.createDataFrame(rows, "u int, s long, t int, item int")
    kept = H.last_sessions(df, "u", "s", 5)
    items = H.session_items(kept, "u", "sess", ["t"], "item", 2).orderBy("u", "sess").collect()
    assert [(r["u"], r["sess"], r["items"]) for r in items] == [
        *[(1, n, [10 * (n + 3) + 1, 10 * (n + 3) + 2]) for n in range(5)], (2, 0, [11, 12]), (2, 1, [21, 22])
    ]
    assert {r["u"]: r["sess_length"] for r in kept.collect()} == {1: 5, 2: 2}


def test_negatives_are_never_own_items(spark):
    # user 0 owns all but one item, user 1 owns everything, user 2 owns one
    rows = [(0, i) for i in range(10) if i != 6] + [(1, i) for i in range(10)] + [(2, 4)] * 30
    df = spark.createDataFrame([(n, u, i) for n, (u, i) in enumerate(rows)], "k long, u long, i long")
    rows += [(None, 3), (3, None), (3, 99)]
    df = spark.createDataFrame([(n, u, i) for n, (u, i) in enumerate(rows)], "k long, u long, i long").repartition(3)
    plans = [sorted(map(tuple, H.draw_negatives(df, "u", "i", 10, F.col("k") * 7, hot_rows=n).collect()), key=str) for n in (100_000, 5)]
    assert plans[0] == plans[1] and len(plans[0]) == len(rows)
    for k, u, _, neg in plans[0]:
        own = {i for v, i in rows if v == u and u is not None and i is not None and i < 10}
        free = [i for i in range(10) if i not in own]
        assert neg == (free[k * 7 % len(free)] if free else None)


def test_negatives_are_uniform_over_free_items(spark):
    df = spark.range(9000).select((F.col("id") % 3).alias("u"), (F.col("id") % 7 * 2).alias("i"), "id")
    got = H.draw_negatives(df, "u", "i", 20, F.xxhash64(F.lit(5), "id")).where("u = 1").groupBy("neg_idx").count().collect()
    free = [i for i in range(20) if i % 2 or i > 12]
    counts = {r["neg_idx"]: r["count"] for r in got}
    assert set(counts) == set(free)
    mean = 3000 / len(free)
    assert sum((c - mean) ** 2 / mean for c in counts.values()) < 35  # 12 degrees of freedom, far beyond the 0.1 % point


def test_next_steps(spark):
    df = spark.createDataFrame([(0, [5, 6, 7, 0], [1, 2, 3, 0], 3), (1, [5], [1], 1)], "id int, c array<int>, g array<int>, n int")
    steps = H.next_steps(df, ["id"], "c", "g", "n")
    assert sorted(tuple(r) for r in steps.collect()) == [(0, 0, 5, 6, 2), (0, 1, 6, 7, 3)]
    loss = H.next_step_loss(steps.withColumns({"a": F.lit(0.5), "b": F.lit(0.5)}), "a", "b", 6).first()[0]
    assert loss == pytest.approx(4 * 0.6931471805599453 / 6)
