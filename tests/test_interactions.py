import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.functions.scalars import rounded, rounded_apart
from clickweave.functions.towers import Tower, attention_scores, tower_logit, tower_output
from clickweave.functions.vectors import literal, softmax
from clickweave.operators import embedding as emb
from clickweave.operators import interactions as X
from clickweave.operators.encode import apply_vocabulary, fit_vocabulary

ROWS = [[(1.0, 2.0), (3.0, 4.0), (5.0, 6.0)], [(0.5, -1.0), (2.0, 0.25), (-3.0, 1.0)]]


@pytest.fixture(scope="module")
def three(spark):
    rows = [(i, *[list(v) for v in r]) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, "id int, a array<double>, b array<double>, c array<double>")




def vs():
    return [F.col(x) for x in "abc"]


def first(df, *cols):
    got = df.orderBy("id").select(*[c.alias(f"_{i}") for i, c in enumerate(cols)]).first()
    return got[0] if len(cols) == 1 else list(got)


def test_second_order_fixture(three):
    assert first(three, X.fm_second_order(vs(), 2)) == pytest.approx(67.0)
    assert first(three, X.bi_interaction(vs(), 2)) == pytest.approx([23.0, 44.0])
    assert first(three, *X.inner_products(vs())) == pytest.approx([11.0, 17.0, 39.0])
    assert first(three, *X.inner_products(vs(), 2)) == pytest.approx([11.0, 17.0, 39.0])


def test_long_unrolled_and_array_plans_agree(three, monkeypatch):
    wide = [r[0] for r in three.orderBy("id").select(X.fm_second_order(vs(), 2)).collect()]
    bi = [r[0] for r in three.orderBy("id").select(X.bi_interaction(vs(), 2)).collect()]
    cells = three.select("id", F.explode(F.array(*vs())).alias("vec"))
    long = X.long_second_order(cells, ["id"]).orderBy("id").collect()
    assert [r["fm"] for r in long] == pytest.approx(wide)
    assert [x for r in long for x in r["bi"]] == pytest.approx([x for r in bi for x in r])
    monkeypatch.setattr(X, "UNROLL", 0)
    assert [r[0] for r in three.orderBy("id").select(X.fm_second_order(vs(), 2)).collect()] == pytest.approx(wide)


def test_field_weighted_and_embedded_fixtures(three):
    assert first(three, X.field_weighted(vs(), [1, 2, 0.5])) == pytest.approx(64.5)
    assert first(three, X.field_weighted(vs(), [1, 1, 1])) == pytest.approx(67.0)
    w = [[1.0, 0.0], [1.0, 0.0]]
    assert first(three, X.field_embedded(vs()[:2], [w])[0]) == pytest.approx(16.0)
    assert first(three, X.field_embedded(vs()[:2], [w], 2)[0]) == pytest.approx(16.0)


def test_outer_products_against_numpy(three):
    rng = np.random.default_rng(1)
    k = rng.normal(size=(3, 2, 2))
    a = np.array(ROWS)
    want = [[float(r[j] @ k[n] @ r[i]) for n, (i, j) in enumerate(itertools.combinations(range(3), 2))] for r in a]
    for dim in (None, 2):
        got = three.orderBy("id").select(*[c.alias(f"p{n}") for n, c in enumerate(X.outer_products(vs(), k.tolist(), "mat", dim))]).collect()
        assert np.allclose([list(r) for r in got], want)
    kv = rng.normal(size=(3, 2))
    got = first(three, *X.outer_products(vs(), kv.tolist(), "vec"))
    assert got == pytest.approx([float((kv[n] * a[0][i] * a[0][j]).sum()) for n, (i, j) in enumerate(X.pairs(3))])
    assert first(three, *X.outer_products(vs(), [2, 3, 4], "num")) == pytest.approx([22.0, 51.0, 156.0])


@pytest.mark.parametrize("kind", ["all", "each", "interaction"])
def test_bilinear_against_numpy(three, kind):
    rng = np.random.default_rng(2)
    k = rng.normal(size=(2, 2) if kind == "all" else (3, 2, 2))
    r = np.array(ROWS[0])
    want = []
    for n, (i, j) in enumerate(X.pairs(3)):
        w = k if kind == "all" else k[i] if kind == "each" else k[n]
        want.append((r[i] @ w) * r[j])
    for dim in (None, 2):
        got = first(three, F.array(*X.bilinear(vs(), k.tolist(), kind, dim)))
        assert np.allclose(got, want)


def test_attention_over_pairs_against_numpy(three):
    rng = np.random.default_rng(3)
    w, b, h, p = rng.normal(size=(2, 3)), rng.normal(size=3), rng.normal(size=3), rng.normal(size=2)
    df = three.withColumn("pairs", X.pair_products(vs()))
    df = df.withColumn("att", X.pair_attention(F.col("pairs"), w.tolist(), b.tolist(), h.tolist()))
    got = df.orderBy("id").select("att", X.attentional_fm(F.col("pairs"), F.col("att"), p.tolist()).alias("s")).collect()
    for row, r in zip(got, np.array(ROWS)):
        prod = np.array([r[i] * r[j] for i, j in X.pairs(3)])
        e = np.maximum(prod @ w + b, 0) @ h
        a = np.exp(e - e.max())
        a /= a.sum()
        assert np.allclose(row["att"], a) and math.isclose(row["s"], float(a @ prod @ p), rel_tol=1e-9)


def test_field_reweighting_against_numpy(three):
    rng = np.random.default_rng(4)
    w1, w2 = rng.normal(size=(3, 2)), rng.normal(size=(2, 3))
    got = first(three, X.squeeze_weights(vs(), w1.tolist(), w2.tolist(), 2))
    z = np.array(ROWS[0]).mean(axis=1)
    assert np.allclose(got, np.maximum(np.maximum(z @ w1, 0) @ w2, 0))


def test_group_bi_interaction_identity(three):
    half = first(three, X.group_bi_interaction([vs()], [], [0.5]))
    assert half == pytest.approx([23.0, 44.0])
    two = first(three, X.group_bi_interaction([vs()[:2], vs()[2:]], [2.0], [0.5, 0.5], [1.0, 1.0], [0.5, 0.5]))
    # sums (4,6) and (5,6); products times 2, then the pair inside the first group, then biases
    assert two == pytest.approx([2 * 20 + 3 + 1.5, 2 * 36 + 8 + 1.5])


def test_cross_layers(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0])], "id int, x array<double>")
    assert X.cross_layers(df, "x", [([1.0, 1.0], [0.0, 0.0])], "o").first()["o"] == [4.0, 8.0]
    w = [[1.0, 2.0], [0.0, 1.0]]
    got = X.cross_layers(df, "x", [(w, [0.5, 0.0])], "o", "matrix").first()["o"]
    assert got == [1 * (1 + 4 + 0.5) + 1, 2 * 2 + 2]


def test_softmax_is_stable_and_gates_sum_to_one(spark):
    got = spark.range(1).select(softmax(literal([1000.0, 1000.0]))).first()[0]
    assert got == pytest.approx([0.5, 0.5])
    assert sum(X.field_gates([0.1, 2.0, -3.0], 0.5)) == pytest.approx(1.0)


def test_log_interaction_against_numpy(three):
    w, b = [[0.5, -1.0], [0.25, 0.1], [1.0, 0.3]], [0.1, -0.2]
    norm = X.folded_norm([0.1, 0.2], [1.0, 2.0], [1.5, 0.5], [0.0, 0.3])
    got = first(three, X.log_transform(vs(), w, b, 2, norm, norm))
    logs = np.log(np.maximum(np.abs(np.array(ROWS[0])), 1e-7)).T * np.array([a for a, _ in norm])[:, None] + np.array([c for _, c in norm])[:, None]
    out = np.exp(logs @ np.array(w) + b) * np.array([a for a, _ in norm])[:, None] + np.array([c for _, c in norm])[:, None]
    assert np.allclose(got, out.ravel())


def test_heads_and_mixture(spark):
    df = spark.createDataFrame([(0, 0.0, 800.0, -800.0)], "id int, z double, big double, low double")
    r = df.select(X.predict_head(F.col("z")), X.predict_head(F.col("big")), X.predict_head(F.col("low")), X.predict_head(F.col("big"), "regression", 1.0)).first()
    assert list(r) == [0.5, 1.0, 0.0, 801.0]
    assert df.select(X.task_product(F.lit(0.2), F.lit(0.5))).first()[0] == pytest.approx(0.1)
    assert df.select(X.linear_logit([])).first()[0] == 0.0
    assert df.select(X.logit_sum(None, F.lit(1.5))).first()[0] == 1.5
    with pytest.raises(ValueError):
        X.region_mixture([F.lit(0.0)], [F.lit(0.0)])
    m = df.select(X.region_mixture([F.lit(0.0), F.lit(0.0)], [F.lit(0.0), F.lit(800.0)])).first()[0]
    assert m == pytest.approx(0.75)


def test_towers_match_numpy_and_sql(three):
    rng = np.random.default_rng(5)
    w1, b1, w2, b2, k = rng.normal(size=(6, 4)), rng.normal(size=4), rng.normal(size=(4, 2)), rng.normal(size=2), rng.normal(size=2)
    norm = (np.array([1.0, 2.0, 0.5, 1.0]), np.array([0.0, 0.1, -0.1, 0.2]))
    tower = Tower([(w1, b1), (w2, b2)], "relu", [norm], "sigmoid")
    df = three.withColumn("x", F.concat(*vs()))
    got = df.orderBy("id").select(tower_output(tower)(F.col("x")).alias("o"), tower_logit(tower, k)(F.col("x")).alias("z")).collect()
    x = np.array(ROWS).reshape(2, 6)
    h = np.maximum((x @ w1 + b1) * norm[0] + norm[1], 0) @ w2 + b2
    o = 1 / (1 + np.exp(-h))
    assert np.allclose([r["o"] for r in got], o) and np.allclose([r["z"] for r in got], o @ k)


def test_attention_net_skips_padding(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], [[3.0, 1.0], None]), (1, [1.0, 0.0], []), (2, [0.0, 1.0], [[1.0, 1.0]])], "id int, q array<double>, k array<array<double>>")
    rng = np.random.default_rng(6)
    w, b, kern = rng.normal(size=(8, 3)), rng.normal(size=3), rng.normal(size=3)
    got = df.orderBy("id").select(attention_scores(Tower([(w, b)], "relu"), kern, 0.5)(F.col("q"), F.col("k"))).collect()

    def score(q, k):
        q, k = np.array(q), np.array(k)
        return float(np.maximum(np.concatenate([q, k, q - k, q * k]) @ w + b, 0) @ kern + 0.5)

    assert got[0][0] == pytest.approx([score([1, 2], [3, 1]), 0.0])
    assert got[1][0] == [] and got[2][0] == pytest.approx([score([0, 1], [1, 1])])


def test_seeded_table_is_recreatable(spark):
    a = emb.create_table(spark, {"f": 50}, 3, seed=1, std=0.1)
    b = emb.create_table(spark, {"f": 50}, 3, seed=1, std=0.1)
    assert {tuple(r["vec"]) for r in a.collect()} == {tuple(r["vec"]) for r in b.collect()}
    x = np.array([r["vec"] for r in a.collect()])
    assert abs(x.mean()) < 0.03 and 0.07 < x.std() < 0.13


def test_wide_and_long_attach_agree(spark):
    df = spark.range(200).select("id", (F.col("id") % 5).cast("string").alias("a"), (F.col("id") * 3 % 7).cast("string").alias("b"))
    vocab = fit_vocabulary(df.where("id < 4"), ["a", "b"])
    ids = vocab.select("feature", "idx").unionByName(vocab.groupBy("feature").agg((F.max("idx") + 1).alias("idx")))
    table = emb.formula_table(ids, ["a", "b"], lambda i, p: F.array(i * 1.0, p + 0.5), lambda i, p: i * 2.0 + p)
    lookup = emb.compose(vocab, table)
    wide = emb.attach(df, ["a", "b"], lookup)
    pick = ["id", "a__w", "a__v", "b__w", "b__v"]
    for limit in (0, 4, 6):  # both fields, one of them, none in long form
        long = emb.attach(df, ["a", "b"], lookup, limit=limit)
        assert long.columns == wide.columns
        assert wide.select(*pick).orderBy("id").collect() == long.select(*pick).orderBy("id").collect()
    assert wide.where("id = 4").first()["a__v"] == [4.0, 0.5]  # unseen category takes the spare row


def test_attach_keeps_null_equal_and_repeated_rows(spark):
    rows = [(1, "a", "x"), (1, "b", None), (None, "b", "x"), (None, "b", "x"), (2, None, "y"), (2, "zz", "y")]
    df = spark.createDataFrame(rows, "id int, a string, b string").repartition(3)
    vocab = fit_vocabulary(df.where("a <> 'zz'"), ["a", "b"])
    ids = vocab.select("feature", "idx").unionByName(vocab.groupBy("feature").agg((F.max("idx") + 1).alias("idx")))
    table = emb.formula_table(ids, ["a", "b"], lambda i, p: F.array(i * 1.0, p + 0.5), lambda i, p: i * 2.0 + p)
    lookup = emb.compose(vocab, table)
    found = [sorted(map(str, emb.attach(df, ["a", "b"], lookup, limit=n).collect())) for n in (None, 0)]
    assert found[0] == found[1] and len(found[0]) == len(rows)
    ids = [sorted(map(str, apply_vocabulary(df, vocab, ["a", "b"], "_i", limit=n).collect())) for n in (10, 0)]
    assert ids[0] == ids[1] and len(ids[0]) == len(rows)
    both = spark.createDataFrame([(f, o, i, [float(i)]) for f, o in (("a", "b"), ("b", "a")) for i in range(3)], "feature string, other string, idx int, vec array<double>")
    coded = apply_vocabulary(df, vocab, ["a", "b"])
    pairs = [sorted(map(str, emb.pair_lookup(coded, ["a", "b"], both, fits=f).collect())) for f in (True, False)]
    assert pairs[0] == pairs[1] and len(pairs[0]) == len(rows)


def test_ids_out_of_range_are_found(spark):
    table = spark.createDataFrame([("f", 0, 0.0, [1.0])], "feature string, idx int, w double, vec array<double>")
    df = spark.createDataFrame([(0,), (3,)], "f int")
    assert [tuple(r) for r in emb.out_of_range(df, ["f"], table).select("feature", "idx").collect()] == [("f", 3)]
    with pytest.raises(ValueError):
        emb.require_in_range(df, ["f"], table)


def _methods(df):
    parts = df._jdf.queryExecution().debug().codegenToSeq()
    return max([parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())], default=0)


@pytest.mark.parametrize("name", ["x4_element_products", "x8_bilinear_all", "x8_bilinear_interaction", "x14_cross_matrix", "x16_field_gating"])
def test_wide_results_stay_below_the_size_the_jvm_compiles(spark, sf, name):
    import __spark_entry__ as entry

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = entry.queries()[name](spark, sf)
        assert _methods(df) < 8000
        assert "zip_with" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_apart_rounding_is_the_rounding_of_decimals(spark):
    values = [0.0000005, -0.0000015, 0.0078125, -0.0078125, 1e-12, -1e-12, 0.0, -0.0, 123456.7890125, 999999.9999995, 5e11, float("nan"), float("inf"), None]
    values += [((i * 7919) % 100003) / 97.0 - 500 for i in range(2000)] + [(i + 0.5) / 1e6 for i in range(-500, 500)]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(rounded(F.col("x")).alias("a"), rounded_apart(F.col("x")).alias("b"))
    assert df.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_long_second_order_of_known_width_moves_one_row_a_key(spark):
    rows = [(i // 3, [0.1 * i, 0.2 - i, 0.3]) for i in range(30)] + [(3, [None, 1.0, 2.0]), (4, None), (98, None), (99, [None, None, None])]
    cells = spark.createDataFrame(rows, "k int, vec array<double>")
    wide, known = X.long_second_order(cells, ["k"]), X.long_second_order(cells, ["k"], 3)
    a, b = ({r["k"]: (r["fm"], r["bi"]) for r in d.collect()} for d in (wide, known))
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip([a[k][0], *a[k][1]], [b[k][0], *b[k][1]]):
            assert (x is None) == (y is None) and (x is None or x == pytest.approx(y))
    assert "Generate" not in known._jdf.queryExecution().toString()
