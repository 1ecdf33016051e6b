import pytest
from pyspark.sql import functions as F

from clickweave.operators import encode as E
from clickweave.operators import prepare as P
from clickweave.operators import splits as S
from clickweave.operators.blocks import global_rank, key_at
from clickweave.operators.joins import hot_keys, lookup_join, split_hot_join
from clickweave.spec import CategoryField, FeatureSpec, NumberField, SequenceField, auto_width


def test_layout_skips_repeats_and_counts_widths():
    seq = SequenceField(CategoryField("hist", 9, table="item"), 4, length_column="n", weight_column="w")
    spec = FeatureSpec.of([CategoryField("a", 3), NumberField("pic", 5), seq, CategoryField("a", 3), NumberField("x")])
    assert spec.layout() == [("a", 0, 1), ("pic", 1, 6), ("hist", 6, 10), ("w", 10, 14), ("n", 14, 15), ("x", 15, 16)]
    assert seq.embedding == "item"
    assert spec.deep_input_width() == 4 + 4 + 4 + 6  # a, hist, a again, then 5 + 1 numbers


def test_unknown_kind_is_a_type_error():
    with pytest.raises(TypeError):
        FeatureSpec.of(["a"])


@pytest.mark.parametrize("v, w", [(16, 12), (81, 18), (10, 6), (1, 6), (255, 18), (256, 24)])
def test_auto_width(v, w):
    assert auto_width(v) == w


def test_schema_check(spark):
    spec = FeatureSpec.of([CategoryField("a", 3), NumberField("v", 2)])
    spec.check(spark.createDataFrame([(1, [0.1, 0.2])], "a bigint, v array<double>"))
    with pytest.raises(ValueError):
        spec.check(spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(TypeError):
        spec.check(spark.createDataFrame([("x", [0.1])], "a string, v array<double>"))


def test_encoder_fixture(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("c",)], "f string")
    vocab = E.fit_vocabulary(fit, ["f"])
    df = spark.createDataFrame([(0, "a"), (1, "z"), (2, None)], "k int, f string")
    assert [r["f"] for r in E.apply_vocabulary(df, vocab, ["f"]).orderBy("k").collect()] == [0, 3, 3]
    shuffled = E.apply_vocabulary(df, vocab, ["f"], limit=0)
    assert [r["f"] for r in shuffled.orderBy("k").collect()] == [0, 3, 3]


def test_encoder_compares_numbers_as_text_and_keeps_null_class(spark):
    fit = spark.createDataFrame([(10,), (9,), (None,)], "f int")
    vocab = {r["category"]: r["idx"] for r in E.fit_vocabulary(fit, ["f"]).collect()}
    assert vocab == {"10": 0, "9": 1, "nan": 2}


def test_both_vocabulary_plans_agree(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 1009).cast("string").alias("a"), (F.col("id") % 3).alias("b"))
    small = {tuple(r) for r in E.fit_vocabulary(df, ["a", "b"]).select("feature", "category", "idx").collect()}
    large = {tuple(r) for r in E.fit_vocabulary(df, ["a", "b"], window_rows=0).select("feature", "category", "idx").collect()}
    assert small == large and len(small) == 1012


def test_scaling_fixture(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in P.apply_ranges(df, P.fit_ranges(df, ["a", "b"])).orderBy("a").collect()] == [(0.0, 0.0), (1.0, 0.0)]


def test_day_and_hour(spark):
    day, hour = P.day_and_hour(F.col("h"))
    assert tuple(spark.createDataFrame([(14102100,)], "h int").select(day, hour).first()) == ("21", "00")


def test_vocabulary_file_fixture(spark):
    vocab = spark.createDataFrame([(1, "lake"), (2, "merson"), (3, "johnson")], "idx int, key string")
    df = spark.createDataFrame([(0, "lake"), (1, "johnson"), (2, "lakemerson")], "k int, c string")
    assert [r["c_idx"] for r in E.lookup_file_vocabulary(df, "c", vocab).orderBy("k").collect()] == [1, 3, 0]


def test_hash_buckets(spark):
    df = spark.createDataFrame([("0",), ("a",), ("b",), ("a",)], "c string")
    got = [tuple(r) for r in df.select("c", E.hash_field(F.col("c"), 7).alias("h"), E.hash_field(F.col("c"), 7, True).alias("z")).collect()]
    assert all(0 <= h < 7 for _, h, _ in got)
    assert [z for c, _, z in got if c == "0"] == [0]
    assert all(1 <= z < 7 for c, _, z in got if c != "0")
    assert got[1] == got[3]


def test_labels_and_fill(spark):
    df = spark.createDataFrame([("x", None), (None, 2.0), ("y", 1.0)], "c string, v double")
    assert sorted(tuple(r) for r in P.fill_missing(df, ["c"], ["v"]).collect()) == [("-1", 2.0), ("x", 0.0), ("y", 1.0)]
    y = P.two_value_label(F.col("c"), {"x": 1, "q": 0})
    assert [r[0] for r in df.select(y).collect()] == [1, None, None]
    assert [r[0] for r in df.select(P.equals_label(F.col("c"), "x")).collect()] == [1, 0, 0]


def test_vector_field_of_wrong_length_fails(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    assert df.select(P.checked_vector(F.col("v"), 2)).first()[0] == [1.0, 2.0]
    with pytest.raises(Exception, match="expected 3 numbers"):
        df.select(P.checked_vector(F.col("v"), 3)).collect()


def test_rank_in_blocks(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"), (F.col("id") % 3).cast("string").alias("g"))
    got = global_rank(df, [F.col("v")], "r", group=["g"], blocks=5)
    want = {}
    for g in "012":
        vs = sorted(i * 37 % 1000 for i in range(1000) if str(i % 3) == g)
        want |= {(g, v): n for n, v in enumerate(vs)}
    assert {(r["g"], r["v"]): r["r"] for r in got.collect()} == want
    assert key_at(df, ["v"], 17) == (17,)
    assert key_at(df, ["v"], 5000) is None


@pytest.mark.parametrize("share", [0.2, 0.5, 0.07])
def test_ordered_split(spark, share):
    # a third of the rows share the leading key
    df = spark.range(301).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("d"), "id")
    got = {r["id"]: r["is_train"] for r in S.ordered_split(df, ["d", "id"], share).collect()}
    order = sorted(range(301), key=lambda i: (5 if i % 3 == 0 else i % 11, i))
    head = int(301 * (1 - share))
    assert got == {i: n < head for n, i in enumerate(order)}


def test_hash_split_is_stable_and_complete(spark):
    df = spark.range(5000)
    train, test = S.hash_split(df, ["id"])
    a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert not a & b and len(a | b) == 5000 and 0.17 < len(b) / 5000 < 0.23
    again = {r[0] for r in S.hash_split(df.repartition(7), ["id"])[0].collect()}
    assert again == a


def test_date_window(spark):
    df = spark.createDataFrame([("20240101",), ("20240108",), ("20240109",), ("20231231",)], "dt string")
    assert sorted(r[0] for r in S.date_window(df, "dt", "20240108").collect()) == ["20240101", "20240108"]


def test_hot_keys_take_the_same_values(spark):
    facts = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("k"))
    table = spark.range(1, 35).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    assert [r["k"] for r in hot_keys(facts, ["k"], 100).collect()] == [1]
    plain = {tuple(r) for r in lookup_join(facts, table, ["k"], ["v"], fits=True).select("id", "k", "v").collect()}
    split = [tuple(r) for r in split_hot_join(facts, table, ["k"], ["v"], least=100).select("id", "k", "v").collect()]
    assert len(split) == 900 and set(split) == plain


def test_long_form(spark):
    df = spark.createDataFrame([(1, "M", 3.0)], "id int, gender string, n double")
    assert sorted(tuple(r) for r in P.long_form(df, ["id"], ["gender"], ["n"]).collect()) == [(1, "gender=M", 1.0), (1, "n", 3.0)]


def test_row_vector(spark):
    spec = FeatureSpec.of([CategoryField("a", 3), NumberField("v", 2)])
    df = spark.createDataFrame([(7, [0.5, 0.25])], "a int, v array<double>")
    assert df.select(P.row_vector(df, spec)).first()[0] == [7.0, 0.5, 0.25]


@pytest.mark.parametrize("hot", [1, 99, None])
def test_a_hot_key_is_dealt_over_all_tasks(spark, hot):
    """Half of the rows share one key: in the table, missing there, or null."""
    facts = spark.range(8000).select("id", F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise(F.col("id") % 1000).cast("int").alias("k"))
    table = spark.range(0, 90).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    was = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(was, ("false", "-1")):
            spark.conf.set(c, v)
        out = split_hot_join(facts, table, ["k"], ["v"], least=100)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        rows = sorted(tuple(r) for r in out.select("id", F.coalesce("v", F.lit(-1))).collect())
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
    key = {r["id"]: r["k"] for r in facts.collect()}
    assert rows == [(i, key[i] * 10 if key[i] is not None and key[i] < 90 else -1) for i in range(8000)]
    assert len(sizes) > 1 and max(sizes) < 1.5 * 8000 / len(sizes)


def test_a_field_the_encoder_does_not_know_is_an_error(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    with pytest.raises(ValueError):
        E.apply_vocabulary(df, E.fit_vocabulary(df, ["a"]), ["a", "b"])
