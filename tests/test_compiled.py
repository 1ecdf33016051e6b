"""Schemas compiled into plans: every kind of field, by hand and in both plans; the fingerprint's known values."""

import math

import pytest
from pyspark.sql import functions as F

from clickweave.functions.fingerprint import fingerprint64, fingerprint_bucket
from clickweave.operators.encode import hash_field
from clickweave.plans.compiled import StoredModel, compile_spec, score_spec
from clickweave.spec import CategoryField, FeatureSpec, NumberField, SequenceField

EPS = 1e-8
# embedding name -> vectors by id; weight is ten times the first number
VECTORS = {
    "item": {0: [1.0, 2.0], 1: [3.0, -1.0], 2: [0.5, 0.5]},  # a, b, unseen
    "bucket": {i: [i * 0.1, -i * 0.2] for i in range(6)},
    "file": {0: [9.0, 9.0], 7: [0.3, 0.4]},
    "tag": {1: [1.0, 0.0], 2: [0.0, 1.0], 3: [2.0, 2.0]},
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(n, i, 10 * v[0], v) for n, own in VECTORS.items() for i, v in own.items()]
    table = spark.createDataFrame(rows, "feature string, idx int, w double, vec array<double>")
    vocab = spark.createDataFrame([("item", "a", 0), ("item", "b", 1)], "feature string, category string, idx int")
    return StoredModel(table, vocab, {"words.csv": spark.createDataFrame([(7, "yes")], "idx int, key string")}, "md5")


SPEC = FeatureSpec.of(
    [
        CategoryField("first", 0, 2, table="item"),
        CategoryField("h", 6, 2, hashed=True, table="bucket", group="g"),
        CategoryField("word", 0, 2, vocabulary_path="words.csv", table="file"),
        SequenceField(CategoryField("seen", 0, 2, table="item", dtype="string"), 2),
        SequenceField(CategoryField("tags", 4, 2, table="tag"), 3, "sum", weight_column="tag_w", weight_norm=False),
        SequenceField(CategoryField("capped", 4, 2, table="tag"), 3, "max", length_column="n"),
        SequenceField(CategoryField("hs", 6, 2, hashed=True, table="bucket", group="g"), 2, "sum"),
        NumberField("x", transform=lambda c: c * 2),
        NumberField("pair", 2),
    ]
)
SCHEMA = "id int, first string, h int, word string, seen array<string>, tags array<int>, tag_w array<double>, capped array<int>, n int, hs array<string>, x double, pair array<double>"
ROWS = [
    (1, "a", 5, "yes", ["a", "b", "b"], [1, 2, 0], [0.5, 2.0, 9.0], [1, 2, 3], 2, ["u", "0"], 1.0, [1.0, 2.0]),
    (1, "zz", 6, "no", ["zz", "a"], [3], [1.0], [1, 2], 1, ["0", "v"], -1.0, [0.0, 0.0]),
    (None, None, None, None, [None, "b"], [], [], [], 0, [], 0.5, [1.0, 1.0]),
    (None, None, None, None, [None, "b"], [], [], [], 0, [], 0.5, [1.0, 1.0]),
    (2, "b", 0, "yes", None, None, None, None, None, None, 0.0, [0.0, 1.0]),
    (3, "b", 1, "yes", [], [1, 2, 3, 3], [9.0, 1.0, 1.0, 1.0], [1, 2, 3, 3], 4, ["u", "u", "v"], 0.0, [0.0, 1.0]),
]


def by_hand(spark):
    """field -> (w, vec) of each row."""
    said = spark.createDataFrame([(t,) for t in ["5", "6", "nan", "0", "1", "u", "v"]], "t string")
    plain = {r["t"]: r["b"] for r in said.select("t", hash_field(F.col("t"), 6, kind="md5").alias("b")).collect()}
    kept = {r["t"]: r["b"] for r in said.select("t", hash_field(F.col("t"), 6, True, "md5").alias("b")).collect()}

    def one(name, i):
        v = VECTORS[name].get(i)
        return (None, None) if v is None else (10 * v[0], v)

    def pooled(name, ids, weights, mode):
        cells = [[10 * VECTORS[name][i][0], *VECTORS[name][i]] for i in ids]
        cells = [[x * w for x in c] for c, w in zip(cells, weights)]
        if mode == "max":
            out = [max(c[d] for c in cells) if cells else None for d in range(3)]
        else:
            out = [sum(c[d] for c in cells) / (len(cells) + EPS if mode == "mean" else 1.0) for d in range(3)]
        return out[0], out[1:]

    out = []
    for _, first, h, word, seen, tags, tag_w, capped, n, hs, *_ in ROWS:
        code = {"a": 0, "b": 1}
        row = {"first": one("item", code.get(first, 2)), "h": one("bucket", plain["nan" if h is None else str(h)])}
        row["word"] = one("file", {"yes": 7}.get(word, -1))
        ids = [code.get(t, 2) for t in (seen or [])[-2:] if t is not None]
        row["seen"] = pooled("item", ids, [1.0] * len(ids), "mean")
        own = [(t, w) for t, w in list(zip(tags or [], tag_w or []))[-3:] if t]
        row["tags"] = pooled("tag", [t for t, _ in own], [w for _, w in own], "sum")
        cut = max(len(capped or []) - 3, 0)
        row["capped"] = pooled("tag", (capped or [])[cut:][: (n or 0) - cut], [1.0] * 9, "max")
        ids = [kept[t] for t in (hs or [])[-2:] if t != "0"]
        row["hs"] = pooled("bucket", ids, [1.0] * len(ids), "sum")
        out.append(row)
    return out


def near(a, b):
    return (a is None) == (b is None) and (a is None or a == pytest.approx(b))


def test_every_kind_of_field_in_both_plans(spark, model):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "at int, " + SCHEMA).repartition(3)
    compiled, want = compile_spec(SPEC, model), by_hand(spark)
    for limit in (None, 0, 3):
        met = compiled.attach(df, limit)
        assert met.columns[: len(df.columns)] == df.columns
        got = sorted(met.collect(), key=lambda r: r["at"])
        assert len(got) == len(ROWS)
        for r, w in zip(got, want):
            for f, (weight, vec) in w.items():
                have = r[f"{f}__v"]
                assert near(r[f"{f}__w"], weight), (limit, r["at"], f)
                assert have is None and vec is None or all(near(a, b) for a, b in zip(have, vec)), (limit, r["at"], f, have, vec)


def test_score_uses_groups_numbers_and_transforms(spark, model):
    df = spark.createDataFrame(ROWS[:1], SCHEMA)
    compiled, want = compile_spec(SPEC, model), by_hand(spark)[0]
    assert compiled.grouped() == {"default_group": ["first", "word", "seen", "tags", "capped"], "g": ["h", "hs"]}

    def fm(names):
        cells = [want[n][1] for n in names]
        return sum((sum(c[d] for c in cells) ** 2 - sum(c[d] ** 2 for c in cells)) / 2 for d in range(2))

    linear = sum(w for w, _ in want.values()) + 0.1 * 2.0 + 0.2 * 1.0 + 0.3 * 2.0
    groups = compiled.grouped()
    for chosen in (None, ["g"], []):
        z = linear + sum(fm(n) for g, n in groups.items() if chosen is None or g in chosen) - 50
        got = score_spec(df, compiled, [0.1, 0.2, 0.3], bias=-50.0, groups=chosen).first()["score"]
        assert got == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
    width = len(compiled.attach(df).select(compiled.tower_input().alias("x")).first()["x"])
    assert width == 7 * 2 + 3


def test_several_widths_and_empty_tables(spark, model):
    with pytest.raises(ValueError):
        compile_spec(FeatureSpec.of([CategoryField("first", 0, 2, table="item"), CategoryField("h", 6, 3, hashed=True)]), model)
    assert score_spec(spark.createDataFrame([], SCHEMA), compile_spec(SPEC, model), [0.1, 0.2, 0.3]).count() == 0


def test_fingerprint_known_values(spark):
    # published values: buckets of the letters and of three words, and signed fingerprints of three texts
    assert [fingerprint64(x) for x in (b"a", b"b", b"c", b"d")] == [12917804110809363939, 11795596070477164822, 11430444447143000872, 4470636696479570465]
    assert [fingerprint64(x) % 3 for x in (b"Hello", b"TensorFlow", b"2.x")] == [0, 2, 2]
    signed = [fingerprint64(x) - (1 << 64 if fingerprint64(x) >> 63 else 0) for x in (b"1footrue", b"2applefalse", b"3true")]
    assert signed == [-1541654101129638711, 2794438866806483259, -4880158226897771312]
    texts = ["", "a", "Hello", None, "é" * 9, "x" * 17, "x" * 33, "x" * 64, "x" * 65, "x" * 129, "x" * 1000]
    df = spark.createDataFrame([(t,) for t in texts * 3], "t string").repartition(3)
    for r in df.select("t", fingerprint_bucket(F.col("t"), 1000).alias("b")).collect():
        assert r["b"] == (None if r["t"] is None else fingerprint64(r["t"].encode()) % 1000)
    many = {fingerprint64(b"x" * n) for n in range(300)}
    assert len(many) == 300 and len({x % 64 for x in many}) == 64
    zeros = spark.createDataFrame([("0",), ("0.0",), ("5",)], "t string")
    for kind in ("xxhash64", "md5", "fingerprint"):
        got = [r[0] for r in zeros.select(hash_field(F.col("t"), 7, True, kind)).collect()]
        assert got[:2] == [0, 0] and 1 <= got[2] < 7
