"""Registered queries: sources, sinks and column preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.functions.scalars import rounded
from clickweave.operators import encode as E
from clickweave.operators import prepare as P
from clickweave.operators import splits as S
from clickweave.plans.catalog import ENC, IMP, ROW, ROW_SQL, r6, register, stored_vocab
from clickweave.plans.impressions import DENSE, GROUPS, KEY, SPARSE, impressions, read
from clickweave.scratch import scratch_path
from clickweave.sources import partitions as PT
from clickweave.sources import tables as T
from clickweave.spec import CategoryField, FeatureSpec, NumberField, SequenceField

# ---- sources and sinks -------------------------------------------------

PART_DDL = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def _csv_round(spark, df, header: bool, sep: str = ","):
    path = scratch_path(spark, "csv")
    df.write.option("header", header).option("sep", sep).option("quote", '"').option("escape", '"').csv(path)
    return path


@register("s1_csv_scan", "SELECT p_partkey, p_name || ', \"' || p_brand || '\"' AS title, p_size, p_retailprice FROM part")
def s1(spark, sf):
    """Titles with commas and quotes survive the trip through a file with a header."""
    title = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("title")
    path = _csv_round(spark, read(spark, sf, "part").select("p_partkey", title, "p_size", "p_retailprice"), True)
    return T.read_csv(spark, path, "p_partkey bigint, title string, p_size int, p_retailprice double")


@register("s2_headless_csv", "SELECT s_suppkey, ' ' || s_name AS s_name, s_acctbal FROM supplier")
def s2(spark, sf):
    """A leading blank is part of the value."""
    df = read(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit(" "), "s_name").alias("s_name"), "s_acctbal")
    path = scratch_path(spark, "csv")
    df.write.option("ignoreLeadingWhiteSpace", False).csv(path)
    return T.read_headless_csv(spark, path, "s_suppkey bigint, s_name string, s_acctbal double")


@register("s3_tsv_scan", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def s3(spark, sf):
    df = read(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = _csv_round(spark, df, False, "\t")
    return T.read_tsv(spark, path, "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double")


@register("s4_parquet_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_discount > 0.05")
def s4(spark, sf):
    df = T.read_parquet(spark, f"{sf}/lineitem.parquet")
    return df.where(F.col("l_discount") > 0.05).select("l_orderkey", "l_linenumber", "l_quantity")


@register("s5_fixed_records", "SELECT o_custkey, o_orderstatus, o_totalprice, o_orderkey FROM orders")
def s5(spark, sf):
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    return T.read_records(spark, f"{sf}/orders.parquet", schema, label="o_orderkey")


@register("s6_model_feed", f"WITH {IMP} SELECT {', '.join(SPARSE)}, {', '.join(DENSE)}, label FROM imp")
def s6(spark, sf):
    return T.feed(impressions(spark, sf), [*SPARSE, *DENSE], "label")


@register("s6_model_feed_unlabelled", f"WITH {IMP} SELECT {', '.join(SPARSE)}, {', '.join(DENSE)} FROM imp")
def s6_unlabelled(spark, sf):
    return T.feed(impressions(spark, sf), [*SPARSE, *DENSE])


DT = "dp AS (SELECT event_id, value, strftime(ts, '%Y%m%d') AS dt, CASE WHEN hour(ts) < 12 THEN '00' ELSE '12' END AS hour FROM events)"


def _by_hour(spark, sf):
    """Events written to and read from a dt=/hour= folder tree."""
    df = read(spark, sf, "events").select(
        "event_id", "value", F.date_format("ts", "yyyyMMdd").alias("dt"),
        F.when(F.hour("ts") < 12, "00").otherwise("12").alias("hour"),
    )
    path = scratch_path(spark, "hours")
    T.write_predictions(df, path)
    return path


@register("s8_latest_partition", f"WITH {DT}, d AS (SELECT * FROM dp WHERE dt = (SELECT max(dt) FROM dp)) SELECT event_id, value, dt, hour FROM d WHERE hour = (SELECT max(hour) FROM d)")
def s8(spark, sf):
    """The newest hour, found by listing folders."""
    return PT.read_newest(spark, _by_hour(spark, sf), "event_id bigint, value double")


@register("s9_latest_partition_by_key", f"WITH {DT} SELECT event_id, value, dt, hour FROM dp WHERE dt || hour = (SELECT max(dt || hour) FROM dp)")
def s9(spark, sf):
    return PT.latest_partition_by_key(PT.read_partitioned(spark, _by_hour(spark, sf), "event_id bigint, value double"))


@register("s11_nested_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def s11(spark, sf):
    """Row structs held in one-element lists, flattened again."""
    cell = F.array(F.struct("o_orderkey", "o_custkey", "o_totalprice")).alias("rows")
    return T.flatten_rows(read(spark, sf, "orders").select(cell), "rows")


VOC_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT {c} AS category FROM imp)"
    for c in SPARSE
)


@register("s12_encoder_store", f"WITH {IMP} {VOC_SQL}")
def s12(spark, sf):
    vocab, _ = stored_vocab(spark, sf)
    path = scratch_path(spark, "encoders")
    T.write_store(vocab, path, "20240101")
    return T.read_store(spark, path, "feature string, category string, idx int")


@register("s13_weight_store", "SELECT vec_id AS idx, label, len(embedding) AS width FROM embeddings")
def s13(spark, sf):
    """Two versions written, the newest read."""
    path = scratch_path(spark, "weights")
    rows = read(spark, sf, "embeddings").select(F.col("vec_id").alias("idx"), "label", "embedding")
    T.write_store(rows.withColumn("label", F.lit(-1)), path, "1")
    T.write_store(rows, path, "2")
    back = T.read_store(spark, path, "idx bigint, label int, embedding array<float>")
    return back.select("idx", "label", F.size("embedding").cast("bigint").alias("width"))


@register("s14_prediction_sink", f"WITH {DT} SELECT dt, hour, count(*) AS n, {r6('sum(value)', 4)} AS total FROM dp GROUP BY dt, hour")
def s14(spark, sf):
    rows = PT.read_partitioned(spark, _by_hour(spark, sf), "event_id bigint, value double")
    return rows.groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("value"), 4).alias("total"))


@register("s16_sample_look", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def s16(spark, sf):
    return T.sample_rows(read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 10, ["o_orderkey"])


# ---- column preparation ------------------------------------------------

@register("f1_feature_selection", f"WITH {IMP} SELECT {', '.join(SPARSE)}, {', '.join(DENSE)}, label FROM imp")
def f1(spark, sf):
    return P.select_features(impressions(spark, sf), [*SPARSE, *DENSE], "label")


@register("f2_derived_columns", "SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS key, l_quantity * l_discount AS value FROM lineitem")
def f2(spark, sf):
    df = read(spark, sf, "lineitem")
    df = P.derive(df, key=F.col("l_orderkey").cast("string"), value=F.col("l_quantity") * F.col("l_discount"))
    return df.select("l_orderkey", "l_linenumber", "key", "value")


@register("f3_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def f3(spark, sf):
    return P.drop_columns(read(spark, sf, "orders"), ["o_orderdate", "o_orderpriority"])


@register("f4_columns_by_exclusion", "SELECT p_partkey, p_size, p_retailprice FROM part")
def f4(spark, sf):
    df = read(spark, sf, "part")
    return df.select(*P.columns_except(df, ["p_name", "p_brand"], ["p_type"]))


@register(
    "f5_null_fill",
    "SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, '-1') AS flag, coalesce(CASE WHEN l_discount > 0.03 THEN l_discount END, 0e0) AS discount FROM lineitem",
)
def f5(spark, sf):
    df = read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_discount") > 0.03, F.col("l_discount")).alias("discount"),
    )
    return P.fill_missing(df, ["flag"], ["discount"])


@register("f6_cast_to_text", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'nan') AS status FROM orders")
def f6(spark, sf):
    return read(spark, sf, "orders").select(
        "o_orderkey", E.as_text(F.col("o_custkey")).alias("cust"),
        E.as_text(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))).alias("status"),
    )


@register("f7_two_value_label", "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 1e0 WHEN 'A' THEN 0e0 END AS y FROM lineitem")
def f7(spark, sf):
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", P.two_value_label(F.col("l_returnflag"), {"R": 1.0, "A": 0.0}).alias("y"))


@register("f8_predicate_label", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS y FROM lineitem")
def f8(spark, sf):
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", P.equals_label(F.col("l_linestatus"), "O").alias("y"))


@register("f9_day_and_hour", "SELECT event_id, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM events")
def f9(spark, sf):
    digits = F.date_format("ts", "yyMMddHH")
    day, hour = P.day_and_hour(digits)
    return read(spark, sf, "events").select("event_id", day.alias("day"), hour.alias("hour"))


@register("f10_label_encode_fit", f"WITH {IMP} {VOC_SQL}")
def f10(spark, sf):
    return E.fit_vocabulary(impressions(spark, sf), SPARSE).select("feature", "category", "idx")


@register("f10_label_encode_fit_in_blocks", f"WITH {IMP} {VOC_SQL}")
def f10_blocks(spark, sf):
    """The plan for vocabularies too large for one window per field."""
    return E.fit_vocabulary(impressions(spark, sf), SPARSE, window_rows=0).select("feature", "category", "idx")


KNOWN = "(SELECT DISTINCT p_brand AS category FROM part WHERE p_size < 3)"


@register(
    "f11_label_encode_apply",
    f"""WITH v AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS idx FROM {KNOWN})
SELECT p_partkey, CAST(coalesce(idx, (SELECT count(*) FROM v)) AS INTEGER) AS p_brand FROM part LEFT JOIN v ON p_brand = category""",
)
def f11(spark, sf):
    """Encoders fitted on small parts only, so that other brands are unseen."""
    part = read(spark, sf, "part")
    vocab = E.fit_vocabulary(part.where("p_size < 3"), ["p_brand"])
    return E.apply_vocabulary(part.select("p_partkey", "p_brand"), vocab, ["p_brand"])


ENCODED_SQL = f"WITH {ENC} SELECT {ROW_SQL}, {', '.join(f'i{f} AS {c}' for f, c in enumerate(SPARSE))} FROM enc"


@register("f11_encode_impressions", ENCODED_SQL)
def f11_impressions(spark, sf):
    vocab, sizes = stored_vocab(spark, sf)
    return E.apply_vocabulary(impressions(spark, sf), vocab, SPARSE, sizes=sizes).select(*ROW, *SPARSE)


@register("f11_encode_impressions_shuffled", ENCODED_SQL)
def f11_shuffled(spark, sf):
    """The plan for fields with more classes than may be broadcast; hot classes stay apart."""
    vocab, sizes = stored_vocab(spark, sf)
    return E.apply_vocabulary(impressions(spark, sf), vocab, SPARSE, limit=0, sizes=sizes).select(*ROW, *SPARSE)


_sizes = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(max(i{f}) + 1 AS BIGINT) AS max_plus_one, count(DISTINCT i{f}) AS n_unique, count(DISTINCT i{f}) + 1 AS with_unseen, "
    f"count(DISTINCT i{f}) * 5 AS hash_space, CAST(6 * floor(pow(count(DISTINCT i{f}), 0.25) + 1e-9) AS BIGINT) AS auto_width FROM enc"
    for f, c in enumerate(SPARSE)
)


@register("f12_vocabulary_size", f"WITH {ENC} {_sizes}")
def f12(spark, sf):
    vocab, sizes = stored_vocab(spark, sf)
    return E.vocabulary_report(E.apply_vocabulary(impressions(spark, sf), vocab, SPARSE, sizes=sizes), SPARSE)


@register(
    "f13_min_max_scaling",
    f"WITH {IMP}, r AS (SELECT " + ", ".join(f"min({c}) AS lo{n}, max({c}) AS hi{n}" for n, c in enumerate(DENSE))
    + f" FROM imp) SELECT {ROW_SQL}, " + ", ".join(f"{r6(f'({c}-lo{n})/(hi{n}-lo{n})')} AS {c}" for n, c in enumerate(DENSE)) + ", 0e0 AS fixed FROM imp, r",
)
def f13(spark, sf):
    df = impressions(spark, sf).withColumn("fixed", F.lit(5.0))
    out = P.apply_ranges(df, P.fit_ranges(df, [*DENSE, "fixed"]))
    return out.select(*ROW, *[rounded(F.col(c)).alias(c) for c in DENSE], rounded(F.col("fixed")).alias("fixed"))


LAYOUT = FeatureSpec.of(
    [CategoryField("i0", 30), CategoryField("i1", 10), NumberField("l_quantity"),
     SequenceField(CategoryField("tok", 20), 3, length_column="tok_n"), CategoryField("i0", 30), NumberField("l_discount")]
)


@register(
    "f14_feature_layout",
    f"WITH {ENC} SELECT {ROW_SQL}, CAST(i0 AS DOUBLE) AS x0, CAST(i1 AS DOUBLE) AS x1, l_quantity AS x2, CAST(length(string_split(p_name, ' ')[1]) AS DOUBLE) AS x3, "
    "CAST(length(string_split(p_name, ' ')[2]) AS DOUBLE) AS x4, 0e0 AS x5, 2e0 AS x6, l_discount AS x7 FROM enc",
)
def f14(spark, sf):
    """Row vectors by declared offsets; the repeated name is laid out once."""
    from clickweave.operators.multivalue import pad, split_values

    vocab, sizes = stored_vocab(spark, sf)
    df = E.apply_vocabulary(impressions(spark, sf, extra=["p_name"]), vocab, SPARSE[:2], sizes=sizes)
    tokens = F.transform(split_values(F.col("p_name"), " "), lambda t: F.length(t))
    df = df.select(*ROW, F.col("p_brand").alias("i0"), F.col("p_type").alias("i1"), "l_quantity", "l_discount",
                   pad(tokens, 3).alias("tok"), F.size(tokens).alias("tok_n"))
    LAYOUT.check(df)
    wide = df.select(*ROW, P.row_vector(df, LAYOUT).alias("x"))
    return wide.select(*ROW, *[F.col("x")[i].alias(f"x{i}") for i in range(LAYOUT.layout()[-1][2])])


@register(
    "f15_vector_dense_feature",
    "SELECT vec_id, len(embedding) AS width, " + r6("CAST(embedding[64] AS DOUBLE)") + " AS last FROM embeddings",
)
def f15(spark, sf):
    df = read(spark, sf, "embeddings").select("vec_id", P.checked_vector(F.col("embedding"), 64).alias("v"))
    return df.select("vec_id", F.size("v").cast("bigint").alias("width"), rounded(F.col("v")[63].cast("double")).alias("last"))


@register("f16_dense_transform", "SELECT l_orderkey, l_linenumber, " + r6("ln(1e0 + l_extendedprice)") + " AS l_extendedprice, " + r6("sqrt(l_quantity)") + " AS l_quantity FROM lineitem")
def f16(spark, sf):
    df = P.transform_numbers(read(spark, sf, "lineitem"), {"l_extendedprice": F.log1p, "l_quantity": F.sqrt})
    return df.select("l_orderkey", "l_linenumber", rounded(F.col("l_extendedprice")).alias("l_extendedprice"), rounded(F.col("l_quantity")).alias("l_quantity"))


def md5_bucket(text: str, n: int) -> str:
    return f"(('0x' || md5({text})[1:15])::BIGINT % {n})"


@register(
    "f17_hash_bucket",
    f"""SELECT o_orderkey, {md5_bucket('o_orderpriority', 1000)} AS bucket, {md5_bucket('CAST(o_custkey AS VARCHAR)', 1000)} AS number_bucket,
    TRUE AS others_in_range FROM orders""",
)
def f17(spark, sf):
    """Buckets by md5, which SQL can repeat; those by Spark's hash and by the fingerprint lie in range."""
    c = F.col("o_custkey")
    others = [E.hash_field(c, 1000, kind=k) for k in ("xxhash64", "fingerprint")]
    df = read(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey", *[o.alias(f"_{i}") for i, o in enumerate(others)])
    return df.select(
        "o_orderkey", E.hash_field(F.col("o_orderpriority"), 1000, kind="md5").alias("bucket"),
        E.hash_field(c, 1000, kind="md5").alias("number_bucket"),
        (F.col("_0").between(0, 999) & F.col("_1").between(0, 999)).alias("others_in_range"),
    )


@register(
    "f18_hash_bucket_keep_zero",
    f"""SELECT {ROW_SQL}, CASE WHEN k = 0 THEN 0 ELSE 1 + {md5_bucket('CAST(k AS VARCHAR)', 499)} END AS bucket, k = 0 AS zero
    FROM (SELECT *, l_partkey % 50 AS k FROM lineitem)""",
)
def f18(spark, sf):
    """Zero stays zero for every hash, and only zero does."""
    k = F.col("l_partkey") % 50
    df = read(spark, sf, "lineitem").select(*ROW, k.alias("k"), *[E.hash_field(k, 500, True, kind).alias(kind) for kind in ("md5", "xxhash64", "fingerprint")])
    agree = F.when((F.col("xxhash64") == 0) == (F.col("fingerprint") == 0), F.col("xxhash64") == 0)
    return df.select(*ROW, F.col("md5").alias("bucket"), agree.alias("zero"))


@register(
    "f19_vocabulary_file",
    "WITH v AS (SELECT key, row_number() OVER (ORDER BY key) AS idx FROM (SELECT DISTINCT p_type AS key FROM part WHERE p_type <> 'PROMO')) "
    "SELECT p_partkey, coalesce(idx, 0) AS p_type_idx FROM part LEFT JOIN v ON p_type = key",
)
def f19(spark, sf):
    """A headless ``index,key`` file written from the part types, one type left out."""
    part = read(spark, sf, "part")
    keys = E.fit_vocabulary(part.where("p_type <> 'PROMO'"), ["p_type"])
    path = scratch_path(spark, "vocab")
    keys.select(F.col("idx") + 1, "category").write.csv(path)
    vocab = T.read_headless_csv(spark, path, "idx int, key string")
    return E.lookup_file_vocabulary(part.select("p_partkey", "p_type"), "p_type", vocab).select("p_partkey", "p_type_idx")


_long = " UNION ALL ".join(
    [f"SELECT {ROW_SQL}, '{c}=' || {c} AS feature, 1e0 AS x FROM imp" for c in SPARSE] + [f"SELECT {ROW_SQL}, '{c}' AS feature, {c} AS x FROM imp" for c in DENSE]
)


@register("f21_long_field_form", f"WITH {IMP} {_long}")
def f21(spark, sf):
    return P.long_form(impressions(spark, sf), ROW, SPARSE, DENSE)


_group_case = " ".join(f"WHEN feature IN ({', '.join(repr(f) for f in fs)}) THEN '{g}'" for g, fs in GROUPS.items())


@register(
    "f22_field_groups",
    f"WITH {IMP}, lg AS ({' UNION ALL '.join(f'SELECT {chr(39)}{c}{chr(39)} AS feature, {c} AS category, label FROM imp' for c in SPARSE)}) "
    f"SELECT CASE {_group_case} END AS field_group, count(*) AS n, CAST(sum(label) AS BIGINT) AS clicks, count(DISTINCT category) AS categories FROM lg GROUP BY 1",
)
def f22(spark, sf):
    """Per (group, category) counts first, so a group never gathers rows."""
    long = E.long_fields(impressions(spark, sf), SPARSE, keep=["label"])
    cells = long.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("clicks"))
    grouped = cells.withColumn("field_group", P.group_of(GROUPS, F.col("feature")))
    return grouped.groupBy("field_group").agg(F.sum("n").alias("n"), F.sum("clicks").alias("clicks"), F.countDistinct("category").alias("categories"))


@register("f23_encode_with_spec", ENCODED_SQL)
def f23(spark, sf):
    vocab, _ = stored_vocab(spark, sf)
    df, spec = P.encode_with_spec(impressions(spark, sf), vocab, SPARSE, DENSE, 8)
    spec.check(df)
    return df.select(*ROW, *SPARSE)


@register(
    "f24_random_split",
    f"WITH {IMP} SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice)) AS keys, "
    "TRUE AS fifth, TRUE AS unbiased, TRUE AS apart FROM imp",
)
def f24(spark, sf):
    """A key-hash split: no row lost, a fifth tested, the label's mean alike on both sides (within five standard
    errors), no key on both sides."""
    train, test = S.hash_split(impressions(spark, sf), KEY)
    both = train.withColumn("side", F.lit(0)).unionByName(test.withColumn("side", F.lit(1)))
    keys = both.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.sum("side").alias("tested"), F.sum("label").alias("y"))
    tested, y = F.sum("tested"), F.sum(F.when(F.col("tested") > 0, F.col("y")).otherwise(0))
    told = keys.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"), tested.alias("t"), F.sum("y").alias("all"), y.alias("yt"),
        F.min((F.col("tested") == 0) | (F.col("tested") == F.col("n"))).alias("apart"),
    )
    error = F.sqrt(F.lit(0.25) / F.col("t") + F.lit(0.25) / (F.col("n") - F.col("t")))
    return told.select(
        "n", "keys", (F.abs(F.col("t") / F.col("n") - 0.2) < 2.5 / F.sqrt("n")).alias("fifth"),
        (F.abs(F.col("yt") / F.col("t") - (F.col("all") - F.col("yt")) / (F.col("n") - F.col("t"))) < 5 * error).alias("unbiased"), "apart",
    )


def _tail_sql(share: float) -> str:
    order = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
    return (
        f"SELECT {ROW_SQL}, row_number() OVER (ORDER BY {order}) <= floor((SELECT count(*) FROM lineitem) * {share}) AS is_train FROM lineitem"
    )


def _tail(share: float):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return lambda spark, sf: S.ordered_split(read(spark, sf, "lineitem"), order, share).select(*ROW, "is_train")


register("f25_ordered_tail_split", _tail_sql(0.8))(_tail(0.2))
register("f26_validation_tail_split", _tail_sql(0.75))(_tail(0.25))


@register(
    "f27_date_window",
    "SELECT event_id, strftime(ts, '%Y%m%d') AS dt FROM events WHERE strftime(ts, '%Y%m%d') BETWEEN '20240108' AND '20240115'",
)
def f27(spark, sf):
    df = read(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("dt"))
    return S.date_window(df, "dt", "20240115", 7)


@register("f28_row_shuffle")
def f28(spark, sf):
    """Rows only: seeded order of the whole table."""
    return S.shuffled(read(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])
