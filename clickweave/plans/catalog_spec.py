"""Registered queries: schemas with every kind of field, compiled into one plan and scored."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.functions.towers import Tower
from clickweave.operators import embedding as emb
from clickweave.operators import multivalue as M
from clickweave.operators.encode import fit_vocabulary, vocabulary_sizes
from clickweave.plans.catalog import ENC, ROW_SQL, lit, mat, nums, r6, register, row_with, sig, spark_vec, spark_weight, sql_cell, sql_weight, stored_vocab
from clickweave.plans.catalog_interactions import tower_ctes
from clickweave.plans.catalog_prepare import md5_bucket
from clickweave.plans.compiled import StoredModel, compile_spec, score_spec
from clickweave.plans.impressions import SPARSE, impressions
from clickweave.scratch import pin
from clickweave.spec import CategoryField, FeatureSpec, NumberField, SequenceField

D, KEPT, EPS = 4, 3, "1e-8"
TOKENS = """tok AS (SELECT p_partkey, string_split(p_name, ' ') AS t FROM part),
kept AS (SELECT p_partkey, unnest(t[greatest(len(t) - 2, 1):]) AS token, generate_subscripts(t[greatest(len(t) - 2, 1):], 1) AS pos FROM tok),
voc AS (SELECT token, dense_rank() OVER (ORDER BY token) - 1 AS idx FROM (SELECT DISTINCT unnest(t) AS token FROM tok))"""


def with_tokens(spark, sf):
    return impressions(spark, sf, extra=["p_name"]).withColumn("tokens", M.split_values(F.col("p_name"), " "))


def token_vocab(spark, sf):
    return fit_vocabulary(with_tokens(spark, sf).select(F.explode("tokens").alias("tokens")), ["tokens"])


def text_model(spark, sf, fields: list[str]) -> StoredModel:
    """Encoders of the impression fields and of the tokens; vectors of every class and of the unseen one."""
    vocab = pin(stored_vocab(spark, sf)[0].unionByName(token_vocab(spark, sf)).where(F.col("feature").isin(fields)), "vocab")
    spare = spark.createDataFrame(list(vocabulary_sizes(vocab).items()), "feature string, idx int")
    ids = vocab.select("feature", "idx").unionByName(spare)
    return StoredModel(pin(emb.formula_table(ids, fields, spark_vec(D), spark_weight), "model"), vocab)


def vectors_sql(cells: dict[str, str], weights: dict[str, str]) -> str:
    return ", ".join(f"{x} AS {n}" for n, x in (cells | weights).items())


def fm_of(names: list[str]) -> str:
    parts = []
    for d in range(D):
        s = "+".join(f"{n}_{d}" for n in names)
        q = "+".join(f"{n}_{d}*{n}_{d}" for n in names)
        parts.append(f"(({s})*({s})-({q}))")
    return "0.5e0*(" + "+".join(parts) + ")"


MULTI = ["p_brand", "p_type", "tokens"]
_pooled = ", ".join(f"sum({sql_cell('idx', 2, d)})/(count(*)+{EPS}) AS t_{d}" for d in range(D))
_multi = f"""WITH {ENC},
{TOKENS},
pool AS (SELECT p_partkey, {_pooled}, sum({sql_weight('idx', 2)})/(count(*)+{EPS}) AS tw FROM kept JOIN voc USING (token) GROUP BY p_partkey),
v AS (SELECT enc.*, {', '.join(f"{sql_cell(f'i{f}', f, d)} AS f{f}_{d}" for f in range(2) for d in range(D))}, {sql_weight('i0', 0)} AS w0, {sql_weight('i1', 1)} AS w1,
  {', '.join(f't_{d}' for d in range(D))}, tw FROM enc JOIN pool ON l_partkey = p_partkey)
SELECT {ROW_SQL}, {r6(sig(f"w0+w1+tw+l_quantity*0.01e0+{fm_of(['f0', 'f1', 't'])}-0.1e0"))} AS score FROM v"""


def multi_spec():
    tokens = CategoryField("tokens", 0, D, dtype="string")
    return FeatureSpec.of([CategoryField("p_brand", 0, D), CategoryField("p_type", 0, D), SequenceField(tokens, KEPT), NumberField("l_quantity")])


@register("p3_spec_multivalue", _multi)
def p3_multi(spark, sf):
    """Two encoded fields and a multi-value one (its last three values, averaged) in all parts of the score."""
    compiled = compile_spec(multi_spec(), text_model(spark, sf, MULTI))
    return row_with(score_spec(with_tokens(spark, sf), compiled, [0.01], bias=-0.1), score=F.col("score"))


@register("p3_spec_multivalue_long", _multi)
def p3_multi_long(spark, sf):
    """The same with every table beyond the broadcast bound."""
    compiled = compile_spec(multi_spec(), text_model(spark, sf, MULTI))
    return row_with(score_spec(with_tokens(spark, sf), compiled, [0.01], bias=-0.1, limit=0), score=F.col("score"))


HASHED = {"l_suppkey": 50, "p_type": 20, "tokens": 40}
_soft = ", ".join(f"sum(exp(pos*0.5e0)*{sql_cell('b', 2, d)})/sum(exp(pos*0.5e0)) AS t_{d}" for d in range(D))
_hashed = f"""WITH {ENC},
{TOKENS},
hb AS (SELECT p_partkey, pos, 1 + {md5_bucket('token', 39)} AS b FROM kept),
pool AS (SELECT p_partkey, {_soft}, sum(exp(pos*0.5e0)*{sql_weight('b', 2)})/sum(exp(pos*0.5e0)) AS tw FROM hb GROUP BY p_partkey),
h AS (SELECT *, {md5_bucket('CAST(l_suppkey AS VARCHAR)', 50)} AS b0, {md5_bucket('p_type', 20)} AS b1 FROM enc),
v AS (SELECT h.*, {', '.join(f"{sql_cell(f'b{f}', f, d)} AS f{f}_{d}" for f in range(2) for d in range(D))}, {sql_weight('b0', 0)} AS w0, {sql_weight('b1', 1)} AS w1,
  {', '.join(f't_{d}' for d in range(D))}, tw FROM h JOIN pool ON l_partkey = p_partkey)
SELECT {ROW_SQL}, {r6(sig(f"w0+w1+tw+{fm_of(['f0', 'f1', 't'])}"))} AS score FROM v"""


@register("p3_spec_hashed", _hashed)
def p3_hashed(spark, sf):
    """Two hashed fields and a hashed sequence with soft-maxed weights; nothing is fitted."""
    ids = None
    for name, n in HASHED.items():
        own = spark.range(n).select(F.lit(name).alias("feature"), F.col("id").cast("int").alias("idx"))
        ids = own if ids is None else ids.unionByName(own)
    model = StoredModel(pin(emb.formula_table(ids, list(HASHED), spark_vec(D), spark_weight), "model"), hash_kind="md5")
    fields = [CategoryField(f, HASHED[f], D, hashed=True) for f in ("l_suppkey", "p_type")]
    tokens = SequenceField(CategoryField("tokens", HASHED["tokens"], D, hashed=True, dtype="string"), KEPT, "sum", weight_column="weights")
    df = with_tokens(spark, sf)
    # weights are by place among the kept values, so they are counted from the end
    last = F.size("tokens") - KEPT
    df = df.withColumn("weights", F.transform("tokens", lambda _, i: (i + 1 - F.greatest(last, F.lit(0))) * 0.5))
    return row_with(score_spec(df, compile_spec(FeatureSpec.of([*fields, tokens]), model), []), score=F.col("score"))


GROUP_OF = {"p_brand": "item", "p_type": "item", "c_mktsegment": "user", "o_orderpriority": "context", "o_orderstatus": "context", "n_name": "context"}
ALL = [*SPARSE, "tokens"]
NAMES = {f: f"f{i}" for i, f in enumerate(SPARSE)} | {"tokens": "t"}
ORDER = ["p_brand", "p_type", "tokens", "c_mktsegment", "o_orderpriority", "o_orderstatus", "n_name"]
_inputs = [f"{NAMES[f]}_{d}" for f in ORDER for d in range(D)] + ["(l_quantity/50e0)"]
TOWER = Tower([(mat(len(_inputs), 5, 700), nums(5, 701))])
TOWER_KERNEL = nums(5, 702)
_layers, _last = tower_ctes("v", _inputs, TOWER)
_seq = len(SPARSE)
_pool6 = ", ".join(f"sum({sql_cell('idx', _seq, d)}) AS t_{d}" for d in range(D))
_groups = f"""WITH {ENC},
{TOKENS},
pool AS (SELECT p_partkey, {_pool6}, sum({sql_weight('idx', _seq)}) AS tw FROM kept JOIN voc USING (token) GROUP BY p_partkey),
v AS (SELECT enc.*, {', '.join(f"{sql_cell(f'i{f}', f, d)} AS f{f}_{d}" for f in range(_seq) for d in range(D))}, {', '.join(f"{sql_weight(f'i{f}', f)} AS w{f}" for f in range(_seq))},
  {', '.join(f't_{d}' for d in range(D))}, tw FROM enc JOIN pool ON l_partkey = p_partkey){_layers}
SELECT {ROW_SQL}, {r6(sig("+".join(f"w{f}" for f in range(_seq)) + "+tw+(l_quantity/50e0)*0.3e0+" + fm_of(['f0', 'f1', 't']) + "+" + fm_of(['f3', 'f4', 'f5']) + "+" + "+".join(f"{x}*{lit(k)}" for x, k in zip(_last, TOWER_KERNEL))))} AS score FROM t0"""


@register("p4_spec_groups", _groups)
def p4_groups(spark, sf):
    """Second order inside two of three groups, and a tower over all fields; the number is transformed by the schema."""
    tokens = CategoryField("tokens", 0, D, dtype="string", group="item")
    fields = [CategoryField(f, 0, D, group=GROUP_OF[f]) for f in SPARSE]
    number = NumberField("l_quantity", transform=lambda c: c / 50.0)
    compiled = compile_spec(FeatureSpec.of([*fields, SequenceField(tokens, KEPT, "sum"), number]), text_model(spark, sf, ALL))
    df = score_spec(with_tokens(spark, sf), compiled, [0.3], groups=["item", "context"], tower=TOWER, tower_kernel=TOWER_KERNEL)
    return row_with(df, score=F.col("score"))
