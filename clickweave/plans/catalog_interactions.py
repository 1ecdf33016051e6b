"""Registered queries: lookups, interactions and scoring on the impression table."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.functions.scalars import rounded
from clickweave.functions.towers import Tower
from clickweave.functions.vectors import column_sum, elements, in_small_methods, literal, total
from clickweave.operators import embedding as emb
from clickweave.operators import interactions as X
from clickweave.operators.encode import apply_vocabulary
from clickweave.operators.prepare import checked_vector
from clickweave.plans import scoring
from clickweave.plans.catalog import (
    ENC, KERNEL, NF, ORACLE, PAIRS, QUERIES, ROW, ROW_SQL, LINEAR_SQL, all_ids, attached, dot_sql, fm_dim_sql, fm_sql,
    lit, mat, nums, r6, register, row_with, row_with_vector, select_sql, sig, spark_vec, sql_cell, stored_model,
    stored_vocab, vec_cte, vecs, wts,
)
from clickweave.plans.impressions import DENSE, GROUPS, KEY, SPARSE, impressions, read
from clickweave.plans.recipes import RECIPES, Parts, score_recipe

D = 4  # width of the pair-heavy queries
WIDE = 8  # width of the scoring queries


def numbers():
    return [F.col(c) for c in DENSE]


# ---- first and second order --------------------------------------------

@register("x1_linear_logit", select_sql(WIDE, linear=LINEAR_SQL))
def x1(spark, sf):
    return row_with(attached(spark, sf, WIDE), linear=X.linear_logit(wts(), numbers(), KERNEL))


@register("x2_fm_second_order", select_sql(WIDE, fm=fm_sql(WIDE)))
def x2(spark, sf):
    return row_with(attached(spark, sf, WIDE), fm=X.fm_second_order(vecs(), WIDE))


@register("x2_fm_second_order_long", select_sql(WIDE, fm=fm_sql(WIDE)))
def x2_long(spark, sf):
    """The plan for tables too wide to gather: cells aggregated per row key."""
    df = attached(spark, sf, WIDE)
    cells = df.select(*KEY, F.explode(F.array(*vecs())).alias("vec"))
    return row_with(X.long_second_order(cells, KEY, WIDE), fm=F.col("fm"))


@register("x3_bi_interaction", select_sql(WIDE, **{f"c{d}": f"0.5e0*{fm_dim_sql(d)}" for d in range(WIDE)}))
def x3(spark, sf):
    return row_with_vector(attached(spark, sf, WIDE), X.bi_interaction(vecs(), WIDE), WIDE)


# ---- pairs -------------------------------------------------------------

@register("x4_inner_products", select_sql(D, **{f"p{n}": dot_sql(i, j, D) for n, (i, j) in enumerate(PAIRS)}))
def x4(spark, sf):
    return row_with(attached(spark, sf, D), **{f"p{n}": c for n, c in enumerate(X.inner_products(vecs(), D))})


@register(
    "x4_element_products",
    select_sql(D, **{f"p{n}_{d}": f"e{i}_{d}*e{j}_{d}" for n, (i, j) in enumerate(PAIRS) for d in range(D)}),
)
def x4_elements(spark, sf):
    cur = attached(spark, sf, D).select(*ROW, X.pair_products(vecs(), D).alias("_p"))
    return row_with(cur, **{f"p{n}_{d}": F.col("_p")[n][d] for n in range(len(PAIRS)) for d in range(D)})


def _outer_sql(kind: str) -> dict[str, str]:
    out = {}
    for n, (i, j) in enumerate(PAIRS):
        if kind == "mat":
            k = mat(D, D, n)
            x = "+".join(f"e{j}_{a}*{lit(k[a][b])}*e{i}_{b}" for a in range(D) for b in range(D))
        elif kind == "vec":
            x = "+".join(f"{lit(v)}*e{i}_{d}*e{j}_{d}" for d, v in enumerate(nums(D, n)))
        else:
            x = f"{lit(nums(len(PAIRS), 3)[n])}*{dot_sql(i, j, D)}"
        out[f"p{n}"] = x
    return out


def _outer(kind: str):
    kernels = {
        "mat": [mat(D, D, n) for n in range(len(PAIRS))],
        "vec": [nums(D, n) for n in range(len(PAIRS))],
        "num": nums(len(PAIRS), 3),
    }[kind]
    return lambda spark, sf: row_with(
        attached(spark, sf, D), **{f"p{n}": c for n, c in enumerate(X.outer_products(vecs(), kernels, kind, D))}
    )


for _kind in ("mat", "vec", "num"):
    register(f"x5_outer_products_{_kind}", select_sql(D, **_outer_sql(_kind)))(_outer(_kind))

STRENGTH = nums(len(PAIRS), 5)
FW_SQL = "+".join(f"{lit(r)}*{dot_sql(i, j, D)}" for r, (i, j) in zip(STRENGTH, PAIRS))


@register("x6_field_weighted", select_sql(D, fw=FW_SQL))
def x6(spark, sf):
    return row_with(attached(spark, sf, D), fw=X.field_weighted(vecs(), STRENGTH, D))


FE_KERNELS = [mat(D, D, 100 + n) for n in range(len(PAIRS))]


def _fe_sql(n: int) -> str:
    (i, j), k = PAIRS[n], FE_KERNELS[n]
    return "(" + "+".join(f"e{i}_{a}*{lit(k[a][b] + k[b][a])}*e{j}_{b}" for a in range(D) for b in range(D)) + ")"


@register("x7_field_embedded", select_sql(D, **{f"p{n}": _fe_sql(n) for n in range(len(PAIRS))}))
def x7(spark, sf):
    return row_with(attached(spark, sf, D), **{f"p{n}": c for n, c in enumerate(X.field_embedded(vecs(), FE_KERNELS, D))})


def _bilinear_kernels(kind: str):
    if kind == "all":
        return mat(D, D, 7)
    return [mat(D, D, 200 + n) for n in range(NF if kind == "each" else len(PAIRS))]


def _bilinear_cell(kind: str, n: int, b: int, left=lambda i, a: f"e{i}_{a}", right=lambda j, b: f"e{j}_{b}") -> str:
    i, j = PAIRS[n]
    k = _bilinear_kernels(kind)
    k = k if kind == "all" else k[i] if kind == "each" else k[n]
    return "(" + "+".join(f"{left(i, a)}*{lit(k[a][b])}" for a in range(D)) + f")*{right(j, b)}"


def _bilinear(kind: str):
    def run(spark, sf):
        products = X.bilinear(vecs(), _bilinear_kernels(kind), kind, D)
        return row_with(attached(spark, sf, D), **{f"p{n}_{b}": p[b] for n, p in enumerate(products) for b in range(D)})

    return run


for _kind in ("all", "each", "interaction"):
    register(
        f"x8_bilinear_{_kind}",
        select_sql(D, **{f"p{n}_{b}": _bilinear_cell(_kind, n, b) for n in range(len(PAIRS)) for b in range(D)}),
    )(_bilinear(_kind))

ATT = 3
ATT_W, ATT_B, ATT_H, ATT_P = mat(D, ATT, 11), nums(ATT, 12), nums(ATT, 13), nums(D, 14)


def _att_ctes() -> str:
    """Pair scores, then their softmax, as two more common table expressions."""
    scores = []
    for n, (i, j) in enumerate(PAIRS):
        hidden = [
            "greatest(0e0, " + "+".join(f"e{i}_{d}*e{j}_{d}*{lit(ATT_W[d][t])}" for d in range(D)) + f"+{lit(ATT_B[t])})"
            for t in range(ATT)
        ]
        scores.append("exp(" + "+".join(f"{h}*{lit(ATT_H[t])}" for t, h in enumerate(hidden)) + f") AS x{n}")
    norm = "+".join(f"x{n}" for n in range(len(PAIRS)))
    shares = ", ".join(f"x{n}/({norm}) AS a{n}" for n in range(len(PAIRS)))
    return vec_cte(D) + f",\nraw AS (SELECT *, {', '.join(scores)} FROM vec),\natt AS (SELECT *, {shares} FROM raw)"


AFM_SQL = "(" + "+".join(
    f"a{n}*(" + "+".join(f"e{i}_{d}*e{j}_{d}*{lit(ATT_P[d])}" for d in range(D)) + ")" for n, (i, j) in enumerate(PAIRS)
) + ")"


def _with_attention(spark, sf):
    df = attached(spark, sf, D).withColumn("_pairs", X.pair_products(vecs(), D))
    return X.with_pair_attention(df, "_pairs", len(PAIRS), ATT_W, ATT_B, ATT_H, "_att")


@register("x9_attentional_fm", f"WITH {_att_ctes()}\nSELECT {ROW_SQL}, {r6(AFM_SQL)} AS afm FROM att")
def x9(spark, sf):
    df = in_small_methods(_with_attention(spark, sf), afm=X.attentional_fm(F.col("_pairs"), F.col("_att"), ATT_P, len(PAIRS)))
    return row_with(df, afm=F.col("afm"))


_pair_rows = " UNION ALL ".join(f"SELECT '{SPARSE[i]}:{SPARSE[j]}' AS pair, a{n} AS a FROM att" for n, (i, j) in enumerate(PAIRS))


@register(
    "x10_pair_weight_report",
    f"WITH {_att_ctes()}\nSELECT pair, {r6('avg(a)')} AS mean_weight, {r6('max(a)')} AS max_weight FROM ({_pair_rows}) GROUP BY pair",
)
def x10(spark, sf):
    names = [f"{SPARSE[i]}:{SPARSE[j]}" for i, j in PAIRS]
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("pair"), F.col("_att").alias("a"))
    long = _with_attention(spark, sf).select(F.inline(pairs))
    return long.groupBy("pair").agg(rounded(F.avg("a")).alias("mean_weight"), rounded(F.max("a")).alias("max_weight"))


# ---- field weighting ---------------------------------------------------

RED = 2
SQ1, SQ2 = mat(NF, RED, 21), mat(RED, NF, 22)


def _squeeze_ctes(dim: int) -> str:
    means = ", ".join("(" + "+".join(f"e{f}_{d}" for d in range(dim)) + f")/{dim}e0 AS z{f}" for f in range(NF))
    hidden = ", ".join(
        "greatest(0e0, " + "+".join(f"z{f}*{lit(SQ1[f][t])}" for f in range(NF)) + f") AS h{t}" for t in range(RED)
    )
    gains = ", ".join(
        "greatest(0e0, " + "+".join(f"h{t}*{lit(SQ2[t][f])}" for t in range(RED)) + f") AS g{f}" for f in range(NF)
    )
    return (
        vec_cte(dim) + f",\nsq0 AS (SELECT *, {means} FROM vec),\nsq1 AS (SELECT *, {hidden} FROM sq0),\n"
        f"sq AS (SELECT *, {gains} FROM sq1)"
    )


_scaled = ", ".join(f"{r6(f'e{f}_{d}*g{f}')} AS v{f}_{d}" for f in range(NF) for d in range(D))


@register("x11_field_reweighting", f"WITH {_squeeze_ctes(D)}\nSELECT {ROW_SQL}, {_scaled} FROM sq")
def x11(spark, sf):
    df = attached(spark, sf, D).withColumn("_g", X.squeeze_weights(vecs(), SQ1, SQ2, D))
    df = df.select(*ROW, F.array(*X.reweight(vecs(), F.col("_g"))).alias("_v"))
    return row_with(df, **{f"v{f}_{d}": F.col("_v")[f][d] for f in range(NF) for d in range(D)})


GROUP_FIELDS = [[SPARSE.index(f) for f in fs] for fs in GROUPS.values()]
GROUP_PAIRS = X.pairs(len(GROUP_FIELDS))
K_MF, K_FM = nums(len(GROUP_PAIRS), 31), nums(len(GROUP_FIELDS), 32)
B_MF, B_FM = nums(D, 33), nums(D, 34)


def _group_dim(d: int) -> str:
    s = ["(" + "+".join(f"e{f}_{d}" for f in fs) + ")" for fs in GROUP_FIELDS]
    terms = [f"{lit(k)}*{s[a]}*{s[b]}" for k, (a, b) in zip(K_MF, GROUP_PAIRS)]
    terms += [f"{lit(k)}*{fm_dim_sql(d, fs)}" for k, fs in zip(K_FM, GROUP_FIELDS)]
    return "(" + "+".join([*terms, lit(B_MF[d]), lit(B_FM[d])]) + ")"


@register("x12_group_bi_interaction", select_sql(D, **{f"c{d}": _group_dim(d) for d in range(D)}))
def x12(spark, sf):
    groups = [[F.col(f"{f}__v") for f in fs] for fs in GROUPS.values()]
    return row_with_vector(attached(spark, sf, D), X.group_bi_interaction(groups, K_MF, K_FM, B_MF, B_FM), D)


# ---- cross layers ------------------------------------------------------

N_IN = NF * D + len(DENSE)


def _x0(i: int) -> str:
    return f"e{i // D}_{i % D}" if i < NF * D else f"({DENSE[i - NF * D]}/1000000e0)"


def _x0_spark():
    return F.concat(*vecs(), F.array(*[F.col(c) / 1000000.0 for c in DENSE]))


CROSS_V = [(nums(N_IN, 41 + n), nums(N_IN, 51 + n)) for n in range(2)]
CROSS_M = [(mat(N_IN, N_IN, 61), nums(N_IN, 71))]


def _cross_v_sql() -> str:
    ctes = vec_cte(D) + ",\nx0 AS (SELECT *, " + ", ".join(f"{_x0(i)} AS x0_{i}" for i in range(N_IN)) + " FROM vec)"
    for n, (w, b) in enumerate(CROSS_V):
        s = "+".join(f"x{n}_{i}*{lit(w[i])}" for i in range(N_IN))
        ctes += f",\ns{n} AS (SELECT *, {s} AS sc{n} FROM x{n})"
        cells = ", ".join(f"x0_{i}*sc{n}+{lit(b[i])}+x{n}_{i} AS x{n + 1}_{i}" for i in range(N_IN))
        ctes += f",\nx{n + 1} AS (SELECT *, {cells} FROM s{n})"
    last = len(CROSS_V)
    return f"WITH {ctes}\nSELECT {ROW_SQL}, " + ", ".join(f"{r6(f'x{last}_{i}')} AS c{i}" for i in range(N_IN)) + f" FROM x{last}"


@register("x13_cross_vector", _cross_v_sql())
def x13(spark, sf):
    df = attached(spark, sf, D).withColumn("_x0", _x0_spark())
    return row_with_vector(X.cross_layers(df, "_x0", CROSS_V, "_x"), F.col("_x"), N_IN)


def _cross_m_sql() -> str:
    w, b = CROSS_M[0]
    ctes = vec_cte(D) + ",\nx0 AS (SELECT *, " + ", ".join(f"{_x0(i)} AS x0_{i}" for i in range(N_IN)) + " FROM vec)"
    cells = ", ".join(
        r6(f"x0_{i}*(" + "+".join(f"{lit(w[i][j])}*x0_{j}" for j in range(N_IN)) + f"+{lit(b[i])})+x0_{i}") + f" AS c{i}"
        for i in range(N_IN)
    )
    return f"WITH {ctes}\nSELECT {ROW_SQL}, {cells} FROM x0"


@register("x14_cross_matrix", _cross_m_sql())
def x14(spark, sf):
    df = attached(spark, sf, D).withColumn("_x0", _x0_spark())
    return row_with_vector(X.cross_layers(df, "_x0", CROSS_M, "_x", "matrix"), F.col("_x"), N_IN)


# ---- factors, gates, logs ----------------------------------------------

FACTOR_ROWS = mat(NF, NF * D, 81)


def _ifm_sql() -> str:
    flat = [f"e{f}_{d}" for f in range(NF) for d in range(D)]
    logits = ", ".join("exp(" + "+".join(f"{lit(k)}*{x}" for k, x in zip(FACTOR_ROWS[f], flat)) + f") AS l{f}" for f in range(NF))
    norm = "+".join(f"l{f}" for f in range(NF))
    ms = ", ".join(f"{NF}e0*l{f}/({norm}) AS m{f}" for f in range(NF))
    fm = []
    for d in range(D):
        s = "+".join(f"m{f}*e{f}_{d}" for f in range(NF))
        q = "+".join(f"m{f}*e{f}_{d}*m{f}*e{f}_{d}" for f in range(NF))
        fm.append(f"(({s})*({s})-({q}))")
    linear = "+".join(f"m{f}*w{f}" for f in range(NF)) + "+" + "+".join(f"{c}*{lit(k)}" for c, k in zip(DENSE, KERNEL))
    return (
        f"WITH {vec_cte(D)},\nlg AS (SELECT *, {logits} FROM vec),\nfa AS (SELECT *, {ms} FROM lg)\n"
        f"SELECT {ROW_SQL}, {r6(linear)} AS linear, {r6('0.5e0*(' + '+'.join(fm) + ')')} AS fm FROM fa"
    )


@register("x15_input_aware_fm", _ifm_sql())
def x15(spark, sf):
    from clickweave.functions.vectors import matvec

    df = attached(spark, sf, D).withColumn(
        "_m", X.input_aware_factors(matvec(literal(FACTOR_ROWS), F.concat(*vecs())), NF)
    )
    m = [F.col("_m").getItem(i) for i in range(NF)]
    df = df.withColumns({f"_r{i}": c for i, c in enumerate(X.reweight(vecs(), F.col("_m")))})
    return row_with(
        df, linear=X.linear_logit(wts(), numbers(), KERNEL, refine=m),
        fm=X.fm_second_order([F.col(f"_r{i}") for i in range(NF)], D),
    )


GATES = nums(NF, 91)
_gate_norm = "(" + "+".join(f"exp({lit(g)}/2e0)" for g in GATES) + ")"


@register(
    "x16_field_gating",
    select_sql(D, **{f"v{f}_{d}": f"e{f}_{d}*exp({lit(GATES[f])}/2e0)/{_gate_norm}" for f in range(NF) for d in range(D)}),
)
def x16(spark, sf):
    gated = X.gate(vecs(), GATES, 2.0, D)
    return row_with(attached(spark, sf, D), **{f"v{f}_{d}": v[d] for f, v in enumerate(gated) for d in range(D)})


NEURONS = 2
LOG_W, LOG_B = mat(NF, NEURONS, 95), nums(NEURONS, 96)
NORM_IN = X.folded_norm([0.1] * D, [1.5] * D, [0.9] * D, [0.05] * D)
NORM_OUT = X.folded_norm([0.3] * D, [0.8] * D, [1.1] * D, [-0.2] * D)


def _log_cell(d: int, h: int) -> str:
    z = "+".join(
        f"{lit(LOG_W[f][h])}*(ln(greatest(abs(e{f}_{d}),1e-7))*{lit(NORM_IN[d][0])}+{lit(NORM_IN[d][1])})" for f in range(NF)
    )
    return f"exp({z}+{lit(LOG_B[h])})*{lit(NORM_OUT[d][0])}+{lit(NORM_OUT[d][1])}"


@register("x17_log_interaction", select_sql(D, **{f"c{d * NEURONS + h}": _log_cell(d, h) for d in range(D) for h in range(NEURONS)}))
def x17(spark, sf):
    df = attached(spark, sf, D)
    return row_with_vector(df, X.log_transform(vecs(), LOG_W, LOG_B, D, NORM_IN, NORM_OUT), D * NEURONS)


# ---- field-aware -------------------------------------------------------

def pair_cell(idx: str, f: int, o: int, d: int) -> str:
    return f"((({idx}*29+{f * 19 + o * 23 + d * 7}) % 83)/83e0-0.5e0)"


def pair_table(spark, sf, fields=SPARSE):
    """Field-aware vectors for every (field, other field, id)."""
    vocab, sizes = stored_vocab(spark, sf)
    pos = F.create_map(*[x for i, f in enumerate(SPARSE) for x in (F.lit(f), F.lit(i))])
    ids = all_ids(spark, vocab, sizes)
    others = ids.select("feature", "idx", F.explode(F.array(*[F.lit(f) for f in SPARSE])).alias("other"))
    f, o = pos[F.col("feature")], pos[F.col("other")]
    vec = F.transform(
        F.sequence(F.lit(0), F.lit(D - 1)),
        lambda d: ((F.col("idx") * 29 + f * 19 + o * 23 + d * 7) % 83) / 83.0 - 0.5,
    )
    return others.where(F.col("feature") != F.col("other")).select("feature", "other", "idx", vec.alias("vec"))


def encoded(spark, sf, suffix: str = ""):
    vocab, sizes = stored_vocab(spark, sf)
    return apply_vocabulary(impressions(spark, sf), vocab, SPARSE, suffix, sizes=sizes)


@register(
    "e10_field_aware_lookup",
    f"WITH {ENC}\nSELECT {ROW_SQL}, "
    + ", ".join(f"{r6(pair_cell(f'i{a}', a, b, 0))} AS s{a}_{b}" for a in range(NF) for b in range(NF) if a != b)
    + " FROM enc",
)
def e10(spark, sf):
    df = emb.pair_lookup(encoded(spark, sf), SPARSE, pair_table(spark, sf), fits=True)
    return row_with(
        df, **{f"s{a}_{b}": F.col(f"{SPARSE[a]}__for__{SPARSE[b]}")[0] for a in range(NF) for b in range(NF) if a != b}
    )


def _aware_sum(a: int, b: int) -> str:
    return "+".join(f"{pair_cell(f'i{a}', a, b, d)}*{pair_cell(f'i{b}', b, a, d)}" for d in range(D))


@register(
    "e10_field_aware_lookup_long",
    f"WITH {ENC}\nSELECT {ROW_SQL}, "
    + ", ".join(f"{r6(pair_cell(f'i{a}', a, b, 0))} AS s{a}_{b}" for a in range(NF) for b in range(NF) if a != b)
    + " FROM enc",
)
def e10_long(spark, sf):
    """All fields in one shuffled join, as tables too large to broadcast need it."""
    df = emb.pair_lookup(encoded(spark, sf), SPARSE, pair_table(spark, sf), fits=False)
    return row_with(
        df, **{f"s{a}_{b}": F.col(f"{SPARSE[a]}__for__{SPARSE[b]}")[0] for a in range(NF) for b in range(NF) if a != b}
    )


@register(
    "x18_field_aware_products",
    f"WITH {ENC}\nSELECT {ROW_SQL}, " + ", ".join(f"{r6(_aware_sum(a, b))} AS p{n}" for n, (a, b) in enumerate(PAIRS)) + " FROM enc",
)
def x18(spark, sf):
    df = emb.pair_lookup(encoded(spark, sf), SPARSE, pair_table(spark, sf), fits=True)
    return row_with(df, **{f"p{n}": c for n, c in enumerate(X.field_aware_products(SPARSE, reduce_sum=True))})


# ---- heads -------------------------------------------------------------

@register("x19_prediction_head", select_sql(WIDE, binary_score=sig(f"{LINEAR_SQL}+0.1e0"), regression_score=f"{LINEAR_SQL}+0.1e0"))
def x19(spark, sf):
    logit = X.linear_logit(wts(), numbers(), KERNEL)
    return row_with(
        attached(spark, sf, WIDE), binary_score=X.predict_head(logit, "binary", 0.1),
        regression_score=X.predict_head(logit, "regression", 0.1),
    )


REGIONS = 3


def _region_sql() -> str:
    lg = [" + ".join(f"e{f}_{r}" for f in range(NF)) for r in range(2 * REGIONS)]
    norm = "(" + "+".join(f"exp({lg[r]})" for r in range(REGIONS)) + ")"
    return "(" + "+".join(f"exp({lg[r]})/{norm}*{sig(lg[REGIONS + r])}" for r in range(REGIONS)) + ")"


@register("x20_region_mixture", select_sql(2 * REGIONS, score=_region_sql(), biased=f"{_region_sql()}*{sig('+'.join(f'w{f}' for f in range(NF)))}"))
def x20(spark, sf):
    df = attached(spark, sf, 2 * REGIONS)
    at = [X.linear_logit([v.getItem(r) for v in vecs()]) for r in range(2 * REGIONS)]
    region, learner = at[:REGIONS], at[REGIONS:]
    return row_with(
        df, score=X.region_mixture(region, learner),
        biased=X.region_mixture(region, learner, bias_logit=X.linear_logit(wts())),
    )


@register("x21_logit_sum", select_sql(WIDE, logit=f"{LINEAR_SQL} + {fm_sql(WIDE)}", only_linear=LINEAR_SQL))
def x21(spark, sf):
    linear, fm = X.linear_logit(wts(), numbers(), KERNEL), X.fm_second_order(vecs(), WIDE)
    return row_with(attached(spark, sf, WIDE), logit=X.logit_sum(linear, fm), only_linear=X.logit_sum(linear, None))


_cvr = sig(fm_sql(WIDE))


@register("x22_task_product", select_sql(WIDE, ctcvr=f"{sig(LINEAR_SQL)}*{_cvr}"))
def x22(spark, sf):
    ctr = X.predict_head(X.linear_logit(wts(), numbers(), KERNEL))
    return row_with(attached(spark, sf, WIDE), ctcvr=X.task_product(ctr, X.predict_head(X.fm_second_order(vecs(), WIDE))))


# ---- embedding tables --------------------------------------------------

@register(
    "e1_embedding_table_create",
    f"WITH {ENC}, u AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, max(i{f}) + 2 AS n FROM enc" for f, c in enumerate(SPARSE))
    + f") SELECT feature, CAST(n AS BIGINT) AS ids, CAST(n * {WIDE} AS BIGINT) AS cells, TRUE AS centred, TRUE AS scaled, TRUE AS again FROM u",
)
def e1(spark, sf):
    """Seeded normals from a hash: per table its size, mean and spread within five standard errors, and the same again."""
    _, sizes = stored_vocab(spark, sf)
    table = emb.create_table(spark, {f: n + 1 for f, n in sizes.items()}, WIDE, seed=7)
    again = emb.create_table(spark, {f: n + 1 for f, n in sizes.items()}, WIDE, seed=7).select("feature", "idx", F.col("vec").alias("vec2"))
    both = table.join(again, ["feature", "idx"])
    cells = both.select("feature", "idx", (F.col("vec") == F.col("vec2")).alias("same"), F.explode("vec").alias("x"))
    sizes_ = [F.countDistinct("idx").alias("ids"), F.count("x").alias("cells"), F.avg("x").alias("mean"), F.stddev("x").alias("std"), F.min("same").alias("again")]
    found = cells.groupBy("feature").agg(*sizes_)
    root = F.sqrt(F.col("cells"))
    return found.select(
        "feature", "ids", "cells", (F.abs("mean") < 5 * 1e-4 / root).alias("centred"),
        (F.abs(F.col("std") - 1e-4) < 5 * 1e-4 / root).alias("scaled"), "again",
    )


_pick = {f"s{f}": "+".join(f"e{f}_{d}" for d in range(WIDE)) for f in range(NF)}


@register("e2_embedding_lookup", select_sql(WIDE, **_pick))
def e2(spark, sf):
    """Lookup by id: encoded columns meet one table, field by field."""
    m = stored_model(spark, sf, WIDE)
    df = encoded(spark, sf)
    for f in SPARSE:
        df = emb.lookup(df, f, m.table, f, f, fits=m.sizes[f] + 1 <= 500_000)
    return row_with(df, **{f"s{i}": column_sum(elements(F.col(f"{f}__v"), WIDE)) for i, f in enumerate(SPARSE)})


@register(
    "e3_shared_table_lookup",
    "SELECT e.event_id, " + r6("t0.s") + " AS current_sum, " + r6("coalesce(t1.s, 0e0)") + " AS previous_sum FROM ("
    "SELECT event_id, dense_rank() OVER (ORDER BY event_type) AS i, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pt, event_type FROM events) e"
    " JOIN (SELECT event_type, " + "+".join(sql_cell("i", 0, d) for d in range(D)) + " AS s FROM (SELECT event_type, row_number() OVER (ORDER BY event_type) AS i FROM (SELECT DISTINCT event_type FROM events))) t0 ON e.event_type = t0.event_type"
    " LEFT JOIN (SELECT event_type, " + "+".join(sql_cell("i", 0, d) for d in range(D)) + " AS s FROM (SELECT event_type, row_number() OVER (ORDER BY event_type) AS i FROM (SELECT DISTINCT event_type FROM events))) t1 ON e.pt = t1.event_type",
)
def e3(spark, sf):
    """Current and previous item of a user read the same table."""
    from clickweave.operators.history import behaviour_history
    from clickweave.plans.catalog_sequences import item_events

    events, table, n = item_events(spark, sf, D)
    hist = behaviour_history(events, "user_id", ["ts", "event_id"], "item", 1)
    hist = hist.withColumn("previous", F.get("hist", F.lit(0)))
    df = emb.lookup(hist, "item", table, "item", "current", fits=n <= 500_000)
    df = emb.lookup(df, "previous", table, "item", "previous", fits=n <= 500_000)
    return df.select(
        "event_id", rounded(total(F.col("current__v"))).alias("current_sum"),
        rounded(F.coalesce(total(F.col("previous__v")), F.lit(0.0))).alias("previous_sum"),
    )


@register(
    "e4_id_range_check",
    "SELECT 'l_partkey' AS feature, CAST(l_partkey AS BIGINT) AS idx FROM (SELECT DISTINCT l_partkey FROM lineitem) "
    "WHERE l_partkey NOT IN (SELECT vec_id FROM embeddings)",
)
def e4(spark, sf):
    """Part keys without a pretrained vector."""
    table = emb.from_vectors(read(spark, sf, "embeddings"), "l_partkey", "vec_id", "embedding")
    return emb.out_of_range(read(spark, sf, "lineitem"), ["l_partkey"], table).select("feature", "idx")


@register(
    "e5_pretrained_load",
    "SELECT vec_id, label, len(embedding) AS width, " + r6("list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE)))", 5)
    + " AS total FROM embeddings",
)
def e5(spark, sf):
    raw = read(spark, sf, "embeddings")
    table = emb.from_vectors(raw.withColumn("embedding", checked_vector(F.col("embedding"), 64)), "frozen", "vec_id", "embedding")
    return table.join(raw.select(F.col("vec_id").alias("idx"), "label"), "idx").select(
        F.col("idx").alias("vec_id"), "label", F.size("vec").cast("bigint").alias("width"), rounded(total(F.col("vec")), 5).alias("total")
    )


@register(
    "e6_embedding_export",
    f"WITH {ENC} " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, idx, " + ", ".join(f"{r6(sql_cell('idx', f, d))} AS c{d}" for d in range(D))
        + f" FROM (SELECT DISTINCT i{f} AS idx FROM enc UNION SELECT max(i{f}) + 1 FROM enc)" for f, c in enumerate(SPARSE)
    ),
)
def e6(spark, sf):
    """Weights by embedding name through the versioned store."""
    from clickweave.scratch import scratch_path
    from clickweave.sources.tables import read_store, write_store

    m = stored_model(spark, sf, D)
    path = scratch_path(spark, "weights")
    write_store(m.table.select("feature", "idx", "w", "vec"), path, "1")
    back = read_store(spark, path, "feature string, idx int, w double, vec array<double>")
    return back.select("feature", "idx", *[rounded(F.col("vec")[d]).alias(f"c{d}") for d in range(D)])


@register(
    "e7_deep_input",
    select_sql(D, **{f"c{f * D + d}": f"e{f}_{d}" for f in range(NF) for d in range(D)}, **{f"c{NF * D + n}": c for n, c in enumerate(DENSE)}),
)
def e7(spark, sf):
    return row_with_vector(attached(spark, sf, D), emb.deep_input(vecs(), numbers()), NF * D + len(DENSE))


@register("e8_dense_values", f"SELECT l_orderkey, l_linenumber, l_partkey, {', '.join(f'{r6(c)} AS c{n}' for n, c in enumerate(DENSE))} FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def e8(spark, sf):
    from clickweave.operators.prepare import dense_values

    return row_with_vector(impressions(spark, sf), dense_values(DENSE), len(DENSE))


@register("e9_first_order_weights", select_sql(D, **{f"w{f}": f"w{f}" for f in range(NF)}))
def e9(spark, sf):
    return row_with(attached(spark, sf, D), **{f"w{i}": w for i, w in enumerate(wts())})


# ---- scoring -----------------------------------------------------------

FM_SCORE = sig(f"{LINEAR_SQL} + {fm_sql(WIDE)} - 0.05e0")


@register("p3_linear_fm_scoring", select_sql(WIDE, score=FM_SCORE))
def p3(spark, sf):
    m = stored_model(spark, sf, WIDE)
    df = scoring.score_fm(impressions(spark, sf), SPARSE, DENSE, m.lookup, WIDE, KERNEL, bias=-0.05)
    return row_with(df, score=F.col("score"))


@register("p3_linear_fm_scoring_long", select_sql(WIDE, score=FM_SCORE))
def p3_long(spark, sf):
    """The same score through the shuffled plan used when a table is too large to broadcast."""
    m = stored_model(spark, sf, WIDE)
    df = scoring.score_fm(impressions(spark, sf), SPARSE, DENSE, m.lookup, WIDE, KERNEL, bias=-0.05, limit=0)
    return row_with(df, score=F.col("score"))


# numbers are brought near 1 so that the towers do not saturate
HID = (6, 3)


def _tower(n_in: int, seed: int = 300, hidden=HID, activation="relu") -> Tower:
    sizes = [n_in, *hidden]
    return Tower([(mat(a, b, seed + n), nums(b, seed + 50 + n)) for n, (a, b) in enumerate(zip(sizes, sizes[1:]))], activation)


def tower_ctes(source: str, inputs: list[str], tower: Tower, tag: str = "t") -> tuple[str, list[str]]:
    """Layers of a tower as common table expressions over ``source``; names of the last units."""
    cur, ctes, src = inputs, "", source
    kind = tower.activation
    for n, (w, b) in enumerate(tower.layers):
        cells = []
        for u in range(len(b)):
            z = "+".join(f"{x}*{lit(w[i][u])}" for i, x in enumerate(cur)) + f"+{lit(b[u])}"
            cells.append((f"greatest(0e0, {z})" if kind == "relu" else sig(z)) + f" AS {tag}{n}_{u}")
        ctes += f",\n{tag}{n} AS (SELECT *, {', '.join(cells)} FROM {src})"
        src, cur = f"{tag}{n}", [f"{tag}{n}_{u}" for u in range(len(b))]
    return ctes, cur


FLAT8 = [f"e{f}_{d}" for f in range(NF) for d in range(WIDE)] + DENSE
TOWER8 = _tower(len(FLAT8))
TK8 = [1e-6 * x for x in nums(HID[-1], 333)]
_ct8, _last8 = tower_ctes("vec", FLAT8, TOWER8)
_deep8 = "+".join(f"{x}*{lit(k)}" for x, k in zip(_last8, TK8))


@register("p2_dense_tower", f"WITH {vec_cte(WIDE)}{_ct8}\nSELECT {ROW_SQL}, {r6(_deep8)} AS logit FROM t1")
def p2(spark, sf):
    from clickweave.functions.towers import tower_logit

    df = attached(spark, sf, WIDE).select(*ROW, emb.deep_input(vecs(), numbers()).alias("_in"))
    return row_with(df.withColumn("logit", tower_logit(TOWER8, TK8)(F.col("_in"))), logit=F.col("logit"))


@register(
    "p4_linear_fm_tower_scoring",
    f"WITH {vec_cte(WIDE)}{_ct8}\nSELECT {ROW_SQL}, {r6(sig(f'{LINEAR_SQL} + {fm_sql(WIDE)} + {_deep8}'))} AS score FROM t1",
)
def p4(spark, sf):
    m = stored_model(spark, sf, WIDE)
    df = scoring.score_deep_fm(
        impressions(spark, sf), SPARSE, DENSE, m.lookup, WIDE, KERNEL, TOWER8, TK8
    )
    return row_with(df, score=F.col("score"))


@register("p5_attentional_scoring", f"WITH {_att_ctes()}\nSELECT {ROW_SQL}, {r6(sig(f'{LINEAR_SQL} + {AFM_SQL}'))} AS score FROM att")
def p5_att(spark, sf):
    m = stored_model(spark, sf, D)
    df = scoring.score_attentional(
        impressions(spark, sf), SPARSE, DENSE, m.lookup, KERNEL, ATT_W, ATT_B, ATT_H, ATT_P
    )
    return row_with(df, score=F.col("score"))


@register("p5_field_weighted_scoring", select_sql(D, score=sig(f"{LINEAR_SQL} + {FW_SQL}")))
def p5_fw(spark, sf):
    m = stored_model(spark, sf, D)
    df = scoring.score_field_weighted(impressions(spark, sf), SPARSE, DENSE, m.lookup, KERNEL, STRENGTH)
    return row_with(df, score=F.col("score"))


@register("p5_region_scoring", select_sql(2 * REGIONS, score=_region_sql()))
def p5_regions(spark, sf):
    m = stored_model(spark, sf, 2 * REGIONS)
    df = scoring.score_regions(impressions(spark, sf), SPARSE, m.lookup, REGIONS)
    return row_with(df, score=F.col("score"))


# ---- recipes -----------------------------------------------------------
# dense inputs of the recipes are scaled copies, so that towers and crosses stay small

SCALED = ["n0", "n1", "n2"]
SCALES = [50.0, 0.1, 1000000.0]
_scaled_cte = vec_cte(D) + ",\nvec2 AS (SELECT *, " + ", ".join(f"{c}/{lit(s)} AS {n}" for n, c, s in zip(SCALED, DENSE, SCALES)) + " FROM vec)"
RK = [0.3, -0.2, 0.1]
R_LINEAR = " + ".join(f"w{f}" for f in range(NF)) + " + " + " + ".join(f"{n}*{lit(k)}" for n, k in zip(SCALED, RK))
VEC_SQL = [f"e{f}_{d}" for f in range(NF) for d in range(D)]
BI_SQL = [f"0.5e0*{fm_dim_sql(d)}" for d in range(D)]
INNER_SQL = [dot_sql(i, j, D) for i, j in PAIRS]
OUTER_SQL = list(_outer_sql("mat").values())
FE_SQL = [_fe_sql(n) for n in range(len(PAIRS))]
GROUP_SQL = [_group_dim(d) for d in range(D)]
LOG_SQL = [_log_cell(d, h) for d in range(D) for h in range(NEURONS)]
BIL_SQL = [_bilinear_cell("interaction", n, b) for n in range(len(PAIRS)) for b in range(D)]
SBIL_SQL = [
    _bilinear_cell("interaction", n, b, lambda i, a: f"e{i}_{a}*g{i}", lambda j, b: f"e{j}_{b}*g{j}")
    for n in range(len(PAIRS)) for b in range(D)
]
AWARE_SQL = [f"{pair_cell(f'i{a}', a, b, d)}*{pair_cell(f'i{b}', b, a, d)}" for a, b in PAIRS for d in range(D)]
BLOCK_SQL = {
    "vectors": VEC_SQL, "numbers": SCALED, "bi": BI_SQL, "inner": INNER_SQL, "outer": OUTER_SQL, "embedded_pairs": FE_SQL,
    "groups": GROUP_SQL, "log": LOG_SQL, "bilinear": BIL_SQL, "squeezed_bilinear": SBIL_SQL, "field_aware": AWARE_SQL,
}
R_IN = NF * D + len(SCALED)
R_CROSS = [(nums(R_IN, 141), nums(R_IN, 151))]


def _cross_cells() -> list[str]:
    x = VEC_SQL + SCALED
    w, b = R_CROSS[0]
    s = "(" + "+".join(f"{v}*{lit(k)}" for v, k in zip(x, w)) + ")"
    return [f"({v}*{s}+{lit(k)}+{v})" for v, k in zip(x, b)]


def _recipe_parts(name: str, spark=None, sf=None) -> Parts:
    r = RECIPES[name]
    width = sum(len(BLOCK_SQL[b]) for b in r.deep)
    beside = sum(len(_cross_cells()) if b == "cross" else len(BLOCK_SQL[b]) for b in r.beside)
    tower = _tower(width, 400) if r.deep else None
    last = beside + (HID[-1] if r.deep else 0)
    return Parts(
        fields=SPARSE, numbers=SCALED, dim=D, kernel=RK, tower=tower, tower_kernel=nums(last, 500), groups=GROUPS,
        weights={
            "outer": [mat(D, D, n) for n in range(len(PAIRS))], "embedded": FE_KERNELS,
            "bilinear": _bilinear_kernels("interaction"), "squeezed": _bilinear_kernels("interaction"),
            "squeeze1": SQ1, "squeeze2": SQ2, "k_mf": K_MF, "k_fm": K_FM, "b_mf": B_MF, "b_fm": B_FM,
            "log_w": LOG_W, "log_b": LOG_B, "log_norm_in": NORM_IN, "log_norm_out": NORM_OUT,
            "cross": R_CROSS, "factors": mat(NF, HID[-1], 600),
        },
        pair_table=pair_table(spark, sf).withColumn("feature", F.concat("feature", F.lit("__id"))).withColumn("other", F.concat("other", F.lit("__id")))
        if spark is not None and "field_aware" in r.deep else None,
    )


def _recipe_sql(name: str) -> str:
    r, p = RECIPES[name], _recipe_parts(name)
    base = _scaled_cte
    src = "vec2"
    if "squeezed_bilinear" in r.deep:
        base = _squeeze_ctes(D) + ",\nvec2 AS (SELECT *, " + ", ".join(f"{c}/{lit(s)} AS {n}" for n, c, s in zip(SCALED, DENSE, SCALES)) + " FROM sq)"
    terms = [R_LINEAR] if r.linear else []
    deep: list[str] = []
    if r.deep:
        ctes, deep = tower_ctes("vec2", [f"({x})" for b in r.deep for x in BLOCK_SQL[b]], p.tower)
        base, src = base + ctes, "t1"
    if r.factors:
        lg = ", ".join("exp(" + "+".join(f"{lit(k)}*{x}" for k, x in zip(row, deep)) + f") AS l{f}" for f, row in enumerate(p.weights["factors"]))
        norm = "+".join(f"l{f}" for f in range(NF))
        ms = ", ".join(f"{NF}e0*l{f}/({norm}) AS m{f}" for f in range(NF))
        fm = []
        for d in range(D):
            s = "+".join(f"m{f}*e{f}_{d}" for f in range(NF))
            q = "+".join(f"m{f}*e{f}_{d}*m{f}*e{f}_{d}" for f in range(NF))
            fm.append(f"(({s})*({s})-({q}))")
        lin = "+".join(f"m{f}*w{f}" for f in range(NF)) + "+" + "+".join(f"{n}*{lit(k)}" for n, k in zip(SCALED, RK))
        base += f",\nlg AS (SELECT *, {lg} FROM {src}),\nfa AS (SELECT *, {ms} FROM lg)"
        return f"WITH {base}\nSELECT {ROW_SQL}, {r6(sig(lin + '+0.5e0*(' + '+'.join(fm) + ')'))} AS score FROM fa"
    if r.terms:
        terms.append("+".join(FE_SQL))
    stacked = [x for b in r.beside for x in (_cross_cells() if b == "cross" else BLOCK_SQL[b])] + deep
    if stacked:
        terms.append("+".join(f"({x})*{lit(k)}" for x, k in zip(stacked, p.tower_kernel)))
    return f"WITH {base}\nSELECT {ROW_SQL}, {r6(sig(' + '.join(terms)))} AS score FROM {src}"


def _recipe(name: str):
    def run(spark, sf):
        m = stored_model(spark, sf, D)
        df = impressions(spark, sf).withColumns({n: F.col(c) / s for n, c, s in zip(SCALED, DENSE, SCALES)})
        if "field_aware" in RECIPES[name].deep:
            df = apply_vocabulary(df, m.vocab, SPARSE, "__id", sizes=m.sizes)
        df = emb.attach(df, SPARSE, m.lookup)
        return row_with(score_recipe(df, name, _recipe_parts(name, spark, sf)), score=F.col("score"))

    return run


for _name in RECIPES:
    register(f"p6_{_name}", _recipe_sql(_name))(_recipe(_name))


# ---- tasks, batches, user models ---------------------------------------

TASK_SHARED = _tower(R_IN, 700, (5,))
TASK_TOWERS = [_tower(5, 710 + n, (3,)) for n in range(2)]
TASK_KERNELS = [nums(3, 720), nums(3, 730)]


def _task_logits() -> tuple[str, list[str], str]:
    ctes, shared = tower_ctes("vec2", VEC_SQL + SCALED, TASK_SHARED, "b")
    src, logits = "b0", []
    for n, t in enumerate(TASK_TOWERS):
        more, last = tower_ctes(src, shared, t, f"q{n}x")
        ctes, src = ctes + more, f"q{n}x0"
        logits.append("+".join(f"{x}*{lit(k)}" for x, k in zip(last, TASK_KERNELS[n])))
    return ctes, logits, src


_tctes, _tlogits, _tsrc = _task_logits()


@register(
    "p7_two_task_scoring",
    f"WITH {_scaled_cte}{_tctes}\nSELECT {ROW_SQL}, {r6(sig(_tlogits[0]))} AS ctr, {r6(sig(_tlogits[1]))} AS cvr, "
    f"{r6(sig(_tlogits[0]) + '*' + sig(_tlogits[1]))} AS ctcvr FROM {_tsrc}",
)
def p7(spark, sf):
    m = stored_model(spark, sf, D)
    df = impressions(spark, sf).withColumns({n: F.col(c) / s for n, c, s in zip(SCALED, DENSE, SCALES)})
    out = scoring.score_tasks(df, SPARSE, SCALED, m.lookup, TASK_SHARED, TASK_TOWERS, TASK_KERNELS)
    return row_with(out, ctr=F.col("ctr"), cvr=F.col("cvr"), ctcvr=F.col("ctcvr"))


W3 = [0.0213717, 3.1415926, -2.2360679e-6]
_lin3 = " + ".join(f"{c}*{lit(w)}" for c, w in zip(DENSE, W3))


@register("p1_batched_predict", f"SELECT {ROW_SQL}, {r6(sig(_lin3))} AS score FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def p1(spark, sf):
    import numpy as np

    w = np.array(W3)
    df = read(spark, sf, "lineitem").join(read(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    out = scoring.predict_batches(df, ROW, DENSE, lambda m: 1.0 / (1.0 + np.exp(-(m @ w))))
    return row_with(out, score=F.col("score"))


@register("p9_user_model_scoring", f"SELECT {ROW_SQL}, {r6(_lin3)} AS score FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def p9(spark, sf):
    def load():
        w = W3
        return lambda q, d, t: q * w[0] + d * w[1] + t * w[2]

    df = read(spark, sf, "lineitem").join(read(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return row_with(df, score=scoring.user_model(load, batch_size=1024)(*[F.col(c) for c in DENSE]))


__all__ = ["QUERIES", "ORACLE"]
