"""Registered queries: multi-value fields, histories, sessions, attention."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.functions.scalars import rounded
from clickweave.functions.towers import Tower, attention_scores
from clickweave.functions.vectors import dot, total
from clickweave.operators import embedding as emb
from clickweave.operators import history as H
from clickweave.operators import multivalue as M
from clickweave.operators.encode import as_text, fit_vocabulary, vocabulary_sizes
from clickweave.operators.joins import keyed_lookup, row_bytes, row_limit
from clickweave.plans import scoring
from clickweave.plans.catalog import lit, mat, nums, r6, register, sig, spark_vec, sql_cell
from clickweave.plans.catalog_interactions import tower_ctes
from clickweave.plans.impressions import read
from clickweave.scratch import pin

MAXLEN = 5
D = 4
DAY = 24 * 3600

# ---- the behaviour table -----------------------------------------------

_items: dict[tuple, tuple] = {}


def item_events(spark, sf, dim: int = D):
    """Events with an item id from 1 (0 is padding), the item table and the number of items."""
    key = (spark.sparkContext.applicationId, sf, dim)
    raw = read(spark, sf, "events")
    if key not in _items:
        vocab = fit_vocabulary(raw, ["event_type"])
        n = vocabulary_sizes(vocab)["event_type"]
        ids = vocab.select(F.lit("item").alias("feature"), (F.col("idx") + 1).alias("idx"))
        table = pin(emb.formula_table(ids, ["item"], spark_vec(dim), lambda i, p: i * 0.0), "items")
        _items[key] = (vocab, table, n)
    vocab, table, n = _items[key]
    names = vocab.select(F.col("category").alias("_type"), (F.col("idx") + 1).alias("item"))
    # the vocabulary's text of a missing type is a class of its own, so no event is lost
    events = keyed_lookup(raw, as_text(F.col("event_type")), names, "_type", ["item"], fits=n <= row_limit(row_bytes(names)))
    return events.select(*raw.columns, "item"), table, n


def histories(spark, sf, m: int = MAXLEN, dim: int = D):
    """Each event with its last ``m`` items, padded, and their number."""
    events, table, n = item_events(spark, sf, dim)
    df = H.behaviour_history(events, "user_id", ["ts", "event_id"], "item", m)
    ids, length = H.padded_history(F.col("hist"), m)
    return df.withColumns({"ids": ids, "length": length}), table, n


IT = "it AS (SELECT *, CAST(dense_rank() OVER (ORDER BY event_type) AS INTEGER) AS item FROM events)"
HB = (
    IT + ",\nhb AS (SELECT event_id, user_id, ts, value, item, "
    + ", ".join(f"lag(item, {k}) OVER w AS l{k}" for k in range(1, MAXLEN + 1))
    + " FROM it WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),\n"
    "hl AS (SELECT *, list_filter([" + ", ".join(f"l{k}" for k in range(MAXLEN, 0, -1)) + "], lambda x: x IS NOT NULL) AS hist FROM hb),\n"
    "hp AS (SELECT *, len(hist) AS n, " + ", ".join(f"hist[{p + 1}] AS h{p}" for p in range(MAXLEN)) + " FROM hl)"
)


def h_cell(p: int, d: int) -> str:
    return sql_cell(f"h{p}", 0, d)


def h_sum(d: int, weight: str = "") -> str:
    return "(" + "+".join(f"coalesce({h_cell(p, d)}{weight.format(p=p)}, 0e0)" for p in range(MAXLEN)) + ")"


# ---- multi-value fields ------------------------------------------------

@register(
    "q1_split_multi_value",
    "SELECT p_partkey, len(t) AS n_tokens, t[1] AS first_token, t[len(t)] AS last_token FROM (SELECT p_partkey, string_split(p_name, ' ') AS t FROM part)",
)
def q1(spark, sf):
    df = read(spark, sf, "part").select("p_partkey", M.split_values(F.col("p_name"), " ").alias("t"))
    return df.select(
        "p_partkey", F.size("t").cast("bigint").alias("n_tokens"), F.element_at("t", 1).alias("first_token"),
        F.element_at("t", -1).alias("last_token"),
    )


TOK = """tok AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token, generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part),
seen AS (SELECT token, min(p_partkey * 1000 + pos) AS f FROM tok GROUP BY token),
voc AS (SELECT token, CAST(row_number() OVER (ORDER BY f) AS INTEGER) AS idx FROM seen)"""


def _tokens(spark, sf):
    return read(spark, sf, "part").select("p_partkey", M.split_values(F.col("p_name"), " ").alias("tokens"))


@register("q2_sequence_vocabulary", f"WITH {TOK} SELECT token, idx FROM voc")
def q2(spark, sf):
    return M.sequence_vocabulary(_tokens(spark, sf), "tokens", ["p_partkey"])


@register("q2_sequence_vocabulary_in_blocks", f"WITH {TOK} SELECT token, idx FROM voc")
def q2_blocks(spark, sf):
    """The plan for vocabularies too large for one window."""
    return M.sequence_vocabulary(_tokens(spark, sf), "tokens", ["p_partkey"], window_rows=0)


@register(
    "q2_sequence_vocabulary_sorted",
    f"WITH {TOK} SELECT token, CAST(row_number() OVER (ORDER BY token) AS INTEGER) AS idx FROM seen",
)
def q2_sorted(spark, sf):
    return M.sequence_vocabulary(_tokens(spark, sf), "tokens", ["p_partkey"], first_seen=False)


@register("q3_length_and_maxlen", f"WITH {TOK} SELECT p_partkey, count(*) AS length, (SELECT max(pos) FROM tok) AS maxlen FROM tok GROUP BY p_partkey")
def q3(spark, sf):
    df = _tokens(spark, sf)
    return df.select("p_partkey", F.size("tokens").cast("bigint").alias("length"), F.lit(M.max_length(df, "tokens")).cast("bigint").alias("maxlen"))


@register(
    "q4_pad_right",
    f"WITH {TOK} SELECT p_partkey, " + ", ".join(f"coalesce(max(CASE WHEN pos = {p + 1} THEN idx END), 0) AS c{p}" for p in range(3))
    + ", max(CASE WHEN pos = len THEN idx END) AS kept_last FROM (SELECT tok.*, idx, count(*) OVER (PARTITION BY p_partkey) AS len FROM tok JOIN voc USING (token)) GROUP BY p_partkey",
)
def q4(spark, sf):
    df = _tokens(spark, sf)
    ids = M.tokens_to_ids(df, "tokens", M.sequence_vocabulary(df, "tokens", ["p_partkey"]), "ids")
    padded = ids.select("p_partkey", M.pad(F.col("ids"), 3).alias("c"), M.pad(F.col("ids"), 1).alias("k"))
    return padded.select("p_partkey", *[F.col("c")[p].alias(f"c{p}") for p in range(3)], F.col("k")[0].alias("kept_last"))


@register("q5_masks", f"WITH {HB} SELECT event_id, n AS valid_by_zero, least(n, 3) AS valid_by_length FROM hp")
def q5(spark, sf):
    df, _, _ = histories(spark, sf)
    yes = lambda m: F.size(F.filter(m, lambda x: x)).cast("bigint")
    return df.select(
        "event_id", yes(M.valid_by_zero(F.col("ids"))).alias("valid_by_zero"),
        yes(M.valid_by_length(F.col("ids"), F.least("length", F.lit(3)))).alias("valid_by_length"),
    )


# ---- pooling -----------------------------------------------------------

def _pool_sql(mode: str) -> str:
    cells = []
    for d in range(D):
        if mode == "max":
            x = "greatest(" + ", ".join(h_cell(p, d) for p in range(MAXLEN)) + ")"
        else:
            x = h_sum(d) + ("/(n + 1e-8)" if mode == "mean" else "")
        cells.append(f"{r6(x)} AS c{d}")
    return f"WITH {HB} SELECT event_id, {', '.join(cells)} FROM hp"


def _pool(mode: str, wide: bool):
    def run(spark, sf):
        df, table, _ = histories(spark, sf)
        out = M.pool(df, "ids", table, D, mode, maxlen=MAXLEN if wide else None)
        return out.select("event_id", *[rounded(F.col("pooled")[d]).alias(f"c{d}") for d in range(D)])

    return run


for _mode in ("sum", "mean", "max"):
    register(f"q6_pooling_{_mode}", _pool_sql(_mode))(_pool(_mode, wide=True))
    register(f"q6_pooling_{_mode}_long", _pool_sql(_mode))(_pool(_mode, wide=False))

_wnorm = "(" + "+".join(f"coalesce(exp(h{p}*0.3e0), 0e0)" for p in range(MAXLEN)) + ")"


@register(
    "q7_weighted_sequence",
    f"WITH {HB} SELECT event_id, "
    + ", ".join(f"{r6('coalesce(' + h_sum(d, '*exp(h{p}*0.3e0)') + f'/nullif({_wnorm}, 0e0), 0e0)')} AS soft{d}" for d in range(D))
    + ", " + ", ".join(f"{r6(h_sum(d, '*(h{p}*0.3e0)'))} AS raw{d}" for d in range(D)) + " FROM hp",
)
def q7(spark, sf):
    df, table, _ = histories(spark, sf)
    weight = F.transform("ids", lambda i: i * 0.3)
    valid = M.valid_by_zero(F.col("ids"))
    for name, soft in (("soft", True), ("raw", False)):
        df = df.withColumn(f"w_{name}", M.sequence_weights(weight, valid, soft))
        df = M.pool(df, "ids", table, D, "sum", weights=F.col(f"w_{name}"), out=name, maxlen=MAXLEN)
    return df.select("event_id", *[rounded(F.col(n)[d]).alias(f"{n}{d}") for n in ("soft", "raw") for d in range(D)])


BUCKETS = "b0, b1, b2, b3, b4"


@register(
    "q8_pool_many",
    f"WITH {HB}, bk AS (SELECT *, " + ", ".join(f"(h{p} * 7 + user_id) % 11 + 1 AS b{p}" for p in range(MAXLEN)) + " FROM hp) SELECT event_id, "
    + ", ".join(f"{r6(h_sum(d) + '/(n + 1e-8)')} AS m{d}" for d in range(D)) + ", "
    + ", ".join(f"{r6('(' + '+'.join('coalesce(' + sql_cell(f'b{p}', 1, d) + ', 0e0)' for p in range(MAXLEN)) + ')')} AS s{d}" for d in range(D))
    + " FROM bk",
)
def q8(spark, sf):
    """Two sequence columns with tables of their own: one explode, one join, one aggregation."""
    df, table, _ = histories(spark, sf)
    df = df.withColumn("buckets", F.transform("ids", lambda i: F.when(i != 0, (i * 7 + F.col("user_id")) % 11 + 1).otherwise(0)))
    # ids 1..11 are read off the rows, as any stored table would hold them
    ids = df.select(F.explode("buckets").alias("idx")).where("idx <> 0").distinct()
    other = emb.formula_table(ids.select(F.lit("bucket").alias("feature"), "idx"), ["item", "bucket"], spark_vec(D), lambda i, p: i * 0.0)
    both = table.select("feature", F.col("idx").cast("bigint").alias("idx"), "vec").unionByName(other.select("feature", "idx", "vec"))
    out = M.pool_many(df, {"ids": ("item", "mean"), "buckets": ("bucket", "sum")}, both, D)
    return out.select(
        "event_id", *[rounded(F.col("ids__v")[d]).alias(f"m{d}") for d in range(D)],
        *[rounded(F.col("buckets__v")[d]).alias(f"s{d}") for d in range(D)],
    )


# ---- histories and sessions --------------------------------------------

Q9_SQL = f"WITH {HB} SELECT event_id, user_id, array_to_string(hist, ',') AS hist, n AS length FROM hp"


def _history(hot_rows):
    def run(spark, sf):
        events, _, _ = item_events(spark, sf)
        df = H.behaviour_history(events, "user_id", ["ts", "event_id"], "item", MAXLEN, hot_rows=hot_rows)
        return df.select("event_id", "user_id", F.array_join("hist", ",").alias("hist"), F.size("hist").cast("bigint").alias("length"))

    return run


register("q9_behaviour_history", Q9_SQL)(_history(H.HOT_ROWS))
register("q9_behaviour_history_hot_users", Q9_SQL)(_history(0))

SESS = f"""sg AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {DAY}000000 THEN 1 ELSE 0 END AS s FROM it
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
sn AS (SELECT *, CAST(sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_no FROM sg)"""


def _sessions(hot_rows):
    def run(spark, sf):
        events, _, _ = item_events(spark, sf)
        df = H.divide_sessions(events, "user_id", "ts", "event_id", DAY, hot_rows=hot_rows)
        return df.select("event_id", "user_id", "session_no")

    return run


_sess_sql = f"WITH {IT}, {SESS} SELECT event_id, user_id, session_no FROM sn"
register("q10_session_division", _sess_sql)(_sessions(H.HOT_ROWS))
register("q10_session_division_hot_users", _sess_sql)(_sessions(0))


@register(
    "q10_last_sessions",
    f"""WITH {IT}, {SESS}, tot AS (SELECT user_id, max(session_no) AS total FROM sn GROUP BY user_id),
kept AS (SELECT sn.*, CAST(session_no - greatest(total - 5, 0) - 1 AS INTEGER) AS sess, CAST(least(total, 5) AS INTEGER) AS sess_length,
  row_number() OVER (PARTITION BY sn.user_id, session_no ORDER BY ts DESC, event_id DESC) AS rn FROM sn JOIN tot ON sn.user_id = tot.user_id WHERE session_no > total - 5)
SELECT user_id, sess, sess_length, string_agg(CAST(item AS VARCHAR), ',' ORDER BY rn DESC) AS items FROM kept WHERE rn <= 4 GROUP BY user_id, sess, sess_length""",
)
def q10_last(spark, sf):
    events, _, _ = item_events(spark, sf)
    df = H.divide_sessions(events, "user_id", "ts", "event_id", DAY)
    kept = H.last_sessions(df, "user_id", "session_no", 5)
    items = H.session_items(kept, "user_id", "sess", ["ts", "event_id"], "item", 4)
    lengths = kept.groupBy("user_id").agg(F.first("sess_length").alias("sess_length"))
    return items.join(lengths, "user_id").select("user_id", "sess", "sess_length", F.array_join("items", ",").alias("items"))


_draw = "(l_orderkey*7919 + l_linenumber*131 + l_partkey*17 + 13)"
_free = f"""WITH clicks AS (SELECT row_number() OVER () AS r, o_custkey, l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
own AS (SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM clicks WHERE l_partkey < (SELECT count(*) FROM part)),
gaps AS (SELECT u, i - (row_number() OVER (PARTITION BY u ORDER BY i) - 1) AS gap FROM own),
k AS (SELECT clicks.*, {_draw} % ((SELECT count(*) FROM part) - coalesce(m, 0)) AS k FROM clicks LEFT JOIN (SELECT u, count(*) AS m FROM own GROUP BY u) ON o_custkey = u)
SELECT o_custkey, l_orderkey, l_linenumber, l_partkey, k + count(gap) AS neg_idx FROM k LEFT JOIN gaps ON o_custkey = u AND gap <= k
GROUP BY r, o_custkey, l_orderkey, l_linenumber, l_partkey, k"""


def _negatives(spark, sf, **how):
    """Bought parts as clicks: one part the customer never bought per bought part."""
    clicks = read(spark, sf, "lineitem").join(read(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    clicks = clicks.select("o_custkey", "l_orderkey", "l_linenumber", "l_partkey")
    n = read(spark, sf, "part").count()
    return H.draw_negatives(clicks, "o_custkey", "l_partkey", n, F.expr(_draw), **how)


@register("q11_negative_history", _free)
def q11(spark, sf):
    return _negatives(spark, sf)


@register("q11_negative_history_hot_users", _free)
def q11_hot(spark, sf):
    """The same with every customer of more than ten rows counted in blocks."""
    return _negatives(spark, sf, hot_rows=10)


NEG = "(({x}) % (SELECT max(item) FROM it) + 1)"


def _steps(spark, sf):
    df, _, n = histories(spark, sf)
    df = df.withColumn("neg", F.transform("ids", lambda i: F.when(i != 0, i % n + 1).otherwise(0)))
    return H.next_steps(df, ["event_id"], "ids", "neg", "length"), df


_step_sql = " UNION ALL ".join(
    f"SELECT event_id, {t} AS pos, h{t} AS current, h{t + 1} AS next_click, {NEG.format(x=f'h{t + 1}')} AS next_negative FROM hp WHERE n > {t + 1}"
    for t in range(MAXLEN - 1)
)


@register("q12_next_behaviour_pairs", f"WITH {HB} {_step_sql}")
def q12(spark, sf):
    return _steps(spark, sf)[0]


@register(
    "q12_next_behaviour_loss",
    f"WITH {HB}, st AS ({_step_sql}) SELECT {r6(f'sum(-ln(0.3e0 + 0.05e0*next_click) - ln(1e0 - (0.1e0 + 0.05e0*next_negative))) / ((SELECT count(*) FROM hp) * {MAXLEN - 1}e0)')} AS loss FROM st",
)
def q12_loss(spark, sf):
    steps, df = _steps(spark, sf)
    steps = steps.withColumns({"pc": 0.3 + 0.05 * F.col("next_click"), "pn": 0.1 + 0.05 * F.col("next_negative")})
    loss = H.next_step_loss(steps, "pc", "pn", df.count() * (MAXLEN - 1))
    return loss.select(rounded(F.col("loss")).alias("loss"))


# ---- attention ---------------------------------------------------------

def _with_keys(spark, sf):
    df, table, n = histories(spark, sf)
    df = M.sequence_vectors(df, "ids", table, "keys")
    return emb.lookup(df, "item", table, "item", "query", fits=n <= 500_000)


def _q_cell(d: int) -> str:
    return sql_cell("item", 0, d)


_dots = ", ".join("(" + "+".join(f"{_q_cell(d)}*{h_cell(p, d)}" for d in range(D)) + f") AS s{p}" for p in range(MAXLEN))
_snorm = "(" + "+".join(f"coalesce(exp(s{p}), 0e0)" for p in range(MAXLEN)) + ")"


@register(
    "q14_attention_pooling",
    f"WITH {HB}, sc AS (SELECT *, {_dots} FROM hp) SELECT event_id, "
    + ", ".join(f"{r6('coalesce(' + h_sum(d, '*exp(s{p})') + f'/nullif({_snorm}, 0e0), 0e0)')} AS soft{d}" for d in range(D)) + ", "
    + ", ".join(f"{r6(h_sum(d, '*s{p}'))} AS raw{d}" for d in range(D)) + ", "
    + ", ".join(f"{r6(f'coalesce(exp(s{p})/nullif({_snorm}, 0e0), 0e0)')} AS weight{p}" for p in range(MAXLEN)) + " FROM sc",
)
def q14(spark, sf):
    df = _with_keys(spark, sf).withColumn("scores", F.transform("keys", lambda k: dot(F.col("query__v"), k)))
    valid = M.valid_by_zero(F.col("ids"))
    df = df.withColumns({"soft_w": M.attention_weights(F.col("scores"), valid, True), "raw_w": M.attention_weights(F.col("scores"), valid, False)})
    df = df.withColumns({"soft": M.attention_pool(F.col("soft_w"), F.col("keys"), D), "raw": M.attention_pool(F.col("raw_w"), F.col("keys"), D)})
    return df.select(
        "event_id", *[rounded(F.col(n)[d]).alias(f"{n}{d}") for n in ("soft", "raw") for d in range(D)],
        *[rounded(F.col("soft_w")[p]).alias(f"weight{p}") for p in range(MAXLEN)],
    )


ATT_NET = Tower([(mat(4 * D, 3, 810), nums(3, 811))], "sigmoid")
ATT_K, ATT_B0 = nums(3, 812), 0.07


def _net_score(p: int) -> str:
    q, k = [_q_cell(d) for d in range(D)], [h_cell(p, d) for d in range(D)]
    x = [*q, *k, *[f"({a}-{b})" for a, b in zip(q, k)], *[f"({a}*{b})" for a, b in zip(q, k)]]
    w, b = ATT_NET.layers[0]
    units = [sig("+".join(f"{v}*{lit(w[i][u])}" for i, v in enumerate(x)) + f"+{lit(b[u])}") for u in range(3)]
    return "(" + "+".join(f"{u}*{lit(c)}" for u, c in zip(units, ATT_K)) + f"+{lit(ATT_B0)})"


_nets = ", ".join(f"{_net_score(p)} AS s{p}" for p in range(MAXLEN))


@register(
    "q15_attention_score_net",
    f"WITH {HB}, sc AS (SELECT *, {_nets} FROM hp) SELECT event_id, "
    + ", ".join(f"{r6(f'coalesce(s{p}, 0e0)')} AS s{p}" for p in range(MAXLEN)) + " FROM sc",
)
def q15(spark, sf):
    df = _with_keys(spark, sf).withColumn("s", attention_scores(ATT_NET, ATT_K, ATT_B0)(F.col("query__v"), F.col("keys")))
    return df.select("event_id", *[rounded(F.col("s")[p]).alias(f"s{p}") for p in range(MAXLEN)])


P8_TOWER = Tower([(mat(2 * D + 1, 4, 820), nums(4, 821))])
P8_K = nums(4, 822)
_p8_in = [_q_cell(d) for d in range(D)] + ["(value/100e0)"] + [f"hv{d}" for d in range(D)]
_p8_ctes, _p8_last = tower_ctes("hv", _p8_in, P8_TOWER)


@register(
    "p8_history_attention_scoring",
    f"WITH {HB}, sc AS (SELECT *, {_nets} FROM hp), hv AS (SELECT *, " + ", ".join(f"{h_sum(d, '*s{p}')} AS hv{d}" for d in range(D))
    + f" FROM sc){_p8_ctes}\nSELECT event_id, {r6(sig('+'.join(f'{x}*{lit(k)}' for x, k in zip(_p8_last, P8_K))))} AS score FROM t0",
)
def p8(spark, sf):
    df = _with_keys(spark, sf)
    others = [F.col("query__v"), F.array(F.col("value") / 100.0)]
    out = scoring.score_history(
        df, "query__v", "keys", M.valid_by_zero(F.col("ids")), others, ATT_NET, ATT_K, ATT_B0, P8_TOWER, P8_K
    )
    return out.select("event_id", rounded(F.col("score")).alias("score"))


@register(
    "q16_k_max_pooling",
    "SELECT vec_id, " + ", ".join(r6(f"list_reverse_sort(list_transform(embedding, lambda x: CAST(x AS DOUBLE)))[{k + 1}]") + f" AS top{k}" for k in range(3)) + " FROM embeddings",
)
def q16(spark, sf):
    df = read(spark, sf, "embeddings").select("vec_id", M.k_max(F.transform("embedding", lambda x: x.cast("double")), 3).alias("t"))
    return df.select("vec_id", *[rounded(F.col("t")[k]).alias(f"top{k}") for k in range(3)])


__all__ = ["histories", "item_events", "total"]
