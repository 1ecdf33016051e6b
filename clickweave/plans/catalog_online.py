"""Registered queries: the online learner and event-time sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.functions.scalars import rounded
from clickweave.operators.blocks import block_count, ordered_blocks
from clickweave.operators.encode import fit_vocabulary
from clickweave.operators.prepare import long_form
from clickweave.plans.catalog import r6, register, sig
from clickweave.plans.impressions import read
from clickweave.scratch import pin, scratch_path
from clickweave.streaming import online as O
from clickweave.streaming.sessions import session_counts, start_sessions
from clickweave.streaming.state import BIAS, LearnerState

K = 2
TEXTS = ("event_type", "person")
NUMBERS = ("amount",)
ROWS = O.Rows("event_id", TEXTS, NUMBERS, "y")
PLAIN = O.FtrlSettings(k=K)
PULLED = O.FtrlSettings(k=K, l1=0.01, l2=0.02)
BIAS0 = 0.05


def learning_rows(spark, sf):
    """Events as rows of the learner; 20 groups of people, one number."""
    return read(spark, sf, "events").select(
        "event_id", "ts", "event_type", (F.col("user_id") % 20).cast("string").alias("person"),
        (F.col("value") / 100.0).alias("amount"), (F.col("event_id") % 3 == 0).cast("int").alias("y"),
    )


EV = "ev AS (SELECT event_id, event_type, CAST(user_id % 20 AS VARCHAR) AS person, value/100e0 AS amount, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS y FROM events)"
FT = (
    "ft AS (SELECT event_id, y, 'event_type=' || event_type AS key, 1e0 AS x FROM ev UNION ALL "
    "SELECT event_id, y, 'person=' || person AS key, 1e0 AS x FROM ev UNION ALL SELECT event_id, y, 'amount' AS key, amount AS x FROM ev)"
)
# a stored state by arithmetic on the rank of the key
ST = (
    "st AS (SELECT key, ((i*13) % 31)/31e0-0.4e0 AS w, ((i*17) % 29)/29e0-0.5e0 AS z, CAST(i % 4 AS DOUBLE) AS n, "
    + ", ".join(f"((i*19+{d * 5}) % 23)/23e0-0.5e0 AS v{d}, ((i*11+{d * 3}) % 19)/19e0-0.5e0 AS zf{d}" for d in range(K))
    + ", CAST(i % 4 AS DOUBLE) AS nf FROM (SELECT key, row_number() OVER (ORDER BY key) AS i FROM (SELECT DISTINCT key FROM ft)))"
)


def features(spark, sf):
    return long_form(learning_rows(spark, sf), ["event_id", "y"], TEXTS, NUMBERS)


def stored_state(spark, sf):
    keys = fit_vocabulary(features(spark, sf), ["feature"])
    i = F.col("idx") + 1
    dims = F.sequence(F.lit(0), F.lit(K - 1))
    return keys.select(
        F.col("category").alias("key"), ((i * 13 % 31) / 31.0 - 0.4).alias("w"), ((i * 17 % 29) / 29.0 - 0.5).alias("z"),
        (i % 4).cast("double").alias("n"), F.transform(dims, lambda d: ((i * 19 + d * 5) % 23) / 23.0 - 0.5).alias("v"),
        F.transform(dims, lambda d: ((i * 11 + d * 3) % 19) / 19.0 - 0.5).alias("zf"), (i % 4).cast("double").alias("nf"),
    )


@register("o1_keyed_features", f"WITH {EV}, {FT} SELECT event_id, key, x FROM ft")
def o1(spark, sf):
    return features(spark, sf).select("event_id", F.col("feature").alias("key"), "x")


@register("o2_unseen_keys")
def o2(spark, sf):
    """Rows only: keys met for the first time get zero weights and seeded factors."""
    keys = O.keys_with_state(features(spark, sf), O.empty_state(spark), PLAIN)
    return keys.select("key", "w", "z", "n", F.col("v")[0].alias("v0"), F.col("v")[1].alias("v1"), "nf")


_q = "(" + "+".join(f"v{d}*v{d}" for d in range(K)) + ")"
PREDICT = (
    f"pd AS (SELECT event_id, any_value(y) AS y, {sig(f'{BIAS0}e0 + sum((w + 0.5e0*({_q}-{_q}*{_q}))*x)')} AS p FROM ft JOIN st USING (key) GROUP BY event_id)"
)
_s = [f"sum(v{d}*x)*sum(v{d}*x)-sum(v{d}*x*v{d}*x)" for d in range(K)]
PREDICT_FM = f"SELECT event_id, {r6(sig(f'{BIAS0}e0 + sum(w*x) + 0.5e0*({chr(43).join(_s)})'))} AS p FROM ft JOIN st USING (key) GROUP BY event_id"


def _predicted(spark, sf, settings=PLAIN):
    return O.predict(features(spark, sf), stored_state(spark, sf), ["event_id", "y"], BIAS0, settings)


@register("o3_online_predict", f"WITH {EV}, {FT}, {ST}, {PREDICT} SELECT event_id, {r6('p')} AS p FROM pd")
def o3(spark, sf):
    return _predicted(spark, sf).select("event_id", rounded(F.col("p")).alias("p"))


@register("o3_online_predict_pairwise", f"WITH {EV}, {FT}, {ST} {PREDICT_FM}")
def o3_fm(spark, sf):
    return _predicted(spark, sf, O.FtrlSettings(k=K, cross="fm")).select("event_id", rounded(F.col("p")).alias("p"))


@register(
    "o4_batch_loss",
    f"WITH {EV}, {FT}, {ST}, {PREDICT} SELECT event_id // 1000 AS batch, {r6('avg(-(y*ln(p)+(1-y)*ln(1-p)))')} AS loss FROM pd GROUP BY 1",
)
def o4(spark, sf):
    from clickweave.functions.scalars import log_loss_term

    p = _predicted(spark, sf)
    per = p.groupBy(F.expr("event_id div 1000").alias("batch")).agg(F.avg(log_loss_term(F.col("y"), F.col("p"))).alias("loss"))
    return per.select("batch", rounded(F.col("loss")).alias("loss"))


# errors by arithmetic; the fold is a list reduction in row order
ERR = "er AS (SELECT event_id, y - (0.2e0 + 0.05e0*(event_id % 7)) AS e FROM ev)"


def _error_pairs(spark, sf):
    f = features(spark, sf)
    e = F.col("y") - (0.2 + 0.05 * (F.col("event_id") % 7))
    return f.select(F.col("feature").alias("key"), F.col("event_id").alias("seq"), "x", e.alias("e"))


def _fold_sql(l1: float, l2: float, beta: float = 1.0) -> str:
    g = "(b.e*b.x)"
    z = f"(a.z + {g} - {l1}e0*sign(a.w) - {l2}e0*a.w)"
    zf = [f"(a.zf{d} + {g}*a.v{d})" for d in range(K)]
    rate = f"({beta}e0 + sqrt(a.nf + 1e0))"
    step = [
        f"'w': ({z} - {l1}e0*sign(a.w))/({beta}e0 + sqrt(a.n + 1e0))", f"'z': {z}", "'n': a.n + 1e0",
        *[f"'v{d}': ({zf[d]} - {l1}e0*sign(a.v{d}))/{rate}" for d in range(K)], *[f"'zf{d}': {zf[d]}" for d in range(K)],
        "'nf': a.nf + 1e0", "'x': b.x", "'e': b.e",
    ]
    names = ["w", "z", "n", *[f"v{d}" for d in range(K)], *[f"zf{d}" for d in range(K)], "nf"]
    start = "{" + ", ".join(f"'{c}': {c}" for c in names) + ", 'x': 0e0, 'e': 0e0}"
    row = "{" + ", ".join(f"'{c}': 0e0" for c in names) + ", 'x': x, 'e': e}"
    out = ", ".join(f"{r6(f's.{c}')} AS {c}" for c in names)
    return (
        f"WITH {EV}, {FT}, {ST}, {ERR}, ls AS (SELECT key, list({row} ORDER BY event_id) AS l FROM ft JOIN er USING (event_id) GROUP BY key), "
        f"fd AS (SELECT key, list_reduce(list_prepend({start}, l), lambda a, b: {{{', '.join(step)}}}) AS s FROM ls JOIN st USING (key)) SELECT key, {out} FROM fd"
    )


def _fold(settings):
    def run(spark, sf):
        pairs = pin(_error_pairs(spark, sf), "pairs")
        new = O.fold_in_rounds(pairs, stored_state(spark, sf), pairs.select("seq").distinct().count(), settings)
        return new.select(
            "key", *[rounded(F.col(c)).alias(c) for c in ("w", "z", "n", "nf")],
            *[rounded(F.col(c)[d]).alias(f"{c}{d}") for c in ("v", "zf") for d in range(K)],
        )

    return run


register("o5_weight_update", _fold_sql(0.01, 0.02))(_fold(PULLED))
register("o5_weight_update_in_rounds", _fold_sql(0.01, 0.02))(_fold(O.FtrlSettings(k=K, l1=0.01, l2=0.02, fold_rows=3000)))
register("o7_factor_update", _fold_sql(0.0, 0.0))(_fold(PLAIN))


@register("o5_weight_update_by_sums", f"WITH {EV}, {FT}, {ST}, {ERR} SELECT key, {r6('(any_value(z) + sum(e*x))/(1e0 + sqrt(any_value(n) + count(*)))')} AS w, {r6('any_value(z) + sum(e*x)')} AS z, any_value(n) + count(*) AS n FROM ft JOIN er USING (event_id) JOIN st USING (key) GROUP BY key")
def o5_sums(spark, sf):
    """Without penalties the weights need sums only, whatever the batch size."""
    new = O.closed_form_weights(_error_pairs(spark, sf), stored_state(spark, sf), PLAIN)
    return new.select("key", rounded(F.col("w")).alias("w"), rounded(F.col("z")).alias("z"), F.col("n").cast("double").alias("n"))


@register("o6_bias_update", f"WITH {EV}, {ERR} SELECT {r6('sum(e)/(1e0+sqrt(count(*)))', 5)} AS w, {r6('sum(e)', 5)} AS z, CAST(count(*) AS DOUBLE) AS n FROM er")
def o6(spark, sf):
    scored = learning_rows(spark, sf).select("y", (0.2 + 0.05 * (F.col("event_id") % 7)).alias("p"))
    w, z, n = O.closed_form_bias(scored, {"w": 0.0, "z": 0.0, "n": 0.0}, PLAIN)
    return spark.createDataFrame([(w, z, float(n))], "w double, z double, n double").select(*[rounded(F.col(c), 5).alias(c) for c in "wzn"])


def _event_files(spark, sf, files: int = 4) -> str:
    """The events as ordered files, one per micro-batch."""
    path = scratch_path(spark, "stream")
    learning_rows(spark, sf).repartitionByRange(files, "event_id").write.parquet(path)
    return path


def _stream(spark, path: str):
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _arrivals(df, order: str, steps: int, path: str):
    """Append the rows to a folder in consecutive ranges of ``order`` and stop after each, as data arrives.

    A step has many files, written by many tasks; the stream takes all new files of a step as one
    batch, so batches do not depend on the order in which a step's files were closed.
    """
    n = max(block_count(df), steps)
    blocks = ordered_blocks(df, [F.col(order)], n)
    for step in range(steps):
        now = blocks.where(F.col("_block").between(-(-step * n // steps), -(-(step + 1) * n // steps) - 1))
        now.drop("_block", "_pos").write.mode("append").parquet(path)
        yield _new_files(df.sparkSession, path, df.schema)


def _new_files(spark, path: str, schema):
    return spark.readStream.schema(schema).parquet(path)


def learned(spark, sf, settings=PLAIN, steps: int = 4):
    store = LearnerState(spark, scratch_path(spark, "learner"))
    checkpoint = scratch_path(spark, "ckpt")
    losses: list = []
    for stream in _arrivals(learning_rows(spark, sf), "event_id", steps, scratch_path(spark, "stream")):
        O.start_learner(stream, store, ROWS, settings, checkpoint, losses).awaitTermination()
    return store, losses


@register("o8_streaming_learner")
def o8(spark, sf):
    """Rows only: the state after one pass over the events in ordered micro-batches."""
    store, _ = learned(spark, sf)
    return store.latest().select("key", "w", "z", "n", "nf")


@register("o9_streaming_scorer", f"WITH {EV}, {FT}, {ST}, {PREDICT.replace(f'{BIAS0}e0 +', '0e0 +')} SELECT event_id, {r6('p')} AS p FROM pd")
def o9(spark, sf):
    """Scores of a stream against a stored state equal the batch scores."""
    store = LearnerState(spark, scratch_path(spark, "learner"))
    store.write(0, stored_state(spark, sf))
    out = scratch_path(spark, "scores")
    O.start_scorer(_stream(spark, _event_files(spark, sf)), store, ROWS, PLAIN, out, scratch_path(spark, "ckpt")).awaitTermination()
    return spark.read.schema("event_id bigint, p double").parquet(out).select("event_id", rounded(F.col("p")).alias("p"))


@register("o10_state_save_load", f"WITH {EV}, {FT}, {ST} SELECT key, {r6('CASE WHEN n > 1 THEN w + 1e0 ELSE w END')} AS w, {r6('z')} AS z FROM st")
def o10(spark, sf):
    """A base, a delta over some of its keys, a compaction, then the newest values."""
    store = LearnerState(spark, scratch_path(spark, "learner"))
    state = stored_state(spark, sf)
    store.write(0, state)
    store.write(1, state.where("n > 1").withColumn("w", F.col("w") + 1.0))
    store.compact(1)
    return store.latest().select("key", rounded(F.col("w")).alias("w"), rounded(F.col("z")).alias("z"))


@register("o11_train_rows", f"WITH {EV} SELECT event_type, person, amount, y FROM ev")
def o11(spark, sf):
    return O.split_columns(learning_rows(spark, sf), [*TEXTS, *NUMBERS], "y", train=True)


@register("o11_predict_rows", f"WITH {EV} SELECT event_type, person, amount FROM ev")
def o11_predict(spark, sf):
    return O.split_columns(learning_rows(spark, sf), [*TEXTS, *NUMBERS], "y", train=False)


_SESSIONS_SQL = """WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM g)"""


def _session_columns(sessions):
    return sessions.select(
        "user_id", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"), "n_events",
        rounded(F.col("total"), 4).alias("total"),
    )


@register(
    "o12_event_time_sessions",
    f"""{_SESSIONS_SQL}
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 21600000000 AS end_us, count(*) AS n_events, round(sum(value), 4) + 0e0 AS total FROM n GROUP BY user_id, no""",
)
def o12(spark, sf):
    return _session_columns(session_counts(read(spark, sf, "events"), "user_id", "ts", "6 hours", "1 hour"))


@register(
    "o12_streaming_sessions",
    f"""{_SESSIONS_SQL}, s AS (SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 21600000000 AS end_us, count(*) AS n_events, round(sum(value), 4) + 0e0 AS total FROM n GROUP BY user_id, no)
SELECT * FROM s WHERE end_us <= (SELECT epoch_us(max(ts)) // 1000 * 1000 FROM events) - 3600000000""",
)
def o12_stream(spark, sf):
    """Sessions that the watermark of an event stream has closed, events arriving in order of time."""
    events = read(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out, checkpoint = scratch_path(spark, "sessions"), scratch_path(spark, "ckpt")
    for stream in _arrivals(events, "ts", 4, scratch_path(spark, "stream")):
        start_sessions(stream, "user_id", "ts", "6 hours", "1 hour", out, checkpoint).awaitTermination()
    closed = spark.read.schema("user_id bigint, session_start timestamp, session_end timestamp, n_events bigint, total double").parquet(out)
    return _session_columns(closed)


__all__ = ["BIAS"]
