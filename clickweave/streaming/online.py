"""Online factorization learner with follow-the-regularised-leader style updates.

One batch: features of the batch meet the state as it was before the batch, rows
are scored, and each key folds its own (x, error) pairs in row order. Keys do not
depend on each other once the errors are known, so the fold is exact in parallel.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.scalars import log_loss_term, sigmoid
from clickweave.functions.vectors import let, total
from clickweave.operators.blocks import block_count, ordered_blocks, rank_in_blocks
from clickweave.operators.embedding import seeded_normal
from clickweave.operators.joins import BROADCAST_ROWS, HOT_ROWS, fits_broadcast, hot_keys, lookup_join
from clickweave.operators.prepare import long_form
from clickweave.scratch import pin, release
from clickweave.streaming.state import BIAS, LearnerState

VALUES = ["w", "z", "n", "v", "zf", "nf"]


@dataclass(frozen=True)
class FtrlSettings:
    k: int
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    sep: str = "="
    std: float = 0.1
    seed: int = 2020
    cross: str = "self"
    # rows of one key folded in one go; longer batches are folded as a stream of sorted rows
    fold_rows: int = 200_000
    # pairs of one key beyond which a longer batch without penalties takes it by products, in all tasks
    spread_rows: int = HOT_ROWS


@dataclass(frozen=True)
class Rows:
    """Which columns of a table are what for the learner."""

    seq: str
    texts: tuple[str, ...]
    numbers: tuple[str, ...] = ()
    label: str = "label"


def split_columns(df: DataFrame, x: Sequence[str], y: str | None = None, train: bool = True) -> DataFrame:
    return df.select(*x, *([y] if train and y else []))


def nested_to_rows(df: DataFrame, column: str) -> DataFrame:
    """A table of lists of row structs to flat rows."""
    return df.select(F.inline(column))


def initial_factors(key: Column, s: FtrlSettings) -> Column:
    dims = F.sequence(F.lit(0), F.lit(s.k - 1))
    return F.transform(dims, lambda d: seeded_normal(s.seed, key, d) * s.std)


def with_state(features: DataFrame, state: DataFrame, s: FtrlSettings, fits: bool | None = None) -> DataFrame:
    """Add the state of each key; unseen keys get zero weight and seeded factors."""
    met = lookup_join(features.withColumnRenamed("feature", "key"), state, ["key"], VALUES, fits=fits)
    zero = F.lit(0.0)
    fresh = F.array_repeat(zero, s.k)
    return met.withColumns(
        {
            "w": F.coalesce("w", zero),
            "z": F.coalesce("z", zero),
            "n": F.coalesce("n", zero),
            "v": F.coalesce("v", initial_factors(F.col("key"), s)),
            "zf": F.coalesce("zf", fresh),
            "nf": F.coalesce("nf", zero),
        }
    )


def keys_with_state(features: DataFrame, state: DataFrame, s: FtrlSettings, fits: bool | None = None) -> DataFrame:
    """State of the distinct keys of a batch, new keys included: one row per key."""
    return with_state(features.select("feature").distinct(), state, s, fits)


def bias_of(state: DataFrame) -> dict[str, float]:
    row = state.where(F.col("key") == BIAS).select("w", "z", "n").first()
    return {"w": 0.0, "z": 0.0, "n": 0.0} if row is None else row.asDict()


def predict(
    features: DataFrame, keys: DataFrame, row: Sequence[str], bias: float, s: FtrlSettings, fits: bool | None = None
) -> DataFrame:
    """``row..., p`` from ``features(row..., feature, x)`` and the state of their keys.

    The default keeps the learner's own second-order term, which has no cross
    products; ``cross='fm'`` uses the pairwise one.
    """
    values = keys.select(F.col("key").alias("feature"), "w", "v")
    if s.cross == "self":
        # the per-key term is computed once per key, not once per row
        q = total(F.transform(F.col("v"), lambda a: a * a))
        values = values.withColumn("q", q).select("feature", "w", (0.5 * (F.col("q") - F.col("q") * F.col("q"))).alias("c"))
        met = lookup_join(features, values, ["feature"], ["w", "c"], fits=fits)
        scored = met.groupBy(*row).agg(F.sum((F.col("w") + F.col("c")) * F.col("x")).alias("_s"))
        return scored.select(*row, sigmoid(F.lit(bias) + F.col("_s")).alias("p"))
    if s.cross != "fm":
        raise ValueError("cross must be self or fm")
    met = lookup_join(features, values, ["feature"], ["w", "v"], fits=fits)
    vx = [F.col("v").getItem(d) * F.col("x") for d in range(s.k)]
    sums = met.groupBy(*row).agg(
        F.sum(F.col("w") * F.col("x")).alias("_lin"),
        *[F.sum(c).alias(f"_s{d}") for d, c in enumerate(vx)],
        *[F.sum(c * c).alias(f"_q{d}") for d, c in enumerate(vx)],
    )
    second = sum((F.col(f"_s{d}") * F.col(f"_s{d}") - F.col(f"_q{d}") for d in range(s.k)), F.lit(0.0))
    return sums.select(*row, sigmoid(F.lit(bias) + F.col("_lin") + 0.5 * second).alias("p"))


def batch_loss(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return scored.agg(F.avg(log_loss_term(F.col(y).cast("double"), F.col(p))).alias("loss"))


def _step(a: Column, g: Column, s: FtrlSettings) -> Column:
    """State after one (x, e) pair."""
    x, e = g["x"], g["e"]
    l1, l2, beta = F.lit(s.l1), F.lit(s.l2), F.lit(s.beta)
    ge = e * x
    z = a["z"] + ge
    pull = F.lit(0.0)
    if s.l1:
        pull = l1 * F.signum(a["w"])
        z = z - pull
    if s.l2:
        z = z - l2 * a["w"]
    n = a["n"] + 1.0
    nf = a["nf"] + 1.0
    rate = beta + F.sqrt(nf)
    def result(zf: Column) -> Column:
        if s.l1:
            v = F.zip_with(zf, a["v"], lambda f, v: (f - l1 * F.signum(v)) / rate)
        else:
            v = F.transform(zf, lambda f: f / rate)
        w = (z - pull) / (beta + F.sqrt(n))
        return F.struct(*[c.alias(k) for k, c in zip(VALUES, (w, z, n, v, zf, nf))])

    # the summed factor gradients are needed twice: bound to a variable, evaluated once
    return let(F.zip_with(a["zf"], a["v"], lambda f, v: f + ge * v), result)


def _taught(pairs: DataFrame) -> DataFrame:
    """A pair without a value or an error teaches nothing."""
    return pairs.where(F.col("x").isNotNull() & F.col("e").isNotNull())


def fold(pairs: DataFrame, keys: DataFrame, s: FtrlSettings) -> DataFrame:
    """New state of every key in ``pairs(key, seq, x, e)``; at most ``fold_rows`` rows per key."""
    lists = _taught(pairs).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seq", "x", "e"))).alias("_g"))
    start = F.struct(*[F.col(c).alias(c) for c in VALUES])
    met = keys.join(lists, ["key"])
    done = met.select("key", F.aggregate("_g", start, lambda a, g: _step(a, g, s)).alias("s"))
    return done.select("key", *[F.col(f"s.{c}").alias(c) for c in VALUES])


def closed_form_bias(scored: DataFrame, bias: dict[str, float], s: FtrlSettings) -> tuple[float, float, float]:
    """Without l1 and l2 only the sum and the count of the errors matter."""
    row = scored.agg(F.sum(F.col("y") - F.col("p")).alias("e"), F.count(F.col("y") - F.col("p")).alias("n")).first()
    z, n = bias["z"] + (row["e"] or 0.0), bias["n"] + row["n"]
    return (z / (s.beta + n**0.5) if row["n"] else bias["w"]), z, n


def closed_form_weights(pairs: DataFrame, keys: DataFrame, s: FtrlSettings) -> DataFrame:
    """Weights (not factors) without l1 and l2: sums per key, combined on the map side."""
    if s.l1 or s.l2:
        raise ValueError("sums are exact only without l1 and l2")
    sums = _taught(pairs).groupBy("key").agg(F.sum(F.col("x") * F.col("e")).alias("_g"), F.count(F.lit(1)).alias("_c"))
    z, n = F.col("z") + F.col("_g"), F.col("n") + F.col("_c")
    return keys.join(sums, ["key"]).select("key", (z / (F.lit(s.beta) + F.sqrt(n))).alias("w"), z.alias("z"), n.alias("n"))


def update(
    batch: DataFrame, state_of: Callable[[DataFrame, bool | None], DataFrame], rows: Rows, s: FtrlSettings
) -> tuple[DataFrame, DataFrame]:
    """``(new state of the touched keys, scored rows(seq, y, p))`` for one batch.

    ``state_of(keys, fits)`` returns the stored state of the given keys. A batch
    of n rows touches at most n x fields keys, so small batches are known to fit a
    broadcast without counting; for larger ones the keys are counted.
    """
    spark = batch.sparkSession
    batch = pin(batch.select(rows.seq, *rows.texts, *rows.numbers, rows.label), "batch")
    n_rows = batch.count()
    fits = True if n_rows * (len(rows.texts) + len(rows.numbers)) < BROADCAST_ROWS else None
    features = long_form(batch, [rows.seq], rows.texts, rows.numbers, s.sep)
    wanted = features.select("feature").distinct().unionByName(spark.createDataFrame([(BIAS,)], "feature string"))
    if fits is None:
        wanted = pin(wanted, "wanted")  # the keys of a large batch are read more than once
    known = state_of(wanted.select(F.col("feature").alias("key")), fits)
    every = pin(keys_with_state(wanted, known, s, fits), "keys")
    bias, keys = bias_of(every), every.where(F.col("key") != BIAS)
    if fits is None:
        fits = fits_broadcast(keys)
    p = predict(features, keys, [rows.seq], bias["w"], s, fits)
    # rows meet rows: neither side is broadcast through the driver, however small its files are
    scored = pin(batch.select(rows.seq, F.col(rows.label).cast("double").alias("y")).join(p.hint("merge"), [rows.seq]), "scored")
    errors = scored.select(rows.seq, (F.col("y") - F.col("p")).alias("e"))
    # rows meet their errors before they become pairs
    taught = batch.join(errors.withColumnRenamed("e", "_e").hint("merge"), [rows.seq]).drop(rows.label)
    if n_rows > max(s.fold_rows, s.spread_rows) and s.l1 == 0 and s.l2 == 0:
        taught = pin(taught, "taught")  # pairs of busy keys are read more than once
    pairs = long_form(taught, [rows.seq, "_e"], rows.texts, rows.numbers, s.sep).select(
        F.col("feature").alias("key"), F.col(rows.seq).alias("seq"), "x", F.col("_e").alias("e")
    )
    if s.l1 == 0 and s.l2 == 0:
        w, z, n = closed_form_bias(scored, bias, s)
        bias_row = spark.createDataFrame([(BIAS, w, z, float(n), [], [], float(n))], _schema())
        return fold_in_rounds(pairs, keys, n_rows, s).unionByName(bias_row), scored
    bias_start = spark.createDataFrame([(BIAS, bias["w"], bias["z"], bias["n"], [], [], bias["n"])], _schema())
    bias_pairs = errors.select(F.lit(BIAS).alias("key"), F.col(rows.seq).alias("seq"), F.lit(1.0).alias("x"), "e")
    return fold_in_rounds(pairs.unionByName(bias_pairs), keys.unionByName(bias_start), n_rows, s), scored


def _schema() -> str:
    from clickweave.streaming.state import SCHEMA

    return SCHEMA


def _fold_on(state: dict, x: list[float], e: list[float], s: FtrlSettings) -> None:
    """``_step`` over consecutive pairs of one key, in place and in the same order of operations."""

    def sign(a: float) -> float:
        return 1.0 if a > 0 else -1.0 if a < 0 else a

    w, z, n, v, zf, nf = (state[c] for c in VALUES)
    for a, b in zip(x, e):
        ge = b * a
        pull = s.l1 * sign(w) if s.l1 else 0.0
        z = z + ge - pull
        if s.l2:
            z = z - s.l2 * w
        n, nf = n + 1.0, nf + 1.0
        rate = s.beta + math.sqrt(nf)
        zf = [f + ge * c for f, c in zip(zf, v)]
        v = [(f - s.l1 * sign(c)) / rate for f, c in zip(zf, v)] if s.l1 else [f / rate for f in zf]
        w = (z - pull) / (s.beta + math.sqrt(n))
    state.update(zip(VALUES, (w, z, n, v, zf, nf)))


def _state(text: str) -> dict:
    """A state from its JSON form, in which numbers that are not finite are texts."""
    found = json.loads(text)
    number = lambda a: a if a is None else float(a)
    return {c: [number(a) for a in found[c]] if isinstance(found.get(c), list) else number(found.get(c)) for c in VALUES}


def _fold_sorted(batches: Iterator, s: FtrlSettings) -> Iterator:
    """New states from rows sorted by key, the states of a key before its pairs and these in row order."""
    import numpy as np
    import pyarrow as pa

    numbers, lists = pa.float64(), pa.list_(pa.float64())
    schema = pa.schema([("key", pa.string()), *[(c, lists if c in ("v", "zf") else numbers) for c in VALUES]])
    key, states, touched = None, [], False

    def done() -> Iterator:
        if states and touched:
            yield pa.RecordBatch.from_pylist([{"key": key, **state} for state in states], schema=schema)

    for batch in batches:
        names, has_seq, is_pair = batch["key"], batch["seq"].is_valid().to_numpy(False), batch["_pair"].to_numpy(False)
        x, e = (batch[c].to_numpy(zero_copy_only=False) for c in ("x", "e"))
        codes = names.dictionary_encode().indices.to_numpy(False)
        cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if names[start].as_py() != key:
                yield from done()
                key, states, touched = names[start].as_py(), [], False
            first = start + int((~is_pair[start:end]).sum())
            states += [_state(batch["state"][i].as_py()) for i in range(start, first)]
            touched = touched or first < end
            first += int((~has_seq[first:end]).sum())  # a pair without a place in the order only marks its key
            if first < end:
                a, b = x[first:end].tolist(), e[first:end].tolist()
                for state in states:
                    _fold_on(state, a, b, s)
    yield from done()


def fold_in_rounds(pairs: DataFrame, keys: DataFrame, batch_rows: int, s: FtrlSettings) -> DataFrame:
    """``fold`` for any batch: a longer one than ``fold_rows`` is folded as a stream in row order, in one job.

    A key present in every row (a bias, a number) would otherwise collect the
    whole batch. The recurrence of a key is sequential: its pairs are sorted by
    Spark, which spills what does not fit, and a task holds one Arrow batch of them.
    Without penalties a key of many pairs needs no sequence: see ``fold_by_products``.
    """
    if batch_rows <= s.fold_rows:
        return fold(pairs, keys, s)
    if s.l1 == 0 and s.l2 == 0:
        hot = hot_keys(_taught(pairs).where("key is not null and seq is not null"), ["key"], s.spread_rows)
        if not hot.isEmpty():
            rest, others = (df.join(F.broadcast(hot), ["key"], "left_anti") for df in (pairs, keys))
            folded = fold_by_products(pairs, keys, hot, s)
            return folded if others.isEmpty() else folded.unionByName(_fold_streams(rest, others, s))
    return _fold_streams(pairs, keys, s)


def fold_by_products(pairs: DataFrame, keys: DataFrame, hot: DataFrame, s: FtrlSettings) -> DataFrame:
    """``fold`` without penalties for the ``hot`` keys, whose pairs stay spread over all tasks.

    After a key's first pair ``v = zf / (beta + sqrt(nf))``, so each later one multiplies ``zf`` by
    ``1 + e x / (beta + sqrt(nf))``: its place in the order is all that a pair must know. The logarithms of the
    factors are added up, in runs of pairs first; products on the way neither overflow nor vanish.
    """
    if s.l1 or s.l2:
        raise ValueError("products are exact only without l1 and l2")
    own = _taught(pairs).where(F.col("seq").isNotNull()).join(F.broadcast(hot), ["key"])
    own = own.withColumns({c: F.col(c).cast("double") for c in ("x", "e")})
    blocked = ordered_blocks(own, [F.col(c) for c in ("key", "seq", "x", "e")])
    states = pin(keys.join(F.broadcast(hot), ["key"]), "states")
    met = rank_in_blocks(blocked, "_t", ["key"]).join(F.broadcast(states.select("key", "nf").distinct()), ["key"])
    ge, t = F.col("e") * F.col("x"), F.col("_t")
    factor = 1.0 + F.col("_ge") / (F.lit(s.beta) + F.sqrt(F.col("nf") + t))
    met = met.withColumn("_ge", ge).withColumn("_f", F.when(t > 0, factor))
    runs = met.groupBy("key", "nf", F.expr("_t div 4096").alias("_run")).agg(
        F.sum("_ge").alias("_g"), F.count(F.lit(1)).alias("_c"), F.max(F.when(t == 0, F.col("_ge"))).alias("_first"),
        F.sum(F.when(F.col("_f") != 0, F.log(F.abs("_f")))).alias("_log"),
        F.count_if(F.col("_f") < 0).alias("_turns"), F.count_if(F.col("_f") == 0).alias("_zeros"),
    )
    sums = runs.groupBy("key", F.col("nf").alias("_nf")).agg(
        F.max("_first").alias("_first"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_g", "_c", "_log", "_turns", "_zeros")]
    )
    sums = pin(sums.withColumnRenamed("key", "_key"), "products")
    release(blocked)
    done = states.join(F.broadcast(sums), (F.col("key") == F.col("_key")) & F.col("nf").eqNullSafe(F.col("_nf")))
    turn = F.when(F.col("_turns") % 2 == 1, -1.0).otherwise(1.0)

    def grown(f: Column) -> Column:
        """A factor of zero ends in zero, unless something before or after was not finite."""
        by_log = turn * F.signum(f) * F.exp(F.col("_log") + F.log(F.abs(f)))
        return F.when((f == 0) | (F.col("_zeros") > 0), f * 0.0 + F.col("_log") * 0.0).otherwise(by_log)

    z, n, nf = F.col("z") + F.col("_g"), F.col("n") + F.col("_c"), F.col("nf") + F.col("_c")
    done = done.withColumn("_zf", F.zip_with("zf", "v", lambda f, v: f + F.col("_first") * v))
    done = done.withColumn("_zf", F.transform("_zf", grown)).select(
        "key", (z / (F.lit(s.beta) + F.sqrt(n))).alias("w"), z.alias("z"), n.alias("n"),
        F.transform("_zf", lambda f: f / (F.lit(s.beta) + F.sqrt(nf))).alias("v"), F.col("_zf").alias("zf"), nf.alias("nf"),
    )
    return pin(done, "fold")


def _fold_streams(pairs: DataFrame, keys: DataFrame, s: FtrlSettings) -> DataFrame:
    # a state travels as text: a column of structs or lists, null in every pair, costs more than the pairs
    state = F.to_json(F.struct(*VALUES))
    first = keys.select(
        "key", F.lit(False).alias("_pair"), *[F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in ("seq", "x", "e")],
        state.alias("state"),
    )
    then = _taught(pairs).select("key", F.lit(True).alias("_pair"), "seq", "x", "e", F.lit(None).cast(first.schema["state"].dataType).alias("state"))
    rows = first.unionByName(then).where(F.col("key").isNotNull())
    rows = rows.withColumns({c: F.col(c).cast("double") for c in ("x", "e")})
    rows = rows.repartition(block_count(rows), "key").sortWithinPartitions("key", "_pair", "seq", "x", "e")
    return pin(rows.mapInArrow(partial(_fold_sorted, s=s), _schema()), "fold")


def learn_batch(batch: DataFrame, batch_id: int, store: LearnerState, rows: Rows, s: FtrlSettings) -> float:
    """Update the stored state with one batch and return its loss before the update."""
    new, scored = update(batch, lambda keys, fits: store.as_of(batch_id, keys, fits), rows, s)
    store.write(batch_id, new)
    return scored.agg(F.avg(log_loss_term(F.col("y"), F.col("p")))).first()[0]


def start_learner(stream: DataFrame, store: LearnerState, rows: Rows, s: FtrlSettings, checkpoint: str, losses: list | None = None):
    """Run the learner over the files present and stop; a replayed batch gives the same version."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        loss = learn_batch(batch, batch_id, store, rows, s)
        if losses is not None:
            losses.append((batch_id, loss))

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def score_rows(df: DataFrame, state: DataFrame, rows: Rows, s: FtrlSettings) -> DataFrame:
    """Score rows against a state without changing it."""
    features = long_form(df, [rows.seq], rows.texts, rows.numbers, s.sep)
    keys = keys_with_state(features, state, s)
    return predict(features, keys, [rows.seq], bias_of(state)["w"], s)


def start_scorer(stream: DataFrame, store: LearnerState, rows: Rows, s: FtrlSettings, out: str, checkpoint: str):
    """Score every arriving batch with the newest state; each batch owns one output folder."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        score_rows(batch, store.latest(), rows, s).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replay(batches: DataFrame, batch_col: str, store: LearnerState, rows: Rows, s: FtrlSettings, n_batches: int) -> None:
    """The batch form of the learner: numbered batches one after another."""
    for b in range(n_batches):
        learn_batch(batches.where(F.col(batch_col) == b), b, store, rows, s)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _schema())
