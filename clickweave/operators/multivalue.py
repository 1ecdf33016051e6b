"""Multi-value fields: split, vocabulary, padding, masks, pooling."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.vectors import let, total
from clickweave.operators.blocks import global_rank
from clickweave.operators.joins import BROADCAST_ROWS, fits_broadcast, lookup_join, row_count_up_to, row_limit
from clickweave.operators.rows import numbered, put_back
from clickweave.scratch import pin

# fixed values: guard against division by zero, and the mask of a maximum
MEAN_EPS = 1e-8
MASKED = -1e9
# fixed value: positions looked up side by side before the long plan is used
WIDE_POSITIONS = 8


def split_values(c: Column, sep: str = "|") -> Column:
    return F.split(c, re.escape(sep))


def sequence_vocabulary(
    df: DataFrame, tokens: str, order: Sequence[str], first_seen: bool = True, window_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``(token, idx)`` numbered from 1 by first appearance (or sorted); 0 is padding."""
    long = df.select(*order, F.posexplode(tokens).alias("_p", "token"))
    if first_seen:
        seen = long.groupBy("token").agg(F.min(F.struct(*order, "_p")).alias("_first"))
    else:
        seen = long.select("token", F.col("token").alias("_first")).distinct()
    seen = pin(seen, "tokens")
    if row_count_up_to(seen, window_rows) is not None:
        ranked = seen.withColumn("idx", F.row_number().over(Window.orderBy("_first")))
    else:
        ranked = global_rank(seen, [F.col("_first")], "idx").withColumn("idx", F.col("idx") + 1)
    return ranked.select("token", F.col("idx").cast("int").alias("idx"))


def tokens_to_ids(df: DataFrame, tokens: str, vocab: DataFrame, out: str) -> DataFrame:
    """Array of texts to array of ids; a text without an id becomes 0. Rows without texts keep an empty array."""
    rows, row = numbered(df)
    long = rows.select(row, F.posexplode(tokens).alias("_p", "token"))
    met = lookup_join(long, vocab, ["token"], ["idx"])
    entry = F.struct("_p", F.coalesce("idx", F.lit(0)).alias("idx"))
    ids = met.groupBy(row).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["idx"]).alias(out))
    none = F.array().cast("array<int>")
    return put_back(rows, ids, row).withColumn(out, F.coalesce(F.col(out), none))


def max_length(df: DataFrame, column: str) -> int:
    return df.agg(F.max(F.size(column))).first()[0] or 0


def pad(c: Column, maxlen: int, value=0) -> Column:
    """Values, then padding up to ``maxlen``; a longer input keeps its last values."""
    kept = F.when(F.size(c) > maxlen, F.slice(c, -maxlen, maxlen)).otherwise(c)
    return F.slice(F.concat(kept, F.array_repeat(F.lit(value), maxlen)), 1, maxlen)


def valid_by_zero(ids: Column) -> Column:
    return F.transform(ids, lambda x: x != 0)


def valid_by_length(ids: Column, length: Column) -> Column:
    return let(length, lambda n: F.transform(ids, lambda _, i: i < n))


def k_max(values: Column, k: int) -> Column:
    """The k largest values, in descending order."""
    return F.slice(F.sort_array(values, asc=False), 1, k)


def sequence_weights(weights: Column, valid: Column, normalise: bool = True) -> Column:
    """Softmax over the valid positions (or the raw weights); masked positions get 0."""
    masked = F.zip_with(weights, valid, lambda w, ok: F.when(ok, w))
    if not normalise:
        return F.transform(masked, lambda w: F.coalesce(w, F.lit(0.0)))
    # array_max skips nulls, so only valid positions set the shift
    shifted = let(
        masked,
        lambda m: let(
            F.array_max(m), lambda top: F.transform(m, lambda w: F.coalesce(F.exp(w - top), F.lit(0.0)))
        ),
    )
    return let(
        shifted, lambda e: let(total(e), lambda s: F.transform(e, lambda x: F.when(s > 0, x / s).otherwise(F.lit(0.0))))
    )


def _cells(ids: Column, length: Column | None, weights: Column | None) -> Column:
    """Array of (_id, _wt), one entry a position; masked positions have a null id."""
    valid = valid_by_length(ids, length) if length is not None else valid_by_zero(ids)
    w = weights if weights is not None else F.transform(ids, lambda _: F.lit(1.0))
    return F.transform(
        F.arrays_zip(ids.alias("i"), valid.alias("ok"), w.alias("w")),
        lambda c: F.struct(F.when(c["ok"], c["i"]).cast("bigint").alias("_id"), c["w"].alias("_wt")),
    )


def _kept(ids: Column, length: Column | None, weights: Column | None, maxlen: int | None):
    """A sequence over ``maxlen`` keeps its last values, as ``pad`` does; weights and length go with it."""
    if maxlen is None:
        return ids, length, weights
    gone = F.greatest(F.size(ids) - maxlen, F.lit(0))
    cut = lambda c: F.slice(c, gone + 1, F.lit(maxlen))
    return cut(ids), length - gone if length is not None else None, cut(weights) if weights is not None else None


def pool(
    df: DataFrame, ids: str, table: DataFrame, dim: int, mode: str = "mean", *,
    length: str | None = None, weights: Column | None = None, out: str = "pooled", empty_max: float | None = None,
    maxlen: int | None = None, fits: bool | None = None,
) -> DataFrame:
    """Add the pooled vector of an id sequence; ``table(idx, vec)``.

    Short sequences against a broadcast table are looked up position by position
    in the wide row, without a shuffle. Otherwise positions are exploded, met in
    one skew-safe join and summed per row number; the map side has reduced a row to one
    record before anything moves. A sequence longer than ``maxlen`` keeps its last values.
    """
    if mode not in ("sum", "mean", "max"):
        raise ValueError(f"unknown pooling mode {mode}")
    one = table.select(F.col("idx").cast("bigint").alias("_id"), F.col("vec").alias("_vec"))
    if fits is None:
        fits = fits_broadcast(one, row_limit(16 + 8 * dim))
    kept = _kept(F.col(ids), F.col(length) if length else None, weights, maxlen)
    if fits and maxlen is not None and maxlen <= WIDE_POSITIONS:
        return _pool_wide(df, kept, one, dim, mode, out, empty_max, maxlen)
    rows, row = numbered(df)
    cells = rows.select(row, F.inline(_cells(*kept)))
    met = lookup_join(cells, one, ["_id"], ["_vec"], fits=fits)
    gather = F.max if mode == "max" else F.sum
    sums = met.groupBy(row).agg(
        *[gather(F.col("_vec").getItem(d) * F.col("_wt")).alias(f"_c{d}") for d in range(dim)], F.count("_id").alias("_n")
    )
    found = put_back(rows, sums, row)
    done = [_finish(F.col(f"_c{d}"), F.coalesce("_n", F.lit(0)), mode, empty_max) for d in range(dim)]
    return found.select(*df.columns, F.array(*done).alias(out))


def _finish(c: Column, n: Column, mode: str, empty_max: float | None) -> Column:
    if mode == "max":
        return c if empty_max is None else F.coalesce(c, F.lit(empty_max))
    s = F.coalesce(c, F.lit(0.0))
    return s / (n + F.lit(MEAN_EPS)) if mode == "mean" else s


def _pool_wide(df, kept, one, dim, mode, out, empty_max, maxlen) -> DataFrame:
    cur = df.withColumn("_cells", _cells(*kept))
    for p in range(maxlen):
        at = F.get(F.col("_cells"), F.lit(p))
        cur = cur.withColumns({"_id": at["_id"], "_wt": at["_wt"]}).join(F.broadcast(one), ["_id"], "left")
        vec = let(F.col("_wt"), lambda k: F.transform(F.col("_vec"), lambda x: x * k))
        cur = cur.withColumns({f"_v{p}": vec, f"_ok{p}": F.col("_id").isNotNull().cast("int")}).drop("_id", "_wt", "_vec")
    n = sum((F.col(f"_ok{p}") for p in range(1, maxlen)), F.col("_ok0"))
    cells = []
    for d in range(dim):
        at = [F.col(f"_v{p}").getItem(d) for p in range(maxlen)]
        if mode == "max":
            c = F.greatest(*at) if maxlen > 1 else at[0]
        else:
            c = sum((F.coalesce(x, F.lit(0.0)) for x in at[1:]), F.coalesce(at[0], F.lit(0.0)))
        cells.append(_finish(c, n, mode, empty_max))
    return cur.select(*df.columns, F.array(*cells).alias(out))


def pool_many(
    df: DataFrame, fields: dict[str, tuple[str, str]], table: DataFrame, dim: int,
    weights: dict[str, Column] | None = None, fits: bool | None = None,
) -> DataFrame:
    """Pool several sequence columns at once: one explode, one join, one aggregation per row number.

    ``fields`` maps a column to (table name, mode); ``table(feature, idx, vec)``.
    """
    rows, row = numbered(df)

    def entries(column: str, name: str) -> Column:
        """A column's positions, marked with it and with its table."""
        marks = F.lit(column).alias("_column"), F.lit(name).alias("feature")
        cells = _cells(F.col(column), None, (weights or {}).get(column))
        return F.transform(cells, lambda x: F.struct(*marks, x["_id"].alias("_id"), x["_wt"].alias("_wt")))

    cells = [entries(c, name) for c, (name, _) in fields.items()]
    nothing = "array<struct<_column:string,feature:string,_id:bigint,_wt:double>>"
    parts = rows.select(row, F.inline(F.concat(*[F.coalesce(c.cast(nothing), F.array().cast(nothing)) for c in cells])))
    one = table.select("feature", F.col("idx").cast("bigint").alias("_id"), F.col("vec").alias("_vec"))
    met = lookup_join(parts, one, ["feature", "_id"], ["_vec"], fits=fits)
    aggs = []
    for column, (_, mode) in fields.items():
        mine = F.col("_column") == column
        gather = F.max if mode == "max" else F.sum
        aggs += [gather(F.when(mine, F.col("_vec").getItem(d) * F.col("_wt"))).alias(f"{column}_{d}") for d in range(dim)]
        aggs.append(F.count(F.when(mine, F.col("_id"))).alias(f"{column}_n"))
    sums = met.groupBy(row).agg(*aggs)
    pooled = [
        F.array(*[_finish(F.col(f"{c}_{d}"), F.col(f"{c}_n"), mode, None) for d in range(dim)]).alias(f"{c}__v")
        for c, (_, mode) in fields.items()
    ]
    found = put_back(rows, sums.select(row, *pooled), row)
    # a row without any position pools nothing
    empty = {c: F.array(*[_finish(F.lit(None).cast("double"), F.lit(0), mode, None)] * dim) for c, (_, mode) in fields.items()}
    return found.select(*df.columns, *[F.coalesce(F.col(f"{c}__v"), empty[c]).alias(f"{c}__v") for c in fields])


def sequence_vectors(df: DataFrame, ids: str, table: DataFrame, out: str, fits: bool | None = None) -> DataFrame:
    """Add the vectors of a padded id sequence, in position order; padding gives null entries."""
    rows, row = numbered(df)
    one = table.select(F.col("idx").cast("bigint").alias("_id"), F.col("vec").alias("_vec"))
    long = rows.select(row, F.posexplode(F.transform(F.col(ids), lambda x: x.cast("bigint"))).alias("_p", "_id"))
    met = lookup_join(long, one, ["_id"], ["_vec"], fits=fits)
    got = met.groupBy(row).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_vec"))), lambda e: e["_vec"]).alias(out))
    none = F.array().cast(one.schema["_vec"].dataType.simpleString().join(["array<", ">"]))
    return put_back(rows, got, row).withColumn(out, F.coalesce(F.col(out), none))


def attention_weights(scores: Column, valid: Column, normalise: bool = False) -> Column:
    """Masked scores, soft-maxed or raw; these are also the result of ``return_score``."""
    return sequence_weights(scores, valid, normalise)


def attention_pool(weights: Column, keys: Column, dim: int) -> Column:
    """Sum of key vectors times their weights; null vectors (padding) add nothing."""
    zero = F.array_repeat(F.lit(0.0), dim)
    cells = F.arrays_zip(weights.alias("w"), keys.alias("k"))
    return F.aggregate(
        cells,
        zero,
        lambda acc, c: F.when(c["k"].isNull(), acc).otherwise(F.zip_with(acc, c["k"], lambda a, x: a + c["w"] * x)),
    )
