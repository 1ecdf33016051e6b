"""Label encoders as tables: fit, apply, sizes, vocabulary files, hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.scalars import hash_bucket
from clickweave.operators.blocks import global_rank
from clickweave.operators.joins import BROADCAST_ROWS, broadcast_fields, fields_join, keyed_lookup, lookup_join, row_count_up_to
from clickweave.scratch import pin

MISSING_TEXT = "nan"


def as_text(c: Column) -> Column:
    """Text form used before encoding; a missing value becomes a class of its own."""
    return F.coalesce(c.cast("string"), F.lit(MISSING_TEXT))


def long_fields(df: DataFrame, fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """``keep..., feature, category``: one row per field, categories as text."""
    prepared = df.select(*(keep or []), *[as_text(F.col(f)).alias(f) for f in fields])
    return prepared.unpivot(keep or [], fields, "feature", "category")


def fit_vocabulary(df: DataFrame, fields: list[str], window_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``vocab(feature, category, idx)``: sorted distinct texts numbered from 0.

    One pass for all fields; the distinct combines on the map side. Small results
    are ranked by a window, larger ones by range blocks.
    """
    distinct = pin(long_fields(df, fields).distinct(), "classes")
    if row_count_up_to(distinct, window_rows) is not None:
        w = Window.partitionBy("feature").orderBy("category")
        ranked = distinct.withColumn("idx", F.row_number().over(w) - 1)
    else:
        ranked = global_rank(distinct, [F.col("category")], "idx", group=["feature"])
    return pin(ranked.withColumn("idx", F.col("idx").cast("int")), "vocab")


def vocabulary_sizes(vocab: DataFrame) -> dict[str, int]:
    """Classes per feature; one row per declared field reaches the driver."""
    return {r["feature"]: r["n"] for r in vocab.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}


def apply_vocabulary(
    df: DataFrame,
    vocab: DataFrame,
    fields: list[str],
    suffix: str = "",
    limit: int = BROADCAST_ROWS,
    sizes: dict[str, int] | None = None,
) -> DataFrame:
    """Replace (or add, with ``suffix``) each field by its class number; unseen and null get ``n``.

    One broadcast hash join per field keeps the row wide and shuffles nothing. Fields with more classes than
    ``limit`` (or beyond four times that in all) go to long form together: one pass finds the frequent
    classes of all of them, one skew-safe join looks them up, and they meet again under the row's number.
    """
    sizes = sizes or vocabulary_sizes(vocab)
    unknown = [f for f in fields if f not in sizes]
    if sizes and unknown:
        raise ValueError(f"the encoder was not fitted on {unknown}")
    wide = set(broadcast_fields(sizes, fields, limit))
    large = [f for f in fields if f not in wide]
    out, ids = df, {}
    if large:
        out = _looked_up_long(df, large, vocab)
    for i, f in enumerate(fields):
        idx = f"_idx{i}" if f in wide else f"_long{large.index(f)}"
        if f in wide:
            table = vocab.where(F.col("feature") == f).select(F.col("category").alias(f"_cat{i}"), F.col("idx").alias(idx))
            out = keyed_lookup(out, as_text(F.col(f)), table, f"_cat{i}", [idx], fits=True)
        ids[f + suffix] = F.coalesce(idx, F.lit(sizes.get(f, 0))).cast("int").alias(f + suffix)
    if suffix:
        return out.select(*df.columns, *ids.values())
    return out.select(*[ids.get(c, F.col(c)) for c in df.columns])


def _looked_up_long(df: DataFrame, fields: list[str], vocab: DataFrame) -> DataFrame:
    """``df`` with the class number of the i-th field as ``_long<i>`` (null: unseen)."""
    table = vocab.withColumnRenamed("category", "_key")
    out, met = fields_join(df, {f: as_text(F.col(f)) for f in fields}, table, ["idx"])
    return out.select(*df.columns, *[F.col(m)["idx"].alias(f"_long{i}") for i, m in enumerate(met)])


def vocabulary_report(df: DataFrame, fields: list[str], hash_factor: int = 5) -> DataFrame:
    """Per encoded field: max+1, distinct count, size with unseen bucket, hash space, automatic width.

    Counts the distinct pairs, not the rows, so no field is shuffled whole.
    """
    pairs = df.select(*[F.col(f).cast("bigint") for f in fields]).unpivot([], fields, "feature", "id").distinct()
    sized = pairs.groupBy("feature").agg(
        (F.max("id") + 1).alias("max_plus_one"), F.count("id").alias("n_unique")
    )
    root = F.floor(F.pow(F.col("n_unique").cast("double"), F.lit(0.25)) + F.lit(1e-9))
    return sized.select(
        "feature",
        "max_plus_one",
        "n_unique",
        (F.col("n_unique") + 1).alias("with_unseen"),
        (F.col("n_unique") * hash_factor).alias("hash_space"),
        (6 * root).cast("bigint").alias("auto_width"),
    )


def lookup_file_vocabulary(
    df: DataFrame, column: str, vocab: DataFrame, default: int = 0, out: str | None = None
) -> DataFrame:
    """``vocab(idx, key)``; keys it lacks get ``default``."""
    table = vocab.select(F.col("key").alias("_key"), F.col("idx").alias("_idx"))
    joined = lookup_join(df.withColumn("_key", F.col(column).cast("string")), table, ["_key"], ["_idx"])
    name = out or f"{column}_idx"
    return joined.withColumn(name, F.coalesce("_idx", F.lit(default)).cast("bigint")).select(*df.columns, name)


def hash_field(c: Column, buckets: int, keep_zero: bool = False, kind: str = "xxhash64") -> Column:
    """Bucket of the text form; with ``keep_zero`` the padding value 0 stays 0."""
    if not keep_zero:
        return hash_bucket(c, buckets, kind)
    text = c.cast("string")
    # texts of zero in whole and fractional types
    return F.when(text.isin("0", "0.0"), F.lit(0).cast("bigint")).otherwise(1 + hash_bucket(c, buckets - 1, kind))
