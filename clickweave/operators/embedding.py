"""Embedding tables ``emb(feature, idx, w, vec)`` and their lookups."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.vectors import literal
from clickweave.operators.encode import as_text, vocabulary_sizes
from clickweave.operators.joins import broadcast_fields, fields_join, fits_broadcast, keyed_lookup, lookup_join, missing_keys, row_bytes, row_limit
from clickweave.scratch import pin


def seeded_normal(seed: int, *keys: Column) -> Column:
    """Normal(0, 1) draw that depends only on seed and keys (Box-Muller on two hashes)."""

    def unit(salt: int) -> Column:
        h = F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), *keys), F.lit(1 << 52)).cast("double")
        return (h + 0.5) / float(1 << 52)

    return F.sqrt(-2.0 * F.log(unit(1))) * F.cos(2.0 * F.pi() * unit(2))


def create_table(
    spark: SparkSession, sizes: dict[str, int], dim: int, seed: int = 2020, std: float = 1e-4
) -> DataFrame:
    """One row per (embedding name, id), re-creatable from the seed alone."""
    parts = None
    for name, n in sizes.items():
        ids = spark.range(n).select(F.lit(name).alias("feature"), F.col("id").cast("int").alias("idx"))
        parts = ids if parts is None else parts.unionByName(ids)
    vec = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)), lambda d: seeded_normal(seed, F.col("feature"), F.col("idx"), d) * std
    )
    return parts.select("feature", "idx", F.lit(0.0).alias("w"), vec.alias("vec"))


def formula_table(
    ids: DataFrame, fields: list[str], vec: Callable[[Column, Column], Column], w: Callable[[Column, Column], Column]
) -> DataFrame:
    """Table over ``ids(feature, idx)`` with values given by expressions of (idx, field position)."""
    pos = F.create_map(*[x for i, f in enumerate(fields) for x in (F.lit(f), F.lit(i))])[F.col("feature")]
    idx = F.col("idx")
    return ids.select("feature", "idx", w(idx, pos).alias("w"), vec(idx, pos).alias("vec"))


def from_vectors(df: DataFrame, name: str, id_col: str, vec_col: str) -> DataFrame:
    """Pretrained (frozen) vectors in table form."""
    return df.select(
        F.lit(name).alias("feature"),
        F.col(id_col).cast("bigint").alias("idx"),
        F.lit(0.0).alias("w"),
        F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("vec"),
    )


def lookup(
    df: DataFrame, id_col: str, table: DataFrame, feature: str, prefix: str, limit: int | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """Add ``<prefix>__w`` and ``<prefix>__v`` for one id column; several columns may share one table."""
    w, v = f"{prefix}__w", f"{prefix}__v"
    one = table.where(F.col("feature") == feature).select(
        F.col("idx").cast("bigint").alias("_id"), F.col("w").alias(w), F.col("vec").alias(v)
    )
    keyed = df.withColumn("_id", F.col(id_col).cast("bigint"))
    return lookup_join(keyed, one, ["_id"], [w, v], fits=fits, limit=limit).drop("_id")


def out_of_range(df: DataFrame, id_cols: list[str], table: DataFrame) -> DataFrame:
    """Distinct (feature, idx) that a lookup would not find; must be empty."""
    ids = df.select(*[F.col(c).cast("bigint").alias(c) for c in id_cols]).unpivot([], id_cols, "feature", "idx")
    return missing_keys(ids, table.select("feature", F.col("idx").cast("bigint").alias("idx")), ["feature", "idx"])


def require_in_range(df: DataFrame, id_cols: list[str], table: DataFrame) -> None:
    bad = out_of_range(df, id_cols, table).limit(1).collect()
    if bad:
        raise ValueError(f"id without an embedding row: {bad[0].asDict()}")


@dataclass(frozen=True)
class Lookup:
    """Vocabulary and embeddings joined once: ``table(feature, category, w, vec)``.

    ``sizes`` are classes per feature; ``spare`` is the row of the unseen bucket of
    each feature (one per declared field). A stored model keeps one of these.
    """

    table: DataFrame
    sizes: dict[str, int]
    spare: dict[str, tuple[float, list[float]]]

    @property
    def dim(self) -> int:
        return max((len(v) for _, v in self.spare.values()), default=64)


def compose(vocab: DataFrame, table: DataFrame, sizes: dict[str, int] | None = None) -> Lookup:
    """Both sides are small next to the facts, so the facts later meet one table, not two."""
    sizes = sizes or vocabulary_sizes(vocab)
    emb = table.select("feature", F.col("idx").cast("int").alias("idx"), "w", "vec")
    met = pin(vocab.select("feature", "category", "idx").join(emb, ["feature", "idx"]).drop("idx"), "lookup")
    keys = table.sparkSession.createDataFrame(list(sizes.items()), "feature string, idx int")
    rows = emb.join(F.broadcast(keys), ["feature", "idx"]).collect()
    return Lookup(met, sizes, {r["feature"]: (r["w"], list(r["vec"])) for r in rows})


def attach(df: DataFrame, fields: list[str], lookup: Lookup, limit: int | None = None) -> DataFrame:
    """Raw categories to ``<field>__w`` and ``<field>__v``, one lookup per field.

    Fields whose tables pass the size check are looked up in the wide row and shuffle nothing. The others
    go to long form together, meet the table in one skew-safe join and come back under the row's number.
    """
    limit = row_limit(64 + 8 * lookup.dim) if limit is None else limit
    wide = broadcast_fields(lookup.sizes, fields, limit)
    large = [f for f in fields if f not in wide]
    out = _attach_long(df, large, lookup) if large else df
    out = _attach_wide(out, wide, lookup) if wide else out
    return out.select(*df.columns, *[f"{f}__{part}" for f in fields for part in "wv"])


def _or_spare(c: Column, lookup: Lookup, feature: str, part: str) -> Column:
    if feature not in lookup.spare:
        return c
    w, vec = lookup.spare[feature]
    return F.coalesce(c, literal(vec) if part == "v" else F.lit(float(w)))


def _attach_wide(df: DataFrame, fields: list[str], lookup: Lookup) -> DataFrame:
    out, columns = df, []
    for i, f in enumerate(fields):
        one = lookup.table.where(F.col("feature") == f).select(
            F.col("category").alias(f"_cat{i}"), F.col("w").alias(f"_w{i}"), F.col("vec").alias(f"_v{i}")
        )
        out = keyed_lookup(out, as_text(F.col(f)), one, f"_cat{i}", [f"_w{i}", f"_v{i}"], fits=True)
        columns.append(_or_spare(F.col(f"_w{i}"), lookup, f, "w").alias(f"{f}__w"))
        columns.append(_or_spare(F.col(f"_v{i}"), lookup, f, "v").alias(f"{f}__v"))
    return out.select(*df.columns, *columns)


def _attach_long(df: DataFrame, fields: list[str], lookup: Lookup) -> DataFrame:
    table = lookup.table.withColumnRenamed("category", "_key")
    out, met = fields_join(df, {f: as_text(F.col(f)) for f in fields}, table, ["w", "vec"])
    columns = []
    for f, m in zip(fields, met):
        columns.append(_or_spare(F.col(m)["w"], lookup, f, "w").alias(f"{f}__w"))
        columns.append(_or_spare(F.col(m)["vec"], lookup, f, "v").alias(f"{f}__v"))
    return out.select(*df.columns, *columns)


def deep_input(vectors: list[Column], numbers: list[Column]) -> Column:
    """Vectors in field order, then numbers, as one flat array."""
    parts = list(vectors)
    if numbers:
        parts.append(F.array(*[n.cast("double") for n in numbers]))
    return F.concat(*parts)


def pair_lookup(
    df: DataFrame, fields: list[str], table: DataFrame, fits: bool | None = None, limit: int | None = None
) -> DataFrame:
    """Field-aware vectors: ``<i>__for__<j>`` from ``table(feature, other, idx, vec)``, ids in ``<i>``.

    All vectors of one field are first put side by side per id, so each field is one broadcast lookup
    instead of one per ordered pair. Larger tables take one join for all fields in long form.
    """
    sides = table.where(F.col("feature").isin(fields) & F.col("other").isin(fields) & (F.col("feature") != F.col("other")))
    vecs = [F.first(F.when(F.col("other") == o, F.col("vec")), ignorenulls=True) for o in fields]
    sides = sides.groupBy("feature", F.col("idx").cast("bigint").alias("_key")).agg(F.array(*vecs).alias("_pair"))
    if fits is None:
        fits = fits_broadcast(sides, row_limit(row_bytes(table) * len(fields)) if limit is None else limit)
    if not fits:
        out, met = fields_join(df, {f: F.col(f).cast("bigint") for f in fields}, sides, ["_pair"])
        return out.select(*df.columns, *_pair_columns(fields, [F.col(m)["_pair"] for m in met]))
    out = df
    for n, f in enumerate(fields):
        one = sides.where(F.col("feature") == f).select(F.col("_key").alias(f"_key{n}"), F.col("_pair").alias(f"_pair{n}"))
        out = keyed_lookup(out, F.col(f).cast("bigint"), one, f"_key{n}", [f"_pair{n}"], fits=True)
    return out.select(*df.columns, *_pair_columns(fields, [F.col(f"_pair{n}") for n in range(len(fields))]))


def _pair_columns(fields: list[str], met: list[Column]) -> list[Column]:
    """A field's vectors travel as one array of them: a chain of joins with a column each is too long to be compiled."""
    return [m[i].alias(f"{f}__for__{o}") for f, m in zip(fields, met) for i, o in enumerate(fields) if o != f]
