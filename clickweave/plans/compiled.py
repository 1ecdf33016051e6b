"""From a declared schema to scores: one plan for every kind of field.

``compile_spec`` turns a ``FeatureSpec`` and a stored model into a plan. Each category field, and each item of
a sequence field, gets its key from the field's own encoding: a fitted encoder, a hash bucket, a vocabulary
file, or an id that is already there. Fields that name one table share it. Small tables of single-valued
fields are broadcast; all sequences and all large fields go to long form together, meet the vectors in
one join, are pooled by field and come back under the row's number. The result has ``<field>__w`` and
``<field>__v`` for every field, whatever its kind, so linear, second-order (over chosen groups) and tower parts
read one set of columns.

Sequences keep their last ``maxlen`` values. Positions count by the length column if there is one, else those
that are not the padding value (0, or null for texts). Weights multiply the vectors before pooling, soft-maxed
over the counted positions if the field says so.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.vectors import literal
from clickweave.operators import interactions as X
from clickweave.operators.embedding import deep_input
from clickweave.operators.encode import as_text, hash_field, vocabulary_sizes
from clickweave.operators.joins import broadcast_fields, keyed_lookup, lookup_join, row_limit
from clickweave.operators.multivalue import _finish, _kept, sequence_weights
from clickweave.operators.rows import numbered, put_back
from clickweave.scratch import pin
from clickweave.spec import CategoryField, FeatureSpec, SequenceField

CELL = "array<struct<field:string,feature:string,key:string,wt:double>>"


@dataclass
class StoredModel:
    """``table(feature, idx, w, vec)`` by embedding name; ``vocab(feature, category, idx)`` of the embeddings that are
    encoded from texts; ``files`` maps a vocabulary path to its ``(idx, key)`` table; ``hash_kind`` names the hash."""

    table: DataFrame
    vocab: DataFrame | None = None
    files: dict[str, DataFrame] = field(default_factory=dict)
    hash_kind: str = "xxhash64"


@dataclass
class CompiledSpec:
    spec: FeatureSpec
    dim: int
    keys: DataFrame  # feature, key, w, vec
    sizes: dict[str, int]
    spare: dict[str, tuple[float, list[float]]]
    encoded: set[str]
    hash_kind: str

    # -- keys

    def _item_key(self, f: CategoryField, value: Column, in_sequence: bool) -> Column:
        """Key of one value in the table of its field; null where nothing is to be looked up."""
        if f.hashed and not f.vocabulary_path:
            bucket = hash_field(F.coalesce(value.cast("string"), F.lit("nan")), f.vocabulary_size, in_sequence, self.hash_kind)
            return F.concat(F.lit("#"), bucket.cast("string"))
        if f.vocabulary_path or f.embedding in self.encoded:
            text = value.cast("string") if in_sequence else as_text(value)
            return F.concat(F.lit(f.vocabulary_path or "="), F.lit(":") if f.vocabulary_path else F.lit(""), text)
        return F.concat(F.lit("#"), value.cast("bigint").cast("string"))

    def _counts(self, f: SequenceField, value: Column) -> Column:
        """Whether a position holds a value, where no length column says so."""
        if f.item.embedding in self.encoded and not f.item.hashed:
            return value.isNotNull()
        return F.coalesce(~value.cast("string").isin("0", "0.0"), F.lit(False))

    def _or_spare(self, c: Column, f: CategoryField, part: str) -> Column:
        if f.embedding not in self.spare or f.hashed or f.vocabulary_path:
            return c
        w, vec = self.spare[f.embedding]
        return F.coalesce(c, literal(vec) if part == "v" else F.lit(float(w)))

    # -- lookups

    def attach(self, df: DataFrame, limit: int | None = None) -> DataFrame:
        """``df`` with ``<field>__w`` and ``<field>__v`` of all fields."""
        limit = row_limit(64 + 8 * self.dim) if limit is None else limit
        single = self.spec.categories
        wide = broadcast_fields({f.name: self.sizes.get(f.embedding, 0) for f in single}, [f.name for f in single], limit)
        large = [f for f in single if f.name not in wide]
        out = self._attach_long(df, large, self.spec.sequences) if large or self.spec.sequences else df
        columns = {f"{f.name}__{p}": F.col(f"{f.name}__{p}") for f in [*large, *self.spec.sequences] for p in "wv"}
        for i, f in enumerate(f for f in single if f.name in wide):
            one = self.keys.where(F.col("feature") == f.embedding).select(
                F.col("key").alias(f"_k{i}"), F.col("w").alias(f"_w{i}"), F.col("vec").alias(f"_v{i}")
            )
            out = keyed_lookup(out, self._item_key(f, F.col(f.name), False), one, f"_k{i}", [f"_w{i}", f"_v{i}"], fits=True)
            columns |= {f"{f.name}__{p}": self._or_spare(F.col(f"_{p}{i}"), f, p) for p in "wv"}
        return out.select(*df.columns, *[c.alias(n) for n, c in columns.items()])

    def _attach_long(self, df: DataFrame, large: list[CategoryField], sequences: list[SequenceField]) -> DataFrame:
        rows, row = numbered(df)
        cells = [self._single_cells(f) for f in large] + [self._sequence_cells(f) for f in sequences]
        long = rows.select(row, F.inline(F.concat(*cells)))
        met = lookup_join(long, self.keys, ["feature", "key"], ["w", "vec"], fits=False if large else None)
        spare = {f.embedding: self.spare[f.embedding] for f in [*large, *[s.item for s in sequences]] if f.embedding in self.spare and not f.hashed and not f.vocabulary_path}
        for name, (w, vec) in spare.items():
            lost = (F.col("feature") == name) & F.col("key").isNotNull() & F.col("vec").isNull()
            met = met.withColumns({"w": F.when(lost, F.lit(float(w))).otherwise(F.col("w")), "vec": F.when(lost, literal(vec)).otherwise(F.col("vec"))})
        aggs, done = [], []
        for i, f in enumerate([*large, *sequences]):
            mine = F.col("field") == f.name
            mode = f.combiner if isinstance(f, SequenceField) else "sum"
            gather = F.max if mode == "max" else F.sum
            values = {"w": F.col("w")} | {f"v{d}": F.col("vec").getItem(d) for d in range(self.dim)}
            aggs += [gather(F.when(mine, c * F.col("wt"))).alias(f"_{i}_{n}") for n, c in values.items()]
            aggs.append(F.count(F.when(mine, F.col("key"))).alias(f"_{i}_n"))
            n = F.coalesce(F.col(f"_{i}_n"), F.lit(0))
            # a single value that is nowhere stays null, as in the wide plan; a sequence without values pools nothing
            finish = (lambda c, n=n, mode=mode: _finish(c, n, mode, None)) if isinstance(f, SequenceField) else (lambda c: c)
            vec = F.array(*[finish(F.col(f"_{i}_v{d}")) for d in range(self.dim)])
            if not isinstance(f, SequenceField):
                vec = F.when(F.col(f"_{i}_w").isNotNull(), vec)
            done += [finish(F.col(f"_{i}_w")).alias(f"{f.name}__w"), vec.alias(f"{f.name}__v")]
        found = put_back(rows, met.groupBy(row).agg(*aggs), row)
        return found.select(*df.columns, *done)

    def _single_cells(self, f: CategoryField) -> Column:
        cell = F.struct(F.lit(f.name).alias("field"), F.lit(f.embedding).alias("feature"), self._item_key(f, F.col(f.name), False).alias("key"), F.lit(1.0).alias("wt"))
        return F.array(cell).cast(CELL)

    def _sequence_cells(self, f: SequenceField) -> Column:
        length = F.col(f.length_column) if f.length_column else None
        ids, length, weights = _kept(F.col(f.name), length, F.col(f.weight_column) if f.weight_column else None, f.maxlen)
        valid = F.transform(ids, lambda x, i: (i < length) if length is not None else self._counts(f, x))
        wt = sequence_weights(weights, valid, f.weight_norm) if weights is not None else F.transform(ids, lambda _: F.lit(1.0))
        zipped = F.arrays_zip(ids.alias("i"), valid.alias("ok"), wt.alias("wt"))
        name, feature = F.lit(f.name).alias("field"), F.lit(f.embedding).alias("feature")
        cells = F.transform(
            zipped, lambda c: F.struct(name, feature, F.when(c["ok"], self._item_key(f.item, c["i"], True)).alias("key"), c["wt"].alias("wt"))
        )
        return F.coalesce(cells.cast(CELL), F.array().cast(CELL))

    # -- parts of a model

    def numbers(self) -> list[Column]:
        """Dense fields in order, transformed if they say so, one column for each of their numbers."""
        out: list[Column] = []
        for f in self.spec.numbers:
            c = f.transform(F.col(f.name)) if f.transform else F.col(f.name)
            out += [c] if f.dimension == 1 else [F.get(c, F.lit(d)) for d in range(f.dimension)]
        return out

    def grouped(self) -> dict[str, list[str]]:
        """Fields by group, categories before sequences, as towers and second-order parts read them."""
        out: dict[str, list[str]] = {}
        for f in [*self.spec.categories, *self.spec.sequences]:
            out.setdefault(f.group, []).append(f.name)
        return out

    def linear(self, kernel: Sequence[float]) -> Column:
        names = [n for own in self.grouped().values() for n in own]
        return X.linear_logit([F.col(f"{n}__w") for n in names], self.numbers(), kernel)

    def second_order(self, groups: Sequence[str] | None = None) -> Column | None:
        """One second-order term for each chosen group (all by default)."""
        own = [v for g, v in self.grouped().items() if (groups is None or g in groups) and len(v) > 1]
        return X.logit_sum(*[X.fm_second_order([F.col(f"{n}__v") for n in v], self.dim) for v in own]) if own else None

    def tower_input(self) -> Column:
        return deep_input([F.col(f"{n}__v") for own in self.grouped().values() for n in own], self.numbers())


def compile_spec(spec: FeatureSpec, model: StoredModel) -> CompiledSpec:
    """Joins encoders and vectors once, under the keys that the spec's fields will ask for."""
    items = [*spec.categories, *[s.item for s in spec.sequences]]
    dims = {f.dim for f in items}
    if len(dims) > 1:
        raise ValueError(f"fields of several widths {sorted(dims)} have no second-order term")
    emb = model.table.select("feature", F.col("idx").cast("bigint").alias("idx"), F.col("w").cast("double").alias("w"), "vec")
    used = sorted({f.embedding for f in items})
    parts, encoded, sizes, spare = [], set(), {}, {}
    texts = {f.embedding for f in items if not f.hashed and not f.vocabulary_path}
    if model.vocab is not None:
        sizes = {f: n for f, n in vocabulary_sizes(model.vocab).items() if f in texts}
        encoded = set(sizes)
        vocab = model.vocab.where(F.col("feature").isin(sorted(encoded)))
        parts.append(vocab.join(emb, ["feature", "idx"]).select("feature", F.concat(F.lit("="), "category").alias("key"), "w", "vec"))
        wanted = [(f, n) for f, n in sizes.items()]
        if wanted:
            asked = model.table.sparkSession.createDataFrame(wanted, "feature string, idx bigint")
            spare = {r["feature"]: (r["w"], list(r["vec"])) for r in emb.join(F.broadcast(asked), ["feature", "idx"]).collect()}
    for f in items:
        if f.vocabulary_path:
            file = model.files[f.vocabulary_path].select(F.col("key").alias("_key"), F.col("idx").cast("bigint").alias("idx"))
            own = file.join(emb.where(F.col("feature") == f.embedding), "idx")
            parts.append(own.select("feature", F.concat(F.lit(f.vocabulary_path + ":"), "_key").alias("key"), "w", "vec"))
    numbered_ = [e for e in used if e not in encoded or any(f.hashed for f in items if f.embedding == e)]
    if numbered_:
        parts.append(emb.where(F.col("feature").isin(numbered_)).select("feature", F.concat(F.lit("#"), F.col("idx").cast("string")).alias("key"), "w", "vec"))
    keys = parts[0]
    for p in parts[1:]:
        keys = keys.unionByName(p)
    keys = pin(keys.distinct(), "spec-keys")
    counts = {r["feature"]: r["n"] for r in keys.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    return CompiledSpec(spec, next(iter(dims), 0), keys, counts, spare, encoded, model.hash_kind)


def score_spec(
    df: DataFrame, compiled: CompiledSpec, kernel: Sequence[float], bias: float = 0.0, groups: Sequence[str] | None = None,
    tower=None, tower_kernel: Sequence[float] | None = None, task: str = "binary", out: str = "score", limit: int | None = None,
) -> DataFrame:
    """Linear part, second order over the chosen groups and, if given, a tower over all vectors and numbers."""
    from clickweave.functions.towers import tower_logit

    met = compiled.attach(df, limit)
    parts = [compiled.linear(kernel)]
    second = compiled.second_order(groups)
    if second is not None:
        parts.append(second)
    ready = met.select(*df.columns, X.logit_sum(*parts).alias("_wide"), *([compiled.tower_input().alias("_in")] if tower else []))
    logits = [F.col("_wide")] + ([tower_logit(tower, tower_kernel)(F.col("_in"))] if tower else [])
    return ready.withColumn(out, X.predict_head(X.logit_sum(*logits), task, bias)).select(*df.columns, out)
