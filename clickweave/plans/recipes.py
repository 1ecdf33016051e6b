"""Scoring jobs put together from listed stages; a model is a line of configuration."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.towers import Tower, tower_output
from clickweave.functions.vectors import column_sum, dot, elements, in_small_methods, literal
from clickweave.operators import interactions as X
from clickweave.operators.embedding import pair_lookup


@dataclass(frozen=True)
class Recipe:
    """``deep`` blocks feed the tower, ``beside`` blocks join its output before the last
    kernel, ``terms`` are logits of their own. ``factors`` lets the tower reweight fields."""

    deep: tuple[str, ...] = ("vectors", "numbers")
    beside: tuple[str, ...] = ()
    terms: tuple[str, ...] = ()
    linear: bool = True
    factors: bool = False


RECIPES: dict[str, Recipe] = {
    "wide_deep": Recipe(),
    "fnn": Recipe(),
    "nfm": Recipe(deep=("bi", "numbers")),
    "ipnn": Recipe(deep=("vectors", "inner", "numbers"), linear=False),
    "opnn": Recipe(deep=("vectors", "outer", "numbers"), linear=False),
    "pnn": Recipe(deep=("vectors", "inner", "outer", "numbers"), linear=False),
    "deepfefm": Recipe(deep=("vectors", "numbers", "embedded_pairs"), terms=("embedded",)),
    "deepfefm_shallow": Recipe(deep=(), terms=("embedded",)),
    "deepfefm_only_pairs": Recipe(deep=(), terms=("embedded",), linear=False),
    "deepfefm_plain_deep": Recipe(deep=("vectors", "numbers", "embedded_pairs")),
    "deepfefm_only_deep": Recipe(deep=("vectors", "numbers", "embedded_pairs"), linear=False),
    "deepfefm_no_linear": Recipe(deep=("vectors", "numbers", "embedded_pairs"), terms=("embedded",), linear=False),
    "deepfefm_no_vectors": Recipe(deep=("embedded_pairs",), terms=("embedded",)),
    "deepfefm_no_pairs_in_deep": Recipe(deep=("vectors", "numbers"), terms=("embedded",)),
    "linear": Recipe(deep=()),
    "flen": Recipe(beside=("groups",)),
    "fibinet": Recipe(deep=("squeezed_bilinear", "bilinear", "numbers")),
    "dcn": Recipe(beside=("cross",)),
    "dcn_cross_only": Recipe(deep=(), beside=("cross",)),
    "ifm": Recipe(deep=("vectors",), factors=True),
    "onn": Recipe(deep=("field_aware", "numbers")),
    "afn": Recipe(deep=("log",)),
}


@dataclass
class Parts:
    """What a recipe is filled with: declared fields and the stored constants of the model."""

    fields: list[str]
    numbers: list[str]
    dim: int
    kernel: list[float] = field(default_factory=list)
    tower: Tower | None = None
    tower_kernel: list[float] = field(default_factory=list)
    bias: float = 0.0
    task: str = "binary"
    weights: dict[str, Any] = field(default_factory=dict)
    groups: dict[str, list[str]] = field(default_factory=dict)
    pair_table: DataFrame | None = None
    id_suffix: str = "__id"


def _vectors(p: Parts) -> list[Column]:
    return [F.col(f"{f}__v") for f in p.fields]


def _block(name: str, p: Parts) -> Column:
    v, c = _vectors(p), p.weights
    if name == "vectors":
        return F.concat(*v)
    if name == "numbers":
        return F.array(*[F.col(x).cast("double") for x in p.numbers]) if p.numbers else F.expr("cast(array() as array<double>)")
    if name == "bi":
        return X.bi_interaction(v, p.dim)
    if name == "inner":
        return F.array(*X.inner_products(v, p.dim))
    if name == "outer":
        return F.array(*X.outer_products(v, c["outer"], c.get("outer_kind", "mat"), p.dim))
    if name == "embedded_pairs":
        return F.col("_embedded")
    if name == "bilinear":
        return F.concat(*X.bilinear(v, c["bilinear"], c.get("bilinear_kind", "interaction"), p.dim))
    if name == "squeezed_bilinear":
        s = [F.col(f"_s{i}") for i in range(len(v))]
        return F.concat(*X.bilinear(s, c["squeezed"], c.get("bilinear_kind", "interaction"), p.dim))
    if name == "log":
        return X.log_transform(v, c["log_w"], c["log_b"], p.dim, c.get("log_norm_in"), c.get("log_norm_out"))
    if name == "field_aware":
        cells = X.field_aware_products([f + p.id_suffix for f in p.fields], c.get("reduce_sum", False))
        return F.array(*cells) if c.get("reduce_sum", False) else F.concat(*cells)
    if name == "groups":
        g = [[F.col(f"{f}__v") for f in fs] for fs in p.groups.values()]
        return X.group_bi_interaction(g, c["k_mf"], c["k_fm"], c.get("b_mf"), c.get("b_fm"))
    if name == "cross":
        return F.col("_cross")
    raise ValueError(f"unknown block {name}")


def _prepare(df: DataFrame, r: Recipe, p: Parts) -> DataFrame:
    """Columns that several stages read, each evaluated once."""
    used = {*r.deep, *r.beside, *r.terms}
    if used & {"embedded_pairs", "embedded"}:
        df = in_small_methods(df, _embedded=F.array(*X.field_embedded(_vectors(p), p.weights["embedded"], p.dim)))
    if "squeezed_bilinear" in used:
        df = X.with_squeeze_weights(df, _vectors(p), p.weights["squeeze1"], p.weights["squeeze2"], p.dim, "_sq")
        df = in_small_methods(df, **{f"_s{i}": c for i, c in enumerate(X.reweight(_vectors(p), F.col("_sq"), p.dim))})
    if "cross" in used:
        df = df.withColumn("_x0", F.concat(_block("vectors", p), _block("numbers", p)))
        df = X.cross_layers(df, "_x0", p.weights["cross"], "_cross", p.weights.get("cross_kind", "vector"))
    if "field_aware" in used:
        df = pair_lookup(df, [f + p.id_suffix for f in p.fields], p.pair_table)
    return df


def score_recipe(df: DataFrame, name: str, p: Parts, out: str = "score") -> DataFrame:
    """``df`` with attached ``__w`` / ``__v`` columns to a score."""
    r = RECIPES[name]
    columns = df.columns
    cur = _prepare(df, r, p)
    deep = None
    if r.deep:
        cur = in_small_methods(cur, _in=F.concat(*[_block(b, p) for b in r.deep]))
        cur = cur.withColumn("_deep", tower_output(p.tower)(F.col("_in")))
        deep = F.col("_deep")
    w = [F.col(f"{f}__w") for f in p.fields]
    numbers = [F.col(c) for c in p.numbers]
    if r.factors:
        logits = dot_rows(p.weights["factors"], deep)
        cur = cur.withColumn("_m", X.input_aware_factors(logits, len(p.fields)))
        m = [F.col("_m").getItem(i) for i in range(len(p.fields))]
        cur = cur.withColumns({f"_r{i}": c for i, c in enumerate(X.reweight(_vectors(p), F.col("_m")))})
        second = X.fm_second_order([F.col(f"_r{i}") for i in range(len(p.fields))], p.dim)
        logit = X.linear_logit(w, numbers, p.kernel, refine=m) + second
        return cur.select(*columns, X.predict_head(logit, p.task, p.bias).alias(out))
    terms: list[Column] = []
    if r.linear:
        terms.append(X.linear_logit(w, numbers, p.kernel))
    if "embedded" in r.terms:
        terms.append(column_sum(elements(F.col("_embedded"), len(X.pairs(len(p.fields))))))
    stacked = [_block(b, p) for b in r.beside] + ([deep] if deep is not None else [])
    if stacked:
        last, width = F.concat(*stacked) if len(stacked) > 1 else stacked[0], len(p.tower_kernel)
        if width <= X.WRITTEN:
            cur = cur.withColumn("_last", last)
            terms.append(column_sum([x * F.lit(float(k)) for x, k in zip(elements(F.col("_last"), width), p.tower_kernel)]))
        else:
            terms.append(dot(last, literal(p.tower_kernel)))
    cur = in_small_methods(cur, _logit=X.logit_sum(*terms))
    return cur.select(*columns, X.predict_head(F.col("_logit"), p.task, p.bias).alias(out))


def dot_rows(rows, v: Column) -> Column:
    from clickweave.functions.vectors import matvec

    return matvec(literal(rows), v)
