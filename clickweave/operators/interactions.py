"""Feature interactions of one row, written as expressions over its field vectors.

Once the vectors of a row are in the row, every interaction is a projection: no
shuffle, whatever the table size. Weights are small constants of the model
(fields x fields x width), never data. A long-form plan exists for the terms
that are plain sums (linear, second order, bi-interaction), for tables too wide
to gather.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.scalars import sigmoid
from clickweave.functions.vectors import (
    column_sum, dot, elements, hadamard, in_small_methods, literal, matvec, plus, quadratic, relu, scale, softmax, total, vector_sum,
)

# fixed value: up to this many products a sum is written out, which compiles to
# straight arithmetic; longer ones use array functions so the method stays small
UNROLL = 256
# and up to this many where the projection is compiled as many small methods
WRITTEN = 2048


def pairs(n: int) -> list[tuple[int, int]]:
    return list(combinations(range(n), 2))


# ---- first order -------------------------------------------------------

def linear_logit(
    weights: Sequence[Column],
    numbers: Sequence[Column] = (),
    kernel: Sequence[float] = (),
    bias: float | None = None,
    refine: Sequence[Column] | None = None,
) -> Column:
    """Sum of looked-up weights and numbers times kernel; nothing declared gives 0."""
    if refine is not None:
        weights = [w * r for w, r in zip(weights, refine)]
    terms = list(weights) + [n.cast("double") * F.lit(float(k)) for n, k in zip(numbers, kernel)]
    if not terms:
        return F.lit(0.0)
    if bias is not None:
        terms.append(F.lit(float(bias)))
    return column_sum(terms)


# ---- second order ------------------------------------------------------

def second_order_parts(vectors: Sequence[Column], dim: int) -> list[Column]:
    """Per dimension ``(sum)^2 - sum of squares``."""
    cells = [elements(v, dim) for v in vectors]
    out = []
    for d in range(dim):
        s = column_sum([c[d] for c in cells])
        out.append(s * s - column_sum([c[d] * c[d] for c in cells]))
    return out


def fm_second_order(vectors: Sequence[Column], dim: int) -> Column:
    if len(vectors) * dim <= UNROLL:
        return 0.5 * column_sum(second_order_parts(vectors, dim))
    return 0.5 * total(_square_gap(vectors))


def _square_gap(vectors: Sequence[Column]) -> Column:
    squares = vector_sum([hadamard(v, v) for v in vectors])
    return F.zip_with(vector_sum(vectors), squares, lambda s, q: s * s - q)


def bi_interaction(vectors: Sequence[Column], dim: int) -> Column:
    if len(vectors) * dim <= UNROLL:
        return F.array(*[0.5 * c for c in second_order_parts(vectors, dim)])
    return F.transform(_square_gap(vectors), lambda x: 0.5 * x)


def long_second_order(cells: DataFrame, key: list[str], dim: int | None = None) -> DataFrame:
    """``cells(key..., field, vec)`` to ``fm`` and the pooled vector per row.

    Sums of v and of v squared per dimension combine on the map side; the
    shuffle carries 2 x width numbers per row and task, not one row per cell.
    With a known width they are columns of one row per key, and a caller that
    reads only ``fm`` moves the sums of v and one sum of squares.
    """
    if dim is not None:
        x = elements(F.col("vec"), dim)
        sums = cells.where(F.col("vec").isNotNull()).groupBy(*key).agg(
            *[F.sum(c).alias(f"_s{d}") for d, c in enumerate(x)], *[F.sum(c * c).alias(f"_q{d}") for d, c in enumerate(x)],
            F.sum(column_sum([F.coalesce(c * c, F.lit(0.0)) for c in x])).alias("_q"),
        )
        s = [F.col(f"_s{d}") for d in range(dim)]
        squares = column_sum([F.coalesce(c * c, F.lit(0.0)) for c in s])
        return sums.select(
            *key, F.when(F.coalesce(*s).isNotNull(), 0.5 * (squares - F.col("_q"))).alias("fm"),
            F.array(*[0.5 * (c * c - F.col(f"_q{d}")) for d, c in enumerate(s)]).alias("bi"),
        )
    marked = cells.select(*key, F.posexplode("vec").alias("d", "v"))
    per_dim = marked.groupBy(*key, "d").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"))
    half = 0.5 * (F.col("s") * F.col("s") - F.col("q"))
    return per_dim.groupBy(*key).agg(
        F.sum(half).alias("fm"),
        F.transform(F.array_sort(F.collect_list(F.struct("d", half.alias("x")))), lambda c: c["x"]).alias("bi"),
    )


def long_linear(cells: DataFrame, key: list[str]) -> DataFrame:
    """``cells(key..., w, x)`` to the first-order logit per row."""
    return cells.groupBy(*key).agg(F.sum(F.col("w") * F.col("x")).alias("linear"))


# ---- pairs -------------------------------------------------------------

def _width(dim: int | None, terms: int) -> int | None:
    """The width, if writing out ``terms`` products keeps the compiled method small."""
    return dim if dim is not None and terms <= UNROLL else None


def inner_products(vectors: Sequence[Column], dim: int | None = None) -> list[Column]:
    ij = pairs(len(vectors))
    w = _width(dim, len(ij) * (dim or 0))
    return [dot(vectors[i], vectors[j], w) for i, j in ij]


def element_products(vectors: Sequence[Column], dim: int | None = None) -> list[Column]:
    ij = pairs(len(vectors))
    w = _width(dim, len(ij) * (dim or 0))
    return [hadamard(vectors[i], vectors[j], w) for i, j in ij]


def outer_products(vectors: Sequence[Column], kernels: Sequence, kind: str = "mat", dim: int | None = None) -> list[Column]:
    """``mat``: q' K p; ``vec``: sum k p q; ``num``: k (p . q); one kernel per pair."""
    ij = pairs(len(vectors))
    if kind == "mat":
        w = _width(dim, len(ij) * (dim or 0) ** 2)
        if w:
            return [quadratic(vectors[j], k, vectors[i]) for (i, j), k in zip(ij, kernels)]
        return [dot(vectors[j], matvec(literal(k), vectors[i])) for (i, j), k in zip(ij, kernels)]
    products = _width(dim, len(ij) * (dim or 0))
    if kind == "vec":
        if products:
            cells = [zip(k, elements(vectors[i], products), elements(vectors[j], products)) for (i, j), k in zip(ij, kernels)]
            return [column_sum([F.lit(float(a)) * (x * y) for a, x, y in c]) for c in cells]
        return [dot(literal(k), hadamard(vectors[i], vectors[j])) for (i, j), k in zip(ij, kernels)]
    if kind == "num":
        return [F.lit(float(k)) * dot(vectors[i], vectors[j], products) for (i, j), k in zip(ij, kernels)]
    raise ValueError(f"unknown kernel kind {kind}")


def field_weighted(vectors: Sequence[Column], strength: Sequence[float], dim: int | None = None) -> Column:
    return column_sum([F.lit(float(r)) * p for r, p in zip(strength, inner_products(vectors, dim))])


def field_embedded(vectors: Sequence[Column], kernels: Sequence, dim: int | None = None) -> list[Column]:
    """Per pair ``v_i' (W + W') v_j``; the symmetric kernel is formed once, outside the query."""
    ij = pairs(len(vectors))
    w = _width(dim, len(ij) * (dim or 0) ** 2)
    out = []
    for (i, j), k in zip(ij, kernels):
        n = len(k)
        sym = [[float(k[a][b]) + float(k[b][a]) for b in range(n)] for a in range(n)]
        out.append(quadratic(vectors[i], sym, vectors[j]) if w else dot(vectors[i], matvec(literal(sym), vectors[j])))
    return out


def bilinear(vectors: Sequence[Column], kernels, kind: str = "interaction", dim: int | None = None) -> list[Column]:
    """``(v_i W) * v_j`` with one W for all, one per left field, or one per pair."""
    ij = pairs(len(vectors))
    w = _width(dim, len(ij) * (dim or 0) ** 2)

    def times(v: Column, m) -> Column:
        columns = [list(c) for c in zip(*m)]
        if w:
            x = elements(v, w)
            return F.array(*[column_sum([F.lit(float(k)) * e for k, e in zip(c, x)]) for c in columns])
        return matvec(literal(columns), v)

    if kind == "interaction":
        return [hadamard(times(vectors[i], kernels[n]), vectors[j], w) for n, (i, j) in enumerate(ij)]
    if kind == "each":
        left = [times(v, kernels[i]) for i, v in enumerate(vectors[:-1])]
    elif kind == "all":
        left = [times(v, kernels) for v in vectors[:-1]]
    else:
        raise ValueError(f"unknown bilinear kind {kind}")
    return [hadamard(left[i], vectors[j], w) for i, j in ij]


def pair_products(vectors: Sequence[Column], dim: int | None = None) -> Column:
    """Element products of all field pairs, as an array of vectors."""
    return F.array(*element_products(vectors, dim))


def pair_attention(products: Column, w, b, h) -> Column:
    """Softmax over the pairs of ``h . relu(W' p + b)``; ``w`` is input x attention width."""
    columns = literal([list(c) for c in zip(*w)])
    scores = F.transform(products, lambda p: dot(relu(plus(matvec(columns, p), literal(b))), literal(h)))
    return softmax(scores)


def with_pair_attention(df: DataFrame, products: str, n: int, w, b, h, out: str) -> DataFrame:
    """``pair_attention`` of ``n`` pairs of known width, written out; each step is a projection of its own."""
    scores = []
    for i in range(n):
        x = elements(F.col(products).getItem(i), len(w))
        hidden = [
            F.greatest(column_sum([F.lit(float(w[d][t])) * x[d] for d in range(len(w))]) + F.lit(float(b[t])), F.lit(0.0))
            for t in range(len(h))
        ]
        scores.append(column_sum([a * F.lit(float(k)) for a, k in zip(hidden, h)]))
    cur = in_small_methods(df, _scores=F.array(*scores)).withColumn("_top", F.array_max("_scores"))
    cur = cur.withColumn("_exp", F.array(*[F.exp(s - F.col("_top")) for s in elements(F.col("_scores"), n)]))
    cur = cur.withColumn("_norm", column_sum(elements(F.col("_exp"), n)))
    cur = cur.withColumn(out, F.array(*[e / F.col("_norm") for e in elements(F.col("_exp"), n)]))
    return cur.drop("_scores", "_top", "_exp", "_norm")


def attentional_fm(products: Column, weights: Column, projection: Sequence[float], n: int | None = None) -> Column:
    """Projection of the weighted pair sum; linear, so pairs are projected first. ``n`` pairs, if known, are written out."""
    if n is not None:
        cells = [elements(products.getItem(i), len(projection)) for i in range(n)]
        sums = [column_sum([x * F.lit(float(k)) for x, k in zip(c, projection)]) for c in cells]
        return column_sum([a * s for a, s in zip(elements(weights, n), sums)])
    p = literal(list(projection))
    return total(F.zip_with(products, weights, lambda x, a: a * dot(x, p)))


# ---- field weighting ---------------------------------------------------

def squeeze_weights(vectors: Sequence[Column], w1, w2, dim: int) -> Column:
    """One weight per field: mean, two dense layers with relu (matrices are input x output)."""
    means = F.array(*[total(v) / float(dim) for v in vectors])
    first = relu(matvec(literal([list(c) for c in zip(*w1)]), means))
    return relu(matvec(literal([list(c) for c in zip(*w2)]), first))


def with_squeeze_weights(df: DataFrame, vectors: Sequence[Column], w1, w2, dim: int, out: str) -> DataFrame:
    """``squeeze_weights`` of known widths, written out; each layer is a projection of its own."""
    cur = in_small_methods(df, _layer=F.array(*[column_sum(elements(v, dim)) / float(dim) for v in vectors]))
    for name, m in (("_layer", w1), (out, w2)):
        x = elements(F.col("_layer"), len(m))
        cells = [column_sum([F.lit(float(k)) * a for k, a in zip(c, x)]) for c in zip(*m)]
        cur = in_small_methods(cur, **{name: F.array(*[F.greatest(c, F.lit(0.0)) for c in cells])})
    return cur.drop("_layer")


def reweight(vectors: Sequence[Column], weights: Column, dim: int | None = None) -> list[Column]:
    return [scale(v, weights.getItem(i), dim) for i, v in enumerate(vectors)]


def field_gates(gates: Sequence[float], tau: float = 1.0) -> list[float]:
    """Softmax of ``g / tau`` over the fields; constants of the model."""
    import math

    top = max(gates) / tau
    e = [math.exp(g / tau - top) for g in gates]
    return [x / sum(e) for x in e]


def gate(vectors: Sequence[Column], gates: Sequence[float], tau: float = 1.0, dim: int | None = None) -> list[Column]:
    return [scale(v, F.lit(g), dim) for v, g in zip(vectors, field_gates(gates, tau))]


def input_aware_factors(logits: Column, fields: int) -> Column:
    """``fields * softmax(logits)``, one factor per field."""
    return F.transform(softmax(logits), lambda x: x * float(fields))


def group_bi_interaction(
    groups: Sequence[Sequence[Column]], k_mf: Sequence[float], k_fm: Sequence[float],
    bias_mf: Sequence[float] | None = None, bias_fm: Sequence[float] | None = None,
) -> Column:
    """Products between group sums times ``k_mf`` plus ``(S^2 - Q)`` inside groups times ``k_fm``."""
    sums = [vector_sum(g) for g in groups]
    terms = [scale(hadamard(sums[i], sums[j]), F.lit(float(k))) for (i, j), k in zip(pairs(len(groups)), k_mf)]
    terms += [scale(_square_gap(g), F.lit(float(k))) for g, k in zip(groups, k_fm)]
    terms += [literal(list(b)) for b in (bias_mf, bias_fm) if b is not None]
    return vector_sum(terms)


# ---- cross layers ------------------------------------------------------

def cross_vector(x0: Column, xl: Column, w: Sequence[float], b: Sequence[float]) -> Column:
    """``x0 (xl . w) + b + xl``."""
    return plus(plus(scale(x0, dot(xl, literal(list(w)))), literal(list(b))), xl)


def cross_matrix(x0: Column, xl: Column, w, b: Sequence[float]) -> Column:
    """``x0 * (W xl + b) + xl``."""
    n = len(b)
    if n * n <= WRITTEN:
        x, y = elements(x0, n), elements(xl, n)
        rows = [column_sum([F.lit(float(k)) * c for k, c in zip(r, y)]) + F.lit(float(a)) for r, a in zip(w, b)]
        return F.array(*[p * r + c for p, r, c in zip(x, rows, y)])
    return plus(hadamard(x0, plus(matvec(literal(w), xl), literal(list(b)))), xl)


def cross_layers(df: DataFrame, x0: str, layers: Sequence[tuple], out: str, kind: str = "vector") -> DataFrame:
    """Chain of cross layers, one projection each so a layer is evaluated once."""
    step = cross_vector if kind == "vector" else cross_matrix
    cur = df.withColumn(out, F.col(x0))
    for w, b in layers:
        if kind == "vector" and len(b) <= WRITTEN:
            first, own = elements(F.col(x0), len(b)), elements(F.col(out), len(b))
            cur = in_small_methods(cur, _share=column_sum([x * F.lit(float(k)) for x, k in zip(own, w)]))
            cells = [x * F.col("_share") + F.lit(float(a)) + y for x, a, y in zip(first, b, own)]
            cur = in_small_methods(cur, **{out: F.array(*cells)}).drop("_share")
        else:
            cur = in_small_methods(cur, **{out: step(F.col(x0), F.col(out), w, b)})
    return cur


# ---- logarithmic neurons ----------------------------------------------

def log_transform(
    vectors: Sequence[Column], weights, biases: Sequence[float], dim: int,
    norm_in: Sequence[tuple] | None = None, norm_out: Sequence[tuple] | None = None,
) -> Column:
    """``exp(sum_f w[f][h] ln max(|v|, 1e-7) + b[h])``, dimension-major, width x neurons long.

    ``norm_*`` are stored (scale, shift) per dimension, already folded from mean,
    variance and learned factors.
    """
    logs = [F.transform(v, lambda x: F.log(F.greatest(F.abs(x), F.lit(1e-7)))) for v in vectors]
    if norm_in is not None:
        gain, shift = literal([a for a, _ in norm_in]), literal([c for _, c in norm_in])
        logs = [plus(hadamard(v, gain), shift) for v in logs]
    out = []
    for d in range(dim):
        for h, b in enumerate(biases):
            z = column_sum([F.lit(float(weights[f][h])) * v.getItem(d) for f, v in enumerate(logs)]) + F.lit(float(b))
            e = F.exp(z)
            if norm_out is not None:
                e = e * F.lit(float(norm_out[d][0])) + F.lit(float(norm_out[d][1]))
            out.append(e)
    return F.array(*out)


def folded_norm(mean, variance, gain, shift, eps: float = 1e-5) -> list[tuple[float, float]]:
    """Stored normalisation as ``x * a + c`` per dimension."""
    a = [g / (v + eps) ** 0.5 for g, v in zip(gain, variance)]
    return [(x, s - m * x) for x, s, m in zip(a, shift, mean)]


# ---- field-aware pairs -------------------------------------------------

def field_aware_products(df_fields: Sequence[str], reduce_sum: bool = False) -> list[Column]:
    """``e_i for j`` times ``e_j for i`` from the columns of a field-aware lookup."""
    step = dot if reduce_sum else hadamard
    return [
        step(F.col(f"{df_fields[i]}__for__{df_fields[j]}"), F.col(f"{df_fields[j]}__for__{df_fields[i]}"))
        for i, j in pairs(len(df_fields))
    ]


# ---- heads -------------------------------------------------------------

def predict_head(logit: Column, task: str = "binary", bias: float = 0.0) -> Column:
    x = logit + F.lit(float(bias)) if bias else logit
    if task == "binary":
        return sigmoid(x)
    if task == "regression":
        return x
    raise ValueError("task must be binary or regression")


def logit_sum(*parts: Column | None) -> Column:
    have = [p for p in parts if p is not None]
    return column_sum(have) if have else F.lit(0.0)


def region_mixture(region_logits: Sequence[Column], learner_logits: Sequence[Column], task: str = "binary",
                   bias_logit: Column | None = None) -> Column:
    """``sum_r softmax(region)_r * head(learner)_r``, times the bias score if there is one."""
    if len(region_logits) < 2:
        raise ValueError("at least two regions are needed")
    share = softmax(F.array(*region_logits))
    score = dot(share, F.array(*[predict_head(x, task) for x in learner_logits]))
    return score if bias_logit is None else score * sigmoid(bias_logit)


def task_product(first: Column, second: Column) -> Column:
    return first * second


