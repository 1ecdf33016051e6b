"""Dense towers and attention nets on Arrow batches; weights travel once per task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F


def activate(x: np.ndarray, kind: str) -> np.ndarray:
    if kind == "relu":
        return np.maximum(x, 0.0)
    if kind == "sigmoid":
        e = np.exp(-np.abs(x))
        return np.where(x >= 0, 1.0 / (1.0 + e), e / (1.0 + e))
    if kind == "tanh":
        return np.tanh(x)
    if kind == "linear":
        return x
    raise ValueError(f"unknown activation {kind}")


@dataclass(frozen=True)
class Tower:
    """Layers ``(matrix input x output, bias)``; ``norms`` are stored (gain, shift) per unit or None."""

    layers: Sequence[tuple]
    activation: str = "relu"
    norms: Sequence[tuple | None] = field(default=())
    output_activation: str | None = None

    def arrays(self):
        n = len(self.layers)
        norms = list(self.norms) + [None] * (n - len(self.norms))
        kinds = [self.activation] * n
        if self.output_activation and n:
            kinds[-1] = self.output_activation
        return [
            (np.asarray(w, float), np.asarray(b, float), None if g is None else np.asarray(g, float), k)
            for (w, b), g, k in zip(self.layers, norms, kinds)
        ]


def run_layers(x: np.ndarray, layers) -> np.ndarray:
    for w, b, norm, kind in layers:
        x = x @ w + b
        if norm is not None:
            x = x * norm[0] + norm[1]
        x = activate(x, kind)
    return x


def once(run):
    """Call an Arrow function with its array and that array's size.

    The size is checked against the rows. Naming the array twice also makes the
    optimizer compute it in a projection of its own, below the Python call.
    """
    return lambda v: run(v, F.size(v))


def matrix_of(column: pa.Array, sizes: pa.Array | None = None) -> np.ndarray:
    """Rows of a list column as a matrix; every list must have the same length."""
    if column.null_count:
        raise ValueError("a tower input is null")
    if sizes is not None and len(column) and pc.min_max(sizes)["min"] != pc.min_max(sizes)["max"]:
        raise ValueError("tower inputs differ in length")
    if len(column) == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def lists_of(m: np.ndarray) -> pa.Array:
    offsets = np.arange(0, (m.shape[0] + 1) * m.shape[1], m.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(m).ravel()))


def tower_output(tower: Tower):
    """Array in, array of the last layer out."""
    layers = tower.arrays()

    @F.arrow_udf("array<double>")
    def run(v: pa.Array, sizes: pa.Array) -> pa.Array:
        return lists_of(run_layers(matrix_of(v, sizes), layers)) if len(v) else pa.array([], pa.list_(pa.float64()))

    return once(run)


def tower_logit(tower: Tower, kernel: Sequence[float]):
    """Array in, one number out: last layer times a kernel without bias."""
    layers, k = tower.arrays(), np.asarray(kernel, float)

    @F.arrow_udf("double")
    def run(v: pa.Array, sizes: pa.Array) -> pa.Array:
        return pa.array(run_layers(matrix_of(v, sizes), layers) @ k if len(v) else np.zeros(0))

    return once(run)


def task_scores(shared: Tower | None, towers: Sequence[Tower], kernels: Sequence[Sequence[float]], names: Sequence[str]):
    """Array in, one struct of task logits out; a shared bottom runs once."""
    bottom = shared.arrays() if shared else []
    heads = [(t.arrays(), np.asarray(k, float)) for t, k in zip(towers, kernels)]
    fields = list(names)

    @F.arrow_udf(", ".join(f"{n} double" for n in fields))
    def run(v: pa.Array, sizes: pa.Array) -> pa.Array:
        if len(v) == 0:
            return pa.StructArray.from_arrays([pa.array([], pa.float64()) for _ in fields], fields)
        x = run_layers(matrix_of(v, sizes), bottom)
        return pa.StructArray.from_arrays([pa.array(run_layers(x, t) @ k) for t, k in heads], fields)

    return once(run)


def attention_scores(tower: Tower, kernel: Sequence[float], bias: float = 0.0):
    """``(query, keys)`` to one score per key from ``[q, k, q - k, q * k]``; null keys score 0."""
    layers, w = tower.arrays(), np.asarray(kernel, float)

    @F.arrow_udf("array<double>")
    def run(q: pa.Array, keys: pa.Array) -> pa.Array:
        if len(q) == 0:
            return pa.array([], pa.list_(pa.float64()))
        sizes = keys.value_lengths().to_numpy(zero_copy_only=False).astype(int)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        vectors = keys.flatten()
        there = np.asarray(vectors.is_valid())
        scores = np.zeros(len(vectors))
        if there.any():
            k = matrix_of(vectors.drop_null())
            rep = np.repeat(matrix_of(q), sizes, axis=0)[there]
            scores[there] = run_layers(np.concatenate([rep, k, rep - k, rep * k], axis=1), layers) @ w + bias
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores))

    return run


def history_logit(att: Tower, att_kernel, att_bias: float, tower: Tower, kernel, normalise: bool = False):
    """``(query, keys, valid, others)`` to one logit: attention scores, pooled history, tower.

    One Arrow call per batch; the history of a row is a run of its flat key list.
    """
    net, net_k = att.arrays(), np.asarray(att_kernel, float)
    layers, k_out = tower.arrays(), np.asarray(kernel, float)

    @F.arrow_udf("double")
    def run(q: pa.Array, keys: pa.Array, valid: pa.Array, others: pa.Array) -> pa.Array:
        if len(q) == 0:
            return pa.array([], pa.float64())
        query = matrix_of(q)
        pooled = np.zeros_like(query)
        vectors = keys.flatten()
        ok = np.asarray(vectors.is_valid()) & np.asarray(valid.flatten().fill_null(False)).astype(bool)
        if ok.any():
            sizes = keys.value_lengths().to_numpy(zero_copy_only=False).astype(int)
            row = np.repeat(np.arange(len(q)), sizes)[ok]
            k = matrix_of(vectors.filter(pa.array(ok)))
            r = query[row]
            w = run_layers(np.concatenate([r, k, r - k, r * k], axis=1), net) @ net_k + att_bias
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            if normalise:
                length = np.diff(np.r_[starts, len(row)])
                w = np.exp(w - np.repeat(np.maximum.reduceat(w, starts), length))
                w = w / np.repeat(np.add.reduceat(w, starts), length)
            pooled[row[starts]] = np.add.reduceat(w[:, None] * k, starts, axis=0)
        x = np.concatenate([matrix_of(others), pooled], axis=1)
        return pa.array(run_layers(x, layers) @ k_out)

    return run
