"""Quality classifier learned from trusted positives and unlabelled text.

Risk: pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)]) with logistic loss, the non-negative unbiased
estimate; where the second part of a batch falls below zero, its gradient is followed upwards, so
the model cannot fit positives by pushing that part under what any negative class could give. pi, the
share of good text among the unlabelled, is estimated: a first model separates positives from all
text, and for every threshold the share of all text above it is at least pi times the share of
positives above it, so the smallest quotient (with a margin for few rows) bounds pi.

Features come from the text alone: measures of its form and hashed word shapes. They are written once;
every training round is one pass over those of all texts: a task takes gradient steps batch by batch,
and the tasks' weights are averaged by Spark. Only positives are sampled, to at most ``MAX_POSITIVES``.

Defined cases: null and empty texts have the features of an empty text and a score; a document with
both labels is not trusted; repeated ids and rows are scored row by row, null ids have the remainder of
an empty id; an empty table gives an empty result, and without positives every score is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import column, remainder, strings, texts
from clickweave.scratch import pin

FOLDS, HELD = 4, 2
#: Bound on labelled rows that training uses, chosen by hash of the id.
MAX_POSITIVES = 8000
SHAPES, DENSE = 256, 18
WIDTH = SHAPES + DENSE + 1
ROUNDS, STEPS, BATCH, RATE, DECAY = 2, 60, 512, 0.03, 1e-4
THRESHOLD = 0.7
BINS = 400

_LETTERS = re.compile(r"[^\W\d_]+")
_SMALL = str.maketrans({c: "a" for c in "abcdefghijklmnopqrstuvwxyz"} | {c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: "0" for c in "123456789"})
_RUN = re.compile(r"(.)\1+")
_shapes: dict[str, int] = {}


def _shape(word: str) -> int:
    """Bucket of a word's form: letters by case, digits, and all other characters as they are, runs cut to one."""
    found = _shapes.get(word)
    if found is None:
        if len(_shapes) >= 200_000:
            _shapes.clear()
        form = "".join(c if c < "\x80" else ("A" if c.isupper() else "a" if c.isalpha() else c) for c in word.translate(_SMALL))
        found = _shapes[word] = xxhash.xxh3_64_intdigest(_RUN.sub(r"\1", form).encode()) % SHAPES
    return found


def features(text: str) -> np.ndarray:
    """Form of a text: shares lie in 0..1, lengths are logarithms; then square-rooted shares of word shapes."""
    out = np.zeros(WIDTH, np.float32)
    out[-1] = 1.0
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return out
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, _LETTERS.findall(text)))
    solid = sum(map(len, words))
    pairs = list(zip(words, words[1:]))
    count = text.count
    symbols = sum(map(count, "#*$%&|<>"))
    marks = sum(map(count, ".,;:?"))
    upper = sum(map(count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = sum(map(count, "0123456789"))
    fours = [hash(x) for x in zip(words, words[1:], words[2:], words[3:])]
    out[:DENSE] = [
        np.log1p(n) / 10, np.log1p(chars) / 12, solid / n / 20, letters / max(1, solid),
        min(1.0, symbols / n), min(1.0, count("!") / n), min(1.0, marks / n), upper / max(1, solid),
        digits / max(1, solid), len(set(words)) / n, sum(a == b for a, b in pairs) / max(1, len(pairs)),
        1 - len(set(fours)) / max(1, len(fours)) if fours else 0.0, 1 - len(set(lines)) / max(1, len(lines)),
        len(lines) / n, min(1.0, count("http") / n * 5), max(map(len, words)) / (40 + max(map(len, words))),
        float(n < 5), min(1.0, count("|") / n),
    ]
    shares = np.bincount([_shape(w) for w in words], minlength=SHAPES) / n
    out[DENSE:-1] = np.sqrt(shares)
    return out


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id and f (16-bit floats as bytes) of every row, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = [features(t).astype("<f2").tobytes() for t in strings(batch)]
            yield pa.RecordBatch.from_pydict({"doc_id": column(batch, "doc_id").cast(pa.int64()), "f": pa.array(f, pa.binary())})

    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return pin(rows.mapInArrow(run, "doc_id long, f binary"), "features")


def _matrix(f: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(f.to_pylist()), "<f2").reshape(-1, WIDTH).astype(np.float32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk_gradient(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float | None) -> np.ndarray:
    """Gradient for one batch of positives and unlabelled rows; without a prior: positives against all text."""
    sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
    up = -((1 - sp) @ p) / len(p)  # of E_p[l(g)]
    u_down = su @ u / len(u)  # of E_u[l(-g)]
    if prior is None:
        return 0.5 * (up + u_down)
    p_down = sp @ p / len(p)
    negative = np.mean(-np.log(1 - su + 1e-7)) - prior * np.mean(-np.log(1 - sp + 1e-7))
    rest = u_down - prior * p_down
    return prior * up + rest if negative >= 0 else -rest


def local_steps(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float | None, seed: int) -> np.ndarray:
    """Adam steps on one Arrow batch of unlabelled rows."""
    rng = np.random.default_rng(seed)
    w = w.astype(np.float64)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, STEPS + 1):
        ub = u[rng.integers(0, len(u), min(BATCH, len(u)))]
        pb = p[rng.integers(0, len(p), min(BATCH, len(p)))]
        g = risk_gradient(w, pb, ub, prior) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return w


def _round(unlabelled: DataFrame, w: np.ndarray, positives: np.ndarray, prior: float | None) -> np.ndarray:
    """One pass over all unlabelled rows; the weights of the tasks, averaged by their rows."""
    sent = unlabelled.sparkSession.sparkContext.broadcast(positives)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows, total = w, 0, np.zeros(WIDTH)
        for k, batch in enumerate(batches):
            u = _matrix(batch.column(0))
            if len(u):
                own = local_steps(own, sent.value, u, prior, k)
                rows, total = rows + len(u), total + own * len(u)
        if rows:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(WIDTH), pa.int32()), "w": pa.array(total), "n": pa.array(np.full(WIDTH, float(rows)))})

    parts = unlabelled.select("f").mapInArrow(run, "i int, w double, n double")
    found = parts.groupBy("i").agg((F.sum("w") / F.sum("n")).alias("w")).collect()
    out = w.copy()
    for r in found:
        out[r["i"]] = r["w"]
    sent.unpersist()
    return out


def _scores(f: pa.Array, w: np.ndarray) -> np.ndarray:
    return _sigmoid(_matrix(f) @ w)


def estimated_prior(unlabelled: DataFrame, w: np.ndarray, positives: np.ndarray) -> float:
    """Smallest quotient of the shares above a threshold, over thresholds that a tenth of the positives pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BINS, np.int64)
        for batch in batches:
            counts += np.bincount((_scores(batch.column(0), w) * (BINS - 1)).astype(int), minlength=BINS)
        yield pa.RecordBatch.from_pydict({"bin": pa.array(np.arange(BINS), pa.int32()), "n": pa.array(counts)})

    found = unlabelled.select("f").mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    u = np.zeros(BINS)
    for r in found:
        u[r["bin"]] = r["n"]
    p = np.bincount((_sigmoid(positives @ w) * (BINS - 1)).astype(int), minlength=BINS)
    nu, np_ = max(1.0, u.sum()), max(1, p.sum())
    above_u, above_p = np.cumsum(u[::-1]) / nu, np.cumsum(p[::-1]) / np_
    margin = 1 / np.sqrt(nu) + 1 / np.sqrt(np_)
    able = above_p >= 0.1
    quotient = (above_u[able] + margin * np.sqrt(above_u[able])) / above_p[able]
    return float(np.clip(quotient.min(), 0.02, 0.98))


def trusted_positives(features_: DataFrame, labels: DataFrame, most: int = MAX_POSITIVES) -> np.ndarray:
    """Features of at most ``most`` rows labelled good (never bad), outside the held-out remainder."""
    good = labels.where(remainder(F.col("doc_id"), FOLDS) != HELD).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = good.agg(F.min("quality").alias("q")).where((F.col("q") == 1) & F.col("doc_id").isNotNull())
    ids = pin(good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id"), "trusted")
    rows = features_.join(F.broadcast(ids), "doc_id", "left_semi").dropDuplicates(["doc_id", "f"])
    found = rows.orderBy("doc_id", "f").limit(most).select("f").toArrow()
    return _matrix(found["f"].combine_chunks()) if found.num_rows else np.zeros((0, WIDTH), np.float32)


def fit(features_: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """(weights, estimated prior)."""
    w = np.zeros(WIDTH)
    positives = trusted_positives(features_, labels)
    unlabelled = features_.where(remainder(F.col("doc_id"), FOLDS) != HELD)
    if not len(positives) or unlabelled.isEmpty():
        return w, 0.5
    first = _round(unlabelled, w, positives, None)
    prior = estimated_prior(unlabelled, first, positives)
    for _ in range(ROUNDS):
        w = _round(unlabelled, w, positives, prior)
    return w, prior


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    table = feature_table(docs)
    w, _ = fit(table, labels)

    def run(batches: Iterator[pa.RecordBatch], w: np.ndarray) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _scores(column(batch, "f"), w) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_pydict({"doc_id": column(batch, "doc_id"), "score": pa.array(s.astype(np.float64))})

    scored = table.mapInArrow(partial(run, w=w), "doc_id long, score double")
    held = remainder(F.col("doc_id"), FOLDS) == HELD
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
