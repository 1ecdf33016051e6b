"""Hard negatives against a plain search over all pairs, and the bounds of the boxes."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, row int, v string"


def wanted(rows, anchor, n_pos=5, n_neg=3, lower=50, upper=95, scale=256):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by brute force."""
    width = max([len(v) for _, v, _ in rows if v is not None] or [0])
    use = []
    for i, v, label in rows:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((math.inf if i is None else i, [math.floor(scale * float(np.float32(x))) for x in v] + [0] * (width - len(v)), label))
    real = lambda i: None if i == math.inf else i
    out = []
    for a, (i, v, label) in enumerate(use):
        if i == math.inf or not anchor(i):
            continue
        scored = sorted([(-sum(x * y for x, y in zip(v, w)), j, m) for b, (j, w, m) in enumerate(use) if b != a])
        for ps, p, _ in [s for s in scored if s[2] == label][:n_pos]:
            fits = [s for s in scored if s[2] != label and lower * -ps <= 100 * -s[0] <= upper * -ps][:n_neg]
            out += [(i, real(p), k + 1, real(n), -ps, -ns) for k, (ns, n, _) in enumerate(fits)]
    return sorted(out, key=str)


def run(spark, rows, anchor=lambda i: i % 10 == 0, **more):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    found = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **more)
    return sorted((tuple(r) for r in found.collect()), key=str)


def unit(g, n):
    v = [g.gauss(0, 1) for _ in range(n)]
    s = math.sqrt(sum(x * x for x in v))
    return [x / s for x in v]


def test_equals_all_pairs(spark, monkeypatch):
    g = random.Random(1)
    hot = unit(g, 12)
    rows = [(i, hot if i % 3 == 0 else unit(g, 12), g.randrange(4)) for i in range(700)]
    for leaf, subtree, slab, group in ((128, 1 << 14, 1 << 17, 256), (4, 64, 100, 7)):
        for name, value in (("LEAF", leaf), ("SUBTREE", subtree), ("SLAB", slab), ("GROUP", group)):
            monkeypatch.setattr(negatives, name, value)
        assert run(spark, rows) == wanted(rows, lambda i: i % 10 == 0)
    monkeypatch.setattr(negatives, "BLOCK", 20)
    assert run(spark, rows) == wanted(rows, lambda i: i % 10 == 0)
    assert run(spark, rows, positives=2, negatives=6, lower=10, upper=100) == wanted(rows, lambda i: i % 10 == 0, 2, 6, 10, 100)


def test_defined_cases(spark):
    g = random.Random(2)
    rows = [(i, unit(g, 6), g.randrange(2)) for i in range(40)]
    rows += [(50, None, 1), (60, [0.5] * 6, None), (70, [float("nan")] + [0.1] * 5, 1), (80, [float("inf")] * 6, 0), (90, [None, 0.5], 1)]
    rows += [(100, [], 0), (110, [0.9, 0.1], 1), (None, [0.5] * 6, 0), (None, [0.4] * 6, 1), (10, rows[10][1], 0), (10, rows[10][1], 0)]
    rows += [(120, [0.0] * 6, 1), (130, [1e6, -1e6, 3.0, 4.0, 5.0, 6.0], 0)]
    assert run(spark, rows) == wanted(rows, lambda i: i % 10 == 0)
    assert run(spark, [(10, [1.0], 0)]) == [] and run(spark, [(10, [1.0], 0), (11, [1.0], 0)]) == []
    assert run(spark, []) == [] and run(spark, [(None, None, None)]) == []


@pytest.mark.parametrize("leaf", [3, 16])
def test_boxes_bound_every_row(monkeypatch, leaf):
    monkeypatch.setattr(negatives, "LEAF", leaf)
    m = np.round(np.random.default_rng(3).normal(0, 40, (500, 5)))
    leaves = list(negatives.tiled(m, np.arange(500), [2, 0, 4, 1], leaf))
    assert sorted(np.concatenate(leaves).tolist()) == list(range(500)) and max(map(len, leaves)) <= leaf
    ends = np.cumsum([len(x) for x in leaves])
    at = np.concatenate(leaves)
    low, high = negatives._boxes(m[at], ends)
    tree = negatives.Tree.__new__(negatives.Tree)
    tree.ends, tree.low, tree.high, tree.leaves, tree.root = ends, low, high, len(ends), len(low) - 1
    q = np.round(np.random.default_rng(4).normal(0, 40, (9, 5)))
    group = negatives.Group(q, np.arange(9), np.zeros(9), np.full((9, 1), -np.inf), np.full((9, 1), np.inf), 3, True)
    least, most = group.bounds(tree, np.arange(len(low)))

    def rows_below(box):
        return [i for c in tree.children(box) for i in rows_below(c)] if box >= tree.leaves else list(range(*tree.leaf(box).indices(500)))

    for box in range(len(low)):
        scores = q @ m[at[rows_below(box)]].T
        assert (scores >= least[:, box, None]).all() and (scores <= most[:, box, None]).all()
    assert len(rows_below(tree.root)) == 500


def test_search_prunes_far_boxes(monkeypatch):
    """Clustered rows: most leaves are never scored."""
    monkeypatch.setattr(negatives, "LEAF", 32)
    g = np.random.default_rng(5)
    centres = g.normal(0, 100, (40, 3))
    m = np.round(np.repeat(centres, 64, axis=0) + g.normal(0, 1, (2560, 3)))
    leaves = list(negatives.tiled(m, np.arange(len(m)), [0, 1, 2], 32))
    at, ends = np.concatenate(leaves), np.cumsum([len(x) for x in leaves])
    low, high = negatives._boxes(m[at], ends)
    tree = negatives.Tree.__new__(negatives.Tree)
    tree.m, tree.ids, tree.rows, tree.labels = m[at], at, at, np.zeros(len(at), np.int64)
    tree.ends, tree.low, tree.high, tree.leaves, tree.root = ends, low, high, len(ends), len(low) - 1
    group = negatives.Group(m[:1], np.array([0]), np.array([0]), np.full((1, 1), -np.inf), np.full((1, 1), np.inf), 5, True)
    scored = []
    plain = group._score
    monkeypatch.setattr(group, "_score", lambda t, part, who: (scored.append(part), plain(t, part, who)))
    group.search(tree)
    want = sorted((-int(m[0] @ m[j]), j) for j in range(1, len(m)))[:5]
    assert [(-int(s), int(i)) for s, i in zip(group.score, group.id)] == want
    assert len(scored) < tree.leaves / 4
