"""Recipes compile to plain arithmetic in methods that the JVM translates, and score as their array forms do."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.functions.towers import Tower
from clickweave.operators import interactions as X
from clickweave.plans.recipes import Parts, score_recipe

FIELDS, DIM = list("abcdef"), 4
N = len(X.pairs(len(FIELDS)))


def numbers(*shape, seed=0):
    return np.random.default_rng(seed).normal(0, 0.3, shape).tolist()


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, *[0.1 * k + i for k in range(6)], *numbers(6, DIM, seed=i), 0.5 * i) for i in range(5)]
    columns = ["id int", *[f"{f}__w double" for f in FIELDS], *[f"{f}__v array<double>" for f in FIELDS], "n double"]
    return spark.createDataFrame(data, ", ".join(columns))


def parts(inputs, last):
    tower = Tower([(numbers(inputs, 3, seed=1), numbers(3, seed=2))]) if inputs else None
    wide = len(FIELDS) * DIM + 1
    return Parts(
        FIELDS, ["n"], DIM, [0.2], tower, numbers(last, seed=3),
        weights={
            "embedded": numbers(N, DIM, DIM, seed=4), "bilinear": numbers(N, DIM, DIM, seed=5), "squeezed": numbers(N, DIM, DIM, seed=6),
            "squeeze1": numbers(6, 2, seed=7), "squeeze2": numbers(2, 6, seed=8), "cross": [(numbers(wide, seed=9), numbers(wide, seed=10))] * 2,
        },
    )


def lambdas(df):
    """Array functions of the plan, without the one that keeps a projection apart."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [x for x in ("zip_with(", "aggregate(") if x in plan]


def largest_method(df):
    found = df._jdf.queryExecution().debug().codegenToSeq()
    return max([found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())], default=0)


def scores(df):
    return [r["score"] for r in df.orderBy("id").collect()]


def test_pairs_only(rows):
    p = parts(0, 0)
    got = score_recipe(rows, "deepfefm_only_pairs", p)
    assert not lambdas(got) and largest_method(got) < 8000
    want = []
    for r in rows.orderBy("id").collect():
        v = [np.array(r[f"{f}__v"]) for f in FIELDS]
        z = sum(v[i] @ (np.array(k) + np.array(k).T) @ v[j] for (i, j), k in zip(X.pairs(6), p.weights["embedded"]))
        want.append(1 / (1 + np.exp(-z)))
    assert scores(got) == pytest.approx(want)


def test_cross_only(rows):
    p = parts(0, len(FIELDS) * DIM + 1)
    got = score_recipe(rows, "dcn_cross_only", p)
    assert not lambdas(got) and largest_method(got) < 8000
    want = []
    for r in rows.orderBy("id").collect():
        x0 = x = np.concatenate([*[r[f"{f}__v"] for f in FIELDS], [r["n"]]])
        for w, b in p.weights["cross"]:
            x = x0 * (x @ np.array(w)) + b + x
        z = x @ np.array(p.tower_kernel) + sum(r[f"{f}__w"] for f in FIELDS) + 0.2 * r["n"]
        want.append(1 / (1 + np.exp(-z)))
    assert scores(got) == pytest.approx(want)


def test_squeezed_bilinear(rows):
    p = parts(2 * N * DIM + 1, 3)
    got = score_recipe(rows, "fibinet", p)
    assert not lambdas(got) and largest_method(got) < 8000
    squeezed = X.with_squeeze_weights(rows, [F.col(f"{f}__v") for f in FIELDS], p.weights["squeeze1"], p.weights["squeeze2"], DIM, "s")
    plain = rows.select("id", X.squeeze_weights([F.col(f"{f}__v") for f in FIELDS], p.weights["squeeze1"], p.weights["squeeze2"], DIM).alias("s"))
    for a, b in zip(squeezed.orderBy("id").collect(), plain.orderBy("id").collect()):
        assert a["s"] == pytest.approx(b["s"])
    want = []
    for r in plain.orderBy("id").join(rows, "id").orderBy("id").collect():
        v = [np.array(r[f"{f}__v"]) for f in FIELDS]
        s = [a * k for a, k in zip(v, r["s"])]
        both = [(u[i] @ np.array(k)) * u[j] for u, name in ((s, "squeezed"), (v, "bilinear")) for (i, j), k in zip(X.pairs(6), p.weights[name])]
        x = np.concatenate([*both, [r["n"]]])
        (w, b), = p.tower.layers
        z = np.maximum(x @ np.array(w) + b, 0) @ np.array(p.tower_kernel) + sum(r[f"{f}__w"] for f in FIELDS) + 0.2 * r["n"]
        want.append(1 / (1 + np.exp(-z)))
    assert scores(got) == pytest.approx(want)
