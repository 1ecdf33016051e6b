"""Batch scoring jobs: linear + second-order scoring and friends, SQL only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.vectors import in_small_methods
from clickweave.operators import interactions as X
from clickweave.operators.embedding import Lookup, attach


def vectors(fields: Sequence[str]) -> list[Column]:
    return [F.col(f"{f}__v") for f in fields]


def weights(fields: Sequence[str]) -> list[Column]:
    return [F.col(f"{f}__w") for f in fields]


def score_fm(
    df: DataFrame,
    fields: list[str],
    numbers: list[str],
    lookup: Lookup,
    dim: int,
    kernel: Sequence[float],
    bias: float = 0.0,
    task: str = "binary",
    out: str = "score",
    **how,
) -> DataFrame:
    """Linear + second-order score. Without fields it is a linear score of the numbers, without width one of first-order weights."""
    met = attach(df, fields, lookup, **how) if fields else df
    first = X.linear_logit(weights(fields), [F.col(c) for c in numbers], kernel)
    second = X.fm_second_order(vectors(fields), dim) if len(fields) > 1 and dim else None
    drop = [f"{f}__{x}" for f in fields for x in "wv"]
    return met.withColumn(out, X.predict_head(X.logit_sum(first, second), task, bias)).drop(*drop)


def predict_batches(df: DataFrame, key: Sequence[str], features: Sequence[str], model, batch_size: int = 256, out: str = "score") -> DataFrame:
    """``model(matrix) -> numbers`` over batches of rows, the row key carried along."""
    import numpy as np
    import pandas as pd

    names, keys, size = list(features), list(key), int(batch_size)

    def run(frames):
        for pdf in frames:
            scores = [
                np.asarray(model(pdf[names].iloc[i : i + size].to_numpy(float)), float).ravel()
                for i in range(0, len(pdf), size)
            ]
            yield pdf[keys].assign(**{out: np.concatenate(scores) if scores else pd.Series(dtype=float)})

    kinds = dict(df.dtypes)
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"`{out}` double"])
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in names]).mapInPandas(run, schema)


def user_model(make, return_type: str = "double", batch_size: int = 256):
    """Column function for any stored model: ``make()`` loads it once per worker."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql import types as T

    return predict_batch_udf(make, return_type=T.DataType.fromDDL(return_type), batch_size=batch_size)


def score_deep_fm(
    df: DataFrame, fields: list[str], numbers: list[str], lookup: Lookup, dim: int,
    kernel: Sequence[float], tower, tower_kernel: Sequence[float], bias: float = 0.0, task: str = "binary",
    out: str = "score", **how,
) -> DataFrame:
    """Linear + second-order + tower score: lookups once, one Arrow call per row batch."""
    from clickweave.functions.towers import tower_logit
    from clickweave.operators.embedding import deep_input

    met = attach(df, fields, lookup, **how)
    nums = [F.col(c) for c in numbers]
    wide = X.linear_logit(weights(fields), nums, kernel) + X.fm_second_order(vectors(fields), dim)
    # the JVM sum is taken before the Arrow call, so that vectors are not carried past it
    ready = met.select(*df.columns, wide.alias("_wide"), deep_input(vectors(fields), nums).alias("_in"))
    deep = tower_logit(tower, tower_kernel)(F.col("_in"))
    return ready.withColumn(out, X.predict_head(X.logit_sum(F.col("_wide"), deep), task, bias)).drop("_wide", "_in")


def score_attentional(df, fields, numbers, lookup: Lookup, kernel, w, b, h, projection, bias=0.0, task="binary", out="score", **how):
    met = attach(df, fields, lookup, **how)
    met = met.withColumn("_pairs", X.pair_products(vectors(fields), len(projection)))
    n = len(X.pairs(len(fields)))
    met = X.with_pair_attention(met, "_pairs", n, w, b, h, "_att")
    met = in_small_methods(met, _second=X.attentional_fm(F.col("_pairs"), F.col("_att"), projection, n))
    first = X.linear_logit(weights(fields), [F.col(c) for c in numbers], kernel)
    return met.select(*df.columns, X.predict_head(first + F.col("_second"), task, bias).alias(out))


def score_field_weighted(df, fields, numbers, lookup: Lookup, kernel, strength, dim: int | None = None, bias=0.0, task="binary", out="score", **how):
    met = attach(df, fields, lookup, **how)
    first = X.linear_logit(weights(fields), [F.col(c) for c in numbers], kernel)
    logit = first + X.field_weighted(vectors(fields), strength, dim)
    return met.select(*df.columns, X.predict_head(logit, task, bias).alias(out))


def score_regions(df, fields, lookup: Lookup, regions: int, task="binary", out="score", **how):
    """``table.vec`` holds region weights, then learner weights, one of each per region."""
    met = attach(df, fields, lookup, **how)
    at = lambda r: X.linear_logit([F.col(f"{f}__v").getItem(r) for f in fields])
    region = [at(r) for r in range(regions)]
    learner = [at(regions + r) for r in range(regions)]
    return met.select(*df.columns, X.region_mixture(region, learner, task).alias(out))


def score_tasks(df, fields, numbers, lookup: Lookup, shared, towers, kernels, names=("ctr", "cvr"), product: str | None = "ctcvr", **how):
    """One score per task; ``product`` names the product of the first two, if wanted."""
    from clickweave.functions.towers import task_scores
    from clickweave.operators.embedding import deep_input

    met = attach(df, fields, lookup, **how)
    ready = met.select(*df.columns, deep_input(vectors(fields), [F.col(c) for c in numbers]).alias("_in"))
    scored = ready.withColumn("_t", task_scores(shared, towers, kernels, names)(F.col("_in")))
    out = scored.select(*df.columns, *[X.predict_head(F.col(f"_t.{n}")).alias(n) for n in names])
    if product:
        out = out.withColumn(product, X.task_product(F.col(names[0]), F.col(names[1])))
    return out


def score_history(
    df: DataFrame, query: str, keys: str, valid: Column, others: list[Column], att, att_kernel, att_bias,
    tower, tower_kernel, normalise: bool = False, bias: float = 0.0, out: str = "score",
) -> DataFrame:
    """History attention score: attention net, pooled history and tower in one Arrow call."""
    from clickweave.functions.towers import history_logit

    net = history_logit(att, att_kernel, att_bias, tower, tower_kernel, normalise)
    logit = net(F.col(query), F.col(keys), valid, F.concat(*others))
    cur = df.withColumn("_z", logit)
    return cur.withColumn(out, X.predict_head(F.col("_z"), "binary", bias)).drop("_z")
