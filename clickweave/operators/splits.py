"""Train/test splits, date windows and seeded order."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.operators.blocks import key_at

_FINE = 10_000


def hash_split(df: DataFrame, key: Sequence[str], test_share: float = 0.2, seed: int = 2018) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the row key: the same row always lands on the same side."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in key]), F.lit(_FINE))
    cut = round(_FINE * (1.0 - test_share))
    return df.where(bucket < cut), df.where(bucket >= cut)


def random_split(df: DataFrame, test_share: float = 0.2, seed: int = 2018) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([1.0 - test_share, test_share], seed)
    return train, test


def _literal(value, kind: str) -> Column:
    if isinstance(value, (datetime, date)):
        value = str(value)
    return F.lit(value).cast(kind)


def tail_flag(df: DataFrame, order: Sequence[str], head_rows: int) -> Column:
    """True for the first ``head_rows`` rows in ``order`` (a unique, non-null key).

    Only the order columns are range partitioned to find the key at the border;
    the rows themselves are filtered where they are, without a shuffle.
    """
    if head_rows <= 0:
        return F.lit(False)
    border = key_at(df, list(order), head_rows - 1)
    if border is None:
        return F.lit(True)
    kinds = dict(df.dtypes)
    limit = F.struct(*[_literal(v, kinds[c]).alias(c) for c, v in zip(order, border)])
    return F.struct(*order) <= limit


def ordered_split(
    df: DataFrame, order: Sequence[str], test_share: float = 0.2, out: str = "is_train"
) -> DataFrame:
    """First part for training, the tail for testing; ``int(n * (1 - share))`` rows in front."""
    n = df.count()
    return df.withColumn(out, tail_flag(df, order, int(n * (1.0 - test_share))))


def date_window(df: DataFrame, column: str, end: str, days: int = 7, form: str = "%Y%m%d") -> DataFrame:
    """Rows with ``end - days <= column <= end``; a plain comparison, so partitions are pruned."""
    last = datetime.strptime(end, form)
    first = (last - timedelta(days=days)).strftime(form)
    return df.where((F.col(column) >= F.lit(first)) & (F.col(column) <= F.lit(end)))


def shuffled(df: DataFrame, key: Sequence[str], seed: int = 2020) -> DataFrame:
    """Reproducible row order that depends on key and seed only."""
    return df.orderBy(F.xxhash64(F.lit(seed), *[F.col(c) for c in key]), *key)
