"""Column preparation: selection, filling, labels, scaling, dense fields."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.operators.encode import apply_vocabulary, vocabulary_sizes
from clickweave.spec import CategoryField, FeatureSpec, NumberField


def select_features(df: DataFrame, names: Sequence[str], label: str | Sequence[str] | None = None) -> DataFrame:
    labels = [label] if isinstance(label, str) else list(label or [])
    return df.select(*names, *labels)


def derive(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def columns_except(df: DataFrame, *excluded: Sequence[str]) -> list[str]:
    out = {c for names in excluded for c in names}
    return [c for c in df.columns if c not in out]


def fill_missing(
    df: DataFrame, categories: Sequence[str], numbers: Sequence[str], text: str = "-1", number: float = 0.0
) -> DataFrame:
    fills = {c: text for c in categories} | {c: number for c in numbers}
    return df.na.fill(fills)


def two_value_label(c: Column, values: dict[str, int]) -> Column:
    out = None
    for k, v in values.items():
        hit = c == F.lit(k)
        out = F.when(hit, F.lit(v)) if out is None else out.when(hit, F.lit(v))
    return out


def equals_label(c: Column, value) -> Column:
    return F.coalesce((c == F.lit(value)).cast("int"), F.lit(0))


def day_and_hour(c: Column) -> tuple[Column, Column]:
    """Digits ``yyMMddHH``: characters 5-6 are the day, the rest after 6 the hour."""
    text = c.cast("string")
    return F.substring(text, 5, 2), F.substring(text, 7, 10)


def fit_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Minimum and maximum of every column in one pass; one row reaches the driver."""
    aggs = [f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    row = df.agg(*aggs).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in columns}


def apply_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """To [0, 1]; a constant column gives 0."""

    def scaled(c: str) -> Column:
        lo, hi = ranges[c]
        if lo is None:
            return F.col(c).cast("double")
        width = hi - lo
        return (F.col(c) - F.lit(lo)) / F.lit(width if width != 0 else 1.0)

    return df.withColumns({c + suffix: scaled(c) for c in ranges})


def checked_vector(c: Column, size: int) -> Column:
    """A dense field of several numbers; another length is an error, not a null."""
    return F.when(F.size(c) == size, c).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {size} numbers, got "), F.size(c).cast("string")))
    )


def transform_numbers(df: DataFrame, functions: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """A user's column function per dense field (a pandas UDF is one, too)."""
    return df.withColumns({c: f(F.col(c)) for c, f in functions.items()})


def dense_values(numbers: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in numbers])


def row_vector(df: DataFrame, spec: FeatureSpec) -> Column:
    """All declared columns of a row as one array, in layout order."""
    kinds = dict(df.dtypes)
    parts = []
    for name, start, end in spec.layout():
        c = F.col(name)
        if kinds[name].startswith("array"):
            parts.append(checked_vector(F.transform(c, lambda x: x.cast("double")), end - start))
        else:
            parts.append(F.array(c.cast("double")))
    return F.concat(*parts)


def group_of(spec_groups: dict[str, list[str]], feature: Column) -> Column:
    """Group of a feature name as a constant map lookup."""
    return F.create_map(*[x for g, fs in spec_groups.items() for f in fs for x in (F.lit(f), F.lit(g))])[feature]


def long_form(df: DataFrame, key: Sequence[str], texts: Sequence[str], numbers: Sequence[str], sep: str = "=") -> DataFrame:
    """``key..., feature, x``: text fields give ``name=value`` and 1, numbers ``name`` and their value."""
    entries = F.array(
        *[F.struct(F.concat(F.lit(c + sep), F.col(c).cast("string")).alias("feature"), F.lit(1.0).alias("x")) for c in texts],
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in numbers],
    )
    return df.select(*key, F.inline(entries))


def encode_with_spec(
    df: DataFrame, vocab: DataFrame, categories: list[str], numbers: list[str], width: int
) -> tuple[DataFrame, FeatureSpec]:
    """Encoded table and the schema it now has (one extra id per field for unseen values)."""
    sizes = vocabulary_sizes(vocab)
    spec = FeatureSpec.of(
        [CategoryField(c, sizes[c] + 1, width) for c in categories] + [NumberField(c) for c in numbers]
    )
    return apply_vocabulary(df, vocab, categories, sizes=sizes), spec
