"""Column expressions over ``array<double>`` vectors; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(values) -> Column:
    """A (nested) list of numbers as one constant array; folded once at planning."""

    def sql(x) -> str:
        if isinstance(x, (list, tuple)):
            return "array(" + ",".join(sql(i) for i in x) + ")"
        return f"CAST('{float(x)!r}' AS DOUBLE)"

    if hasattr(values, "tolist"):
        values = values.tolist()
    return F.expr(sql(values))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``body``.

    A column named inside a lambda is evaluated again for every element; a lambda
    variable is not.
    """
    return F.transform(F.array(value), body).getItem(0)


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column, dim: int | None = None) -> Column:
    """With a known width the sum is written out, which compiles to plain arithmetic."""
    if dim is not None:
        return column_sum([x * y for x, y in zip(elements(a, dim), elements(b, dim))])
    return total(F.zip_with(a, b, lambda x, y: x * y))


def hadamard(a: Column, b: Column, dim: int | None = None) -> Column:
    if dim is not None:
        return F.array(*[x * y for x, y in zip(elements(a, dim), elements(b, dim))])
    return F.zip_with(a, b, lambda x, y: x * y)


def plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def scale(a: Column, s: Column, dim: int | None = None) -> Column:
    if dim is not None:
        return F.array(*[x * s for x in elements(a, dim)])
    return let(s, lambda k: F.transform(a, lambda x: x * k))


def matvec(rows: Column, v: Column) -> Column:
    """``M v`` for a constant matrix given as its rows."""
    return let(v, lambda u: F.transform(rows, lambda r: dot(r, u)))


def quadratic(a: Column, m, b: Column) -> Column:
    """``a' M b`` for a small constant matrix, written out."""
    x, y = elements(a, len(m)), elements(b, len(m[0]))
    rows = [column_sum([F.lit(float(k)) * v for k, v in zip(row, y)]) for row in m]
    return column_sum([u * r for u, r in zip(x, rows)])


def vector_sum(vectors: Sequence[Column]) -> Column:
    out = vectors[0]
    for v in vectors[1:]:
        out = plus(out, v)
    return out


def column_sum(columns: Sequence[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out + c
    return out


def relu(a: Column) -> Column:
    return F.transform(a, lambda x: F.greatest(x, F.lit(0.0)))


def softmax(a: Column) -> Column:
    """Shifted by the maximum, so large scores do not overflow."""
    def shifted(x: Column) -> Column:
        return let(F.array_max(x), lambda top: F.transform(x, lambda i: F.exp(i - top)))

    return let(a, lambda x: let(shifted(x), lambda e: let(total(e), lambda n: F.transform(e, lambda i: i / n))))


def elements(v: Column, width: int) -> list[Column]:
    return [v.getItem(i) for i in range(width)]


def in_small_methods(df, **cols):
    """``df`` with ``cols``, compiled as many small methods.

    A fused stage writes a projection as one method, and beyond 8,000 bytes the JVM only interprets it. A projection with
    a higher-order function is not fused: here the first column passes through one, all others are compiled as written.
    """
    first = df.columns[0]
    passed = F.transform(F.array(F.col(f"`{first}`")), lambda x: x).getItem(0)
    return df.withColumns({first: passed, **cols})


def with_columns(df, **cols):
    """Project step by step so that a shared vector is computed once."""
    for name, c in cols.items():
        df = df.withColumn(name, c)
    return df
