"""Declared schema of a click model: three kinds of field and their layout."""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

DEFAULT_GROUP = "default_group"


def auto_width(vocabulary_size: int) -> int:
    """``6 * floor(V ** 0.25)``, exact for perfect fourth powers."""
    root = int(round(vocabulary_size**0.25))
    while root**4 > vocabulary_size:
        root -= 1
    while (root + 1) ** 4 <= vocabulary_size:
        root += 1
    return 6 * root


@dataclass(frozen=True)
class CategoryField:
    name: str
    vocabulary_size: int
    width: int | str = 4
    hashed: bool = False
    vocabulary_path: str | None = None
    dtype: str = "int"
    table: str | None = None
    group: str = DEFAULT_GROUP
    trainable: bool = True

    @property
    def embedding(self) -> str:
        return self.table or self.name

    @property
    def dim(self) -> int:
        return auto_width(self.vocabulary_size) if self.width == "auto" else int(self.width)

    @property
    def columns(self) -> list[tuple[str, int, str]]:
        return [(self.name, 1, self.dtype)]


@dataclass(frozen=True)
class SequenceField:
    item: CategoryField
    maxlen: int
    combiner: str = "mean"
    length_column: str | None = None
    weight_column: str | None = None
    weight_norm: bool = True

    @property
    def name(self) -> str:
        return self.item.name

    @property
    def embedding(self) -> str:
        return self.item.embedding

    @property
    def dim(self) -> int:
        return self.item.dim

    @property
    def group(self) -> str:
        return self.item.group

    @property
    def columns(self) -> list[tuple[str, int, str]]:
        out = [(self.name, self.maxlen, f"array<{self.item.dtype}>")]
        if self.weight_column:
            out.append((self.weight_column, self.maxlen, "array<double>"))
        if self.length_column:
            out.append((self.length_column, 1, "int"))
        return out


@dataclass(frozen=True)
class NumberField:
    name: str
    dimension: int = 1
    dtype: str = "double"
    transform: Callable[[Column], Column] | None = field(default=None, compare=False)

    @property
    def columns(self) -> list[tuple[str, int, str]]:
        return [(self.name, self.dimension, self.dtype if self.dimension == 1 else f"array<{self.dtype}>")]


Field = CategoryField | SequenceField | NumberField


@dataclass(frozen=True)
class FeatureSpec:
    fields: tuple[Field, ...]

    @staticmethod
    def of(fields: Iterable[Field]) -> "FeatureSpec":
        fields = tuple(fields)
        for f in fields:
            if not isinstance(f, (CategoryField, SequenceField, NumberField)):
                raise TypeError(f"not a feature field: {f!r}")
        return FeatureSpec(fields)

    @property
    def categories(self) -> list[CategoryField]:
        return [f for f in self.fields if isinstance(f, CategoryField)]

    @property
    def sequences(self) -> list[SequenceField]:
        return [f for f in self.fields if isinstance(f, SequenceField)]

    @property
    def numbers(self) -> list[NumberField]:
        return [f for f in self.fields if isinstance(f, NumberField)]

    def layout(self) -> list[tuple[str, int, int]]:
        """Ordered ``(column, start, end)``; a name used before is skipped."""
        out: list[tuple[str, int, int]] = []
        seen: set[str] = set()
        start = 0
        for f in self.fields:
            for name, width, _ in f.columns:
                if name in seen:
                    continue
                seen.add(name)
                out.append((name, start, start + width))
                start += width
        return out

    @property
    def names(self) -> list[str]:
        return [n for n, _, _ in self.layout()]

    def schema(self) -> T.StructType:
        kinds = {n: t for f in reversed(self.fields) for n, _, t in f.columns}
        return T.StructType([T.StructField(n, T.DataType.fromDDL(kinds[n])) for n in self.names])

    def deep_input_width(self, category: bool = True, number: bool = True, per_group: bool = False) -> int:
        """Length of the flattened vectors-then-numbers input of a dense tower."""
        vectors = [f.dim for f in self.fields if not isinstance(f, NumberField)]
        w = (len(vectors) if per_group else sum(vectors)) if category else 0
        return w + (sum(f.dimension for f in self.numbers) if number else 0)

    def groups(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for f in self.fields:
            if not isinstance(f, NumberField):
                out.setdefault(f.group, []).append(f.name)
        return out

    def check(self, df: DataFrame) -> None:
        """Raise if a declared column is missing or has another kind of type."""
        have = {f.name: f.dataType for f in df.schema.fields}
        for want in self.schema().fields:
            if want.name not in have:
                raise ValueError(f"column {want.name} is missing")
            got = have[want.name]
            same = type(got) is type(want.dataType)
            both_whole = isinstance(got, T.IntegralType) and isinstance(want.dataType, T.IntegralType)
            both_frac = isinstance(got, T.FractionalType) and isinstance(want.dataType, T.FractionalType)
            if not (same or both_whole or both_frac):
                raise TypeError(f"column {want.name} is {got.simpleString()}, declared {want.dataType.simpleString()}")
