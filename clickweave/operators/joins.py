"""Key lookups: broadcast only behind a size check, hot keys spread otherwise."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# fixed values: a lookup side is broadcast up to this many rows and bytes; keys above
# HOT_ROWS rows and above one HOT_SHARE-th of all rows are treated apart
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 << 20
HOT_ROWS = 100_000
HOT_SHARE = 1 << 14


def row_count_up_to(df: DataFrame, limit: int) -> int | None:
    """Exact row count, or None when there are more than ``limit`` rows."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None


def row_limit(row_bytes: int) -> int:
    """Rows of this width that may be broadcast."""
    return min(BROADCAST_ROWS, BROADCAST_BYTES // max(1, row_bytes))


def row_bytes(table: DataFrame, array_length: int = 64) -> int:
    """Width of a row from its schema; arrays of unknown length count as ``array_length`` numbers."""
    width = {"array": 8 * array_length, "string": 40, "struct": 8 * array_length, "map": 8 * array_length}
    return 16 + sum(width.get(t.split("<")[0], 8) for _, t in table.dtypes)


def broadcast_fields(sizes: dict[str, int], fields: list[str], limit: int) -> list[str]:
    """The fields whose tables are broadcast side by side: each within ``limit`` rows, all within four times that."""
    out, left = set(), 4 * limit
    for f in sorted(fields, key=lambda f: sizes.get(f, 0)):
        n = sizes.get(f, 0)
        if n <= min(limit, left):
            out.add(f)
            left -= n
    return [f for f in fields if f in out]


def fits_broadcast(table: DataFrame, limit: int | None = None) -> bool:
    """Counted, not guessed: true when rows times width stay below both bounds."""
    limit = row_limit(row_bytes(table)) if limit is None else limit
    return row_count_up_to(table, limit) is not None


def hot_keys(facts: DataFrame, on: list[str], least: int = HOT_ROWS) -> DataFrame:
    """Every key with more than ``least`` rows and more than ``1 / HOT_SHARE`` of all rows.

    The share bounds their number below ``HOT_SHARE``, so none is left out. Counts combine on the
    map side, so the pre-pass moves one row per key and task.
    """
    from clickweave.scratch import pin

    seen = Observation()
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("rows"))
    busy = pin(counts.where(F.col("_n") > least), "busy")
    floor = (seen.get["rows"] or 0) // HOT_SHARE
    return busy.where(F.col("_n") > floor).select(*on)


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    values: list[str],
    fits: bool | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Left join ``facts`` with ``table`` (unique on ``on``), adding ``values``.

    A side of checked size is broadcast and nothing is shuffled. A larger one is
    shuffled; rows with a hot key take their value from a broadcast of the hot
    rows alone (fewer than ``HOT_SHARE``); they and rows with a null key are dealt over all tasks.
    """
    table = table.select(*on, *values)
    if fits is None:
        fits = fits_broadcast(table, limit)
    if fits:
        return facts.join(F.broadcast(table), on, "left")
    return split_hot_join(facts, table, on, values)


def keyed_lookup(facts: DataFrame, key: Column, table: DataFrame, on: str, values: list[str], fits: bool) -> DataFrame:
    """``lookup_join`` on an expression of the facts; the column ``on`` of the table may stay behind."""
    if fits:
        return facts.join(F.broadcast(table), key == F.col(on), "left")
    return split_hot_join(facts.withColumn(on, key), table, [on], values)


def split_hot_join(
    facts: DataFrame, table: DataFrame, on: list[str], values: list[str], least: int = HOT_ROWS
) -> DataFrame:
    columns = facts.columns
    hot = hot_keys(facts, on, least)  # read from a table that is written already
    found = table.join(F.broadcast(hot), on, "left_semi")
    # a hot key that the table lacks is hot all the same: its values are null
    hot_rows = hot.join(found, on, "left").select(
        *on, *[F.col(v).alias(f"_hot_{v}") for v in values], F.lit(True).alias("_hot")
    )
    # rows that need nothing from the table are dealt by their number, all others have salt 0; the
    # table computes its 0, as a constant would leave the join's keys and the exchange
    free = F.xxhash64(F.monotonically_increasing_id())
    settled = F.col("_hot") | reduce(or_, [F.col(c).isNull() for c in on])
    marked = facts.join(F.broadcast(hot_rows), on, "left").withColumn("_salt", F.when(settled, free).otherwise(F.lit(0).cast("long")))
    zero = F.pmod(F.xxhash64(*on), F.lit(1).cast("long"))
    out = marked.join(table.withColumn("_salt", zero), [*on, "_salt"], "left")
    return out.select(
        *columns,
        *[F.when(F.col("_hot"), F.col(f"_hot_{v}")).otherwise(F.col(v)).alias(v) for v in values],
    )


def fields_join(df: DataFrame, keys: dict[str, Column], table: DataFrame, values: list[str], least: int = HOT_ROWS) -> tuple[DataFrame, list[str]]:
    """``df`` with a struct of ``values`` for each field (null: nothing found), from ``table(feature, _key, values)``.

    ``table`` is unique on feature and key, and not broadcast. Cells with a hot key (see ``hot_keys``) take their values
    from a small broadcast in the wide row. The others alone go to long form, meet the table in a shuffled join and come
    back under the row's number; rows without any of them are not shuffled. Returns the names of the structs, too.
    """
    from clickweave.operators.rows import free_name, numbered, put_back

    rows, row = numbered(df)
    on, fields = ["feature", "_key"], list(keys)
    names = [free_name(rows, f"_met{i}") for i in range(len(fields))]
    cells = rows.select(row, *[k.alias(f) for f, k in keys.items()]).unpivot([row], fields, "feature", "_key").where(F.col("_key").isNotNull())
    hot = hot_keys(cells, on, least)  # read from a table that is written already
    found = table.join(F.broadcast(hot), on, "left_semi").groupBy(*on).agg(F.first(F.struct(*values)).alias("_found"))
    # a hot key that the table lacks is hot all the same: its values are null
    hot = hot.join(found, on, "left").withColumn("_hot", F.lit(True))

    def with_hot(wide: DataFrame) -> DataFrame:
        for i, (f, k) in enumerate(keys.items()):
            one = hot.where(F.col("feature") == f).select(*[F.col(c).alias(f"{names[i]}{c}") for c in ("_key", "_found", "_hot")])
            wide = wide.join(F.broadcast(one), k == F.col(f"{names[i]}_key"), "left")
        return wide

    cold = [k.isNotNull() & F.col(f"{n}_hot").isNull() for n, k in zip(names, keys.values())]
    any_cold = reduce(or_, cold)
    met = cells.join(F.broadcast(hot.select(*on)), on, "left_anti").join(table.select(*on, *values), on)
    gathered = met.groupBy(row).agg(
        *[F.first(F.when(F.col("feature") == f, F.struct(*values)), ignorenulls=True).alias(n) for f, n in zip(fields, names)]
    )
    some = with_hot(put_back(with_hot(rows).where(any_cold).select(*rows.columns), gathered, row))
    some = some.select(*df.columns, *[F.coalesce(F.col(f"{n}_found"), F.col(n)).alias(n) for n in names])
    none = with_hot(rows).where(~any_cold).select(*df.columns, *[F.col(f"{n}_found").alias(n) for n in names])
    return none.unionByName(some), names


def missing_keys(facts: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Distinct keys of ``facts`` that ``table`` lacks; distinct first, so no hot key is shuffled."""
    return facts.select(*on).distinct().join(table.select(*on), on, "left_anti")


def null_safe_key(c: Column, text: str) -> Column:
    return F.coalesce(c.cast("string"), F.lit(text))
