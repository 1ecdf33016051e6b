"""Row identity: a number written once with the row, carried through explode, join and gather.

Plans that take a row apart put it together again by this number, never by a user's key, so null and
equal keys and whole equal rows come back as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.scratch import pin


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a unique number, stored, and the number's column: a second reader or a repeated task sees the same."""
    row = free_name(df, "_row")
    return pin(df.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def put_back(rows: DataFrame, gathered: DataFrame, row: str) -> DataFrame:
    """``rows`` with the columns of ``gathered`` (one line a number), without the number."""
    return rows.join(gathered, row, "left").drop(row)
