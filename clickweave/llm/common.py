"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators between words in every contract of this folder: blank and 0x09-0x0D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a Python worker takes at once.
PORTION = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the named columns; other columns stay behind."""
    return docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"), *[docs[c] for c in more])


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key() -> list[Column]:
    """128 bits that stand for a text where whole texts must not be shuffled."""
    t = F.col("text")
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(7919), t).alias("k2")]


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes, without decoding; null becomes empty."""
    return [b or b"" for b in batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()]


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [s or "" for s in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def give_back() -> None:
    """Return freed memory to the system: a Python worker serves other jobs afterwards, and the C library would keep it for this one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cases A-Z alone and splits at blank and 0x09-0x0D, as ``bytes`` does both."""
    return text.lower().split()


def portions(batches: Iterator[pa.RecordBatch], name: str = "text", most: int = PORTION) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of a text column; a longer text is alone in its batch.

    Arrow batches are bounded by rows; what Python makes of their texts is bounded by this.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(column(batch, name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        after, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = int(after[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(after, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end
