"""Fill-in-middle rearrangement of whole texts, cut through a learned rank index.

A text's units (code points, words or lines, matched left to right) have boundaries: the byte offset
before each unit and the end of the text. The index over them is piecewise linear: from the first
boundary on, a segment takes in boundaries for as long as one line through its start stays within
``error`` bytes of all of them (the cone of allowed slopes narrows until it is empty), then the next one
starts. What a line misses is stored as one signed byte a boundary. A cut at rank r finds its segment by
its first rank, predicts the offset from the line and corrects it by the stored residual, so every cut is
exact; a boundary costs a byte instead of the eight of a stored offset.

Cuts and form come from the id alone: h1 to h4 are the first four 8-digit groups of the hex sha256 of
``1:`` and the id in decimal. Prefix and middle end after the smaller and the larger of h1 % (n + 1) and
h2 % (n + 1) units.

Defined cases: a null or empty text has no unit and stays plain; a null id counts as empty decimal text
and stays null; texts that hold a sentinel stay plain, so that restoring is exact; equal rows give equal
rows; an empty table gives an empty result; other columns stay behind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from clickweave.llm.common import column, portions, texts, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Shares in a hundred: texts that are rearranged, and those of them in suffix-first order.
APPLIED, SUFFIX_FIRST = 90, 20
#: Bytes a line may miss a boundary by (a residual is one signed byte), and boundaries looked at first in a segment.
ERROR, FIRST_WINDOW = 100, 256

_UNITS = {"word": re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+"), "line": re.compile(rb"[^\n]*\n|[^\n]+")}


def boundaries(text: bytes, unit: str = "code_point") -> np.ndarray:
    """Byte offsets before each unit, and the text's length."""
    if unit == "code_point":
        starts = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    else:
        starts = np.fromiter((m.start() for m in _UNITS[unit].finditer(text)), np.int64)
    return np.append(starts, len(text)).astype(np.int64)


@dataclass
class RankIndex:
    """rank -> offset: segments (first rank, its offset, slope) and a residual for every rank."""

    first: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        if not 0 <= error < 127:
            raise ValueError("a residual is one signed byte")
        first, slope = [], []
        n, at = len(offsets), 0
        while at < n:
            end, line = _segment(offsets, at, error)
            first.append(at)
            slope.append(line)
            at = end
        starts = np.array(first, np.int64)
        index = cls(starts, offsets[starts], np.array(slope, np.float64), np.zeros(0, np.int64))
        index.residual = (offsets - index.predict(np.arange(n))).astype(np.int8)
        return index

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        of = np.searchsorted(self.first, ranks, side="right") - 1
        return self.offset[of] + np.rint(self.slope[of] * (ranks - self.first[of])).astype(np.int64)

    def find(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets: prediction and stored residual."""
        return self.predict(ranks) + self.residual[ranks]


def _segment(offsets: np.ndarray, at: int, error: int) -> tuple[int, float]:
    """(end, slope) of the longest segment from ``at`` on that some slope keeps within ``error``."""
    low, high, done, window = -np.inf, np.inf, at + 1, FIRST_WINDOW
    while done < len(offsets):
        part = slice(done, min(len(offsets), done + window))
        run = np.arange(part.start - at, part.stop - at, dtype=np.float64)
        rise = (offsets[part] - offsets[at]).astype(np.float64)
        lows = np.maximum.accumulate(np.maximum((rise - error) / run, low))
        highs = np.minimum.accumulate(np.minimum((rise + error) / run, high))
        wrong = lows > highs
        stop = int(np.argmax(wrong)) if wrong.any() else len(wrong)
        if stop:
            low, high = lows[stop - 1], highs[stop - 1]
        done += stop
        if stop < len(wrong):
            break
        window *= 2
    return done, 0.0 if np.isinf(low) else (low + high) / 2


def choices(doc_id: int | None) -> list[int]:
    """h1 to h4 of an id."""
    said = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(said[i : i + 8], 16) for i in range(0, 32, 8)]


def form_of(text: bytes, h: list[int]) -> str:
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= APPLIED:
        return "plain"
    return "spm" if h[3] % 100 < SUFFIX_FIRST else "psm"


def arranged(prefix: bytes, middle: bytes, suffix: bytes, form: str) -> bytes:
    if form == "psm":
        return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle


def restored(output: bytes, form: str) -> bytes:
    """The text that ``output`` was made from. No sentinel can arise where a cut meets one, so the first is the one."""
    if form == "plain":
        return output
    head, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, _, rest = output[len(head) :].partition(second)
    two, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


SCHEMA = (
    "doc_id long, n long, form string, prefix_units long, middle_units long, prefix_bytes long, middle_bytes long, "
    "n_segments int, output string"
)


def transformed(docs: DataFrame, unit: str = "code_point") -> DataFrame:
    """doc_id, units, form, cuts (in units and in bytes), segments of the index, and the rearranged text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = [_one(i, t, unit) for i, t in zip(column(batch, "doc_id").to_pylist(), utf8(batch))]
            cols = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.int32(), pa.string()]
    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return texts(plain).mapInArrow(run, SCHEMA)


def _one(doc_id: int | None, text: bytes, unit: str) -> tuple:
    h = choices(doc_id)
    form = form_of(text, h)
    offsets = boundaries(text, unit)
    n = len(offsets) - 1
    if form == "plain":
        return doc_id, n, form, None, None, None, None, 0, text.decode()
    index = RankIndex.fit(offsets)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    x, y = index.find(np.array([a, b])).tolist()
    out = arranged(text[:x], text[x:y], text[y:], form)
    return doc_id, n, form, a, b - a, x, y - x, len(index.first), out.decode()


def restored_texts(made: DataFrame) -> DataFrame:
    """``made`` (with ``output`` and ``form``) and the exact ``text`` it came from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "output"):
            found = [restored(o, f or "plain").decode() for o, f in zip(utf8(batch, "output"), column(batch, "form").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "text"])

    if "text" in {c.lower() for c in made.columns}:
        raise ValueError("text is added here")
    return made.mapInArrow(run, StructType([*made.schema.fields, StructField("text", StringType())]))
