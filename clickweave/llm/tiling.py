"""Benchmark decontamination by greedy string tiling.

Seeds (runs of ``MIN_MATCH`` tokens) of the benchmark items are looked up in every text; a document
and an item that share one are tiled: starting from a long search length, Karp-Rabin hashes of
unmarked windows find common runs, the longest are marked first, no token is marked twice, and the
search length shrinks to ``MIN_MATCH``. A document is contaminated by an item when the tiles cover
``PERCENT`` of the item's tokens, in whatever order they stand.

Tokens are runs of letters or digits, lower case, so punctuation does not hide a passage. Items go
to the tasks in slices of bounded size; each slice is held against all texts, so a large benchmark
means more passes and no larger broadcast.

Defined cases: null and empty texts or items match nothing; an item shorter than a seed must occur
as one run; rows with equal texts get equal results; null ids stay; an empty table on either side
gives no matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import column, strings, texts

MIN_MATCH, PERCENT = 5, 50
#: UTF-8 bytes of item texts that go to the tasks at once.
SLICE_BYTES = 16 << 20

_TOKEN = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def tokens_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def rolling(x: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows, modulo 2^64."""
    if len(x) < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(x) - width + 1, np.uint64)
    for i in range(width):
        out = out * _BASE + x[i : len(x) - width + 1 + i]
    return out


def _windows(x: np.ndarray, width: int) -> np.ndarray:
    """The same for long windows, from prefix hashes: H[i + width] - H[i] * base^width."""
    if width <= 16:
        return rolling(x, width)
    half = width // 2
    a, b = _windows(x, half), _windows(x, width - half)
    power = np.uint64(pow(int(_BASE), width - half, 1 << 64))
    n = len(x) - width + 1
    return a[:n] * power + b[half : half + n] if n > 0 else np.zeros(0, np.uint64)


def _free(marked: np.ndarray, width: int) -> np.ndarray:
    """Whether each window has no marked token."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return sums[width:] == sums[: len(sums) - width]


def _matches(p: np.ndarray, t: np.ndarray, mp: np.ndarray, mt: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(length, start in p, start in t) of unmarked common runs of at least ``width``, each as long as it goes."""
    if min(len(p), len(t)) < width:
        return []
    hp, ht = _windows(p, width), _windows(t, width)
    at_p, at_t = np.flatnonzero(_free(mp, width)), np.flatnonzero(_free(mt, width))
    at_t = at_t[np.isin(ht[at_t], hp[at_p])]
    places: dict[int, list[int]] = {}
    for i in at_p.tolist():
        places.setdefault(int(hp[i]), []).append(i)
    found, met = [], set()
    for j in at_t.tolist():
        for i in places.get(int(ht[j]), ()):
            if (i - 1, j - 1) in met:  # inside the run that began earlier
                met.add((i, j))
                continue
            n = 0
            while i + n < len(p) and j + n < len(t) and p[i + n] == t[j + n] and not mp[i + n] and not mt[j + n]:
                n += 1
            if n >= width:
                met.add((i, j))
                found.append((n, i, j))
    return found


def greedy_tiles(p: np.ndarray, t: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (length, start in p, start in t): non-overlapping in both, longest first."""
    mp, mt = np.zeros(len(p), bool), np.zeros(len(t), bool)
    tiles: list[tuple[int, int, int]] = []
    width = max(least, len(p) // 2)
    while True:
        found = _matches(p, t, mp, mt, width)
        longest = max((f[0] for f in found), default=0)
        if longest > 2 * width:
            width = longest  # start again at the longest run
            continue
        again = False
        for n, i, j in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if mp[i : i + n].any() or mt[j : j + n].any():
                again = True  # cut by a longer tile: what is left is found by the next search
                continue
            mp[i : i + n] = mt[j : j + n] = True
            tiles.append((n, i, j))
        if again:
            continue
        if width <= least:
            return tiles
        width = max(least, width // 2)


@dataclass
class Items:
    """A slice of the benchmark: item ids, their tokens as numbers, and the seed index."""

    ids: list
    tokens: list[np.ndarray]
    numbers: dict[str, int]
    widths: dict[int, tuple[np.ndarray, np.ndarray]]  # seed width -> sorted hashes, their items

    @classmethod
    def build(cls, rows: list[tuple[object, str | None]], least: int) -> Items:
        numbers: dict[str, int] = {}
        ids, tokens = [], []
        for item, text in rows:
            words = tokens_of(text or "")
            if words:
                ids.append(item)
                tokens.append(np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], np.uint64))
        seeds: dict[int, list[tuple[np.ndarray, int]]] = {}
        for k, t in enumerate(tokens):
            width = min(least, len(t))
            seeds.setdefault(width, []).append((np.unique(rolling(t, width)), k))
        widths = {}
        for width, found in seeds.items():
            h, k = np.concatenate([f for f, _ in found]), np.concatenate([np.full(len(f), k) for f, k in found])
            order = np.argsort(h, kind="stable")
            widths[width] = (h[order], k[order])
        return cls(ids, tokens, numbers, widths)

    def matches(self, text: str, least: int, percent: int) -> list[tuple[object, int, int, list]]:
        """(item, covered tokens, item's tokens, tiles) for the items that contaminate a text."""
        get = self.numbers.get
        words = tokens_of(text)
        t = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        near: set[int] = set()
        for width, (hashes, owner) in self.widths.items():
            h = np.unique(rolling(t, width))
            a, b = np.searchsorted(hashes, h), np.searchsorted(hashes, h, side="right")
            for x, y in zip(a[b > a], b[b > a]):
                near.update(owner[x:y].tolist())
        out = []
        for k in sorted(near):
            p = self.tokens[k]
            tiles = greedy_tiles(p, t, min(least, len(p)))
            covered = sum(n for n, _, _ in tiles)
            if covered * 100 >= percent * len(p):
                out.append((self.ids[k], covered, len(p), tiles))
        return out


def slices(benchmark: DataFrame, least: int = MIN_MATCH, item: str = "item_id") -> Iterator[Items]:
    """The benchmark in parts of about ``SLICE_BYTES``."""
    rows = benchmark.select(benchmark[item].alias("item"), F.coalesce(benchmark["text"], F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // SLICE_BYTES))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    for k in range(parts):
        yield Items.build([tuple(r) for r in rows.where(part == k).collect()], least)


def contamination(docs: DataFrame, benchmark: DataFrame, least: int = MIN_MATCH, percent: int = PERCENT) -> DataFrame:
    """One row for each document and item that contaminates it: doc_id, item, covered, item_tokens, coverage, tiles.

    A tile is (length, start token in the item, start token in the document).
    """
    schema = "doc_id long, item string, covered long, item_tokens long, coverage double, tiles array<array<long>>"
    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, text in zip(column(batch, "doc_id").to_pylist(), strings(batch)):
                for item, covered, n, tiles in items.matches(text, least, percent):
                    found.append((doc_id, None if item is None else str(item), covered, n, covered / n, [list(x) for x in tiles]))
            cols = list(zip(*found)) or [[] for _ in range(6)]
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.list_(pa.int64()))]
            names = ["doc_id", "item", "covered", "item_tokens", "coverage", "tiles"]
            yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, cols, types)})

    out = None
    for items in slices(benchmark, least):
        part = rows.mapInArrow(partial(run, items=items), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _holds_none(items: Items, least: int, percent: int):
    @F.pandas_udf("boolean")
    def test(column: pd.Series) -> pd.Series:
        return pd.Series([not items.matches(t or "", least, percent) for t in column], dtype=bool)

    return test


def is_clean(text: Column, benchmark: DataFrame, least: int = MIN_MATCH, percent: int = PERCENT) -> Column:
    """Condition that no item contaminates the text."""
    clean = F.lit(True)
    for items in slices(benchmark, least):
        clean = clean & _holds_none(items, least, percent)(text)
    return clean


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, all columns as they were."""
    return docs.where(is_clean(docs["text"], benchmark)).select(*docs.columns)
