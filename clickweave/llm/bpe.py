"""Byte-pair encoding with a priority queue over a linked symbol list, and its decoding.

A word's symbols form a doubly linked list. The queue holds (rank, place) of pairs that merge;
the smallest is taken, dropped if one of its symbols has changed since (a stale entry), else
the right symbol is folded into the left one and the two new neighbour pairs are queued.
Decoding joins vocabulary strings with the separator the tokenizer file asks for.

Words repeat, so each Python worker keeps the results of the words it has met, up to a fixed
number of entries; a full store is emptied, which changes nothing but time.

Defined cases: a null or empty text has no ids and decodes to an empty text; equal rows give
equal rows; null ids stay; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickweave.llm.common import column, give_back, portions, strings, texts
from clickweave.llm.pieces import WordPieces, load

STORE = 400_000


def merge_word(symbols: list[int], ranks: dict[int, int], merged: list[int]) -> list[int]:
    """Ids of one word from its start symbols.

    ``ranks`` has the rank of a pair under ``left << 32 | right``, ``merged`` the new symbol of a rank.
    A queue entry is rank times word length plus place; the rank a place has now tells stale entries.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    rank_of = ranks.get
    now = [rank_of(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:])]
    queue = [r * n + i for i, r in enumerate(now) if r >= 0]
    if not queue:
        return symbols
    now.append(-1)
    ids = list(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heapify(queue)
    while queue:
        rank, i = divmod(heappop(queue), n)
        if now[i] != rank:
            continue  # stale
        j = right[i]
        new = ids[i] = merged[rank]
        ids[j] = now[j] = now[i] = -1
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            r = now[i] = rank_of(new << 32 | ids[k], -1)
            if r >= 0:
                heappush(queue, r * n + i)
        h = left[i]
        if h >= 0:
            r = now[h] = rank_of(ids[h] << 32 | new, -1)
            if r >= 0:
                heappush(queue, r * n + h)
    return [x for x in ids if x >= 0]


class _Words(dict):
    """word -> (ids as bytes, number of ids); filled on demand."""

    def __init__(self, pieces: WordPieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, word: str) -> tuple[bytes, int]:
        ids = merge_word(self.pieces.symbols(word), self.pieces.ranks, self.pieces.merged)
        if len(self) >= STORE:
            self.clear()
        out = self[word] = (pack(f"<{len(ids)}I", *ids), len(ids))
        return out


@lru_cache(maxsize=4)
def _store(path: str) -> _Words:
    return _Words(load(path))


def encode(text: str, path: str) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit integers."""
    pieces, store = load(path), _store(path)
    out = []
    for part, special in pieces.segments(text):
        if special is None:
            out += [store[w][0] for w in pieces.words(part)]
        else:
            out.append(np.array([special], "<u4").tobytes())
    return b"".join(out)


@lru_cache(maxsize=4)
def _decoder(path: str) -> list[bytes]:
    tokens = load(path).tokens
    return [tokens.get(i, "").encode() for i in range(max(tokens) + 1)]


def decode(ids: np.ndarray, path: str, separator: bytes = b" ") -> bytes:
    """UTF-8 of the decoded text: vocabulary strings in order.

    A file without a decoder, like this one's, sets its strings apart by a blank and keeps
    their end-of-word marks.
    """
    strings_of = _decoder(path)
    return separator.join([strings_of[i] for i in ids.tolist()])


def encoded(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded text, and the ids (array of int) if asked for."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows_of(batches)
        finally:  # a worker serves other jobs afterwards, and what it remembers would stay beside theirs
            _store(path).clear()
            give_back()

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            packed = [encode(t, path) for t in strings(batch)]
            ids = [np.frombuffer(p, "<u4") for p in packed]
            cols = {
                "doc_id": column(batch, "doc_id").cast(pa.int64()),
                "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                "decoded_sha256": pa.array([hashlib.sha256(decode(i, path)).hexdigest() for i in ids]),
            }
            if with_ids:
                ends = np.cumsum([0] + [len(i) for i in ids]).astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                cols["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_pydict(cols)

    return texts(docs).mapInArrow(run, schema + ", ids array<int>" * with_ids)


def decoded(encoded_docs: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with ``ids``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "ids").to_pylist()
            out = [decode(np.array(x or [], np.int64), path).decode() for x in lists]
            yield pa.RecordBatch.from_pydict({"doc_id": column(batch, "doc_id").cast(pa.int64()), "text": pa.array(out, pa.string())})

    return encoded_docs.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
