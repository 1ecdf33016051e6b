"""Sentence pieces: offset-preserving encoding of whole texts, and decoding.

Normalising walks the text once: at each place the longest entry of the model's compiled character map
(a double-array trie with its replacements) is taken, or else one character; blanks are trimmed, doubled
ones dropped and all of them escaped as the model asks. Beside each normalised byte it records the source
byte where its entry began. Pieces come from merging neighbouring symbols by score, best first, leftmost of
equals, over a linked list with a queue that skips stale entries; characters without a piece become bytes.
A piece covers a range of normalised bytes, and the record projects that range to its span in the source.

No piece of usual vocabularies has a blank after another character, so a text falls apart before each run of
blanks, and around characters that stand in no longer piece; each distinct part of a batch is merged once, short
ones side by side as rows of a matrix. Where a vocabulary has such pieces the whole text is one part.

Defined cases: a null or empty text has no pieces and decodes to an empty text; equal rows give equal rows;
null ids stay; an empty table gives an empty result; other columns stay behind.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from clickweave.llm.common import column, portions, texts, utf8

MARK = "▁"
_MARK = MARK.encode()
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Length up to which parts are merged side by side.
LONGEST = 48

codecs.register_error("clickweave-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


# ---- model file --------------------------------------------------------------

def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message; messages, strings and fixed numbers stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """Pieces and settings of a model file."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    algorithm: int = 1
    byte_fallback: bool = False
    mark_last: bool = False
    unknown_text: str = " ⁇ "
    charmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True

    @classmethod
    def read(cls, data: bytes) -> Model:
        m = cls()
        for number, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                m.pieces.append((piece, score, kind))
            elif number == 2:
                own = dict(_fields(value))
                m.algorithm = own.get(3, 1)
                m.byte_fallback, m.mark_last = bool(own.get(35, 0)), bool(own.get(24, 0))
                m.unknown_text = own[44].decode() if 44 in own else m.unknown_text
            elif number == 3:
                own = dict(_fields(value))
                m.charmap = own.get(2, b"")
                m.dummy_prefix, m.trim, m.escape = (bool(own.get(n, 1)) for n in (3, 4, 5))
        if m.algorithm != 2:
            raise ValueError("only models that merge pairs are read here")
        return m


# ---- normalising -------------------------------------------------------------

class CharMap:
    """The compiled character map: a double-array trie over source bytes, whose values point at replacements.

    A unit of the array holds its label (low byte), whether a value follows (bit 8) and the offset of its
    children (bits 10 on, shifted by 8 more if bit 9 is set); a value's unit has the top bit set.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.targets = blob[4 + size :]
        #: bytes with which no entry begins
        self.never = np.array([self._step(self._root(), b) is None for b in range(256)]) if blob else np.ones(256, bool)

    def _root(self) -> int:
        return self._children(self.units[0])

    @staticmethod
    def _children(unit: int) -> int:
        return unit >> 10 << (8 if unit & 512 else 0)

    def _step(self, at: int, byte: int) -> tuple[int, int | None] | None:
        """(place of the children, place of the value or None) after one more byte; None: no such path."""
        at ^= byte
        unit = self.units[at] if at < len(self.units) else 0x80000000
        if unit & 0x800000FF != byte:
            return None
        below = at ^ self._children(unit)
        return below, (below if unit & 256 else None)

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest entry that the text has at ``start``."""
        at, best = self._root(), None
        for i in range(start, len(text)):
            step = self._step(at, text[i])
            if step is None:
                break
            at, value = step
            if value is not None:
                best = i + 1 - start, self.units[value] & 0x7FFFFFFF
        if best is None:
            return None
        return best[0], self.targets[best[1] : self.targets.index(b"\0", best[1])]


class MergeTable:
    """Merges many short parts side by side: parts of one length are rows of a matrix, and each row that has
    a pair to merge merges its best one a round, so the matrix gets one column narrower each time."""

    def __init__(self, id_of: dict[str, int], rank: dict[str, int]):
        letters = {ord(p): i for p, i in id_of.items() if len(p) == 1}
        self.base = max(id_of.values(), default=0) + 1
        narrow = np.int32 if self.base * self.base < 1 << 31 else np.int64
        self.letter = np.full(max(letters, default=0) + 2, -1, narrow)
        self.letter[list(letters)] = list(letters.values())
        self.none = len(id_of)
        self.sizes = np.zeros(self.base, np.int64)
        pairs = {}
        for p, i in id_of.items():
            self.sizes[i] = len(p.encode())
            for cut in range(1, len(p)):
                a, b = id_of.get(p[:cut]), id_of.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a * self.base + b] = rank[p], i
        # pairs of ids in order, and at the end one that no ids make
        self.keys = np.array([*sorted(pairs), self.base * self.base], narrow)
        self.ranks, self.made = np.array([*(pairs[k] for k in sorted(pairs)), (self.none, -1)], narrow).T.copy()

    def _find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs, and whether they are there."""
        pair = a * self.base + b
        at = np.searchsorted(self.keys, pair)
        return at, self.keys[at] == pair

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at, there = self._find(a, b)
        return np.where(there, self.ranks[at], self.none)

    def merge_all(self, parts: Iterable[str]) -> dict[str, bytes]:
        """Packed ids and sizes of the parts whose letters all have pieces; longer or other ones are left out."""
        by_length: dict[int, list[str]] = {}
        for p in parts:
            if len(p) <= LONGEST:
                by_length.setdefault(len(p), []).append(p)
        out: dict[str, bytes] = {}
        for n, own in by_length.items():
            code = np.frombuffer("".join(own).encode("utf-32-le"), "<u4").reshape(-1, n)
            ids = self.letter[np.minimum(code, len(self.letter) - 1)]
            whole = (ids >= 0).all(axis=1)
            self._merge(ids[whole], [p for p, w in zip(own, whole.tolist()) if w], out)
        return out

    def _merge(self, ids: np.ndarray, names: list[str], out: dict[str, bytes]) -> None:
        of = np.arange(len(names))
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        while len(of):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(of), np.int64)
            best = ranks[np.arange(len(of)), at] if ranks.shape[1] else np.full(len(of), self.none)
            ready = best == self.none
            if ready.any():
                both = np.empty((int(ready.sum()), 2 * ids.shape[1]), "<i4")
                both[:, ::2] = done = ids[ready]
                both[:, 1::2] = self.sizes[done]
                blob, width = both.tobytes(), 8 * ids.shape[1]
                out.update(zip([names[i] for i in of[ready].tolist()], [blob[k : k + width] for k in range(0, len(blob), width)]))
                ids, ranks, of, at = (x[~ready] for x in (ids, ranks, of, at))
            row, n = np.arange(len(of)), ids.shape[1] - 1
            if not len(of):
                break
            column_ = np.arange(n)
            made = self.made[self._find(ids[row, at], ids[row, at + 1])[0]]
            ids = np.take_along_axis(ids, column_ + (column_ > at[:, None]), axis=1)
            ids[row, at] = made
            ranks = np.take_along_axis(ranks, (c := column_[:-1]) + (c >= at[:, None]), axis=1)
            has = at < n - 1
            ranks[row[has], at[has]] = self._rank(ids[row[has], at[has]], ids[row[has], at[has] + 1])
            has = at > 0
            ranks[row[has], at[has] - 1] = self._rank(ids[row[has], at[has] - 1], ids[row[has], at[has]])


class Pieces:
    """A model made ready: normaliser, merges and decoder."""

    def __init__(self, data: bytes):
        m = self.model = Model.read(data)
        self.map = CharMap(m.charmap)
        if m.trim and b"  " in self.map.targets:
            raise ValueError("replacements with two blanks in a row")
        self.id_of = {p: i for i, (p, _, k) in enumerate(m.pieces) if k in (NORMAL, USER, UNUSED)}
        # pieces that merging can make, best score first; equal scores share a rank, so the leftmost goes first
        scores = sorted({-m.pieces[i][1] for i in self.id_of.values()})
        place = {s: r for r, s in enumerate(scores)}
        self.rank = {p: place[-m.pieces[i][1]] for p, i in self.id_of.items()}
        self.unused = {p for p, i in self.id_of.items() if m.pieces[i][2] == UNUSED}
        self.users = sorted((p for p, i in self.id_of.items() if m.pieces[i][2] == USER), key=len, reverse=True)
        self.user_at = re.compile("|".join(map(re.escape, self.users))) if self.users else None
        self.user_bytes = re.compile(b"|".join(re.escape(p.encode()) for p in self.users)) if self.users else None
        reserved = {p: i for i, (p, _, k) in enumerate(m.pieces) if k in (UNKNOWN, CONTROL, BYTE)}
        #: id and length in bytes of a symbol that may stay
        self.final = {p: (i, len(p.encode())) for p, i in (self.id_of | reserved).items()}
        self.unknown = next(i for i, (_, _, k) in enumerate(m.pieces) if k == UNKNOWN)
        self.of_byte = {int(p[3:-1], 16): i for i, (p, _, k) in enumerate(m.pieces) if k == BYTE}
        apart = not m.mark_last and not any(MARK in p.lstrip(MARK) for p in self.id_of)
        # characters that stand next to another one in some piece; any other character is a part of its own
        joining = "".join(sorted({c for p in self.id_of if len(p) > 1 for c in p if c != MARK}))
        own = f"[{re.escape(joining)}]" if joining else "(?!)"
        self.parts = re.compile(f"(?s){MARK}*{own}+|{MARK}+|." if apart else "(?s).+")
        self.table = None if self.users or self.unused else MergeTable(self.id_of, self.rank)
        said = {UNKNOWN: lambda p: m.unknown_text.encode(), CONTROL: lambda p: b"", BYTE: lambda p: bytes([int(p[3:-1], 16)])}
        self.text_of = [said.get(k, lambda p: p.replace(MARK, " ").encode())(p) for p, _, k in m.pieces]
        self.kind_of = [k for _, _, k in m.pieces]

    # -- text to normalised bytes and their record

    def _replaced(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Bytes after the character map, and for each the source place where its entry or character begins."""
        raw = np.frombuffer(text, np.uint8)
        place = np.arange(len(raw), dtype=np.int32)
        inside = (raw & 0xC0) == 0x80
        start = np.maximum.accumulate(np.where(inside, 0, place)).astype(np.int32)
        may = np.flatnonzero(~self.map.never[raw] & ~inside)
        kept = self._user_spans(text)
        if not len(may):
            return raw, start
        out, at, done = [], [], 0
        spans = iter(kept)
        span = next(spans, None)
        for i in may.tolist():
            while span and span[1] <= i:
                span = next(spans, None)
            if i < done or (span and span[0] <= i):
                continue
            found = self.map.longest(text, i)
            if found is None:
                continue
            size, said = found
            out += [raw[done:i], np.frombuffer(said, np.uint8)]
            at += [start[done:i], np.full(len(said), i, np.int32)]
            done = i + size
        return np.concatenate([*out, raw[done:]]), np.concatenate([*at, start[done:]])

    def _user_spans(self, text: bytes) -> list[tuple[int, int]]:
        """User-defined symbols in the raw text; the map leaves them alone."""
        return [m.span() for m in self.user_bytes.finditer(text)] if self.user_bytes else []

    def normalised(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the source offset of each of them and of the end."""
        m, end = self.model, len(text)
        out, at = self._replaced(text)
        blank = out == 32
        if m.trim:
            solid = np.flatnonzero(~blank)
            first = int(solid[0]) if len(solid) else len(out)
            out, at, blank = out[first:], at[first:], blank[first:]
            keep = ~(blank & np.append(False, blank[:-1])) if len(out) else blank
            out, at, blank = out[keep], at[keep], blank[keep]
        if not len(out):
            return b"", np.zeros(1, np.int32)
        if m.dummy_prefix and not m.mark_last:
            out, at, blank = np.append(np.uint8(32), out), np.append(at[0], at), np.append(True, blank)
        mark = _MARK if m.escape else b" "
        if m.escape and blank.any():
            times = np.where(blank, len(mark), 1)
            first = np.cumsum(times) - times
            out, at = np.repeat(out, times), np.repeat(at, times)
            for k, b in enumerate(mark):
                out[first[blank] + k] = b
        said = out.tobytes()
        if m.trim:  # marks of the text itself go like escaped blanks
            size = len(said)
            while said.endswith(mark, 0, size):
                size -= len(mark)
                end = int(at[size])
            said, at = said[:size], at[:size]
        if m.dummy_prefix and m.mark_last:
            said, at = said + mark, np.append(at, np.full(len(mark), end))
        return said, np.append(at, end).astype(np.int32)

    # -- normalised text to pieces

    def _symbols(self, part: str) -> tuple[list[str], set[int] | frozenset[int]]:
        """Start symbols, and the places of user-defined ones, which never merge."""
        if self.user_at is None:
            return list(part), frozenset()
        out, frozen, at = [], set(), 0
        for m in self.user_at.finditer(part):
            out += part[at : m.start()]
            frozen.add(len(out))
            out.append(m[0])
            at = m.end()
        return out + list(part[at:]), frozen

    def merge(self, part: str) -> list[str]:
        """Best-scored neighbours first, leftmost of equals; a queue entry is rank times length plus place."""
        symbols, frozen = self._symbols(part)
        n, rank_of = len(symbols), self.rank.get
        now = [rank_of(a + b, -1) for a, b in zip(symbols, symbols[1:])] + [-1]
        for i in frozen:
            now[i] = now[i - 1] = -1  # before the first symbol there is none, and none merges with what follows the last
        queue = [r * n + i for i, r in enumerate(now) if r >= 0]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        made_of: dict[str, tuple[str, str]] = {}
        heapify(queue)
        while queue:
            rank, i = divmod(heappop(queue), n)
            if now[i] != rank:
                continue  # stale
            j = right[i]
            whole = symbols[i] + symbols[j]
            if whole in self.unused:
                made_of[whole] = (symbols[i], symbols[j])
            symbols[i], symbols[j] = whole, ""
            now[i] = now[j] = -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if k not in frozen:
                    r = now[i] = rank_of(whole + symbols[k], -1)
                    if r >= 0:
                        heappush(queue, r * n + i)
            h = left[i]
            if h >= 0 and h not in frozen:
                r = now[h] = rank_of(symbols[h] + whole, -1)
                if r >= 0:
                    heappush(queue, r * n + h)
        out = [s for s in symbols if s]
        while made_of and any(s in made_of for s in out):  # pieces out of use fall back to what they were made of
            out = [x for s in out for x in made_of.get(s, (s,))]
        return out

    def _part(self, part: str) -> bytes:
        """Ids of a part, and after each the number of normalised bytes that it covers, packed."""
        out = []
        for s in self.merge(part):
            one = self.final.get(s) or (self.unknown, len(s.encode()))
            if one[0] == self.unknown and self.model.byte_fallback:
                for b in s.encode():
                    out += (self.of_byte[b], 0)
                out[-1] = one[1]  # the last byte stands for the character
            else:
                out += one
        return struct.pack(f"<{len(out)}i", *out)

    def encode_all(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text its ids, and the begin and end of each piece's span in the source's bytes."""
        normal = [self.normalised(t) for t in texts]
        parts = [self.parts.findall(said.decode()) for said, _ in normal]
        distinct = set().union(*parts)
        known = self.table.merge_all(distinct) if self.table else {}
        for part in distinct - known.keys():
            known[part] = self._part(part)
        packed = known.__getitem__
        return [self._spans(list(map(packed, own)), source) for own, (_, source) in zip(parts, normal)]

    def encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.encode_all([text])[0]

    def _spans(self, packed: list[bytes], source: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, sizes = np.frombuffer(b"".join(packed), "<i4").reshape(-1, 2).T
        ends = np.cumsum(sizes, dtype=np.int64)
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        if not self.model.byte_fallback and len(ids) > 1:  # a run of unknown pieces is one
            same = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
            first, last = np.concatenate([[True], ~same]), np.concatenate([~same, [True]])
            ids, begins, ends = ids[first], begins[first], ends[last]
        return ids, source[begins], source[ends]

    # -- and back

    def decode(self, ids: list[int]) -> str:
        """Pieces' texts in order, the blank put before the text taken off again; broken bytes become U+FFFD, each one."""
        out = [self.text_of[i] for i in ids]
        m = self.model
        if m.dummy_prefix or m.trim:
            for k, i in enumerate(ids):
                if self.kind_of[i] in (BYTE, UNKNOWN):
                    break
                if self.kind_of[i] == CONTROL:
                    continue
                had = out[k].startswith(b" ")
                out[k] = out[k].removeprefix(b" ")
                if out[k] or (had and not m.trim):
                    break
        return b"".join(out).decode("utf-8", "clickweave-each-byte")


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    """One copy in each Python worker."""
    with open(path, "rb") as f:
        return Pieces(f.read())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, and the begin and end of each id's span in the source's UTF-8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in portions(batches):
            found = pieces.encode_all(utf8(batch))
            lists = {name: _lists([f[k] for f in found]) for k, name in enumerate(("ids", "begins", "ends"))}
            yield pa.RecordBatch.from_pydict({"doc_id": column(batch, "doc_id"), **lists})

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return texts(rows).mapInArrow(run, "doc_id long, ids array<int>, begins array<int>, ends array<int>")


def digested(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids, of their spans and of the text they decode to, in one pass.

    The ids are digested in decimal with commas between them; the spans as little-endian 32-bit integers, begins first.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        decimal = list(map(str, range(len(pieces.text_of)))).__getitem__
        for batch in portions(batches):
            rows = []
            for found, begins, ends in pieces.encode_all(utf8(batch)):
                ids = found.tolist()
                said = ",".join(map(decimal, ids)).encode(), pieces.decode(ids).encode(), begins.tobytes() + ends.tobytes()
                rows.append((len(ids), *(sha256(x).hexdigest() for x in said)))
            cols = [pa.array(c, pa.string() if k else pa.int64()) for k, c in enumerate(list(zip(*rows)) or [[]] * 4)]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *cols], names=[f.split()[0] for f in schema.split(", ")])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return texts(rows).mapInArrow(run, schema)


def decoded(made: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """doc_id, ids, the columns ``keep`` and the decoded text; null ids give an empty text."""
    rows = made.select("doc_id", "ids", *(keep or []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = [pieces.decode(i.values.to_pylist() if i.is_valid else []) for i in column(part, "ids")]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], names=[*part.schema.names, "text"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("text", StringType())]))
