"""Token-id shards with a minimal perfect hash index for keyed access.

A shard is two files in a shared folder. ``*.bin`` holds nothing but ids, little-endian unsigned
integers of the width that the vocabulary needs, document after document. ``*.idx`` holds the
document ends and the key index: a minimal perfect hash (levels of bit sets in which only keys
without a collision settle, ranked by counted bits) numbers the distinct keys 0..n-1; under its
number a key has a 64-bit fingerprint, its first document and how many documents carry it. Keys
themselves are not stored; a lookup costs a few probes whatever the shard's size, and the
fingerprint turns strangers away.

Shards follow ascending document id: rows are range partitioned and sorted by Spark, a task
streams its rows into one shard, under a temporary name that is moved into place at the end, so
a repeated task replaces a shard by an equal one. The manifest (one row a shard) is a table.

Defined cases: a null or empty text has the end id alone; null ids sort first and are looked up
like any key; rows with one id are separate documents next to each other (their order among equal
ids is free), and a lookup gives all of them; an empty table has an empty manifest.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.common import column, portions, strings, texts
from clickweave.scratch import pin, scratch_path

#: Text bytes and documents that a shard is meant to hold.
SHARD_BYTES, SHARD_DOCS = 48 << 20, 200_000
#: Pre-tokens after which a worker starts a new store, the old one still being asked, and the longest it keeps; characters that the quick split covers.
STORE, LONGEST, LIMIT = 400_000, 40, 0x250
#: White space below that limit.
WHITE = frozenset([*range(9, 14), 32, 0x85, 0xA0])
END_ID = 0
NULL_KEY = np.uint64(0x9E3779B97F4A7C15)
MANIFEST = "shard int, n_docs long, n_tokens long, min_id long, max_id long, has_null boolean, name string"


# ---- minimal perfect hash --------------------------------------------------

def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over unsigned integers."""
    with np.errstate(over="ignore"):
        z = x + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Numbers distinct keys 0..n-1. ``levels``: sizes in bits; ``bits``: all levels as bytes."""

    GAMMA, MOST_LEVELS = 2, 40

    def __init__(self, levels: list[int], bits: np.ndarray, rest: np.ndarray):
        self.levels, self.bits, self.rest = levels, bits, rest
        self.starts = np.concatenate([[0], np.cumsum(levels)]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)  # ones before each place

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, bits = [], []
        left = keys
        while len(left) and len(levels) < cls.MOST_LEVELS:
            m = max(8, cls.GAMMA * len(left))
            at = (mix(left, len(levels) + 1) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(m)
            bits.append(alone)
            left = left[~alone[at]]
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        return cls(levels, flat, np.sort(left))

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; -1 where no level holds it (strangers may get a number as well)."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for i, m in enumerate(self.levels):
            if not len(open_):
                break
            at = (mix(keys[open_], i + 1) % np.uint64(m)).astype(np.int64) + self.starts[i]
            hit = self.bits[at]
            out[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit]
        if len(open_) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = self.ranks[-1] + at[hit]
        return out


def key_of(ids: list[int | None]) -> np.ndarray:
    """Document ids as hash keys; null has one of its own, a fixed bit pattern."""
    missing = np.array([i is None for i in ids], bool)
    plain = np.array([0 if i is None else i for i in ids], np.int64).view(np.uint64)
    return np.where(missing, NULL_KEY, mix(plain, 3)) if len(ids) else np.zeros(0, np.uint64)


# ---- files -----------------------------------------------------------------

def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _write(store: fs.FileSystem, path: str, chunks: Iterator[bytes]) -> None:
    """Whole file or none: written under another name, then moved."""
    temporary = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        for c in chunks:
            out.write(c)
    store.move(temporary, path)


def index_bytes(keys: np.ndarray, ends: np.ndarray, width: int) -> bytes:
    """keys: of all documents in order, equal ones adjacent; ends: ids up to and with each document."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    distinct = keys[first]
    table = PerfectHash.build(distinct)
    place = table.number(distinct)
    prints, starts, copies = (np.zeros(len(first), t) for t in ("<u8", "<u8", "<u8"))
    prints[place] = mix(distinct, 77)
    starts[place] = first
    copies[place] = np.diff(np.concatenate([first, [len(keys)]]))
    head = {"width": width, "levels": table.levels, "rest": len(table.rest), "keys": len(first), "docs": len(ends)}
    parts = [np.packbits(table.bits), table.rest.astype("<u8"), prints, starts, copies, ends.astype("<u8")]
    text = json.dumps(head).encode()
    return len(text).to_bytes(8, "little") + text + b"".join(p.tobytes() for p in parts)


class Shard:
    """One shard opened for reading; ``bin`` is read by ranges."""

    def __init__(self, folder: str, name: str):
        store, path = _store(folder)
        with store.open_input_stream(f"{path}/{name}.idx") as f:
            data = f.read()
        n = int.from_bytes(data[:8], "little")
        head = json.loads(data[8 : 8 + n])
        at = 8 + n
        total_bits = sum(head["levels"])

        def take(count: int, dtype: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype, count, at)
            at += out.nbytes
            return out

        bits = np.unpackbits(take(-(-total_bits // 8), "u1"), count=total_bits).astype(bool)
        self.hash = PerfectHash(head["levels"], bits, take(head["rest"], "<u8"))
        self.prints, self.starts, self.copies = (take(head["keys"], "<u8") for _ in range(3))
        self.ends = take(head["docs"], "<u8").astype(np.int64)
        self.width = head["width"]
        self.bin = store.open_input_file(f"{path}/{name}.bin")

    def find(self, keys: np.ndarray) -> list[range]:
        """The documents of each key, as numbers in the shard; empty for a stranger."""
        at = self.hash.number(keys)
        known = at >= 0
        known[known] = self.prints[at[known]] == mix(keys[known], 77)
        first, n = self.starts[np.where(known, at, 0)] if len(self.starts) else at, self.copies
        return [range(int(f), int(f) + int(n[a])) if k else range(0) for f, a, k in zip(first, at, known)]

    def span(self, doc: int) -> tuple[int, int]:
        """(first id, end) of a document within the shard."""
        return (int(self.ends[doc - 1]) if doc else 0), int(self.ends[doc])

    def ids(self, doc: int) -> np.ndarray:
        a, b = self.span(doc)
        raw = self.bin.read_at((b - a) * self.width, a * self.width)
        return np.frombuffer(raw, f"<u{self.width}")


# ---- encoding --------------------------------------------------------------

@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of whole texts as the library gives them, each distinct pre-token encoded once.

    A byte-level file splits a text by one fixed pattern before it merges, so a text's ids are those of its
    pre-tokens one after another; a worker remembers the pre-tokens it met last. Texts below U+0250 are split
    by a compiled pattern over explicit character classes, others by the library's own splitter; texts that
    hold a special string, and files of another kind, go to the library whole.
    """

    def __init__(self, path: str):
        self.library = _tokenizer(path)
        spec = json.loads(self.library.to_str())
        self.dtype = f"<u{width_of(path)}"
        self.special = [t["content"] for t in spec["added_tokens"]]
        pre = spec["pre_tokenizer"] or {}
        self.whole = spec["normalizer"] is not None or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space", True)
        self.store = _Store()

    def _split(self, text: str) -> list[str]:
        if not _OTHER.search(text):
            return _WORDS.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        store = self.store
        store.turn()
        get = store.__getitem__
        out: list[bytes] = []
        open_: list[tuple[int, list[str]]] = []
        whole: list[int] = []
        for i, text in enumerate(texts):
            out.append(b"")
            if self.whole or any(s in text for s in self.special):
                whole.append(i)
                continue
            words, n = self._split(text), len(store.new)
            packed = list(map(get, words))
            if len(store.new) == n and b"" not in packed:
                out[i] = b"".join(packed)
            else:
                open_.append((i, words))
        new = list(store.new)
        store.new.clear()
        for i, packed in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = packed
        store.update(zip(new, self._library(new)))
        for i, words in open_:
            out[i] = b"".join(map(get, words))
        for w in new:
            if len(w) > LONGEST:
                del store[w]
        return out


class _Store(dict):
    """Pre-token -> packed ids. Unknown ones are noted in ``new`` and stand as empty until they are encoded."""

    def __init__(self):
        super().__init__()
        self.earlier: dict[str, bytes] = {}
        self.new: dict[str, None] = {}

    def __missing__(self, word: str) -> bytes:
        one = self.earlier.get(word, b"")
        if not one:
            self.new[word] = None
        self[word] = one
        return one

    def turn(self) -> None:
        """A full store is asked once more for what is met again, then goes."""
        if len(self) >= STORE:
            self.earlier = dict(self)
            self.clear()


def _classes() -> tuple[re.Pattern, re.Pattern]:
    """The pre-token pattern of byte-level files over explicit classes, and a character it does not cover."""
    sets: dict[str, list[str]] = {"L": [], "N": [], "S": []}
    for i in range(LIMIT):
        c = chr(i)
        kind = "S" if i in WHITE else unicodedata.category(c)[0]
        if kind in "LN" or i in WHITE:
            sets[kind].append(re.escape(c))
    letter, number, space = ("".join(sets[k]) for k in "LNS")
    # fixed values: the file's pattern
    words = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    return re.compile(words), re.compile(f"[^\x00-{chr(LIMIT - 1)}]")


_WORDS, _OTHER = _classes()


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def width_of(path: str) -> int:
    """Bytes of an id: two where the vocabulary allows it."""
    return 2 if _tokenizer(path).get_vocab_size() <= 1 << 16 else 4


# ---- write and read --------------------------------------------------------

def write_shards(docs: DataFrame, path: str, folder: str | None = None, end_id: int = END_ID) -> tuple[DataFrame, str]:
    """Encodes every text and writes the shards; gives the manifest table and the folder."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "shards")
    store, base = _store(folder)
    store.create_dir(base)
    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    shards = max(1, -(-(size[1] or 0) // SHARD_BYTES), -(-size[0] // SHARD_DOCS))
    # the second key splits a run of equal ids that is too long for one shard
    dealt = rows.withColumn("_tie", F.rand(5)).repartitionByRange(int(shards), "doc_id", "_tie")
    ordered = dealt.sortWithinPartitions("doc_id", F.xxhash64("text")).select("doc_id", "text")
    width = width_of(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        name = f"shard-{number:06d}"
        task_store, task_base = _store(folder)
        end = np.array([end_id], f"<u{width}").tobytes()
        ids_seen: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        low = high = None
        nulls = False

        def payload() -> Iterator[bytes]:
            nonlocal low, high, nulls
            for batch in portions(batches):
                ids, text = column(batch, "doc_id").to_pylist(), strings(batch)
                plain = [i for i in ids if i is not None]
                if plain:
                    low, high = (plain[0] if low is None else low), plain[-1]
                nulls = nulls or len(plain) < len(ids)
                ids_seen.append(key_of(ids))
                found = _encoder(path).encode(text)
                lengths.append(np.array([len(x) // width + 1 for x in found], np.int64))
                yield end.join([*found, b""])

        _write(task_store, f"{task_base}/{name}.bin", payload())
        if not ids_seen:
            return
        ends = np.cumsum(np.concatenate(lengths)) if lengths else np.zeros(0, np.int64)
        keys = np.concatenate(ids_seen)
        _write(task_store, f"{task_base}/{name}.idx", iter([index_bytes(keys, ends, width)]))
        one = (number, len(keys), int(ends[-1]) if len(ends) else 0, low, high, nulls, name)
        yield pa.RecordBatch.from_pydict({f.name: pa.array([v], f.type) for f, v in zip(schema, one)}, schema=schema)

    schema = _arrow(spark, MANIFEST)
    return pin(ordered.mapInArrow(write, MANIFEST), "manifest"), folder


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


FOUND = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_by_key(keys: DataFrame, manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the distinct ``keys`` (column doc_id), read from the shards.

    doc_id, start (ids of all documents before it), n_tokens and the crc32 of its ids as 32-bit
    integers. The manifest, a row a shard, is read by the driver: its bounds route each key to the
    shards that may hold it.
    """
    spark = keys.sparkSession
    # the order of the shards is that of the documents, so tokens before a shard are a running sum
    rows = sorted((tuple(r) for r in manifest.collect() if r["n_docs"]), key=lambda r: r[0])
    starts, total = {}, 0
    for r in rows:
        starts[r[0]] = total
        total += r[2]
    names = {r[0]: r[6] for r in rows}
    bounded = [r for r in rows if r[3] is not None]
    low, high = (np.array([r[i] for r in bounded], np.int64) for i in (3, 4))
    numbers = np.array([r[0] for r in bounded], np.int64)
    with_null = [r[0] for r in rows if r[5]]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column(batch, "doc_id").cast(pa.int64())
            plain = np.array([i for i in ids.to_pylist() if i is not None], np.int64)
            a, b = np.searchsorted(high, plain), np.searchsorted(low, plain, side="right")
            n = np.maximum(b - a, 0)
            at = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out, shard = [pa.array(np.repeat(plain, n))], [numbers[at] if len(numbers) else at]
            if ids.null_count:
                out.append(pa.nulls(len(with_null), pa.int64()))
                shard.append(np.array(with_null, np.int64))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.concat_arrays(out), "shard": pa.array(np.concatenate(shard).astype(np.int32))}
            )

    def read(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["shard"].iloc[0])
        shard = Shard(folder, names[number])
        ids = [None if pd.isna(i) else int(i) for i in pdf["doc_id"].astype(object)]
        out = []
        for doc_id, docs in zip(ids, shard.find(key_of(ids))):
            for d in docs:
                a, b = shard.span(d)
                crc = zlib.crc32(shard.ids(d).astype("<u4").tobytes())
                out.append((doc_id, starts[number] + a, b - a, crc))
        names_ = ["doc_id", "start", "n_tokens", "ids_crc32"]
        return pd.DataFrame(out, columns=names_).astype({"doc_id": "Int64"})

    distinct = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    routed = distinct.mapInArrow(route, "doc_id long, shard int")
    routed = routed.select(F.col("doc_id").cast("string").alias("doc_id"), "shard")
    return routed.groupBy("shard").applyInPandas(read, FOUND)
