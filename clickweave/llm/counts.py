"""Token counts by a compiled transducer, composed over chunks of a text.

The transducer reads a word's bytes (the last one marked as such). Its state says, for each
place from which a longer token may still begin, the vocabulary-trie node reached from there,
the last token of the text before it, and how many tokens that text has, relative to the text
read so far. A byte's transition therefore fixes the new state and the change of the token
count, which annotates it. A token follows another in an encoding just when merging the two
strings together gives back the two; that test picks the one token that may end at each place.
Only states that texts reach are built, and each once in a worker.

Between words the machine is in its start state, so a blank synchronises it. A chunk's map is
thus short: what stands before its first blank, the count from there to its last blank, and
what stands behind. Maps compose associatively; the chunks of a document are composed by a
pairwise scan, and any cut of a text into chunks gives the same count.

Defined cases: a null or empty text has 0 tokens; equal rows give equal rows; null ids stay;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.bpe import merge_word
from clickweave.llm.common import portions, texts
from clickweave.llm.pieces import WordPieces, load

#: Characters of a chunk; entries that a worker's word, pair and state tables hold before they start anew (about
#: 100, 100 and 700 bytes each, 140 MB in all).
CHUNK = 1 << 15
STORE, STATES = 350_000, 100_000
ROOT = 0


class Transducer:
    """Deterministic transitions (state, symbol) -> (state, change of the count), made on demand."""

    def __init__(self, pieces: WordPieces):
        self.pieces = pieces
        self._build_trie()
        self._pairs: dict[int, bool] = {}  # under first << 32 | second
        self.words: dict[str, int] = {}
        self._reset()

    def _build_trie(self) -> None:
        """Vocabulary trie over start symbols; a node's token is the one that its merges give back."""
        p = self.pieces
        of_letter = {p.tokens[i]: i for i in p.inner}
        self.next: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.spelled: dict[int, list[int]] = {}
        merged_ids = set(p.inner) | set(p.last) | set(p.merged)
        for text, i in p.vocab.items():
            if i not in merged_ids:
                continue
            ends = bool(p.suffix) and text.endswith(p.suffix) and text != p.suffix
            letters = text[: -len(p.suffix)] if ends else text
            symbols = [of_letter[c] for c in letters]
            if ends:
                symbols[-1] = p.vocab[letters[-1] + p.suffix]
            if merge_word(symbols, p.ranks, p.merged) != [i]:
                continue  # no merge order reaches it
            node = ROOT
            for s in symbols:
                if s not in self.next[node]:
                    self.next[node][s] = len(self.next)
                    self.next.append({})
                    self.token.append(-1)
                node = self.next[node][s]
            self.token[node] = i
            self.spelled[i] = symbols

    def _reset(self) -> None:
        start = ((ROOT, -1, 0),)
        self.states = [start]
        self.number = {start: 0}
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def _follows(self, a: int, b: int) -> bool:
        """Whether token b may come right after token a."""
        if a < 0:
            return True
        known = self._pairs.get(a << 32 | b)
        if known is None:
            p = self.pieces
            if len(self._pairs) >= STORE:
                self._pairs.clear()
            known = merge_word(self.spelled[a] + self.spelled[b], p.ranks, p.merged) == [a, b]
            self._pairs[a << 32 | b] = known
        return known

    def _move(self, state: int, symbol: int) -> tuple[int, int]:
        reached, last, count = [], None, 0
        for node, before, so_far in self.states[state]:
            child = self.next[node].get(symbol)
            if child is None:
                continue
            reached.append((child, before, so_far))
            t = self.token[child]
            if last is None and t >= 0 and self._follows(before, t):
                last, count = t, so_far + 1
        new = tuple((n, b, c - count) for n, b, c in reached if self.next[n]) + ((ROOT, last, 0),)
        at = self.number.get(new)
        if at is None:
            at = self.number[new] = len(self.states)
            self.states.append(new)
            self.moves.append({})
        out = self.moves[state][symbol] = (at, count)
        return out

    def count_word(self, word: str) -> int:
        """Sum of the counts along the word's path."""
        known = self.words.get(word)
        if known is not None:
            return known
        if len(self.words) >= STORE:
            self.words.clear()
        if len(self.states) >= STATES:
            self._reset()
        state = total = 0
        moves = self.moves
        for s in self.pieces.symbols(word):
            step = moves[state].get(s)
            if step is None:
                step = self._move(state, s)
            state = step[0]
            total += step[1]
        self.words[word] = total
        return total

    def count(self, text: str) -> int:
        """Tokens of a text that starts and ends between words."""
        total = 0
        for part, special in self.pieces.segments(text):
            if special is None:
                known, slow = self.words.get, self.count_word
                for w in self.pieces.words(part):
                    n = known(w)
                    total += slow(w) if n is None else n
            else:
                total += 1
        return total


@lru_cache(maxsize=4)
def compiled(path: str) -> Transducer:
    return Transducer(load(path))


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to the machine: ``head`` joins what comes before it; with a blank inside, ``count``
    tokens lie between its first and last blank and ``tail`` is left open; without one all of it is head."""

    head: str
    closed: bool = False
    count: int = 0
    tail: str = ""


BLANKS = "\t\n\x0b\x0c\r "


def chunk_map(chunk: str, machine: Transducer) -> ChunkMap:
    first = next((i for i, c in enumerate(chunk) if c in BLANKS), -1)
    if first < 0:
        return ChunkMap(chunk)
    last = max(chunk.rfind(c) for c in BLANKS)
    return ChunkMap(chunk[:first], True, machine.count(chunk[first : last + 1]), chunk[last + 1 :])


def compose(a: ChunkMap, b: ChunkMap, machine: Transducer) -> ChunkMap:
    if not a.closed:
        return ChunkMap(a.head + b.head, b.closed, b.count, b.tail)
    if not b.closed:
        return ChunkMap(a.head, True, a.count, a.tail + b.head)
    return ChunkMap(a.head, True, a.count + machine.count(a.tail + b.head) + b.count, b.tail)


def scan(maps: list[ChunkMap], machine: Transducer) -> ChunkMap:
    """Pairwise composition: log2(n) rounds, in each of which all pairs are independent."""
    while len(maps) > 1:
        odd = maps[-1:] if len(maps) % 2 else []
        maps = [compose(a, b, machine) for a, b in zip(maps[::2], maps[1::2])] + odd
    return maps[0] if maps else ChunkMap("")


def total(whole: ChunkMap, machine: Transducer) -> int:
    return machine.count(whole.head) + whole.count + machine.count(whole.tail)


MAP = "doc_id long, row long, n_bytes long, chunks int, chunk int, head string, closed boolean, count long, tail string"


def token_counts(docs: DataFrame, path: str, chunk_chars: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every document.

    One row for each chunk holds its map. Documents of one chunk are done at that point; the maps
    of longer ones meet under a row number given in this plan and are composed there.
    """

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(path)
        for batch in portions(batches):
            rows = []
            for doc_id, text, row in zip(*[c.to_pylist() for c in batch.columns]):
                n = max(1, -(-len(text) // chunk_chars))
                size = len(text.encode())
                for k in range(n):
                    m = chunk_map(text[k * chunk_chars : (k + 1) * chunk_chars], machine)
                    if n == 1:
                        m = ChunkMap("", True, total(m, machine))
                    rows.append((doc_id, row, size, n, k, m.head, m.closed, m.count, m.tail))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=maps_schema)

    def compose_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(path)
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]  # one document's maps at a time
                ordered = sorted(r["maps"], key=lambda m: m["chunk"])
                parts = [ChunkMap(m["head"], m["closed"], m["count"], m["tail"]) for m in ordered]
                found.append({"doc_id": r["doc_id"], "n_bytes": r["n_bytes"], "n_tokens": total(scan(parts, machine), machine)})
            yield pa.RecordBatch.from_pylist(found, schema=out_schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    empty = docs.sparkSession.createDataFrame([], MAP)
    maps_schema = to_arrow_schema(empty.schema)
    names = maps_schema.names
    out = "doc_id long, n_bytes long, n_tokens long"
    out_schema = to_arrow_schema(docs.sparkSession.createDataFrame([], out).schema)
    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    found = rows.mapInArrow(maps, MAP)
    groups = found.groupBy("row")  # the rows of a group are the chunks of a single text
    packed = groups.agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_bytes").alias("n_bytes"),
        F.collect_list(F.struct("chunk", "head", "closed", "count", "tail")).alias("maps"),
    )
    return packed.select("doc_id", "n_bytes", "maps").mapInArrow(compose_all, out)
