"""N-gram Jaccard join by PartEnum signatures, and the connected components of its links.

Documents with equal shingle sets form one class; everything below works on classes. Sizes are cut
into bands so that two sets that link lie in one band or in neighbouring ones. Each band instance
knows how many elements two linked sets can differ by, k. It partitions the domain of shingles (by
hash) into n1 parts of n2 cells with n1 > k / (k2 + 1), so that in some part at most k2 cells differ;
a set's signatures are, for each part, the contents of every choice of n2 - k2 of its cells. Two
linked sets therefore share a signature. Sets that share one are candidates and are verified.

A signature's sets are never paired all with all. Signatures with the same sets are compared once. First each
set meets one set only, the one that shares most signatures with others of its crowd (a star); what links is
merged, and signatures whose sets are connected are done. Then every set of an open signature meets the
signature's most frequent one, and that one is done with it. What is still open after some rounds is cut into
blocks of bounded size, and pairs of blocks are compared across components; where that is little work, it is done
without rounds before. Before two sets are compared element by element, their sizes and profiles (elements by cell
of their hash) must allow the similarity, and, where much would be sent, their sketches (a bit for each of more cells).

Defined cases: a null or empty text, or one without words, has an empty set and links with nothing;
fewer words than a shingle make one shingle; rows with equal texts are linked whatever their ids;
null ids count as larger than any id, and a component of null ids alone is null; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import column, portions, texts, utf8
from clickweave.operators.joins import row_limit
from clickweave.scratch import pin, release

SHINGLE, PERCENT = 4, 85
#: Partners in a share; sets of a block; star rounds before blocks; cells of a profile; nodes that a task connects at once; bits of the table
#: that preselects rows (a fixed size; it lets false ones pass, which joins remove); digests a task remembers; bytes hashed at once, and bytes
#: of texts whose sets and signatures a worker holds at once; elements of sets to send beyond which sketches are sent before them.
SHARE, BLOCK, STARS, PROFILE, STORE, TABLE_BITS = 256, 128, 3, 256, 400_000, 27
SEEN, WINDOW, PIECE, SCREEN = 200_000, 1 << 20, 1 << 19, 1 << 21

_U = np.uint64
_M1, _M2, _M3 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> _U(30))) * _M1
    z = (z ^ (z >> _U(27))) * _M2
    return z ^ (z >> _U(31))


def _salt(n: int) -> np.uint64:
    return _U(n * int(_M3) & (2**64 - 1))


#: A word's hash is a polynomial in one odd base over a random number for each byte; blanks (and the ends of texts) count nothing.
_BASE = 0x9E3779B97F4A7C15
_OF_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _M2)
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), 32]] = True
_OF_BYTE[_BLANK] = 0


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    up, down = (np.full(WINDOW + 1, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _window_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, hash) of the words of a window that starts and ends between words."""
    up, down = _powers()
    blank = _BLANK[raw]
    edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    first, end = edge[::2], edge[1::2]
    if len(raw) > WINDOW:  # one word longer than a window
        parts = [_window_words(raw[i : i + WINDOW])[1] for i in range(0, len(raw), WINDOW)]
        whole = np.array([xxhash.xxh3_64_intdigest(np.concatenate(parts).tobytes())], np.uint64)
        return first, whole
    sums = np.append(_U(0), np.cumsum(_OF_BYTE[raw] * up[: len(raw)]))
    return first, _mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64) * _M1)


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(first place, hash) of each word, A-Z lower-cased, without making the words; a bounded window at a time."""
    raw = np.frombuffer(text.lower(), np.uint8)
    at, found = 0, [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    while at < len(raw):
        end = min(len(raw), at + WINDOW)
        if end < len(raw):
            blanks = np.flatnonzero(_BLANK[raw[at:end]])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
            else:  # go on to the end of the word
                rest = next((i + int(b[0]) for i in range(end, len(raw), WINDOW) if len(b := np.flatnonzero(_BLANK[raw[i : i + WINDOW]]))), len(raw))
                end = rest
        first, h = _window_words(raw[at:end])
        found.append((first + at, h))
        at = end
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def shingle_sets(texts: list[bytes], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; all texts are hashed side by side."""
    first, h = word_hashes(b"\n".join(texts))
    after = np.cumsum([len(t) + 1 for t in texts])
    ends = np.searchsorted(first, after)
    sizes = np.diff(ends, prepend=0)
    width = np.repeat(np.minimum(sizes, n), sizes).astype(np.uint64)
    out, ahead = width.copy(), np.append(h, np.zeros(n, np.uint64))
    for i in range(n):
        out = np.where(width > i, _mix(out * _M3 + ahead[i : i + len(h)]), out)
    return [_distinct(out[e - s : e - min(s, n) + 1]) if s else out[:0] for s, e in zip(sizes.tolist(), ends.tolist())]


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])]


def shingle_set(text: bytes, n: int = SHINGLE) -> np.ndarray:
    return shingle_sets([text], n)[0]


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed integers."""
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


# ---- bands and signatures --------------------------------------------------

def most_partner(size: int, percent: int) -> int:
    return size * 100 // percent


def band_of(size: int, percent: int, starts: list[int]) -> int:
    """Number of the band with ``size``; ``starts`` (first sizes of the bands) grows as needed."""
    if not starts:
        starts.append(1)
    while most_partner(starts[-1], percent) < size:
        starts.append(most_partner(starts[-1], percent) + 1)
    return int(np.searchsorted(starts, size, side="right")) - 1


def instance(band: int, percent: int, starts: list[int]) -> tuple[int, int, int, int]:
    """(k, n1, n2, k2) for pairs whose smaller set lies in ``band``."""
    largest = most_partner(starts[band], percent)
    rest = 100 - percent
    k = rest * (largest + most_partner(largest, percent)) // (100 + percent)
    k2 = 1
    n1 = k // (k2 + 1) + 1
    return k, n1, (3 if k >= 40 else 4), k2


def _instances(most: int, percent: int) -> tuple[list[int], np.ndarray]:
    """First sizes of the bands up to that of size ``most``, and n1 and n2 of each (0 where only equal sets link)."""
    starts: list[int] = []
    last = band_of(max(1, most), percent, starts)
    found = [instance(b, percent, starts) for b in range(last + 1)]
    return starts, np.array([(n1, n2) if k else (0, 1) for k, n1, n2, _ in found], np.int64)


def signatures_of(sets: list[np.ndarray], percent: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """All signatures, of each set's own band's instance and of the one below, and the number of the set of each.

    Only one cell of a part is left out (k2 = 1), so a signature is its part's sum less one cell's.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts, shapes = _instances(int(sizes.max()), percent)
    own = np.searchsorted(starts, sizes, side="right") - 1
    of, values = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    salted = _mix(values + _salt(seed * 1_000_003 + 17))
    content = _mix(salted ^ _M1)
    sig, who = [], []
    for below in (0, 1):
        band = own - below
        n1, n2 = shapes[np.maximum(band, 0)].T
        cells = np.where((sizes > 0) & (band >= 0), n1 * n2, 0)
        first = np.cumsum(cells) - cells
        use = cells[of] > 0
        place = first[of[use]] + ((salted[use] >> _U(20)) % cells[of[use]].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(int(cells.sum()), np.uint64)
        np.add.at(sums, place, content[use])
        owner = np.repeat(np.arange(len(sets)), cells)
        sums = _mix(sums + (np.arange(len(sums)) - first[owner]).astype(np.uint64) * _M3)
        for width in np.unique(n2[cells > 0]).tolist():
            mine = n2[owner] == width
            part, by = sums[mine].reshape(-1, width), owner[mine][::width]
            base = (band[by] + 1).astype(np.uint64) * _U(0x1F123BB5) + _U(seed)
            left = part.sum(axis=1, dtype=np.uint64)[:, None] - part
            left = _mix(left + base[:, None] * _M3 + (np.arange(width, dtype=np.uint64) + _U(7)) * _M1)
            sig.append(left.ravel())
            who.append(np.repeat(by, width))
    return (np.concatenate(sig), np.concatenate(who)) if sig else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


# ---- passes over the texts -------------------------------------------------

def _digests(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, most=PIECE):
        found = [(len(s), *digest(s)) for s in shingle_sets(utf8(batch), n)]
        size, d1, d2 = (pa.array([f[k] for f in found], pa.int64()) for k in range(3))
        yield pa.RecordBatch.from_pydict({"doc_id": column(batch, "doc_id").cast(pa.int64()), "n_shingles": size, "d1": d1, "d2": d2})


def _new_sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[list[tuple[int, int]], list[np.ndarray]]]:
    """Digests and sets that a task has not just had; forgetting some only costs repeated rows."""
    seen: set[tuple[int, int]] = set()
    for batch in portions(batches, most=PIECE):
        found = {digest(s): s for s in shingle_sets(utf8(batch), n) if len(s)}
        fresh = [d for d in found if d not in seen]
        if len(seen) >= SEEN:
            seen.clear()
        seen.update(fresh)
        yield fresh, [found[d] for d in fresh]


def _signature_rows(batches: Iterator[pa.RecordBatch], n: int, percent: int, only, name: str = "sig") -> Iterator[pa.RecordBatch]:
    for digests, sets in _new_sets(batches, n):
        sig, who = signatures_of(sets, percent)
        if only is not None:
            kept = _in_table(sig.view(np.int64), only.value)
            sig, who = sig[kept], who[kept]
        d1 = np.array([d[0] for d in digests], np.int64)
        for i in range(0, len(sig), 100_000):
            part = slice(i, i + 100_000)
            yield pa.RecordBatch.from_pydict({"sig": pa.array(sig[part].view(np.int64)), "d1": pa.array(d1[who[part]])})


def _runs(sig: np.ndarray, d1: np.ndarray) -> tuple[np.ndarray, ...]:
    """(signature, smallest and largest digest, rows) of each run of rows sorted by signature."""
    at = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
    return sig[at], np.minimum.reduceat(d1, at), np.maximum.reduceat(d1, at), np.diff(np.append(at, len(sig)))


def _three(sig: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stand for runs: as many as there were, or three; both ends of a run are among them."""
    two, more = n > 1, n > 2
    return np.concatenate([sig, sig[two], sig[more]]), np.concatenate([a, b[two], a[more]])


def _fewer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same signatures with three rows each at most out of a bounded number of rows."""
    held: list[pa.RecordBatch] = []

    def gathered() -> Iterator[pa.RecordBatch]:
        sig, d1 = (np.concatenate([column(b, c).to_numpy() for b in held]) for c in ("sig", "d1"))
        held.clear()
        order = np.argsort(sig)
        sig, d1 = _three(*_runs(sig[order], d1[order]))
        for i in range(0, len(sig), 100_000):
            yield pa.RecordBatch.from_pydict({"sig": pa.array(sig[i : i + 100_000]), "d1": pa.array(d1[i : i + 100_000])})

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= STORE:
            yield from gathered()
    if held:
        yield from gathered()


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sig, a, b (smallest and largest digest) and n (rows, three for more) of signatures of several sets, from rows sorted by signature.

    Rows are read as a stream; what the last signature of a batch has had so far goes on with the next batch.
    """

    def several(sig: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        kept = a < b
        return pa.RecordBatch.from_pydict({k: pa.array(v[kept], pa.int64()) for k, v in zip(("sig", "a", "b", "n"), (sig, a, b, np.minimum(n, 3)))})

    sig = d1 = np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows:
            runs = _runs(*(np.concatenate([x, column(batch, c).to_numpy()]) for x, c in ((sig, "sig"), (d1, "d1"))))
            yield several(*(r[:-1] for r in runs))
            sig, d1 = _three(*(r[-1:] for r in runs))
    if len(sig):
        yield several(*_runs(sig, d1))


def profile_of(s: np.ndarray) -> bytes:
    """Elements by cell of their hash, one byte a cell; a full byte stays, which only brings profiles nearer."""
    return np.minimum(np.bincount((s >> _U(56)).astype(np.int64), minlength=PROFILE), 255).astype(np.uint8).tobytes()


def sketch_of(s: np.ndarray) -> bytes:
    """For each of two to four cells an element, whether it has an odd number of elements."""
    cells = 1 << max(8, (2 * len(s) - 1).bit_length())
    odd = np.bincount((s & _U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _set_rows(batches: Iterator[pa.RecordBatch], n: int, only) -> Iterator[pa.RecordBatch]:
    for digests, sets in _new_sets(batches, n):
        found = [(*d, s.tobytes(), len(s), profile_of(s), sketch_of(s)) for d, s in zip(digests, sets)]
        if found:
            inside = _in_table(np.array([f[0] for f in found], np.int64), only.value)
            found = [f for f, i in zip(found, inside.tolist()) if i]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
        names = ["d1", "d2", "shingles", "size", "profile", "sketch"]
        yield pa.RecordBatch.from_pydict({c: pa.array([f[i] for f in found], t) for i, (c, t) in enumerate(zip(names, types))})


def _slot(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys.view(np.uint64) + _M3) >> _U(64 - TABLE_BITS)).astype(np.int64)


def _in_table(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = _slot(keys)
    return (table[at >> 6] >> (at & 63).astype(np.uint64)) & _U(1) == 1


def bit_table(keys: DataFrame, name: str):
    """Broadcast table of 2^27 bits (16 MiB, whatever the number of keys) with a bit for each key."""

    def partial_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_slot(column(batch, name).to_numpy(zero_copy_only=False).astype(np.int64)))
            bit = (_U(1) << (at & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_pydict({"word": pa.array(at >> 6), "bits": pa.array(bit)})

    words = keys.select(name).mapInArrow(partial_words, "word long, bits long")
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table)


# ---- links and components --------------------------------------------------

def _may_link(size, profile, size_, profile_, percent: int) -> np.ndarray:
    """Whether sizes and profiles allow the similarity.

    Two sets' profiles differ in all by at most the number of elements the sets differ by, so a larger
    difference than linked sets can have excludes a pair for sure.
    """
    total = size + size_
    apart = np.abs(profile.astype(np.int32) - profile_).sum(axis=-1)
    return (apart * (100 + percent) <= (100 - percent) * total) & (np.minimum(size, size_) * 100 >= np.maximum(size, size_) * percent)


def _profiles(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(column(batch, name).to_pylist()), np.uint8).reshape(-1, PROFILE)


def bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) that sizes and profiles do not rule out, and the elements of both sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [(column(batch, f"size_{e}").to_numpy(), _profiles(batch, f"profile_{e}")) for e in "ab"]
            both = pa.RecordBatch.from_arrays([*batch.select(["a", "b"]).columns, pa.array(ends[0][0] + ends[1][0])], ["a", "b", "elements"])
            yield both.filter(pa.array(_may_link(*ends[0], *ends[1], percent)))

    wide = pairs.select("a", "b").distinct()
    for e in "ab":
        wide = wide.join(sets.select(F.col("node").alias(e), F.col("size").alias(f"size_{e}"), F.col("profile").alias(f"profile_{e}")), e)
    return wide.select("a", "b", "size_a", "profile_a", "size_b", "profile_b").mapInArrow(run, "a long, b long, elements long")


def _sketches_apart(x: bytes, y: bytes) -> int:
    """Cells with an odd number of elements in one of the sets alone: each takes one element at least that only one set has."""
    a, b = (np.frombuffer(v, np.uint8) for v in (x, y))
    while len(a) != len(b):  # the larger one's halves together are its sketch of half as many cells
        a, b = (a, b) if len(a) > len(b) else (b, a)
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum(dtype=np.int64))


def screened(near: DataFrame, sets: DataFrame, percent: int, count: int) -> DataFrame:
    """Those of ``count`` pairs that sketches do not rule out; a sketch is a sixteenth to a thirty-second of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "sketch_a"):
            both = zip(column(batch, "sketch_a").to_pylist(), column(batch, "sketch_b").to_pylist())
            apart = np.array([_sketches_apart(x, y) for x, y in both], np.int64)
            total = column(batch, "elements").to_numpy()
            yield batch.select(["a", "b", "elements"]).filter(pa.array(apart * (100 + percent) <= (100 - percent) * total))

    asked = F.broadcast(near) if count <= row_limit(40) else near
    a, b = (sets.select(F.col("node").alias(e), F.col("sketch").alias(f"sketch_{e}")).join(asked, e) for e in "ab")
    both = a.join(b.select("a", "b", "sketch_b"), ["a", "b"])
    return both.select("a", "b", "elements", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long, elements long")


def verified(near: DataFrame, sets: DataFrame, percent: int, count: int) -> DataFrame:
    """The pairs (a < b) of nodes whose sets link, of ``count`` pairs or fewer that their profiles allow.

    A pair belongs to the end that has more pairs. The sets of its partners are sent to that end in shares of
    a bounded number, the end's own set once to each share; rows are read as a stream.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, np.zeros(0, np.int64)
        for batch in portions(batches, "shingles"):
            out = []
            shingles = column(batch, "shingles").to_pylist()
            for hub, share, node, raw in zip(*[column(batch, c).to_pylist() for c in ("hub", "share", "node")], shingles):
                s = np.frombuffer(raw, np.int64)
                if node == hub:
                    key, own = (hub, share), s
                elif key == (hub, share):
                    both = len(own) + len(s) - len(_distinct(np.concatenate([own, s])))
                    if both * 100 >= (len(own) + len(s) - both) * percent:
                        out.append((min(hub, node), max(hub, node)))
            yield pa.RecordBatch.from_pydict({c: pa.array([p[k] for p in out], pa.int64()) for k, c in enumerate("ab")})

    degree = near.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    both = near.join(degree.toDF("a", "na"), "a").join(degree.toDF("b", "nb"), "b")
    first = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    sent = both.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("node"),
        F.ceil(F.greatest("na", "nb") / SHARE).alias("shares"),
    )
    sent = pin(sent.select("hub", F.pmod(F.xxhash64("node"), F.col("shares")).alias("share"), "node"), "sent")
    asked = sent.unionByName(sent.select("hub", "share", F.col("hub").alias("node")).distinct())
    # at most two rows a pair, three numbers each; where they fit, the sets stay in place until they are sent
    asked = F.broadcast(asked) if 2 * count <= row_limit(40) else asked
    rows = sets.select("node", "shingles").join(asked, "node").select("hub", "share", "node", "shingles")
    own = F.when(F.col("node") == F.col("hub"), 0).otherwise(1)
    rows = rows.repartition("hub", "share").sortWithinPartitions("hub", "share", own)
    links = pin(rows.mapInArrow(run, "a long, b long"), "links")
    release(sent)
    return links


def connected(pairs: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, elements: int) -> tuple[DataFrame, DataFrame]:
    """(labels after the links among the pairs, those links); ``elements``: of all sets.

    Pairs are compared in slices, so that what is sent at a time is about half of the sets' own size at most;
    pairs that earlier ones have connected are left out.
    """
    near, links = pin(bounded(pairs, sets, percent), "near"), None
    size = lambda: near.agg(F.count(F.lit(1)), F.coalesce(F.sum("elements"), F.lit(0))).first()
    count, sent = size()
    if sent > SCREEN:
        all_, near = near, pin(screened(near, sets, percent, count), "near")
        release(all_)
        count, sent = size()
    if not count:
        return labels, near.select("a", "b")
    slices = max(1, -(-2 * sent // max(1, elements))) if sent > SCREEN else 1
    for number in range(slices):
        part = near.where(F.pmod(F.xxhash64("a", "b"), F.lit(slices)) == number) if slices > 1 else near
        if number:
            apart = part.join(labels.toDF("a", "la"), "a").join(labels.toDF("b", "lb"), "b").where("la <> lb")
            part = pin(apart.select("a", "b"), "part")
        more = verified(part, sets, percent, count)
        labels_ = merged(labels, more, count)
        release(labels, *([part] if number else []))
        labels, links = labels_, more if links is None else links.union(more)
    release(near)
    return labels, links


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars around their smallest ends, in both directions; as much at once as memory allows."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def stars() -> pa.RecordBatch:
        ends = [(n, root(n)) for n in list(parent)]
        both = [e for n, r in ends if n != r for e in ((n, r), (r, n))]
        parent.clear()
        return pa.RecordBatch.from_pydict({k: pa.array([e[i] for e in both], pa.int64()) for i, k in enumerate("uv")})

    for batch in batches:
        for u, v in zip(column(batch, "u").to_pylist(), column(batch, "v").to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > STORE:
            yield stars()
    yield stars()


def merged(labels: DataFrame, links: DataFrame, count: int) -> DataFrame:
    """``labels`` (node, label) after ``links`` (``count`` or fewer): the smallest node reachable.

    Links are first drawn between labels, so a round works on what is not yet connected. Each task makes
    stars of its share. Where these are few, a task can hold them and connects them at once; over more of them,
    labels spread and jump to their label's label until nothing changes.
    """
    la, lb = labels.toDF("a", "la"), labels.toDF("b", "lb")
    few = F.broadcast if count <= row_limit(40) else lambda df: df
    edges = few(few(links).join(la, "a")).join(lb, "b").where("la <> lb")
    edges = pin(edges.select(F.col("la").alias("u"), F.col("lb").alias("v")).mapInArrow(_contracted, "u long, v long"), "edges")
    last = None
    if edges.count() <= STORE:
        now = edges.coalesce(1).mapInArrow(_contracted, "u long, v long").where("u > v").toDF("node", "label")
    else:
        last = spread(edges)
        now = last.select("node", "label")
    change = few(now.toDF("label", "to"))
    out = pin(labels.join(change, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
    release(edges, *([] if last is None else [last]))
    return out


def spread(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node reachable by ``edges``, which are given in both directions."""
    now, last = edges.select("u").distinct().select(F.col("u").alias("node"), F.col("u").alias("label")), None
    while True:
        near = edges.join(now.toDF("u", "near"), "u").groupBy("v").agg(F.min("near").alias("near"))
        step = now.join(near.withColumnRenamed("v", "node"), "node")
        step = step.select("node", F.least("label", "near").alias("next"), F.col("label").alias("was"))
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("label"))
        now_ = pin(step.join(jump, "next").select("node", "label", "was"), "labels")
        if last is not None:
            release(last)
        last, now = now_, now_.select("node", "label")
        if now_.where("label <> was").isEmpty():
            return last


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """sig, node, label, n of the signatures that still have sets of several components."""
    rows = members.join(labels, "node")
    mixed = rows.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("n"))
    mixed = mixed.where(F.col("x") < F.col("y")).select("sig", "n")
    return pin(rows.join(mixed, "sig"), "open")


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _hubs(rows: DataFrame) -> DataFrame:
    """sig and the set of it that occurs with most others in all."""
    often = rows.groupBy("node").agg(F.sum("n").alias("often"))
    return rows.join(often, "node").groupBy("sig").agg(F.max(F.struct("often", "node", "label")).alias("hub"))


def _nominated(rows: DataFrame) -> DataFrame:
    """One pair for each set: with the most frequent hub of its signatures."""
    met = rows.join(_hubs(rows), "sig").where(F.col("node") != F.col("hub.node"))
    best = met.groupBy("node").agg(F.max("hub").alias("hub"))
    return best.select(*_pair("node", "hub.node"))


def _star(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidate pairs, members that stay): each signature's most frequent set against its other components."""
    met = rows.join(_hubs(rows), "sig")
    pairs = met.where(F.col("label") != F.col("hub.label")).select(*_pair("node", "hub.node"))
    return pairs.distinct(), met.where(F.col("node") != F.col("hub.node")).select("sig", "node")


def _shares(rows: DataFrame) -> DataFrame:
    """Of each signature the component with the most sets (m, label) and the number of all sets."""
    sized = rows.groupBy("sig", "label").agg(F.count(F.lit(1)).alias("m"))
    return sized.groupBy("sig").agg(F.max(F.struct("m", "label")).alias("top"), F.sum("m").alias("all"))


def _blocks_suffice(rows: DataFrame) -> bool:
    """Whether a set meets no more than a block of others in the mean, if signatures are compared as they are."""
    met = F.sum((F.col("all") - F.col("top.m")) * F.col("all"))
    found = _shares(rows).agg(met.alias("met"), F.sum("all").alias("n")).first()
    return (found["met"] or 0) <= BLOCK * (found["n"] or 0)


def _block_pairs(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidates of all open signatures across components, block by block.

    Of a signature's sets those of the largest component need not meet each other. The rest is cut into blocks;
    each meets itself, the later ones, and the blocks of the largest component. Rows are sorted by signature
    and the two blocks and read as a stream, so a task holds two blocks at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def pairs() -> set[tuple[int, int]]:
            node, label, side, size = (np.array([h[i] for h in held], np.int64) for i in range(4))
            profile = np.frombuffer(b"".join(h[4] for h in held), np.uint8).reshape(-1, PROFILE)
            out = set()
            left = np.flatnonzero(side == 0)
            for i in left.tolist():
                # within one block each pair once, between two blocks only across
                rest = left[left > i] if key[1] == key[2] else np.flatnonzero(side == 1)
                rest = rest[label[rest] != label[i]]
                near = rest[_may_link(size[i], profile[i], size[rest], profile[rest], percent)]
                out.update((int(min(node[i], x)), int(max(node[i], x))) for x in node[near].tolist())
            return out

        found: set[tuple[int, int]] = set()
        for batch in batches:
            for sig, i, j, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if (sig, i, j) != key:
                    found |= pairs() if len(held) > 1 else set()
                    key, held = (sig, i, j), []
                held.append(row)
            if len(found) >= STORE:
                yield _ends(found)
                found = set()
        yield _ends(found | pairs() if len(held) > 1 else found)

    own = rows.select("sig", "node", "label").join(_shares(rows), "sig")
    major = F.col("label") == F.col("top.label")
    a, b = F.ceil((F.col("all") - F.col("top.m")) / BLOCK), F.ceil(F.col("top.m") / BLOCK)
    own = own.select("sig", "node", "label", major.alias("major"), a.alias("a"), b.alias("b"))
    own = own.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("major"), F.col("b")).otherwise(F.col("a"))))
    # the rest's blocks are 0.., those of the largest component follow them
    one, last = F.lit(1).cast("long"), F.col("a") + F.col("b") - 1
    place = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.alias("side"))
    zero, second = F.lit(0).cast("long"), F.lit(1).cast("long")
    of_major = F.transform(F.sequence(zero, F.col("a") - 1), lambda i: place(i, F.col("a") + F.col("own"), second))
    as_first = F.transform(F.sequence(F.col("own"), last), lambda j: place(F.col("own"), j, zero))
    as_second = F.transform(F.sequence(zero, F.col("own") - 1, one), lambda i: place(i, F.col("own"), second))
    of_rest = F.when(F.col("own") > 0, F.concat(as_first, as_second)).otherwise(as_first)
    wide = own.select("sig", "node", "label", F.inline(F.when(F.col("major"), of_major).otherwise(of_rest)))
    wide = wide.join(sets.select("node", "size", "profile"), "node").select("sig", "i", "j", "node", "label", "side", "size", "profile")
    return wide.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j").mapInArrow(run, "a long, b long")


def _ends(found: set[tuple[int, int]]) -> pa.RecordBatch:
    pairs = sorted(found)
    return pa.RecordBatch.from_pydict({c: pa.array([p[k] for p in pairs], pa.int64()) for k, c in enumerate("ab")})


def _once(members: DataFrame) -> DataFrame:
    """The members of one signature for each distinct collection of sets.

    A collection is known by its number of sets and by two hashes of them, folded together; none is gathered.
    """
    part = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "d1"))
    kinds = members.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), part(1).alias("h1"), part(2).alias("h2"))
    first = kinds.groupBy("n", "h1", "h2").agg(F.min("sig").alias("sig")).select("sig")
    return members.join(first, "sig", "left_semi")


def links_of(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: doc_id, n_shingles, d1, d2; nodes: node, d1, d2, label; links: a, b).

    A node is a class of equal sets that may link with another class; links hold verified pairs
    enough to connect every component (not each pair of copies).
    """
    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    documents = pin(rows.mapInArrow(partial(_digests, n=n), "doc_id long, n_shingles long, d1 long, d2 long"), "digests")
    text = rows.select("text")

    def signature_rows(only) -> DataFrame:
        return text.mapInArrow(partial(_signature_rows, n=n, percent=percent, only=only), "sig long, d1 long")

    # nearly all signatures are of one set alone: sorted rows can leave memory, and no task holds a table of its signatures
    every = text.mapInArrow(lambda batches: _fewer(_signature_rows(batches, n, percent, None)), "sig long, d1 long")
    shared = pin(every.repartition("sig").sortWithinPartitions("sig").mapInArrow(_met, "sig long, a long, b long, n long"), "shared")
    crowded = shared.where("n > 2").select("sig")
    table = bit_table(crowded, "sig")
    everyone = pin(signature_rows(table).join(crowded, "sig", "left_semi").distinct(), "members")
    members = pin(_once(everyone), "members")
    two = pin(shared.where("n = 2").select("a", "b").distinct(), "two")
    release(everyone, shared)
    wanted = pin(two.select(F.explode(F.array("a", "b")).alias("d1")).union(members.select("d1")).distinct(), "wanted")
    table = bit_table(wanted, "d1")
    sets = text.mapInArrow(partial(_set_rows, n=n, only=table), "d1 long, d2 long, shingles binary, size long, profile binary, sketch binary")
    sets = sets.join(wanted, "d1", "left_semi").groupBy("d1", "d2").agg(*[F.first(c).alias(c) for c in ("shingles", "size", "profile", "sketch")])
    sets = pin(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    key = sets.select("node", "d1")
    pairs = two.join(key.toDF("x", "a"), "a").join(key.toDF("y", "b"), "b").select(*_pair("x", "y"))
    labels = pin(key.select("node", F.col("node").alias("label")), "labels")
    left = pin(members.join(key, "d1").select("sig", "node"), "members")
    release(members, wanted)
    open_ = _open(left, labels)
    links, round_, last = None, 0, False
    elements = sets.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    while True:
        if round_ == 0:
            pairs = pairs.union(_nominated(open_))
        elif last := round_ > STARS or _blocks_suffice(open_):
            pairs = _block_pairs(open_, sets, percent)
        else:
            pairs, stay = _star(open_)
            left_ = pin(stay, "members")
            release(left)
            left = left_
        labels, more = connected(pairs, sets, labels, percent, elements)
        release(open_)
        links = more if links is None else links.union(more)
        round_ += 1
        if last:
            break
        open_ = _open(left, labels)
        if open_.isEmpty():
            release(open_)
            break
    nodes = pin(sets.select("node", "d1", "d2").join(labels, "node"), "nodes")
    release(left, two, sets, labels)
    return documents, nodes, links


def near_duplicates(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every document."""
    documents, nodes, _ = links_of(docs, n, percent)
    classes = documents.where("n_shingles > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")
    )
    classes = pin(classes.join(nodes.select("d1", "d2", "label"), ["d1", "d2"], "left"), "classes")
    linked = classes.where("label is not null")
    smallest = linked.groupBy("label").agg(F.min("least").alias("smallest"))
    joined = linked.join(smallest, "label").select("d1", "d2", "smallest")
    alone = classes.where("label is null and n > 1").select("d1", "d2", F.col("least").alias("smallest"))
    known = joined.unionByName(alone)
    out = documents.join(known, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("smallest", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
