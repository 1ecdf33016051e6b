"""Hard negatives of anchors, found by best-first search in packed trees of bounding boxes.

Packing (sort-tile-recursive): Spark cuts all rows into ranges of the coordinate with the largest variance;
inside a range the rows are sorted and cut by the next coordinates in turn, each into as many tiles as make
leaves of ``LEAF`` rows. Consecutive leaves form a subtree, one row of a table: its rows in leaf order and
the minimum bounding box of every leaf, of every ``FAN`` leaves, and of all.

Searching: a box bounds each coordinate x by low <= x <= high, so q*x lies between q*low and q*high (swapped
where q < 0), and the sums over the coordinates bound the inner product with every row in the box. A queue
holds boxes by their best upper bound; the best box is opened, its children are queued or its rows scored.
A box is dropped for an anchor when its bounds miss all score windows of the anchor, or its upper bound is
strictly below the anchor's k-th score in each; equal bounds stay, since ties go by id. Anchors near each
other go through a subtree as one group (each with its own bounds and scores), and what they have found
prunes the subtrees that follow in the same task.

Anchors are taken in blocks of ``BLOCK``; a block is sent to all tasks, the tasks' best rows meet under the
anchor. First the positives are found (same label, no window), then, with the windows that their scores
span, the negatives. Scores are exact up to 2^53 and rounded as doubles beyond.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part; shorter
vectors count as padded with zeros; a null id comes after all others in ties and is never an anchor; rows
with one id are separate rows, and each that is an anchor gets its own results; an anchor without positives,
or a positive without negatives, gives no row; an empty table gives an empty result; other columns stay behind.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import column
from clickweave.scratch import pin

#: Rows of a leaf, boxes of an inner box, rows of a subtree, rows that a packing task holds, anchors searched
#: together, and anchors of a block.
LEAF, FAN, SUBTREE, SLAB, GROUP, BLOCK = 128, 16, 1 << 14, 1 << 17, 256, 1 << 15
LAST = (1 << 63) - 1
POSITIVES, NEGATIVES, LOWER, UPPER = 5, 3, 50, 95


# ---- rows ----------------------------------------------------------------------

def usable_rows(rows: DataFrame, anchor: Column, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """row, id, label, whole-numbered vector and whether the row is an anchor; only rows that take part."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    wide = rows.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("id"),
        F.col("label").cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(anchor & F.col("vec_id").isNotNull(), F.lit(False)).alias("anchor"),
    )
    wide = wide.where(F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", good))
    scaled = wide.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    return pin(scaled.withColumn("row", F.monotonically_increasing_id()), "vectors")


def matrix_of(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, padded with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def coordinates(rows: DataFrame, width: int) -> list[int]:
    """Coordinates by variance, largest first; each task adds up its own sums."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            m = matrix_of(column(batch, "v"), width)
            n, one, two = n + len(m), one + m.sum(axis=0), two + (m * m).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"d": pa.array(range(width), pa.int32()), "n": pa.array([n] * width, pa.int64()), "one": pa.array(one), "two": pa.array(two)})

    spread = F.sum("two") / F.sum("n") - F.pow(F.sum("one") / F.sum("n"), F.lit(2))
    found = rows.select("v").mapInArrow(sums, "d int, n long, one double, two double").groupBy("d").agg(spread.alias("s"))
    return [r["d"] for r in sorted(found.collect(), key=lambda r: (-(r["s"] or 0), r["d"]))]


# ---- packing -------------------------------------------------------------------

def tiled(m: np.ndarray, rows: np.ndarray, dims: list[int], leaf: int) -> Iterator[np.ndarray]:
    """The rows of each leaf: sorted by the first coordinate, cut into tiles, and each tile by the next ones."""
    leaves = -(-len(rows) // leaf)
    if leaves <= 1 or not dims:
        yield from (rows[i : i + leaf] for i in range(0, len(rows), leaf))
        return
    used = dims[: max(1, int(math.log2(leaves)))]
    tiles = math.ceil(leaves ** (1 / len(used)))
    ordered = rows[np.argsort(m[rows, used[0]], kind="stable")]
    size = -(-leaves // tiles) * leaf
    for i in range(0, len(ordered), size):
        yield from tiled(m, ordered[i : i + size], used[1:], leaf)


SUBTREES = "n int, ids binary, rows binary, labels binary, vectors binary, ends binary, low binary, high binary"


def _boxes(m: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lows and highs of the leaves, of every ``FAN`` leaves, and of all."""
    starts = np.concatenate([[0], ends[:-1]])
    low, high = np.minimum.reduceat(m, starts), np.maximum.reduceat(m, starts)
    inner = np.arange(0, len(ends), FAN)
    lows, highs = [low, np.minimum.reduceat(low, inner)], [high, np.maximum.reduceat(high, inner)]
    return np.concatenate([*lows, low.min(axis=0)[None]]), np.concatenate([*highs, high.max(axis=0)[None]])


def _subtrees(held: list[pa.RecordBatch], width: int, dims: list[int]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held).combine_chunks()
    m = matrix_of(table["v"].combine_chunks(), width)
    ids, rows, labels = (table[c].to_numpy().astype("<i8") for c in ("id", "row", "label"))
    leaves = list(tiled(m, np.arange(len(m)), dims, LEAF))
    step = SUBTREE // LEAF
    for i in range(0, len(leaves), step):
        own = leaves[i : i + step]
        at, ends = np.concatenate(own), np.cumsum([len(x) for x in own])
        low, high = _boxes(m[at], ends)
        packed = [ids[at], rows[at], labels[at], m[at].astype("<f8"), ends.astype("<i8"), low.astype("<f8"), high.astype("<f8")]
        names = [f.split()[0] for f in SUBTREES.split(", ")]
        cols = [pa.array([len(at)], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in packed]]
        yield pa.RecordBatch.from_arrays(cols, names=names)


def packed(rows: DataFrame, n: int, width: int, dims: list[int]) -> DataFrame:
    """The subtrees of all rows. The id splits rows with one value of the first coordinate between ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= SLAB:
                yield from _subtrees(held, width, dims[1:])
                held, size = [], 0
        if size:
            yield from _subtrees(held, width, dims[1:])

    spark = rows.sparkSession
    ranges = max(1, -(-n // SLAB), min(spark.sparkContext.defaultParallelism, -(-n // (8 * LEAF))))
    dealt = rows.select("id", "row", "label", "v").repartitionByRange(ranges, F.get("v", F.lit(dims[0])), "id", "row")
    return pin(dealt.mapInArrow(run, SUBTREES), "subtrees")


class Tree:
    """One subtree as its tasks see it; boxes are numbered leaves first, then inner ones, then the whole."""

    def __init__(self, row: dict, width: int):
        take = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.rows, self.labels = (take(c, "<i8") for c in ("ids", "rows", "labels"))
        self.m = take("vectors", "<f8").reshape(-1, width)
        self.ends = take("ends", "<i8")
        self.low, self.high = (take(c, "<f8").reshape(-1, width) for c in ("low", "high"))
        self.leaves, self.root = len(self.ends), len(self.low) - 1

    def children(self, box: int) -> np.ndarray:
        if box == self.root:
            return np.arange(self.leaves, self.root)
        first = (box - self.leaves) * FAN
        return np.arange(first, min(first + FAN, self.leaves))

    def leaf(self, box: int) -> slice:
        return slice(int(self.ends[box - 1]) if box else 0, int(self.ends[box]))


# ---- searching -----------------------------------------------------------------

class Group:
    """Anchors searched together and the best rows found for each of their windows so far."""

    def __init__(self, q: np.ndarray, rows: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.q, self.rows, self.labels, self.low, self.high, self.k, self.same = q, rows, labels, low, high, k, same
        self.plus, self.minus = np.maximum(q, 0), np.minimum(q, 0)
        self.floor = low.copy()  # scores below neither fit the window nor reach the k-th one
        self.query, self.score, self.id, self.row = (np.zeros(0, t) for t in (np.int64, np.float64, np.int64, np.int64))

    def bounds(self, tree: Tree, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of each anchor with what lies in the boxes."""
        low, high = tree.low[boxes].T, tree.high[boxes].T
        return self.plus @ low + self.minus @ high, self.plus @ high + self.minus @ low

    def wanted(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which anchors may find something between the bounds (anchor x box)."""
        fits = (most[:, :, None] >= self.floor[:, None, :]) & (least[:, :, None] <= self.high[:, None, :])
        return fits.any(axis=2)

    def search(self, tree: Tree) -> None:
        queue: list[tuple[float, int]] = []
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def offer(boxes: np.ndarray) -> None:
            least, most = self.bounds(tree, boxes)
            open_ = self.wanted(least, most)
            best = np.where(open_, most, -np.inf).max(axis=0)
            for i in np.flatnonzero(open_.any(axis=0)).tolist():
                bounds[int(boxes[i])] = least[:, i : i + 1], most[:, i : i + 1]
                heappush(queue, (-float(best[i]), int(boxes[i])))

        offer(np.array([tree.root]))
        while queue:
            _, box = heappop(queue)
            who = np.flatnonzero(self.wanted(*bounds.pop(box))[:, 0])
            if not len(who):
                continue  # what was found since excludes it
            if box >= tree.leaves:
                offer(tree.children(box))
            else:
                self._score(tree, tree.leaf(box), who)

    def _score(self, tree: Tree, part: slice, who: np.ndarray) -> None:
        scores = self.q[who] @ tree.m[part].T
        other = (tree.labels[part] == self.labels[who, None]) == self.same
        other &= tree.rows[part] != self.rows[who, None]
        windows, found = self.low.shape[1], []
        for w in range(windows):
            a, r = np.nonzero(other & (scores >= self.floor[who, w, None]) & (scores <= self.high[who, w, None]))
            if len(a):
                found.append((who[a] * windows + w, scores[a, r], tree.ids[part][r], tree.rows[part][r]))
        if not found:
            return
        new = [np.concatenate(x) for x in zip((self.query, self.score, self.id, self.row), *found)]
        order = np.lexsort((new[3], new[2], -new[1], new[0]))
        query = new[0][order]
        first = np.flatnonzero(np.diff(query, prepend=-1))
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        kept = place < self.k
        self.query, self.score, self.id, self.row = (x[order][kept] for x in new)
        full = place == self.k - 1
        self.floor.reshape(-1)[query[full]] = np.maximum(self.floor.reshape(-1)[query[full]], new[1][order][full])


FOUND = "anchor long, win int, score double, id long, row long"


def _best(batches: Iterator[pa.RecordBatch], block, width: int, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """The best rows of a task's subtrees for each anchor and window of the block."""
    b = block.value
    groups = [
        Group(*(b[c][i : i + GROUP] for c in ("q", "rows", "labels", "low", "high")), k, same) for i in range(0, len(b["rows"]), GROUP)
    ]
    for batch in batches:
        for row in range(batch.num_rows):
            tree = Tree({n: batch.column(i)[row].as_py() for i, n in enumerate(batch.schema.names) if n != "n"}, width)
            for g in groups:
                g.search(tree)
    for g in groups:
        a, w = np.divmod(g.query, g.low.shape[1])
        cols = [g.rows[a], w.astype(np.int32), g.score, g.id, g.row]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["anchor", "win", "score", "id", "row"])


def _top(trees: DataFrame, block: dict[str, np.ndarray], width: int, k: int, same: bool) -> DataFrame:
    """anchor, win, place (from 1), score, id: the best ``k`` over all tasks."""
    sent = trees.sparkSession.sparkContext.broadcast(block)
    found = trees.mapInArrow(partial(_best, block=sent, width=width, k=k, same=same), FOUND)
    order = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "id", "row")
    ranked = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    out = pin(ranked.select("anchor", "win", "place", "score", "id"), "best")
    sent.destroy()
    return out


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lower: int = LOWER,
    upper: int = UPPER,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and the vector; ``anchor`` tells the anchors among them. A negative has another
    label and lower * positive_score <= 100 * negative_score <= upper * positive_score.
    """
    spark = rows.sparkSession
    known = usable_rows(rows, anchor, vector, scale)
    n, width = known.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(1, width or 0)
    dims = coordinates(known, width) if n else [0]
    trees = packed(known, n, width, dims)
    # anchors in the order of the first coordinates, so that neighbours share groups
    order = [F.get("v", F.lit(d)) for d in dims[:2]]
    asked = known.where("anchor").select("row", "id", "label", "v", *[o.alias(f"o{i}") for i, o in enumerate(order)])
    blocks = max(1, -(-asked.count() // BLOCK))
    asked = pin(asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))), "anchors")
    out = None
    for number in range(blocks):
        block = asked.where(F.col("block") == number).orderBy("o0", *(["o1"] if len(order) > 1 else []), "row").toArrow().combine_chunks()
        size = block.num_rows
        one = {c: block[k].to_numpy().astype(np.int64) for c, k in (("rows", "row"), ("labels", "label"))}
        one |= {"q": matrix_of(block["v"].combine_chunks(), width) if size else np.zeros((0, width))}
        first = one | {"low": np.full((size, 1), -np.inf), "high": np.full((size, 1), np.inf)}
        near = _top(trees, first, width, positives, same=True)
        low, high = np.full((size, positives), np.inf), np.full((size, positives), -np.inf)
        got = near.toArrow()
        place = np.searchsorted(np.sort(one["rows"]), got["anchor"].to_numpy())
        at, win, s = np.argsort(one["rows"])[place], got["place"].to_numpy() - 1, got["score"].to_numpy()
        low[at, win], high[at, win] = np.ceil(s * lower / 100), np.floor(s * upper / 100)
        far = _top(trees, one | {"low": low, "high": high}, width, negatives, same=False)
        id_of = lambda c: F.when(F.col(c) < LAST, F.col(c))
        pairs = near.select("anchor", (F.col("place") - 1).alias("win"), F.col("id").alias("p"), F.col("score").alias("ps"))
        made = far.join(pairs, ["anchor", "win"]).join(asked.select(F.col("row").alias("anchor"), F.col("id").alias("a")), "anchor")
        made = made.select(
            F.col("a").alias("anchor_id"),
            id_of("p").alias("positive_id"),
            F.col("place").alias("rank"),
            id_of("id").alias("negative_id"),
            F.col("ps").cast("long").alias("positive_score"),
            F.col("score").cast("long").alias("negative_score"),
        )
        out = made if out is None else out.unionByName(made)
    return out
