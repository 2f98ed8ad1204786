"""N-gram Jaccard join over an R-tree of count vectors.

A document is the set of its word shingles. Shingles are hashed into ``DIMS`` groups, and
the counts per group are the point of a set. The overlap of two sets is at most the sum of
the smaller coordinates of their points. A node of the tree keeps the largest coordinates
and the smallest size below it, so the same sum bounds every pair below two nodes.

Points of unrelated texts of equal length lie close together, so one tree over all of them
would compare nearly every pair of leaves. Its roots are therefore cells, which lose no
link: sets of similar sizes are hashed into slots, of which a linked pair can differ in no
more than ``limit``. A set enters the cells of its first ``limit`` + 1 slots that hold
anything, a cell being the exact content of a slot, so a linked pair meets in one of them.

1. Sorted by cell, every set is linked with the first set of the cells it shares most, if
   the sets are similar enough.
2. In cells that still hold several components an R-tree finds the pairs of different
   components that its bounds can't exclude. Crowded cells are cut into nodes over many
   tasks, and only pairs of nodes within the bounds meet. In a few rounds every set tells only its
   best pair in one larger cell, so that families become components without all their pairs.
3. Then all cells tell all their surviving pairs between components, which are verified on the
   full sets, each pair once.

Sets equal in all shingles are one set throughout, however many documents have it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.components import components
from tamarack.llm.words import WORD, gram_hashes, mixed, utf8, word_hashes
from tamarack.session import materialize

WORDS = 4
PERCENT = 85
DIMS = 256  # coordinates of a point: the more, the closer the bound
FULL = 255  # a coordinate of so many or more
LEAF = 16  # points of a leaf
FAN = 8  # children of an inner node
FEW = 32  # sets of a cell whose pairs are all bounded, without a tree
ROUNDS = 3  # of joining the best pairs of larger cells, before what is left is gone through
NODE = 1024  # sets in a node of a crowded cell
PART = 256  # documents whose hashes are held at once
STRIP = 1 << 14  # pairs whose bounds are computed at once
GROUP = 20_000  # rows of small cells in a task's group, about
TEXTS = 256  # texts of a side that are compared at once
SLICE = 4_000_000  # rows of a sorted slice, about

_SEED = np.uint64(0xD6E8FEB86659FD93)
_SLOT = np.uint64(0xA0761D6478BD642F)
_CLASS = np.uint64(0xE7037ED1A0B428DB)


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of lower-cased words; a shorter text is one shingle."""
    hashes = word_hashes(WORD.findall(text.lower())) if text else np.zeros(0, np.uint64)
    return np.unique(gram_hashes(hashes, min(words, len(hashes)) or 1))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def size_classes(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(smallest size, slots) of every class of sizes, so that links stay in a class or reach the next.

    The last class has no end that a set could reach. Slots are a few more than a linked
    pair can differ in; 0 where sets that differ can't be linked.
    """
    lo, slots = [1], []
    while lo[-1] < 2**40:
        lo.append(max(lo[-1] + 1, -(-lo[-1] * max(200, -(-10000 // percent)) // 100)))
        most = 2 * (lo[-1] - 1) * (100 - percent) // (100 + percent)
        slots.append(most + most // 16 + 2 if most else 0)
    return np.array(lo, np.int64), np.array([*slots, 0], np.int64)


def expanded(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) for every whole number from lo to hi (exclusive) of every row."""
    n = hi - lo
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + lo[row]


def cell_keys(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the set, key) of every cell that the sets enter."""
    lo, slots = size_classes(percent)
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *sets])
    ends = np.cumsum(n)
    own = np.searchsorted(lo, n, "right") - 1
    every = np.arange(len(n))
    guest = every[(n > 0) & (100 * n >= percent * lo[np.minimum(own + 1, len(lo) - 1)])]
    of = np.concatenate([every[n > 0], guest])
    size = np.concatenate([own[n > 0], own[guest] + 1])
    # How far a linked set of this class can differ: most for the largest partner.
    partner = np.minimum(lo[np.minimum(size + 1, len(lo) - 1)] - 1, 100 * n[of] // percent)
    limit = (n[of] + partner) * (100 - percent) // (100 + percent)
    some = (limit > 0) & (slots[size] > 0)
    of, size, limit = of[some], size[some], limit[some]

    found_of, found_key, seed = [], [], 0
    while len(of):  # a set with too few slots in use is hashed once more
        salt = np.uint64(seed * int(_SEED) % 2**64)
        h = slots[size]
        row, at = expanded(ends[of] - n[of], ends[of])
        m = mixed(flat[at] ^ salt)
        first = np.cumsum(h) - h
        place = first[row] + (m % h[row].astype(np.uint64)).astype(np.int64)
        content = np.zeros(int(h.sum()), np.uint64)
        np.add.at(content, place, mixed(m ^ _SLOT))
        used = np.bincount(place, minlength=len(content)) > 0
        rank = np.cumsum(used)
        slot_row, slot = expanded(np.zeros(len(h), np.int64), h)
        rank -= (rank[first] - used[first])[slot_row]
        entered = used & (rank <= limit[slot_row] + 1)
        mark = slot.astype(np.uint64) * _SLOT + size[slot_row].astype(np.uint64) * _CLASS + salt
        found_of.append(of[slot_row[entered]])
        found_key.append(mixed(content + mixed(mark))[entered])
        short = np.bincount(slot_row, weights=used, minlength=len(of)) <= limit
        of, size, limit, seed = of[short], size[short], limit[short], seed + 1
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([none[0], *found_of]), np.concatenate([none[1], *found_key])


def points_of(sets: list[np.ndarray]) -> np.ndarray:
    """Counts per group up to ``FULL``, a row per set."""
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    group = (np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(56)).astype(np.int64)  # DIMS of them
    counts = np.bincount(of * DIMS + group, minlength=len(sets) * DIMS).reshape(-1, DIMS)
    return np.minimum(counts, FULL).astype(np.uint8)


def overlap_bound(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The sum of the smaller coordinates, row by row; no bound (2^40) where both are ``FULL`` somewhere."""
    least = np.minimum(p, q)
    return np.where((least == FULL).any(1), 2**40, least.sum(1, dtype=np.int64))


def sign(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, text_id, n_shingles, set_id, cells and point of every row; no cells or point for an empty set."""
    schema = "doc_id long, text_id long, n_shingles long, set_id long, cells array<long>, point binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, PART):
                part = batch.slice(lo, PART)
                sets = [shingle_set(t, words) for t in utf8(part.column(2))]
                of, key = cell_keys(sets, percent)
                order = np.argsort(of, kind="stable")
                offsets = np.append(0, np.cumsum(np.bincount(of, minlength=len(sets)))).astype(np.int32)
                ids = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
                points = [p.tobytes() if len(s) else None for p, s in zip(points_of(sets), sets, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(key[order].view(np.int64))),
                        pa.array(points, pa.binary()),
                    ],
                    names=["doc_id", "text_id", "n_shingles", "set_id", "cells", "point"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    return rows.mapInArrow(run, schema)


def _slices(df: DataFrame, rows: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // SLICE))


def shared_cells(signed: DataFrame) -> DataFrame:
    """key, v and pivot: the sets of all cells that hold several, and the first set of each.

    Cells are sorted into ranges, so one that holds most sets lies in many slices, with a
    pivot in each; the first and last cell of a slice are kept even with one set.
    """
    rows = signed.agg(F.sum(F.size("cells"))).first()[0] or 0
    pairs = signed.select(F.explode("cells").alias("key"), F.col("set_id").alias("v"))
    pairs = pairs.repartitionByRange(_slices(signed, rows), "key", "v").sortWithinPartitions("key", "v")

    def table(key, v, pivot) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(v), pa.array(pivot)], names=["key", "v", "pivot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (key, v, pivot) of the row before
        waiting, leading = False, True  # whether that row is not given out yet; whether in the first cell
        for batch in batches:
            key, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            fresh = np.append(True, (key[1:] != key[:-1]) | (v[1:] != v[:-1]))
            if len(key) and last is not None:
                fresh[0] = (key[0], v[0]) != last[:2]
            key, v = key[fresh], v[fresh]
            if not len(key):
                continue
            start = np.append(True, key[1:] != key[:-1])
            goes_on = last is not None and key[0] == last[0]
            first = np.flatnonzero(start)
            run_of = np.cumsum(start) - 1
            pivot = v[first][run_of]
            if goes_on:
                pivot[run_of == 0] = last[2]
                if waiting:
                    yield table(key[:1], np.array([last[1]]), np.array([last[2]]))
            several = np.bincount(run_of) > 1
            if goes_on or leading:
                several[0] = True
            leading = leading and len(first) == 1
            out = several[run_of]
            waiting = not out[-1]
            last = (key[-1], v[-1], pivot[-1])
            yield table(key[out], v[out], pivot[out])
        if waiting:
            yield table(*(np.array([x]) for x in last))

    return pairs.mapInArrow(run, "key long, v long, pivot long")


class Tree:
    """An R-tree over points: a list of levels, the points first, each with the bounds of its nodes."""

    def __init__(self, points: np.ndarray, size: np.ndarray, root: np.ndarray):
        self.order = self._packed(points, np.arange(len(points)))
        p, n, r = points[self.order], size[self.order], root[self.order]
        # upper coordinates, least size, most size, and the component if there is but one (else None).
        self.levels = [(p, n, n, r, np.ones(len(n), bool))]
        while len(self.levels[-1][1]) > FAN:
            upper, least, most, comp, pure = self.levels[-1]
            at = np.arange(0, len(least), LEAF if len(self.levels) == 1 else FAN)
            low, high = np.minimum.reduceat(comp, at), np.maximum.reduceat(comp, at)
            self.levels.append(
                (
                    np.maximum.reduceat(upper, at, axis=0),
                    np.minimum.reduceat(least, at),
                    np.maximum.reduceat(most, at),
                    low,
                    (low == high) & np.logical_and.reduceat(pure, at),
                )
            )

    def _packed(self, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rows in an order in which neighbours are alike: halved along the widest coordinate."""
        if len(rows) <= LEAF:
            return rows
        p = points[rows]
        along = rows[np.argsort(p[:, np.argmax(p.max(axis=0) - p.min(axis=0))], kind="stable")]
        half = -(-len(along) // (2 * LEAF)) * LEAF
        return np.concatenate([self._packed(points, along[:half]), self._packed(points, along[half:])])

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``nodes``, child) for all children, which are nodes of the level below."""
        width = LEAF if level == 1 else FAN
        return expanded(nodes * width, np.minimum((nodes + 1) * width, len(self.levels[level - 1][1])))


def within_bounds(left: tuple, right: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of nodes may hold a linked pair of different components."""
    (pu, pl, pm, pc, pp), (qu, ql, qm, qc, qp) = left, right
    ok = (100 * pm[i] >= percent * ql[j]) & (100 * qm[j] >= percent * pl[i])
    ok &= ~(pp[i] & qp[j] & (pc[i] == qc[j]))
    some = np.flatnonzero(ok)
    for lo in range(0, len(some), STRIP):
        at = some[lo : lo + STRIP]
        bound = overlap_bound(pu[i[at]], qu[j[at]])
        ok[at] = (100 + percent) * bound >= percent * (pl[i[at]] + ql[j[at]])
    return ok


def tree_join(a: Tree, b: Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b that the bounds let through, level by level; each pair once if a is b."""
    p, q = len(a.levels) - 1, len(b.levels) - 1
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a.levels[p][1])), np.arange(len(b.levels[q][1])), indexing="ij"))
    while True:
        if a is b:
            once = i <= j if p else i < j
            i, j = i[once], j[once]
        ok = within_bounds(a.levels[p], b.levels[q], i, j, percent)
        i, j = i[ok], j[ok]
        if not p and not q:
            return a.order[i], b.order[j]
        if a is b:
            row, i = a.children(p, i)
            row_j, j = b.children(q, j[row])
            i, p, q = i[row_j], p - 1, q - 1
        elif p >= q:
            row, i = a.children(p, i)
            j, p = j[row], p - 1
        else:
            row, j = b.children(q, j)
            i, q = i[row], q - 1


def small_pairs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All i < j within consecutive runs of the given sizes."""
    end = np.repeat(np.cumsum(sizes), sizes)
    return expanded(np.arange(1, len(end) + 1), end)


def surviving(table: pa.Table, percent: int, best: bool = False) -> pa.Table:
    """a, b, key and bound: pairs of different components, cell by cell, that the bounds let through.

    Rows of key, x, y, own, v, root, n and point. A small cell has x = y; else x and y are
    two nodes of the cell, and own is the one that the row is in. With ``best`` only the pair of
    the largest bound on the similarity is told for each set.
    """
    columns = [table[c].to_numpy() for c in ("key", "x", "y", "own", "v", "root", "n")]
    order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
    key, x, y, own, v, root, n = (c[order] for c in columns)
    raw = b"".join(table["point"].to_pylist())
    points = np.frombuffer(raw, np.uint8).reshape(-1, DIMS)[order]
    start = np.append(True, (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
    first = np.flatnonzero(start)
    sizes = np.diff(np.append(first, len(key)))
    few = (sizes <= FEW) & (x[first] == y[first])
    found = []
    rows = np.flatnonzero(np.repeat(few, sizes))
    if len(rows):
        i, j = small_pairs(sizes[few])
        i, j = rows[i], rows[j]
        level = (points[rows], n[rows], n[rows], root[rows], np.ones(len(rows), bool))
        back = np.zeros(len(key), np.int64)
        back[rows] = np.arange(len(rows))
        ok = within_bounds(level, level, back[i], back[j], percent)
        found.append((i[ok], j[ok]))
    for lo, size in zip(first[~few].tolist(), sizes[~few].tolist(), strict=True):
        at = np.arange(lo, lo + size)
        left, right = at[own[at] == x[lo]], at[own[at] == y[lo]]
        a = Tree(points[left], n[left], root[left])
        b = a if x[lo] == y[lo] else Tree(points[right], n[right], root[right])
        i, j = tree_join(a, b, percent)
        found.append((left[i], right[j]))
    i = np.concatenate([np.zeros(0, np.int64), *(f[0] for f in found)])
    j = np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)])
    bound = np.empty(len(i))
    for lo in range(0, len(i), STRIP):
        p, q = i[lo : lo + STRIP], j[lo : lo + STRIP]
        bound[lo : lo + STRIP] = overlap_bound(points[p], points[q]) / (n[p] + n[q])
    if best:
        ends, pair = np.concatenate([v[i], v[j]]), np.tile(np.arange(len(i)), 2)
        order = np.lexsort((pair, bound[pair], ends))
        last = np.append(ends[order][1:] != ends[order][:-1], True)[: len(order)]
        kept = np.unique(pair[order[last]])
        i, j, bound = i[kept], j[kept], bound[kept]
    a, b = np.minimum(v[i], v[j]), np.maximum(v[i], v[j])
    # A pair that shares several cells of this group is given out for the smallest only.
    by = np.lexsort((key[i], b, a))
    a, b, k = a[by], b[by], key[i][by]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
    return pa.table({"a": a[new], "b": b[new], "key": k[new], "bound": bound[by][new]})


def in_nodes(rows: DataFrame, count: int) -> DataFrame:
    """Rows of crowded cells with their node: ``NODE`` neighbours by size of one cell and slice."""
    ranged = rows.repartitionByRange(_slices(rows, count), "key", "n", "v").sortWithinPartitions("key", "n", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            out = []
            for k in batch.column("key").to_pylist():
                if k != last or held == NODE:
                    node, held, last = node + 1, 0, k
                held += 1
                out.append(node)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "own"])

    return ranged.mapInArrow(run, "key long, v long, root long, n long, point binary, own long")


def node_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """key, x and y: the nodes of crowded cells that their bounds let meet."""

    def box(table: pa.Table) -> pa.Table:
        points = np.frombuffer(b"".join(table["point"].to_pylist()), np.uint8).reshape(-1, DIMS)
        n, root = table["n"].to_numpy(), table["root"].to_numpy()
        one = {"key": table["key"][0].as_py(), "own": table["own"][0].as_py(), "least": int(n.min()), "most": int(n.max())}
        one |= {"root": int(root[0]) if (root == root[0]).all() else None, "upper": points.max(axis=0).tobytes()}
        return pa.Table.from_pylist([one], schema=boxed)

    boxed = pa.schema(
        [("key", pa.int64()), ("own", pa.int64()), ("least", pa.int64()), ("most", pa.int64()), ("root", pa.int64()), ("upper", pa.binary())]
    )
    boxes = rows.groupBy("own").applyInArrow(box, "key long, own long, least long, most long, root long, upper binary")
    boxes = materialize(boxes, "nodes")
    x, y = boxes.alias("x"), boxes.alias("y")
    near = (F.col("x.key") == F.col("y.key")) & (F.col("x.own") <= F.col("y.own"))
    near &= (100 * F.col("x.most") >= percent * F.col("y.least")) & (100 * F.col("y.most") >= percent * F.col("x.least"))
    near &= ~F.coalesce(F.col("x.root") == F.col("y.root"), F.lit(False))
    pairs = x.join(y, near).select(
        "x.key", F.col("x.own").alias("x"), F.col("y.own").alias("y"),
        (F.col("x.least") + F.col("y.least")).alias("sizes"), F.col("x.upper").alias("p"), F.col("y.upper").alias("q"),
    )

    return _allowed(pairs, percent, "key long, x long, y long")


def distinct_cells(members: DataFrame) -> DataFrame:
    """key, v, in_cell, first and times: the members of cells, one of those that hold the very same sets.

    ``first`` is the cell's smallest set, ``times`` how many cells this one stands for: they all
    hold the same pairs.
    """
    hashes = [F.sum(F.xxhash64(F.lit(seed), "v").cast("decimal(20,0)")).alias(f"h{seed}") for seed in (1, 2)]
    cells = members.groupBy("key").agg(F.count(F.lit(1)).alias("in_cell"), F.min("v").alias("first"), *hashes)
    cells = cells.filter("in_cell > 1").groupBy("in_cell", "h1", "h2", "first")
    cells = cells.agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("times"))
    kept = members.select("key", "v").join(cells.select("key", "in_cell", "first", "times"), "key")
    return materialize(kept, "cells")


def one_large_cell(placed: DataFrame, turn: int) -> DataFrame:
    """For every set of ``placed`` (key, v, root, in_cell, first) one of its cells of more than ``FEW`` sets.

    The first in an order that all share and that changes with the turn, so like sets mostly choose alike.
    """
    large = placed.filter(F.col("in_cell") > FEW)
    chosen = large.groupBy("v", "root").agg(F.min_by("key", F.xxhash64(F.lit(turn), "key")).alias("key"))
    chosen = materialize(chosen, "chosen")
    sizes = chosen.groupBy("key").agg(F.count(F.lit(1)).alias("in_cell"), F.min("v").alias("first"))
    return chosen.join(sizes, "key")


def candidates(
    cells: DataFrame, points: DataFrame, roots: DataFrame, percent: int, node: int = NODE, turn: int | None = None
) -> DataFrame:
    """a, b and key: pairs of different components in a common cell that the tree's bounds let through.

    ``cells`` is :func:`distinct_cells`, ``points`` has v, n and point. With a ``turn`` every set is looked at
    in one large cell only and tells its best pair only.
    """
    best = turn is not None
    placed = cells.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    if best:
        placed = one_large_cell(placed, turn)
    placed = materialize(placed.select("key", "v", "root", "in_cell", "first"), "placed")
    several = placed.groupBy("key").agg((F.min("root") != F.max("root")).alias("several")).filter("several")
    rows = placed.join(several.select("key"), "key").join(points, "v")
    rows = materialize(rows.select("key", "v", "root", "n", "point", "in_cell", "first"), "open")
    none = F.lit(0).cast("long")
    # Small cells of the same first set go together, so that a pair that shares several is told once.
    small = rows.filter(F.col("in_cell") <= node)
    per_first = small.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts"))
    parted = per_first.filter("parts > 1")  # each of them has over GROUP rows
    small = small.join(parted, "first", "left").select(
        F.pmod(F.xxhash64("first", F.pmod("key", F.coalesce("parts", F.lit(1)))), F.lit(-(-rows.count() // GROUP) or 1)).alias("g"),
        "key", none.alias("x"), none.alias("y"), none.alias("own"), "v", "root", "n", "point",
    )
    schema = "a long, b long, key long, bound double"
    found = small.groupBy("g").applyInArrow(lambda t: surviving(t, percent, best), schema)
    crowded = rows.filter(F.col("in_cell") > node).drop("in_cell", "first")
    n_crowded = crowded.count()
    if n_crowded:
        nodes = materialize(in_nodes(crowded, n_crowded), "in-nodes")
        pairs = materialize(node_pairs(nodes, percent), "node-pairs")
        ends = pairs.withColumn("own", F.explode(F.array_distinct(F.array("x", "y"))))
        met = nodes.drop("key").join(ends, "own").select("key", "x", "y", "own", "v", "root", "n", "point")
        found = found.unionByName(met.groupBy("x", "y").applyInArrow(lambda t: surviving(t, percent, best), schema))
    if best:  # of the pairs that the nodes of a cell tell
        ends = F.explode(F.array(F.struct(F.col("a").alias("v"), "*"), F.struct(F.col("b").alias("v"), "*"))).alias("e")
        first = F.max(F.struct("e.bound", "e.key", "e.a", "e.b")).alias("e")
        found = found.select(ends).groupBy("e.v").agg(first).select("e.a", "e.b", "e.key")
    return found.groupBy("a", "b").agg(F.min("key").alias("key"))


def bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The rows of a, b and key whose points allow a link."""
    x = points.select(F.col("v").alias("a"), F.col("n").alias("n_a"), F.col("point").alias("p"))
    y = points.select(F.col("v").alias("b"), F.col("n").alias("n_b"), F.col("point").alias("q"))
    sizes = (F.col("n_a") + F.col("n_b")).alias("sizes")
    near = (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (F.col("a") != F.col("b"))
    both = pairs.join(x, "a").join(y, "b").filter(near).select("a", "b", "key", sizes, "p", "q")
    return _allowed(both, percent, "a long, b long, key long")


def _allowed(pairs: DataFrame, percent: int, schema: str) -> DataFrame:
    """The first three columns of the rows whose points p and q bound no link of two sets of ``sizes`` together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, DIMS) for c in ("p", "q")
            )
            ok = (100 + percent) * overlap_bound(p, q) >= percent * batch.column("sizes").to_numpy()
            yield batch.select([0, 1, 2]).filter(pa.array(ok, pa.bool_()))

    return pairs.mapInArrow(run, schema)


def verified(pairs: DataFrame, pool: DataFrame, roots: DataFrame | None, percent: int, words: int) -> DataFrame:
    """Of rows of a, b and key the pairs (a, b) whose full sets are linked.

    Pairs of one key are compared together, ``TEXTS`` by ``TEXTS``, and a text travels once
    to each such block. What a block has linked already, with the components in ``roots``,
    is not compared again, so the result has the components of all links, not every link.
    """
    pairs = materialize(pairs, "pairs")
    wide = pairs.groupBy("key").agg(F.count_distinct("a").alias("of_a"), F.count_distinct("b").alias("of_b"))
    wide = wide.select("key", *[F.ceil(F.col(c) / TEXTS).alias(c) for c in ("of_a", "of_b")])
    dealt = pairs.join(wide, "key").select(
        F.xxhash64("key", F.pmod(F.xxhash64("a"), "of_a"), F.pmod(F.xxhash64("b", F.lit(1)), "of_b")).alias("g"), "a", "b"
    )
    dealt = materialize(dealt, "dealt")
    ends = dealt.select(F.col("g").alias("to"), F.explode(F.array("a", "b")).alias("v")).distinct()
    if roots is not None:
        ends = ends.join(roots, "v", "left")
    else:
        ends = ends.withColumn("root", F.lit(None).cast("long"))
    ends = materialize(ends, "ends")  # its size tells whether the texts have to be shuffled to meet it
    texts = ends.join(pool, "v").select("to", "v", F.coalesce("root", "v").alias("root"), "text")

    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        ids = texts["v"].to_pylist()
        text_of = dict(zip(ids, utf8(texts["text"].combine_chunks()), strict=True))
        root_of = dict(zip(ids, texts["root"].to_pylist(), strict=True))
        above = {r: r for r in root_of.values()}
        known: dict[int, np.ndarray] = {}
        out = []

        def top(r: int) -> int:
            while above[r] != r:
                above[r] = above[above[r]]
                r = above[r]
            return r

        for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist(), strict=True):
            p, q = top(root_of[a]), top(root_of[b])
            if p == q:
                continue
            for v in (a, b):
                if v not in known:
                    known[v] = shingle_set(text_of[v], words)
            if linked(known[a], known[b], percent):
                above[p] = q
                out.append((a, b))
        return pa.table({"a": pa.array([o[0] for o in out], pa.int64()), "b": pa.array([o[1] for o in out], pa.int64())})

    return dealt.groupBy("g").cogroup(texts.groupBy("to")).applyInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, node: int = NODE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    ``docs`` has doc_id and text. Words are lower-cased (A-Z). Two documents are linked if
    100 * intersection >= ``percent`` * union of their sets of ``words``-word shingles;
    component_id is the smallest doc_id that can be reached. Texts that are null or without
    words have an empty set and are linked with nothing. Fewer words than a shingle has are one
    shingle. Rows that repeat a text are linked as copies. A null doc_id stays a row of its
    own with a null component and passes links on like any other. Further columns are not
    looked at; an empty table gives no rows.
    """
    signed = materialize(sign(docs, percent, words), "signed")
    sets = signed.filter("n_shingles > 0").groupBy(F.col("set_id").alias("v")).agg(
        F.min(F.struct("doc_id", "text_id")).alias("first"),
        F.min("doc_id").alias("rep"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("point").alias("point"),
    )
    sets = materialize(sets, "sets")
    cells = distinct_cells(materialize(shared_cells(signed), "members"))

    # The points and texts of sets that share a cell, one for each.
    wanted = sets.join(cells.select("v").distinct(), "v")
    points = materialize(wanted.select("v", F.col("n_shingles").alias("n"), "point"), "points")
    wanted = wanted.select("v", F.col("first.doc_id").alias("doc_id"), F.col("first.text_id").alias("text_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["text_id"] == wanted["text_id"])
    pool = texts.join(wanted, same).select("v", "text")
    again = signed.filter("n_shingles > 0").groupBy("doc_id", "text_id").agg(F.count(F.lit(1)).alias("rows"))
    if not again.filter("rows > 1").isEmpty():  # repeated rows
        pool = pool.dropDuplicates(["v"])
    pool = materialize(pool, "pool")

    # 1. Every set with the first set of most of its cells.
    votes = cells.filter("v <> first").groupBy("v", "first").agg(F.sum("times").alias("votes"))
    most = votes.groupBy("v").agg(F.max_by("first", F.struct("votes", "first")).alias("first"))
    stars = most.select(F.col("first").alias("a"), F.col("v").alias("b"), F.col("first").alias("key"))
    links = materialize(verified(bounded(stars, points, percent), pool, None, percent, words), "links")
    roots = components(links)

    # 2. Larger cells: every set with the partner of the largest bound, so that families grow together.
    for turn in range(ROUNDS if not cells.filter(F.col("in_cell") > FEW).isEmpty() else 0):
        near = materialize(candidates(cells, points, roots, percent, node, turn), "near")
        more = materialize(verified(near, pool, roots, percent, words), "links")
        if more.isEmpty():
            break
        links = materialize(links.unionByName(more), "links")
        roots = components(links)

    # 3. What cells of several components still hold.
    rest = candidates(cells, points, roots, percent, node)
    more = materialize(verified(rest, pool, roots, percent, words), "links")
    if not more.isEmpty():
        roots = components(links.unionByName(more))

    named = sets.select("v", "rep").join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    named = materialize(named, "named")
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "root").select(F.col("v").alias("set_id"), "component_id")
    out = signed.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
