"""Near duplicates by an LSH forest of MinHash signatures.

A document is the set of its five-word shingles. Each tree of the forest orders the
sets by a label of several MinHash values, so sets that share a long label prefix
stand side by side. A region is the sets that share a prefix of ``MIN_DEPTH`` values.

1. Every set is linked with the neighbour of longest common prefix that most trees
   agree on, if their full sets are similar enough. Only here crowded regions are taken
   apart by longer prefixes.
2. In regions that still hold several components, however large they are, sets of
   different components whose signatures agree are compared on their full sets, block by
   block, until nothing is left that could join two components.

All copies of a set are one vertex, so copies cost nothing beyond the first count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tamarack.llm.components import components
from tamarack.llm.words import WORD, gram_hashes, mixed, utf8, word_hashes
from tamarack.session import materialize

WORDS = 5
PERCENT = 85
TREES = 16
DEPTH = 8  # MinHash values in a label
MIN_DEPTH = 4
DEPTHS = (4, 6, 8)
CROWDED = 4096  # sets in a region, beyond which neighbours are looked for deeper
BLOCK = 256  # sets that are compared with as many at once
SLACK = 0.15  # how far a signature may fall short of the similarity: 4.7 standard errors
PART = 256  # documents whose hashes are held at once

_RANDOM = np.random.default_rng(20240229)
_XOR = _RANDOM.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)
_ODD = _RANDOM.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of fewer words the whole sequence; none without words."""
    hashes = word_hashes(WORD.findall(text.lower())) if text else np.zeros(0, np.uint64)
    return np.unique(gram_hashes(hashes, min(words, len(hashes)) or 1))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16-bit MinHash values of sets that are not empty, a row per set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), TREES * DEPTH), np.uint16)
    for j in range(TREES * DEPTH):
        least = np.minimum.reduceat((flat ^ _XOR[j]) * _ODD[j], starts)
        out[:, j] = (mixed(least) >> np.uint64(48)).astype(np.uint16)
    return out


def packed(values: np.ndarray) -> np.ndarray:
    """Four 16-bit values to a long, the first one in front: two longs to a tree's label."""
    v = values.reshape(len(values), -1, 4).astype(np.uint64)
    longs = (v[..., 0] << np.uint64(48)) | (v[..., 1] << np.uint64(32)) | (v[..., 2] << np.uint64(16)) | v[..., 3]
    return longs.view(np.int64)


def sign(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, text_id, n_shingles, set_id and label longs of every row; no label for an empty set."""
    schema = "doc_id long, text_id long, n_shingles long, set_id long, labels array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, PART):
                part = batch.slice(lo, PART)
                sets = [shingles(t, words) for t in utf8(part.column(2))]
                full = [s for s in sets if len(s)]
                longs = iter(packed(signatures(full)) if full else ())
                ids = [xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array(ids, np.uint64).view(np.int64)),
                        pa.array([next(longs) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_id", "n_shingles", "set_id", "labels"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    return rows.mapInArrow(run, schema)


def _prefix(depth: int) -> list[Column]:
    """The first ``depth`` values (4 to 8) of a label."""
    if depth == MIN_DEPTH:
        return [F.col("k1")]
    return [F.col("k1"), F.shiftright("k2", 16 * (8 - depth))]


def _placed(labels: DataFrame, depth: int) -> DataFrame:
    """Rows of v, tree, k1 and k2 with their region, its size and its smallest set; none that stand alone."""
    rows = labels.withColumn("region", F.xxhash64(F.lit(depth), "tree", *_prefix(depth)))
    sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("pivot")).filter("n > 1")
    return materialize(rows.join(sizes, "region"), "regions")


def whole_regions(sets: DataFrame) -> DataFrame:
    """region, v, tree, k1, k2, n and pivot: the sets (v) that share a prefix of ``MIN_DEPTH`` with another, by tree."""
    trees = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.struct(
            t.alias("tree"), F.get("labels", 2 * t).alias("k1"), F.get("labels", 2 * t + 1).alias("k2")
        ),
    )
    labels = sets.select("v", F.explode(trees).alias("label")).select("v", "label.*")
    return _placed(labels, MIN_DEPTH)


def taken_apart(whole: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """The regions with those of more than ``crowded`` sets taken apart by more values, down to the full label."""
    done, placed = None, whole
    for depth in DEPTHS:
        if depth != MIN_DEPTH:
            placed = _placed(placed.filter(F.col("n") > crowded).select("v", "tree", "k1", "k2"), depth)
        last = depth == DEPTHS[-1]
        ready = (placed if last else placed.filter(F.col("n") <= crowded)).select("region", "v", "k2", "n", "pivot")
        done = ready if done is None else done.unionByName(ready)
        if last or placed.filter(F.col("n") > crowded).isEmpty():
            return done


def regions(sets: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """region, v, k2, n and pivot: the sets (v) that share a prefix with another, by tree.

    A region of more than ``crowded`` sets is taken apart by more values, down to the
    full label; ``n`` is its size, ``pivot`` its smallest set.
    """
    return taken_apart(whole_regions(sets), crowded)


def neighbours(members: DataFrame, slices: int) -> DataFrame:
    """v and partner: the set next to it in the order of a tree, for most trees.

    The order of all regions is dealt out in ranges, so a large region is spread over
    many tasks; the first set of a range is paired with the region's pivot.
    """
    ranged = members.repartitionByRange(slices, "region", "k2", "v").withColumn("__slice", F.spark_partition_id())
    order = Window.partitionBy("__slice", "region").orderBy("k2", "v")
    pairs = ranged.select("v", F.coalesce(F.lag("v").over(order), "pivot").alias("partner")).filter("v <> partner")
    votes = pairs.groupBy("v", "partner").agg(F.count(F.lit(1)).alias("votes"))
    return votes.groupBy("v").agg(F.max_by("partner", F.struct("votes", "partner")).alias("partner"))


def _verified(pairs: DataFrame, percent: int, words: int) -> DataFrame:
    """Of rows (a, b, text_a, text_b) the pairs whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similar(shingles(x, words), shingles(y, words), percent)
                for x, y in zip(utf8(batch.column(2)), utf8(batch.column(3)), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Rows of region, v and root, once for each pair of blocks (x <= y) of the region that they are in.

    A component (root) of more than a block that is the largest of its region has blocks of
    its own, which come first and are not paired with each other: they hold no two components.
    """
    roots = members.groupBy("region", "root").agg(F.count(F.lit(1)).alias("__rows"))
    size = roots.groupBy("region").agg(
        F.sum("__rows").alias("__n"),
        F.max(F.struct("__rows", "root")).alias("__most"),
    )
    most, rows = F.col("__most.root"), F.col("__most.__rows")
    apart = rows > block
    size = size.filter(F.col("__n") > rows).select(
        "region",
        F.when(apart, most).alias("__major"),
        F.when(apart, F.ceil(rows / block)).otherwise(0).cast("int").alias("__first"),
        F.ceil((F.col("__n") - F.when(apart, rows).otherwise(0)) / block).cast("int").alias("__rest"),
    )
    dealt = members.join(size, "region")
    major = F.coalesce(F.col("root") == F.col("__major"), F.lit(False))
    first, rest = F.col("__first"), F.col("__rest")
    own = F.when(major, F.pmod(F.xxhash64("v"), first)).otherwise(first + F.pmod(F.xxhash64("v"), rest)).cast("int")
    others = F.sequence(F.when(major, first).otherwise(F.lit(0)), first + rest - 1)
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(others))
    return dealt.select(
        "*", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")
    ).drop("__major", "__first", "__rest", "other")


def _pairs_of(table: pa.Table, least: float, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows between the two blocks of a group: of different components, of signatures that
    agree in at least ``least`` of the values, and of sizes that allow it; the most alike first."""

    def column(name: str) -> np.ndarray:
        return table[name].to_numpy()

    labels = table["labels"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    values = np.ascontiguousarray(labels).view(np.uint16)
    root, n, own = column("root"), column("n_shingles"), column("own")
    x, y = column("x")[0], column("y")[0]
    left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
    found_l, found_r, found_s = [], [], []
    for lo in range(0, len(left), 32):
        i = left[lo : lo + 32]
        alike = (values[i][:, None, :] == values[right][None]).mean(2)
        small, large = np.minimum(n[i][:, None], n[right]), np.maximum(n[i][:, None], n[right])
        ok = (alike >= least) & (root[i][:, None] != root[right]) & (100 * small >= percent * large)
        if x == y:
            ok &= i[:, None] < right
        p, q = np.nonzero(ok)
        found_l.append(i[p])
        found_r.append(right[q])
        found_s.append(alike[p, q])
    if not found_l:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    a, b, s = np.concatenate(found_l), np.concatenate(found_r), np.concatenate(found_s)
    order = np.argsort(-s, kind="stable")
    return a[order], b[order], s[order]


def near_components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, crowded: int = CROWDED, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    ``docs`` has doc_id and text. Words are lower-cased (A-Z). Two documents are linked
    if 100 * intersection >= ``percent`` * union of their shingle sets; component_id is the
    smallest doc_id that can be reached. Texts that are null or without words have an
    empty set and are linked with nothing. Fewer words than a shingle has are one
    shingle. Rows that repeat a text are linked as copies. A null doc_id stays a row of
    its own with a null component, not kept, and passes links on like any other.
    """
    spark = docs.sparkSession
    least = percent / 100 - SLACK
    signed = materialize(sign(docs, words), "signed")
    sets = signed.filter("n_shingles > 0").groupBy(F.col("set_id").alias("v")).agg(
        F.min(F.struct("doc_id", "text_id")).alias("first"),
        F.min("doc_id").alias("rep"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("labels").alias("labels"),
    )
    sets = materialize(sets, "sets")
    members = whole_regions(sets)
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partners = materialize(neighbours(taken_apart(members, crowded), slices), "partners")

    # The texts of sets that stand in a region, one for each.
    wanted = sets.select("v", F.col("first.doc_id").alias("doc_id"), F.col("first.text_id").alias("text_id"))
    wanted = wanted.join(members.select("v").distinct(), "v")
    wanted = wanted.join(partners, "v", "left")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["text_id"] == wanted["text_id"])
    pool = texts.join(wanted, same).select(texts["doc_id"], texts["text_id"], "v", "partner", "text")
    pool = materialize(pool.dropDuplicates(["doc_id", "text_id"]).select("v", "partner", "text"), "pool")

    # 1. Neighbours.
    other = pool.select(F.col("v").alias("partner"), F.col("text").alias("text_b"))
    pairs = pool.filter("partner IS NOT NULL").join(other, "partner")
    links = _verified(pairs.select(F.col("v").alias("a"), F.col("partner").alias("b"), F.col("text").alias("text_a"), "text_b"), percent, words)
    roots = components(materialize(links, "links"))

    # 2. What regions of several components still hold.
    placed = members.select("region", "v").join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    placed = materialize(placed, "placed")
    mixed_regions = placed.groupBy("region").agg((F.min("root") != F.max("root")).alias("several")).filter("several")
    open_rows = placed.join(mixed_regions.select("region"), "region")
    labelled = open_rows.join(sets.select("v", "n_shingles", "labels"), "v")

    def active(table: pa.Table) -> pa.Table:
        a, b, _ = _pairs_of(table, least, percent)
        return table.select(["region", "v", "root", "n_shingles", "labels"]).take(pa.array(np.unique(np.concatenate([a, b]))))

    schema = "region long, v long, root long, n_shingles long, labels array<long>"
    asked = _blocks(labelled, block).groupBy("region", "x", "y").applyInArrow(active, schema)
    asked = materialize(asked.dropDuplicates(["region", "v"]), "asked")

    def joined(table: pa.Table) -> pa.Table:
        a, b, _ = _pairs_of(table, least, percent)
        ids, root, texts = table["v"].to_numpy(), table["root"].to_numpy(), utf8(table["text"].combine_chunks())
        above = {r: r for r in root.tolist()}

        def top(r: int) -> int:
            while above[r] != r:
                above[r] = above[above[r]]
                r = above[r]
            return r

        known: dict[int, np.ndarray] = {}
        out = []
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            p, q = top(int(root[i])), top(int(root[j]))
            if p == q:
                continue
            for k in (i, j):
                if k not in known:
                    known[k] = shingles(texts[k], words)
            if similar(known[i], known[j], percent):
                above[p] = q
                out.append((int(ids[i]), int(ids[j])))
        return pa.table({"a": pa.array([o[0] for o in out], pa.int64()), "b": pa.array([o[1] for o in out], pa.int64())})

    full = _blocks(asked, block).join(pool.select("v", "text"), "v")
    more = materialize(full.groupBy("region", "x", "y").applyInArrow(joined, "a long, b long"), "links")

    if not more.isEmpty():  # components of components
        root_of = roots.select(F.col("v"), F.col("root"))
        for end in ("a", "b"):
            at = root_of.select(F.col("v").alias(end), F.col("root").alias(f"root_{end}"))
            more = more.join(at, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
        upper = components(more.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
        upper = upper.select(F.col("v").alias("low"), F.col("root").alias("high"))
        every = sets.select("v").join(roots, "v", "left").select("v", F.coalesce("root", "v").alias("low"))
        roots = every.join(upper, "low", "left").select("v", F.coalesce("high", "low").alias("root"))
        roots = materialize(roots.filter("v <> root").union(upper.select("high", "high").distinct()).distinct(), "roots")

    named = sets.select("v", "rep").join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    named = materialize(named, "named")
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = materialize(named.join(smallest, "root").select(F.col("v").alias("set_id"), "component_id"), "components")
    out = signed.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    alone = F.col("n_shingles") == 0
    out = out.withColumn("component_id", F.when(alone, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
