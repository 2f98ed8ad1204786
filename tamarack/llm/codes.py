"""Vector codes by Lloyd's method with active entries.

Vectors become whole numbers and are cut into consecutive parts; every part position has
a codebook. A round assigns each part to its nearest entry and then moves every used entry
to the floor of its parts' mean. What a part was assigned to, and how far that was, is
stored. If that entry stayed where it was, no other entry that stayed can have come
nearer, so only the entries that moved are compared with the stored distance; a part whose
entry moved is compared with all. Ties go to the lower index either way.

A round reads the table of the round before and writes its own; of these no more than two
exist at a time. Entry sums are made in the tasks; the driver sees one row per entry and
component, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.operators.joins import join_lookup
from tamarack.session import materialize, scratch_path, spread

PARTS = 4
ENTRIES = 256
ROUNDS = 4
FACTOR = 1024
STRIP = 4096  # vectors whose distances are held at once
EXACT = 2**53  # whole numbers below are exact in double precision


def whole(vector: str, factor: int, limit: int) -> Column:
    """floor(factor * x) of every component, no further from 0 than ``limit``."""
    scaled = lambda x: x.cast("double") * F.lit(float(factor))
    held = lambda x: F.least(F.greatest(scaled(x), F.lit(-float(limit))), F.lit(float(limit)))
    return F.transform(F.col(vector), lambda x: F.floor(held(x)).cast("int"))


def largest(dim: int) -> int:
    """The largest component with which the squared distance of two vectors is a long."""
    return min(2**31 - 1, math.isqrt(2**62 // max(dim, 1)) // 2)


def cuts(dim: int, parts: int) -> list[slice]:
    """The places of every part; of equal length where ``dim`` allows it."""
    ends = [j * dim // parts for j in range(parts + 1)]
    return [slice(a, b) for a, b in zip(ends, ends[1:], strict=False)]


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of two tables of whole numbers, exactly."""
    reach = sum(int(np.abs(t).max()) if t.size else 0 for t in (x, entries))
    if x.shape[1] * reach * reach < EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for c in range(x.shape[1]):
        apart = x[:, c, None].astype(np.int64) - entries[:, c].astype(np.int64)
        out += apart * apart
    return out


def nearest_of(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every row, the lowest of several, and its distance."""
    at, far = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for lo in range(0, len(x), STRIP):
        d = distances(x[lo : lo + STRIP], entries)
        best = d.argmin(1)
        at[lo : lo + STRIP], far[lo : lo + STRIP] = best, d[np.arange(len(d)), best]
    return at, far


def reassigned(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray, far: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``nearest_of(x, entries)`` from an assignment made before some entries moved."""
    at, far = at.copy(), far.copy()
    again = moved[at]
    if again.any():
        at[again], far[again] = nearest_of(x[again], entries)
    active, fixed = np.flatnonzero(moved), np.flatnonzero(~again)
    if len(active) and len(fixed):
        near, d = nearest_of(x[fixed], entries[active])
        near = active[near]
        closer = (d < far[fixed]) | ((d == far[fixed]) & (near < at[fixed]))
        at[fixed[closer]], far[fixed[closer]] = near[closer], d[closer]
    return at, far


def _numbers(column: pa.Array, dim: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dim)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel(), kind))


def assigned(rows: DataFrame, books: list[np.ndarray], moved: list[np.ndarray] | None) -> DataFrame:
    """Rows of key, tag and x with at and far: entry and squared distance of every part.

    Without ``moved`` every part is compared with all entries; else the rows carry the
    assignment of the round before, and ``moved`` marks the entries that changed since.
    """
    places = cuts(sum(b.shape[1] for b in books), len(books))
    dim = places[-1].stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = _numbers(batch.column("x"), dim, np.int32)
            at, far = np.zeros((n, len(books)), np.int64), np.zeros((n, len(books)), np.int64)
            if moved is not None:
                at = _numbers(batch.column("at"), len(books), np.int64)
                far = _numbers(batch.column("far"), len(books), np.int64)
                at, far = at.copy(), far.copy()
            for j, (place, entries) in enumerate(zip(places, books, strict=True)):
                part = x[:, place]
                if moved is None:
                    at[:, j], far[:, j] = nearest_of(part, entries)
                else:
                    at[:, j], far[:, j] = reassigned(part, entries, moved[j], at[:, j], far[:, j])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("tag"), batch.column("x"),
                 _lists(at.astype(np.int32), pa.int32()), _lists(far, pa.int64())],
                names=["key", "tag", "x", "at", "far"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"key {kinds['key']}, tag {kinds['tag']}, x array<int>, at array<int>, far array<bigint>"
    return rows.mapInArrow(run, schema)


def entry_sums(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """part, entry, place, n and total: how many parts an entry has, and the sum of a component."""
    places = cuts(sum(b.shape[1] for b in books), len(books))
    dim = places[-1].stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            x = _numbers(batch.column("x"), dim, np.int64)
            at = _numbers(batch.column("at"), len(books), np.int64)
            if not len(x):
                continue
            for j, place in enumerate(places):
                order = np.argsort(at[:, j], kind="stable")
                entry, first, n = np.unique(at[order, j], return_index=True, return_counts=True)
                counts[j][entry] += n
                if place.stop > place.start:
                    sums[j][entry] += np.add.reduceat(x[order, place], first, axis=0)
        for j in range(len(books)):
            used = np.flatnonzero(counts[j])
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), j, np.int32)), pa.array(used.astype(np.int32)),
                     pa.array(counts[j][used]), _lists(sums[j][used], pa.int64())],
                    names=["part", "entry", "n", "sums"],
                )

    partial = rows.select("x", "at").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    each = partial.select("part", "entry", "n", F.posexplode("sums").alias("place", "s"))
    return each.groupBy("part", "entry", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("total")
    )


def improved(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Every used entry at the floor of its parts' mean; others stay. Collects one row per entry and component."""
    out = [b.copy() for b in books]
    for r in entry_sums(rows, books).collect():
        out[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return out


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, "codes")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _dropped(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
    """Codebooks after ``rounds`` rounds and the table (key, tag, x, at, far) of the last assignment.

    ``rows`` has key, tag and x, whole numbers of one length. The codebooks start as the
    parts of the ``entries`` smallest keys (null keys last, equal ones by x), or of all rows
    if there are fewer. None and an empty table where there are no rows.
    """
    first = rows.orderBy(F.col("key").asc_nulls_last(), "x").limit(entries).select("x").collect()
    if not first:
        none = rows.select("*", F.lit(None).cast("array<int>").alias("at"), F.lit(None).cast("array<bigint>").alias("far"))
        return None, none
    start = np.array([r["x"] for r in first], np.int32).reshape(len(first), -1)
    books = [start[:, place].astype(np.int64) for place in cuts(start.shape[1], parts)]
    state, path = _written(assigned(rows, books, None))
    for _ in range(rounds):
        better = improved(state, books)
        moved = [(a != b).any(axis=1) for a, b in zip(books, better, strict=True)]
        books = better
        if any(m.any() for m in moved):
            before = path
            state, path = _written(assigned(state, books, moved))
            _dropped(rows.sparkSession, before)
    return books, state


def fingerprint(books: list[np.ndarray] | None) -> str:
    """Lowercase hex SHA-256 of all entries' decimal components by part, entry and place."""
    numbers = "" if books is None else ",".join(str(v) for b in books for v in b.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def encode(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    factor: int = FACTOR,
) -> DataFrame:
    """``key``, code, error, label_error and codebooks_sha256 of every row with a usable vector.

    Rows whose vector is null or holds null, NaN or infinite components are left out. Codebooks
    are made of the vectors of the commonest length above 0 (the shorter one of several); rows of
    another length are returned with null code and error. A length that ``parts`` does not divide
    is cut into parts as equal as possible. Repeated keys and rows stay rows of their own; null
    keys come last. label_error sums the errors of all rows with an equal label, nulls together,
    and is null beyond the range of a long. Components whose whole number is beyond
    :func:`largest` (2^27 for 64 components) are held there. No rows give no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index is one byte: 1 to 256 entries")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.select(key, label, vector).filter(F.col(vector).isNotNull() & ~odd)
    lengths = usable.groupBy(F.size(vector).alias("dim")).count().filter("dim > 0")
    dim = lengths.orderBy(F.desc("count"), "dim").select("dim").first()
    dim = dim[0] if dim else 0
    rows = usable.select(
        F.col(key).alias("key"),
        F.col(label).alias("tag"),
        F.when(F.size(vector) == dim, whole(vector, factor, largest(dim))).alias("x"),
    )
    rows = materialize(spread(rows, "key"), "vectors")
    fitting = rows.filter(F.size("x") == dim) if dim else rows.filter(F.lit(False))
    books, state = train(fitting, parts, entries, rounds)
    code = F.concat(*[F.lpad(F.lower(F.hex(F.get("at", F.lit(j)))), 2, "0") for j in range(parts)])
    error = F.aggregate("far", F.lit(0).cast("bigint"), lambda s, d: s + d)
    coded = state.select("key", "tag", code.alias("code"), error.alias("error"))
    others = rows.filter(F.col("x").isNull() | (F.lit(dim) == 0))
    coded = coded.unionByName(
        others.select("key", "tag", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    )
    coded = coded.withColumn("__label", F.to_json(F.struct("tag")))  # a null tag is a value too
    totals = materialize(coded.groupBy("__label").agg(F.try_sum("error").alias("label_error")), "totals")
    named = join_lookup(coded, totals, ["__label"], "left")
    return named.select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256")
    )
