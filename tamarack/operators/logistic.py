"""Multinomial logistic regression, fitted by few passes over packed rows.

Rows are written once as blocks of numbers: the columns that most rows have as a matrix, all others
sparse. A step sends the coefficients to every task and one gradient a task back. Steps are those of
L-BFGS that start from the curvature itself: whole for intercepts and common columns, which are few and
hang together, and the diagonal for all others. So classes that can nearly be told apart, for which
coefficients grow for long, take tens of steps and not hundreds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators.boosting import entries, softmax
from tamarack.operators.kmeans import products
from tamarack.session import materialize

BLOCK_ROWS = 1 << 16  # rows of a block
PART_VALUES = 1 << 25  # values that are not zero in the rows of a task
WHOLE = 256  # intercepts and coefficients whose curvature is kept whole, at most
MEMORY = 6  # steps remembered
REFRESH = 8  # steps after which the curvature is taken anew
TOLERANCE = 1e-6  # done when the last steps have gained less than this part of the first loss ...
HISTORY = 20  # ... and there were this many, as in MLlib

BLOCK = "n int, label binary, matrix binary, ends binary, places binary, row_values binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Labels, common columns, offsets, places and values of every block; no values if all are ones."""
    for batch in batches:
        for r in range(batch.num_rows):
            n, *held = (c[r] for c in batch.columns)
            n = n.as_py()
            label, matrix, ends, places, values = (
                np.frombuffer(b.as_buffer(), kind)
                for b, kind in zip(held, (np.int32, np.float64, np.int64, np.int32, np.float64), strict=True)
            )
            values = values if len(values) else np.ones(len(places))
            yield label, matrix.reshape(n, -1), np.append(0, ends), places, values


def _block(label: np.ndarray, matrix: np.ndarray, row: np.ndarray, place: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    ends = np.cumsum(np.bincount(row, minlength=len(label)))
    value = np.zeros(0) if (value == 1).all() else value
    kinds = ((label, np.int32), (matrix, np.float64), (ends, np.int64), (place, np.int32), (value, np.float64))
    out = [pa.array([x.astype(kind).tobytes()], pa.binary()) for x, kind in kinds]
    return pa.RecordBatch.from_arrays([pa.array([len(label)], pa.int32()), *out], names=[c.split()[0] for c in BLOCK.split(", ")])


def _pack(train: DataFrame, label: str, features: str, parts: int) -> DataFrame:
    """The rows as blocks without common columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            row, place, value = entries(batch.column(1))
            order = np.lexsort((place, row))
            held.append((batch.column(0).to_numpy(zero_copy_only=False), row[order] + n, place[order], value[order]))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield packed(held)
                held, n = [], 0
        if n:
            yield packed(held)

    def packed(held: list) -> pa.RecordBatch:
        label, row, place, value = (np.concatenate(x) for x in zip(*held, strict=True))
        return _block(label, np.zeros((len(label), 0)), row, place, value)

    rows = train.select(F.col(label).cast("int").alias("label"), F.unwrap_udt(features).alias("features"))
    dealt = rows.repartition(parts, F.xxhash64("features", "label"))
    return materialize(dealt.mapInArrow(run, BLOCK), "blocks")


def _added(blocks: DataFrame, size: int, run) -> np.ndarray:
    """The sum over all tasks of the ``size`` numbers that ``run`` makes of the blocks of a task."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([run(_read(batches)).tobytes()], pa.binary())], names=["sums"])

    total = np.zeros(size)
    for chunk in blocks.mapInArrow(one, "sums binary").toArrow()["sums"].chunks:
        for b in chunk:
            total += np.frombuffer(b.as_buffer())
    return total


def _split_columns(blocks: DataFrame, common: np.ndarray, size: int) -> DataFrame:
    """The blocks with the columns ``common`` as a matrix."""
    at = np.full(size, -1, np.int32)
    at[common] = np.arange(len(common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, _, offsets, places, values in _read(batches):
            row, own = np.repeat(np.arange(len(label)), np.diff(offsets)), at[places]
            matrix = np.zeros((len(label), len(common)))
            matrix[row[own >= 0], own[own >= 0]] = values[own >= 0]
            rest = own < 0
            yield _block(label, matrix, row[rest], places[rest], values[rest])

    return materialize(blocks.mapInArrow(run, BLOCK), "blocks")


class Loss:
    """The mean loss of all rows plus half the squares of all coefficients by the number of rows.

    Coefficients are one array: a row of classes per column of the vectors, and one of intercepts at the end.
    """

    def __init__(self, blocks: DataFrame, n: int, size: int, classes: int, common: np.ndarray):
        self.blocks, self.n, self.size, self.classes, self.common = blocks, n, size, classes, common

    def sums(self, at: np.ndarray, curved: bool) -> tuple[float, np.ndarray, np.ndarray | None, np.ndarray | None]:
        """Loss and gradient; with ``curved`` the diagonal of the curvature and its whole part, too."""
        size, k, common, whole = self.size, self.classes, self.common, (len(self.common) + 1) * self.classes
        sent = self.blocks.sparkSession.sparkContext.broadcast(at)

        def run(blocks: Iterator[tuple[np.ndarray, ...]]) -> np.ndarray:
            w, loss = sent.value, 0.0
            gradient = np.zeros((size + 1, k))
            diagonal, full = np.zeros((size + 1, k)) if curved else None, np.zeros((whole, whole)) if curved else None
            for label, matrix, offsets, places, values in blocks:
                line = np.arange(len(label))
                row = np.repeat(line, np.diff(offsets))
                p = softmax(products(offsets, places, values, w) + matrix @ w[common] + w[size])
                loss -= np.log(np.maximum(p[line, label], 1e-300)).sum()
                if curved:
                    for i in range(k):
                        diagonal[:size, i] += np.bincount(places, values * values * (p[:, i] * (1 - p[:, i]))[row], minlength=size)
                    dense = np.column_stack([matrix, np.ones(len(label))])
                    for i in range(k):
                        for j in range(i + 1):
                            cell = (dense * (p[:, i] * ((i == j) - p[:, j]))[:, None]).T @ dense
                            full[i::k, j::k] += cell
                            if i != j:
                                full[j::k, i::k] += cell
                p[line, label] -= 1
                for i in range(k):
                    gradient[:size, i] += np.bincount(places, values * p[row, i], minlength=size)
                gradient[common] += matrix.T @ p
                gradient[size] += p.sum(0)
            held = [gradient.ravel(), *([diagonal.ravel(), full.ravel()] if curved else [])]
            return np.concatenate([[loss], *held])

        cells = (size + 1) * k
        total = _added(self.blocks, 1 + cells + (cells + whole * whole if curved else 0), run) / self.n
        sent.destroy()
        own = at[:size]
        gradient = total[1 : 1 + cells].reshape(-1, k)
        gradient[:size] += own / self.n
        loss = float(total[0] + (own * own).sum() / (2 * self.n))
        if not curved:
            return loss, gradient, None, None
        diagonal = total[1 + cells : 1 + 2 * cells].reshape(-1, k) + 1 / self.n
        full = total[1 + 2 * cells :].reshape(whole, whole)
        # Intercepts have no weight, and all of them may move together; a trace keeps the matrix regular.
        full += np.diag(np.repeat([1 / self.n] * len(common) + [1e-3 / self.n], k))
        return loss, gradient, diagonal, full

    def solve(self, gradient: np.ndarray, diagonal: np.ndarray, full: np.ndarray) -> np.ndarray:
        """The step that the curvature gives for a gradient."""
        out = gradient / diagonal
        rows = np.append(self.common, self.size)
        out[rows] = np.linalg.solve(full, gradient[rows].ravel()).reshape(-1, self.classes)
        return out


def minimum(loss: Loss, at: np.ndarray, max_iter: int) -> tuple[np.ndarray, list[float]]:
    """Where the loss is least, by L-BFGS on the curvature, and the loss after every step."""
    value, gradient, diagonal, full = loss.sums(at, True)
    values, steps = [value], []
    while len(values) <= max_iter:
        q, used = gradient.copy(), []
        for s, y, rho in reversed(steps):
            used.append(rho * (s * q).sum())
            q -= used[-1] * y
        q = loss.solve(q, diagonal, full)
        for (s, y, rho), a in zip(steps, reversed(used), strict=True):
            q += (a - rho * (y * q).sum()) * s
        slope, length = -(gradient * q).sum(), 1.0
        if slope >= -1e-15 * abs(value):
            break
        curved = len(values) % REFRESH == 0 or len(values) < 4
        while True:
            found = loss.sums(at - length * q, curved)
            if found[0] <= value + 1e-4 * length * slope:
                break
            drop = found[0] - value - length * slope
            length *= float(np.clip(-slope * length / (2 * drop), 0.1, 0.5)) if np.isfinite(drop) and drop > 0 else 0.1
            if length < 1e-10:
                return at, values
        y = found[1] - gradient
        s = -length * q
        if (s * y).sum() > 0:
            steps = [*steps[1 - MEMORY :], (s, y, 1 / (s * y).sum())]
        at, (value, gradient) = at + s, found[:2]
        if curved:
            diagonal, full = found[2:]
        values.append(value)
        if len(values) > HISTORY and values[-1 - HISTORY] - value <= TOLERANCE * values[0]:
            break
    return at, values


def fit(train: DataFrame, label: str, max_iter: int, features: str = "features") -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Coefficients (classes by columns), intercepts and the loss of every step, with an L2 weight of one over all rows.

    ``label`` holds whole numbers from 0.
    """
    vector, y = F.unwrap_udt(features), F.col(label)
    size = F.coalesce(vector["size"], F.size(vector["values"]))
    odd = y.isNull() | (y < 0) | (y != F.floor(y))
    n, bad, top, width, held = train.agg(
        F.count(F.lit(1)), F.count_if(odd), F.max(y), F.max(size), F.sum(F.size(vector["values"]).cast("bigint"))
    ).first()
    if not n or bad:
        raise ValueError(f"labels must be whole numbers from 0: {bad} of {n} rows are not")
    classes, parts = int(top) + 1, max(train.sparkSession.sparkContext.defaultParallelism, -(-held // PART_VALUES))
    blocks = _pack(train, label, features, parts)

    def counted(blocks: Iterator[tuple[np.ndarray, ...]]) -> np.ndarray:
        out = np.zeros(width + classes)
        for own, _, _, places, _ in blocks:
            out += np.concatenate([np.bincount(places, minlength=width), np.bincount(own, minlength=classes)])
        return out

    counts = _added(blocks, width + classes, counted)
    often = np.argsort(-counts[:width], kind="stable")[: max(0, WHOLE // classes - 1)]
    common = np.sort(often[counts[often] * 4 > n])
    loss = Loss(_split_columns(blocks, common, width), n, width, classes, common)
    at = np.zeros((width + 1, classes))
    at[width] = np.log1p(counts[width:])
    at[width] -= at[width].mean()
    at, values = minimum(loss, at, max_iter)
    return at[:width].T, at[width] - at[width].mean(), values
