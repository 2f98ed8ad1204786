"""Quality classifier: a factorization machine over hashed words and structure.

    score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

The pairwise sum is taken in time linear in the number of features that are not
zero: for each factor f it is ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2) / 2.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.words import WORD, utf8, word_hashes

BUCKETS = 4096  # hashed words
FACTORS = 8
TRAIN_ROWS = 6000  # labelled rows that the machine is fitted on, at most
EPOCHS = 20
BATCH = 256
HELD_OUT_OF = 5
THRESHOLD = 0.3

_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_MARKS = b".,;:'\"()?-"
_SYMBOLS = bytes(b for b in range(33, 127) if bytes([b]) not in (_DIGITS + _UPPER + _LOWER + _MARKS) and not chr(b).isalnum())
_LINE = re.compile(rb"[^\n]+")
STRUCTURE = 16  # numbers about the form of a text, see structure()


def structure(body: bytes, words: list[bytes], hashes: np.ndarray, n_chars: int) -> list[float]:
    """Numbers about the form of a text, and its length as the table states it."""
    size, n = max(len(body), 1), max(len(words), 1)

    def share(chars: bytes) -> float:
        return (len(body) - len(body.translate(None, chars))) / size

    lines = _LINE.findall(body)
    counts = np.unique(hashes, return_counts=True)[1] if len(hashes) else np.zeros(1)
    same = float((hashes[1:] == hashes[:-1]).mean()) if len(hashes) > 1 else 0.0
    return [
        np.log1p(len(words)),
        len(body) / n,
        max(map(len, words), default=0) ** 0.5,
        share(_DIGITS),
        share(_UPPER),
        share(_LOWER),
        share(_MARKS),
        share(_SYMBOLS),
        share(b"!"),
        np.log1p(len(lines)),
        len(set(lines)) / max(len(lines), 1),
        len(counts) / n if len(hashes) else 0.0,
        float(counts.max()) / n,
        same,
        np.log1p(max(n_chars, 0)),
        float(not words),
    ]


def features(body: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Buckets of a text's words, their weights (of length 1 together), and its structure."""
    body = body or b""
    words = WORD.findall(body.lower())
    hashes = word_hashes(words)
    counts = np.bincount((hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    weights = np.log1p(counts[at])
    norm = np.sqrt((weights**2).sum())
    given = len(body) if n_chars is None else int(n_chars)
    return at, weights / norm if norm else weights, structure(body, words, hashes, given)


@dataclass(frozen=True)
class Machine:
    """Fitted weights; the structure's numbers come after the ``BUCKETS`` hashed words."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def score(self, at: np.ndarray, weights: np.ndarray, form: list[float]) -> float:
        shaped = np.clip((np.asarray(form) - self.mean) / self.scale, -4, 4) / 4
        linear, v = self.linear, self.factors
        total = self.bias + linear[at] @ weights + linear[BUCKETS:] @ shaped
        summed = weights @ v[at] + shaped @ v[BUCKETS:]
        squares = (weights**2) @ (v[at] ** 2) + (shaped**2) @ (v[BUCKETS:] ** 2)
        total += 0.5 * float((summed**2 - squares).sum())
        return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray, list[float]]],
    labels: np.ndarray,
    epochs: int = EPOCHS,
    batch: int = BATCH,
    seed: int = 7,
) -> Machine:
    """Fit by Adam on the log loss, a seeded batch of rows at a time.

    Without rows, or with one class only, the machine gives the share of label 1
    (one half without rows) to everything.
    """
    width = BUCKETS + STRUCTURE
    flat = Machine(0.0, np.zeros(width), np.zeros((width, FACTORS)), np.zeros(STRUCTURE), np.ones(STRUCTURE))
    if not rows or labels.min() == labels.max():
        share = float(labels.mean()) if rows else 0.5
        return replace(flat, bias=float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    form = np.array([r[2] for r in rows])
    mean, scale = form.mean(0), form.std(0)
    scale[scale < 1e-9] = 1.0
    shaped = np.clip((form - mean) / scale, -4, 4) / 4
    rng = np.random.default_rng(seed)
    factors = rng.normal(0, 0.05, (width, FACTORS)).astype(np.float32)
    params = [np.zeros(1, np.float32), np.zeros(width, np.float32), factors]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    decay = (0.0, 1e-5, 1e-4)
    steps = [s for _ in range(epochs) for s in np.array_split(rng.permutation(len(rows)), -(-len(rows) // batch))]
    for step, chosen in enumerate(steps, 1):
        x = np.zeros((len(chosen), width), np.float32)
        for k, r in enumerate(chosen):
            x[k, rows[r][0]] = rows[r][1]
        x[:, BUCKETS:] = shaped[chosen]
        squared = x**2
        bias, linear, v = params
        summed = x @ v
        total = bias + x @ linear + 0.5 * (summed**2 - squared @ (v**2)).sum(1)
        error = ((1 / (1 + np.exp(-np.clip(total, -30, 30))) - labels[chosen]) / len(chosen)).astype(np.float32)
        grads = [
            error.sum(keepdims=True),
            x.T @ error,
            x.T @ (error[:, None] * summed) - v * (squared.T @ error)[:, None],
        ]
        rate = 0.05 * (1 - step / (len(steps) + 1))
        for k, g in enumerate(grads):
            g = g + decay[k] * params[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] = params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Machine(float(params[0][0]), params[1].astype(float), params[2].astype(float), mean, scale)


def _stated_length(docs: DataFrame) -> Column:
    """The length that the table states, where it has one."""
    return F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")


def held_out(key: str) -> Column:
    """Rows whose labels are never learned from: crc32 of the key as text is divisible by 5."""
    rest = F.crc32(F.col(key).cast("string").cast("binary")) % HELD_OUT_OF
    return F.coalesce(rest == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, seed: int = 7) -> Machine:
    """Fit on at most ``train_rows`` labelled rows that are not held out.

    Which rows: those whose hashed key is smallest, so reruns agree. A key with
    several labels counts as 1 if one of them is; of several texts with one key the
    smallest is used. Null keys and labels other than 0 and 1 take no part.
    """
    chosen = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
        .limit(train_rows)
    )
    texts = (
        docs.select("doc_id", F.struct(F.coalesce("text", F.lit("")).alias("text"), _stated_length(docs).alias("n")).alias("row"))
        .join(F.broadcast(chosen), "doc_id")  # at most train_rows rows of two numbers
        .groupBy("doc_id")
        .agg(F.min("row").alias("row"), F.first("label").alias("label"))
        .select("doc_id", "label", "row.text", "row.n")
    )

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [features(t.encode(), None if pd.isna(n) else int(n)) for t, n in zip(frame["text"], frame["n"], strict=True)]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "label": frame["label"],
                    "at": [f[0].astype(np.int16).tobytes() for f in found],
                    "weights": [f[1].astype(np.float32).tobytes() for f in found],
                    "form": [np.array(f[2]).tobytes() for f in found],
                }
            )

    schema = "doc_id long, label int, at binary, weights binary, form binary"
    rows = sorted(texts.mapInPandas(extract, schema).collect(), key=lambda r: r.doc_id)  # at most train_rows
    sparse = [
        (np.frombuffer(r.at, np.int16).astype(np.int64), np.frombuffer(r.weights, np.float32), np.frombuffer(r.form).tolist())
        for r in rows
    ]
    return fit(sparse, np.array([r.label for r in rows], np.float32), seed=seed)


def score(docs: DataFrame, machine: Machine, out: str = "score") -> DataFrame:
    """Add the column ``out``: the chance that a document has label 1.

    Uses the columns text (null counts as empty) and n_chars (where missing or null,
    the length in bytes). All rows and all other columns stay; a column already
    named ``out`` is replaced.
    """
    docs = docs.drop(out)
    at = docs.columns.index("text")
    schema = docs.select("*", F.lit(0.0).alias(out), _stated_length(docs).alias("__n")).schema
    schema = type(schema)([*schema.fields[:-1]])
    fitted = docs.sparkSession.sparkContext.broadcast(machine)  # (BUCKETS + STRUCTURE) x (FACTORS + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(batch.num_columns - 1).to_pylist()
            found = [fitted.value.score(*features(t, n)) for t, n in zip(utf8(batch.column(at)), given, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.float64())], names=[*batch.schema.names[:-1], out]
            )

    return docs.withColumn("__n", _stated_length(docs)).mapInArrow(run, schema)


def classify(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """``score`` and ``predicted`` (1 if the score reaches ``threshold``, else 0)."""
    return score(docs, machine).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
