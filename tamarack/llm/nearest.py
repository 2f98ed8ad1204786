"""Nearest neighbours by inner product through a block matrix join.

Every pair of a query block and a data block is one task. It multiplies int8
matrices and bounds each product's error by what rounding to int8 has taken from
the two vectors. Pairs whose upper bound reaches the k-th largest lower bound are
multiplied again in double precision; a heap per query and block keeps the k best,
and the heaps of a query are merged by a limited window.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.tiles import best_by_query, first_copies, matrix, meet_blocks, one_row_per_id, usable
from tamarack.session import materialize

STRIP = 256  # queries of a block that are multiplied at once


def quantized(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, the lengths of what they stand for, and of what is lost."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1.0
    small = np.rint(x / scale[:, None]).astype(np.int8)
    kept = small * scale[:, None]
    return small, scale, np.linalg.norm(kept, axis=1), np.linalg.norm(x - kept, axis=1)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added up from the first component to the last."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def block_best(query_ids, queries, ids, data, k: int) -> list[tuple[int, int, float]]:
    """(query, id, product) of the ``k`` best of a block for every query, the query's own id left out."""
    q8, q_scale, q_kept, q_lost = quantized(queries)
    d8, d_scale, d_kept, d_lost = quantized(data)
    q_size = np.linalg.norm(queries, axis=1)
    # Sums of products of int8 are whole numbers below 2^24 up to 1040 components: exact in single precision.
    exact_in = np.float32 if data.shape[1] <= 1040 else np.float64
    q8, d8 = q8.astype(exact_in), d8.astype(exact_in).T
    out = []
    for lo in range(0, len(queries), STRIP):
        rows = slice(lo, lo + STRIP)
        about = (q8[rows] @ d8) * q_scale[rows, None] * d_scale
        # |q.d - q'.d'| <= |q| |d - d'| + |q - q'| |d'|, and a margin for the rounding of these numbers.
        error = q_size[rows, None] * d_lost + q_lost[rows, None] * d_kept
        error += 1e-9 * (q_size[rows, None] * (d_kept + d_lost)) + 1e-300
        own = query_ids[rows, None] == ids
        lower = np.where(own, -np.inf, about - error)
        if lower.shape[1] > k:
            kth = np.partition(lower, -k, axis=1)[:, -k]
        else:
            kth = np.full(len(lower), -np.inf)
        at_q, at_d = np.nonzero((about + error >= kth[:, None]) & ~own)
        scores = np.concatenate(
            [
                exact_products(queries[lo + at_q[i : i + 65536]], data[at_d[i : i + 65536]])
                for i in range(0, len(at_q), 65536)
            ]
            or [np.zeros(0)]
        )
        ends = np.searchsorted(at_q, np.arange(len(lower) + 1))
        for r in range(len(lower)):
            own_pairs = slice(ends[r], ends[r + 1])
            best = heapq.nsmallest(k, zip(-scores[own_pairs], ids[at_d[own_pairs]], strict=True))
            out += [(query_ids[lo + r], i, -s) for s, i in best]
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` rows with the largest inner product for every query: query_id, rank, vec_id, score.

    ``queries`` has the same two columns; a query's own id is no candidate. All
    candidates are returned if there are fewer than ``k``. Exact: the bounds only
    spare work. Vectors that are null, empty, zero or hold a null or a number that is
    not finite take no part, nor do null ids; vectors of different lengths do not
    meet. Rows that repeat an id count once, with their smallest vector; other columns
    are ignored. Of equal vectors only the first ``k + 1`` ids can be among the best,
    and only these are compared. Empty tables give an empty result.
    """

    def prepared(table: DataFrame) -> DataFrame:
        wide = F.transform(F.col(vector), lambda x: x.cast("double"))
        table = table.select(F.col(key).cast("long").alias("vec_id"), wide.alias("v"))
        table = table.filter(usable("v") & F.exists("v", lambda x: x != 0))
        return one_row_per_id(table, "vec_id", "v").withColumn("dim", F.size("v"))

    data = materialize(first_copies(prepared(vectors), "vec_id", "v", k + 1), "candidates")
    asked = materialize(prepared(queries), "queries")

    def match(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        best = block_best(q["vec_id"].to_numpy(), matrix(q["v"]), d["vec_id"].to_numpy(), matrix(d["v"]), k)
        return pd.DataFrame(best, columns=["query_id", "vec_id", "score"])

    found = meet_blocks(asked, data, "vec_id", match, "query_id long, vec_id long, score double")
    return best_by_query(found, k).select("query_id", "rank", "vec_id", "score")
