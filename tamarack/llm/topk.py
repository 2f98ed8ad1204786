"""Exact top-k search over a vector-approximation file.

The approximation of a vector is one small cell number per component. Scanning the
cells bounds every product from both sides. The exact vectors are then read in the
order of their bounds: first the k with the largest upper bounds of every query,
whose k-th product is a mark; then those whose upper bound still reaches the mark.
What is left cannot be among the k best, so the k-th result is certain.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.tiles import best_by_query, first_copies, matrix, meet_blocks, one_row_per_id, usable
from tamarack.session import materialize

CELLS = 64  # cells along a component, of equal width between its smallest and largest value
STRIP = 256


def whole_numbers(vector: str, factor: int) -> Column:
    """floor(factor * x) of every component."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * F.lit(float(factor))).cast("long"))


def grid(vectors: DataFrame, vector: str, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Smallest value and cell width of every component, over all vectors; a row per component."""
    ends = (
        vectors.select(F.posexplode(vector).alias("at", "x"))
        .groupBy("at")
        .agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        .orderBy("at")
        .collect()  # one row per component
    )
    lo = np.array([r["lo"] for r in ends], np.int64)
    hi = np.array([r["hi"] for r in ends], np.int64)
    return lo, (hi - lo) // cells + 1


def approximated(x: np.ndarray, lo: np.ndarray, width: np.ndarray) -> np.ndarray:
    return ((x - lo) // width).astype(np.uint8)


def cell_candidates(query_ids, queries, ids, cells, lo, width, k: int) -> pd.DataFrame:
    """Pairs whose upper bound reaches the k-th largest lower bound of the query in this block."""
    low = lo + cells.astype(np.float64) * width  # smallest and largest number of every cell
    high = low + (width - 1)
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    parts = []
    for start in range(0, len(queries), STRIP):
        rows = slice(start, start + STRIP)
        # Whole numbers below 2^53 are exact in double precision.
        upper = up[rows] @ high.T + down[rows] @ low.T
        lower = up[rows] @ low.T + down[rows] @ high.T
        own = query_ids[rows, None] == ids
        lower[own] = -np.inf
        kth = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] > k else np.full(len(lower), -np.inf)
        at_q, at_d = np.nonzero((upper >= kth[:, None]) & ~own)
        parts.append(
            pd.DataFrame({"query_id": query_ids[start + at_q], "vec_id": ids[at_d], "upper": upper[at_q, at_d].astype(np.int64)})
        )
    return pd.concat(parts, ignore_index=True)


def _product(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, factor: int = 256, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` largest inner products of floor(factor * x): query_id, rank, vec_id, score (long).

    ``queries`` has the same two columns; a query's own id is no candidate. Exact, ties
    to the smaller id. Vectors that are null, empty or hold a null or a number that is
    not finite take no part, nor do null ids; vectors of different lengths do not meet.
    Rows that repeat an id count once, with their smallest vector; other columns are
    ignored. Of equal vectors only the first ``k + 1`` ids can be among the best, and
    only these are compared. Products are exact below 2^53.
    """

    def prepared(table: DataFrame) -> DataFrame:
        table = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")).filter(usable("v"))
        whole = table.select("vec_id", whole_numbers("v", factor).alias("v"))
        return one_row_per_id(whole, "vec_id", "v").withColumn("dim", F.size("v"))

    data = materialize(first_copies(prepared(vectors), "vec_id", "v", k + 1), "vectors")
    asked = materialize(prepared(queries), "queries")
    lo, width = grid(data, "v")

    def approximate(frames):
        for frame in frames:
            cells = [approximated(np.asarray(v), lo[: len(v)], width[: len(v)]).tobytes() for v in frame["v"]]
            yield pd.DataFrame({"vec_id": frame["vec_id"], "dim": frame["dim"], "cells": cells})

    file = materialize(data.mapInPandas(approximate, "vec_id long, dim int, cells binary"), "approximations")

    def match(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        n = int(q["dim"].iloc[0])
        cells = np.frombuffer(b"".join(d["cells"]), np.uint8).reshape(len(d), n)
        return cell_candidates(
            q["vec_id"].to_numpy(), matrix(q["v"], np.int64), d["vec_id"].to_numpy(), cells, lo[:n], width[:n], k
        )

    bounded = meet_blocks(asked, file, "vec_id", match, "query_id long, vec_id long, upper long")
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("upper"), "vec_id")
    bounded = materialize(bounded.withColumn("place", F.row_number().over(by_bound)), "bounds")

    def read(pairs: DataFrame) -> DataFrame:
        exact = pairs.join(data.select("vec_id", F.col("v").alias("__v")), "vec_id")
        exact = exact.join(asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("__q")), "query_id")
        return exact.select("query_id", "vec_id", _product("__q", "__v").alias("score"))

    first = materialize(read(bounded.filter(F.col("place") <= k)), "first")
    marks = first.groupBy("query_id").agg(F.min("score").alias("mark"))
    later = bounded.filter(F.col("place") > k).join(marks, "query_id").filter(F.col("upper") >= F.col("mark"))
    found = first.unionByName(read(later.select("query_id", "vec_id")))
    return best_by_query(found, k).select("query_id", "rank", "vec_id", "score")
