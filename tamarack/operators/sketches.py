"""Mergeable sketches: distinct counts and quantiles per part of a table, for any union of parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_REGISTERS = 14  # relative error of a distinct count: about 0.8 % (one standard error)
KLL_SIZE = 400  # error of a quantile's rank: about 0.7 %


def sketch_parts(df: DataFrame, part: Sequence[str], distinct: str, value: str) -> DataFrame:
    """A row for each value of ``part``: n, and sketches of distinct entries and of the values.

    A sketch has a bounded size however many rows it saw; NULLs count in n only.
    """
    return df.groupBy(*part).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(distinct, F.lit(LG_REGISTERS)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_SIZE)).alias("value_sketch"),
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of whole groups of parts, made of their parts' sketches alone."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("value_sketch", F.lit(KLL_SIZE)).alias("value_sketch"),
    )


def read_sketches(sketches: DataFrame, probabilities: dict[str, float]) -> DataFrame:
    """``n_distinct`` and the asked quantiles, in place of the sketches."""
    asked = {
        name: F.kll_sketch_get_quantile_double("value_sketch", F.lit(float(p))) for name, p in probabilities.items()
    }
    read = sketches.withColumns({"n_distinct": F.hll_sketch_estimate("distinct_sketch"), **asked})
    return read.drop("distinct_sketch", "value_sketch")


def rank_of(sketches: DataFrame, value: float) -> DataFrame:
    """Add ``rank``, the share of the values that are at most ``value``."""
    return sketches.withColumn("rank", F.kll_sketch_get_rank_double("value_sketch", F.lit(float(value))))
