"""Descriptive statistics by measurement level, facets, and the data behind plots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions.text import blank_to_null, is_numeric
from tamarack.operators.joins import join_small
from tamarack.operators.ordering import quantiles, value_counts
from tamarack.session import materialize

NUMERIC_LEVELS = ("interval", "ratio")
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def text_facet(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value; NULL left out."""
    return value_counts(df, col).orderBy(F.desc("n"), F.asc(col))


def mode_smallest(counts: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per group, the smallest on a tie, from value counts."""
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col(value).alias("v")))
    return counts.groupBy(*by).agg(best["v"].alias("mode"))


def _edges(df: DataFrame, col: str) -> Column:
    """Scalar struct (lo, hi); a single value gets an interval of width one around it."""
    lo, hi = F.min(col).cast("double"), F.max(col).cast("double")
    half = F.when(lo == hi, 0.5).otherwise(0.0)
    return df.agg(F.struct((lo - half).alias("lo"), (hi + half).alias("hi")).alias("e")).scalar()


def _bin(value: Column, edges: Column, bins: int) -> Column:
    share = (value - edges["lo"]) / (edges["hi"] - edges["lo"])
    return F.least(F.floor(share * bins) + 1, F.lit(bins)).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """All ``bins`` equal-width bins over [min, max] with their counts."""
    edges = _edges(df, col)
    counted = (
        df.filter(F.col(col).isNotNull())
        .groupBy(_bin(F.col(col).cast("double"), edges, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (edges["hi"] - edges["lo"]) / bins
    return every.join(F.broadcast(counted), "bin", "left").select(  # at most `bins` rows
        "bin",
        (edges["lo"] + (F.col("bin") - 1) * width).alias("lo"),
        (edges["lo"] + F.col("bin") * width).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def scatter_density(df: DataFrame, x: str, y: str, bins: int = 10) -> DataFrame:
    """Rows per cell of a ``bins`` x ``bins`` grid over two numeric columns."""
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    cells = [
        _bin(F.col(c).cast("double"), _edges(pairs, c), bins).alias(name)
        for c, name in ((x, "x_bin"), (y, "y_bin"))
    ]
    return pairs.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"))


def numeric_facet(
    df: DataFrame,
    col: str,
    include: Sequence[str] = ("numeric", "non_numeric", "blank"),
    bins: int = 10,
) -> DataFrame:
    """Counts of numeric, non-numeric and blank entries of a text column, then a histogram.

    Included entries that are no number count as 0 in the histogram and in the
    ``min_max`` row; kinds that are not included are left out of both.
    """
    text = F.col(col).cast("string")
    kind = (
        F.when(blank_to_null(text).isNull(), "blank")
        .when(is_numeric(text), "numeric")
        .otherwise("non_numeric")
    )
    number = F.when(kind == "numeric", F.trim(text).try_cast("double")).otherwise(0.0)
    rows = df.select(kind.alias("kind"), F.when(kind.isin(*include), number).alias("value"))

    counts = [F.count_if(F.col("kind") == k) for k in ("numeric", "non_numeric", "blank")]
    shown = [
        F.struct(
            F.lit(k).alias("kind"),
            F.lit(None).cast("int").alias("bin"),
            F.lit(None).cast("double").alias("lo"),
            F.lit(None).cast("double").alias("hi"),
            c.alias("n"),
        )
        for k, c in zip(("numeric", "non_numeric", "blank"), counts)
    ]
    min_max = F.struct(
        F.lit("min_max").alias("kind"),
        F.lit(None).cast("int").alias("bin"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.count("value").alias("n"),
    )
    summary = rows.agg(F.array(*shown, min_max).alias("r")).select(F.inline("r"))
    bars = histogram(rows, "value", bins).select(F.lit("histogram").alias("kind"), "bin", "lo", "hi", "n")
    return summary.unionByName(bars)


def box_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """Quartiles, whiskers and outlier count of ``value`` per category.

    Whiskers end at the last entry within 1.5 interquartile ranges of the box.
    """
    known = df.filter(F.col(by).isNotNull())
    values = known.select(by, F.col(value).cast("double").alias(value))
    values = materialize(values.filter(F.col(value).isNotNull()), "values")
    boxes = materialize(quantiles(values, value, QUARTILES, [by], weight=None), "boxes")
    v, reach = F.col(value), 1.5 * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = v.between(low, high)
    placed = join_small(values, boxes, [by])
    return placed.groupBy(by, *QUARTILES).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, v)).alias("whisker_lo"),
        F.max(F.when(inside, v)).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
    )


def ordinal_stats(counts: DataFrame, ordinal: DataFrame) -> DataFrame:
    """Median entry and rank range per feature.

    ``counts`` has ``feature, value, n`` with missing entries as NULL values,
    ``ordinal`` has ``feature, value, rank``. The median is the middle row when
    the number of rows is odd and undefined when it is even.
    """
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    ranked = counts.join(ordinal, ["feature", "value"])
    # Bounded: one row per entry of the ordinal list.
    earlier = Window.partitionBy("feature").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    middle = F.floor(F.col("total") / 2)
    hit = (F.col("total") % 2 == 1) & (F.col("before") <= middle) & (middle < F.col("before") + F.col("n"))
    return (
        ranked.withColumn("before", before)
        .join(totals, "feature")
        .groupBy("feature")
        .agg(
            F.max(F.when(hit, F.col("value"))).alias("median_entry"),
            (F.max("rank") - F.min("rank")).cast("double").alias("rank_range"),
        )
    )


def _melt(df: DataFrame, features: Sequence[str], kind: str) -> DataFrame:
    pairs = [
        F.struct(F.lit(f).alias("feature"), F.col(f).cast(kind).alias("value")) for f in features
    ]
    return df.select(F.inline(F.array(*pairs)))


def profile_table(
    df: DataFrame, levels: dict[str, str], ordinal: DataFrame | None = None
) -> DataFrame:
    """One row per feature, with the statistics its measurement level allows.

    ``levels`` maps a column to nominal, ordinal, interval or ratio, and
    ``ordinal(feature, value, rank)`` lists the order of ordinal entries as
    text. Statistics a level does not allow are NULL.
    """
    unknown = set(levels.values()) - {"nominal", "ordinal", *NUMERIC_LEVELS}
    if unknown:
        raise ValueError(f"unknown levels {sorted(unknown)}")
    numbers = [f for f, level in levels.items() if level in NUMERIC_LEVELS]
    names = [f for f in levels if f not in numbers]

    # One pass without a row shuffle gives everything but uniqueness and order.
    def one(f: str) -> Column:
        number = f in numbers
        v = F.col(f).cast("double") if number else F.lit(None).cast("double")
        return F.struct(
            F.lit(f).alias("feature"),
            F.lit(levels[f]).alias("level"),
            F.count(F.lit(1)).alias("n"),
            F.count(f).alias("n_entries"),
            F.count_if(F.col(f).isNull()).alias("n_missing"),
            F.avg(v).alias("mean"),
            (F.max(v) - F.min(v)).alias("value_range"),
            F.stddev_samp(v).alias("std"),
        )

    basic = df.agg(F.array(*[one(f) for f in levels]).alias("r")).select(F.inline("r"))

    extra = []
    if numbers:
        counts = materialize(value_counts(_melt(df, numbers, "double"), "value", ["feature"]), "counts")
        modes = counts.groupBy("feature").agg(
            F.count(F.lit(1)).alias("n_unique"),
            F.min(F.struct((-F.col("n")).alias("neg"), "value"))["value"].alias("mode_number"),
            F.lit(None).cast("string").alias("mode"),
        )
        boxes = quantiles(counts, "value", QUARTILES, ["feature"])
        extra.append(
            modes.join(F.broadcast(boxes), "feature").select(  # one row per feature
                *modes.columns,
                "median",
                (F.col("q3") - F.col("q1")).alias("iqr"),
                F.lit(None).cast("string").alias("median_entry"),
                F.lit(None).cast("double").alias("rank_range"),
            )
        )
    if names:
        counts = _melt(df, names, "string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        counts = materialize(counts, "counts")
        modes = (
            counts.filter(F.col("value").isNotNull())
            .groupBy("feature")
            .agg(
                F.count(F.lit(1)).alias("n_unique"),
                F.lit(None).cast("double").alias("mode_number"),
                F.min(F.struct((-F.col("n")).alias("neg"), "value"))["value"].alias("mode"),
                F.lit(None).cast("double").alias("median"),
                F.lit(None).cast("double").alias("iqr"),
            )
        )
        ranked = [f for f in names if levels[f] == "ordinal"]
        if ranked and ordinal is None:
            raise ValueError("ordinal features need their list of entries")
        if ranked:
            stats = ordinal_stats(counts.filter(F.col("feature").isin(ranked)), ordinal)
            modes = modes.join(F.broadcast(stats), "feature", "left")  # one row per feature
        else:
            modes = modes.select(
                "*",
                F.lit(None).cast("string").alias("median_entry"),
                F.lit(None).cast("double").alias("rank_range"),
            )
        extra.append(modes)
    more = reduce(DataFrame.unionByName, extra)
    return basic.join(F.broadcast(more), "feature", "left").select(  # one row per feature
        "feature",
        "level",
        "n",
        "n_entries",
        F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
        "n_missing",
        "mode",
        "mode_number",
        "median_entry",
        "median",
        "mean",
        F.coalesce("value_range", "rank_range").alias("range"),
        "iqr",
        "std",
    )
