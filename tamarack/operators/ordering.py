"""Positions, running totals and exact quantiles without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, LongType

from tamarack.operators.joins import fits_broadcast
from tamarack.session import materialize

_SLICE = "__slice"
SLICE_ROWS = 4_000_000  # rows of a slice, about, where there are more than the session's partitions hold


def _slices(rows: DataFrame) -> int:
    """As many as the session's partitions, or more where the rows ask for it."""
    wanted = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, -(-rows.count() // SLICE_ROWS))


def running_total(
    df: DataFrame,
    order_by: Sequence[str | Column],
    weight: str,
    by: Sequence[str] = (),
    name: str = "before",
    total: str = "total",
) -> DataFrame:
    """Add the sum of ``weight`` over all earlier rows, and the group's total.

    The rows are range-partitioned by (``by``, ``order_by``), so a group that
    holds most rows is spread over many slices. A slice's sum is the only thing
    that crosses slices: one row per (slice, group). ``order_by`` must put the
    rows of a group in a total order, with names only where ``by`` is given.
    """
    by = list(by)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    # Written first: the range bounds are sampled in a pass of their own, and counting is free.
    rows = materialize(df, "unsorted")
    ranged = rows.repartitionByRange(_slices(rows), *[F.col(c) for c in by], *order)
    # The slice number must not change between the two uses below.
    ranged = materialize(ranged.withColumn(_SLICE, F.spark_partition_id()), "ranged")

    sums = ranged.groupBy(_SLICE, *by).agg(F.sum(weight).alias("__sum"))
    # Bounded: a group has at most one row per slice here.
    anchor = by or [F.lit(0)]
    earlier = Window.partitionBy(*anchor).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*anchor)
    offsets = sums.select(
        _SLICE,
        *by,
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"),
        F.sum("__sum").over(whole).alias(total),
    )
    inner = (
        Window.partitionBy(_SLICE, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = ranged.join(F.broadcast(offsets), _SLICE) if not by else ranged.join(offsets, [_SLICE, *by])
    return joined.withColumn(
        name, F.col("__offset") + F.coalesce(F.sum(weight).over(inner), F.lit(0))
    ).drop(_SLICE, "__offset")


def row_index(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "position", start: int = 0
) -> DataFrame:
    """Number all rows by their place in a total order.

    One range exchange and one write: a row's id holds its slice and its place in it, and the
    rows before each slice are added up from one number per slice. ``df`` is read once more
    for the bounds of the slices.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("__id", F.monotonically_increasing_id()), "ranged")
    slice_of = F.shiftright("__id", 33)
    sizes = placed.groupBy(slice_of.alias(_SLICE)).agg(F.count(F.lit(1)).alias("n")).orderBy(_SLICE).collect()
    offsets, before = [], start  # a row per slice
    for r in sizes:
        offsets.append((r[_SLICE], before))
        before += r["n"]
    first = df.sparkSession.createDataFrame(offsets, f"{_SLICE} bigint, __first bigint")
    joined = placed.withColumn(_SLICE, slice_of).join(F.broadcast(first), _SLICE)
    place = F.col("__id") - F.shiftleft(_SLICE, 33)
    return joined.withColumn(name, F.col("__first") + place).drop(_SLICE, "__id", "__first")


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct non-null value; equal values meet before the shuffle."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


BINS = 4096  # intervals that one pass tells apart


def _share(value: Column, lo: Column, hi: Column, kind: DataType, logarithmic: bool) -> Column:
    """Where ``value`` lies between ``lo`` (0) and ``hi`` (1); never falls where the value rises."""
    if isinstance(kind, (LongType, DecimalType)) and not logarithmic:  # differences are exact
        wide = DecimalType(38, kind.scale if isinstance(kind, DecimalType) else 0)
        value, lo, hi = (c.cast(wide) for c in (value, lo, hi))
        return (value - lo).cast("double") / (hi - lo).cast("double")

    def at(c: Column) -> Column:
        finite = F.least(F.greatest(c.cast("double"), F.lit(-1.7e308)), F.lit(1.7e308))
        return F.signum(finite) * F.log1p(F.abs(finite)) if logarithmic else finite / 2

    span = at(hi) - at(lo)
    return F.when(span > 0, (at(value) - at(lo)) / span).otherwise(0.0)


def _beside(
    rows: DataFrame, groups: DataFrame, by: Sequence[str], column: str, few: bool, how: str = "inner"
) -> DataFrame:
    """``rows`` with ``column`` of their group, NULL being one; without ``by``, of the only row of ``groups``.

    ``few`` says that there are few groups: they are sent to every task.
    """
    if not by:
        return rows.withColumn(column, groups.agg(F.first(column)).scalar())
    renamed = groups.select(*[F.col(c).alias(f"__{c}") for c in by], column)
    if few:
        renamed = F.broadcast(renamed)
    same = reduce(Column.__and__, [rows[c].eqNullSafe(renamed[f"__{c}"]) for c in by])
    return rows.join(renamed, same, how).drop(*[f"__{c}" for c in by])


def select_ranks(rows: DataFrame, value: str, ranks: dict[str, Column], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """``by``, total and the values at the given ranks (from 0, in terms of ``total``) of every group.

    Nothing is sorted. Each pass counts the rows of ``BINS`` intervals between the bounds of
    every rank, and the interval that holds the rank gives its new bounds: the least and the largest
    value in it. Passes divide evenly and by logarithm in turn, so a few of them do for any spread
    of values, and only bins are shuffled. ``rows`` is read once a pass; NULL values are left out.
    """
    by, kind = list(by), rows.schema[value].dataType
    held = rows.filter(F.col(value).isNotNull()).select(
        *by, F.col(value).alias("__v"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("__w")
    )
    whole = held.groupBy(*by).agg(F.sum("__w").alias("total"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    aims = [
        F.struct(F.lit(t).alias("t"), rank.cast("bigint").alias("rank"), F.lit(0).cast("bigint").alias("below"), "lo", "hi")
        for t, rank in ranks.items()
    ]
    state = materialize(whole.filter("total > 0").select(*by, "total", F.array(*aims).alias("aims")), "aims")
    logarithmic, few = False, bool(by) and fits_broadcast(state)
    while not state.filter(F.exists("aims", lambda a: a["lo"] < a["hi"])).isEmpty():
        open_aims = F.filter("aims", lambda a: a["lo"] < a["hi"])
        bounds = F.array_distinct(F.transform(open_aims, lambda a: F.struct(a["lo"].alias("lo"), a["hi"].alias("hi"), a["below"].alias("below"))))
        # Ranks between the same bounds share their bins.
        near = _beside(held, state.select(*by, bounds.alias("__bounds")), by, "__bounds", few).withColumn("__a", F.explode("__bounds"))
        near = near.filter(F.col("__v").between(F.col("__a.lo"), F.col("__a.hi")))
        v, lo, hi = F.col("__v"), F.col("__a.lo"), F.col("__a.hi")
        share = F.floor(_share(v, lo, hi, kind, logarithmic) * BINS)
        bin_ = F.when(v == hi, BINS - 1).when(v == lo, 0).otherwise(F.least(F.greatest(share, F.lit(0)), F.lit(BINS - 1)))
        bins = near.groupBy(*by, "__a", bin_.alias("bin")).agg(F.sum("__w").alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
        # Bounded: the same bounds of a group have no more than BINS rows here.
        earlier = Window.partitionBy(*by, "__a").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("below", F.col("__a.below") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        wanted = state.select(*[F.col(c).alias(f"__{c}") for c in by], F.explode(open_aims).alias("x"))
        inside = [F.col(f"__a.{c}") == F.col(f"x.{c}") for c in ("lo", "hi", "below")]
        inside += [bins[c].eqNullSafe(wanted[f"__{c}"]) for c in by]
        inside += [F.col("below") <= F.col("x.rank"), F.col("x.rank") < F.col("below") + F.col("n")]
        hit = bins.join(F.broadcast(wanted) if few or not by else wanted, reduce(Column.__and__, inside))
        hit = hit.select(*by, "x.t", "x.rank", "below", "lo", "hi")
        found = hit.groupBy(*by).agg(F.collect_list(F.struct("t", "rank", "below", "lo", "hi")).alias("__found"))
        done = F.filter("aims", lambda a: ~(a["lo"] < a["hi"]))
        merged = F.concat(done, F.coalesce("__found", F.filter("aims", lambda a: F.lit(False))))
        state = _beside(state, found, by, "__found", few, "left").select(*by, "total", merged.alias("aims"))
        state = materialize(state, "aims")
        logarithmic = not logarithmic

    def found_for(t: str) -> Column:
        return F.get(F.filter("aims", lambda a: a["t"] == t), 0)["lo"].alias(t)

    return state.select(*by, "total", *map(found_for, ranks))


def quantiles(
    rows: DataFrame,
    value: str,
    probabilities: dict[str, float],
    by: Sequence[str] = (),
    weight: str | None = "n",
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group; a NULL group is one, too.

    ``probabilities`` maps output column to probability. ``rows`` are :func:`value_counts`, or
    plain rows with ``weight=None``; they should be cheap to read, as several passes are made.
    Without any value there is one row of NULLs, or none with ``by``.
    """
    ranks, shown = {}, []
    for name, p in probabilities.items():
        target = F.lit(float(p)) * (F.col("total") - 1)
        ranks |= {f"__{name}_lo": F.floor(target), f"__{name}_hi": F.ceil(target)}
        lo, hi = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        shown.append((lo + (hi - lo) * (target - F.floor(target))).alias(name))
    found = select_ranks(rows, value, ranks, by, weight).select(*by, *shown)
    return found if by else found.agg(*[F.first(name).alias(name) for name in probabilities])
