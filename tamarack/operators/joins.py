"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.session import materialize

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20
HOT_SHARE = 256  # a key with 1/256 of all rows is hot, so at most 256 keys are
SPREAD = 4096


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure whether ``df`` is small, in one pass over no more rows than may be broadcast."""
    seen = df.limit(max_rows + 1)
    n, size = seen.agg(F.count(F.lit(1)), F.sum(F.length(F.to_json(F.struct("*"))))).first()
    return n <= max_rows and (size or 0) <= max_bytes


def join_small(
    facts: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", salts: int = 32
) -> DataFrame:
    """Broadcast ``small`` after measuring it, else join with hot keys dealt out."""
    if fits_broadcast(small):
        return facts.join(F.broadcast(small), list(on), how)
    return join_salted(facts, small, on, how, salts)


def join_salted(
    facts: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner", salts: int = 32
) -> DataFrame:
    """Equi-join in which every hot key of ``facts`` is dealt out to ``salts`` tasks.

    Only the rows of ``other`` that have a hot key are repeated, once per salt; all
    others travel once. ``how`` is inner, left, left_semi or left_anti: each fact row
    meets exactly one copy of ``other``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join_salted cannot do {how}")
    counts = materialize(facts.groupBy(*on).agg(F.count(F.lit(1)).alias("n")), "counts")
    hot = F.broadcast(hot_keys(counts, on).withColumn("__hot", F.lit(True)))  # at most HOT_SHARE rows
    rest = [c for c in facts.columns if c not in on] or list(on)
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    dealt = facts.join(hot, list(on), "left").withColumn("__salt", salt).drop("__hot")
    every = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = other.join(hot, list(on), "left").withColumn("__salt", F.explode(every)).drop("__hot")
    return dealt.join(copies, [*on, "__salt"], how).drop("__salt")


def hot_keys(counts: DataFrame, on: Sequence[str], n: str = "n", share: int = HOT_SHARE) -> DataFrame:
    """Keys that own at least 1/``share`` of all rows: never more than ``share`` keys."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.filter(F.col(n) * share >= total).select(*on)


def join_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join with a ``lookup`` that has one row per key and may be of any size.

    A lookup measured to be small is broadcast whole. Else hot keys are answered
    from a broadcast of at most ``HOT_SHARE`` rows; their fact rows then travel
    under scattered keys, so no task owns a hot key. All other rows take one
    ordinary shuffle join. ``counts`` (key columns and ``n``) saves counting the
    facts when the caller has it already.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join_lookup cannot do {how}")
    on = list(on)
    if fits_broadcast(lookup, max_rows):
        return facts.join(F.broadcast(lookup), on, how)
    added = [c for c in lookup.columns if c not in on]
    if counts is None:
        counts = materialize(facts.groupBy(*on).agg(F.count(F.lit(1)).alias("n")), "counts")
    hot = F.broadcast(hot_keys(counts, on))
    hot_rows = lookup.join(hot, on, "left_semi").select(
        *on, F.lit(True).alias("__hot"), F.struct(*added).alias("__hot_row")
    )
    rest = [c for c in facts.columns if c not in on] or on
    marked = facts.join(F.broadcast(hot_rows), on, "left").withColumn(
        "__salt",
        F.when(F.col("__hot"), 1 + F.pmod(F.xxhash64(*rest), F.lit(SPREAD))).otherwise(F.lit(0)),
    )
    cold = lookup.select(*on, F.struct(*added).alias("__cold_row"), F.lit(0).cast("bigint").alias("__salt"))
    joined = marked.join(cold, [*on, "__salt"], "left")
    if how == "inner":
        joined = joined.filter(F.col("__hot") | F.col("__cold_row").isNotNull())
    kept = [c for c in facts.columns]
    picked = F.coalesce(F.col("__hot_row"), F.col("__cold_row"))
    return joined.select(*kept, picked.alias("__row")).select(
        *kept, *[F.col("__row")[c].alias(c) for c in added]
    )
