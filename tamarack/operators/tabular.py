"""Counting, top-k, set and incremental operators over plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.text import blank_to_null
from tamarack.operators.joins import fits_broadcast, join_small


def filter_not_blank(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is neither NULL nor blank."""
    return df.filter(blank_to_null(col).isNotNull())


def count_rows(df: DataFrame) -> DataFrame:
    """One row: the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_nonblank(df: DataFrame, col: str) -> DataFrame:
    """One row: the number of rows with a non-blank ``col``."""
    return df.agg(F.count(blank_to_null(col)).alias("n"))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-blank values, ascending."""
    return filter_not_blank(df, col).select(col).distinct().orderBy(col)


def group_count(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-blank value, by value."""
    return filter_not_blank(df, col).groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(col)


def topk_count(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent non-blank values; ties by value."""
    counts = filter_not_blank(df, col).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(col)).limit(k)


def intersect_sorted(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Non-blank values present in both inputs, ascending."""
    left = filter_not_blank(a, col).select(col)
    return left.intersect(filter_not_blank(b, col).select(col)).orderBy(col)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either input, once each."""
    return a.unionByName(b).distinct()


def csv_lines(df: DataFrame, cols: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Rows as comma-joined text lines in a stated order; NULL becomes ''."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return df.orderBy(*order_by).select(F.concat_ws(",", *parts).alias("line"))


def collect_blocks(
    df: DataFrame, by: Sequence[str], member: str, block_size: int = 1 << 16
) -> DataFrame:
    """Members per group as sorted lists, cut into blocks of neighbouring ids.

    Block ``b`` holds the distinct integer ids in ``[b * size, (b + 1) * size)``,
    so no row or task ever holds a whole large group.
    """
    block = F.floor(F.col(member) / F.lit(block_size)).cast("bigint")
    return (
        df.select(*by, member)
        .distinct()
        .groupBy(*by, block.alias("block"))
        .agg(F.sort_array(F.collect_list(member)).alias("members"))
        .withColumn("n", F.size("members").cast("bigint"))
    )


def dedupe_keep_first(df: DataFrame, key: str, position: str) -> DataFrame:
    """First row per key by ``position``; partial minima meet before the shuffle."""
    rest = [c for c in df.columns if c not in (key, position)]
    if not rest:  # a plain minimum aggregates by hash, a struct only by sorting
        return df.groupBy(key).agg(F.min(position).alias(position)).select(*df.columns)
    first = F.min(F.struct(position, *rest)).alias("__first")
    return df.groupBy(key).agg(first).select(key, "__first.*").select(*df.columns)


def anti_join_seen(batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``seen``; NULL is a key like any other."""
    known = seen.select(F.col(key).alias("__seen")).distinct()
    return batch.join(known, batch[key].eqNullSafe(known["__seen"]), "left_anti")


def store_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int = 64) -> None:
    """Save ``df`` as the table ``name``, bucketed and sorted by ``key``: joins on the key do not shuffle it."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(name)


def rows_by_stored(batch: DataFrame, name: str, key: str, known: bool) -> DataFrame:
    """Rows of ``batch`` whose key the table of :func:`store_bucketed` has (``known``) or has not.

    The stored rows never move. For a batch measured to be small they are first cut to its keys, which
    every task of their scan is sent; else the batch alone is shuffled to their buckets. NULL is a key
    like any other.
    """
    stored = batch.sparkSession.table(name).select(F.col(key).alias("__stored"))
    how = "left_semi" if known else "left_anti"
    keyed, null = batch.filter(F.col(key).isNotNull()), batch.filter(F.col(key).isNull())
    keys = keyed.select(F.col(key).alias("__stored")).distinct()
    same = keyed[key] == F.col("__stored")
    if fits_broadcast(keys):
        held = stored.join(F.broadcast(keys), "__stored", "left_semi").distinct()  # no more than the batch has
        found = keyed.join(F.broadcast(held), same, how)
    else:
        found = keyed.join(stored.hint("merge"), same, how)
    any_null = stored.filter("__stored IS NULL").limit(1).agg(F.count(F.lit(1))).scalar() > 0
    return found.unionByName(null.filter(any_null if known else ~any_null))


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest by its other columns."""
    rest = [c for c in df.columns if c != key]
    smallest = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("__row"))
    return smallest.select(key, "__row.*").select(*df.columns)


def append_unseen(history: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``history`` plus the batch rows with new keys; appending twice changes nothing."""
    fresh = anti_join_seen(one_per_key(batch, key), history, key)
    return history.unionByName(fresh)


def join_ordinal(df: DataFrame, col: str, ordinal: DataFrame) -> DataFrame:
    """Add ``rank`` of ``col`` from ``ordinal(value, rank)``; NULL when not listed."""
    listed = ordinal.select(F.col("value").alias(col), "rank")
    return join_small(df, listed, [col], "left")


def pivot_cells(df: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """Mean of ``value`` by ``rows`` x ``columns`` in long form, any number of either."""
    known = [F.col(c).isNotNull() for c in (rows, columns, value)]
    kept = df.filter(known[0] & known[1] & known[2])
    return kept.groupBy(rows, columns).agg(F.avg(value).alias(value))


def pivot_mean(df: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """Mean of ``value`` by ``rows`` x ``columns``, absent cells 0, a column per value of ``columns``.

    The column names have to be known to the driver, as they are the schema. Where
    there are too many to be columns of a table, use :func:`pivot_cells`.
    """
    names = df.select(columns).filter(F.col(columns).isNotNull()).distinct()
    wanted = sorted(r[0] for r in names.collect())  # the names of the result's columns
    kept = df.filter(F.col(rows).isNotNull() & F.col(value).isNotNull())
    return kept.groupBy(rows).pivot(columns, wanted).agg(F.avg(value)).na.fill(0.0)


def pivot_sparse(df: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """Mean of ``value`` by ``rows`` x ``columns``: per row one map of the cells that are there, in order.

    The names of the columns are data here, not schema, so there may be any number of them and
    none comes to the driver. A row of the result is as large as its own cells.
    """
    cells = pivot_cells(df, rows, columns, value)
    held = F.sort_array(F.collect_list(F.struct(columns, value)))
    return cells.groupBy(rows).agg(F.map_from_entries(held).alias("cells"))


def pivot_mean_smaller(df: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """:func:`pivot_mean` with the column of fewer distinct values across (``a`` on a tie)."""
    n_a, n_b = df.agg(F.countDistinct(a), F.countDistinct(b)).first()
    return pivot_mean(df, b, a, value) if n_a <= n_b else pivot_mean(df, a, b, value)
