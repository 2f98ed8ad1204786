"""Grouping spellings of a name by a fingerprint key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.text import fingerprint_ngram_char, fingerprint_ngram_word
from tamarack.operators.joins import join_lookup
from tamarack.session import materialize

_METHODS = {"word": fingerprint_ngram_word, "char": fingerprint_ngram_char}


def cluster_keys(df: DataFrame, col: str, method: str = "word", n: int = 2) -> DataFrame:
    """``(key, variant, n, key_rows, merged)``: one row per spelling of a key.

    ``merged`` is the key's most frequent spelling, the smallest on a tie. A
    key's spellings stay rows, as one key (such as '' for all one-word names)
    may own any number of them.
    """
    # Count spellings before fingerprinting, so each is processed once.
    spellings = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("variant")).agg(
        F.count(F.lit(1)).alias("n")
    )
    keyed = spellings.select(_METHODS[method]("variant", n).alias("key"), "variant", "n")
    keyed = materialize(keyed, "keyed")
    best = F.min(F.struct((-F.col("n")).alias("neg"), "variant"))["variant"]
    merged = keyed.groupBy("key").agg(F.sum("n").alias("key_rows"), best.alias("merged"))
    return join_lookup(keyed, materialize(merged, "merged"), ["key"])


def merge_spellings(df: DataFrame, col: str, clusters: DataFrame) -> DataFrame:
    """``df`` with every spelling in ``col`` replaced by the one its key is merged into.

    ``clusters`` comes from :func:`cluster_keys`. NULL and values that are not
    listed stay.
    """
    listed = clusters.select(F.col("variant").alias(col), F.col("merged").alias("__merged"))
    joined = join_lookup(df, listed, [col], "left")
    return joined.withColumn(col, F.coalesce("__merged", col)).select(*df.columns)
