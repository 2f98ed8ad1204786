"""Inverted index: tokens, frequencies, postings in blocks, lookups."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.text import tokenize_words
from tamarack.session import materialize
from tamarack.sources.sinks import read_layout, term_bucket, write_buckets

BLOCK = 1 << 16
WRITERS = 8  # parts of a saved index for each core, at least
ENTRY = ("doc_id", "doc_len", "tf")
IMPACT_BLOCK = 128  # neighbouring ids whose largest share of a score is kept together


def _tokens(text: str, mode: str, lower: bool) -> Column:
    return tokenize_words(F.lower(text) if lower else F.col(text), mode)


def token_doc_pairs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    mode: str = "strip",
    lower: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Distinct ``(term, doc_id)`` pairs, made inside each row without a shuffle."""
    words = F.array_distinct(_tokens(text_col, mode, lower))
    # For a plain explode Spark adds a filter on the array's size, and with it a
    # second and third run of the tokenizer.
    pairs = docs.select(F.explode_outer(words).alias("term"), F.col(id_col).alias("doc_id"), *keep)
    return pairs.filter(F.col("term").isNotNull())


def term_frequency(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    mode: str = "strip",
    lower: bool = False,
    length: str = "distinct",
) -> DataFrame:
    """``(term, doc_id, doc_len, tf)``; a document's length rides along with its tokens.

    ``length`` is the number of ``distinct`` tokens or the ``total``. Tokens are counted inside each row,
    without a shuffle. Only rows that share their doc_id and length are added up.
    """
    rows = _count_rows(docs, id_col, text_col, mode, lower, length)
    return _entries(rows, _repeats(rows))


def _count_rows(docs: DataFrame, id_col: str, text_col: str, mode: str, lower: bool, length: str) -> DataFrame:
    """``(doc_id, doc_len, c)`` for every document, with its (term, tf) in ``c``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), _tokens(text_col, mode, lower).alias("k"))
    # The length is taken before the explode, or Spark would redo it per token.
    return rows.select("doc_id", _length("k", length).alias("doc_len"), _counted("k").alias("c"))


def _repeats(rows: DataFrame) -> bool:
    """Whether a doc_id comes twice; texts are not read for it."""
    return not rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def _entries(rows: DataFrame, repeats: bool) -> DataFrame:
    counted = rows.select("doc_id", "doc_len", F.explode_outer("c").alias("c")).filter(F.col("c").isNotNull())
    counted = counted.select("c.term", "doc_id", "doc_len", "c.tf")
    if not repeats:
        return counted
    return counted.groupBy("term", "doc_id", "doc_len").agg(F.sum("tf").alias("tf"))


def _counted(tokens: str) -> Column:
    """Distinct tokens of an array in order, each with its number: a sorted token is as many as the next one starts later."""

    def runs(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(words) + 1)
        fresh = F.filter(places, lambda i: (i == 1) | (i > F.size(words)) | (F.get(words, i - 1) != F.get(words, i - 2)))
        return _with(fresh, lambda starts: pairs(words, starts))

    def pairs(words: Column, starts: Column) -> Column:
        ends, n = F.slice(starts, 2, F.size(starts) - 1), F.size(starts) - 1
        return F.zip_with(
            F.slice(starts, 1, n), ends, lambda i, j: F.struct(F.get(words, i - 1).alias("term"), (j - i).cast("bigint").alias("tf"))
        )

    return _with(F.sort_array(tokens), runs)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used: it is the variable of a lambda."""
    return F.get(F.transform(F.array(value), use), 0)


def _length(tokens: str, length: str) -> Column:
    if length not in ("distinct", "total"):
        raise ValueError(f"no document length {length}")
    counted = F.array_distinct(tokens) if length == "distinct" else F.col(tokens)
    return F.size(counted).cast("bigint")


def doc_stats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    mode: str = "strip",
    lower: bool = False,
    length: str = "distinct",
) -> DataFrame:
    """``(doc_id, doc_len)`` for every document, also the empty ones."""
    rows = docs.select(F.col(id_col).alias("doc_id"), _tokens(text_col, mode, lower).alias("k"))
    return rows.select("doc_id", _length("k", length).alias("doc_len"))


def corpus_stats(stats: DataFrame) -> DataFrame:
    """One row ``(n_docs, avg_len)``."""
    return stats.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("doc_len").alias("avg_len"))


def document_frequency(pairs: DataFrame) -> DataFrame:
    """Documents per term, from distinct pairs."""
    return pairs.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


@dataclass(frozen=True)
class Index:
    """``postings(term, doc_id, doc_len, tf)`` and ``docs(doc_id, doc_len)``.

    ``blocks`` are :func:`impact_blocks` of the postings, or None. The postings and blocks of a
    saved index also have the ``bucket`` (of ``buckets``) of their term, by which its files
    are foldered. ``counted`` are the rows (doc_id, doc_len, c) that both are made of, or None, and
    ``repeats`` tells whether a doc_id comes twice in them.
    """

    postings: DataFrame
    docs: DataFrame
    buckets: int | None = None
    blocks: DataFrame | None = None
    counted: DataFrame | None = None
    repeats: bool = False


def impact_block() -> Column:
    """The block of a posting's document."""
    return F.floor(F.col("doc_id") / IMPACT_BLOCK).cast("bigint")


def impact_blocks(postings: DataFrame) -> DataFrame:
    """``(term, block, n, max_tf, min_len)``: what bounds a term's share of any score in a block of documents.

    A share rises with the term's frequency and falls with the document's length, so the largest
    of the one and the smallest of the other bound it for any parameters.
    """
    return postings.groupBy("term", impact_block().alias("block")).agg(
        F.count(F.lit(1)).alias("n"), F.max("tf").alias("max_tf"), F.min("doc_len").alias("min_len")
    )


def build_index(docs: DataFrame, length: str = "distinct", mode: str = "strip", lower: bool = False) -> Index:
    """Index of ``docs(doc_id, text)``; lazy, without a shuffle unless a doc_id comes twice."""
    rows = _count_rows(docs, "doc_id", "text", mode, lower, length)
    repeats = _repeats(rows)
    return Index(_entries(rows, repeats), rows.select("doc_id", "doc_len"), counted=rows, repeats=repeats)


def _place() -> Column:
    """A number that tells nearly all terms and blocks apart, by bucket: a sort compares it before anything else."""
    term = F.shiftleft(F.shiftrightunsigned(F.xxhash64("term"), 33), 24)
    return F.shiftleft(F.col("bucket").cast("bigint"), 55).bitwiseOR(term).bitwiseOR(F.col("block").bitwiseAND(F.lit((1 << 24) - 1)))


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per term and block of rows sorted by them. No more is held than a batch and a block."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
        if not rows.num_rows:
            continue
        fresh = np.zeros(rows.num_rows, bool)
        fresh[0] = True
        for c in ("term", "block"):
            column = rows[c].combine_chunks()
            a, b = column.slice(1), column.slice(0, len(column) - 1)
            differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
            fresh[1:] |= differ | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
        starts = np.flatnonzero(fresh)
        if len(starts) > 1:
            yield _rows_of(rows.slice(0, starts[-1]), starts[:-1])
        held = rows.slice(starts[-1])
    if held is not None:
        yield _rows_of(held, np.zeros(1, np.int64))


def _rows_of(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    columns = {c: rows[c].combine_chunks() for c in rows.column_names}
    columns = {c: x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for c, x in columns.items()}
    ends = np.append(starts, rows.num_rows)
    entries = pa.StructArray.from_arrays([columns[c] for c in ENTRY], names=ENTRY)
    out = {
        "term": columns["term"].take(pa.array(starts)),
        "block": columns["block"].take(pa.array(starts)),
        "n": pa.array(np.diff(ends)),
        "max_tf": pa.array(np.maximum.reduceat(columns["tf"].to_numpy(zero_copy_only=False), starts)),
        "min_len": pa.array(np.minimum.reduceat(columns["doc_len"].to_numpy(zero_copy_only=False), starts)),
        "entries": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries),
        "bucket": columns["bucket"].take(pa.array(starts)),
    }
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def save_index(index: Index, path: str, buckets: int = 64) -> None:
    """Write an index for :func:`load_index`; a frequent term fills several files.

    A row has the postings of a term in one impact block and what bounds them. All rows of a block are dealt
    to the same task once, sorted there, and put together as they come. Few buckets are cut into slices of terms,
    so that every core writes. A text is tokenized once for postings and lengths.
    """
    postings, docs = index.postings, index.docs
    if index.counted is not None:
        rows = materialize(index.counted, "counted")  # used twice
        postings, docs = _entries(rows, index.repeats), rows.select("doc_id", "doc_len")
    slices = -(-WRITERS * postings.sparkSession.sparkContext.defaultParallelism // buckets)
    dealt = {
        "bucket": term_bucket("term", buckets),
        "block": impact_block(),
        "__near": F.floor(F.col("doc_id") / BLOCK),
        "__slice": F.pmod(F.xxhash64("term", F.lit("slice")), F.lit(slices)),
    }
    keys = ("bucket", "__near", "__slice")
    placed = postings.withColumns(dealt).repartition(*keys).sortWithinPartitions(_place(), "term", "block", "doc_id")
    placed = placed.select("term", "block", "doc_id", "doc_len", "tf", "bucket")
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    entry = ", ".join(f"{c}: {kinds[c]}" for c in ENTRY)
    put = placed.mapInArrow(
        _put_together,
        f"term {kinds['term']}, block bigint, n bigint, max_tf {kinds['tf']}, min_len {kinds['doc_len']}, "
        f"entries array<struct<{entry}>>, bucket {kinds['bucket']}",
    )
    write_buckets(put, f"{path}/postings", buckets)
    docs.write.mode("overwrite").parquet(f"{path}/docs")


def read_postings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, int]:
    """Postings and impact blocks of a saved index, each with its bucket, and the number of buckets."""
    rows, buckets = read_layout(spark, f"{path}/postings")
    postings = rows.select("term", F.explode("entries").alias("e"), "bucket")
    return postings.select("term", "e.doc_id", "e.doc_len", "e.tf", "bucket"), rows.drop("entries"), buckets


def load_index(spark: SparkSession, path: str) -> Index:
    """A saved index; a search reads only the buckets of the words asked for."""
    postings, blocks, buckets = read_postings(spark, path)
    return Index(postings, spark.read.parquet(f"{path}/docs"), buckets, blocks)


def _block(block_size: int) -> Column:
    return F.floor(F.col("doc_id") / F.lit(block_size)).cast("bigint").alias("block")


def index_sorted(pairs: DataFrame, block_size: int = BLOCK) -> DataFrame:
    """``(term, block, n, doc_ids)`` with ascending ids, from distinct pairs.

    A block covers ``block_size`` neighbouring ids. That bounds every row and
    spreads a term found in a third of all documents over many tasks; reading a
    term's blocks in order gives its whole posting list.
    """
    return (
        pairs.groupBy("term", _block(block_size))
        .agg(F.sort_array(F.collect_list("doc_id")).alias("doc_ids"))
        .select("term", "block", F.size("doc_ids").cast("bigint").alias("n"), "doc_ids")
    )


def index_single_pass(postings: DataFrame, block_size: int = BLOCK) -> DataFrame:
    """``(term, block, n, postings)`` with (doc_id, tf) entries, from term frequencies."""
    entry = F.struct("doc_id", "tf")
    return (
        postings.groupBy("term", _block(block_size))
        .agg(F.sort_array(F.collect_list(entry)).alias("postings"))
        .select("term", "block", F.size("postings").cast("bigint").alias("n"), "postings")
    )


def lookup_term(index: DataFrame, term: str) -> DataFrame:
    """Document ids of one term, case-sensitive; no rows for an unknown term."""
    return index.filter(F.col("term") == term).select(F.explode("doc_ids").alias("doc_id"))


def read_index(spark: SparkSession, path: str, term: str | None = None) -> DataFrame:
    """A saved index; with ``term``, only that term's bucket is read."""
    saved, buckets = read_layout(spark, path)
    if term is not None:
        saved = saved.filter(F.col("bucket") == term_bucket(F.lit(term), buckets))
        saved = saved.filter(F.col("term") == term)
    return saved.drop("bucket")


def index_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: (term, doc_id) entries in only one of two indexes, and the entries of each."""
    sides = [
        x.select("term", F.explode("doc_ids").alias("doc_id"), F.lit(i).alias("a"), F.lit(1 - i).alias("b"))
        for x, i in ((a, 1), (b, 0))
    ]
    sums = sides[0].unionByName(sides[1]).groupBy("term", "doc_id").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return sums.agg(
        F.count_if(F.col("a") != F.col("b")).alias("n_differences"),
        F.sum("a").alias("n_sorted"),
        F.sum("b").alias("n_single_pass"),
    )


def incidence_top(pairs: DataFrame, docs: DataFrame, top: int = 10) -> DataFrame:
    """0/1 per document for the ``top`` most frequent terms, columns t1, t2, ...

    The full matrix stays in long form (:func:`token_doc_pairs`): a column per
    term only works for a few terms.
    """
    best = document_frequency(pairs).orderBy(F.desc("df"), "term").limit(top)
    ranks = best.agg(F.sort_array(F.collect_list(F.struct(-F.col("df"), "term"))).alias("r"))
    ranked = ranks.select(F.posexplode("r").alias("pos", "t")).select(
        F.col("t.term").alias("term"), (F.col("pos") + 1).alias("rank")
    )
    hits = pairs.join(F.broadcast(ranked), "term")  # `top` rows
    flags = hits.groupBy("doc_id").pivot("rank", list(range(1, top + 1))).agg(F.max(F.lit(1)))
    names = [F.coalesce(F.col(str(i)), F.lit(0)).alias(f"t{i}") for i in range(1, top + 1)]
    return docs.select("doc_id").join(flags, "doc_id", "left").select("doc_id", *names)
