"""Index and search queries over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarack.functions.text import strip_punctuation
from tamarack.operators import index as ix
from tamarack.operators import search as se
from tamarack.operators import segments as sg
from tamarack.plans.registry import Tables, query
from tamarack.plans.tabular import SQL_PUNCT, TOKENS_SQL
from tamarack.session import scratch_path
from tamarack.sources import sinks

BLOCK = 256

TOK = f"tok AS (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents)"
LENS = f"lens AS (SELECT doc_id, len(list_distinct({TOKENS_SQL})) AS doc_len FROM documents)"
TF = "tf AS (SELECT term, doc_id, count(*) AS tf FROM tok GROUP BY ALL)"


def pairs(t: Tables, **options):
    return ix.token_doc_pairs(t("documents"), **options)


@query("token_doc_pairs", f"WITH {TOK} SELECT DISTINCT term, doc_id FROM tok")
def token_doc_pairs(t: Tables):
    return pairs(t)


@query("term_frequency", f"WITH {TOK}, {TF} SELECT term, doc_id, tf FROM tf")
def term_frequency(t: Tables):
    return ix.term_frequency(t("documents")).select("term", "doc_id", "tf")


@query(
    "doc_length",
    f"WITH {LENS} SELECT doc_id, doc_len, len({TOKENS_SQL}) AS total_len FROM lens JOIN documents USING (doc_id)",
)
def doc_length(t: Tables):
    """Both lengths, the distinct one being the default."""
    total = ix.doc_stats(t("documents"), length="total").withColumnRenamed("doc_len", "total_len")
    return ix.doc_stats(t("documents")).join(total, "doc_id")


@query(
    "corpus_stats",
    f"WITH {LENS} SELECT count(*) AS n_docs, round(avg(doc_len), 6) AS avg_len FROM lens",
)
def corpus_stats(t: Tables):
    return ix.corpus_stats(ix.doc_stats(t("documents"))).withColumn("avg_len", F.round("avg_len", 6))


@query("document_frequency", f"WITH {TOK} SELECT term, count(DISTINCT doc_id) AS df FROM tok GROUP BY term")
def document_frequency(t: Tables):
    return ix.document_frequency(pairs(t))


@query(
    "pivot_incidence",
    f"WITH {TOK}, top AS (SELECT term, row_number() OVER (ORDER BY count(DISTINCT doc_id) DESC, term) AS rank "
    "FROM tok GROUP BY term), hits AS (SELECT DISTINCT doc_id, rank FROM tok JOIN top USING (term) WHERE rank <= 10) "
    "SELECT d.doc_id, "
    + ", ".join(f"CAST(count(CASE WHEN rank = {i} THEN 1 END) AS INTEGER) AS t{i}" for i in range(1, 11))
    + " FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id",
)
def pivot_incidence(t: Tables):
    return ix.incidence_top(pairs(t), t("documents"), 10)


def postings_sql(entry: str, name: str) -> str:
    """Posting blocks as text, in the check's SQL."""
    return (
        f"WITH {TOK}, {TF} SELECT term, doc_id // {BLOCK} AS block, count(*) AS n, "
        f"string_agg({entry}, ',' ORDER BY doc_id) AS {name} FROM tf GROUP BY ALL"
    )


IDS_SQL = postings_sql("CAST(doc_id AS VARCHAR)", "doc_ids")


@query("inverted_index_sorted", IDS_SQL)
def inverted_index_sorted(t: Tables):
    return ix.index_sorted(pairs(t), BLOCK).withColumn("doc_ids", F.array_join("doc_ids", ","))


@query("inverted_index_single_pass", postings_sql("doc_id || ':' || tf", "postings"))
def inverted_index_single_pass(t: Tables):
    entries = F.transform("postings", lambda p: F.concat_ws(":", p["doc_id"], p["tf"]))
    built = ix.index_single_pass(ix.term_frequency(t("documents")), BLOCK)
    return built.withColumn("postings", F.array_join(entries, ","))


@query("sink_index", IDS_SQL)
def sink_index(t: Tables):
    path = scratch_path(t.spark, "index")
    sinks.write_index(ix.index_sorted(pairs(t), BLOCK), path, buckets=8)
    return ix.read_index(t.spark, path).withColumn("doc_ids", F.array_join("doc_ids", ","))


@query("lookup_term", f"WITH {TOK} SELECT DISTINCT doc_id FROM tok WHERE term = 'the'")
def lookup_term(t: Tables):
    """From the saved index: one bucket is read."""
    path = scratch_path(t.spark, "index")
    sinks.write_index(ix.index_sorted(pairs(t), BLOCK), path, buckets=8)
    return ix.lookup_term(ix.read_index(t.spark, path, "the"), "the")


@query(
    "index_equivalence",
    f"WITH {TOK}, e AS (SELECT DISTINCT term, doc_id FROM tok) SELECT CAST(0 AS BIGINT) AS n_differences, "
    "count(*) AS n_sorted, count(*) AS n_single_pass FROM e",
)
def index_equivalence(t: Tables):
    """Entries in only one of the two indexes, and the entries of each."""
    built = ix.index_single_pass(ix.term_frequency(t("documents")), BLOCK)
    ids = F.transform("postings", lambda p: p["doc_id"])
    return ix.index_differences(ix.index_sorted(pairs(t), 64), built.withColumn("doc_ids", ids))


def match_sql(queries: str) -> str:
    """All matching documents of a table ``qs(qid, text, mode, ranked)``, in the check's SQL."""
    return f"""WITH {TOK}, {TF}, {LENS}, qs AS ({queries}),
      c AS (SELECT count(*) AS n_docs, avg(doc_len) AS avg_len FROM lens),
      w AS (SELECT qid, mode, ranked, list_distinct(list_filter(string_split_regex(text, '\\s+'),
                   lambda x: x <> '')) AS w FROM qs),
      qt AS (SELECT qid, mode, ranked, len(w) AS n_terms, unnest(w) AS term FROM w),
      dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
      m AS (SELECT qid, mode, ranked, n_terms, doc_id, count(*) AS n_matched,
              round(sum(ln(n_docs / CAST(df AS DOUBLE)) * (11 * tf.tf
                    / (CAST(10 AS DOUBLE) * (CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * doc_len / avg_len)
                       + tf.tf))), 6) AS score
            FROM qt JOIN tf USING (term) JOIN dfs USING (term) JOIN lens USING (doc_id), c
            GROUP BY ALL HAVING mode = 'or' OR count(*) = n_terms)"""


def _one(t: Tables, text: str, mode: str, ranked: bool):
    return t.spark.createDataFrame([(0, text, mode, ranked)], "qid int, text string, mode string, ranked boolean")


def _one_sql(text: str, mode: str, ranked: bool, cols: str) -> str:
    q = f"SELECT 0 AS qid, '{text}' AS text, '{mode}' AS mode, {ranked} AS ranked"
    return match_sql(q) + f" SELECT {cols} FROM m"


@query(
    "join_postings_query",
    f"WITH {TOK}, {TF} SELECT term, doc_id, tf FROM tf WHERE term IN ('the', 'und', 'Nobody')",
)
def join_postings_query(t: Tables):
    asked = t.spark.createDataFrame([("the",), ("und",), ("Nobody",)], "term string")
    hits = se.join_small(ix.term_frequency(t("documents")), asked, ["term"], "left_semi")
    return hits.select("term", "doc_id", "tf")


@query("search_and", _one_sql("the of and", "and", False, "doc_id, n_matched"))
def search_and(t: Tables):
    found = se.search_all(ix.build_index(t("documents")), _one(t, "the of and", " AND ", False))
    return found.select("doc_id", "n_matched")


@query("search_or", _one_sql("de und the Nobody", "or", False, "doc_id, n_matched"))
def search_or(t: Tables):
    found = se.search_all(ix.build_index(t("documents")), _one(t, "de und the Nobody", " OR ", False))
    return found.select("doc_id", "n_matched")


@query("bm25_and", _one_sql("the that with the", "and", True, "doc_id, score"))
def bm25_and(t: Tables):
    """A repeated word counts once."""
    found = se.search_all(ix.build_index(t("documents")), _one(t, "the that with the", "and", True))
    return found.select("doc_id", "score")


@query("bm25_or", _one_sql("worthless die und with", "or", True, "doc_id, score"))
def bm25_or(t: Tables):
    found = se.search_all(ix.build_index(t("documents")), _one(t, "worthless die und with", "or", True))
    return found.select("doc_id", "score")


MODE = "CASE WHEN item_id % 2 = 0 THEN 'or' ELSE 'and' END"


BATCH_SQL = (
    match_sql(
        f"SELECT item_id AS qid, regexp_replace(text, '{SQL_PUNCT}', '', 'g') AS text, {MODE} AS mode, "
        "item_id % 4 < 2 AS ranked FROM benchmark"
    )
    + """ SELECT qid, rank, doc_id, n_matched, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY
          CASE WHEN ranked THEN -score WHEN mode = 'or' THEN -CAST(n_matched AS DOUBLE) ELSE 0 END, doc_id) AS rank
          FROM m) WHERE rank <= 10"""
)


def _passages(t: Tables):
    """Every benchmark passage is a query: both modes, ranked and unranked."""
    mode = F.when(F.col("item_id") % 2 == 0, "or").otherwise("and")
    return t("benchmark").select(
        F.col("item_id").alias("qid"),
        strip_punctuation("text").alias("text"),
        mode.alias("mode"),
        (F.col("item_id") % 4 < 2).alias("ranked"),
    )


@query("search_batch", BATCH_SQL)
def search_batch(t: Tables):
    return se.search_batch(ix.build_index(t("documents")), _passages(t), k=10)


@query("search_saved_index", BATCH_SQL)
def search_saved_index(t: Tables):
    """The same search over an index built and saved before."""
    path = scratch_path(t.spark, "search-index")
    ix.save_index(ix.build_index(t("documents")), path, buckets=8)
    return se.search_batch(ix.load_index(t.spark, path), _passages(t), k=10)


@query("search_segments", BATCH_SQL)
def search_segments(t: Tables):
    """The same search over an index that grew in batches: some texts replaced, some deleted and added again."""
    docs, path = t("documents").select("doc_id", "text"), scratch_path(t.spark, "segments")
    even, third = F.col("doc_id") % 2 == 0, F.col("doc_id") % 3 == 0
    sg.create_segments(t.spark, path, buckets=8)
    old = docs.withColumn("text", F.when(third, F.lit("an older text")).otherwise(F.col("text")))
    sg.add_segment(t.spark, path, old.filter(even), "first")
    sg.delete_documents(t.spark, path, docs.filter(even & (F.col("doc_id") % 5 == 0)))
    sg.add_segment(t.spark, path, docs.filter(~even | third | (F.col("doc_id") % 5 == 0)), "second")
    sg.merge_segments(t.spark, path, "merged")
    sg.drop_unused(t.spark, path)
    return se.search_batch(sg.load_segments(t.spark, path), _passages(t), k=10)


@query(
    "informativeness",
    """WITH tok AS (SELECT DISTINCT lang AS cluster, doc_id, unnest({0}) AS term FROM documents),
      n AS (SELECT lang AS cluster, count(*) AS n_pages FROM documents GROUP BY lang),
      c AS (SELECT cluster, term, count(*) AS df FROM tok GROUP BY ALL)
      SELECT cluster, rank, term, df, round(ln(n_pages / CAST(df AS DOUBLE)), 6) AS score FROM
      (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY df, term) AS rank FROM c) JOIN n USING (cluster)
      WHERE rank <= 20""".format(TOKENS_SQL),
)
def informativeness(t: Tables):
    docs = t("documents").withColumnRenamed("lang", "cluster")
    sizes = docs.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_pages"))
    return se.informative_terms(ix.token_doc_pairs(docs, keep=("cluster",)), sizes)
