"""The registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm import alignment, codes, pii, quality
from tamarack.llm.gram_join import jaccard_components
from tamarack.llm.licenses import scan_licenses
from tamarack.llm.minhash import near_components
from tamarack.llm.mixing import mix
from tamarack.llm.nearest import nearest
from tamarack.llm.phrases import remove_repeats
from tamarack.llm.pieces import round_trip
from tamarack.llm.sharding import shard_rows
from tamarack.llm.topk import top_k

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


@_query
def op1_license_scan(spark: SparkSession, root: str) -> DataFrame:
    """Licenses of all documents."""
    return scan_licenses(_table(spark, root, "documents")).drop("finds")


@_query
def op2_sentencepiece(spark: SparkSession, root: str) -> DataFrame:
    """Piece ids of all documents, and whether decoding them gives the text again."""
    docs = _table(spark, root, "documents").select("doc_id", "text")
    return round_trip(docs, TOKENIZER).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("exact"),
    )


@_query
def op3_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    """Quality of all documents, learned from the labels that are not held out."""
    docs = _table(spark, root, "documents")
    machine = quality.train(docs, _table(spark, root, "labels"))
    scored = quality.classify(docs, machine)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


@_query
def op4_pii_disclosure(spark: SparkSession, root: str) -> DataFrame:
    """Personal data of all documents, and the terms that disclose whose it is."""
    return pii.report(_table(spark, root, "documents"))


def _places_sql(kind: str, rank: int, pattern: str) -> str:
    """Matches of a pattern with their places, from the texts between them."""
    return f"""SELECT row_id, doc_id, text, {rank} AS rank, '{kind}' AS kind, unnest(m) AS value, unnest(list_transform(range(1, len(m) + 1),
            lambda i: coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
                + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)))::BIGINT AS start
        FROM (SELECT row_id, doc_id, text, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS g FROM d)"""


_WRITTEN_SQL = (
    "coalesce(string_agg(kind || ':' || start || ':' || (start + length(value)), ',' ORDER BY start, rank), '')"
)

SQL["op4_pii_disclosure"] = (
    r"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
matched AS (
    """
    + "\n    UNION ALL ".join(
        [
            _places_sql("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            _places_sql("ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            _places_sql("card", 2, r"[0-9]([\x20-]?[0-9])+"),
            _places_sql("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]"),
        ]
    )
    + r"""),
numbered AS (SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS digits FROM matched),
base AS (
    SELECT * FROM numbered WHERE CASE kind
        WHEN 'ip' THEN len(list_filter(string_split(value, '.'), lambda p: p::HUGEINT > 255)) = 0
        WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
        WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(
            range(1, length(digits) + 1), lambda i: CASE WHEN i % 2 = 1 THEN reverse(digits)[i]::INTEGER
                ELSE (2 * reverse(digits)[i]::INTEGER) // 10 + (2 * reverse(digits)[i]::INTEGER) % 10 END)) % 10 = 0
        ELSE true END),
held AS (SELECT *, kind || ':' || lower(value) AS entity FROM base),
rich AS (  -- an entity in one text only has no term in two
    SELECT entity FROM held GROUP BY entity HAVING count(DISTINCT text) >= 2),
near AS (
    SELECT row_id, text, entity, unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))) AS term
    FROM (SELECT DISTINCT row_id, text, entity FROM held WHERE entity IN (SELECT entity FROM rich))),
total AS (SELECT count(*) AS n FROM d),
of_entity AS (SELECT entity, count(DISTINCT (doc_id, text)) AS df_e FROM held GROUP BY entity),
of_pair AS (
    SELECT entity, term, count(DISTINCT (row_id)) AS df_te, count(DISTINCT text) AS texts FROM (
        SELECT min(row_id) AS row_id, near.text, entity, term FROM near JOIN d USING (row_id)
        GROUP BY doc_id, near.text, entity, term)
    GROUP BY entity, term HAVING count(DISTINCT text) >= 2),
of_term AS (
    SELECT term, count(*) AS df_t FROM (
        SELECT DISTINCT row_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM d)
    GROUP BY term),
told AS (
    SELECT entity, term FROM of_pair JOIN of_entity USING (entity) JOIN of_term USING (term), total
    WHERE df_e < n AND ln(n * df_te / (df_t * df_e)::DOUBLE) / ln(n / df_e::DOUBLE) >= 0.9),
hidden AS (SELECT DISTINCT row_id, term FROM near JOIN told USING (entity, term)),
word AS (
    """
    + _places_sql("term", 4, r"[\p{L}\p{N}]+").replace("FROM d)", "FROM d WHERE row_id IN (SELECT row_id FROM hidden))")
    + rf"""),
extra AS (
    SELECT word.* FROM word JOIN hidden ON hidden.row_id = word.row_id AND hidden.term = lower(word.value)
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row_id = word.row_id
        AND b.start < word.start + length(word.value) AND word.start < b.start + length(b.value))),
found AS (SELECT row_id, kind, rank, value, start FROM base),
every AS (SELECT * FROM found UNION ALL SELECT row_id, kind, rank, value, start FROM extra),
counted AS (
    SELECT row_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
        count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone, {_WRITTEN_SQL} AS listed
    FROM found GROUP BY row_id),
listed AS (SELECT row_id, {_WRITTEN_SQL} AS spans FROM every GROUP BY row_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
    coalesce(n_phone, 0) AS n_phone, sha256(coalesce(listed, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN counted USING (row_id) LEFT JOIN listed USING (row_id)
"""
)


@_query
def op5_mix_sources(spark: SparkSession, root: str) -> DataFrame:
    """Words that a mix of 5:2:1 weighted sources takes of every document."""
    return mix(_table(spark, root, "documents")).drop("source_key")


SQL["op5_mix_sources"] = """
WITH d AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
    FROM documents),
sums AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
    FROM d GROUP BY source),
caps AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM sums),
levels AS (
    SELECT cap / weight AS ratio, source,
        (0.75::DOUBLE * sum(cap) OVER () - coalesce(sum(cap) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM caps
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
    SELECT level FROM levels WHERE level <= ratio * (1 + 1e-12) ORDER BY ratio, source NULLS LAST LIMIT 1),
plan AS (SELECT caps.*, least(cap, level * weight) AS target FROM caps, level),
words AS (  -- of a block: 32, or an eighth of the smallest target
    SELECT greatest(1, least(32, coalesce(floor(min(target) FILTER (target > 0) / 8), 32)))::BIGINT AS w FROM plan),
lines AS (SELECT plan.*, ceil(source_size * 2 / w::DOUBLE)::BIGINT AS blocks FROM plan, words),
won AS (  -- the quotients, one by one
    SELECT source, count(*)::BIGINT AS quota
    FROM (SELECT source, target, unnest(generate_series(1, blocks)) AS j FROM lines), words
    WHERE target / (2 * j - 1) >= w / 2.0 GROUP BY source),
both_kinds AS (
    SELECT lines.source, blocks, coalesce(quota, 0) AS quota, blocks - coalesce(quota, 0) AS others
    FROM lines LEFT JOIN won ON lines.source IS NOT DISTINCT FROM won.source),
dealt AS (  -- blocks numbered over all sources go round 16 shards
    SELECT source, 'quota' AS kind, unnest(range(before, before + quota)) % 16 AS shard
    FROM (SELECT *, (sum(quota) OVER (ORDER BY source NULLS LAST) - quota)::BIGINT AS before FROM both_kinds)
    UNION ALL
    SELECT source, 'others', unnest(range(before, before + others)) % 16
    FROM (SELECT *, (sum(others) OVER (ORDER BY source NULLS LAST) - others)::BIGINT AS before FROM both_kinds)),
shards AS (
    SELECT b.source, shard, count(kind) FILTER (kind = 'quota') AS quota, count(kind) AS n
    FROM both_kinds b CROSS JOIN range(16) AS r(shard) LEFT JOIN dealt x USING (shard)
    WHERE x.source IS NOT DISTINCT FROM b.source OR x.kind IS NULL GROUP BY b.source, shard),
runs AS (
    SELECT *, (sum(n) OVER (PARTITION BY source ORDER BY shard) - n)::BIGINT AS first,
        ('0x' || substr(md5('mix-1:' || concat_ws(':', shard, coalesce(source, ''))), 1, 8))::BIGINT % n AS start
    FROM shards WHERE n > 0),
chosen AS (  -- the words of each selected block on its source's line
    SELECT source, (first + b) * w AS lo, (first + b + 1) * w AS hi
    FROM (SELECT *, unnest(range(n)) AS b FROM runs), words
    WHERE (b + 1 + start) * quota // n > (b + start) * quota // n),
lined AS (
    SELECT *, row_number() OVER () AS row_id, sum(size) OVER (
        PARTITION BY source ORDER BY md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, size) - size AS at0
    FROM d),
passes AS (
    SELECT row_id, l.source, size, at0 + p * source_size AS a, at0 + p * source_size + size AS b
    FROM lined l JOIN plan ON l.source IS NOT DISTINCT FROM plan.source, (VALUES (0), (1)) AS t(p) WHERE size > 0),
given AS (
    SELECT row_id, sum(least(hi, b) - greatest(lo, a))::BIGINT AS taken
    FROM passes JOIN chosen ON passes.source IS NOT DISTINCT FROM chosen.source AND lo < b AND a < hi GROUP BY row_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken
FROM lined l JOIN plan ON l.source IS NOT DISTINCT FROM plan.source LEFT JOIN given USING (row_id)
"""


@_query
def op6_label_propagation(spark: SparkSession, root: str) -> DataFrame:
    """All documents in 16 shards of equal row counts, equal texts together."""
    return shard_rows(_table(spark, root, "documents"))


@_query
def op7_block_nearest(spark: SparkSession, root: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    vectors = _table(spark, root, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


SQL["op7_block_nearest"] = """
WITH v AS (
    SELECT vec_id, min(list_transform(embedding, lambda x: x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    GROUP BY vec_id),
pairs AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.e, d.e) AS score
    FROM v q JOIN v d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id AND len(q.e) = len(d.e)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@_query
def op8_minhash_forest(spark: SparkSession, root: str) -> DataFrame:
    """Groups of near duplicates among all documents."""
    return near_components(_table(spark, root, "documents"))


SQL["op8_minhash_forest"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents),
sh AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s
    FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON other = a),
least_of AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
    least(d.doc_id, coalesce(other, d.doc_id)) AS component_id,
    d.doc_id = least(d.doc_id, coalesce(other, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of l ON l.doc_id = d.doc_id
"""


@_query
def op9_repeated_phrases(spark: SparkSession, root: str) -> DataFrame:
    """Words of all documents left after 20-word passages that stand earlier are removed."""
    left = remove_repeats(_table(spark, root, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op9_repeated_phrases"] = r"""
WITH w AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
win AS (
    SELECT doc_id, unnest(range(1, len(ws) - 18)) AS p, ws FROM w WHERE len(ws) >= 20),
marked AS (
    SELECT doc_id, p, row_number() OVER (PARTITION BY array_to_string(ws[p:p + 19], ' ') ORDER BY doc_id, p) > 1 AS later
    FROM win),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS place FROM marked WHERE later),
lost AS (SELECT doc_id, list(place) AS ats FROM gone GROUP BY doc_id),
kept AS (
    SELECT w.doc_id, ws, coalesce(len(ats), 0) AS n_removed,
        CASE WHEN ats IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ats, i)) END AS k
    FROM w LEFT JOIN lost ON lost.doc_id = w.doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
    sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
"""


@_query
def op10_exact_top_k(spark: SparkSession, root: str) -> DataFrame:
    """The 5 largest whole-number products of every fiftieth vector."""
    vectors = _table(spark, root, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


SQL["op10_exact_top_k"] = """
WITH v AS (
    SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id),
pairs AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.e::DOUBLE[], d.e::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id AND len(q.e) = len(d.e)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@_query
def op11_vector_codes(spark: SparkSession, root: str) -> DataFrame:
    """Four-byte codes of all vectors, and what they lose."""
    return codes.encode(_table(spark, root, "embeddings"))


def _assigned_sql(n: int) -> str:
    """The nearest entry of every part in the codebooks of round ``n``, as struct(d, i)."""
    return f"""a{n} AS MATERIALIZED (
    SELECT p.r, p.j, min({{'d': (list_inner_product(v, v) + list_inner_product(e, e) - 2 * list_inner_product(v, e))::BIGINT, 'i': i}}) AS best
    FROM p JOIN b{n} USING (j) GROUP BY p.r, p.j)"""


def _improved_sql(n: int) -> str:
    """The codebooks after round ``n``."""
    return f"""m{n} AS (
    SELECT j, i, list(floor(total / n) ORDER BY place) AS e FROM (
        SELECT a.j, a.best.i AS i, place, sum(v[place]) AS total, count(*)::DOUBLE AS n
        FROM a{n} a JOIN p USING (r, j), range(1, len(v) + 1) AS t(place) GROUP BY ALL) GROUP BY j, i),
b{n + 1} AS MATERIALIZED (SELECT j, i, coalesce(m.e, b.e) AS e FROM b{n} b LEFT JOIN m{n} m USING (j, i))"""


SQL["op11_vector_codes"] = f"""
WITH k AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
    SELECT r, vec_id, j, x[j * len(x) // 4 + 1:(j + 1) * len(x) // 4] AS v FROM k, range(4) AS t(j)),
b0 AS MATERIALIZED (
    SELECT j, i, v AS e FROM (SELECT *, row_number() OVER (PARTITION BY j ORDER BY vec_id NULLS LAST, v) - 1 AS i FROM p)
    WHERE i < 256),
{", ".join(_assigned_sql(n) + ", " + _improved_sql(n) for n in range(4))},
{_assigned_sql(4)},
coded AS (
    SELECT r, string_agg(printf('%02x', best.i), '' ORDER BY j) AS code, sum(best.d)::BIGINT AS error FROM a4 GROUP BY r),
books AS (
    SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: x::BIGINT), ','), ',' ORDER BY j, i)) AS h FROM b4)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256
FROM k JOIN coded USING (r), books
"""


@_query
def op12_token_alignment(spark: SparkSession, root: str) -> DataFrame:
    """Tokens of two tokenizers in all documents, aligned and linked."""
    docs = _table(spark, root, "documents").select("doc_id", "text")
    return alignment.link_report(docs, BYTE_TOKENIZER, TOKENIZER)


@_query
def op13_gram_join(spark: SparkSession, root: str) -> DataFrame:
    """Groups of documents whose four-word shingles are alike."""
    return jaccard_components(_table(spark, root, "documents"))


SQL["op13_gram_join"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents),
sh AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s
    FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON other = a),
least_of AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of l ON l.doc_id = d.doc_id
"""
