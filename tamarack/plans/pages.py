"""Link, paragraph, record, sentiment and cluster queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarack.functions import html as hx
from tamarack.operators import pagecluster as pc
from tamarack.operators import records as rec
from tamarack.operators import sentiment as sm
from tamarack.operators import tabular as tab
from tamarack.plans.registry import Tables, query
from tamarack.plans.tabular import SQL_SPACE, TOKENS_SQL, keep_punct_sql
from tamarack.plans.views import matches, with_views
from tamarack.session import materialize

HIDDEN_SQL = r"regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g')"

# The pages, and one more for each with forms of links and references that they lack.
ODD_HTML = """'<p>Fish &amp; chips &lt;b&gt; &copy;<a data-href="no" title="a > b href=no" HREF=u' || page_id
    || ' class=x>x</a><p>&quot;<a href=''/q?a=1&amp;b=2''>y</a><a name="n">z</a><a
    href = "">e</a><abbr href="no">'"""
PAGES_SQL = f"(SELECT page_id, url, html FROM pages UNION ALL SELECT -1 - page_id, url, {ODD_HTML} FROM pages)"
ODD_HTML_SPARK = ODD_HTML.replace("''", r"\'")


def odd_pages(t: Tables):
    pages = t("pages").select("page_id", "url", "html")
    odd = pages.select((-1 - F.col("page_id")).alias("page_id"), "url", F.expr(ODD_HTML_SPARK).alias("html"))
    return pages.unionByName(odd)


# All attributes of each tag first, then the one asked for among them.
_VALUE_SQL = r""""[^"]*"|''[^'']*''|[^\s"''>]+"""
_ATTRIBUTE_SQL = rf"""\s+[^\s=>"'']+(?:\s*=\s*(?:{_VALUE_SQL}))?"""
LINKS_SQL = f"""SELECT page_id, url, unnest(range(len(l))) AS pos, unnest(l) AS href
    FROM (SELECT page_id, url, list_transform(list_filter(list_transform(
        regexp_extract_all({HIDDEN_SQL}, '(?i)<a((?:{_ATTRIBUTE_SQL})+)', 1),
        lambda x: regexp_extract(x, '(?i)^(?:{_ATTRIBUTE_SQL})*?\\s+href\\s*=\\s*({_VALUE_SQL})', 1)),
        lambda x: x <> ''), lambda x: replace(trim(x, '"'''), '&amp;', '&')) AS l FROM {PAGES_SQL})"""


@query("html_links", f"SELECT page_id, pos, href FROM ({LINKS_SQL})")
def html_links(t: Tables):
    return pc.page_links(odd_pages(t)).select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query(
    "resolve_link",
    f"""SELECT page_id, pos, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
          ELSE regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1)
               || CASE WHEN starts_with(href, '/') THEN '' ELSE '/' END || href END AS link FROM
        (SELECT page_id, url, pos * 2 AS pos, href FROM ({LINKS_SQL})
         UNION ALL SELECT page_id, url, pos * 2 + 1, 'HTTP://x.example/' || href FROM ({LINKS_SQL})
         UNION ALL SELECT page_id, url, -1 - pos, ltrim(href, '/') FROM ({LINKS_SQL}))""",
)
def resolve_link(t: Tables):
    """Each link rooted, absolute and relative."""
    pos = F.col("pos").cast("bigint")
    forms = [
        F.struct((pos * 2).alias("pos"), F.col("href")),
        F.struct((pos * 2 + 1).alias("pos"), F.concat(F.lit("HTTP://x.example/"), "href").alias("href")),
        F.struct((-1 - pos).alias("pos"), F.regexp_replace("href", "^/+", "").alias("href")),
    ]
    links = pc.page_links(odd_pages(t)).select("page_id", "url", F.inline(F.array(*forms)))
    return links.select("page_id", "pos", hx.resolve_link("url", "href").alias("link"))


# Tags that end a paragraph, for the check alone.
BLOCK_SQL = (
    r"(?i)</?(article|aside|blockquote|body|dd|div|dl|dt|footer|form|h[1-6r]|header|html|li|main|nav|ol|p|pre"
    r"|section|t[dhr]|table|ul)(\s[^>]*)?/?>"
)
PARAGRAPHS_SQL = (
    f"list_transform(list_filter(string_split(regexp_replace(regexp_replace({HIDDEN_SQL}, "
    f"'(?i)<p(?:\\s[^>]*)?>', chr(1) || chr(2), 'g'), '{BLOCK_SQL}', chr(1), 'g'), chr(1)), "
    "lambda x: starts_with(x, chr(2))), lambda x: regexp_replace(substr(x, 2), '<[^>]*>', '', 'g'))"
)
UNESCAPED_SQL = "{}"
for _name, _char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
    UNESCAPED_SQL = f"replace({UNESCAPED_SQL}, '&{_name};', '{_char}')"


def page_texts_sql() -> str:
    """Text of each page, in the check's SQL."""
    joined = UNESCAPED_SQL.replace("{}", f"array_to_string({PARAGRAPHS_SQL}, ' ')")
    return f"SELECT page_id, trim(regexp_replace({joined}, '{SQL_SPACE}+', ' ', 'g')) AS text FROM pages"


@query(
    "html_paragraphs",
    f"SELECT page_id, CAST(unnest(range(len(p))) AS INTEGER) AS pos, unnest(p) AS text FROM "
    f"(SELECT page_id, list_transform({PARAGRAPHS_SQL}, lambda y: {UNESCAPED_SQL.replace('{}', 'y')}) AS p FROM {PAGES_SQL})",
)
def html_paragraphs(t: Tables):
    return pc.page_paragraphs(odd_pages(t))


# Each kind of reference, and what it stands for; None where it stays.
REFERENCES = [
    ("it&apos;s", "it's"), ("&copy 2020", "© 2020"), ("&#150;", "–"), ("&NotEqual;", "≠"), ("&#x80;&#159", "€Ÿ"),
    ("&notit; &notin;", "¬it; ∉"), ("&ampx &ltb&gt", "&x <b>"), ("&NotEqualTilde;", "≂̸"), ("&copyright", "©right"),
    ("&#xE9;&#233;&eacute", "ééé"), ("&nope; & &; &#; &#x;", None), ("&#99999999999999999999;", None),
    ("&AMP;&QUOT&AElig;", '&"Æ'), ("&#38;amp;", "&amp;"), ("&frac12&frac14;", "½¼"), ("&hellip;&hellip", "…&hellip"),
]


def references_sql() -> str:
    """A document's id, its reference as text and in an attribute that ``&copy=`` follows, in the check's SQL."""
    cases = " ".join(f"WHEN {i} THEN '" + (told or ref).replace("'", "''") + "'" for i, (ref, told) in enumerate(REFERENCES))
    return (
        f"SELECT doc_id, doc_id || ': ' || CASE doc_id % {len(REFERENCES)} {cases} END || '!' AS text, "
        "'/q?a=' || doc_id || '&copy=1&b=©&c=3' AS href FROM documents"
    )


@query("html_references", references_sql())
def html_references(t: Tables):
    """References with and without semicolon, of any name, in paragraphs and in links."""
    kinds = F.array(*[F.lit(ref) for ref, _ in REFERENCES])
    ref = F.get(kinds, (F.col("doc_id") % len(REFERENCES)).cast("int"))
    link = F.concat(F.lit("<a href='/q?a="), "doc_id", F.lit("&copy=1&b=&copy&c=3'>x</a>"))
    page = F.concat(F.lit("<p>"), "doc_id", F.lit(": "), ref, F.lit("!</p>"), link)
    pages = t("documents").select("doc_id", page.alias("html"))
    return pages.select(
        "doc_id", F.get(hx.html_paragraphs("html"), 0).alias("text"), F.get(hx.html_links("html"), 0).alias("href")
    )


@query("page_texts", page_texts_sql())
def page_texts(t: Tables):
    return pc.page_texts(t("pages"))


def event_pages(t: Tables):
    """Event pages listing up to 50 matches each, one table row per match."""
    link = F.concat(F.lit("http://stats.example/fight-details/"), F.col("match_id").cast("string"))
    row = F.concat(
        F.lit('<tr class="r" data-link="'), link, F.lit('"><td><p>'), "fighter_a", F.lit("</p></td></tr>")
    )
    body = F.transform(F.sort_array(F.collect_list(F.struct("match_id", row.alias("r")))), lambda x: x["r"])
    head = '<html><!-- <tr data-link="no"> --><table><tr><th>Fights</th></tr>'
    return (
        matches(t)
        .groupBy(F.floor(F.col("match_id") / 50).alias("page_id"))
        .agg(F.concat(F.lit(head), F.array_join(body, "\n"), F.lit("</table></html>")).alias("html"))
    )


@query(
    "html_attr_rows",
    with_views("v_matches") + """SELECT match_id // 50 AS page_id,
        CAST(row_number() OVER (PARTITION BY match_id // 50 ORDER BY match_id) - 1 AS INTEGER) AS pos,
        'http://stats.example/fight-details/' || match_id AS link FROM v_matches""",
)
def html_attr_rows(t: Tables):
    links = F.posexplode(hx.html_attributes("html", "tr", "data-link")).alias("pos", "link")
    return event_pages(t).select("page_id", links)


SHOWN = ["qty", "n_lines", "qty_lo", "qty_hi"]


def _cell_values(sql: bool) -> list[tuple[str, str]]:
    """(first side, second side) of the nine value cells, as SQL both engines read."""
    number = "CAST({} AS VARCHAR)" if sql else "CAST({} AS STRING)"
    n = {c: number.format(c) for c in SHOWN}
    return [
        (n["n_lines"], n["qty_lo"]),
        (f"{n['qty_lo']} || ' of ' || {n['qty']}", f"{n['qty_hi']} || ' of ' || {n['qty']}"),
        (f"{n['qty_lo']} || '%'", f"{n['qty_hi']} || '%'"),
        (n["qty"], n["qty_hi"]),
        (f"{n['n_lines']} || ' & more'", f"'<' || {n['n_lines']}"),
        ("'---'", f"{n['qty_hi']} || '%'"),
        (n["qty_hi"], n["n_lines"]),
        ("'0'", n["qty_lo"]),
        (f"{n['n_lines']} || ':' || {n['qty_lo']}", "'--'"),
    ]


def match_pages(t: Tables):
    """One result page per match: a winner, NC, a draw, no status, or no table at all."""
    escape = "replace(replace(({}), '&', '&amp;'), '<', '&lt;')"
    both = [("fighter_a", "fighter_b"), *_cell_values(sql=False)]
    tds = []
    for i, pair in enumerate(both):
        texts = [escape.format(v) for v in pair]
        if i == 0:
            texts = [f"'<a href=\"#\">' || {v} || '</a>'" for v in texts]
        tds.append("'<td><p>\n ' || " + " || '</p><p> ' || ".join(texts) + " || ' </p></td>'")
    table = "'<table><tr><th>x</th></tr><tr>' || " + " || ".join(tds) + " || '</tr></table>'"
    person = (
        "'<div class=\"b-fight-details__person\"><i class=\"b-fight-details__person-status {0}\"> ' || {1} || "
        "' </i><div><h3><a href=\"/f\">' || {2} || '</a></h3></div></div>'"
    )
    won, lost = "b-fight-details__person-status_style_green", "b-fight-details__person-status_style_gray"
    a_won = person.format(won, "'W'", "fighter_a") + " || " + person.format(lost, "'L'", "fighter_b")
    b_won = person.format(lost, "'L'", "fighter_a") + " || " + person.format(won, "'W'", "fighter_b")
    same = " || ".join(person.format(lost, "{}", f) for f in ("fighter_a", "fighter_b"))
    head = f"""CASE WHEN match_id % 7 = 0 THEN {same.format("'NC'", "'NC'")}
        WHEN match_id % 7 = 1 THEN {same.format("'D'", "'D'")}
        WHEN match_id % 7 = 2 THEN '<div class="b-fight-details__person"><h3><a>' || fighter_a || '</a></h3></div>'
        WHEN match_id % 7 IN (3, 4) THEN {a_won} ELSE {b_won} END"""
    body = f"CASE WHEN match_id % 11 = 0 THEN '<p>no table</p>' ELSE {table} END"
    page = f"'<html><script>\"<tr></tr><tr>\"</script>' || {head} || {body} || '</html>'"
    return matches(t).select(F.col("match_id").alias("page_id"), F.expr(page).alias("html"))


WINNER_SQL = (
    "CASE match_id % 7 WHEN 0 THEN 'NC' WHEN 1 THEN 'D' WHEN 2 THEN 'Unknown' "
    "WHEN 3 THEN fighter_a WHEN 4 THEN fighter_a ELSE fighter_b END"
)


def _record_sql() -> str:
    spec = rec.RecordSpec()
    values = [v for pair in [("fighter_a", "fighter_b"), *_cell_values(sql=True)] for v in pair]
    shown = [f"CASE WHEN match_id % 11 <> 0 THEN {v} END AS {n}" for n, v in zip(spec.fields(), values)]
    return with_views("v_matches") + f"SELECT match_id AS page_id, {', '.join(shown)} FROM v_matches"


@query("html_record_extract", _record_sql())
def html_record_extract(t: Tables):
    return rec.extract_records(match_pages(t)).drop("winner")


@query(
    "html_winner_extract",
    with_views("v_matches") + f"SELECT match_id AS page_id, {WINNER_SQL} AS winner FROM v_matches",
)
def html_winner_extract(t: Tables):
    return rec.extract_records(match_pages(t)).select("page_id", "winner")


@query(
    "case_label",
    with_views("v_matches") + """SELECT match_id, winner, CASE
        WHEN lower(trim(winner)) = 'nc' THEN 'nc' WHEN lower(trim(winner)) IN ('d', 'draw') THEN 'd'
        WHEN lower(trim(winner)) = lower(trim(fighter_a)) THEN 'red'
        WHEN lower(trim(winner)) = lower(trim(fighter_b)) THEN 'blue' ELSE 'unknown' END AS winner_color
      FROM v_matches""",
)
def case_label(t: Tables):
    return rec.winner_label(matches(t)).select("match_id", "winner", "winner_color")


# -------------------------------------------------------------- sentiment

LEXICON_SQL = "lex(term, valence) AS (VALUES {})".format(
    ", ".join(f"('{w}', {v})" for w, v in sm.VALENCE.items())
)
LOWER_SQL = f"low AS (SELECT doc_id, lang, unnest({TOKENS_SQL.replace('(text,', '(lower(text),')}) AS term FROM documents)"


@query(
    "join_lexicon",
    f"WITH {LEXICON_SQL}, {LOWER_SQL} SELECT doc_id, term, valence, count(*) AS tf FROM low JOIN lex USING (term) "
    "GROUP BY ALL",
)
def join_lexicon(t: Tables):
    return sm.join_lexicon(t("documents"), sm.lexicon(t.spark), ["doc_id"])


@query(
    "afinn_score_doc",
    f"WITH {LEXICON_SQL}, {LOWER_SQL} SELECT d.doc_id, CAST(coalesce(sum(valence), 0) AS BIGINT) AS sentiment "
    "FROM documents d LEFT JOIN low ON d.doc_id = low.doc_id LEFT JOIN lex USING (term) GROUP BY d.doc_id",
)
def afinn_score_doc(t: Tables):
    return sm.sentiment(t("documents"), sm.lexicon(t.spark), ["doc_id"])


@query(
    "sentiment_by_cluster",
    f"WITH {LEXICON_SQL}, {LOWER_SQL} SELECT lang AS cluster, CAST(coalesce(sum(valence), 0) AS BIGINT) AS sentiment "
    "FROM low LEFT JOIN lex USING (term) GROUP BY lang",
)
def sentiment_by_cluster(t: Tables):
    docs = t("documents").withColumnRenamed("lang", "cluster")
    return sm.sentiment(docs, sm.lexicon(t.spark), ["cluster"])


PAGE_TOKENS_SQL = keep_punct_sql("lower(text)")


@query(
    "sentiment_pages",
    f"WITH {LEXICON_SQL}, x AS ({page_texts_sql()}), low AS (SELECT page_id, unnest({PAGE_TOKENS_SQL}) AS term FROM x) "
    "SELECT x.page_id, CAST(coalesce(sum(valence), 0) AS BIGINT) AS sentiment FROM x LEFT JOIN low USING (page_id) "
    "LEFT JOIN lex USING (term) GROUP BY x.page_id",
)
def sentiment_pages(t: Tables):
    return sm.sentiment(pc.page_texts(t("pages")), sm.lexicon(t.spark), ["page_id"], mode="keep_punct")


# --------------------------------------------------------------- clusters


@query(
    "cluster_members",
    "SELECT label AS cluster, vec_id // 100 AS block, string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY vec_id) "
    "AS members, count(*) AS n FROM embeddings GROUP BY ALL",
)
def cluster_members(t: Tables):
    rows = t("embeddings").withColumnRenamed("label", "cluster")
    return tab.collect_blocks(rows, ["cluster"], "vec_id", 100).withColumn("members", F.array_join("members", ","))


@query(
    "page_term_vectors",
    f"WITH x AS ({page_texts_sql()}), w AS (SELECT page_id, list_sort(list_distinct({keep_punct_sql('text')})) AS w FROM x) "
    "SELECT page_id, array_to_string(w, ' ') AS terms, CAST(len(w) AS INTEGER) AS n_terms, true AS fits FROM w",
)
def page_term_vectors(t: Tables):
    """The terms behind each vector; ``fits`` if it has a one in a place of its own for each of them."""
    vectors = pc.page_term_vectors(pc.page_texts(t("pages")))
    held = F.unwrap_udt("features")
    n, n_terms = F.size(F.array_distinct(held["indices"])), F.size("words")
    fits = (n == n_terms) & F.forall(held["values"], lambda x: x == 1)
    terms = F.array_join(F.array_sort("words"), " ")
    return vectors.select("page_id", terms.alias("terms"), n_terms.alias("n_terms"), fits.alias("fits"))


K_SQL = "(VALUES (3), (6)) AS ks(k)"


@query(
    "kmeans_pages",
    f"SELECT k, count(*) AS n_pages, count(DISTINCT page_id) AS n_ids, true AS in_range FROM pages, {K_SQL} GROUP BY k",
)
def kmeans_pages(t: Tables):
    """Both cluster counts over the same vectors: each page is in one of the k clusters."""
    vectors = materialize(pc.page_term_vectors(pc.page_texts(t("pages"))), "vectors")
    runs = [pc.kmeans_pages(vectors, k).select("page_id", F.lit(k).alias("k"), "cluster") for k in (3, 6)]
    found = runs[0].unionByName(runs[1])
    return found.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.countDistinct("page_id").alias("n_ids"),
        F.bool_and((F.col("cluster") >= 0) & (F.col("cluster") < F.col("k"))).alias("in_range"),
    )


@query(
    "cluster_report",
    f"""WITH {LEXICON_SQL}, x AS ({page_texts_sql()}), low AS (SELECT unnest({PAGE_TOKENS_SQL}) AS term FROM x),
      total AS (SELECT CAST(coalesce(sum(valence), 0) AS BIGINT) AS sentiment FROM low JOIN lex USING (term))
      SELECT k, (SELECT count(*) FROM pages) AS n_pages, sentiment, true AS complete FROM total, {K_SQL}""",
)
def cluster_report(t: Tables):
    """The reports for 3 and 6 clusters, added up: pages, sentiment, and whether all clusters have terms."""
    report = pc.cluster_report(t("pages"), (3, 6), sm.lexicon(t.spark))
    whole = (F.count(F.lit(1)) <= F.max("k")) & F.bool_and(F.size("terms").between(1, 20))
    return report.groupBy("k").agg(
        F.sum("n_pages").alias("n_pages"), F.sum("sentiment").alias("sentiment"), whole.alias("complete")
    )
