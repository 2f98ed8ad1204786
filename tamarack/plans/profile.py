"""Descriptive profile, facet and key-cluster queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarack.operators import keycluster, ordering
from tamarack.operators import profile as pf
from tamarack.operators import tabular as tab
from tamarack.plans.registry import Tables, query
from tamarack.plans.tabular import CHAR_KEY_SQL, FINGERPRINT_CHAR_SQL, bigrams_sql
from tamarack.plans.views import labelled, messy, tips, with_views
from tamarack.session import materialize

TIPS = with_views("v_tips")
MESSY = with_views("v_messy")
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("mode_smallest", "SELECT p_size AS mode FROM part GROUP BY p_size ORDER BY count(*) DESC, p_size LIMIT 1")
def mode_smallest(t: Tables):
    return pf.mode_smallest(ordering.value_counts(t("part"), "p_size"), "p_size")


def _price_quantiles(t: Tables, **wanted):
    prices = materialize(tips(t).select("price"), "prices")
    return ordering.quantiles(prices, "price", wanted, weight=None)


@query("median_exact", TIPS + "SELECT round(quantile_cont(price, 0.5), 6) AS median FROM v_tips")
def median_exact(t: Tables):
    return _price_quantiles(t, median=0.5).select(F.round("median", 6).alias("median"))


@query(
    "iqr",
    TIPS + "SELECT round(quantile_cont(price, 0.75) - quantile_cont(price, 0.25), 6) AS iqr FROM v_tips",
)
def iqr(t: Tables):
    return _price_quantiles(t, q1=0.25, q3=0.75).select(F.round(F.col("q3") - F.col("q1"), 6).alias("iqr"))


@query(
    "stddev_sample",
    "SELECT l_returnflag, round(stddev_samp(l_extendedprice), 4) AS std FROM lineitem GROUP BY l_returnflag",
)
def stddev_sample(t: Tables):
    std = F.round(F.stddev_samp("l_extendedprice"), 4).alias("std")
    return t("lineitem").groupBy("l_returnflag").agg(std)


@query(
    "range_minmax",
    TIPS + "SELECT flag, min(price) AS lo, max(price) AS hi, round(max(price) - min(price), 6) AS range "
    "FROM v_tips GROUP BY flag",
)
def range_minmax(t: Tables):
    lo, hi = F.min("price"), F.max("price")
    return tips(t).groupBy("flag").agg(lo.alias("lo"), hi.alias("hi"), F.round(hi - lo, 6).alias("range"))


@query("mean_numeric", TIPS + "SELECT round(avg(price), 4) AS price, round(avg(neg_qty), 4) AS neg_qty FROM v_tips")
def mean_numeric(t: Tables):
    return tips(t).agg(*[F.round(F.avg(c), 4).alias(c) for c in ("price", "neg_qty")])


# Two features on purpose: `lang` over an odd and `prio` over an even row count.
LANGS = ["en", "de", "fr", "es"]


def _ordinal(t: Tables, **lists: list[str]):
    rows = [(f, v, i + 1) for f, values in lists.items() for i, v in enumerate(values)]
    return t.spark.createDataFrame(rows, "feature string, value string, rank int")


def _ordinal_sql(what: str) -> str:
    return f"""WITH d AS (
        SELECT 'lang' AS feature, d.lang AS value, list_position({LANGS}, d.lang) AS rank
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id
        UNION ALL SELECT 'prio', o_orderpriority, list_position({PRIORITIES}, o_orderpriority) FROM orders),
      r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY rank) AS pos,
                   count(*) OVER (PARTITION BY feature) AS n FROM d)
      SELECT feature, {what} FROM r GROUP BY feature"""


def _ordinal_stats(t: Tables):
    langs = labelled(t).select(F.lit("lang").alias("feature"), F.col("lang").alias("value"))
    prios = t("orders").select(F.lit("prio").alias("feature"), F.col("o_orderpriority").alias("value"))
    counts = langs.unionByName(prios).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return pf.ordinal_stats(counts, _ordinal(t, lang=LANGS, prio=PRIORITIES))


@query(
    "ordinal_median",
    _ordinal_sql("max(CASE WHEN n % 2 = 1 AND pos = (n + 1) // 2 THEN value END) AS median_entry"),
)
def ordinal_median(t: Tables):
    return _ordinal_stats(t).select("feature", "median_entry")


@query("ordinal_range", _ordinal_sql("CAST(max(rank) - min(rank) AS DOUBLE) AS rank_range"))
def ordinal_range(t: Tables):
    return _ordinal_stats(t).select("feature", "rank_range")


@query("text_facet", "SELECT p_name, count(*) AS n FROM part GROUP BY p_name")
def text_facet(t: Tables):
    return pf.text_facet(t("part"), "p_name")


NUMERIC_SQL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def histogram_sql(source: str, col: str, bins: int = 10) -> str:
    """Equal-width histogram of one column, in the check's SQL."""
    return f"""e AS (SELECT CASE WHEN min({col}) = max({col}) THEN min({col}) - 0.5 ELSE min({col}) END AS lo,
                  CASE WHEN min({col}) = max({col}) THEN max({col}) + 0.5 ELSE max({col}) END AS hi FROM {source}),
      b AS (SELECT CAST(least(floor(({col} - lo) / (hi - lo) * {bins}) + 1, {bins}) AS INTEGER) AS bin, count(*) AS n
            FROM {source}, e WHERE {col} IS NOT NULL GROUP BY 1),
      h AS (SELECT CAST(i AS INTEGER) AS bin, round(lo + (i - 1) * ((hi - lo) / {bins}), 6) AS lo,
                   round(lo + i * ((hi - lo) / {bins}), 6) AS hi, coalesce(n, 0) AS n
            FROM e, range(1, {bins + 1}) r(i) LEFT JOIN b ON bin = i)"""


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query(
    "numeric_facet",
    MESSY + f""", k AS (SELECT CASE WHEN nullif(trim(num), '') IS NULL THEN 'blank'
          WHEN regexp_matches(num, '{NUMERIC_SQL}') THEN 'numeric' ELSE 'non_numeric' END AS kind, num FROM v_messy),
      v AS (SELECT kind, CASE kind WHEN 'numeric' THEN CAST(num AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS value FROM k),
      {histogram_sql("v", "value")}
      SELECT kind, CAST(NULL AS INTEGER) AS bin, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, count(*) AS n
      FROM v GROUP BY kind
      UNION ALL SELECT 'min_max', NULL, min(value), max(value), count(value) FROM v
      UNION ALL SELECT 'histogram', bin, lo, hi, n FROM h""",
)
def numeric_facet(t: Tables):
    return _rounded(pf.numeric_facet(messy(t), "num"), "lo", "hi")


@query(
    "histogram_equal_width",
    TIPS + f", {histogram_sql('v_tips', 'price')} SELECT bin, lo, hi, n FROM h",
)
def histogram_equal_width(t: Tables):
    return _rounded(pf.histogram(tips(t), "price"), "lo", "hi")


@query(
    "pivot_mean",
    TIPS + "SELECT prio, "
    + ", ".join(f"coalesce(round(avg(CASE WHEN flag = '{f}' THEN price END), 4), 0) AS {f}" for f in "ANR")
    + " FROM v_tips GROUP BY prio",
)
def pivot_mean(t: Tables):
    table = tab.pivot_mean_smaller(tips(t), "prio", "flag", "price")
    return table.select("prio", *[F.round(c, 4).alias(c) for c in table.columns if c != "prio"])


PARTS = "v_tips JOIN orders ON orderkey = o_orderkey"
CELLS = f"SELECT prio, o_custkey, round(avg(price), 8) AS price FROM {PARTS} WHERE price IS NOT NULL GROUP BY prio, o_custkey"


def _by_customer(t: Tables):
    """Prices by priority and customer: far more customers than a table could have columns."""
    orders = t("orders").select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    return tips(t).join(orders, "orderkey")


@query("pivot_cells", TIPS + CELLS)
def pivot_cells(t: Tables):
    return tab.pivot_cells(_by_customer(t), "prio", "o_custkey", "price").withColumn("price", F.round("price", 8))


@query(
    "pivot_sparse",
    TIPS + "SELECT prio, count(*) AS n_cells, string_agg(o_custkey || ':' || CAST(price AS DECIMAL(24, 8)), ',' ORDER BY o_custkey) AS cells "
    f"FROM ({CELLS}) GROUP BY prio",
)
def pivot_sparse(t: Tables):
    """A row per priority: one map from customer to mean price, here as text."""
    wide = tab.pivot_sparse(_by_customer(t), "prio", "o_custkey", "price")
    mean = lambda e: F.round(e["value"], 8).cast("decimal(24,8)").cast("string")
    shown = F.transform(F.map_entries("cells"), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), mean(e)))
    return wide.select("prio", F.size("cells").cast("bigint").alias("n_cells"), F.array_join(shown, ",").alias("cells"))


@query(
    "box_summary",
    TIPS + """, q AS (SELECT prio, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
        quantile_cont(price, 0.75) AS q3 FROM v_tips GROUP BY prio),
      x AS (SELECT t.prio, price, q1, median, q3,
                   price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
            FROM v_tips t JOIN q ON t.prio = q.prio WHERE price IS NOT NULL)
      SELECT prio, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, count(*) AS n,
             min(CASE WHEN inside THEN price END) AS whisker_lo, max(CASE WHEN inside THEN price END) AS whisker_hi,
             count(CASE WHEN NOT inside THEN 1 END) AS n_outliers FROM x GROUP BY prio, q1, median, q3""",
)
def box_summary(t: Tables):
    return _rounded(pf.box_summary(tips(t), "prio", "price"), "q1", "median", "q3")


@query("bar_counts", TIPS + "SELECT prio, count(*) AS n FROM v_tips GROUP BY prio")
def bar_counts(t: Tables):
    return tab.group_count(tips(t), "prio")


@query(
    "scatter_pairs",
    TIPS + """, p AS (SELECT price AS x, neg_qty AS y FROM v_tips WHERE price IS NOT NULL),
      e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p)
      SELECT CAST(least(floor((x - x0) / (x1 - x0) * 10) + 1, 10) AS INTEGER) AS x_bin,
             CAST(least(floor((y - y0) / (y1 - y0) * 10) + 1, 10) AS INTEGER) AS y_bin, count(*) AS n
      FROM p, e GROUP BY ALL""",
)
def scatter_pairs(t: Tables):
    return pf.scatter_density(tips(t), "price", "neg_qty")


LEVELS = {"flag": "nominal", "ord_size": "ordinal", "prio": "ordinal", "price": "ratio", "neg_qty": "interval"}
SIZES = [str(i) for i in range(1, 51)]


def _profile_sql(feature: str, level: str) -> str:
    none = "CAST(NULL AS DOUBLE)"
    number = level in ("interval", "ratio")
    best = f"SELECT {{}} FROM v_tips WHERE {feature} IS NOT NULL GROUP BY {feature} ORDER BY count(*) DESC, 1 LIMIT 1"
    text = f"CAST({feature} AS VARCHAR)"
    order = SIZES if feature == "ord_size" else PRIORITIES
    rank = f"list_position({order}, {text})"
    middle = (
        f"CASE WHEN count(*) % 2 = 1 THEN (SELECT {text} FROM v_tips ORDER BY {rank} "
        f"LIMIT 1 OFFSET (SELECT count(*) // 2 FROM v_tips)) END"
    )
    return f"""SELECT '{feature}' AS feature, '{level}' AS level, count(*) AS n, count({feature}) AS n_entries,
        count(DISTINCT {feature}) AS n_unique, count(*) - count({feature}) AS n_missing,
        {"CAST(NULL AS VARCHAR)" if number else "(" + best.format(text) + ")"} AS mode,
        {"(" + best.format(feature) + ")" if number else none} AS mode_number,
        {middle if level == "ordinal" else "CAST(NULL AS VARCHAR)"} AS median_entry,
        {f"round(quantile_cont({feature}, 0.5), 4)" if number else none} AS median,
        {f"round(avg({feature}), 4)" if number else none} AS mean,
        {f"round(max({feature}) - min({feature}), 4)" if number
         else f"CAST(max({rank}) - min({rank}) AS DOUBLE)" if level == "ordinal" else none} AS range,
        {f"round(quantile_cont({feature}, 0.75) - quantile_cont({feature}, 0.25), 4)" if number else none} AS iqr,
        {f"round(stddev_samp({feature}), 4)" if number else none} AS std
      FROM v_tips"""


@query("profile_table", TIPS + " UNION ALL ".join(_profile_sql(f, level) for f, level in LEVELS.items()))
def profile_table(t: Tables):
    ordinal = _ordinal(t, ord_size=SIZES, prio=PRIORITIES)
    table = pf.profile_table(tips(t), LEVELS, ordinal)
    return table.withColumns({c: F.round(c, 4) for c in ("median", "mean", "range", "iqr", "std")})


def _clusters_sql(key: str) -> str:
    return f""", v AS (SELECT {key} AS key, text AS variant, count(*) AS n FROM {{}} GROUP BY ALL),
      m AS (SELECT key, CAST(sum(n) AS BIGINT) AS key_rows, first(variant ORDER BY n DESC, variant) AS merged
            FROM v GROUP BY key)
      SELECT v.key, variant, n, key_rows, merged FROM v JOIN m ON v.key = m.key"""


@query(
    "cluster_keys",
    MESSY + _clusters_sql(f"array_to_string(list_sort(list_distinct({bigrams_sql('text')})), '')").format("v_messy"),
)
def cluster_keys(t: Tables):
    return keycluster.cluster_keys(messy(t), "text", "word")


@query(
    "cluster_keys_char",
    MESSY
    + f", s AS (SELECT text, {CHAR_KEY_SQL} AS s FROM v_messy)"
    + _clusters_sql(FINGERPRINT_CHAR_SQL).format("s"),
)
def cluster_keys_char(t: Tables):
    return keycluster.cluster_keys(messy(t), "text", "char")


@query(
    "merge_spellings",
    MESSY
    + _clusters_sql(f"array_to_string(list_sort(list_distinct({bigrams_sql('text')})), '')")
    .format("v_messy")
    .replace("SELECT v.key, variant, n, key_rows, merged FROM v JOIN m ON v.key = m.key", "")
    + """ SELECT p_partkey, merged AS text, num FROM v_messy x JOIN v ON v.variant = x.text JOIN m ON m.key = v.key""",
)
def merge_spellings(t: Tables):
    """The rows again, each name in the spelling that its cluster is merged into."""
    rows = messy(t)
    return keycluster.merge_spellings(rows, "text", keycluster.cluster_keys(rows, "text", "word"))
