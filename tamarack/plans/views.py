"""Input views derived from the driver tables, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.plans.registry import Tables


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named views for a check query."""
    return "WITH " + ", ".join(f"{n} AS ({VIEW_SQL[n]})" for n in names) + " "


VIEW_SQL = {
    "v_trees": """
        SELECT CASE WHEN p_size % 3 <> 0 THEN p_brand || ' ' || p_name END AS loc,
               strftime(l_shipdate, '%Y-%m') AS month
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_ratings": """
        SELECT o_custkey AS "user", l_partkey AS item, avg(l_quantity) / 10 AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey""",
    "v_taste": """
        SELECT "user", item, rating + ("user" % 7) * 0.4 + (item % 5) * 0.3
               + CASE WHEN "user" % 3 = item % 3 THEN 1 ELSE 0 END AS rating
        FROM (SELECT 5000000000 + o_custkey AS "user", l_partkey AS item, avg(l_quantity) / 100 AS rating
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)""",
    "v_tips": """
        SELECT l_orderkey AS orderkey, l_returnflag AS flag, p_size AS ord_size,
               CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_extendedprice END AS price,
               -l_quantity AS neg_qty, o_orderpriority AS prio
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "v_messy": """
        SELECT p_partkey,
               CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name)
                    WHEN 2 THEN '  ' || replace(p_name, ' ', '   ') WHEN 3 THEN p_name || '.'
                    ELSE replace(p_name, ' ', ', ') END AS text,
               CASE p_size WHEN 9 THEN 'hey' WHEN 10 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS num
        FROM part""",
    "v_matches": """
        SELECT l_orderkey AS match_id,
               'Supplier ' || CAST(min(l_suppkey) AS VARCHAR) AS fighter_a,
               'Supplier ' || CAST(max(l_suppkey) AS VARCHAR) AS fighter_b,
               CASE WHEN count(*) >= 6 THEN 'NC' WHEN max(l_quantity) - min(l_quantity) < 15 THEN ' draw '
                    WHEN l_orderkey % 50 = 2 THEN 'someone'
                    WHEN min(l_quantity) > 6 THEN 'Supplier ' || CAST(max(l_suppkey) AS VARCHAR)
                    WHEN l_orderkey % 2 = 0 THEN upper('Supplier ' || CAST(min(l_suppkey) AS VARCHAR))
                    ELSE 'Supplier ' || CAST(min(l_suppkey) AS VARCHAR) END AS winner,
               count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS qty,
               CAST(min(l_quantity) AS BIGINT) AS qty_lo, CAST(max(l_quantity) AS BIGINT) AS qty_hi
        FROM lineitem GROUP BY l_orderkey HAVING min(l_suppkey) <> max(l_suppkey)""",
    "v_labels": """
        SELECT l.doc_id, l.quality AS actual, 1 - l.toxic AS predicted, d.n_chars, d.lang
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "v_players": """
        SELECT user_id, count(*) AS n_events,
               avg(CASE WHEN event_type = 'purchase' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)
                   AS purchase_rate,
               avg(value) AS avg_value,
               (epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(max(ts))) / 3600 AS hours_away,
               CASE WHEN (max(ts) < TIMESTAMP '2024-01-30 14:00:00') <> (user_id % 17 = 3) THEN 1 ELSE 0 END AS churn
        FROM events GROUP BY user_id""",
}


def trees(t: Tables) -> DataFrame:
    """Items with an optional place and a month."""
    place = F.when(F.col("p_size") % 3 != 0, F.concat_ws(" ", "p_brand", "p_name"))
    return (
        t("lineitem")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(place.alias("loc"), F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    )


def ratings(t: Tables) -> DataFrame:
    """One rating per (user, item)."""
    return (
        t("lineitem")
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        .agg((F.avg("l_quantity") / 10).alias("rating"))
    )


def taste(t: Tables) -> DataFrame:
    """A rating for each customer and part, with effects of both and of the pair; user ids beyond 32 bits."""
    user, item = F.lit(5_000_000_000) + F.col("o_custkey"), F.col("l_partkey")
    both = F.when(F.col("user") % 3 == F.col("item") % 3, 1).otherwise(0)
    means = (
        t("lineitem")
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(user.alias("user"), item.alias("item"))
        .agg((F.avg("l_quantity") / 100).alias("rating"))
    )
    return means.withColumn("rating", F.col("rating") + (F.col("user") % 7) * 0.4 + (F.col("item") % 5) * 0.3 + both)


def tips(t: Tables) -> DataFrame:
    """A table with nominal, ordinal, interval and ratio columns, one with gaps."""
    return (
        t("lineitem")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").alias("orderkey"),
            F.col("l_returnflag").alias("flag"),
            F.col("p_size").alias("ord_size"),
            F.when(F.col("l_orderkey") % 50 != 0, F.col("l_extendedprice")).alias("price"),
            (-F.col("l_quantity")).alias("neg_qty"),
            F.col("o_orderpriority").alias("prio"),
        )
    )


def messy(t: Tables) -> DataFrame:
    """Names in five spellings and a mostly numeric text column."""
    name, kind = F.col("p_name"), F.col("p_partkey") % 5
    text = (
        F.when(kind == 0, name)
        .when(kind == 1, F.upper(name))
        .when(kind == 2, F.concat(F.lit("  "), F.regexp_replace(name, " ", "   ")))
        .when(kind == 3, F.concat(name, F.lit(".")))
        .otherwise(F.regexp_replace(name, " ", ", "))
    )
    size = F.col("p_size")
    num = F.when(size == 9, F.lit("hey")).when(size != 10, size.cast("string"))
    return t("part").select("p_partkey", text.alias("text"), num.alias("num"))


def matches(t: Tables) -> DataFrame:
    """Two sides, a winner text and some counts per order with several suppliers."""
    a = F.concat(F.lit("Supplier "), F.col("lo").cast("string"))
    b = F.concat(F.lit("Supplier "), F.col("hi").cast("string"))
    winner = (
        F.when(F.col("n_lines") >= 6, F.lit("NC"))
        .when(F.col("qty_hi") - F.col("qty_lo") < 15, F.lit(" draw "))
        .when(F.col("l_orderkey") % 50 == 2, F.lit("someone"))
        .when(F.col("qty_lo") > 6, b)
        .when(F.col("l_orderkey") % 2 == 0, F.upper(a))
        .otherwise(a)
    )
    return (
        t("lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.min("l_suppkey").alias("lo"),
            F.max("l_suppkey").alias("hi"),
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").cast("bigint").alias("qty"),
            F.min("l_quantity").cast("bigint").alias("qty_lo"),
            F.max("l_quantity").cast("bigint").alias("qty_hi"),
        )
        .filter("lo <> hi")
        .select(
            F.col("l_orderkey").alias("match_id"),
            a.alias("fighter_a"),
            b.alias("fighter_b"),
            winner.alias("winner"),
            "n_lines",
            "qty",
            "qty_lo",
            "qty_hi",
        )
    )


def labelled(t: Tables) -> DataFrame:
    """Actual class next to a stand-in prediction."""
    return (
        t("labels")
        .join(t("documents").select("doc_id", "n_chars", "lang"), "doc_id")
        .select(
            "doc_id",
            F.col("quality").alias("actual"),
            (1 - F.col("toxic")).alias("predicted"),
            "n_chars",
            "lang",
        )
    )


def players(t: Tables) -> DataFrame:
    """Activity per user and whether the user stayed away at the end."""
    purchase = F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0)
    left = F.max("ts") < F.lit("2024-01-30 14:00:00").cast("timestamp")
    away = F.unix_micros(F.lit("2024-01-31 00:00:00").cast("timestamp")) - F.unix_micros(F.max("ts").cast("timestamp"))
    odd = F.col("user_id") % 17 == 3
    return (
        t("events")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.avg(purchase).alias("purchase_rate"),
            F.avg("value").alias("avg_value"),
            (away / 3.6e9).alias("hours_away"),
            F.when(left, 1).otherwise(0).alias("left"),
        )
        .withColumn("churn", F.when(odd, 1 - F.col("left")).otherwise(F.col("left")))
        .drop("left")
    )
