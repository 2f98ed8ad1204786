"""Encoding, classification, metric and streaming queries."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import functions as F

from tamarack.operators import boosting as bo
from tamarack.operators import classify as cl
from tamarack.operators import features as ft
from tamarack.operators import metrics as me
from tamarack.operators import records as rec
from tamarack.operators.recommend import split_by_key
from tamarack.plans.registry import Tables, query
from tamarack.plans.tabular import EVENTS, LOG_SQL, NULL_KEY_SQL, events_with_null_key, read_training_log
from tamarack.plans.views import labelled, matches, players, with_views
from tamarack.session import materialize, scratch_path
from tamarack.sources import readers
from tamarack.streaming import incremental as inc

MATCHES = with_views("v_matches")
SIDES = ["fighter_a", "fighter_b"]


@query(
    "onehot_shared_vocab",
    MATCHES + """, v AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS index FROM
        (SELECT fighter_a AS name FROM v_matches UNION SELECT fighter_b FROM v_matches))
      SELECT match_id, a.index AS fighter_a_index, b.index AS fighter_b_index FROM v_matches
      JOIN v a ON fighter_a = a.name JOIN v b ON fighter_b = b.name""",
)
def onehot_shared_vocab(t: Tables):
    sides = matches(t).select("match_id", *SIDES)
    encoded = ft.encode_shared(sides, SIDES, ft.shared_vocabulary(sides, SIDES))
    return encoded.select("match_id", "fighter_a_index", "fighter_b_index")


@query(
    "label_encode",
    MATCHES + "SELECT match_id, winner, dense_rank() OVER (ORDER BY winner) - 1 AS label_index FROM v_matches",
)
def label_encode(t: Tables):
    return ft.label_encode(matches(t).select("match_id", "winner"), "winner")


@query(
    "label_decode",
    MATCHES + "SELECT match_id, dense_rank() OVER (ORDER BY winner) - 1 AS label_index, winner AS decoded FROM v_matches",
)
def label_decode(t: Tables):
    """Class numbers back to names, as for predictions."""
    coded = materialize(ft.label_encode(matches(t).select("match_id", "winner"), "winner"), "coded")
    classes = coded.select(F.col("winner").alias("name"), F.col("label_index").alias("index")).distinct()
    return ft.label_decode(coded.drop("winner"), "label_index", classes, "decoded")


STATS = ["n_lines", "qty", "qty_lo", "qty_hi"]
COLOR_SQL = """CASE WHEN lower(trim(winner)) = 'nc' THEN 'nc' WHEN lower(trim(winner)) IN ('d', 'draw') THEN 'd'
    WHEN lower(trim(winner)) = lower(trim(fighter_a)) THEN 'red'
    WHEN lower(trim(winner)) = lower(trim(fighter_b)) THEN 'blue' ELSE 'unknown' END"""


def _features(t: Tables):
    """Match statistics, both sides one-hot, and the numbered winner class."""
    rows = materialize(rec.winner_label(matches(t)), "matches")
    vocabulary = ft.shared_vocabulary(rows, SIDES)
    coded = ft.onehot_shared(ft.label_encode(rows, "winner_color"), SIDES, vocabulary)
    return ft.assemble(coded, [*STATS, "fighter_a_vec", "fighter_b_vec"])


@query(
    "assemble_features",
    MATCHES + f""", v AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS i, count(*) OVER () AS n FROM
        (SELECT fighter_a AS name FROM v_matches UNION SELECT fighter_b FROM v_matches))
      SELECT match_id, dense_rank() OVER (ORDER BY {COLOR_SQL}) - 1 AS label_index,
        '0:' || n_lines || ' 1:' || qty || ' 2:' || qty_lo || ' 3:' || qty_hi || ' ' || (4 + a.i) || ':1 '
          || (4 + a.n + b.i) || ':1' AS entries
      FROM v_matches JOIN v a ON fighter_a = a.name JOIN v b ON fighter_b = b.name""",
)
def assemble_features(t: Tables):
    """Each vector as text: the places that are not zero, and their values."""
    parts = _features(t).select("match_id", "label_index", F.unwrap_udt("features").alias("f"))
    places = F.when(F.col("f.type") == 0, F.col("f.indices")).otherwise(
        F.transform(F.col("f.values"), lambda _, i: i)
    )
    pairs = F.filter(F.arrays_zip(places.alias("i"), F.col("f.values").alias("v")), lambda x: x["v"] != 0)
    shown = F.transform(pairs, lambda x: F.concat(x["i"].cast("string"), F.lit(":"), x["v"].cast("bigint").cast("string")))
    return parts.select("match_id", "label_index", F.array_join(shown, " ").alias("entries"))


TEST_SQL = "CAST('0x' || substr(md5('0|' || match_id), 1, 7) AS BIGINT) < 53687091"


@query(
    "drop_unseen_labels",
    MATCHES + f"SELECT match_id, winner FROM v_matches WHERE {TEST_SQL} AND winner IN "
    f"(SELECT winner FROM v_matches WHERE NOT {TEST_SQL})",
)
def drop_unseen_labels(t: Tables):
    train, test = split_by_key(matches(t).select("match_id", "winner"), ["match_id"])
    return ft.drop_unseen_labels(train, test, "winner")


@query(
    "unseen_label_count",
    MATCHES + f"SELECT count(*) AS n_removed FROM v_matches WHERE {TEST_SQL} AND winner NOT IN "
    f"(SELECT winner FROM v_matches WHERE NOT {TEST_SQL})",
)
def unseen_label_count(t: Tables):
    train, test = split_by_key(matches(t).select("match_id", "winner"), ["match_id"])
    left = test.join(train.select("winner").distinct(), "winner", "left_anti")
    return left.agg(F.count(F.lit(1)).alias("n_removed"))


MARGIN = 0.1  # by which a fitted model has to beat always naming the most frequent class
PLAYER_FEATURES = ["n_events", "purchase_rate", "avg_value", "hours_away"]


def _verdict(scored, label: str):
    """One row: rows scored, share of the most frequent class, and whether the model beats it clearly."""
    counts = scored.groupBy(F.col(label).alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col(label)).alias("hit")
    )
    majority = F.max("n") / F.sum("n")
    return counts.agg(
        F.sum("n").alias("n_scored"),
        F.round(majority, 6).alias("majority"),
        (F.sum("hit") / F.sum("n") > majority + MARGIN).alias("better"),
    )


def _verdict_sql(rows: str, label: str) -> str:
    return (
        "SELECT CAST(sum(n) AS BIGINT) AS n_scored, round(max(n) / CAST(sum(n) AS DOUBLE), 6) AS majority, "
        f"true AS better FROM (SELECT {label}, count(*) AS n FROM {rows} GROUP BY {label})"
    )


CHURN_SQL = with_views("v_players") + _verdict_sql("v_players", "churn")
WINNER_SQL = (
    MATCHES + f", w AS (SELECT match_id, {COLOR_SQL} AS color FROM v_matches), test AS (SELECT color FROM w WHERE {TEST_SQL} "
    f"AND color IN (SELECT color FROM w WHERE NOT {TEST_SQL})) " + _verdict_sql("test", "color")
)


def _players(t: Tables):
    return materialize(ft.assemble(players(t), PLAYER_FEATURES), "players")


@query("decision_tree_churn", CHURN_SQL)
def decision_tree_churn(t: Tables):
    """Every user is scored by a tree fitted on four fifths of the others."""
    scored = cl.score_held_out(_players(t), lambda rows: cl.fit_decision_tree(rows, "churn"), ["user_id"])
    return _verdict(scored, "churn")


@query("random_forest", CHURN_SQL)
def random_forest(t: Tables):
    """Every user is scored by a forest fitted on two thirds of the others."""
    scored = cl.score_held_out(_players(t), lambda rows: cl.fit_random_forest(rows, "churn"), ["user_id"], folds=3)
    return _verdict(scored, "churn")


@query("score_batch", CHURN_SQL)
def score_batch(t: Tables):
    """Models are saved, loaded, and score the users that they were not fitted on."""

    def stored(rows):
        path = scratch_path(t.spark, "model")
        cl.fit_decision_tree(rows, "churn").save(path)
        return DecisionTreeClassificationModel.load(path)

    return _verdict(cl.score_held_out(_players(t), stored, ["user_id"], folds=3), "churn")


def _match_split(t: Tables):
    """Features on one scale, which the solver needs a tenth of the steps for."""
    rows = materialize(_features(t).select("match_id", "label_index", *STATS, "fighter_a_vec", "fighter_b_vec"), "columns")
    rows = ft.assemble(ft.scale_columns(rows, STATS), [*STATS, "fighter_a_vec", "fighter_b_vec"])
    rows = materialize(rows.select("match_id", "label_index", "features"), "features")
    train, test = split_by_key(rows, ["match_id"])
    return train, ft.drop_unseen_labels(train, test, "label_index")


@query("logreg_multinomial", WINNER_SQL)
def logreg_multinomial(t: Tables):
    train, test = _match_split(t)
    return _verdict(cl.score(cl.fit_logreg(train, "label_index"), test), "label_index")


def _three_parts(t: Tables):
    """Matches to fit on, to watch the rounds on, and to judge the model on: 3/5, 1/5 and 1/5."""
    rows = materialize(_features(t).select("match_id", "label_index", "features"), "features")
    rest, judged = split_by_key(rows, ["match_id"])
    train, watched = split_by_key(rest, ["match_id"], test_fraction=0.25, seed=1)
    return train, watched, ft.drop_unseen_labels(train, judged, "label_index")


WATCHED_SQL = "CAST('0x' || substr(md5('1|' || match_id), 1, 7) AS BIGINT) < 67108864"
ROUNDS = 500
BOOSTED_SQL = (
    MATCHES + f", w AS (SELECT match_id, {COLOR_SQL} AS color FROM v_matches), test AS (SELECT color FROM w WHERE {TEST_SQL} "
    f"AND color IN (SELECT color FROM w WHERE NOT {TEST_SQL} AND NOT {WATCHED_SQL})) "
    f"SELECT *, {ROUNDS} AS n_rounds, true AS best_kept FROM (" + _verdict_sql("test", "color") + ")"
)


@query("boosted_trees", BOOSTED_SQL)
def boosted_trees(t: Tables):
    """500 rounds of depth 8, all run; the round that does best on the watched part scores the judged part."""
    train, watched, judged = _three_parts(t)
    model = bo.fit_boosted(train, watched, "label_index", rounds=ROUNDS)
    verdict = _verdict(bo.score_boosted(model, judged), "label_index")
    log = model.log
    kept = log.filter(F.col("iter") == model.best).agg(F.first("test_accuracy")).scalar()
    return verdict.withColumns(
        {
            "n_rounds": log.agg(F.count(F.lit(1)).cast("int")).scalar(),
            "best_kept": kept == log.agg(F.max("test_accuracy")).scalar(),
        }
    )


@query("boosting_curve")
def boosting_curve(t: Tables):
    """The log of that fit, stored and read as training logs are, with its best round marked."""
    train, watched, _ = _three_parts(t)
    model = bo.fit_boosted(train, watched, "label_index", rounds=ROUNDS)
    logs = []
    for log in bo.read_logs(model):
        path = scratch_path(t.spark, "log")
        log.write.option("header", True).option("sep", "\t").csv(path)
        logs.append(readers.read_tsv_log(t.spark, path))
    return me.training_curve(*logs)


# ---------------------------------------------------------------- metrics

LABELS = with_views("v_labels")


@query(
    "confusion_matrix",
    LABELS + """, k(x) AS (SELECT actual FROM v_labels UNION SELECT predicted FROM v_labels)
      SELECT a.x AS actual, p.x AS predicted, count(l.doc_id) AS n FROM k a CROSS JOIN k p
      LEFT JOIN v_labels l ON l.actual = a.x AND l.predicted = p.x GROUP BY a.x, p.x""",
)
def confusion_matrix(t: Tables):
    return me.confusion_matrix(labelled(t), "actual", "predicted")


@query(
    "accuracy",
    LABELS + "SELECT round(avg(CAST(actual = predicted AS INTEGER)), 6) AS accuracy FROM v_labels",
)
def accuracy(t: Tables):
    return me.accuracy(labelled(t), "actual", "predicted").withColumn("accuracy", F.round("accuracy", 6))


@query(
    "classification_report",
    LABELS + """, k(x) AS (SELECT actual FROM v_labels UNION SELECT predicted FROM v_labels),
      c AS (SELECT x, CAST(count(*) FILTER (actual = x AND predicted = x) AS DOUBLE) AS tp,
                   count(*) FILTER (predicted = x) AS said, count(*) FILTER (actual = x) AS support
            FROM k, v_labels GROUP BY x),
      r AS (SELECT *, CASE WHEN said = 0 THEN 0 ELSE tp / said END AS p,
                   CASE WHEN support = 0 THEN 0 ELSE tp / support END AS r FROM c),
      f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM r),
      o AS (SELECT CAST(x AS VARCHAR) AS label, p AS precision, r AS recall, f AS f1, support FROM f
        UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM f
        UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM f
        UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                         sum(f * support) / sum(support), sum(support) FROM f)
      SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
             CAST(support AS BIGINT) AS support FROM o""",
)
def classification_report(t: Tables):
    report = me.classification_report(labelled(t), "actual", "predicted")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


NAMED_SQL = "SELECT lang AS actual, CASE WHEN n_chars % 5 = 0 THEN 'en' ELSE lang END AS predicted FROM documents"


@query(
    "classification_report_names",
    f"""WITH v AS ({NAMED_SQL}), k(x) AS (SELECT actual FROM v UNION SELECT predicted FROM v),
      c AS (SELECT x, CAST(count(*) FILTER (actual = x AND predicted = x) AS DOUBLE) AS tp,
                   count(*) FILTER (predicted = x) AS said, count(*) FILTER (actual = x) AS support
            FROM k, v GROUP BY x)
      SELECT x AS label, round(tp / said, 6) AS precision, round(tp / support, 6) AS recall,
             CAST(support AS BIGINT) AS support FROM c
      UNION ALL SELECT 'accuracy', NULL, NULL, CAST(sum(support) AS BIGINT) FROM c""",
)
def classification_report_names(t: Tables):
    """Classes numbered, compared as numbers, and shown by their names again."""
    guess = F.when(F.col("n_chars") % 5 == 0, "en").otherwise(F.col("lang"))
    rows = t("documents").select(F.col("lang").alias("actual"), guess.alias("predicted"))
    coded = materialize(ft.label_encode(rows, "actual", "actual_index"), "coded")
    names = materialize(coded.select(F.col("actual_index").alias("label"), F.col("actual").alias("name")).distinct(), "names")
    numbered = names.select(F.col("name").alias("predicted"), F.col("label").alias("predicted_index"))
    both = coded.join(F.broadcast(numbered), "predicted")  # a row per language
    report = me.classification_report(both, "actual_index", "predicted_index", names=names)
    shown = report.filter(~F.col("label").endswith(" avg"))
    return shown.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall")], "support")


@query(
    "best_iteration",
    f"SELECT iter, accuracy FROM ({LOG_SQL.format('F')}) ORDER BY accuracy DESC, iter LIMIT 1",
)
def best_iteration(t: Tables):
    return me.best_iteration(read_training_log(t, "F"))


@query(
    "training_curve",
    f"""WITH o AS ({LOG_SQL.format('O')}), f AS ({LOG_SQL.format('F')}),
      b AS (SELECT iter FROM f ORDER BY accuracy DESC, iter LIMIT 1)
      SELECT o.iter, o.accuracy AS train_accuracy, o.loss AS train_loss, f.accuracy AS test_accuracy,
             f.loss AS test_loss, o.iter = b.iter AS is_best FROM o JOIN f ON o.iter = f.iter, b""",
)
def training_curve(t: Tables):
    return me.training_curve(read_training_log(t, "O"), read_training_log(t, "F"))


# -------------------------------------------------------------- streaming


@query("incremental_append_stream", NULL_KEY_SQL)
def incremental_append_stream(t: Tables):
    """The whole table arrives as a stream, twice, on top of a part already known."""
    events = events_with_null_key(t)
    path, arriving = scratch_path(t.spark, "history"), scratch_path(t.spark, "arriving")
    known = events.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp"))
    inc.start_history(known.select(*EVENTS), path, "event_id", buckets=8)
    events.select(*EVENTS).write.parquet(arriving)
    for _ in range(2):
        stream = t.spark.readStream.schema(events.select(*EVENTS).schema).parquet(arriving)
        run = inc.append_stream(stream, path, "event_id", scratch_path(t.spark, "stream"))
        run.awaitTermination()
    return inc.read_history(t.spark, path)


@query("incremental_append_stateful", NULL_KEY_SQL)
def incremental_append_stateful(t: Tables):
    """The table arrives in two overlapping deliveries on top of nothing; the keys seen are state. Then the parts are made one."""
    events = events_with_null_key(t)
    path, arriving = scratch_path(t.spark, "history"), scratch_path(t.spark, "arriving")
    rows, checkpoint = events.select(*EVENTS), scratch_path(t.spark, "stream")
    inc.start_history(rows.limit(0), path, "event_id", buckets=8)
    deliveries = (("ts", "<", "2024-01-20 00:00:00"), ("ts", ">=", "2024-01-10 00:00:00"))
    for column, side, day in deliveries:
        events.filter(f"{column} {side} TIMESTAMP '{day}'").select(*EVENTS).write.mode("append").parquet(arriving)
        stream = t.spark.readStream.schema(rows.schema).parquet(arriving)
        inc.append_stateful(stream, path, "event_id", checkpoint).awaitTermination()
    inc.compact_history(t.spark, path, "event_id")
    return inc.read_history(t.spark, path)
