"""Classification metrics and training curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators.joins import join_small
from tamarack.session import materialize


def class_labels(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``(label)``: all classes in either column, each once."""
    both = df.select(F.explode(F.array(actual, predicted)).alias("label"))
    return both.filter("label is not null").distinct()


def _listed(df: DataFrame, column: str, labels: list) -> DataFrame:
    kind = df.schema[column].dataType
    return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x).cast(kind) for x in labels])).alias("label"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: list | None = None) -> DataFrame:
    """``(actual, predicted, n)`` for every pair of classes, zeros shown."""
    shown = class_labels(df, actual, predicted) if labels is None else _listed(df, actual, labels)
    every = shown.agg(F.collect_list("label")).scalar()  # the result has this squared
    grid = shown.select(F.col("label").alias("actual"), F.explode(every).alias("predicted"))
    counts = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    joined = grid.join(counts, ["actual", "predicted"], "left")
    return joined.select("actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: share of right predictions."""
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("int")).alias("accuracy"))


def classification_report(
    df: DataFrame, actual: str, predicted: str, labels: list | None = None, names: DataFrame | None = None
) -> DataFrame:
    """``(label, precision, recall, f1, support)`` per class, then accuracy and averages.

    An undefined ratio is 0. With ``labels`` only those classes are shown and
    averaged; if that leaves classes out, ``micro avg`` stands for accuracy.
    ``names(label, name)`` gives the text shown for a class. Any number of classes.
    """
    seen = class_labels(df, actual, predicted)
    shown = seen if labels is None else _listed(df, actual, labels)
    counts = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    parts = F.array(
        F.struct(
            F.col("a").alias("label"), hit.alias("tp"), zero.alias("said"), F.col("n").alias("support")
        ),
        F.struct(F.col("p").alias("label"), zero.alias("tp"), F.col("n").alias("said"), zero.alias("support")),
    )
    sums = (
        counts.select(F.inline(parts))
        .groupBy("label")
        .agg(*[F.sum(x).alias(x) for x in ("tp", "said", "support")])
    )
    filled = [F.coalesce(x, zero).alias(x) for x in ("tp", "said", "support")]
    sums = shown.join(sums, "label", "left").select("label", *filled)  # a class without rows is shown

    def ratio(a, b):
        return F.when(b != 0, a / b).otherwise(0.0)

    precision = ratio(F.col("tp"), F.col("said"))
    recall = ratio(F.col("tp"), F.col("support"))
    rows = sums.withColumns({"precision": precision, "recall": recall})
    rows = rows.withColumn(
        "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )
    rows = materialize(rows, "classes")

    def line(label, p, r, f, s):
        return F.struct(
            label.alias("label"),
            p.cast("double").alias("precision"),
            r.cast("double").alias("recall"),
            f.cast("double").alias("f1"),
            s.cast("bigint").alias("support"),
        )

    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    if labels is None or seen.join(shown, "label", "left_anti").isEmpty():
        right = ratio(F.sum("tp"), total)
        overall = line(F.lit("accuracy"), F.lit(None), F.lit(None), right, total)
    else:
        micro_p, micro_r = ratio(F.sum("tp"), F.sum("said")), ratio(F.sum("tp"), total)
        micro_f = ratio(2 * micro_p * micro_r, micro_p + micro_r)
        overall = line(F.lit("micro avg"), micro_p, micro_r, micro_f, total)
    macro = line(F.lit("macro avg"), *[F.avg(m) for m in measures], total)
    weighted = [ratio(F.sum(F.col(m) * F.col("support")), total) for m in measures]
    tail = rows.agg(F.array(overall, macro, line(F.lit("weighted avg"), *weighted, total)).alias("r"))
    if names is not None:
        rows = join_small(rows, names.select("label", "name"), ["label"], "left")
    name = F.col("label").cast("string")
    shown_name = name if names is None else F.coalesce("name", name)
    each = rows.select(line(shown_name, *[F.col(m) for m in measures], F.col("support")).alias("r")).select("r.*")
    return each.unionByName(tail.select(F.inline("r")))


def best_iteration(log: DataFrame, metric: str = "accuracy") -> DataFrame:
    """One row ``(iter, <metric>)``: the best value, the earliest on a tie."""
    best = F.min(F.struct((-F.col(metric)).alias("neg"), "iter"))
    return log.agg(best.alias("b")).select("b.iter", (-F.col("b.neg")).alias(metric))


def training_curve(train_log: DataFrame, test_log: DataFrame, metric: str = "accuracy") -> DataFrame:
    """Metrics of both logs per iteration, with the best test iteration marked."""
    sides = [
        log.select("iter", *[F.col(c).alias(f"{side}_{c}") for c in log.columns if c != "iter"])
        for log, side in ((train_log, "train"), (test_log, "test"))
    ]
    best = best_iteration(test_log, metric).select("iter").scalar()
    return sides[0].join(sides[1], "iter").withColumn("is_best", F.col("iter") == best).orderBy("iter")
