import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.operators import boosting as bo
from tamarack.operators import classify as cl
from tamarack.operators import features as ft
from tamarack.operators import metrics as me
from tamarack.plans import learning
from tamarack.plans.registry import Tables
from tamarack.session import materialize


def test_shared_onehot(spark):
    train = spark.createDataFrame([("b", "a"), ("a", "c"), ("c", None)], "x string, y string")
    vocabulary = ft.shared_vocabulary(train, ["x", "y"])
    assert sorted(map(tuple, vocabulary.collect())) == [("a", 0), ("b", 1), ("c", 2)]
    rows = spark.createDataFrame([("c", "new"), ("a", None)], "x string, y string")
    got = sorted(ft.onehot_shared(rows, ["x", "y"], vocabulary).collect(), key=lambda r: r.x)
    assert [list(r.x_vec.toArray()) for r in got] == [[1, 0, 0], [0, 0, 1]]
    assert [list(r.y_vec.toArray()) for r in got] == [[0, 0, 0], [0, 0, 0]]


def test_labels_there_and_back(spark):
    df = spark.createDataFrame([("red",), ("blue",), ("nc",), ("red",)], "w string")
    coded = ft.label_encode(df, "w")
    assert {r.w: r.label_index for r in coded.collect()} == {"blue": 0, "nc": 1, "red": 2}
    classes = coded.select(F.col("w").alias("name"), F.col("label_index").alias("index")).distinct()
    back = ft.label_decode(coded, "label_index", classes, "again")
    assert all(r.w == r.again for r in back.collect()) and back.count() == 4


def test_unseen_labels(spark):
    train = spark.createDataFrame([("a",), ("b",)], "y string")
    test = spark.createDataFrame([("a", 1), ("z", 2)], "y string, id int")
    assert [r.id for r in ft.drop_unseen_labels(train, test, "y").collect()] == [1]


ROWS = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(ROWS, "y string, p string")


def test_confusion(scored):
    got = {(r.actual, r.predicted): r.n for r in me.confusion_matrix(scored, "y", "p").collect()}
    assert len(got) == 9 and got["a", "a"] == 3 and got["c", "a"] == 1 and got["b", "c"] == 0


def test_report(scored):
    names = scored.sparkSession.createDataFrame([("a", "A!")], "label string, name string")
    got = {r.label: r for r in me.classification_report(scored, "y", "p", names=names).collect()}
    assert set(got) == {"A!", "b", "c", "accuracy", "macro avg", "weighted avg"}
    assert (got["A!"].precision, got["A!"].recall, got["A!"].support) == (0.75, 0.75, 4)
    assert (got["c"].precision, got["c"].recall, got["c"].f1) == (0, 0, 0)  # never predicted
    assert got["accuracy"].f1 == pytest.approx(5 / 7) and got["accuracy"].support == 7
    assert got["macro avg"].recall == pytest.approx((0.75 + 1 + 0) / 3)
    assert got["weighted avg"].recall == pytest.approx(5 / 7)


def test_report_for_some_labels(scored):
    got = {r.label: r for r in me.classification_report(scored, "y", "p", labels=["a", "x"]).collect()}
    assert set(got) == {"a", "x", "micro avg", "macro avg", "weighted avg"}
    assert got["x"].support == 0 and got["micro avg"].precision == 0.75


def test_curve(spark):
    train = spark.createDataFrame([(0, 0.8, 1.0), (1, 0.9, 0.9), (2, 1.0, 0.8)], "iter int, accuracy double, loss double")
    test = spark.createDataFrame([(0, 0.6, 1.0), (1, 0.7, 0.9), (2, 0.7, 0.8)], "iter int, accuracy double, loss double")
    assert tuple(me.best_iteration(test).first()) == (1, 0.7)
    assert [r.is_best for r in me.training_curve(train, test).collect()] == [False, True, False]


def test_models_learn(spark):
    rows = spark.range(300).select(
        (F.col("id") % 3).cast("double").alias("y"),
        ((F.col("id") % 3) * 10 + F.rand(1)).alias("x"),
        F.rand(2).alias("noise"),
    )
    rows = ft.assemble(rows, ["x", "noise"]).cache()
    for scored in (
        cl.score(cl.fit_decision_tree(rows, "y"), rows),
        cl.score(cl.fit_random_forest(rows, "y", trees=5, depth=5), rows),
        cl.score(cl.fit_logreg(rows, "y"), rows),
        bo.score_boosted(bo.fit_boosted(rows, rows, "y", rounds=2, depth=2), rows),
    ):
        assert me.accuracy(scored, "y", "prediction").first()[0] > 0.95


def test_deep_forests_keep_the_place_of_each_row(spark, monkeypatch):
    """Levels don't start from the root again, and the trees are the same as if they did."""
    rows = spark.range(600).select((F.col("id") % 2).alias("y"), (F.col("id") % 2 + 3 * F.rand(1)).alias("x"), F.rand(2).alias("z"))
    rows = materialize(ft.assemble(rows, ["x", "z"]), "rows")
    kept = cl.fit_random_forest(rows, "y", trees=4)
    assert kept.getCacheNodeIds() and kept.getMaxDepth() == 30
    real = cl.RandomForestClassifier
    monkeypatch.setattr(cl, "RandomForestClassifier", lambda **kw: real(**kw | {"cacheNodeIds": False}))
    again = cl.fit_random_forest(rows, "y", trees=4)
    assert max(m.depth for m in kept.trees) > 5
    assert [m.toDebugString.split("\n")[1:] for m in kept.trees] == [m.toDebugString.split("\n")[1:] for m in again.trees]


def test_forests_in_groups_of_trees(spark, monkeypatch):
    """Of many rows the driver grows some trees at a time; the votes of all of them count, and all rows are scored."""
    rows = spark.range(900).select("id", (F.col("id") % 3).alias("y"), (F.col("id") % 3 + 1.6 * F.rand(1)).alias("x"), F.rand(2).alias("z"))
    rows = materialize(ft.assemble(rows, ["x", "z"]), "rows")
    asked, real = [], cl.RandomForestClassifier
    monkeypatch.setattr(cl, "RandomForestClassifier", lambda **kw: asked.append((kw["numTrees"], kw["seed"])) or real(**kw))
    monkeypatch.setattr(cl, "TREE_ROWS", 900 * 4)
    model = cl.fit_random_forest(rows, "y", trees=10, depth=6)
    assert [n for n, _ in asked] == [4, 4, 2] and len({s for _, s in asked}) == 3
    scored = cl.score(model, rows)
    assert scored.columns == [*rows.columns, "prediction"]
    groups = [{r.id: r.rawPrediction for r in cl.RandomForestClassificationModel.load(p).transform(rows).collect()} for p in model.paths]
    want = {i: int(np.argmax(sum(g[i].toArray() for g in groups))) for i in groups[0]}
    assert {r.id: r.prediction for r in scored.collect()} == want
    assert len(cl.score_held_out(rows, lambda r: cl.fit_random_forest(r, "y", trees=10, depth=4), ["id"], folds=2).collect()) == 900


def test_a_step_of_logreg_adds_up_large_blocks(spark):
    """A gradient of all features per block of rows, not per megabyte of them."""
    rows = spark.range(300).select((F.col("id") % 3).alias("y"), (F.col("id") % 3 + F.rand(1)).alias("x"))
    assert cl.fit_logreg(ft.assemble(rows, ["x"]), "y", max_iter=3).getMaxBlockSizeInMB() >= 64


@pytest.fixture(scope="module")
def signal(spark):
    """Three classes that follow two of four columns, one label in ten at random."""
    rows = spark.range(1500).select(
        "id",
        F.rand(1).alias("a"),
        F.rand(2).alias("b"),
        F.rand(3).alias("noise"),
        (F.rand(4) < 0.5).cast("double").alias("flag"),
        F.rand(5).alias("luck"),
    )
    kind = F.when(F.col("a") + F.col("flag") > 1.1, 2).when(F.col("b") > 0.5, 1).otherwise(0)
    rows = rows.withColumn("y", F.when(F.col("luck") < 0.1, F.floor(F.col("luck") * 30)).otherwise(kind).cast("int"))
    return materialize(ft.assemble(rows, ["a", "b", "noise", "flag"]).select("id", "y", "features"), "signal")


def test_all_rounds_run_and_the_best_is_kept(spark, signal):
    train, watched, judged = (signal.filter(f"id % 5 {c}") for c in ("> 1", "= 0", "= 1"))
    model = bo.fit_boosted(train, watched, "y", rounds=120, rate=0.1, depth=4)
    log = sorted(model.log.collect(), key=lambda r: r.iter)
    assert [r.iter for r in log] == list(range(120))
    best = max(log, key=lambda r: (r.test_accuracy, -r.iter))
    assert model.best == best.iter
    assert log[-1].train_loss < log[20].train_loss < log[0].train_loss
    scored = bo.score_boosted(model, judged)
    assert scored.columns == ["id", "y", "features", "prediction"]
    assert me.accuracy(scored, "y", "prediction").first()[0] > 0.8
    at_best = bo.score_boosted(model, watched)
    assert me.accuracy(at_best, "y", "prediction").first()[0] == pytest.approx(best.test_accuracy)
    train_log, test_log = bo.read_logs(model)
    assert me.best_iteration(test_log).first().iter == model.best
    assert [r.iter for r in me.training_curve(train_log, test_log).filter("is_best").collect()] == [model.best]


def test_least_loss_can_be_the_metric(signal):
    train, watched = signal.filter("id % 2 = 0"), signal.filter("id % 2 = 1")
    model = bo.fit_boosted(train, watched, "y", rounds=60, rate=0.3, depth=6, metric="loss")
    log = {r.iter: r.test_loss for r in model.log.collect()}
    assert model.best == min(log, key=lambda i: (log[i], i)) < 59  # later rounds only learn the noise


def test_rows_dealt_to_several_ensembles(signal):
    train, watched = signal.filter("id % 5 <> 0"), signal.filter("id % 5 = 0")
    model = bo.fit_boosted(train, watched, "y", rounds=40, depth=4, max_rows=400)
    assert model.trees.select("ensemble").distinct().count() == 3
    assert max(r.test_accuracy for r in model.log.collect()) > 0.8
    again = bo.fit_boosted(train.repartition(3, "id"), watched, "y", rounds=40, depth=4, max_rows=400)
    assert sorted(map(str, again.trees.collect())) == sorted(map(str, model.trees.collect()))


def test_every_row_is_fitted_however_many_there_are(signal, monkeypatch):
    """More rows than ensembles of ``max_rows`` can take make the parts larger, then more; none is left out."""
    tables, real = {}, bo.materialize
    monkeypatch.setattr(bo, "materialize", lambda df, name="table": tables.setdefault(name, real(df, name)))
    train = signal.filter("id % 5 <> 0")
    model = bo.fit_boosted(train, signal.filter("id % 5 = 0"), "y", rounds=2, depth=2, max_rows=100, max_ensembles=3)
    assert tables["dealt"].count() == train.count() == 1200
    assert model.trees.select("ensemble").distinct().count() == 3
    assert bo.n_parts(bo.TASK_ROWS * 8 + 1, bo.MAX_ROWS, bo.MAX_ENSEMBLES) == 9


def test_a_level_from_one_side_of_the_level_before():
    """Sums carried over from level to level give the gains of sums made anew; names need no pass over all rows each."""
    rng = np.random.default_rng(8)
    n, names = 3000, 2000
    x = {0: rng.integers(0, 90, n), 1: rng.integers(-1, 2, n), 2: 1 + rng.integers(0, 2, n)}
    row = np.concatenate([np.tile(np.arange(n), 3), np.arange(n)])
    feature = np.concatenate([np.repeat([0, 1, 2], n), 3 + rng.integers(0, names, n)])
    value = np.concatenate([x[0], x[1], x[2], np.full(n, 0.5)]).astype(float)
    columns = bo.Columns(row[value != 0], feature[value != 0], value[value != 0], n)
    assert columns.flags == 1 + len(np.unique(feature[3 * n :])) and columns.bins[0].nbytes == n
    assert (np.diff(columns.feature[: columns.flags]) > 0).all() and (columns.threshold[1 : columns.flags] == 0.25).all()
    stats = np.column_stack([rng.normal(0, 1, (n, 2)), np.ones(n)])
    level = bo.Level(columns, np.zeros(n, np.int64), stats.sum(0)[None], stats)
    for t in (columns.flags + 5, 0, 7, len(columns.threshold) - 1):
        level.split(columns.is_above(t))
        whole = np.stack([stats[level.leaf == v].sum(0) for v in range(level.leaf.max() + 1)])
        whole = np.vstack([whole, np.zeros((len(level.whole) - len(whole), 3))])
        assert level.gains(bo.SHRINK) == pytest.approx(columns.gains(level.leaf, whole, stats, bo.SHRINK))


def test_a_round_is_the_best_split_of_each_level():
    """Against all thresholds tried one by one."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 5, 60), rng.integers(0, 2, 60), rng.integers(-2, 3, 60)]).astype(float)
    g = rng.normal(0, 1, (60, 2))
    row, feature = np.nonzero(x)
    columns = bo.Columns(row, feature, x[row, feature], 60)
    chosen, leaf = bo.grow(columns, g, 3)
    sides = [(f, t) for f in range(3) for t in bo.borders_of(x[:, f])]
    assert sorted(zip(columns.feature.tolist(), columns.threshold.tolist())) == sorted(sides)
    have = np.zeros(60, int)

    def worth(leaf):
        return sum((g[leaf == v].sum(0) ** 2).sum() / ((leaf == v).sum() + bo.SHRINK) for v in set(leaf.tolist()))

    for t in chosen:
        best = max(worth(2 * have + (x[:, f] > b)) for f, b in sides)
        have = 2 * have + (x[:, columns.feature[t]] > columns.threshold[t])
        assert worth(have) == pytest.approx(best)
    assert (have == leaf).all()


def test_odd_tables_for_boosting(spark, signal):
    empty = signal.filter("id < 0")
    with pytest.raises(ValueError):
        bo.fit_boosted(empty, signal, "y", rounds=2)
    one = signal.filter("y = 1")
    model = bo.fit_boosted(one, empty, "y", rounds=3, depth=2)  # one class, nothing to watch
    assert {r.prediction for r in bo.score_boosted(model, signal).collect()} == {1} and model.best == 0
    assert bo.score_boosted(model, empty).count() == 0


def test_held_out_rows_only(spark):
    """Labels without any signal are not predicted, however deep the model."""
    rows = spark.range(400).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), (F.xxhash64("id") % 2 == 0).cast("int").alias("y"))
    rows = materialize(ft.assemble(rows, ["a", "b"]), "rows")
    scored = cl.score_held_out(rows, lambda r: cl.fit_decision_tree(r, "y", depth=20), ["id"], folds=2)
    assert scored.count() == 400
    assert 0.35 < me.accuracy(scored, "y", "prediction").first()[0] < 0.65
    assert not learning._verdict(scored, "y").first().better
    known = cl.score(cl.fit_decision_tree(rows, "y", depth=20), rows)
    assert learning._verdict(known, "y").first().better  # what scoring known rows would say


@pytest.mark.parametrize("name", ["decision_tree_churn", "score_batch", "random_forest", "boosted_trees"])
def test_verdicts_turn_false_without_signal(spark, root, name, monkeypatch):
    t = Tables(spark, root)

    def shuffled(rows, label):
        kinds = rows.select(label).distinct().agg(F.sort_array(F.collect_list(label))).first()[0]
        picked = F.get(F.array(*[F.lit(k) for k in kinds]), F.pmod(F.xxhash64(rows[rows.columns[0]], F.lit(9)), F.lit(len(kinds))).cast("int"))
        return rows.withColumn(label, picked)

    real_players, real_features = learning.players, learning._features
    monkeypatch.setattr(learning, "players", lambda t: shuffled(real_players(t), "churn"))
    monkeypatch.setattr(learning, "_features", lambda t: shuffled(real_features(t).select("match_id", "label_index", "features"), "label_index"))
    monkeypatch.setattr(learning, "ROUNDS", 20)
    assert not getattr(learning, name)(t).first().better


def test_a_split_costs_what_its_rows_cost():
    """Flags are worth the same as binned columns, and a table of all leaves and flags is never made."""
    rng = np.random.default_rng(5)
    n, flags = 400, 300_000
    row, feature = np.arange(n), rng.choice(flags, n, replace=False)
    feature[: n // 2] = rng.integers(0, 3, n // 2)  # three frequent ones
    columns = bo.Columns(row, feature, np.ones(n), n)
    leaf, g = rng.integers(0, 128, n), rng.normal(0, 1, (n, 3))
    stats = np.column_stack([g, np.ones(n)])
    whole = np.column_stack([np.bincount(leaf, weights=s, minlength=128) for s in stats.T])
    gain = columns.gains(leaf, whole, stats, bo.SHRINK)
    for t in (0, 1, 2, len(gain) - 1):
        above, want = feature == columns.feature[t], 0.0
        for v in range(128):
            for side in (leaf == v) & above, (leaf == v) & ~above:
                want += (g[side].sum(0) ** 2).sum() / (side.sum() + bo.SHRINK)
        assert gain[t] == pytest.approx(want)
    tracemalloc.start()
    wide = bo.Columns(np.arange(20_000), np.arange(20_000), np.ones(20_000), 20_000)
    bo.grow(wide, rng.normal(0, 1, (20_000, 3)), 8)
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()


def test_leaves_by_places():
    """Against plain columns, with thresholds below, at and above zero and features that no row has."""
    rng = np.random.default_rng(6)
    x = rng.integers(-2, 3, (50, 6)) * (rng.random((50, 6)) < [1, 0.8, 0.2, 0.1, 0.05, 0])
    row, feature = np.nonzero(x)
    places = bo.Places(row, feature, x[row, feature].astype(float), 50)
    for _ in range(30):
        chosen, at = rng.integers(0, 6, 4), rng.choice([-1.5, -1, -0.5, 0, 0.5, 1.5], 4)
        want = sum((x[:, f] > t).astype(int) << (3 - i) for i, (f, t) in enumerate(zip(chosen, at)))
        assert (places.leaf(chosen.tolist(), at.tolist()) == want).all()
