import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tamarack.operators import classify as cl
from tamarack.operators import logistic as lo


def table(spark, n=3000):
    """Three classes nearly told apart by one column, and names with no say."""
    rng = np.random.default_rng(4)
    x, names = rng.normal(0, 3, n), rng.integers(0, 40, n)
    y = np.where(rng.random(n) < 0.02, 2, (x > 0).astype(int))
    rows = [(int(k), SparseVector(43, {0: float(v), 1: 2.5, 3 + int(m): 1.0})) for k, v, m in zip(y, x, names)]
    return spark.createDataFrame(rows, ["y", "features"])


def mllib(rows, tol=1e-12):
    step = LogisticRegression(
        labelCol="y", family="multinomial", maxIter=2000, standardization=False, regParam=1.0 / rows.count(), tol=tol
    )
    return step.fit(rows)


def test_tens_of_steps_to_the_least_loss(spark, monkeypatch):
    """The loss that MLlib comes to in many more steps; blocks, tasks and what is kept whole change nothing."""
    rows = table(spark).cache()
    want = mllib(rows)
    weights, intercepts, values = lo.fit(rows, "y", 1000)
    assert len(values) < 60 and values[-1] == pytest.approx(want.summary.objectiveHistory[-1], abs=1e-6)
    assert weights == pytest.approx(want.coefficientMatrix.toArray(), abs=0.05)
    model = cl.fit_logreg(rows, "y")
    assert (model.coefficientMatrix.toArray() == pytest.approx(weights)) and model.interceptVector.toArray() == pytest.approx(intercepts)
    a, b = (cl.score(m, rows).filter("prediction = y").count() for m in (model, want))
    assert abs(a - b) <= 3
    for name, value in (("BLOCK_ROWS", 70), ("PART_VALUES", 500), ("WHOLE", 2)):
        monkeypatch.setattr(lo, name, value)
    assert lo.fit(rows, "y", 1000)[2][-1] == pytest.approx(values[-1], abs=1e-5)


def test_gradient_and_curvature(spark):
    """Against differences of the loss."""
    rows = table(spark, 300).cache()
    blocks = lo._split_columns(lo._pack(rows, "y", "features", 2), np.array([0, 1]), 43)
    loss, rng = lo.Loss(blocks, 300, 43, 3, np.array([0, 1])), np.random.default_rng(1)
    at = rng.normal(0, 0.3, (44, 3))
    value, gradient, diagonal, full = loss.sums(at, True)
    for place in ((0, 1), (9, 2), (43, 0)):
        step = np.zeros((44, 3))
        step[place] = 1e-4
        up, down = loss.sums(at + step, False), loss.sums(at - step, False)
        assert (up[0] - down[0]) / 2e-4 == pytest.approx(gradient[place], rel=1e-4, abs=1e-8)
        turn = (up[1] - down[1]) / 2e-4
        if place[0] == 9:
            assert turn[place] == pytest.approx(diagonal[place], rel=1e-4)
        else:
            row = {0: 0, 43: 2}[place[0]] * 3 + place[1]
            assert full[row] == pytest.approx(turn[[0, 1, 43]].ravel(), rel=1e-3, abs=1e-4)


def test_odd_labels(spark):
    rows = table(spark, 50)
    for odd in (F.lit(None).cast("int"), F.lit(-1), F.lit(0.5)):
        with pytest.raises(ValueError):
            cl.fit_logreg(rows.withColumn("y", odd), "y")
    same = rows.withColumn("y", F.lit(1))
    assert {r.prediction for r in cl.score(cl.fit_logreg(same, "y"), same).collect()} == {1.0}
