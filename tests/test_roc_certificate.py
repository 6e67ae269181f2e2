"""Exact AUC and the optimality certificate against plain computations."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from shoal.operators.certificate import optimality
from shoal.operators.roc import auc, roc_points


def plain_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y != 1]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits, ranges", [(0, 256), (1, 4), (6, 256), (6, 1)])
def test_auc_equals_all_pairs(spark, digits, ranges):
    r = random.Random(digits)
    rows = [(round(r.gauss(y * 0.7, 1), digits), y) for y in [0, 1, 1] * 250]
    df = spark.createDataFrame(rows + [(None, 1), (float("nan"), 0), (0.5, None)], "s double, y int")
    got = auc(df, "s", "y", ranges).first()
    assert (got["positives"], got["negatives"]) == (500, 250)
    assert got["auc"] == pytest.approx(plain_auc(rows), abs=1e-12)


def test_auc_equals_sparks_evaluator(spark):
    r = random.Random(9)
    rows = [(r.random() + 0.2 * (y := i % 2), float(y)) for i in range(2000)]
    df = spark.createDataFrame(rows, "s double, y double")
    assert auc(df, "s", "y").first()["auc"] == pytest.approx(BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df), abs=1e-9)


def test_degenerate_inputs(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert auc(df, "s", "y").first()["auc"] is None
    assert tuple(auc(df.limit(0), "s", "y").first()) == (0, 0, None)
    ties = spark.createDataFrame([(0.5, i % 2) for i in range(1000)], "s double, y int")
    assert auc(ties, "s", "y").first()["auc"] == 0.5


def test_roc_points(spark):
    rows = [(0.91, 1), (0.85, 0), (0.62, 1), (0.61, 1), (0.2, 0), (-0.35, 0)]
    got = [(round(x["threshold"], 6), x["true_positives"], x["false_positives"], x["tpr"], x["fpr"])
           for x in roc_points(spark.createDataFrame(rows, "s double, y int"), "s", "y").orderBy(F.desc("threshold")).collect()]
    assert got == [(0.9, 1, 0, 1 / 3, 0.0), (0.8, 1, 1, 1 / 3, 1 / 3), (0.6, 3, 1, 1.0, 1 / 3), (0.2, 3, 2, 1.0, 2 / 3), (-0.4, 3, 3, 1.0, 1.0)]


@pytest.fixture(scope="module")
def fitted(spark):
    r = np.random.default_rng(1)
    n, d = 400, 30
    x = np.where(r.random((n, d)) < 0.2, r.random((n, d)), 0.0)
    x[0] = 0  # a row without entries
    y = (x @ r.normal(size=d) + 0.3 * r.normal(size=n) > 0).astype(float)
    reg = 1.0 / n
    vec = spark.createDataFrame([(SparseVector(d, {int(j): float(x[i, j]) for j in np.flatnonzero(x[i])}), float(y[i])) for i in range(n)], ["features", "label"])
    model = LogisticRegression(regParam=reg, elasticNetParam=0.0, standardization=False, maxIter=500, tol=1e-10).fit(vec)
    long = spark.createDataFrame([(i, int(j), float(x[i, j])) for i in range(n) for j in np.flatnonzero(x[i])], "doc_id int, idx int, weight double")
    docs = spark.createDataFrame([(i, float(y[i])) for i in range(n)], "doc_id int, label double")
    return x, y, reg, model.coefficients.toArray(), model.intercept, long, docs


def plain(x, y, w, b, reg):
    m = x @ w + b
    loss = np.mean(np.log1p(np.exp(-np.where(y == 1, m, -m)))) + reg / 2 * (w @ w)
    g = 1 / (1 + np.exp(-m)) - y
    return loss, np.sqrt(np.sum((x.T @ g / len(y) + reg * w) ** 2) + np.mean(g) ** 2)


@pytest.mark.parametrize("shift", [0.0, 0.5, 40.0])
def test_loss_and_gradient(spark, fitted, shift):
    x, y, reg, w, b, long, docs = fitted
    w = w + shift
    coefs = spark.createDataFrame([(i, float(v)) for i, v in enumerate(w)], "idx int, coef double")
    got = optimality(long, docs, coefs, b, reg, "doc_id").first()
    loss, norm = plain(x, y, w, b, reg)
    assert got["rows"] == len(y) and got["loss"] == pytest.approx(loss, rel=1e-9) and got["gradient_norm"] == pytest.approx(norm, rel=1e-6, abs=1e-9)
    p = y.mean()
    assert got["constant_loss"] == pytest.approx(-(p * np.log(p) + (1 - p) * np.log(1 - p)))
    if shift:
        assert got["gradient_norm"] > 1e-2
    else:
        assert got["gradient_norm"] < 1e-5 and got["loss"] < got["constant_loss"]
