"""Metrics as aggregations agree with pyspark.ml evaluators; edge cases."""

import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orchard.operators import metrics


def _scored(spark, n=2000, seed=3, ties=True):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        y = 1.0 if rng.random() < 0.35 else 0.0
        s = rng.random() * 0.6 + 0.4 * y
        if ties:
            s = round(s, 2)
        rows.append((y, s, 1.0 if s >= 0.5 else 0.0, y * 10 + rng.gauss(0, 2), rng.gauss(3, 2)))
    return spark.createDataFrame(rows, "label double, score double, prediction double, y double, yhat double")


def test_auc_matches_evaluator_with_ties(spark):
    df = _scored(spark)
    ours = metrics.auc(df).first()["auc"]
    vec = df.withColumn("raw", array_to_vector(F.array(F.lit(0.0) - F.col("score"), F.col("score"))))
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0)
    assert ours == pytest.approx(ev.evaluate(vec), abs=1e-12)


def test_auc_flip_and_one_class(spark):
    df = _scored(spark)
    a = metrics.auc(df).first()["auc"]
    b = metrics.auc(df.withColumn("score", -F.col("score"))).first()["auc"]
    assert a + b == pytest.approx(1.0, abs=1e-12)
    one = df.where("label = 1")
    assert metrics.auc(one).first()["auc"] is None


def test_classification_metrics_match_evaluators(spark):
    df = _scored(spark)
    m = metrics.classification_metrics(df).first()
    for name, key in (("accuracy", "accuracy"), ("f1", "f1_weighted")):
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert m[key] == pytest.approx(ev.evaluate(df), abs=1e-12)
    tp, fp, fn = m["tp"], m["fp"], m["fn"]
    assert m["f1_positive"] == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_f1_positive_zero_when_undefined(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    m = metrics.classification_metrics(df).first()
    assert m["f1_positive"] == 0.0 and m["accuracy"] == 1.0


def test_regression_metrics_match_evaluator(spark):
    df = _scored(spark)
    m = metrics.regression_metrics(df, label="y", prediction="yhat").first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="y", predictionCol="yhat", metricName=name)
        assert m[name] == pytest.approx(ev.evaluate(df), rel=1e-10)


def test_segments_in_one_job(spark):
    df = _scored(spark).withColumn("seg", (F.rand(1) * 3).cast("int"))
    per = {r.seg: r.auc for r in metrics.auc(df, segments=["seg"]).collect()}
    for seg, v in per.items():
        assert v == pytest.approx(metrics.auc(df.where(F.col("seg") == seg)).first()["auc"], abs=1e-12)
