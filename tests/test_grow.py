"""Forests fitted by level histograms."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from orchard.operators import forest, grow, training


@pytest.fixture(scope="module")
def rows(spark):
    """1,200 rows in three partitions; every 100th row is there three times."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(1000, 4)) * [1, 50, 1, 3], 2)
    x[:, 2] = 7.0  # one value only
    y = 1000 + 3 * x[:, 0] + (x[:, 1] > 10) * 20 + rng.normal(size=1000)
    told = [(i, Vectors.dense(v), float(t), float(t > 1005)) for i, (v, t) in enumerate(zip(x, y)) for _ in range(3 if i % 10 == 0 else 1)]
    return spark.createDataFrame(told, ["id", "features", "y", "c"]).repartition(3, "id").sortWithinPartitions("id").cache()


def _trees(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


@pytest.mark.parametrize("task,label", [(training.REGRESSION, "y"), (training.CLASSIFICATION, "c")])
def test_nodes_are_the_same_wherever_they_grow(rows, monkeypatch, task, label):
    """By passes over all rows, dealt out at once, dealt out below the root."""
    est = training.make_estimator(task, label, numTrees=3, maxDepth=5)
    assert isinstance(est, grow._Histograms)
    dealt = _trees(est.fit(rows))
    monkeypatch.setattr(grow, "GROUP_ROWS", 500)
    assert _trees(est.fit(rows)) == dealt
    monkeypatch.setattr(grow, "ROWS_AT_HAND", 900)
    assert _trees(est.fit(rows)) == dealt
    monkeypatch.setattr(grow, "ROWS_AT_HAND", 0)
    assert _trees(est.fit(rows)) == dealt


def test_fewer_trees_are_the_first_of_more_trees(rows):
    few, many = (training.make_estimator(training.REGRESSION, "y", numTrees=k, maxDepth=4).fit(rows) for k in (2, 5))
    assert _trees(few) == _trees(many)[:2] and len(set(_trees(many))) == 5


@pytest.mark.parametrize("task,label", [(training.REGRESSION, "y"), (training.CLASSIFICATION, "c")])
def test_without_draws_the_tree_is_that_of_mllib(spark, rows, task, label):
    """Leaves, counts, impurities and importances; features of one value are
    never split."""
    est = training.make_estimator(task, label, numTrees=1, maxDepth=4, bootstrap=False, maxBins=64)
    own = est.fit(rows)
    plain = super(grow._Histograms, est)._fit(rows)
    assert own.totalNumNodes == plain.totalNumNodes
    assert np.allclose(own.featureImportances.toArray(), plain.featureImportances.toArray(), rtol=1e-6)
    a, b = (forest.node_table(m, spark).orderBy("tree", "node").collect() for m in (own, plain))
    assert [(r["feature"], r["threshold"], r["n_rows"]) for r in a] == [(r["feature"], r["threshold"], r["n_rows"]) for r in b]
    assert np.allclose([r["value"] for r in a], [r["value"] for r in b], rtol=1e-9)


def test_other_labels_are_fitted_by_mllib(rows):
    three = rows.withColumn("c", F.col("id") % 3 * 1.0)
    assert training.make_estimator(training.CLASSIFICATION, "c", numTrees=2, maxDepth=2).fit(three).numClasses == 3


def test_candidate_thresholds():
    assert grow.candidate_thresholds(np.array([1.0, 3.0, 3.0, np.nan, 9.0]), 32).tolist() == [2.0, 6.0]
    many = grow.candidate_thresholds(np.arange(1000.0), 32)
    assert len(many) == 31 and np.allclose(np.diff(many), 31.25, atol=1)
    assert grow.candidate_thresholds(np.full(5, 4.0), 32).size == 0
