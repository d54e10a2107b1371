"""Node tables, prefix search and normal equations."""

import duckdb
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orchard.functions.features import derive_features
from orchard.operators import forest, linear, split, training
from orchard.plans import train as train_plan
from orchard.session import fresh_path
from orchard.sources.views import METRICS_KEYS, signal_labels, signal_view

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")


@pytest.mark.parametrize("task,label,view", [(training.CLASSIFICATION, "fraud", signal_labels), (training.REGRESSION, "query_latency", signal_view)])
def test_duckdb_scores_from_the_written_node_table(spark, lineitem, task, label, view):
    res = train_plan.train(view(lineitem), task, label, METRICS_KEYS, params={"numTrees": 4, "maxDepth": 6})
    model = res.model.stages[-1]
    root = fresh_path(spark, "nodes")
    forest.node_table(model, spark).coalesce(1).write.parquet(root + "/nodes")
    own = training.with_score(res.predictions) if task == training.CLASSIFICATION else res.predictions.withColumn("score", F.col("prediction"))
    own.select(F.monotonically_increasing_id().alias("row"), vector_to_array("features").alias("x"), "score").coalesce(1).write.parquet(root + "/rows")
    root = root.removeprefix("file:")
    bad, n = duckdb.connect().execute(f"""
        WITH RECURSIVE nodes AS (SELECT * FROM read_parquet('{root}/nodes/*.parquet')), rows AS (SELECT * FROM read_parquet('{root}/rows/*.parquet')),
        walk AS (
          SELECT r.row, n.tree, n.node FROM rows r, nodes n WHERE n.node = 0
          UNION ALL
          SELECT w.row, w.tree, CASE WHEN r.x[n.feature + 1] <= n.threshold THEN n.left ELSE n.right END
          FROM walk w JOIN nodes n USING (tree, node) JOIN rows r USING (row) WHERE n.feature IS NOT NULL
        ),
        scored AS (SELECT w.row, avg(n.value) AS score FROM walk w JOIN nodes n USING (tree, node) WHERE n.feature IS NULL GROUP BY w.row)
        SELECT count(*) FILTER (abs(s.score - r.score) > 1e-9 * greatest(1, abs(r.score)) OR s.score IS NULL), count(*) FROM rows r LEFT JOIN scored s USING (row)
    """).fetchone()
    assert (bad, n) == (0, res.predictions.count())
    by_joins = forest.score_with_nodes(res.predictions, spark.read.parquet(root + "/nodes"), 4, 6, METRICS_KEYS)
    both = own.withColumn("features", vector_to_array("features")).join(by_joins.withColumnRenamed("score", "joined"), [*METRICS_KEYS, "features"])
    assert both.count() == n and both.where(F.abs(F.col("score") - F.col("joined")) > 1e-9 * F.greatest(F.lit(1.0), F.abs("score"))).count() == 0


def _vectors(lineitem, view, label):
    pipe, _ = training.build_pipeline(view(lineitem), training.REGRESSION if label == "query_latency" else training.CLASSIFICATION, label, METRICS_KEYS)
    derive, inner = training.split_derivation(pipe)
    rows = derive.transform(view(lineitem))
    prep = Pipeline(stages=inner.getStages()[:-1]).fit(rows)
    return prep.transform(rows).select(*METRICS_KEYS, label, "features").coalesce(1).persist()


def test_a_prefix_is_the_mean_of_its_trees(spark, lineitem):
    """Prefix k of a forest equals the mean of its first k fitted trees; the
    last prefix is the forest itself."""
    rows = _vectors(lineitem, signal_view, "query_latency")
    model = training.make_estimator(training.REGRESSION, "query_latency", numTrees=6, maxDepth=5).fit(rows)
    got = forest.prefix_scores(model, rows, [1, 2, 6], ["features"]).collect()[:50]
    for r in got:
        each = [t.predict(r["features"]) for t in model.trees]
        assert np.allclose(r["scores"], [np.mean(each[:k]) for k in (1, 2, 6)], rtol=1e-12)
        assert r["scores"][2] == pytest.approx(model.predict(r["features"]), rel=1e-12)


@pytest.mark.parametrize("view,label", [(signal_view, "query_latency"), (signal_labels, "fraud")])
def test_prefix_and_separate_fit_agree_within_a_bound(spark, lineitem, view, label):
    """Spark draws a row's bootstrap weights for all trees in one sequence, so
    the trees of a separate fit differ; its metric stays within 10 % (RMSE) or
    0.03 (AUC) of the prefix's, well below the distance to an uninformed model."""
    task = training.REGRESSION if label == "query_latency" else training.CLASSIFICATION
    rows = _vectors(lineitem, view, label)
    tr, va = split.hash_split(rows, METRICS_KEYS)
    counts = [10, 20, 30]
    whole = training.make_estimator(task, label, numTrees=30, maxDepth=5).fit(tr)
    prefix = [m for m, _ in training._fold_scores(whole, va, task, label, counts)]
    for k, m in zip(counts, prefix):
        alone = training.make_estimator(task, label, numTrees=k, maxDepth=5).fit(tr)
        (own, n), = training._fold_scores(alone, va, task, label, [k])
        assert n == va.count()
        assert abs(own - m) < (0.1 * own if task == training.REGRESSION else 0.03)


def test_search_picks_the_best_mean_and_refits(spark, lineitem):
    grid = {"numTrees": [2, 4], "maxDepth": [2, 5]}
    res = train_plan.train(signal_view(lineitem), training.REGRESSION, "query_latency", METRICS_KEYS, grid=grid)
    means = {(r["numTrees"], r["maxDepth"]): r["mean_rmse"] for r in res.grid_metrics.collect()}
    folds = res.fold_metrics.collect()
    assert len(means) == 4 and len(folds) == 12 and {r["fold"] for r in folds} == {0, 1, 2}
    for key, m in means.items():
        own = [r["rmse"] for r in folds if (r["numTrees"], r["maxDepth"]) == key]
        assert m == pytest.approx(np.mean(own))
    best = min(means, key=means.get)
    assert (res.best_params["numTrees"], res.best_params["maxDepth"]) == best
    last = res.model.stages[-1]
    assert last.getNumTrees == best[0] and last.getOrDefault("maxDepth") == best[1]
    linear_grid = train_plan.train(signal_view(lineitem), training.REGRESSION, "query_latency", METRICS_KEYS, grid=training.LINEAR_GRID, model_type="lr")
    assert linear_grid.grid_metrics.count() == 3 and linear_grid.fold_metrics.count() == 9


def test_normal_equations(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4)) * [1, 1000, 1e-3, 1] + [0, 1e6, 5, 0]
    x[:, 3] = 7.0  # no variance
    y = 3 + x[:, :3] @ [2.0, -0.5, 40.0] + rng.normal(size=500) * 0.1
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)] + [(None, 1.0, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double").repartition(6)
    fit = linear.fit_linear(df, ["a", "b", "c", "d"], "y")
    want = np.linalg.lstsq(np.column_stack([x[:, :3] - x[:, :3].mean(0), np.ones(500)]), y, rcond=None)[0]
    assert fit.n_rows == 500 and fit.coefficients[3] == 0.0
    assert np.allclose(fit.coefficients[:3], want[:3], rtol=1e-7)
    rest = df.dropna().withColumn("rest", F.col("y") - fit.predict())
    assert abs(rest.agg(F.avg("rest")).first()[0]) < 1e-8
    assert all(abs(rest.agg(F.corr("rest", c)).first()[0]) < 1e-7 for c in "abc")
    twice = linear.fit_linear(df.withColumn("a2", F.col("a") * 2), ["a", "a2"], "y")  # one determines the other
    assert np.isfinite(twice.coefficients).all()
    assert linear.fit_linear(df.limit(0), ["a", "b"], "y") == linear.LinearFit(("a", "b"), (0.0, 0.0), 0.0, 0)


def test_spark_and_normal_equations_agree(spark, lineitem):
    res = train_plan.train(signal_view(lineitem), training.REGRESSION, "query_latency", METRICS_KEYS, model_type="lr")
    train, _ = split.hash_split(derive_features(signal_view(lineitem)), METRICS_KEYS)
    fit = linear.fit_linear(train, res.features, "query_latency")
    gap = derive_features(signal_view(lineitem)).withColumn("own", fit.predict()).select(*METRICS_KEYS, "own").join(res.predictions, METRICS_KEYS)
    assert gap.agg(F.max(F.abs(F.col("own") - F.col("prediction")))).first()[0] < 1e-6


@pytest.mark.parametrize("view,label", [(signal_view, "query_latency"), (signal_labels, "fraud")])
def test_a_cut_tree_is_the_tree_of_that_depth(spark, lineitem, view, label):
    """With every feature tried at every node and no bootstrap nothing is drawn:
    a deep forest cut at a depth scores as one fitted to that depth."""
    task = training.REGRESSION if label == "query_latency" else training.CLASSIFICATION
    rows = _vectors(lineitem, view, label)
    setting = {"bootstrap": False, "featureSubsetStrategy": "all", "numTrees": 2}
    deep = training.make_estimator(task, label, maxDepth=8, **setting).fit(rows)
    got = np.array([r["scores"] for r in forest.prefix_scores(deep, rows, [1, 2], [label], depths=[2, 5, 8]).collect()])
    for i, d in enumerate((2, 5, 8)):
        alone = training.make_estimator(task, label, maxDepth=d, **setting).fit(rows)
        want = [r["scores"] for r in forest.prefix_scores(alone, rows, [1, 2], [label]).collect()]
        assert np.allclose(got[:, 2 * i : 2 * i + 2], want, rtol=1e-12)


def test_forest_parts_add_up(spark, lineitem, monkeypatch):
    """A forest fitted in parts is searched like one fitted at once; its driver
    never holds more trees than the node budget allows."""
    monkeypatch.setattr(training, "NODES_AT_ONCE", 3 << 6)
    assert training.forest_parts(8, 5) == [3, 3, 2] and training.forest_parts(8, 20) == [1] * 8 and training.forest_parts(3, 2) == [3]
    rows = _vectors(lineitem, signal_view, "query_latency")
    est = training.make_estimator(training.REGRESSION, "query_latency")
    got = training._forest_scores(est, {}, rows, rows, "query_latency", [2, 4, 8], [3, 5]).collect()
    models = [est.copy({est.numTrees: t, est.maxDepth: 5, est.seed: 42 + 1_000_003 * i}).fit(rows) for i, t in enumerate((3, 3, 2))]
    x = [r["features"] for r in rows.limit(20).collect()]
    trees = [t for m in models for t in m.trees]
    for r, v in zip(got, x):
        each = [t.predict(v) for t in trees]
        assert len(r["scores"]) == 6 and np.allclose(r["scores"][3:], [np.mean(each[:k]) for k in (2, 4, 8)], rtol=1e-12)


def test_a_search_fits_one_forest_per_fold(spark, lineitem, monkeypatch):
    fitted = []
    own = training.without_summary
    monkeypatch.setattr(training, "without_summary", lambda m, s: fitted.append(m) or own(m, s))
    res = train_plan.train(signal_labels(lineitem), training.CLASSIFICATION, "fraud", METRICS_KEYS, grid={"numTrees": [2, 3], "maxDepth": [2, 4]})
    assert sum(hasattr(m, "totalNumNodes") for m in fitted) == 3 + 1  # a forest a fold, the refit
    assert res.grid_metrics.count() == 4 and res.fold_metrics.count() == 12


def test_node_ids_are_cached_for_deep_trees_only():
    assert not training.make_estimator(training.REGRESSION, "y", maxDepth=10).getCacheNodeIds()
    assert training.make_estimator(training.REGRESSION, "y", maxDepth=15).getCacheNodeIds()
    est = training.make_estimator(training.CLASSIFICATION, "y")
    assert not est.getCacheNodeIds() and training._with_setting(est, {"maxDepth": 12}).getOrDefault("cacheNodeIds")


def test_leaves_are_fitted_on_laid_out_rows(spark, lineitem, monkeypatch):
    """The scan's partitions follow the files; the fit's follow the row count."""
    from orchard import catalog

    made = []
    monkeypatch.setattr(training, "layout_partitions", lambda n: made.append(n) or 7)
    own = training.stable_layout
    monkeypatch.setattr(training, "stable_layout", lambda *a: made.append(own(*a)) or made[-1])
    totals = catalog.q_forest_leaves(spark, SF_SMALL).collect()
    assert len(totals) == 3 and {r["n_rows"] for r in totals} == {made[0]} and made[1].rdd.getNumPartitions() == 7


def _spied(monkeypatch, frame):
    """Layouts made and storage levels asked for from here on."""
    made, kept = [], []
    own, persist = training.stable_layout, frame.persist
    monkeypatch.setattr(training, "stable_layout", lambda *a: made.append(a[2]) or own(*a))
    monkeypatch.setattr(frame, "persist", lambda self, level=None: kept.append(level) or (persist(self, level) if level else persist(self)))
    return made, kept


def test_settings_share_one_layout_and_fit_as_alone(spark, lineitem, monkeypatch):
    from orchard import catalog

    data, task = signal_labels(lineitem), training.CLASSIFICATION
    settings = [{"numTrees": 2, "maxDepth": 2}, {"numTrees": 3, "maxDepth": 4}]
    alone = [train_plan.train(data, task, "fraud", METRICS_KEYS, params=p) for p in settings]
    made, _ = _spied(monkeypatch, type(data))
    both = train_plan.train_each(data, task, "fraud", METRICS_KEYS, settings)
    assert len(made) == 1
    for got, want in zip(both, alone):
        assert got.extra == want.extra and got.best_params == want.best_params
        assert got.predictions.count() == want.predictions.count()
        told = [[t.toDebugString.split("\n", 1)[1] for t in r.model.stages[-1].trees] for r in (got, want)]
        assert told[0] == told[1]
    catalog.q_two_model_score(spark, SF_SMALL)
    assert len(made) == 2


def test_training_rows_are_kept_on_disk(spark, lineitem, monkeypatch):
    """A fit's own copy of the rows has the memory for itself."""
    from pyspark import StorageLevel

    data, small = signal_view(lineitem), {"numTrees": 2, "maxDepth": 2}
    path = fresh_path(spark, "processed")
    train_plan.write_processed(data, "query_latency", METRICS_KEYS, path)
    made, kept = _spied(monkeypatch, type(data))
    train_plan.train(data, training.REGRESSION, "query_latency", METRICS_KEYS, params=small)
    train_plan.train_processed(train_plan.read_processed(spark, path), training.REGRESSION, params=small)
    assert len(made) == 2 and kept == [StorageLevel.DISK_ONLY] * 2
