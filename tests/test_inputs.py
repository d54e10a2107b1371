"""Jobs on inputs as users have them: no keys, any columns, nulls, bad paths."""

import json

import pytest
from pyspark.sql import functions as F

from orchard.functions.hashing import STREAM_PRIME, key_string, poisson_cdf_thresholds
from orchard.operators import metrics, profile, registry, split, training
from orchard.plans import ab_test, cli, inference
from orchard.plans import train as train_plan
from orchard.session import fresh_path
from orchard.sources.models import RegistryStore
from orchard.sources.readers import METRICS_CSV_SCHEMA, read_csv


@pytest.fixture(scope="module")
def raw(spark):
    """99 rows in the raw CSV's columns, without any key."""
    cols = [((F.col("id") * (i + 3) % 37) + F.col("id") * 0.25 + i).cast(f.dataType).alias(f.name) for i, f in enumerate(METRICS_CSV_SCHEMA.fields)]
    return spark.range(99).select(*cols)


@pytest.fixture(scope="module")
def csv(spark, raw):
    path = fresh_path(spark, "raw-csv")
    raw.write.option("header", "true").csv(path)
    return path


def run(*args):
    assert cli.main([str(a) for a in args]) == 0


def test_command_line_without_keys(spark, csv, capsys):
    root = fresh_path(spark, "cli")
    run("preprocess", "--input", csv, "--output-train", root + "/train", "--output-test", root + "/test")
    n_train, n_test = (spark.read.parquet(f"{root}/{s}").count() for s in ("train", "test"))
    assert n_train + n_test == 99 and 5 < n_test < 45
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["num_features"] == 15
    common = ("--input", csv, "--registry", root + "/reg", "--model-name", "m")
    run("train", *common, "--task", "regression", "--no-search", "--auto-register")
    run("train", *common, "--task", "regression", "--model-type", "lr", "--auto-register")
    run("ab-test", *common, "--task", "regression", "--report", root + "/report")
    assert spark.read.json(root + "/report").count() == 1
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        run("infer", *common, "--output", root + "/pred", "--score-date", day)
    pred = spark.read.parquet(root + "/pred")
    assert {str(r["score_date"]): r["count"] for r in pred.groupBy("score_date").count().collect()} == {"2024-01-01": 99, "2024-01-02": 99}
    assert {f.name for f in METRICS_CSV_SCHEMA.fields} <= set(pred.columns)
    run("retrain-report", "--registry", root + "/reg")


def test_any_numeric_columns(spark):
    data = spark.range(400).select((F.col("id") * 7 % 100).cast("double").alias("amount"), (F.col("id") % 13).alias("v1"), F.lit("x").alias("note"), (F.col("id") * 7 % 100 > 60).cast("int").alias("fraud"))
    res = train_plan.train(data, training.CLASSIFICATION, "fraud", [], params={"numTrees": 3, "maxDepth": 3})
    assert res.features == ["amount", "v1"] and res.holdout_metrics.first()["auc"] > 0.9
    lr = train_plan.train(data, training.CLASSIFICATION, "fraud", [], grid=training.LINEAR_GRID, model_type="lr")
    assert lr.grid_metrics.count() == 3


def test_split_of_keyless_rows_and_null_keys(spark, raw):
    with pytest.raises(ValueError):
        key_string([])
    pairs = spark.createDataFrame([(1, None), (None, 1)], "a int, b int").select(key_string(["a", "b"]).alias("k"))
    assert pairs.distinct().count() == 2
    train, test = split.hash_split(raw, raw.columns)
    assert train.count() + test.count() == 99 and test.count() > 5


def test_csv_with_swapped_columns_is_refused(spark, raw):
    path = fresh_path(spark, "swapped")
    names = raw.columns
    raw.select(names[1], names[0], *names[2:]).write.option("header", "true").csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, schema=METRICS_CSV_SCHEMA).collect()


def test_registry_errors_are_not_an_empty_registry(spark, raw, monkeypatch):
    broken = RegistryStore(spark, "nofs://nowhere/registry")
    with pytest.raises(Exception):  # noqa: B017 - whatever the file system raises
        broken.versions().count()
    store = RegistryStore(spark, fresh_path(spark, "reg"))
    assert store.versions().count() == 0
    res = train_plan.train(raw, training.REGRESSION, "query_latency", [], params={"numTrees": 2, "maxDepth": 2})
    taken = store.model_path("m", "r")
    res.model.save(taken)
    monkeypatch.setattr(store, "model_path", lambda model, run_id: taken)
    with pytest.raises(Exception, match="(?i)exist"):
        store.register_model(res.model, "m", "r", 1)
    assert store.versions().count() == 0  # no version without its model
    with pytest.raises(ValueError):
        inference.batch_score(raw, store, "m", [], fresh_path(spark, "out"), score_date="2024-01-01")


def test_null_segments_and_labels(spark):
    rows = [(s, float(y), float(y) * 0.6 + 0.1 * i / 50, float(y)) for s in ("a", None) for i in range(50) for y in (0, 1)]
    rows += [("a", None, 0.9, 1.0), (None, None, 0.1, 0.0)]
    df = spark.createDataFrame(rows, "seg string, label double, score double, prediction double")
    roc = {r["seg"]: r for r in metrics.auc(df, segments=["seg"]).collect()}
    assert {k: (r["auc"], r["n_pos"], r["n_neg"]) for k, r in roc.items()} == {"a": (1.0, 50, 50), None: (1.0, 50, 50)}
    cls = {r["seg"]: r for r in metrics.classification_metrics(df, segments=["seg"]).collect()}
    assert {k: (r["n_rows"], r["accuracy"]) for k, r in cls.items()} == {"a": (100, 1.0), None: (100, 1.0)}
    reg = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (None, 5.0), (4.0, None)], "label double, prediction double")
    got = metrics.regression_metrics(reg).first()
    assert (got["n_rows"], got["rmse"], got["mae"]) == (2, 1.0, 1.0)


def test_preprocess_leaves_out_incomplete_rows(spark, raw):
    holed = raw.withColumn("disk_io", F.when(F.col("node_id") % 5 != 0, F.col("disk_io")))
    tr, te, _, feats = train_plan.preprocess(holed, "query_latency", [])
    from pyspark.ml.functions import vector_to_array

    rows = tr.unionByName(te).select(F.explode(vector_to_array("features")).alias("x"))
    assert tr.count() + te.count() == holed.where("disk_io is not null").count()
    assert rows.where("isnan(x) or x is null").count() == 0 and rows.count() > 0


def test_holdout_with_nulls_is_scored_without_them(spark):
    data = spark.range(300).select(F.when(F.col("id") % 10 != 0, (F.col("id") * 7 % 100).cast("double")).alias("amount"), F.col("id").alias("k"), (F.col("id") % 2).alias("fraud"))
    res = train_plan.train(data, training.CLASSIFICATION, "fraud", ["k"], params={"numTrees": 2, "maxDepth": 2})
    n = res.holdout_metrics.first()["n_rows"]
    _, te = split.hash_split(data, ["k"])
    assert n == te.where("amount is not null").count() and res.extra["dropped_test_rows"] == te.count() - n > 0


def test_profile_counts_large_integers_exactly(spark):
    big = spark.range(2**53, 2**53 + 100)
    assert profile.column_profile(big).first()["n_distinct"] == 100


def test_poisson_weights_are_never_clipped():
    cuts = poisson_cdf_thresholds()
    assert cuts[-1] == STREAM_PRIME and cuts == sorted(cuts) and len(cuts) > 10


def test_retraining_report_after_promotion(spark):
    runs = spark.createDataFrame([(f"r{i}", "metric", "rmse", str(m), m, i) for i, m in ((1, 5.0), (2, 4.0))], "run_id string, kind string, key string, value string, num_value double, event_id long")
    versions = spark.createDataFrame([("m", 1, "r1", "p", 1), ("m", 2, "r2", "p", 2)], "model string, version int, run_id string, path string, event_id long")
    aliases = spark.createDataFrame([(1, "m", "champion", 1), (2, "m", "champion", 2)], "event_id long, model string, alias string, version int")
    row = registry.retraining_report(versions, runs, aliases).first()
    assert (row["status"], row["champion_version"], row["new_rmse"], row["champion_rmse"]) == ("IMPROVED", 1, 4.0, 5.0)


def test_a_model_is_not_compared_with_itself(spark, raw):
    store = RegistryStore(spark, fresh_path(spark, "same"))
    res = train_plan.train(raw, training.REGRESSION, "query_latency", [], params={"numTrees": 2, "maxDepth": 2})
    version = store.register_model(res.model, "m", "r", 1)
    store.set_alias("m", "champion", version, 1)
    store.set_alias("m", "challenger", version, 2)
    report = ab_test.run_regression_ab(raw, store, "m", [], "query_latency", fresh_path(spark, "report"))
    assert report.first()["decision"] == "SKIPPED"
    runs = store.runs().collect()
    assert ("tag", "decision", "SKIPPED") in {(r["kind"], r["key"], r["value"]) for r in runs}
    assert any(r["kind"] == "metric" and r["key"] == "champion_rmse" and r["num_value"] > 0 for r in runs)


def test_skipped_classification_report_has_all_columns(spark):
    data = spark.range(200).select((F.col("id") * 7 % 100).cast("double").alias("amount"), (F.col("id") % 2).alias("fraud"))
    store = RegistryStore(spark, fresh_path(spark, "skip"))
    root = fresh_path(spark, "skip-out")
    report = ab_test.run_classification_ab(data, store, "m", [], "fraud", root + "/report", root + "/log", run_id="run-1", timestamp="2024-01-31T00:00:00")
    row = report.first()
    assert (row["decision"], row["run_id"], row["timestamp"], row["champion_auc"]) == ("SKIPPED", "run-1", "2024-01-31T00:00:00", None)
    assert {"p_value", "test_set_size", "challenger_model"} <= set(report.columns)
    assert {(r["kind"], r["key"]) for r in store.runs().collect()} == {("tag", "decision")}


def test_checkpoint_folder_is_needed_on_a_cluster(spark, monkeypatch):
    from orchard import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
