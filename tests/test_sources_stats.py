"""Processed sets as a source, commits by two writers, kept statistics, logs."""

import json
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.functions.features import derive_features
from orchard.operators import profile, scaling, split, training
from orchard.plans import cli, inference
from orchard.plans import train as train_plan
from orchard.session import fresh_path
from orchard.sources.commits import CommitLog
from orchard.sources.models import RegistryStore
from orchard.sources.views import METRICS_KEYS, signal_labels, signal_view

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")


# --- processed sets


def test_search_on_a_processed_set_equals_search_on_raw_rows(spark, lineitem):
    data = signal_view(lineitem)
    path = fresh_path(spark, "set")
    counts = train_plan.write_processed(data, "query_latency", METRICS_KEYS, path)
    assert counts["n_rows"] == data.count() == counts["train_rows"] + counts["test_rows"] and counts["dropped_rows"] == 0
    source = train_plan.read_processed(spark, path)
    assert (source.keys, source.label, source.train.count()) == (METRICS_KEYS, "query_latency", counts["train_rows"])
    grid = {"numTrees": [2, 4], "maxDepth": [3]}
    a = train_plan.train_processed(source, training.REGRESSION, grid=grid)
    b = train_plan.train(data, training.REGRESSION, "query_latency", METRICS_KEYS, grid=grid)
    assert a.best_params == b.best_params
    ra, rb = a.holdout_metrics.first(), b.holdout_metrics.first()
    assert ra["n_rows"] == rb["n_rows"] and ra["rmse"] == pytest.approx(rb["rmse"], rel=1e-9) and ra["r2"] == pytest.approx(rb["r2"], rel=1e-9)
    assert a.model.transform(data).count() == data.count()  # raw rows in


def test_processed_set_without_keys(spark):
    rows = spark.range(500).select((F.col("id") % 50).cast("double").alias("v"), (F.col("id") % 50 * 2.0).alias("query_latency"))
    path = fresh_path(spark, "set")
    train_plan.write_processed(rows, "query_latency", [], path)
    res = train_plan.train_processed(train_plan.read_processed(spark, path), training.REGRESSION, grid={"numTrees": [3], "maxDepth": [2, 4]})
    assert res.fold_metrics.count() == 6 and res.holdout_metrics.first()["rmse"] < 10


def test_command_line_trains_on_what_preprocess_wrote(spark, lineitem, capsys):
    root = fresh_path(spark, "cli")
    names = ["timestamp", "node_id", "query_latency", "cpu_utilization", "memory_utilization", "system_load"]
    signal_view(lineitem).select(*METRICS_KEYS, *names).write.parquet(root + "/raw")
    keys = ",".join(METRICS_KEYS)
    assert cli.main(["preprocess", "--input", root + "/raw", "--format", "parquet", "--keys", keys, "--output", root + "/set", "--log", root + "/plog"]) == 0
    told = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert told["train_rows"] + told["test_rows"] == told["n_rows"]
    common = ["--registry", root + "/reg", "--model-name", "m"]
    assert cli.main(["train", "--input", root + "/set", "--format", "processed", "--task", "regression", "--no-search", "--auto-register", "--log", root + "/tlog", *common]) == 0
    lines = [r["value"] for r in spark.read.text(root + "/tlog").collect()]
    assert any("| metric | rmse |" in x for x in lines) and any(x.endswith("| tag | decision | FIRST_MODEL") for x in lines)
    assert cli.main(["infer", "--input", root + "/raw", "--format", "parquet", "--keys", keys, "--output", root + "/pred", "--score-date", "2024-01-31", "--log", root + "/ilog", *common]) == 0
    said = dict(r["value"].split(" | ") for r in spark.read.text(root + "/ilog").collect())
    pred = spark.read.parquet(root + "/pred")
    assert int(said["n_rows"]) == pred.count() and said["version"] == "1" and said["null_predictions"] == "0"
    assert float(said["mean_prediction"]) == pytest.approx(pred.agg(F.avg("prediction")).first()[0])
    with pytest.raises(SystemExit):
        cli.main(["infer", "--input", root + "/set", "--format", "processed", "--output", root + "/x", "--score-date", "2024-01-31", *common])


def test_models_apply_after_metrics_were_observed(spark, lineitem):
    """A classifier's summary would hold the session, which cannot be shipped
    once it has observed metrics."""
    data = signal_labels(lineitem)
    train_plan.write_processed(data, "fraud", METRICS_KEYS, fresh_path(spark, "set"))
    for kind in ("rf", "lr"):
        res = train_plan.train(data, training.CLASSIFICATION, "fraud", METRICS_KEYS, model_type=kind, grid=training.LINEAR_GRID if kind == "lr" else None)
        assert res.holdout_metrics.first()["auc"] > 0.8


# --- registration


def test_two_writers_never_get_one_version(spark):
    root = fresh_path(spark, "commits")
    schema = "model string, version int, run_id string, path string, event_id bigint"
    got, start = [], threading.Barrier(4)

    def write(who):
        log = CommitLog(spark, root, schema)
        start.wait()
        for i in range(6):
            got.append(log.append("m", lambda n, i=i: {"model": "m", "version": n, "run_id": f"{who}-{i}", "path": "p", "event_id": i}))

    threads = [threading.Thread(target=write, args=(w,)) for w in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == list(range(1, 25))
    rows = CommitLog(spark, root, schema).table().collect()
    assert sorted(r["version"] for r in rows) == list(range(1, 25)) and len({r["run_id"] for r in rows}) == 24


def test_a_taken_number_is_refused_and_an_empty_commit_is_skipped(spark):
    log = CommitLog(spark, fresh_path(spark, "commits"), "model string, version int")
    assert log.numbers("m") == [] and log.table().count() == 0
    assert log.put_if_absent("m", 1, {"model": "m", "version": 1})
    assert not log.put_if_absent("m", 1, {"model": "other", "version": 1})
    fs, path = log._file(f"{log.root}/m/{2:010d}.json")
    fs.create(path, False).close()  # a writer died here
    assert log.append("m", lambda n: {"model": "m", "version": n}) == 3
    assert log.append("other", lambda n: {"model": "other", "version": n}) == 1
    assert sorted(tuple(r) for r in log.table().collect()) == [("m", 1), ("m", 3), ("other", 1)]


def test_a_model_without_a_metric_still_gets_its_alias(spark):
    """One class in the hold-out: no AUC, yet no version without an alias."""
    data = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("v"))
    _, held = split.hash_split(data, ["k"])
    one = data.join(held.select("k", F.lit(1).alias("held")), "k", "left").select("k", "v", F.when(F.col("held").isNull(), (F.col("v") > 8).cast("int")).otherwise(0).alias("fraud"))
    store = RegistryStore(spark, fresh_path(spark, "reg"))
    for want in ("FIRST_MODEL", "NO_BASELINE_METRIC"):
        res = train_plan.train(one, training.CLASSIFICATION, "fraud", ["k"], params={"numTrees": 2, "maxDepth": 2})
        assert res.holdout_metrics.first()["auc"] is None
        event = store.next_event_id()
        train_plan.log_training_run(res, store, event, None)
        version, decision = train_plan.register_and_promote(res, store, "m", "auc", True, event)
        assert decision == want and version in (1, 2)
    assert store.resolve("m", "champion")[0] == 1 and store.resolve("m", "challenger")[0] == 2
    empty = inference.retraining_summary(store, "auc").first()
    assert empty["status"] == "NO_DATA"


# --- kept statistics


def test_merged_moments_equal_a_full_scan(spark):
    rng = np.random.default_rng(3)
    x = 1e9 + rng.normal(size=3000)  # squares would cancel
    rows = [(i % 11 if i % 13 else None, float(v), None if i % 5 else float(i)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "day int, x double, y double").withColumn("c", F.lit(7.0))
    merged = scaling.merge_moments(scaling.moments(df, ["x", "y", "c"], ["day"]))
    got = {r["column_name"]: r for r in merged.collect()}
    assert got["x"]["n"] == 3000 and got["y"]["n"] == 600
    assert got["x"]["mean"] == pytest.approx(x.mean(), rel=1e-14)
    assert np.sqrt(got["x"]["m2"] / 2999) == pytest.approx(x.std(ddof=1), rel=1e-6)
    one, two = scaling.scaler_from_moments(merged, ["x", "y", "c"]), scaling.fit_scaler(df, ["x", "y", "c"])
    assert one.means == pytest.approx(two.means, rel=1e-12) and one.stds == pytest.approx(two.stds, rel=1e-6) and one.stds[2] == 0.0
    none = scaling.merge_moments(scaling.moments(df.limit(0), ["x"], ["day"]))
    assert scaling.scaler_from_moments(none, ["x"]).means == (None,)


def test_moments_of_a_replaced_slice(spark, lineitem):
    rows = derive_features(signal_view(lineitem)).withColumn("load", F.pmod("l_orderkey", F.lit(3)).cast("int"))
    path = fresh_path(spark, "moments")
    scaling.write_moments(rows.where("load < 2"), ["system_load"], ["load"], path)
    scaling.write_moments(rows.where("load = 1").limit(5), ["system_load"], ["load"], path)
    scaling.write_moments(rows.where("load >= 1"), ["system_load"], ["load"], path)
    merged = scaling.merge_moments(spark.read.parquet(path)).first()
    want = rows.agg(F.count("system_load"), F.avg("system_load"), F.var_samp("system_load")).first()
    assert (merged["n"], merged["mean"], merged["m2"] / (merged["n"] - 1)) == pytest.approx(tuple(want), rel=1e-12)


def test_sketches_keep_their_bounds_over_slices(spark):
    df = spark.range(40_000).select((F.col("id") % 7).alias("slice"), (F.col("id") * 7919 % 30_011).alias("n"), F.sqrt("id").alias("x"), F.concat(F.lit("k"), F.col("id") % 5000).alias("s"), F.lit(None).cast("double").alias("none"))
    got = {r["column_name"]: r for r in profile.sketch_profile(profile.merge_sketches(profile.column_sketches(df, ["slice"]))).collect()}
    assert set(got) == {"n", "x", "s", "none"} and all(r["n_rows"] == 40_000 for r in got.values())
    for name, want in (("n", 30_011), ("x", 40_000), ("s", 5000)):
        assert abs(got[name]["n_distinct"] - want) <= profile.DISTINCT_ERROR * want
    assert got["none"]["null_count"] == 40_000 and got["none"]["n_distinct"] == 0 and got["none"]["q50"] is None and got["s"]["q50"] is None
    for q in (25, 50, 75):
        assert abs((got["x"][f"q{q}"] ** 2) / 40_000 - q / 100) <= profile.RANK_ERROR
    assert (got["n"]["min_value"], got["x"]["max_value"]) == (0.0, pytest.approx(39_999 ** 0.5))


def test_gain_interval_is_exact(spark):
    from orchard.operators import abtest

    rng = np.random.default_rng(5)
    a, b = rng.normal(0.5, 0.02, 1000), rng.normal(0.51, 0.02, 1000)
    reps = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "f1_champion double, f1_challenger double")
    r = abtest.replicate_summary(reps).first()
    assert r["share_without_gain"] == pytest.approx(float((b <= a).mean()))
    assert (r["gain_low"], r["gain_high"]) == pytest.approx(tuple(np.quantile(b - a, [0.025, 0.975])), rel=1e-12)
