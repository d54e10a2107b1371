"""Command-line entry points, one per job (``python -m orchard.plans.cli ...``).

Object-store credentials are taken from the submit configuration or the
environment of the cluster, never from arguments, and nothing sensitive is
printed (Q-12).
"""

from __future__ import annotations

import argparse
import json

from orchard.operators import training
from orchard.plans import ab_test, inference
from orchard.plans import train as train_plan
from orchard.session import build_session
from orchard.sources import sinks
from orchard.sources.readers import FRAUD_LABEL, METRICS_CSV_SCHEMA, METRICS_LABEL, read_csv, read_parquet
from orchard.sources.models import RegistryStore


def _load(spark, path: str, fmt: str, task: str = training.REGRESSION):
    if fmt == "parquet":
        return read_parquet(spark, path)
    # Labelled transactions have no fixed columns beyond the label.
    if fmt == "csv-infer" or task == training.CLASSIFICATION:
        return read_csv(spark, path, infer=True)
    return read_csv(spark, path, schema=METRICS_CSV_SCHEMA)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="orchard")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--input", required=True)
        sp.add_argument("--format", default="csv", choices=["csv", "csv-infer", "parquet", "processed"], help="processed (train only): a folder that preprocess --output wrote")
        sp.add_argument("--keys", default="", help="comma-separated key columns (default: the whole row)")
        sp.add_argument("--registry", required=True, help="registry root folder (shared storage)")
        sp.add_argument("--model-name", required=True)
        sp.add_argument("--test-size", type=float, default=0.2)
        sp.add_argument("--seed", type=int, default=42)

    pp = sub.add_parser("preprocess")
    pp.add_argument("--input", required=True)
    pp.add_argument("--format", default="csv", choices=["csv", "csv-infer", "parquet"])
    pp.add_argument("--keys", default="")
    pp.add_argument("--output", help="folder of the processed set: split=train, split=test and the feature stages")
    pp.add_argument("--output-train", help="with --output-test: the two sides as plain Parquet sets")
    pp.add_argument("--output-test")
    pp.add_argument("--log", default=None, help="folder for log lines")
    pp.add_argument("--test-size", type=float, default=0.2)
    pp.add_argument("--seed", type=int, default=42)

    tp = sub.add_parser("train")
    common(tp)
    tp.add_argument("--task", choices=[training.CLASSIFICATION, training.REGRESSION], required=True)
    tp.add_argument("--model-type", default="rf", choices=["rf", "lr"])
    tp.add_argument("--no-search", action="store_true", help="fit the base setting only")
    tp.add_argument("--parallelism", type=int, default=4)
    tp.add_argument("--auto-register", action="store_true")
    tp.add_argument("--log", default=None, help="folder for log lines")

    ap = sub.add_parser("ab-test")
    common(ap)
    ap.add_argument("--task", choices=[training.CLASSIFICATION, training.REGRESSION], required=True)
    ap.add_argument("--report", required=True)
    ap.add_argument("--log", default=None)
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--timestamp", default="", help="written into the report")
    ap.add_argument("--replicates", type=int, default=1000)

    ip = sub.add_parser("infer")
    common(ip)
    ip.add_argument("--output", required=True)
    ip.add_argument("--log", default=None, help="folder for log lines")
    ip.add_argument("--score-date", required=True, help="partition to write, e.g. 2024-01-31")
    ip.add_argument("--task", choices=[training.CLASSIFICATION, training.REGRESSION], default=training.REGRESSION)

    rp = sub.add_parser("retrain-report")
    rp.add_argument("--registry", required=True)
    rp.add_argument("--metric", default="rmse")

    a = p.parse_args(argv)
    spark = build_session(f"orchard-{a.cmd}")
    keys = [k for k in getattr(a, "keys", "").split(",") if k]

    if a.cmd == "preprocess":
        raw = _load(spark, a.input, a.format)
        if a.output:
            counts = train_plan.write_processed(raw, METRICS_LABEL, keys, a.output, a.test_size, a.seed)
            n_features = len(train_plan.read_processed(spark, a.output).features)
        elif a.output_train and a.output_test:
            tr, te, _, feats = train_plan.preprocess(raw, METRICS_LABEL, keys, a.test_size, a.seed)
            sinks.write_parquet(tr, a.output_train)
            sinks.write_parquet(te, a.output_test)
            counts, n_features = {}, len(feats)
        else:
            p.error("preprocess needs --output, or --output-train and --output-test")
        told = {"num_features": n_features, **counts}
        if a.log:
            rows = spark.createDataFrame([(i, k, str(v)) for i, (k, v) in enumerate(told.items())], "n int, key string, value string")
            sinks.write_text(sinks.format_lines(rows.orderBy("n"), ["key", "value"], sep=" | "), a.log)
        print(json.dumps(told))
        return 0

    if a.cmd == "retrain-report":
        inference.retraining_summary(RegistryStore(spark, a.registry), a.metric).show(truncate=False)
        return 0

    store = RegistryStore(spark, a.registry)
    source = None
    if a.format == "processed":
        if a.cmd != "train":
            p.error("only train reads a processed set; other jobs take raw rows")
        source = train_plan.read_processed(spark, a.input)
    data = None if source else _load(spark, a.input, a.format, getattr(a, "task", training.REGRESSION))
    label = FRAUD_LABEL if getattr(a, "task", None) == training.CLASSIFICATION else METRICS_LABEL

    if a.cmd == "train":
        grid = None
        if not a.no_search:
            forest = training.CLASSIFIER_GRID if a.task == training.CLASSIFICATION else training.REGRESSOR_GRID
            grid = training.LINEAR_GRID if a.model_type == "lr" else forest
        if source:
            res = train_plan.train_processed(source, a.task, grid=grid, parallelism=a.parallelism, seed=a.seed, model_type=a.model_type)
        else:
            res = train_plan.train(data, a.task, label, keys, grid=grid, parallelism=a.parallelism,
                                   test_size=a.test_size, seed=a.seed, model_type=a.model_type)
        event_id = store.next_event_id()
        train_plan.log_training_run(res, store, event_id, grid)
        if a.auto_register:
            metric, higher = ("auc", True) if a.task == training.CLASSIFICATION else ("rmse", False)
            train_plan.register_and_promote(res, store, a.model_name, metric, higher, event_id)
        if a.log:
            sinks.write_text(train_plan.log_lines(res, store), a.log)
        res.holdout_metrics.show(truncate=False)
        return 0

    if a.cmd == "ab-test":
        if a.task == training.CLASSIFICATION:
            ab_test.run_classification_ab(data, store, a.model_name, keys, label, a.report,
                                          a.log or a.report + "_log", a.test_size, a.seed, a.replicates,
                                          a.run_id, a.timestamp)
        else:
            ab_test.run_regression_ab(data, store, a.model_name, keys, label, a.report, a.test_size, a.seed,
                                      a.run_id, a.timestamp, a.log or a.report + "_log")
        return 0

    if a.cmd == "infer":
        inference.batch_score(data, store, a.model_name, keys, a.output, a.score_date, a.log)
        return 0
    return 2


if __name__ == "__main__":
    raise SystemExit(main())
