"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, reads the driver's tables under
``sf_dir`` and returns a DataFrame.  Doubles are rounded to ``DIGITS`` places
at the very end so results compare equal with the SQL twins in
``orchard.oracle`` regardless of summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.functions.features import (
    CALENDAR_FEATURES,
    INTERACTION_FEATURE,
    RATIO_FEATURE,
    add_calendar,
    all_but,
    derive_features,
    guarded_ratio,
    interaction,
    numeric_columns,
)
from orchard.operators import abtest, baselines, bootstrap, forest, linear, metrics, profile, registry, scaling, scoring, split, training
from orchard.plans import inference
from orchard.streaming import scoring as stream_scoring
from orchard.plans import train as train_plan
from orchard.operators.scaling import fit_scaler
from orchard.session import fresh_path
from orchard.sources import sinks, views
from orchard.sources.models import RegistryStore
from orchard.sources.readers import read_csv, read_table
from orchard.sources.views import METRICS_KEYS, label_view, metrics_view, signal_labels, signal_view

DIGITS = 6
SEED = 42
TEST_SIZE = 0.2
NUM_FOLDS = 3

# Feature columns after derivation (everything but keys and label).
FEATURES = [
    "node_id",
    "cpu_utilization",
    "memory_utilization",
    "system_load",
    *CALENDAR_FEATURES,
    INTERACTION_FEATURE,
    RATIO_FEATURE,
]


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double/float column (comparison hygiene only)."""
    exprs = {
        f.name: F.round(F.col(f"`{f.name}`"), digits)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(exprs) if exprs else df


# --------------------------------------------------------------------------
# shared inputs
# --------------------------------------------------------------------------


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_view(read_table(spark, sf_dir, "lineitem"))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_view(read_table(spark, sf_dir, "lineitem"))


def _signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal_view(read_table(spark, sf_dir, "lineitem"))


def _signal_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal_labels(read_table(spark, sf_dir, "lineitem"))


def _split_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.with_split(derive_features(_metrics(spark, sf_dir)), METRICS_KEYS, TEST_SIZE, SEED)


def _scored_classifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out rows scored by both fixed classifiers, in long form."""
    _, test = split.hash_split(_labels(spark, sf_dir), METRICS_KEYS, TEST_SIZE, SEED)
    wide = baselines.score_two_classifiers(test)
    models = F.array(
        F.struct(F.lit("champion").alias("model"), F.col("score_champion").alias("score"),
                 F.col("pred_champion").alias("prediction")),
        F.struct(F.lit("challenger").alias("model"), F.col("score_challenger").alias("score"),
                 F.col("pred_challenger").alias("prediction")),
    )
    return wide.select("node_id", F.col("fraud").cast("double").alias("label"),
                       F.explode(models).alias("m")).select("node_id", "label", "m.*")


def _scored_regressors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out rows scored by the per-node mean (champion) and the per-node
    line on memory utilisation (challenger), in long form.  One aggregation
    fits both and one lookup join attaches them."""
    tagged = _split_metrics(spark, sf_dir)
    train = tagged.where(F.col("split") == split.TRAIN)
    test = tagged.where(F.col("split") == split.TEST)
    fit = baselines.fit_group_line(train, "query_latency", "memory_utilization", ["node_id"])
    both = baselines.score_mean_and_line(test, fit, "memory_utilization", ["node_id"])
    models = F.array(
        F.struct(F.lit("champion").alias("model"), F.col("pred_champion").alias("prediction")),
        F.struct(F.lit("challenger").alias("model"), F.col("pred_challenger").alias("prediction")),
    )
    return both.select("node_id", F.col("query_latency").alias("label"), F.explode(models).alias("m")).select(
        "m.model", "node_id", "label", "m.prediction"
    )


# --------------------------------------------------------------------------
# S / K / F / P / T / M-4
# --------------------------------------------------------------------------


def q_csv_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1 + K-4 style sink: write the metrics view as CSV, scan it back with
    an explicit schema (no inference pass)."""
    view = _metrics(spark, sf_dir)
    path = fresh_path(spark, "csv_roundtrip")
    view.write.mode("overwrite").option("header", "true").csv(path)
    back = read_csv(spark, path, schema=view.schema)
    return rounded(back)


def q_row_count(spark, sf_dir):
    return profile.row_count(_metrics(spark, sf_dir))


def q_null_profile(spark, sf_dir):
    return profile.null_profile(_labels(spark, sf_dir))


def q_column_profile(spark, sf_dir):
    return rounded(profile.column_profile(derive_features(_labels(spark, sf_dir))))


def q_null_rows(spark, sf_dir):
    """F-3: rows whose label or any raw feature is null (IsNull filters reach
    the Parquet scan)."""
    cols = ["query_latency", "cpu_utilization", "memory_utilization", "system_load", "timestamp", "fraud"]
    return rounded(profile.null_rows(_labels(spark, sf_dir), cols))


def q_preview(spark, sf_dir):
    return rounded(profile.preview(_labels(spark, sf_dir), METRICS_KEYS, 5))


def q_select_numeric_columns(spark, sf_dir):
    """P-2: choose features by type from a frame that also carries strings
    (return flag, line status) and a timestamp; keys and label excluded."""
    li = read_table(spark, sf_dir, "lineitem")
    base = label_view(li, extra=["l_returnflag", "l_linestatus"])
    chosen = numeric_columns(base, exclude=["fraud", *METRICS_KEYS])
    return rounded(base.select(*METRICS_KEYS, *chosen))


def q_calendar_features(spark, sf_dir):
    out = add_calendar(_metrics(spark, sf_dir))
    return out.select(*METRICS_KEYS, *CALENDAR_FEATURES)


def q_interaction_feature(spark, sf_dir):
    return rounded(_metrics(spark, sf_dir).select(*METRICS_KEYS, interaction().alias(INTERACTION_FEATURE)))


def q_guarded_ratio(spark, sf_dir):
    return rounded(_metrics(spark, sf_dir).select(*METRICS_KEYS, guarded_ratio().alias(RATIO_FEATURE)))


def q_full_features(spark, sf_dir):
    return rounded(derive_features(_metrics(spark, sf_dir)))


def q_hash_split(spark, sf_dir):
    return split.with_split(_metrics(spark, sf_dir), METRICS_KEYS, TEST_SIZE, SEED).select(*METRICS_KEYS, "split")


def q_split_sizes(spark, sf_dir):
    return split.split_sizes(split.with_split(_metrics(spark, sf_dir), METRICS_KEYS, TEST_SIZE, SEED))


def q_kfold_sizes(spark, sf_dir):
    train, _ = split.hash_split(_metrics(spark, sf_dir), METRICS_KEYS, TEST_SIZE, SEED)
    return split.fold_sizes(split.with_folds(train, METRICS_KEYS, NUM_FOLDS, SEED))


def q_standardize(spark, sf_dir):
    tagged = _split_metrics(spark, sf_dir)
    scaler = fit_scaler(tagged.where(F.col("split") == split.TRAIN), FEATURES)
    return rounded(scaler.transform(tagged).select(*METRICS_KEYS, "split", *FEATURES))


# --------------------------------------------------------------------------
# A-1 ... A-8
# --------------------------------------------------------------------------

CLS_SEGMENTS = ["model", "node_id"]


def q_confusion_counts(spark, sf_dir):
    return metrics.confusion_counts(_scored_classifiers(spark, sf_dir), segments=CLS_SEGMENTS)


def q_auc(spark, sf_dir):
    return rounded(metrics.auc(_scored_classifiers(spark, sf_dir), segments=CLS_SEGMENTS))


def _cls_metric(spark, sf_dir, name):
    m = metrics.classification_metrics(_scored_classifiers(spark, sf_dir), segments=CLS_SEGMENTS)
    return rounded(m.select(*CLS_SEGMENTS, "n_rows", name))


def q_accuracy(spark, sf_dir):
    return _cls_metric(spark, sf_dir, "accuracy")


def q_f1_weighted(spark, sf_dir):
    return _cls_metric(spark, sf_dir, "f1_weighted")


def q_f1_positive(spark, sf_dir):
    return _cls_metric(spark, sf_dir, "f1_positive")


def q_regression_metrics(spark, sf_dir):
    return rounded(metrics.regression_metrics(_scored_regressors(spark, sf_dir), segments=["model", "node_id"]))


# --------------------------------------------------------------------------
# B-1 ... B-9: A/B comparison (fixed classifiers, per node)
# --------------------------------------------------------------------------

REPLICATES = 1000
AB_SEGMENTS = ["node_id"]
CHAMPION_URI = "models:/fixed_scores@champion"
CHALLENGER_URI = "models:/fixed_scores@challenger"


def _scored_wide(spark, sf_dir):
    _, test = split.hash_split(_labels(spark, sf_dir), METRICS_KEYS, TEST_SIZE, SEED)
    return baselines.score_two_classifiers(test).withColumn("label", F.col("fraud").cast("double"))


def _poisson_reps(spark, sf_dir):
    return bootstrap.poisson_bootstrap(
        _scored_wide(spark, sf_dir), METRICS_KEYS, "label", "pred_champion", "pred_challenger",
        AB_SEGMENTS, REPLICATES, SEED,
    )


def q_poisson_bootstrap(spark, sf_dir):
    return rounded(_poisson_reps(spark, sf_dir))


def _tested(spark, sf_dir, with_p=True):
    summary = abtest.replicate_summary(_poisson_reps(spark, sf_dir), AB_SEGMENTS)
    return abtest.with_effect_size(abtest.welch_test(summary, with_p=with_p))


def q_welch_stats(spark, sf_dir):
    t = _tested(spark, sf_dir)
    return rounded(t.select(
        *AB_SEGMENTS, "n_replicates", "mean_champion", "mean_challenger", "var_champion", "var_challenger",
        "t_stat", "dof", "p_value",
    ))


def q_effect_size(spark, sf_dir):
    t = _tested(spark, sf_dir, with_p=False)
    return rounded(t.select(
        *AB_SEGMENTS, "mean_champion", "mean_challenger", "sd_champion", "sd_challenger",
        "f1_improvement", "effect_size",
    ))


def _ab_report(spark, sf_dir):
    scored = _scored_classifiers(spark, sf_dir)
    cls = metrics.classification_metrics(scored, segments=CLS_SEGMENTS)
    roc = metrics.auc(scored, segments=CLS_SEGMENTS)
    tested = abtest.with_decision(_tested(spark, sf_dir))
    return abtest.ab_report(cls, roc, tested, AB_SEGMENTS, champion_uri=CHAMPION_URI, challenger_uri=CHALLENGER_URI)


def q_ab_report(spark, sf_dir):
    return rounded(_ab_report(spark, sf_dir))


def q_ab_report_json(spark, sf_dir):
    """K-3: the report through the JSON sink and back (explicit schema)."""
    report = rounded(_ab_report(spark, sf_dir))
    path = sinks.write_json(report, fresh_path(spark, "ab_report"))
    return spark.read.schema(report.schema).json(path)


def _decide_regression(spark, sf_dir):
    m = metrics.regression_metrics(_scored_regressors(spark, sf_dir), segments=["model", "node_id"])
    return abtest.decide_regression(m, ["node_id"])


def q_decide_regression(spark, sf_dir):
    return rounded(_decide_regression(spark, sf_dir))


def q_bootstrap_f1(spark, sf_dir):
    """B-1: multinomial cell bootstrap; per node the replicates, those whose F1
    follows from their cells, and whether their mean lies near the point F1."""
    wide = _scored_wide(spark, sf_dir)
    reps = bootstrap.multinomial_bootstrap(wide, "label", "pred_champion", "pred_challenger", AB_SEGMENTS, REPLICATES, SEED)
    den = 2 * F.col("tp_champion") + F.col("fp_champion") + F.col("fn_champion")
    fits = F.abs(F.col("f1_champion") - F.when(den > 0, 2.0 * F.col("tp_champion") / den).otherwise(0.0)) < 1e-9
    drawn = reps.groupBy(*AB_SEGMENTS).agg(F.count(F.lit(1)).alias("n_replicates"), F.count_if(fits).alias("n_consistent"), F.avg("f1_champion").alias("m"), F.stddev("f1_champion").alias("sd"))
    point = metrics.classification_metrics(wide, prediction="pred_champion", segments=AB_SEGMENTS).select(*AB_SEGMENTS, "f1_positive")
    near = F.abs(F.col("m") - F.col("f1_positive")) <= 4 * F.col("sd") + 1e-9
    return drawn.join(point, AB_SEGMENTS).select(*AB_SEGMENTS, "n_replicates", "n_consistent", near.alias("mean_is_near"))


def q_log_metrics(spark, sf_dir):
    """R-1 / R-2 / R-3: the regression A/B result logged as run rows."""
    d = _decide_regression(spark, sf_dir)
    rows = registry.run_rows(
        d,
        run_id=F.concat(F.lit("ab_node_"), F.col("node_id").cast("string")),
        event_id=F.col("node_id").cast("bigint"),
        metrics=["champion_rmse", "challenger_rmse", "champion_mae", "challenger_mae",
                 "champion_r2", "challenger_r2", "rmse_improvement_pct"],
        tags=["decision"],
    )
    return rounded(rows)


def q_log_lines(spark, sf_dir):
    """K-4: run rows formatted as text lines, through the text sink and back."""
    runs = q_log_metrics(spark, sf_dir)
    lines = sinks.format_lines(runs, ["run_id", "kind", "key", "value"])
    path = sinks.write_text(lines, fresh_path(spark, "log_lines"))
    return spark.read.text(path).withColumnRenamed("value", "line")


# --------------------------------------------------------------------------
# R-4 ... R-11: registry on tables derived from events
# --------------------------------------------------------------------------


def _registry(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    versions = views.registry_versions(events)
    return versions, views.registry_runs(events), views.registry_alias_events(versions)


def q_resolve_alias(spark, sf_dir):
    _, _, aliases = _registry(spark, sf_dir)
    return registry.resolve_aliases(aliases)


def q_champion_metrics(spark, sf_dir):
    versions, runs, aliases = _registry(spark, sf_dir)
    return rounded(registry.champion_metrics(aliases, versions, runs, ["auc", "rmse"]))


def q_next_version(spark, sf_dir):
    versions, _, _ = _registry(spark, sf_dir)
    return registry.next_versions(versions)


def q_promotion_auc(spark, sf_dir):
    versions, runs, _ = _registry(spark, sf_dir)
    return rounded(registry.promotion_history(versions, runs, "auc", higher_is_better=True))


def q_promotion_rmse(spark, sf_dir):
    versions, runs, _ = _registry(spark, sf_dir)
    return rounded(registry.promotion_history(versions, runs, "rmse", higher_is_better=False))


def q_relative_improvement(spark, sf_dir):
    """R-7 + R-9 for the newest version of every model against its champion."""
    versions, runs, aliases = _registry(spark, sf_dir)
    newest = versions.groupBy("model").agg(
        F.max_by("version", "event_id").alias("version"),
        F.max_by("run_id", "event_id").alias("run_id"),
    )
    cand = newest.join(registry.run_metrics_wide(runs, ["auc"]), "run_id", "left").select("model", "version", "auc")
    champs = registry.champion_metrics(aliases, versions, runs, ["auc"])
    return rounded(registry.promote_new(cand, champs, "auc", higher_is_better=True))


def q_alias_swap(spark, sf_dir):
    """R-10: challenger beats champion on auc -> append a champion event."""
    versions, runs, aliases = _registry(spark, sf_dir)
    current = registry.resolve_aliases(aliases)
    wide = registry.run_metrics_wide(runs, ["auc"])
    with_metric = current.join(
        versions.select("model", "version", "run_id"), ["model", "version"], "left"
    ).join(wide, "run_id", "left")
    decisions = with_metric.groupBy("model").agg(
        F.max(F.when(F.col("alias") == registry.CHAMPION, F.col("auc"))).alias("_champ"),
        F.max(F.when(F.col("alias") == registry.CHALLENGER, F.col("auc"))).alias("_chall"),
    ).select("model", F.when(F.col("_chall") > F.col("_champ"), F.lit("PROMOTE"))
             .otherwise(F.lit("KEEP_CHAMPION")).alias("decision"))
    batch_id = (aliases.agg(F.max("event_id")).first()[0] or 0) + 1
    new_events = registry.alias_swap_events(current, decisions, batch_id)
    return registry.resolve_aliases(aliases.unionByName(new_events))


def q_retraining_report(spark, sf_dir):
    versions, runs, aliases = _registry(spark, sf_dir)
    return rounded(registry.retraining_report(versions, runs, aliases, "rmse"))


# --------------------------------------------------------------------------
# M / L / C / K-1 / K-2 / K-5 / K-6 / S-4: model fitting and scoring
# --------------------------------------------------------------------------


def q_processed_sets(spark, sf_dir):
    """K-1 + M-1 + M-4: preprocess (assembler + ML scaler fit on the training
    side), write both sets in one pass, read back and expand the vectors."""
    path = fresh_path(spark, "processed")
    train_plan.write_processed(_metrics(spark, sf_dir), "query_latency", METRICS_KEYS, path, TEST_SIZE, SEED)
    feats = train_plan.read_processed(spark, path).features
    return rounded(train_plan.expand_features(spark.read.parquet(path), feats).select(*METRICS_KEYS, "split", *feats))


def q_processed_counts(spark, sf_dir):
    """F-1 + T-3 + F-3 observed while the processed set is written: all rows,
    rows left out for a null, both sides."""
    data = _holed(spark, sf_dir).select(*METRICS_KEYS, "memory_utilization", "label")
    counts = train_plan.write_processed(data, "label", METRICS_KEYS, fresh_path(spark, "processed"), TEST_SIZE, SEED)
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items()], "name string, n bigint")


def q_train_from_processed(spark, sf_dir):
    """S-2 + K-1: a forest trained on the stored set against one trained on the
    raw rows: the hold-out predictions are the same."""
    data = _signal(spark, sf_dir)
    path = fresh_path(spark, "processed")
    train_plan.write_processed(data, "query_latency", METRICS_KEYS, path, TEST_SIZE, SEED)
    small = {"numTrees": 10, "maxDepth": 5}
    stored = train_plan.train_processed(train_plan.read_processed(spark, path), training.REGRESSION, seed=SEED, params=small)
    raw = train_plan.train(data, training.REGRESSION, "query_latency", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED, params=small)
    gap = abs(stored.holdout_metrics.first()["rmse"] - raw.holdout_metrics.first()["rmse"])
    test = split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)[1]
    both = scoring.score_two(raw.model, stored.model, test, keep=[*METRICS_KEYS, "query_latency"])
    same = F.abs(F.col("pred_champion") - F.col("pred_challenger")) < 1e-6
    return rounded(both.select(*METRICS_KEYS, "query_latency", same.alias("same_prediction"), F.lit(gap < 1e-6).alias("same_rmse")))


def q_log_params(spark, sf_dir):
    """R-1: what a training run writes as params: its settings and counts."""
    data = _signal_labels(spark, sf_dir)
    store = RegistryStore(spark, fresh_path(spark, "registry"))
    res = train_plan.train(data, training.CLASSIFICATION, "fraud", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED, run_id="run-1")
    train_plan.log_training_run(res, store, store.next_event_id(), training.CLASSIFIER_GRID)
    return store.runs().where(F.col("kind") == "param").select("run_id", "key", "value", "event_id")


def q_train_log_lines(spark, sf_dir):
    """K-4: a training run's log lines through the text sink and back: every
    param, every hold-out metric by name, the decision."""
    data = _signal_labels(spark, sf_dir)
    store = RegistryStore(spark, fresh_path(spark, "registry"))
    res = train_plan.train(data, training.CLASSIFICATION, "fraud", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED, run_id="run-1")
    event = store.next_event_id()
    train_plan.log_training_run(res, store, event, None)
    train_plan.register_and_promote(res, store, "fraud_model", "auc", True, event)
    path = sinks.write_text(train_plan.log_lines(res, store), fresh_path(spark, "train-log"))
    lines = spark.read.text(path).select(F.split("value", r" \| ").alias("p"))
    # Metric values belong to the fit; their rows are told by name.
    return lines.select(F.col("p")[1].alias("kind"), F.col("p")[2].alias("key"), F.when(F.col("p")[1] != "metric", F.col("p")[3]).alias("value"))


def q_select_all_but_label(spark, sf_dir):
    """P-3: every column except keys and label."""
    rows = _labels(spark, sf_dir)
    return rounded(rows.select(*all_but(rows, ["fraud", *METRICS_KEYS])))


def q_auc_many_scores(spark, sf_dir):
    """A-1 with nearly as many distinct scores as rows."""
    rows = _labels(spark, sf_dir).select("node_id", F.col("fraud").alias("label"), (F.col("query_latency") * F.lit(0.001) + F.col("memory_utilization")).alias("score"))
    return rounded(metrics.auc(rows, segments=["node_id"]))


def q_incremental_scaler(spark, sf_dir):
    """M-4 incremental: moments per load are written for two loads, the second
    is replaced, the table is merged: mean and standard deviation of all rows."""
    rows = derive_features(_metrics(spark, sf_dir)).withColumn("load", (F.col("l_orderkey") % 7).cast("int"))
    path = fresh_path(spark, "moments")
    scaling.write_moments(rows.where("load < 4"), FEATURES, ["load"], path)
    scaling.write_moments(rows.where("load = 4 and node_id > 2"), FEATURES, ["load"], path)
    scaling.write_moments(rows.where("load >= 4"), FEATURES, ["load"], path)
    merged = scaling.merge_moments(spark.read.parquet(path))
    return rounded(merged.select("column_name", "n", "mean", F.sqrt(F.col("m2") / (F.col("n") - 1)).alias("sd")))


def q_sketch_profile(spark, sf_dir):
    """F-4 by sketches per slice, merged: exact counts and extremes beside
    whether the estimates keep their bounds against exact answers."""
    rows = derive_features(_labels(spark, sf_dir)).withColumn("slice", F.pmod("l_orderkey", F.lit(5)))
    path = fresh_path(spark, "sketches")
    profile.column_sketches(rows, ["slice"]).write.parquet(path)
    told = profile.sketch_profile(profile.merge_sketches(spark.read.parquet(path)))
    names = [c for c in rows.columns if c != "slice"]
    exact = profile.column_profile(rows.select(*names)).select("column_name", F.col("n_distinct").alias("exact"))
    median = told.select("column_name", "q50")
    cells = rows.select(*[F.struct(F.col(c).cast("double").alias("v")).alias(c) for c in names]).unpivot([], names, "column_name", "e")
    ranks = cells.join(median, "column_name").groupBy("column_name").agg(
        F.avg((F.col("e.v") < F.col("q50")).cast("double")).alias("below"), F.avg((F.col("e.v") <= F.col("q50")).cast("double")).alias("upto"))
    good = F.abs(F.col("n_distinct") - F.col("exact")) <= F.lit(profile.DISTINCT_ERROR) * F.col("exact") + 0.5
    near = (F.col("below") <= 0.5 + profile.RANK_ERROR) & (F.col("upto") >= 0.5 - profile.RANK_ERROR)
    out = told.join(exact, "column_name").join(ranks, "column_name")
    return rounded(out.select("column_name", "n_rows", "null_count", "min_value", "max_value", good.alias("distinct_within_bound"), near.alias("median_within_bound")))


def _classified(spark, scored: DataFrame, train: DataFrame) -> DataFrame:
    """Hold-out rows with what a fit has to show: a class and a score for each
    row, an AUC far above chance, more right answers than the training side's
    more frequent class gives."""
    scored = scored.persist()
    roc = metrics.auc(scored.select(F.col("fraud").alias("label"), "score")).first()["auc"]
    right = scored.agg(F.avg((F.col("prediction") == F.col("fraud")).cast("double"))).first()[0]
    common = train.groupBy("fraud").count().orderBy(F.desc("count"), "fraud").first()["fraud"]
    share = scored.agg(F.avg((F.col("fraud") == common).cast("double"))).first()[0]
    fine = F.col("prediction").isin(0.0, 1.0) & F.col("score").between(0.0, 1.0)
    return rounded(scored.select(*METRICS_KEYS, "fraud", fine.alias("valid"), F.lit(share).alias("common_share"),
                                 F.lit(right > share).alias("beats_common"), F.lit(roc > 0.9).alias("auc_above_nine_tenths")))


def q_train_classifier(spark, sf_dir):
    """L-1 with the base setting."""
    data = _signal_labels(spark, sf_dir)
    res = train_plan.train(data, training.CLASSIFICATION, "fraud", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED)
    return _classified(spark, training.with_score(res.predictions), split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)[0])


def q_train_logistic(spark, sf_dir):
    """L-9, logistic form."""
    data = _signal_labels(spark, sf_dir)
    res = train_plan.train(data, training.CLASSIFICATION, "fraud", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED, model_type="lr")
    return _classified(spark, training.with_score(res.predictions), split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)[0])


def q_train_regressor(spark, sf_dir):
    """L-2 with the base setting: the hold-out RMSE against that of the
    training mean."""
    data = _signal(spark, sf_dir)
    res = train_plan.train(data, training.REGRESSION, "query_latency", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED)
    train, test = split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)
    mean = train.agg(F.avg("query_latency")).first()[0]
    plain = test.agg(F.sqrt(F.avg(F.pow(F.col("query_latency") - F.lit(mean), 2)))).first()[0]
    rmse = res.holdout_metrics.first()["rmse"]
    return rounded(res.predictions.select(*METRICS_KEYS, "query_latency", F.lit(plain).alias("mean_rmse"), F.lit(rmse < 0.3 * plain).alias("far_below_mean_rmse")))


def q_train_linear(spark, sf_dir):
    """L-9: the ``--model-type lr`` option, honoured (linear regression in the
    same pipeline), beside the least-squares prediction by normal equations."""
    data = _signal(spark, sf_dir)
    res = train_plan.train(data, training.REGRESSION, "query_latency", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED, model_type="lr")
    train, _ = split.hash_split(derive_features(data), METRICS_KEYS, TEST_SIZE, SEED)
    fit = linear.fit_linear(train, res.features, "query_latency")
    exact = res.predictions.withColumn("least_squares", fit.predict())
    return rounded(exact.select(*METRICS_KEYS, F.col("least_squares").alias("prediction"), (F.abs(F.col("prediction") - F.col("least_squares")) < 1e-4).alias("pipeline_agrees")), 4)


def q_linear_coefficients(spark, sf_dir):
    """L-9 by normal equations: coefficient of every feature, and how far from
    orthogonal to it the training residuals are (as a correlation)."""
    train, _ = split.hash_split(derive_features(_signal(spark, sf_dir)), METRICS_KEYS, TEST_SIZE, SEED)
    fit = linear.fit_linear(train, FEATURES, "query_latency")
    rest = train.withColumn("rest", F.col("query_latency") - fit.predict())
    spread = F.stddev_pop("rest")
    row = rest.agg(*[F.coalesce(F.covar_pop("rest", F.col(c).cast("double")) / F.nullif(spread * F.stddev_pop(c), F.lit(0.0)), F.lit(0.0)).alias(c) for c in FEATURES]).first()
    return rounded(spark.createDataFrame([(c, b, not abs(row[c]) >= 1e-8) for c, b in zip(FEATURES, fit.coefficients)], "feature string, coefficient double, residual_is_orthogonal boolean"))


def q_cross_validate(spark, sf_dir):
    """L-3 + L-5 + L-7: the classification grid, 3 hash folds: one row per
    setting, its mean AUC above 0.9, one best setting with the largest."""
    res = train_plan.train(_signal_labels(spark, sf_dir), training.CLASSIFICATION, "fraud", METRICS_KEYS,
                           grid=training.CLASSIFIER_GRID, num_folds=NUM_FOLDS, parallelism=4,
                           test_size=TEST_SIZE, seed=SEED)
    best = res.best_params
    rows = res.grid_metrics.collect()  # one row per setting
    top = max(r["mean_areaUnderROC"] for r in rows)
    chosen = [r for r in rows if all(r[k] == v for k, v in best.items())]
    return spark.createDataFrame([
        (int(r["numTrees"]), int(r["maxDepth"]), 0.9 < r["mean_areaUnderROC"] <= 1.0, len(chosen) == 1 and chosen[0]["mean_areaUnderROC"] == top)
        for r in rows
    ], "numTrees int, maxDepth int, valid boolean, best_has_largest boolean")


def q_cross_validate_regression(spark, sf_dir):
    """L-4 + L-6 + L-7: the regression grid, 9 settings by 3 hash folds: rows of
    each validation fold, the RMSE of the mean of the other folds there, and
    whether the setting's RMSE is below half of that."""
    data = _signal(spark, sf_dir)
    res = train_plan.train(data, training.REGRESSION, "query_latency", METRICS_KEYS, grid=training.REGRESSOR_GRID,
                           num_folds=NUM_FOLDS, parallelism=4, test_size=TEST_SIZE, seed=SEED)
    folds = split.with_folds(split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)[0], METRICS_KEYS, NUM_FOLDS, SEED)
    other = F.array(*[F.lit(k) for k in range(NUM_FOLDS)])
    means = folds.select(F.explode(F.array_remove(other, F.col("fold"))).alias("fold"), "query_latency").groupBy("fold").agg(F.avg("query_latency").alias("mean"))
    plain = folds.join(means, "fold").groupBy("fold").agg(F.sqrt(F.avg(F.pow(F.col("query_latency") - F.col("mean"), 2))).alias("mean_rmse"))
    least = res.grid_metrics.agg(F.min_by(F.struct("numTrees", "maxDepth"), "mean_rmse").alias("s")).first()["s"]
    chosen = res.best_params == {"numTrees": least["numTrees"], "maxDepth": least["maxDepth"]}
    return rounded(res.fold_metrics.join(plain, "fold").select("numTrees", "maxDepth", "fold", "n_rows", "mean_rmse", (F.col("rmse") < 0.5 * F.col("mean_rmse")).alias("far_below"), F.lit(chosen).alias("best_has_least")))


def q_forest_nodes(spark, sf_dir):
    """L-1 + C-1 + C-3 from the node table: the hold-out scored by joins with
    the fitted forest's nodes, and whether Spark's own score is the same."""
    res = train_plan.train(_signal_labels(spark, sf_dir), training.CLASSIFICATION, "fraud", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED)
    model = res.model.stages[-1]
    nodes = forest.node_table(model, spark)
    own = training.with_score(res.predictions).select(*METRICS_KEYS, "fraud", "features", "score", "prediction")
    by_nodes = forest.score_with_nodes(own, nodes, model.getNumTrees, model.getOrDefault("maxDepth"), METRICS_KEYS).withColumnRenamed("score", "by_nodes")
    own = own.withColumn("features", vector_to_array("features"))
    same = (F.abs(F.col("score") - F.col("by_nodes")) < 1e-9) & ((F.col("by_nodes") > 0.5).cast("double") == F.col("prediction"))
    return own.join(by_nodes, [*METRICS_KEYS, "features"]).select(*METRICS_KEYS, "fraud", same.alias("same"))


def q_forest_leaves(spark, sf_dir):
    """L-2 from the node table: trees grown on every training row once (no
    bootstrap): training rows and label sums over each tree's leaves."""
    data = derive_features(_signal(spark, sf_dir))
    train, _ = split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)
    pipe, _ = training.build_pipeline(_signal(spark, sf_dir), training.REGRESSION, "query_latency", METRICS_KEYS, numTrees=3, maxDepth=6, bootstrap=False)
    rows = training.stable_layout(train, METRICS_KEYS, training.layout_partitions(train.count()))
    fitted = training.split_derivation(pipe)[1].fit(rows)
    nodes = forest.node_table(fitted.stages[-1], spark)
    leaves = nodes.where(F.col("feature").isNull())
    totals = leaves.groupBy("tree").agg(F.sum("n_rows").alias("n_rows"), F.sum(F.col("n_rows") * F.col("value")).alias("label_sum"), (F.count(F.lit(1)) > 30).alias("many_leaves"))
    return rounded(totals, 2)


def _registered_regressor(spark, sf_dir):
    data = _signal(spark, sf_dir)
    store = RegistryStore(spark, fresh_path(spark, "registry"))
    res = train_plan.train(data, training.REGRESSION, "query_latency", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED)
    event_id = store.next_event_id()
    train_plan.log_training_run(res, store, event_id, None)
    train_plan.register_and_promote(res, store, "query_latency_model", "rmse", False, event_id)
    return data, store


def q_batch_score(spark, sf_dir):
    """C-3 + S-4 + K-2 + K-5 + K-6: register a trained model as champion,
    resolve the alias, load it, score the hold-out, write partitioned
    Parquet and read it back."""
    data, store = _registered_regressor(spark, sf_dir)
    _, test = split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)
    out = fresh_path(spark, "predictions")
    for day in ("2024-01-30", "2024-01-31", "2024-01-31"):  # a date may be scored again
        inference.batch_score(test, store, "query_latency_model", [*METRICS_KEYS, "memory_utilization", "system_load"], out, score_date=day)
    # What the model cannot explain lies within 10 of the label (see signal_view).
    told = F.lit(2.0) * F.col("memory_utilization") + F.lit(3.0) * F.col("system_load")
    fine = F.coalesce(F.abs(F.col("prediction") - told - 5.0) < 25, F.lit(False))
    return spark.read.parquet(out).select(*METRICS_KEYS, F.col("score_date").cast("string").alias("score_date"), fine.alias("valid"))


def q_two_model_score(spark, sf_dir):
    """C-2: two fitted classifiers score the hold-out side by side."""
    data = _signal_labels(spark, sf_dir)
    a, b = train_plan.train_each(data, training.CLASSIFICATION, "fraud", METRICS_KEYS, [{}, {"numTrees": 20, "maxDepth": 10}],
                                 test_size=TEST_SIZE, seed=SEED)
    _, test = split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)
    both = scoring.score_two(a.model, b.model, test, keep=METRICS_KEYS + ["fraud"])
    models = ("champion", "challenger")
    fine = [F.col(f"pred_{m}").isin(0.0, 1.0) & F.col(f"score_{m}").between(0.0, 1.0) for m in models]
    hit = [(F.col(f"pred_{m}") == F.col("fraud")).alias(m) for m in models]
    both = both.select(*METRICS_KEYS, "fraud", (fine[0] & fine[1]).alias("valid"), *hit).persist()
    right = both.agg(*[F.avg(F.col(m).cast("double")).alias(m) for m in models]).first()
    return both.select(*METRICS_KEYS, "fraud", "valid", *[F.lit(right[m] > 0.85).alias(f"{m}_mostly_right") for m in models])


def q_model_roundtrip(spark, sf_dir):
    """K-5: save, reload, score again: all rows the same."""
    data = _signal_labels(spark, sf_dir)
    res = train_plan.train(data, training.CLASSIFICATION, "fraud", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED)
    path = sinks.save_model(res.model, fresh_path(spark, "model"))
    from pyspark.ml import PipelineModel

    both = scoring.score_two(res.model, PipelineModel.load(path), split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)[1],
                             keep=METRICS_KEYS)
    same = (F.col("pred_champion") == F.col("pred_challenger")) & (F.abs(F.col("score_champion") - F.col("score_challenger")) < 1e-12)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_same"))


def q_stream_score(spark, sf_dir):
    """Incremental scoring: the hold-out lands as files, a file-source stream
    (availableNow) scores them with a fitted classifier into Parquet."""
    data = _signal_labels(spark, sf_dir)
    res = train_plan.train(data, training.CLASSIFICATION, "fraud", METRICS_KEYS, test_size=TEST_SIZE, seed=SEED)
    _, test = split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)
    root = fresh_path(spark, "stream")
    test.repartition(4, *METRICS_KEYS).write.parquet(root + "/landing")
    stream_scoring.score_new_files(
        spark, root + "/landing", test.schema, res.model, METRICS_KEYS + ["fraud"],
        root + "/scored", root + "/checkpoint", max_files_per_trigger=2,
    )
    scored = spark.read.parquet(root + "/scored")
    return _classified(spark, scored, split.hash_split(data, METRICS_KEYS, TEST_SIZE, SEED)[0])


def _holed(spark, sf_dir):
    """Label rows with nulls in the segment, a feature and the label."""
    return _labels(spark, sf_dir).select(
        *METRICS_KEYS, F.expr("nullif(node_id, 3)").cast("string").alias("node_id"), F.expr("nullif(memory_utilization, 10.0)").alias("memory_utilization"),
        F.when(F.col("l_linenumber") != 2, F.col("fraud").cast("double")).alias("label"),
    )


def q_null_profile_holed(spark, sf_dir):
    """F-2 where there are nulls."""
    return profile.null_profile(_holed(spark, sf_dir))


def q_auc_nulls(spark, sf_dir):
    """A-1 with a null segment, null labels and null scores."""
    scored = _holed(spark, sf_dir).withColumn("score", F.col("memory_utilization") / 50.0)
    return rounded(metrics.auc(scored, segments=["node_id"]))


def q_accuracy_nulls(spark, sf_dir):
    """A-2, A-4 with a null segment, null labels and null predictions."""
    scored = _holed(spark, sf_dir).withColumn("prediction", (F.col("memory_utilization") >= 25).cast("double"))
    return rounded(metrics.classification_metrics(scored, segments=["node_id"]).select("node_id", "n_rows", "accuracy", "f1_positive"))


def q_regression_metrics_nulls(spark, sf_dir):
    """A-5, A-6 with a null segment, null labels and null predictions."""
    m = metrics.regression_metrics(_holed(spark, sf_dir).withColumn("prediction", F.col("memory_utilization") / 50.0), segments=["node_id"])
    return rounded(m.select("node_id", "n_rows", "rmse", "mae"))


def q_profile_bigint(spark, sf_dir):
    """F-4 distinct counts of whole numbers beyond 2^53."""
    big = read_table(spark, sf_dir, "orders").select((F.col("o_orderkey") + F.lit(2**53)).alias("big"))
    return profile.column_profile(big).select("column_name", "null_count", "n_distinct")


def q_hash_split_no_keys(spark, sf_dir):
    """T-2 without key columns: the whole row is the key."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return split.with_split(labels, labels.columns, TEST_SIZE, SEED)


def q_random_split(spark, sf_dir):
    """T-1: the sides are disjoint and together hold every row."""
    rows = read_table(spark, sf_dir, "events").select("event_id").persist()
    train, test = split.random_split(rows, TEST_SIZE, SEED)
    both = train.withColumn("side", F.lit(0)).unionByName(test.withColumn("side", F.lit(1)))
    return both.groupBy("event_id").agg(F.countDistinct("side").alias("sides"), F.count(F.lit(1)).alias("n")).groupBy("sides").agg(F.sum("n").alias("n_rows"))


def q_skipped_ab(spark, sf_dir):
    """B-8: a champion without a challenger gives a SKIPPED decision per node."""
    m = metrics.regression_metrics(_scored_regressors(spark, sf_dir).where(F.col("model") == "champion"), segments=["model", "node_id"])
    return abtest.decide_regression(m, ["node_id"]).select("node_id", "decision")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_scan_roundtrip": q_csv_scan_roundtrip,
    "row_count": q_row_count,
    "null_profile": q_null_profile,
    "column_profile": q_column_profile,
    "null_rows": q_null_rows,
    "preview": q_preview,
    "select_numeric_columns": q_select_numeric_columns,
    "calendar_features": q_calendar_features,
    "interaction_feature": q_interaction_feature,
    "guarded_ratio": q_guarded_ratio,
    "full_features": q_full_features,
    "hash_split": q_hash_split,
    "split_sizes": q_split_sizes,
    "kfold_sizes": q_kfold_sizes,
    "standardize": q_standardize,
    "confusion_counts": q_confusion_counts,
    "auc": q_auc,
    "accuracy": q_accuracy,
    "f1_weighted": q_f1_weighted,
    "f1_positive": q_f1_positive,
    "regression_metrics": q_regression_metrics,
    "poisson_bootstrap": q_poisson_bootstrap,
    "welch_stats": q_welch_stats,
    "effect_size": q_effect_size,
    "decide_regression": q_decide_regression,
    "ab_report": q_ab_report,
    "ab_report_json": q_ab_report_json,
    "log_metrics": q_log_metrics,
    "log_lines": q_log_lines,
    "resolve_alias": q_resolve_alias,
    "champion_metrics": q_champion_metrics,
    "next_version": q_next_version,
    "promotion_auc": q_promotion_auc,
    "promotion_rmse": q_promotion_rmse,
    "relative_improvement": q_relative_improvement,
    "alias_swap": q_alias_swap,
    "retraining_report": q_retraining_report,
    "bootstrap_f1": q_bootstrap_f1,
    "processed_sets": q_processed_sets,
    "train_classifier": q_train_classifier,
    "train_regressor": q_train_regressor,
    "train_linear": q_train_linear,
    "cross_validate": q_cross_validate,
    "processed_counts": q_processed_counts,
    "train_from_processed": q_train_from_processed,
    "log_params": q_log_params,
    "train_log_lines": q_train_log_lines,
    "select_all_but_label": q_select_all_but_label,
    "auc_many_scores": q_auc_many_scores,
    "incremental_scaler": q_incremental_scaler,
    "sketch_profile": q_sketch_profile,
    "cross_validate_regression": q_cross_validate_regression,
    "linear_coefficients": q_linear_coefficients,
    "forest_nodes": q_forest_nodes,
    "forest_leaves": q_forest_leaves,
    "batch_score": q_batch_score,
    "two_model_score": q_two_model_score,
    "model_roundtrip": q_model_roundtrip,
    "stream_score": q_stream_score,
    "train_logistic": q_train_logistic,
    "null_profile_holed": q_null_profile_holed,
    "auc_nulls": q_auc_nulls,
    "accuracy_nulls": q_accuracy_nulls,
    "regression_metrics_nulls": q_regression_metrics_nulls,
    "profile_bigint": q_profile_bigint,
    "hash_split_no_keys": q_hash_split_no_keys,
    "random_split": q_random_split,
    "skipped_ab": q_skipped_ab,
}
