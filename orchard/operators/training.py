"""Model fitting and selection.

One ``Pipeline`` goes from raw columns to a prediction:

    SQLTransformer (feature derivation, P-11)
      -> VectorAssembler (M-1 / M-2)
      -> StandardScaler (M-4, mean and sample std of the training rows)
      -> RandomForest{Classifier,Regressor} (L-1 / L-2) or a linear model (L-9)

Because the derivation and the scaler are stages of the saved model, batch
scoring and A/B evaluation feed raw rows to the same fitted object the
training job evaluated — no second, unscaled copy of the features.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.functions.features import TIME_COLUMN, derivation_sql
from orchard.operators import forest, metrics
from orchard.operators.grow import ForestClassifier, ForestRegressor
from orchard.session import fresh_path

CLASSIFICATION, REGRESSION = "classification", "regression"

# The search grids and base settings of the two jobs.
CLASSIFIER_GRID = {"numTrees": [10, 20], "maxDepth": [5, 10]}
REGRESSOR_GRID = {"numTrees": [30, 50, 70], "maxDepth": [5, 10, 15]}
LINEAR_GRID = {"regParam": [0.0, 0.01, 0.1]}
CLASSIFIER_BASE = {"numTrees": 10, "maxDepth": 5}
REGRESSOR_BASE = {"numTrees": 50, "maxDepth": 10}


def derivation_statement(schema: T.StructType, time_col: str = TIME_COLUMN) -> str:
    """P-11 over ``__THIS__``: every input column plus the derived ones whose
    inputs exist.  The statement is fixed at fit time and saved with the model."""
    return "SELECT " + ", ".join(derivation_sql(schema, time_col)) + " FROM __THIS__"


def feature_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    """Feature names after derivation: numeric/boolean, not label or keys (P-2)."""
    derived = SQLTransformer(statement=derivation_statement(df.schema)).transform(df.limit(0))
    ex = set(exclude) | {"fold", "split"}
    return [
        f.name for f in derived.schema.fields
        if f.name not in ex and f.name != TIME_COLUMN and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


# Forest settings that change speed and memory, not the fitted model.  Cached
# node ids avoid walking every tree from the root at each level and shipping the
# trees with each pass, but keep three copies of one number per row and tree:
# they are kept for deep trees only.  More memory for histograms puts more nodes
# of a level into one pass over the rows; every running task may take as much.
FOREST_SPEED = {"checkpointInterval": 10, "maxMemoryInMB": 512}
CACHED_IDS_BEYOND_DEPTH = 10


def forest_speed(max_depth: int) -> dict:
    return {**FOREST_SPEED, "cacheNodeIds": max_depth > CACHED_IDS_BEYOND_DEPTH}


# Nodes a search holds in the driver per fit: forests that may grow beyond it
# are fitted in parts of fewer trees, scored and let go one after another.  They
# are held as finished nodes; MLlib's fit held its own records of them besides.
NODES_AT_ONCE = 1 << 20


def forest_parts(trees: int, max_depth: int) -> list[int]:
    """Tree counts of the parts in which a search fits ``trees`` trees."""
    parts = -(-trees // max(1, NODES_AT_ONCE >> (max_depth + 1)))
    return [trees // parts + (i < trees % parts) for i in range(parts)]


def make_estimator(task: str, label: str, model_type: str = "rf", seed: int = 42, **params):
    """L-1 / L-2 forests; ``model_type='lr'`` gives the linear model the
    reference's option names but never builds (L-9)."""
    common = {"labelCol": label, "featuresCol": "features"}
    if task == CLASSIFICATION:
        if model_type == "lr":
            return LogisticRegression(**common, **params)
        base = {**CLASSIFIER_BASE, **params}
        base = {**forest_speed(base["maxDepth"]), **base}
        return ForestClassifier(**common, seed=seed, **base)
    if model_type == "lr":
        return LinearRegression(**common, **params)
    base = {**REGRESSOR_BASE, **params}
    base = {**forest_speed(base["maxDepth"]), **base}
    return ForestRegressor(**common, seed=seed, **base)


def build_pipeline(
    df: DataFrame,
    task: str,
    label: str,
    keys: list[str] = (),
    model_type: str = "rf",
    handle_invalid: str = "keep",
    seed: int = 42,
    **params,
) -> tuple[Pipeline, list[str]]:
    """M-5: derivation -> assembler -> scaler -> estimator; returns the
    pipeline and the feature names it assembles."""
    feats = feature_columns(df, [label, *keys])
    stages = [
        SQLTransformer(statement=derivation_statement(df.schema)),
        VectorAssembler(inputCols=feats, outputCol="features_raw", handleInvalid=handle_invalid),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        make_estimator(task, label, model_type, seed, **params),
    ]
    return Pipeline(stages=stages), feats


def stable_layout(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """Fix row placement and order before fitting: forests sample per
    partition, so the same seed needs the same layout to give the same model."""
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def complete_rows(df: DataFrame, columns: list[str]) -> Column:
    """True where none of ``columns`` is null or NaN.  One null or NaN in a
    training column would make the scaler's mean and sd of that column NaN,
    and so every scaled value (SURVEY 7.7)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cond = F.lit(True)
    for c in columns:
        col = F.col(f"`{c}`")
        ok = col.isNotNull()
        if isinstance(types.get(c), (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(col)
        cond = cond & ok
    return cond


# Training-set partitioning, from the row count alone: forests sample per
# partition, so a layout that followed the cluster's cores would give another
# model on another cluster.  Every tree level ships one histogram array per
# partition and node through a shuffle, so thin partitions cost more than their
# rows; beyond MANY partitions they grow to ROWS_PER_FIT_PARTITION.
MIN_ROWS_PER_FIT_PARTITION = 50_000
MANY_FIT_PARTITIONS = 64
ROWS_PER_FIT_PARTITION = 1_000_000


def layout_partitions(n_rows: int) -> int:
    """Partitions for a training set of ``n_rows``."""
    thin = min(MANY_FIT_PARTITIONS, math.ceil(n_rows / MIN_ROWS_PER_FIT_PARTITION))
    return max(1, thin, math.ceil(n_rows / ROWS_PER_FIT_PARTITION))


def split_derivation(pipeline: Pipeline) -> tuple[SQLTransformer, Pipeline]:
    """(derivation stage, rest of the pipeline).  The derivation has no fitted
    state, so it can run once before a search and be put back in front of the
    fitted stages: the saved model still takes raw columns."""
    first, *rest = pipeline.getStages()
    return first, Pipeline(stages=rest)


def without_summary(model, spark: SparkSession):
    """The fitted model without its training summary.  A classifier's summary
    holds the Spark session, and once a session has observed metrics
    (``DataFrame.observe``) it cannot be sent to executors with the model.
    Copying a forest leaves the summary behind, other models drop it when they
    are saved and loaded."""
    if isinstance(model, PipelineModel):
        return PipelineModel(stages=[without_summary(s, spark) for s in model.stages])
    if not getattr(model, "hasSummary", False):
        return model
    if isinstance(model, RandomForestClassificationModel):
        return model.copy()
    path = fresh_path(spark, "model")
    model.write().save(path)
    return type(model).load(path)


@dataclass
class CVResult:
    model: PipelineModel
    best_params: dict
    grid_metrics: DataFrame  # one row per setting: params..., mean metric
    fold_metrics: DataFrame  # one row per setting and fold: params..., fold, n_rows, metric


def _settings(grid: dict[str, list]) -> list[dict]:
    """The full cartesian grid of the given settings."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _fold_scores(model, valid: DataFrame, task: str, label: str, counts: list[int] | None) -> list[tuple[float, int]]:
    """(metric, rows) of one validation fold: one pair per tree count, all read
    off one pass of the forest over the rows; one pair for other models."""
    if counts:
        wide = forest.prefix_scores(model, valid, counts, [label])
    else:
        score = with_score(model.transform(valid)) if task == CLASSIFICATION else model.transform(valid).withColumn("score", F.col("prediction"))
        wide = score.select(label, F.array("score").alias("scores"))
    return _score_metrics(wide, task, label, len(counts or [1]))


def _score_metrics(wide: DataFrame, task: str, label: str, n: int) -> list[tuple[float, int]]:
    """(metric, rows) of each of the ``n`` entries of ``scores``."""
    if task == REGRESSION:
        errors = [F.sqrt(F.avg(F.pow(F.col("scores")[i] - F.col(label), 2))).alias(f"m{i}") for i in range(n)]
        row = wide.agg(F.count(F.lit(1)).alias("n"), *errors).first()
        return [(row[f"m{i}"], row["n"]) for i in range(n)]
    wide = wide.persist()  # read for the slices and for the curve
    long = wide.select(F.col(label).alias("label"), F.posexplode("scores").alias("nth", "score"))
    found = {r["nth"]: r for r in metrics.auc(long, segments=["nth"]).collect()}  # one row per entry
    wide.unpersist()
    return [(found[i]["auc"], found[i]["n_pos"] + found[i]["n_neg"]) if i in found else (None, 0) for i in range(n)]


def _with_setting(est, setting: dict):
    """The estimator with a setting, and the speed settings that go with its depth."""
    speed = {"cacheNodeIds": forest_speed(setting["maxDepth"])["cacheNodeIds"]} if "maxDepth" in setting else {}
    return est.copy({est.getParam(n): v for n, v in {**speed, **setting}.items()})


def _forest_scores(est, setting: dict, rows: DataFrame, valid: DataFrame, label: str, counts: list[int], depths: list[int]) -> DataFrame:
    """Label and ``scores`` of the validation rows: for each depth, for each
    tree count, the score of that forest.  One forest of the most and deepest
    trees serves all; where it may hold more than ``NODES_AT_ONCE`` nodes, its
    trees are fitted in parts, and only the running sums are kept of a part."""
    spark, seed, done, sums = rows.sparkSession, est.getSeed(), 0, None
    parts = forest_parts(counts[-1], depths[-1])
    for i, trees in enumerate(parts):
        part = _with_setting(est, {**setting, "numTrees": trees, "maxDepth": depths[-1], "seed": seed + 1_000_003 * i})
        model = without_summary(part.fit(rows), spark)
        keep = [label] if i == len(parts) - 1 else [label, "features"]
        valid = forest.prefix_scores(model, valid, counts, keep, depths=depths, first_tree=done, before=sums)
        if i < len(parts) - 1:
            path = fresh_path(spark, "forest-sums")
            valid.write.parquet(path)
            valid, sums, done = spark.read.parquet(path), "scores", done + trees
    return valid


def cross_validate(
    train: DataFrame,
    pipeline: Pipeline,
    grid: dict[str, list],
    task: str,
    label: str,
    num_folds: int = 3,
    fold_col: str = "fold",
    parallelism: int = 4,
) -> CVResult:
    """L-3 ... L-7: k-fold search on precomputed folds (``fold_col``), best mean
    AUC or RMSE, refitted on all rows.

    The feature stages are fitted once a fold and their vectors kept while more
    than one fit reads them.  Forests are evaluated by prefix: the trees of a
    forest are drawn independently, so the first k trees of the largest are a
    forest of k trees, and a node's split does not depend on how deep its tree
    may grow, so trees cut at a depth are trees of that depth; one fit per fold
    and other settings serves all tree counts and depths.  ``parallelism`` fits
    run at a time.
    """
    *prepare, est = pipeline.getStages()
    counts = depths = None
    if est.hasParam("numTrees") and {"numTrees", "maxDepth"} & set(grid):
        counts = sorted(set(grid.get("numTrees", [est.getNumTrees()])))
        depths = sorted(set(grid.get("maxDepth", [est.getMaxDepth()])))
    others = _settings({k: v for k, v in grid.items() if not (counts and k in ("numTrees", "maxDepth"))})
    fits = len(others) * (len(forest_parts(counts[-1], depths[-1])) if counts else 1)
    read_off = [{k: v for k, v in (("numTrees", c), ("maxDepth", d)) if k in grid} for d in depths for c in counts] if counts else [{}]
    kept: dict[int, DataFrame] = {}
    left = dict.fromkeys(range(num_folds), len(others))
    lock = Lock()

    def features(k: int) -> DataFrame:
        with lock:
            if k not in kept:
                side = F.col(fold_col) == k
                fitted = Pipeline(stages=prepare).fit(train.where(~side))
                kept[k] = fitted.transform(train).select(label, "features", fold_col)
                if fits > 1:
                    kept[k].persist()
            return kept[k]

    def run(job: tuple[int, dict]) -> list[dict]:
        k, setting = job
        rows = features(k)
        fold, valid = rows.where(F.col(fold_col) != k), rows.where(F.col(fold_col) == k)
        if counts:
            scores = _score_metrics(_forest_scores(est, setting, fold, valid, label, counts, depths), task, label, len(read_off))
        else:
            model = without_summary(_with_setting(est, setting).fit(fold), train.sparkSession)
            scores = _fold_scores(model, valid, task, label, None)
        with lock:
            left[k] -= 1
            if not left[k] and fits > 1:
                rows.unpersist()
        return [{**setting, **read, "fold": k, "metric": m, "n_rows": n} for read, (m, n) in zip(read_off, scores)]

    with ThreadPool(parallelism) as pool:
        rows = [r for part in pool.map(inheritable_thread_target(train.sparkSession)(run), [(k, s) for k in range(num_folds) for s in others], chunksize=1) for r in part]
    names = list(grid)
    means = []
    for s in _settings(grid):
        seen = [r["metric"] for r in rows if all(r[n] == s[n] for n in names) and r["metric"] is not None]
        means.append((s, sum(seen) / len(seen) if seen else None))
    scored = [(s, m) for s, m in means if m is not None]
    pick = max if task == CLASSIFICATION else min
    best = pick(scored, key=lambda x: x[1])[0] if scored else means[0][0]
    model = Pipeline(stages=[*prepare, _with_setting(est, best)]).fit(train)
    model = without_summary(model, train.sparkSession)
    spark, metric = train.sparkSession, "areaUnderROC" if task == CLASSIFICATION else "rmse"
    kinds = ", ".join(f"{n} {'int' if isinstance(v[0], int) else 'double'}" for n, v in grid.items())
    return CVResult(
        model, best,
        spark.createDataFrame([(*(s[n] for n in names), m) for s, m in means], f"{kinds}, mean_{metric} double"),
        spark.createDataFrame([(*(r[n] for n in names), r["fold"], r["n_rows"], r["metric"]) for r in rows], f"{kinds}, fold int, n_rows bigint, {metric} double"),
    )


def with_score(predictions: DataFrame, out: str = "score") -> DataFrame:
    """Positive-class probability as a plain double column (for AUC)."""
    return predictions.withColumn(out, vector_to_array(F.col("probability"))[1])
