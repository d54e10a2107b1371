"""Training jobs: preprocess (pipeline B step 1) and train + register
(both pipelines), as DataFrame plans over the operators."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orchard.operators import metrics, registry, split, training
from orchard.sources import sinks
from orchard.sources.models import RegistryStore


# --------------------------------------------------------------------------
# preprocess: raw rows -> processed train / test sets (K-1)
# --------------------------------------------------------------------------

#: Folder inside a processed set with what made it; readers of the set skip
#: names that begin with an underscore.
FEATURES_FOLDER = "_features"


def processed(raw: DataFrame, label: str, keys: list[str], test_size: float = 0.2, seed: int = 42):
    """Both sides in one frame (``keys…, features, label, split``), the fitted
    feature pipeline, the feature names and an observation of the counts.

    Rows are tagged by the key hash; derivation, assembler and scaler are
    fitted on the training side only.  Rows with a null or NaN would turn the
    scaler's statistics, and with them every scaled value, into NaN: they are
    left out of both sets.  The observation counts all rows, the dropped ones
    and both sides while the frame is written, without a pass of its own.
    """
    own, keys = keys, keys or list(raw.columns)
    pipe, feats = training.build_pipeline(raw, training.REGRESSION, label, own)
    derive, *rest = pipe.getStages()[:-1]
    tagged = derive.transform(split.with_split(raw, keys, test_size, seed))
    complete = training.complete_rows(tagged, [*feats, label])
    inner = Pipeline(stages=rest).fit(tagged.where(complete & (F.col("split") == split.TRAIN)))
    counts = Observation("processed")
    watched = tagged.observe(
        counts, F.count(F.lit(1)).alias("n_rows"), F.count_if(~complete).alias("dropped_rows"),
        F.count_if(complete & (F.col("split") == split.TRAIN)).alias("train_rows"), F.count_if(complete & (F.col("split") == split.TEST)).alias("test_rows"),
    )
    out = inner.transform(watched.where(complete)).select(*own, "features", F.col(label).cast("double").alias("label"), "split")
    return out, PipelineModel(stages=[derive, *inner.stages]), feats, counts


def preprocess(
    raw: DataFrame,
    label: str,
    keys: list[str],
    test_size: float = 0.2,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, PipelineModel, list[str]]:
    """``processed`` as (train, test, fitted feature pipeline, feature names)."""
    both, fitted, feats, _ = processed(raw, label, keys, test_size, seed)
    return (*(both.where(F.col("split") == s).drop("split") for s in (split.TRAIN, split.TEST)), fitted, feats)


def write_processed(raw: DataFrame, label: str, keys: list[str], path: str, test_size: float = 0.2, seed: int = 42) -> dict:
    """Write the processed set under ``path`` in one pass, partitioned by
    ``split`` (``split=train`` and ``split=test`` are Parquet sets of their
    own), with the fitted feature stages and the feature names beside it.
    Returns the counts."""
    both, fitted, feats, counts = processed(raw, label, keys, test_size, seed)
    with sinks.few_folders(raw.sparkSession):
        both.write.mode("overwrite").partitionBy("split").parquet(path)
    fitted.write().overwrite().save(f"{path}/{FEATURES_FOLDER}/stages")
    spark = raw.sparkSession
    names = spark.createDataFrame([("feature", i, n) for i, n in enumerate(feats)] + [("key", i, n) for i, n in enumerate(keys)] + [("label", 0, label)], "kind string, position int, name string")
    names.write.mode("overwrite").parquet(f"{path}/{FEATURES_FOLDER}/names")
    return counts.get


@dataclass
class ProcessedSet:
    train: DataFrame
    test: DataFrame
    stages: PipelineModel
    features: list[str]
    keys: list[str]
    label: str


def read_processed(spark: SparkSession, path: str) -> ProcessedSet:
    """S-2: a set that ``write_processed`` left, with its feature stages."""
    names = spark.read.parquet(f"{path}/{FEATURES_FOLDER}/names").orderBy("kind", "position").collect()
    told = {k: [r["name"] for r in names if r["kind"] == k] for k in ("feature", "key", "label")}
    both = spark.read.parquet(path)
    train, test = (both.where(F.col("split") == s).drop("split") for s in (split.TRAIN, split.TEST))
    return ProcessedSet(train, test, PipelineModel.load(f"{path}/{FEATURES_FOLDER}/stages"), told["feature"], told["key"], told["label"][0])


def expand_features(df: DataFrame, names: list[str]) -> DataFrame:
    """Vector -> named double columns (for reading a processed set back)."""
    arr = vector_to_array(F.col("features"))
    return df.select(*[c for c in df.columns if c != "features"], *[arr[i].alias(n) for i, n in enumerate(names)])


# --------------------------------------------------------------------------
# train + evaluate + register
# --------------------------------------------------------------------------


@dataclass
class TrainResult:
    run_id: str
    model: PipelineModel
    features: list[str]
    best_params: dict
    grid_metrics: DataFrame | None
    fold_metrics: DataFrame | None
    predictions: DataFrame
    task: str
    label: str
    version: int | None = None
    decision: str | None = None
    extra: dict = field(default_factory=dict)
    _holdout: DataFrame | None = None

    @property
    def holdout_metrics(self) -> DataFrame:
        """One-row hold-out metrics, computed on first use and kept."""
        if self._holdout is None:
            self._holdout = holdout_metrics(self.task, self.predictions, self.label)
        return self._holdout


def holdout_metrics(task: str, predictions: DataFrame, label: str) -> DataFrame:
    """One-row metric table of the hold-out (evaluators as aggregations).

    The metrics read the scored hold-out several times (confusion counts,
    AUC and its slice bounds).  Only a narrow (label, prediction, score)
    projection is kept for that, so the model is applied to the hold-out
    once; the single result row is then kept as a literal one-row frame, so
    logging and promotion do not score the hold-out again.
    """
    spark = predictions.sparkSession
    if task == training.CLASSIFICATION:
        scored = training.with_score(predictions).select(label, "prediction", "score")
    else:
        scored = predictions.select(label, "prediction")
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    if task == training.CLASSIFICATION:
        cls = metrics.classification_metrics(scored, label=label, prediction="prediction")
        roc = metrics.auc(scored, label=label, score="score")
        cls = cls.withColumn("_k", F.lit(0))
        roc = roc.withColumn("_k", F.lit(0))
        table = cls.join(roc.select("_k", "auc"), "_k").select(
            "auc", "accuracy", F.col("f1_weighted").alias("f1"), "f1_positive", "n_rows"
        )
    else:
        table = metrics.regression_metrics(scored, label=label, prediction="prediction")
    row = table.first()
    scored.unpersist()
    return spark.createDataFrame([tuple(row)] if row is not None else [], table.schema)


# Laid-out training rows stay on disk: a forest fit keeps its own copy of them,
# with one number a row and tree, and passes over that copy once a level of the
# trees.  Rows held in memory beside it would push it out, block by block.
KEPT_ROWS = StorageLevel.DISK_ONLY


def train(
    df: DataFrame,
    task: str,
    label: str,
    keys: list[str],
    grid: dict | None = None,
    num_folds: int = 3,
    parallelism: int = 4,
    test_size: float = 0.2,
    seed: int = 42,
    model_type: str = "rf",
    params: dict | None = None,
    run_id: str | None = None,
) -> TrainResult:
    """Split -> (cross-validated) fit -> hold-out metrics.

    With ``grid`` the settings are searched with ``num_folds``-fold CV on
    hash folds (L-5/L-6) and the best is refit on all training rows; without
    it one model with ``params`` is fit.  The training side is laid out
    deterministically and kept once: every fold and setting reads it.
    """
    res, = train_each(df, task, label, keys, [params or {}], grid, num_folds, parallelism, test_size, seed, model_type)
    res.run_id = run_id or res.run_id
    return res


def train_each(
    df: DataFrame,
    task: str,
    label: str,
    keys: list[str],
    settings: list[dict],
    grid: dict | None = None,
    num_folds: int = 3,
    parallelism: int = 4,
    test_size: float = 0.2,
    seed: int = 42,
    model_type: str = "rf",
) -> list[TrainResult]:
    """``train`` with each of the ``settings`` as ``params``, one result each.
    All fits read one layout of the training rows and, without a grid, the
    feature stages fitted once on it."""
    handle = "keep" if task == training.REGRESSION else "error"
    pipe, feats = training.build_pipeline(df, task, label, keys, model_type, handle, seed)
    keys = keys or list(df.columns)  # without keys the row itself is the key
    derive, inner = training.split_derivation(pipe)
    *prepare, _ = inner.getStages()
    tr, te = split.hash_split(df, keys, test_size, seed)
    # Derived once here instead of once per fold and setting.
    tr = derive.transform(tr)
    if grid:  # a second hash of every row, which only a search reads
        tr = split.with_folds(tr, keys, num_folds, seed)
    # Incomplete rows of both sides are left out and counted, in the one pass
    # that sizes the layout.
    sides = derive.transform(split.with_split(df, keys, test_size, seed))
    whole, held = training.complete_rows(sides, [*feats, label]), F.col("split") == split.TEST
    counts = sides.agg(F.count_if(whole & ~held).alias("n"), F.count_if(~whole & ~held).alias("dropped"), F.count_if(~whole & held).alias("dropped_test")).first()
    parts = training.layout_partitions(counts["n"])
    # Keys and raw columns only place the rows; what is kept is what fits read.
    tr = tr.where(training.complete_rows(tr, [*feats, label]))
    tr = training.stable_layout(tr, keys, parts).select(*feats, label, *(["fold"] if grid else []))
    if not grid:  # a fit passes several times over its input before it has its own copy
        assemble, scale = prepare
        tr = assemble.transform(tr).select(assemble.getOutputCol(), label)
    tr = tr.persist(KEPT_ROWS)
    # The hold-out leaves its incomplete rows out as well.
    te = derive.transform(te)
    te = te.where(training.complete_rows(te, [*feats, label]))
    if not grid:
        features = PipelineModel(stages=[assemble, scale.fit(tr)])
        vectors = features.stages[-1].transform(tr).select("features", label)
    results = []
    for params in settings:
        est = training.make_estimator(task, label, model_type, seed, **params)
        grid_df = fold_df = None
        if grid:
            cv = training.cross_validate(tr, Pipeline(stages=[*prepare, est]), grid, task, label, num_folds, "fold", parallelism)
            fitted, best, grid_df, fold_df = cv.model, cv.best_params, cv.grid_metrics, cv.fold_metrics
        else:
            fitted = PipelineModel(stages=[*features.stages, training.without_summary(est.fit(vectors), df.sparkSession)])
            best = {n: est.getOrDefault(est.getParam(n)) for n in ("numTrees", "maxDepth") if est.hasParam(n)}
        model = PipelineModel(stages=[derive, *fitted.stages])
        results.append(TrainResult(uuid.uuid4().hex, model, feats, best, grid_df, fold_df, fitted.transform(te), task, label,
                                   extra={"training_rows": counts["n"], "dropped_training_rows": counts["dropped"], "dropped_test_rows": counts["dropped_test"]}))
    tr.unpersist()
    return results


def train_processed(
    source: ProcessedSet,
    task: str,
    grid: dict | None = None,
    num_folds: int = 3,
    parallelism: int = 4,
    seed: int = 42,
    model_type: str = "rf",
    params: dict | None = None,
    run_id: str | None = None,
) -> TrainResult:
    """``train`` on a processed set: no derivation, assembling or scaling is
    done again, and folds and layout come from the same keys, so the result is
    that of training from the raw rows.  The model in the result begins with
    the set's feature stages and takes raw rows like any other."""
    est = training.make_estimator(task, "label", model_type, seed, **(params or {}))
    tr = source.train
    keys = source.keys
    if not keys:  # the row itself is the key
        keys = ["_row"]
        tr = tr.withColumn("_row", F.concat_ws(",", vector_to_array("features").cast("array<string>"), F.col("label").cast("string")))
    if grid:
        tr = split.with_folds(tr, keys, num_folds, seed)
    n = tr.count()
    tr = training.stable_layout(tr, keys, training.layout_partitions(n)).select("features", "label", *(["fold"] if grid else [])).persist(KEPT_ROWS)
    grid_df = fold_df = None
    if grid:
        cv = training.cross_validate(tr, Pipeline(stages=[est]), grid, task, "label", num_folds, "fold", parallelism)
        fitted, best, grid_df, fold_df = cv.model, cv.best_params, cv.grid_metrics, cv.fold_metrics
    else:
        fitted = training.without_summary(Pipeline(stages=[est]).fit(tr), tr.sparkSession)
        best = {k: est.getOrDefault(est.getParam(k)) for k in ("numTrees", "maxDepth") if est.hasParam(k)}
    preds = fitted.transform(source.test)
    tr.unpersist()
    model = PipelineModel(stages=[*source.stages.stages, *fitted.stages])
    return TrainResult(run_id or uuid.uuid4().hex, model, source.features, best, grid_df, fold_df, preds, task, "label", extra={"training_rows": n})


def log_lines(result: TrainResult, store: RegistryStore) -> DataFrame:
    """K-4: the run's rows (params, hold-out metrics, decision) as text lines,
    in the order kind, key."""
    rows = store.runs().where(F.col("run_id") == result.run_id).select("run_id", "kind", "key", "value")
    if result.decision is not None:
        said = store.spark.createDataFrame([(result.run_id, "tag", "decision", result.decision), (result.run_id, "tag", "version", str(result.version))], rows.schema)
        rows = rows.unionByName(said)
    return sinks.format_lines(rows.orderBy("kind", "key"), ["run_id", "kind", "key", "value"], sep=" | ")


def log_training_run(result: TrainResult, store: RegistryStore, event_id: int, grid: dict | None) -> None:
    """R-1 / R-2: params and hold-out metrics of the run, appended to ``runs``."""
    spark = store.spark
    params = {f"best_{k}": str(v) for k, v in result.best_params.items()}
    params.update({f"{k}_options": str(v) for k, v in (grid or {}).items()})
    params["num_features"] = str(len(result.features))
    params.update({k: str(v) for k, v in result.extra.items()})
    p_rows = spark.createDataFrame(
        [(result.run_id, "param", k, v, None, event_id) for k, v in sorted(params.items())],
        "run_id string, kind string, key string, value string, num_value double, event_id bigint",
    )
    mcols = [c for c in result.holdout_metrics.columns if c != "n_rows"]
    m_rows = registry.run_rows(
        result.holdout_metrics, F.lit(result.run_id), F.lit(event_id).cast("bigint"), metrics=mcols
    )
    store.append_runs(p_rows.unionByName(m_rows))


def register_and_promote(
    result: TrainResult, store: RegistryStore, model_name: str, metric: str, higher_is_better: bool,
    event_id: int,
) -> tuple[int, str]:
    """R-6 + R-7/R-8: save and register the model, compare with the current
    champion, append the alias event (champion or challenger)."""
    version = store.register_model(result.model, model_name, result.run_id, event_id)
    spark = store.spark
    champs = registry.champion_metrics(store.alias_events(), store.versions(), store.runs(), [metric]).where(
        F.col("model") == model_name
    )
    # Without a hold-out of both classes, or without any, there is no metric:
    # the rule then compares a null, and the version still gets its alias.
    held = result.holdout_metrics.select(F.col(metric).cast("double")).first()
    cand = spark.createDataFrame([(model_name, version, held[0] if held else None)], f"model string, version int, {metric} double")
    row = registry.promote_new(cand, champs, metric, higher_is_better).first()
    store.set_alias(model_name, row["alias"], version, event_id)
    result.version, result.decision = version, row["decision"]
    return version, row["decision"]
