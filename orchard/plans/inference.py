"""Batch inference (C-3) and the retraining comparison (R-11)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orchard.operators import registry, scoring
from orchard.sources import sinks
from orchard.sources.models import RegistryStore


def batch_score(
    data: DataFrame,
    store: RegistryStore,
    model_name: str,
    keep: list[str],
    output_path: str,
    score_date: str,
    log_path: str | None = None,
) -> DataFrame:
    """Resolve ``models:/<name>@champion`` -> load -> score -> Parquet,
    partitioned by score date, key columns kept (Q-6).

    The saved pipeline derives its own features from the raw columns, so the
    input is the same raw table the model was trained on (no skew, Q-1).
    Scoring a date again replaces that date; other dates stay.  ``log_path``
    gets the run's log lines (K-4); their figures are observed while the
    predictions are written, so the model runs once over the rows.
    """
    found = store.resolve(model_name, "champion")
    if found is None:
        raise ValueError(f"no champion registered for {model_name}")
    if not score_date:
        raise ValueError("score_date is needed: it names the partition to write")
    version, path = found
    keep = keep or list(data.columns)  # Q-6: without keys a row is known by its raw columns
    preds = scoring.score(PipelineModel.load(path), data, keep=keep).withColumn("score_date", F.lit(score_date))
    seen = Observation("predictions")
    p = F.col("prediction")
    watched = preds.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(p.isNull()).alias("null_predictions"), F.min(p).alias("min_prediction"), F.avg(p).alias("mean_prediction"), F.max(p).alias("max_prediction"))
    sinks.write_parquet(watched, output_path, partition_by=["score_date"], mode="overwrite")
    if log_path:
        told = {"model": f"models:/{model_name}@champion", "version": version, "score_date": score_date, **seen.get, "output": output_path}
        rows = store.spark.createDataFrame([(i, k, str(v)) for i, (k, v) in enumerate(told.items())], "n int, key string, value string")
        sinks.write_text(sinks.format_lines(rows.orderBy("n"), ["key", "value"], sep=" | "), log_path)
    return preds


def retraining_summary(store: RegistryStore, metric: str = "rmse") -> DataFrame:
    """R-11 over the store's tables: IMPROVED / NOT_IMPROVED / NO_DATA per model."""
    return registry.retraining_report(store.versions(), store.runs(), store.alias_events(), metric)
