"""Model quality metrics as aggregations.

Every metric takes optional ``segments`` (grouping columns) and computes all
segments in one job.  A null segment is a segment; rows whose label or
prediction is null count in no metric (``n_rows`` counts the complete ones).  Classification metrics share one pass over the scored
rows: they are read off the confusion counts, which are tiny.  AUC aggregates
to distinct scores first and then runs a hot-group-safe prefix sum, so it
never needs a single-task global window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.operators.scan import prefix_aggregate, slice_bounds
from orchard.session import shuffle_partitions


def _safe_div(num: Column, den: Column, zero: Column | None = None) -> Column:
    """``num / den``; when ``den`` is 0 returns ``zero`` (default null)."""
    return F.when(den != 0, num / den).otherwise(zero if zero is not None else F.lit(None))


# --------------------------------------------------------------------------
# A-8 confusion counts and the metrics read off them (A-2, A-3, A-4)
# --------------------------------------------------------------------------


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which a null key matches a null key; keys come from ``left``."""
    other = right.select(*[F.col(k).alias(f"_j_{k}") if k in keys else F.col(k) for k in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys])
    return left.join(other, on, how).drop(*[f"_j_{k}" for k in keys])


def confusion_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction", segments: list[str] | None = None
) -> DataFrame:
    """A-8: ``segments…, label, prediction, n`` (partial aggregation map-side)."""
    seg = segments or []
    return df.groupBy(*seg, F.col(label).cast("double").alias("label"),
                      F.col(prediction).cast("double").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    segments: list[str] | None = None,
    positive: float = 1.0,
) -> DataFrame:
    """A-2 accuracy, A-3 weighted F1 (all classes), A-4 positive-class F1.

    Weighted F1 follows ``MulticlassClassificationEvaluator("f1")``: each class
    seen in the labels contributes F1 * (its share of rows); precision or
    recall with an empty denominator is 0 and F1 with ``p + r = 0`` is 0.
    Positive-class F1 is ``2tp / (2tp + fp + fn)``, 0 when undefined.
    """
    seg = segments or []
    # Without segments, group on a constant so the final join has a key.
    key = seg or ["_all"]
    if not seg:
        df = df.withColumn("_all", F.lit(0))
    df = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    cc = confusion_counts(df, label, prediction, key)
    # Per-class counts: one row per (segment, class) from the tiny table.
    by_actual = cc.groupBy(*key, F.col("label").alias("cls")).agg(
        F.sum("n").alias("actual"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"),
    )
    by_pred = cc.groupBy(*key, F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    per_class = null_safe_join(by_actual, by_pred, [*key, "cls"], "left").fillna(0, subset=["predicted"])
    precision = _safe_div(F.col("tp").cast("double"), F.col("predicted").cast("double"), F.lit(0.0))
    recall = _safe_div(F.col("tp").cast("double"), F.col("actual").cast("double"), F.lit(0.0))
    per_class = per_class.withColumn("p", precision).withColumn("r", recall).withColumn(
        "f1", F.when(F.col("p") + F.col("r") == 0, F.lit(0.0)).otherwise(
            F.lit(2.0) * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))
        )
    )
    weighted = per_class.groupBy(*key).agg(
        F.sum("actual").alias("_n"),
        F.sum(F.col("f1") * F.col("actual")).alias("_f1w"),
    )
    totals = cc.groupBy(*key).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("n_correct"),
        F.sum(F.when((F.col("label") == positive) & (F.col("prediction") == positive), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when((F.col("label") != positive) & (F.col("prediction") == positive), F.col("n")).otherwise(0)).alias("fp"),
        F.sum(F.when((F.col("label") == positive) & (F.col("prediction") != positive), F.col("n")).otherwise(0)).alias("fn"),
    )
    out = null_safe_join(totals, weighted, key, "inner")
    return out.select(
        *seg,
        "n_rows",
        (F.col("n_correct") / F.col("n_rows")).alias("accuracy"),
        (F.col("_f1w") / F.col("_n")).alias("f1_weighted"),
        _safe_div(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0.0)).alias("f1_positive"),
        "tp",
        "fp",
        "fn",
    )


# --------------------------------------------------------------------------
# A-1 area under ROC
# --------------------------------------------------------------------------


def auc(
    df: DataFrame, label: str = "label", score: str = "score", segments: list[str] | None = None
) -> DataFrame:
    """A-1: area under the ROC curve, exact, ties counted one half.

    Equals the trapezoid ROC area of ``BinaryClassificationEvaluator`` with
    ``numBins=0``: ``sum over positives of (#neg below + 0.5 #neg equal) / (P N)``.
    Plan: aggregate to distinct (segment, score) -> running sum of negatives
    (range-partitioned prefix sum, no single-task window) -> one aggregate.
    """
    seg = segments or []
    df = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    is_pos = F.col(label).cast("double") == 1.0
    per_score = df.groupBy(*seg, F.col(score).cast("double").alias("_s")).agg(
        F.sum(F.when(is_pos, 1).otherwise(0)).cast("double").alias("_pos"),
        F.sum(F.when(is_pos, 0).otherwise(1)).cast("double").alias("_neg"),
    )
    # Slice boundaries come from the raw scores (one scan, no second run of
    # the distinct-score aggregation).
    n = shuffle_partitions(df.sparkSession)
    bounds = slice_bounds(df.select(F.col(score).cast("double").alias("_s")), "_s", n)
    ranked = prefix_aggregate(
        per_score, seg, "_s", [("_neg_below", "sum", F.col("_neg"))], inclusive=False, bounds=bounds
    )
    summed = ranked.groupBy(*seg).agg(
        F.sum(F.col("_pos") * (F.col("_neg_below") + F.lit(0.5) * F.col("_neg"))).alias("_u"),
        F.sum("_pos").alias("n_pos"),
        F.sum("_neg").alias("n_neg"),
    )
    return summed.select(
        *seg,
        _safe_div(F.col("_u"), F.col("n_pos") * F.col("n_neg")).alias("auc"),
        F.col("n_pos").cast("bigint").alias("n_pos"),
        F.col("n_neg").cast("bigint").alias("n_neg"),
    )


# --------------------------------------------------------------------------
# A-5, A-6, A-7 regression metrics
# --------------------------------------------------------------------------


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", segments: list[str] | None = None
) -> DataFrame:
    """A-5 RMSE, A-6 MAE, A-7 R² in one aggregation.

    R² = 1 - SSE / SST with SST = sum((y - mean y)²) = var_samp(y) (n - 1),
    as in ``RegressionEvaluator("r2")``; null when SST is 0.
    """
    seg = segments or []
    df = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    agg = df.groupBy(*seg).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(err * err).alias("_sse"),
        F.avg(F.abs(err)).alias("mae"),
        F.var_samp(F.col(label).cast("double")).alias("_var"),
    )
    sst = F.col("_var") * (F.col("n_rows") - 1)
    return agg.select(
        *seg,
        "n_rows",
        F.sqrt(F.col("_sse") / F.col("n_rows")).alias("rmse"),
        "mae",
        (F.lit(1.0) - _safe_div(F.col("_sse"), sst)).alias("r2"),
    )
