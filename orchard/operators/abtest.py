"""A/B comparison of a champion and a challenger.

All functions work per segment in one job; the reference's single global
comparison is the case ``segments=[]``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.functions.stats import cohens_d, t_pvalue, welch_dof, welch_t

PROMOTE, KEEP, SKIPPED = "PROMOTE", "KEEP_CHAMPION", "SKIPPED"
ALPHA = 0.05
GAIN_INTERVAL = (0.025, 0.975)


def replicate_summary(
    reps: DataFrame, segments: list[str] | None = None, a: str = "champion", b: str = "challenger"
) -> DataFrame:
    """B-4: replicate means, population sds, sample variances, improvement;
    Q-8: the share of replicates in which the challenger gains nothing, and the
    interval that holds the middle 95 % of its gains (exact order statistics,
    neighbours interpolated, over the replicates of one segment)."""
    seg = segments or []
    fa, fb = F.col(f"f1_{a}"), F.col(f"f1_{b}")
    return reps.groupBy(*seg).agg(
        F.count(F.lit(1)).alias("n_replicates"),
        F.avg(fa).alias(f"mean_{a}"),
        F.avg(fb).alias(f"mean_{b}"),
        F.stddev_pop(fa).alias(f"sd_{a}"),
        F.stddev_pop(fb).alias(f"sd_{b}"),
        F.var_samp(fa).alias(f"var_{a}"),
        F.var_samp(fb).alias(f"var_{b}"),
        F.avg(F.when(fb > fa, 0.0).otherwise(1.0)).alias("share_without_gain"),
        F.percentile(fb - fa, GAIN_INTERVAL[0]).alias("gain_low"),
        F.percentile(fb - fa, GAIN_INTERVAL[1]).alias("gain_high"),
    ).withColumn("f1_improvement", F.col(f"mean_{b}") - F.col(f"mean_{a}"))


def welch_test(summary: DataFrame, a: str = "champion", b: str = "challenger", with_p: bool = True) -> DataFrame:
    """B-2: Welch's t-test of challenger against champion replicates."""
    n = F.col("n_replicates").cast("double")
    out = summary.withColumns(
        {
            "t_stat": welch_t(F.col(f"mean_{b}"), F.col(f"var_{b}"), n, F.col(f"mean_{a}"), F.col(f"var_{a}"), n),
            "dof": welch_dof(F.col(f"var_{b}"), n, F.col(f"var_{a}"), n),
        }
    )
    if with_p:
        out = out.withColumn("p_value", t_pvalue(F.col("t_stat"), F.col("dof")))
    return out


def with_effect_size(summary: DataFrame, a: str = "champion", b: str = "challenger") -> DataFrame:
    """B-3: Cohen's d with population sds; null when both sds are 0."""
    return summary.withColumn(
        "effect_size", cohens_d(F.col(f"mean_{b}"), F.col(f"sd_{b}"), F.col(f"mean_{a}"), F.col(f"sd_{a}"))
    )


def with_decision(tested: DataFrame, a: str = "champion", b: str = "challenger", alpha: float = ALPHA) -> DataFrame:
    """B-5 significance (p < alpha and challenger mean higher), B-6 decision."""
    sig = F.coalesce((F.col("p_value") < alpha) & (F.col(f"mean_{b}") > F.col(f"mean_{a}")), F.lit(False))
    return tested.withColumn("is_significant", sig).withColumn(
        "decision", F.when(sig, F.lit(PROMOTE)).otherwise(F.lit(KEEP))
    )


def decide_regression(
    metrics_long: DataFrame,
    segments: list[str] | None = None,
    model_col: str = "model",
    a: str = "champion",
    b: str = "challenger",
) -> DataFrame:
    """B-7 / B-8: PROMOTE when the challenger's RMSE is strictly lower.

    ``metrics_long`` has one row per (segment, model) with rmse, mae, r2.  A
    segment without a challenger row is reported as SKIPPED, without one
    failing the whole job.
    """
    seg = segments or []
    key = seg or ["_all"]
    if not seg:
        metrics_long = metrics_long.withColumn("_all", F.lit(0))
    wide = metrics_long.groupBy(*key).agg(
        *[
            F.max(F.when(F.col(model_col) == m, F.col(k))).alias(f"{m}_{k}")
            for m in (a, b)
            for k in ("rmse", "mae", "r2")
        ]
    )
    ca, cb = F.col(f"{a}_rmse"), F.col(f"{b}_rmse")
    decision = (
        F.when(cb.isNull() | ca.isNull(), F.lit(SKIPPED))
        .when(cb < ca, F.lit(PROMOTE))
        .otherwise(F.lit(KEEP))
    )
    improvement = F.when(ca != 0, (ca - cb) / ca * 100.0)
    out = wide.withColumn("decision", decision).withColumn("rmse_improvement_pct", improvement)
    return out.drop("_all") if not seg else out


def ab_report(
    cls_metrics_long: DataFrame,
    auc_long: DataFrame,
    tested: DataFrame,
    segments: list[str] | None = None,
    model_col: str = "model",
    a: str = "champion",
    b: str = "challenger",
    champion_uri: str = "",
    challenger_uri: str = "",
) -> DataFrame:
    """B-9: one report row per segment, metrics side by side plus the test.

    ``cls_metrics_long`` / ``auc_long``: one row per (segment, model);
    ``tested``: output of ``with_decision`` (one row per segment).  All three
    are per-segment tables, so the joins are small.
    """
    seg = segments or []
    key = seg or ["_all"]

    def keyed(df):
        return df if seg else df.withColumn("_all", F.lit(0))

    m = keyed(cls_metrics_long).join(keyed(auc_long).select(*key, model_col, "auc"), [*key, model_col], "left")
    side = m.groupBy(*key).agg(
        *[
            F.max(F.when(F.col(model_col) == mm, F.col(src))).alias(f"{mm}_{dst}")
            for mm in (a, b)
            for src, dst in (("auc", "auc"), ("f1_weighted", "f1"), ("accuracy", "accuracy"))
        ],
        F.max("n_rows").alias("test_set_size"),
    )
    report = side.join(keyed(tested), key, "inner").select(
        *seg,
        f"{a}_auc", f"{a}_f1", f"{a}_accuracy",
        f"{b}_auc", f"{b}_f1", f"{b}_accuracy",
        "f1_improvement", "p_value", "effect_size", "is_significant", "decision",
        "share_without_gain", "gain_low", "gain_high",
        F.col("test_set_size").cast("bigint").alias("test_set_size"),
        F.lit(champion_uri).alias(f"{a}_model"),
        F.lit(challenger_uri).alias(f"{b}_model"),
    )
    return report
