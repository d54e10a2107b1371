"""Table-fitted reference models used as champion / challenger stand-ins.

The exact (SQL-checkable) metric and A/B queries need predictions whose value
an independent engine can reproduce.  These models are fitted with one
``groupBy`` aggregation on the training side and applied with a lookup join;
the forests of ``orchard.operators.training`` are used by the full jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def fit_group_line(train: DataFrame, label: str, x: str, group: list[str]) -> DataFrame:
    """Least-squares line ``label ~ a + b x`` per group (closed form), in one
    aggregation.  ``_my`` is the group's mean label, so the same table also
    serves the mean-per-group predictor."""
    y = F.col(label).cast("double")
    xv = F.col(x).cast("double")
    return train.groupBy(*group).agg(
        F.covar_samp(xv, y).alias("_cov"),
        F.var_samp(xv).alias("_var"),
        F.avg(xv).alias("_mx"),
        F.avg(y).alias("_my"),
    ).select(
        *group,
        F.when(F.col("_var") > 0, F.col("_cov") / F.col("_var")).otherwise(F.lit(0.0)).alias("_slope"),
        "_mx",
        "_my",
    )


def score_mean_and_line(
    df: DataFrame, fitted: DataFrame, x: str, group: list[str],
    mean_out: str = "pred_champion", line_out: str = "pred_challenger",
) -> DataFrame:
    """Both regression stand-ins from one fitted table and one lookup join:
    the group mean (``mean_out``) and the group line (``line_out``)."""
    joined = df.join(fitted, group, "left")
    line = F.col("_my") + F.col("_slope") * (F.col(x).cast("double") - F.col("_mx"))
    return joined.withColumns({mean_out: F.col("_my"), line_out: line}).drop("_slope", "_mx", "_my")


# The two linear scorers standing in for the classification
# champion (discount-driven) and challenger (quantity-driven), and the cut.
CHAMPION_SCORE = ("cpu_utilization", 10.0)
CHALLENGER_SCORE = ("memory_utilization", 50.0)
SCORE_CUT = 0.5


def fixed_score(col: str, scale: float):
    return F.col(col).cast("double") / F.lit(scale)


def score_two_classifiers(df: DataFrame) -> DataFrame:
    """C-2 for the fixed scorers: both models' score and 0/1 prediction side
    by side in one projection (no join)."""
    sa = fixed_score(*CHAMPION_SCORE)
    sb = fixed_score(*CHALLENGER_SCORE)
    return df.withColumns(
        {
            "score_champion": sa,
            "pred_champion": (sa >= SCORE_CUT).cast("double"),
            "score_challenger": sb,
            "pred_challenger": (sb >= SCORE_CUT).cast("double"),
        }
    )
