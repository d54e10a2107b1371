"""Bootstrap determinism and statistics; A/B decisions and edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.functions.hashing import STREAM_PRIME, poisson_cdf_thresholds, poisson_weight, stream_words
from orchard.operators import abtest, bootstrap


def _pairs(spark, n=3000, seed=11):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1.0 if rng.random() < 0.3 else 0.0
        a = y if rng.random() < 0.7 else 1.0 - y
        b = y if rng.random() < 0.8 else 1.0 - y
        rows.append((i, i % 3, y, a, b))
    return spark.createDataFrame(rows, "k bigint, seg int, label double, pa double, pb double")


def test_poisson_weights_have_mean_and_variance_one(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a, b = stream_words(["k"], 42)
    w = df.select(F.explode(F.sequence(F.lit(0), F.lit(4))).alias("r"), a.alias("a"), b.alias("b")).select(
        poisson_weight(F.col("a"), F.col("b"), F.col("r")).alias("w")
    )
    st = w.agg(F.avg("w").alias("m"), F.var_pop("w").alias("v")).first()
    assert abs(st.m - 1.0) < 0.02 and abs(st.v - 1.0) < 0.04
    cuts = poisson_cdf_thresholds()
    assert cuts == sorted(cuts) and cuts[-1] == STREAM_PRIME  # no draw lies above the last cut


def test_multinomial_is_partition_independent(spark):
    df = _pairs(spark)
    a = bootstrap.multinomial_bootstrap(df, "label", "pa", "pb", ["seg"], replicates=50)
    b = bootstrap.multinomial_bootstrap(df.repartition(7), "label", "pa", "pb", ["seg"], replicates=50)
    assert a.exceptAll(b).count() == 0 and a.count() == 150


def test_poisson_is_partition_independent(spark):
    """Weights are a function of the row key and replicate only: any input
    layout (one partition, many) gives the same replicate counts."""
    df = _pairs(spark)
    a = bootstrap.poisson_bootstrap(df.coalesce(1), ["k"], "label", "pa", "pb", ["seg"], replicates=40)
    b = bootstrap.poisson_bootstrap(df.repartition(11, "seg"), ["k"], "label", "pa", "pb", ["seg"], replicates=40)
    assert a.count() == 120 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_poisson_and_multinomial_agree_in_distribution(spark):
    df = _pairs(spark)
    p = abtest.replicate_summary(bootstrap.poisson_bootstrap(df, ["k"], "label", "pa", "pb", replicates=400)).first()
    m = abtest.replicate_summary(bootstrap.multinomial_bootstrap(df, "label", "pa", "pb", replicates=400)).first()
    for col in ("mean_champion", "mean_challenger"):
        assert abs(p[col] - m[col]) < 0.01
    for col in ("sd_champion", "sd_challenger"):
        assert p[col] == pytest.approx(m[col], rel=0.25)


def test_paired_bootstrap_uses_same_resample(spark):
    # identical models -> identical replicate F1 for both, improvement 0
    df = _pairs(spark).withColumn("pb", F.col("pa"))
    reps = bootstrap.poisson_bootstrap(df, ["k"], "label", "pa", "pb", replicates=30)
    assert reps.where("f1_champion <> f1_challenger").count() == 0
    t = abtest.with_decision(abtest.with_effect_size(abtest.welch_test(abtest.replicate_summary(reps))))
    r = t.first()
    assert r.f1_improvement == 0.0 and r.decision == abtest.KEEP


def test_zero_variance_gives_null_t_and_effect(spark):
    reps = spark.createDataFrame([(i, 0.5, 0.5) for i in range(10)], "replicate int, f1_champion double, f1_challenger double")
    r = abtest.with_decision(abtest.with_effect_size(abtest.welch_test(abtest.replicate_summary(reps)))).first()
    assert r.t_stat is None and r.effect_size is None and r.p_value is None
    assert r.is_significant is False and r.decision == abtest.KEEP


def test_significant_improvement_promotes(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(rng.normal(0.5, 0.01)), float(rng.normal(0.6, 0.01))) for i in range(200)]
    reps = spark.createDataFrame(rows, "replicate int, f1_champion double, f1_challenger double")
    r = abtest.with_decision(abtest.welch_test(abtest.replicate_summary(reps))).first()
    assert r.p_value < 1e-6 and r.decision == abtest.PROMOTE


def test_regression_decision_strict_and_skipped(spark):
    rows = [("champion", 1, 2.0, 1.0, 0.5), ("challenger", 1, 2.0, 1.0, 0.5),
            ("champion", 2, 2.0, 1.0, 0.5), ("challenger", 2, 1.5, 1.0, 0.6),
            ("champion", 3, 2.0, 1.0, 0.5)]
    df = spark.createDataFrame(rows, "model string, seg int, rmse double, mae double, r2 double")
    d = {r.seg: r for r in abtest.decide_regression(df, ["seg"]).collect()}
    assert d[1].decision == abtest.KEEP  # equal -> champion stays
    assert d[2].decision == abtest.PROMOTE and d[2].rmse_improvement_pct == pytest.approx(25.0)
    assert d[3].decision == abtest.SKIPPED
