"""Hot-group-safe prefix aggregates equal a plain window (brute force)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from orchard.operators.scan import prefix_aggregate, row_number_within, slice_bounds, with_slice


def _data(spark, n=3000, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one group owns about a third of the rows
        g = "hot" if rng.random() < 0.34 else f"g{rng.randint(0, 40)}"
        v = None if rng.random() < 0.05 else rng.uniform(-5, 5)
        rows.append((g, i, v))
    return spark.createDataFrame(rows, "g string, o bigint, v double")


def test_row_number_matches_window(spark):
    df = _data(spark)
    a = row_number_within(df, ["g"], "o", "rn", slices=7)
    b = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    j = a.join(b, ["g", "o"])
    assert j.count() == df.count()
    assert j.where("rn <> rn2").count() == 0


def test_exclusive_max_min_sum(spark):
    df = _data(spark)
    out = prefix_aggregate(
        df, ["g"], "o",
        [("mx", "max", F.col("v")), ("mn", "min", F.col("v")), ("sm", "sum", F.col("v"))],
        inclusive=False, slices=5,
    ).toPandas().sort_values(["g", "o"])
    for g, part in out.groupby("g"):
        vals = part["v"].tolist()
        for k, (_, row) in enumerate(part.iterrows()):
            prev = [x for x in vals[:k] if x == x and x is not None]
            exp_mx = max(prev) if prev else None
            exp_mn = min(prev) if prev else None
            exp_sm = sum(prev) if prev else 0.0
            assert (row.mx is None or row.mx != row.mx) == (exp_mx is None)
            if exp_mx is not None:
                assert abs(row.mx - exp_mx) < 1e-12 and abs(row.mn - exp_mn) < 1e-12
            assert abs(row.sm - exp_sm) < 1e-9


def test_global_group_and_ties(spark):
    # no group columns; equal order values with a tiebreak column
    rows = [(i // 3, i) for i in range(300)]
    df = spark.createDataFrame(rows, "o bigint, t bigint")
    a = row_number_within(df, [], "o", "rn", slices=6, tiebreak=["t"])
    got = {r.t: r.rn for r in a.collect()}
    assert got == {t: t + 1 for t in range(300)}


def test_slice_expression_is_monotone(spark):
    df = spark.range(1000).withColumn("x", (F.col("id") * 7919 % 1000).cast("double"))
    b = slice_bounds(df, "x", 10)
    assert b == sorted(b) and 1 <= len(b) <= 9
    s = with_slice(df, "x", b, "s").groupBy("s").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    parts = sorted((r.s, r.lo, r.hi) for r in s.collect())
    for (s1, _, hi1), (s2, lo2, _) in zip(parts, parts[1:]):
        assert s1 < s2 and hi1 < lo2


def test_infinite_order_values(spark):
    from orchard.operators import metrics
    from orchard.operators.scan import row_number_within

    inf = float("inf")
    rows = [("a", v) for v in [inf] * 20 + [-inf] * 20 + [float(i) for i in range(10)]]
    df = spark.createDataFrame(rows, "g string, x double")
    assert sorted(r["row_number"] for r in row_number_within(df, ["g"], "x", slices=8).collect()) == list(range(1, 51))
    scored = spark.createDataFrame([(1.0, inf)] * 20 + [(0.0, -inf)] * 20 + [(1.0, 0.5), (0.0, 0.4)], "label double, score double")
    assert metrics.auc(scored).first()["auc"] == 1.0
