"""Student-t p-value: known values, brute-force integration, another evaluation
of the continued fraction; worker functions without the package."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.functions.stats import ln_gamma_ratio, t_pvalue


def p_values(spark, pairs):
    df = spark.createDataFrame([(i, t, v) for i, (t, v) in enumerate(pairs)], "i int, t double, v double")
    return [r["p"] for r in df.select("i", t_pvalue(F.col("t"), F.col("v")).alias("p")).orderBy("i").collect()]


def by_hand(t, v):
    """The same tail by the other classic route: the fraction from its far end."""
    a, b, x = v / 2, 0.5, v / (v + t * t)
    flip = not x < (a + 1) / (a + b + 2)
    if flip:
        a, b, x = b, a, t * t / (v + t * t)
    f = 1.0
    for m in range(4000, 0, -1):
        f = 1 + m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) / f
        f = 1 - (a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1)) / f
    ln = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + (v / 2) * -math.log1p(t * t / v) + 0.5 * math.log(t * t / (v + t * t))
    part = math.exp(ln) / a / f
    return 1 - part if flip else part


def _t_density(x, v):
    return math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2) - 0.5 * math.log(v * math.pi)
                    - (v + 1) / 2 * math.log1p(x * x / v))


def _brute_p(t, v, n=200000):
    # 2 * integral_{|t|}^{inf}, substitution x = |t| + w / (1 - w)
    w = np.linspace(0.0, 1.0, n + 1)[:-1]
    x = abs(t) + w / (1 - w)
    g = np.array([_t_density(xi, v) for xi in x]) / (1 - w) ** 2
    h = 1.0 / n
    return 2 * h * (g.sum() - 0.5 * g[0])


def test_against_integration(spark):
    pairs = [(1.0, 3.0), (2.0, 10.0), (2.228, 10.0), (-3.5, 42.7), (5.0, 1998.0)]
    for p, (t, v) in zip(p_values(spark, pairs), pairs):
        assert abs(p - _brute_p(t, v)) < 1e-6


def test_against_another_evaluation(spark):
    pairs = [(t, v) for t in (1e-6, 0.01, 0.5, 1.0, 2.0, 3.3, -7.0, 30.0, 400.0) for v in (0.7, 1.0, 2.0, 9.5, 100.0, 1998.0, 25_000.0)]
    for p, (t, v) in zip(p_values(spark, pairs), pairs):
        assert p == pytest.approx(by_hand(t, v), rel=1e-9 if v > 5000 else 1e-11, abs=1e-12), (t, v)


def test_known_values(spark):
    nan, inf = float("nan"), float("inf")
    p = p_values(spark, [(2.2281388520, 10.0), (0.0, 7.0), (1e9, 7.0), (nan, 7.0), (1.0, -1.0), (inf, 3.0), (None, 3.0), (1.0, None), (1.0, 1.0)])
    assert p[0] == pytest.approx(0.05, abs=1e-9) and p[1] == 1.0 and p[2] < 1e-12
    assert math.isnan(p[3]) and math.isnan(p[4]) and p[5] == 0.0 and p[6] is None and p[7] is None
    assert p[8] == pytest.approx(0.5, abs=1e-12)  # a quarter of the Cauchy distribution on each side


def test_ln_gamma_ratio(spark):
    a = [0.05, 0.5, 1.0, 3.25, 40.0, 999.0, 1e6]
    got = spark.createDataFrame([(x,) for x in a], "a double").select(ln_gamma_ratio(F.col("a")).alias("g")).collect()
    for x, r in zip(a, got):
        assert r["g"] == pytest.approx(math.lgamma(x + 0.5) - math.lgamma(x), rel=1e-9)


def test_p_value_starts_no_python(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "t double, v double").select(t_pvalue(F.col("t"), F.col("v")).alias("p"))
    assert "Python" not in df._jdf.queryExecution().toString()


def test_worker_functions_need_no_package(tmp_path):
    """The bootstrap draw runs in Python workers; it is shipped by value, so a
    process without this package can run it."""
    import subprocess
    import sys
    from functools import partial

    from pyspark import cloudpickle

    from orchard.operators.bootstrap import draw_cells

    blob = tmp_path / "f.pkl"
    blob.write_bytes(cloudpickle.dumps(partial(draw_cells, seg=[], names=("a", "b"), seed=1)))
    code = (
        "import pickle, sys, pandas as pd\n"
        "assert not any('orchard' in m for m in sys.modules)\n"
        "f = pickle.load(open(sys.argv[1], 'rb'))\n"
        "row = {f'c{k}': [10] for k in range(8)} | {'replicate': [0], '_salt': [7]}\n"
        "out = next(f(iter([pd.DataFrame(row)])))\n"
        "print(int(out[['tp_a', 'fn_a']].sum(axis=1).iloc[0]) > 0)\n"
    )
    out = subprocess.run([sys.executable, "-c", code, str(blob)], cwd=str(tmp_path),
                         capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == "True"
