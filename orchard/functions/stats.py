"""Statistical column functions for the A/B comparison.

Welch's t statistic and its degrees of freedom are plain column arithmetic.
The two-sided p-value needs the Student-t tail, which Spark SQL lacks: it is the
regularised incomplete beta function ``I_x(dof/2, 1/2)``, whose continued
fraction runs as an ``aggregate`` over a sequence, so no Python worker starts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms of the ratio's logarithm that are taken one by one before the
# asymptotic series (in 1/a) takes over; from there its error is below 1e-15.
_SHIFT = 20
# ln(Gamma(a + 1/2) / Gamma(a)) = ln(a) / 2 + sum of c / a^k.
_RATIO_SERIES = {1: -1 / 8, 3: 1 / 192, 5: -1 / 640, 7: 17 / 14336, 9: -31 / 18432}
_TINY = 1e-300


def ln_gamma_ratio(a: Column) -> Column:
    """``ln(Gamma(a + 1/2) / Gamma(a))`` for a > 0, without the cancellation of
    two large logarithms."""
    z = a + F.lit(float(_SHIFT))
    series = F.log(z) / F.lit(2.0)
    for k, c in _RATIO_SERIES.items():
        series = series + F.lit(c) / F.pow(z, F.lit(float(k)))
    steps = F.aggregate(F.sequence(F.lit(0), F.lit(_SHIFT - 1)), F.lit(0.0), lambda s, k: s - F.log1p(F.lit(0.5) / (a + k)))
    return series + steps


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function by Lentz's method.

    The state (c, d, h, gap) takes one partial fraction a step; once a step
    changes h by less than a rounding, it stays.  The steps that can be needed
    grow with the root of a + b; a fraction that has not settled raises."""
    steps = F.sequence(F.lit(1), F.ceil(F.lit(200.0) + F.lit(40.0) * F.sqrt(a + b)).cast("int"))
    q = a + b
    first = F.lit(1.0) - q * x / (a + F.lit(1.0))

    def nonzero(v: Column) -> Column:
        return F.when(F.abs(v) > _TINY, v).otherwise(F.lit(_TINY))

    def state(c, d, h, gap):
        return F.struct(c.alias("c"), d.alias("d"), h.alias("h"), gap.alias("gap"))

    def step(s: Column, k: Column) -> Column:
        m = F.floor((k + 1) / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (q + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        term = F.when(k % 2 == 1, even).otherwise(odd)
        return F.when(s["gap"] < 1e-16, s).otherwise(_advance(s, term, k))

    def _advance(s: Column, term: Column, k: Column) -> Column:
        d = F.lit(1.0) / nonzero(F.lit(1.0) + term * s["d"])
        c = nonzero(F.lit(1.0) + term / s["c"])
        # Only a whole pair of steps tells whether the fraction has settled.
        gap = F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.abs(c * d - F.lit(1.0)))
        return state(c, d, s["h"] * c * d, gap)

    d0 = F.lit(1.0) / nonzero(first)
    last = F.aggregate(steps, state(F.lit(1.0), d0, d0, F.lit(1.0)), step)
    return F.when(last["gap"] < 1e-13, last["h"]).otherwise(F.raise_error(F.lit("the continued fraction of the p-value did not settle")).cast("double"))


def t_pvalue(t: Column, dof: Column) -> Column:
    """Two-sided p-value of Student's t, ``P(|T| >= |t|)``; null when t or dof
    is null (e.g. zero variance), NaN when either is NaN or dof is not
    positive, 0 for an infinite t."""
    a, t2 = dof / F.lit(2.0), t * t
    x, rest = dof / (dof + t2), t2 / (dof + t2)
    front = F.exp(ln_gamma_ratio(a) - F.lit(0.5 * math.log(math.pi)) - a * F.log1p(t2 / dof) + F.log(rest) / F.lit(2.0))
    direct = x < (a + F.lit(1.0)) / (a + F.lit(2.5))
    one, other = F.when(direct, a).otherwise(F.lit(0.5)), F.when(direct, F.lit(0.5)).otherwise(a)
    tail = front * _beta_fraction(one, other, F.when(direct, x).otherwise(rest)) / one
    p = F.when(direct, tail).otherwise(F.lit(1.0) - tail)
    nan = F.lit(float("nan"))
    return (
        F.when(t.isNull() | dof.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(t) | F.isnan(dof) | (dof <= 0), nan)
        .when(t == 0, F.lit(1.0))
        .when(rest >= 1.0, F.lit(0.0))
        .when(F.abs(t) == float("inf"), F.lit(0.0))
        .otherwise(p)
    )


def welch_t(mean_a: Column, var_a: Column, n_a: Column, mean_b: Column, var_b: Column, n_b: Column) -> Column:
    """Welch's t for ``a - b`` (sample variances); null if both variances are 0."""
    se2 = var_a / n_a + var_b / n_b
    return F.when(se2 > 0, (mean_a - mean_b) / F.sqrt(se2))


def welch_dof(var_a: Column, n_a: Column, var_b: Column, n_b: Column) -> Column:
    """Welch–Satterthwaite degrees of freedom."""
    qa, qb = var_a / n_a, var_b / n_b
    den = qa * qa / (n_a - 1) + qb * qb / (n_b - 1)
    return F.when(den > 0, (qa + qb) * (qa + qb) / den)


def cohens_d(mean_a: Column, sd_a: Column, mean_b: Column, sd_b: Column) -> Column:
    """Effect size with the pooled population sd; null when it is 0."""
    pooled = F.sqrt((sd_a * sd_a + sd_b * sd_b) / 2.0)
    return F.when(pooled > 0, (mean_a - mean_b) / pooled)
