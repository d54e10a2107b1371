"""Running (prefix) aggregates that survive a hot group.

``Window.partitionBy(g).orderBy(o)`` puts every row of a group into one task.
If one model, user or score range holds a third of the data, that task sorts a
third of the data alone.  ``prefix_aggregate`` computes the same running
aggregate in three distributed steps:

1. cut the order column into *slices* at approximate quantiles (one small
   sketch job; the boundaries, at most ``slices`` numbers, go to a
   ``Bucketizer``).  A hot group is thereby split into up
   to ``slices`` pieces of bounded size;
2. aggregate each ``(group, slice)`` and compute, on that small table, the
   carry-in from earlier slices of the same group;
3. run the window inside each ``(group, slice)`` and add the carry-in.

The slice of a row is a pure function of its order value, so every branch of
the plan (and every retry of a task) agrees on it.  Only associative
operators are supported (sum, count, max, min); the order column must be
numeric and, together with ``tiebreak`` columns, give a total order inside
each group when the exact per-row result matters.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.session import shuffle_partitions

_OPS = {
    "sum": F.sum,
    "count": F.count,
    "max": F.max,
    "min": F.min,
}

# How a carry-in combines with the in-slice running value.
_COMBINE = {
    "sum": lambda carry, local: F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0)),
    "count": lambda carry, local: F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0)),
    "max": lambda carry, local: F.greatest(carry, local),
    "min": lambda carry, local: F.least(carry, local),
}

# How per-slice totals are merged into the carry (count totals are summed).
_MERGE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def slice_bounds(df: DataFrame, order_col: str, slices: int, accuracy: int = 10000) -> list[float]:
    """Approximate quantile cut points of ``order_col`` (at most slices - 1).
    Infinite values belong to the first and last slice and give no cut."""
    if slices <= 1:
        return []
    probs = [i / slices for i in range(1, slices)]
    row = df.select(
        F.percentile_approx(F.col(order_col).cast("double"), probs, accuracy).alias("q")
    ).first()
    qs = row["q"] if row is not None else None
    return sorted({float(q) for q in qs if q is not None and math.isfinite(q)}) if qs else []


def with_slice(df: DataFrame, order_col: str, bounds: list[float], out: str = "_slice") -> DataFrame:
    """Add index ``i`` with ``bounds[i-1] <= x < bounds[i]`` by binary search in
    the JVM, whatever the number of slices.  Nulls go to slice 0, matching
    ``ORDER BY ... ASC NULLS FIRST``; NaN to the last."""
    if not bounds:
        return df.withColumn(out, F.lit(0))
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="_order", outputCol="_bucket", handleInvalid="keep")
    placed = cut.transform(df.withColumn("_order", F.col(order_col).cast("double")))
    index = F.when(F.col("_order").isNull(), F.lit(0)).otherwise(F.col("_bucket").cast("int"))
    return placed.withColumn(out, index).drop("_order", "_bucket")


def prefix_aggregate(
    df: DataFrame,
    group_cols: list[str],
    order_col: str,
    specs: list[tuple[str, str, str | Column]],
    inclusive: bool = True,
    slices: int | None = None,
    tiebreak: list[str] | None = None,
    bounds: list[float] | None = None,
) -> DataFrame:
    """Add running aggregates ``specs = [(out_col, op, value), ...]``.

    ``inclusive`` includes the current row (``ROWS UNBOUNDED PRECEDING``);
    otherwise the frame ends one row before it (``... AND 1 PRECEDING``), so the
    first row of a group gets null for max/min and 0 for sum/count.
    ``bounds`` may be given (e.g. quantiles taken from a cheaper source);
    otherwise they are computed from ``df``.
    """
    for _, op, _ in specs:
        if op not in _OPS:
            raise ValueError(f"unsupported prefix op {op!r}")
    n = slices or shuffle_partitions(df.sparkSession)
    if bounds is None:
        bounds = slice_bounds(df, order_col, n)
    sliced = with_slice(df, order_col, bounds)
    order_exprs = [F.col(order_col)] + [F.col(c) for c in (tiebreak or [])]

    # Per (group, slice) totals and the carry-in from earlier slices.
    totals = sliced.groupBy(*group_cols, "_slice").agg(
        *[_OPS[op](value).alias(f"_tot_{out}") for out, op, value in specs]
    )
    w_slices = (
        Window.partitionBy(*group_cols)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        *group_cols,
        "_slice",
        *[_MERGE[op](f"_tot_{out}").over(w_slices).alias(f"_carry_{out}") for out, op, _ in specs],
    )

    end = Window.currentRow if inclusive else -1
    w_local = (
        Window.partitionBy(*group_cols, "_slice")
        .orderBy(*order_exprs)
        .rowsBetween(Window.unboundedPreceding, end)
    )
    local = sliced.select(
        "*", *[_OPS[op](value).over(w_local).alias(f"_local_{out}") for out, op, value in specs]
    )
    # Null groups are groups too: null-safe equality on every key.
    renamed = carry.select(*[F.col(c).alias(f"_k_{c}") for c in [*group_cols, "_slice"]], *[c for c in carry.columns if c.startswith("_carry_")])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*group_cols, "_slice"]])
    joined = local.join(renamed, on=on, how="left")
    out_cols = [
        _COMBINE[op](F.col(f"_carry_{out}"), F.col(f"_local_{out}")).alias(out)
        for out, op, _ in specs
    ]
    drop = ["_slice"] + [f"_k_{c}" for c in [*group_cols, "_slice"]] + [f"_carry_{o}" for o, _, _ in specs] + [f"_local_{o}" for o, _, _ in specs]
    return joined.select(*[c for c in joined.columns if c not in drop], *out_cols)


def row_number_within(
    df: DataFrame, group_cols: list[str], order_col: str, out_col: str = "row_number",
    slices: int | None = None, tiebreak: list[str] | None = None,
) -> DataFrame:
    """``row_number() over (partition by group order by order)``, hot-group safe."""
    return prefix_aggregate(
        df, group_cols, order_col, [(out_col, "count", F.lit(1))], inclusive=True, slices=slices,
        tiebreak=tiebreak,
    )
