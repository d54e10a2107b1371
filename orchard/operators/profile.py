"""Profiling.

Every profile is one pass over the input (``unpivot`` to long form where a
value per column is needed) — not one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_count(df: DataFrame) -> DataFrame:
    """F-1 as a one-row DataFrame (composable, unlike ``df.count()``)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def null_rows(df: DataFrame, cols: str | list[str]) -> DataFrame:
    """F-3: rows where any of ``cols`` is null — one scan with one OR filter
    (pushed to the Parquet reader), not one scan per column."""
    names = [cols] if isinstance(cols, str) else list(cols)
    cond = F.col(f"`{names[0]}`").isNull()
    for c in names[1:]:
        cond = cond | F.col(f"`{c}`").isNull()
    return df.where(cond)


def null_profile(df: DataFrame) -> DataFrame:
    """F-2: null count of every column in one pass.

    Returns ``column_name, null_count, has_nulls`` (the reference warns when a
    count is above zero; here the flag is a column).
    """
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column_name", "null_count")
    return long.withColumn("has_nulls", F.col("null_count") > 0)


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, (T.NumericType, T.BooleanType))


def column_profile(df: DataFrame) -> DataFrame:
    """F-4: schema listing as a profile, one row per column.

    ``column_name, data_type, null_count, n_distinct, min_value, max_value,
    is_constant``.  min/max are given for numeric and boolean columns (as
    double); ``is_constant`` flags zero-variance columns, e.g. calendar
    features of data that all fall on one hour.

    One pass over the input: every row is unpivoted to one ``(column_name,
    num, txt)`` entry per column — numeric/boolean values as double in
    ``num``, the rest as string in ``txt``, so no number is formatted as
    text — and counted per distinct entry (partial aggregation map-side, so
    the shuffle carries distinct values, not rows).  Null counts, exact
    distinct counts and min/max are read off that table.
    """
    fields = df.schema.fields
    names = [f.name for f in fields]
    entries = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        none = {"whole": F.lit(None).cast("bigint"), "num": F.lit(None).cast("double"), "txt": F.lit(None).cast("string")}
        if isinstance(f.dataType, (T.IntegralType, T.BooleanType)):
            none |= {"whole": c.cast("bigint"), "num": c.cast("double")}  # whole numbers stay exact
        elif isinstance(f.dataType, T.DecimalType):
            none |= {"num": c.cast("double"), "txt": c.cast("string")}
        elif _is_numeric(f.dataType):
            none["num"] = c.cast("double")
        else:
            none["txt"] = c.cast("string")
        entries.append(F.struct(*[v.alias(k) for k, v in none.items()]).alias(f.name))
    long = df.select(*entries).unpivot([], names, "column_name", "e").select("column_name", "e.whole", "e.num", "e.txt")
    per_value = long.groupBy("column_name", "whole", "num", "txt").agg(F.count(F.lit(1)).alias("n"))
    is_null = F.col("num").isNull() & F.col("txt").isNull()
    per_column = per_value.groupBy("column_name").agg(
        F.sum(F.when(is_null, F.col("n")).otherwise(F.lit(0))).cast("bigint").alias("null_count"),
        F.count_if(~is_null).cast("bigint").alias("n_distinct"),
        F.min("num").alias("min_value"),
        F.max("num").alias("max_value"),
    )
    # The column list (from the schema, not the data) keeps every column in
    # the profile, also for an empty input.
    listing = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in fields], "column_name string, data_type string"
    )
    out = listing.join(per_column, "column_name", "left").withColumns(
        {
            "null_count": F.coalesce(F.col("null_count"), F.lit(0)).cast("bigint"),
            "n_distinct": F.coalesce(F.col("n_distinct"), F.lit(0)).cast("bigint"),
        }
    )
    return out.withColumn("is_constant", F.col("n_distinct") <= 1).select(
        "column_name", "data_type", "null_count", "n_distinct", "min_value", "max_value", "is_constant"
    )


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """F-5: first ``n`` rows in key order (a stable ``show(5)``).

    Planned as a top-k (``TakeOrderedAndProject``): each task keeps ``n`` rows.
    """
    return df.orderBy(*order_by).limit(n)


# --------------------------------------------------------------------------
# F-4 by sketches: bounded state per column, mergeable over slices
# --------------------------------------------------------------------------

#: State sizes: 2^12 registers (distinct counts), k = 400 (quantiles).
DISTINCT_LOG_K, QUANTILE_K = 12, 400
#: What the states promise: three standard errors of the distinct count
#: (0.78 / sqrt(2^12) each way of the union form), the 99 % rank error.
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (DISTINCT_LOG_K / 2), 0.01


def column_sketches(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """``by…, column_name, n_rows, null_count, distinct, quantiles, min_value,
    max_value``: one row per slice and column with mergeable sketches in place
    of the values, so the shuffle carries a state of bounded size per task and
    column whatever the data.  A mode of its own, chosen by the caller."""
    parts = []
    for f in df.schema.fields:
        if f.name in by:
            continue
        c = F.col(f"`{f.name}`")
        number = c.cast("double") if _is_numeric(f.dataType) else F.lit(None).cast("double")
        parts.append(F.struct(
            F.lit(f.name).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(c.isNull()).alias("null_count"),
            F.hll_sketch_agg(c.cast("string"), DISTINCT_LOG_K).alias("distinct"),
            F.kll_sketch_agg_double(number, QUANTILE_K).alias("quantiles"),
            F.min(number).alias("min_value"), F.max(number).alias("max_value")))
    return df.groupBy(*by).agg(F.array(*parts).alias("_s")).select(*by, F.explode("_s").alias("_s")).select(*by, "_s.*")


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column over all slices, sketches merged."""
    return sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"))


def sketch_profile(merged: DataFrame, quantiles: list[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column_name, n_rows, null_count, n_distinct, min_value, max_value, q…``
    read off merged sketches: distinct counts within ``DISTINCT_ERROR`` of the
    truth, quantiles within ``RANK_ERROR`` of their rank; null for columns that
    are not numbers or hold none."""
    has = F.kll_sketch_get_n_double("quantiles") > 0
    return merged.select(
        "column_name", "n_rows", "null_count", F.hll_sketch_estimate("distinct").alias("n_distinct"), "min_value", "max_value",
        *[F.when(has, F.kll_sketch_get_quantile_double("quantiles", F.lit(q))).alias(f"q{round(100 * q)}") for q in quantiles])
