"""Standardisation in column form.

``fit`` is one aggregation (mean and sample standard deviation of every
column) whose single result row — two numbers per column, bounded by the
schema, not by the data — becomes literals in ``transform``.  That is what
``pyspark.ml.feature.StandardScaler`` does with vectors; the column form keeps
named columns and plain SQL semantics.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnScaler:
    columns: tuple[str, ...]
    means: tuple[float | None, ...]
    stds: tuple[float | None, ...]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """``(x - mean) / std``; a zero-variance column maps to 0.0."""
        exprs = {}
        for c, m, s in zip(self.columns, self.means, self.stds):
            x = F.col(c).cast("double")
            if m is None or s is None:
                exprs[c + suffix] = F.lit(None).cast("double")
            elif s == 0.0:
                exprs[c + suffix] = F.lit(0.0)
            else:
                exprs[c + suffix] = (x - F.lit(m)) / F.lit(s)
        return df.withColumns(exprs)


def fit_scaler(df: DataFrame, columns: list[str]) -> ColumnScaler:
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return ColumnScaler(
        tuple(columns),
        tuple(row[f"m{i}"] for i in range(len(columns))),
        tuple(row[f"s{i}"] for i in range(len(columns))),
    )


# --------------------------------------------------------------------------
# Statistics kept per slice of the data (a day, a load), merged on demand
# --------------------------------------------------------------------------


def moments(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """``by…, column_name, n, mean, m2``: row count, mean and sum of squared
    deviations of each column's non-null values per slice, in one pass.  Append
    the rows of new slices to a table and old data is never read again."""
    x = [F.col(c).cast("double") for c in columns]
    parts = [
        F.struct(F.lit(c).alias("column_name"), F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"))
        for c, v in zip(columns, x)
    ]
    return df.groupBy(*by).agg(F.array(*parts).alias("_m")).select(*by, F.explode("_m").alias("_m")).select(*by, "_m.*")


def write_moments(rows: DataFrame, columns: list[str], by: list[str], path: str) -> str:
    """Add or replace the slices that ``rows`` holds; other slices stay."""
    moments(rows, columns, by).write.mode("overwrite").partitionBy(*by).option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def merge_moments(table: DataFrame) -> DataFrame:
    """``column_name, n, mean, m2`` over all slices by the pairwise formula:
    two parts with means m1, m2 have the joint mean m1 + d n2 / n and the joint
    sum of squares s1 + s2 + d² n1 n2 / n, d = m2 - m1.  Deviations are added,
    never squares of the values, so nothing cancels.  The list that is folded
    holds one entry a slice and column."""
    part = F.struct("n", "mean", "m2")
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def both(a, b):
        n = a["n"] + b["n"]
        d = b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + d * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + d * d * a["n"] * b["n"] / n).alias("m2"),
        )

    folded = table.where(F.col("n") > 0).groupBy("column_name").agg(F.aggregate(F.array_sort(F.collect_list(part)), zero, both).alias("all"))
    return folded.select("column_name", "all.*")


def scaler_from_moments(merged: DataFrame, columns: list[str]) -> ColumnScaler:
    """The scaler that ``fit_scaler`` would fit on all slices' rows."""
    rows = {r["column_name"]: r for r in merged.collect()}  # one row a column
    found = [rows.get(c) for c in columns]
    return ColumnScaler(
        tuple(columns),
        tuple(r["mean"] if r else None for r in found),
        tuple((r["m2"] / (r["n"] - 1)) ** 0.5 if r and r["n"] > 1 else None for r in found),
    )
