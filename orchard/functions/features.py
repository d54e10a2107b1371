"""Feature column expressions.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen and fuse into one projection with the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the derived features, in the order they are added.
CALENDAR_FEATURES = ["hour", "day_of_week", "month"]
INTERACTION_FEATURE = "cpu_memory_product"
RATIO_FEATURE = "load_per_core"
TIME_COLUMN = "timestamp"


def event_time(col: str | Column, dtype: T.DataType) -> Column:
    """P-7: a timestamp from a timestamp, a string, or epoch seconds.

    Integer timestamps are read as seconds since the epoch (what an implicit
    cast did before ANSI mode); strings go through ``to_timestamp``.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp")
    if isinstance(dtype, T.NumericType):
        return F.timestamp_seconds(c)
    return F.to_timestamp(c)


def calendar_columns(ts: Column) -> dict[str, Column]:
    """P-4, P-5, P-6: hour, day of week (1 = Sunday ... 7 = Saturday), month."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "month": F.month(ts),
    }


def interaction(a: str = "cpu_utilization", b: str = "memory_utilization") -> Column:
    """P-9: product of two utilisation columns."""
    return F.col(a) * F.col(b)


def guarded_ratio(num: str = "system_load", den: str = "cpu_utilization") -> Column:
    """P-10: ``num / den`` when ``den > 0``, else 0 (null/zero/negative -> 0).

    The branch guard keeps the division out of ANSI divide-by-zero errors.
    """
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(F.lit(0.0))


def derivation_sql(schema: T.StructType, time_col: str = TIME_COLUMN) -> list[str]:
    """P-11 as SQL select items, the one place where the derivation is written:
    models save them as a stage, ``derive_features`` applies them.

    Calendar features appear when the time column exists, the interaction and
    the guarded ratio when their inputs do; a table without any of them is left
    as it is.  Times are read in UTC whatever the session's zone.
    """
    names, items = schema.fieldNames(), ["*"]
    if time_col in names:
        t, dt = f"`{time_col}`", schema[time_col].dataType
        if isinstance(dt, T.NumericType):
            day = f"date_from_unix_date(CAST(floor({t} / 86400) AS INT))"
            hour = f"CAST(pmod(floor({t} / 3600), 24) AS INT)"
        else:
            if isinstance(dt, T.TimestampType):
                t = f"to_utc_timestamp({t}, current_timezone())"
            elif not isinstance(dt, T.TimestampNTZType):
                t = f"to_timestamp_ntz({t})"
            day, hour = t, f"hour({t})"
        items += [f"{hour} AS hour", f"dayofweek({day}) AS day_of_week", f"month({day}) AS month"]
    if {"cpu_utilization", "memory_utilization"} <= set(names):
        items.append(f"cpu_utilization * memory_utilization AS {INTERACTION_FEATURE}")
    if {"cpu_utilization", "system_load"} <= set(names):
        items.append(f"CASE WHEN cpu_utilization > 0 THEN system_load / cpu_utilization ELSE 0.0 END AS {RATIO_FEATURE}")
    return items


def add_calendar(df: DataFrame, time_col: str = TIME_COLUMN, drop_source: bool = True) -> DataFrame:
    """P-8: calendar features only if the time column exists; then drop it."""
    if time_col not in df.columns:
        return df
    ts = event_time(time_col, df.schema[time_col].dataType)
    out = df.withColumns(calendar_columns(ts))
    return out.drop(time_col) if drop_source else out


def derive_features(df: DataFrame, time_col: str = TIME_COLUMN) -> DataFrame:
    """P-11: the full feature derivation, one ``DataFrame -> DataFrame`` step.

    The same select items are saved in models, so training, A/B evaluation and
    batch scoring cannot drift apart.
    """
    return df.selectExpr(*derivation_sql(df.schema, time_col)).drop(time_col)


# --------------------------------------------------------------------------
# Column choice (P-2, P-3)
# --------------------------------------------------------------------------


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    """P-2: feature columns chosen by type: numeric or boolean, not excluded.

    Strings, timestamps, dates, arrays and vectors are left out (an assembler
    rejects timestamps).
    """
    ex = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in ex and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def all_but(df: DataFrame, exclude: list[str] | tuple[str, ...]) -> list[str]:
    """P-3: every column except the label (and keys)."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]
