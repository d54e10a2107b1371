"""Sinks.

Reports and log lines are DataFrames computed by aggregations, so they are
written by executors like any other table; nothing is assembled from driver
lists.  Append-only registry tables use ``mode("append")``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Folders (sides, dates) that a task of a partitioned write fills at once.
FOLDERS_AT_ONCE = 4
_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def few_folders(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes to a few folders, without sorting all rows by folder
    first.  Spark sorts what is left of a task that meets more folders."""
    before = spark.conf.get(_AT_ONCE, None)
    spark.conf.set(_AT_ONCE, str(FOLDERS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.unset(_AT_ONCE) if before is None else spark.conf.set(_AT_ONCE, before)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """K-1 / K-2: Parquet, optionally partitioned (e.g. by score date).
    Overwriting a partitioned table replaces only the partitions in ``df``."""
    w = df.write.mode(mode)
    if not partition_by:
        w.parquet(path)
        return path
    with few_folders(df.sparkSession):
        w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K-3: JSON lines (the A/B report)."""
    df.write.mode(mode).json(path)
    return path


def format_lines(df: DataFrame, columns: list[str], sep: str = " ") -> DataFrame:
    """K-4: one string column ``line`` from the given columns."""
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("line"))


def write_text(lines: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K-4: text sink of a single string column."""
    if len(lines.columns) != 1:
        raise ValueError("text sink needs exactly one string column")
    lines.write.mode(mode).text(path)
    return path


def append_table(df: DataFrame, path: str) -> str:
    """Append rows to a registry table (runs, model_versions, alias_events).

    Appends are not transactional on plain Parquet: keep one writer per model
    and derive current state from event order (see ``operators.registry``).
    """
    df.write.mode("append").parquet(path)
    return path


def save_model(model, path: str, overwrite: bool = True) -> str:
    """K-5: model directory; without ``overwrite`` an existing one raises."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
    return path
