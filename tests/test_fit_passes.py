"""What a partitioned write and a fit without a search leave out: the sort of
all rows by folder and the fold hash of every row."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from orchard.operators import split, training
from orchard.plans import train as train_plan
from orchard.session import fresh_path
from orchard.sources import sinks

AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def rows(spark):
    """300 rows, three of them incomplete, some keys twice or null."""
    x = F.col("id").cast("double")
    return spark.range(300).select(
        F.when(F.col("id") % 50 != 7, F.col("id") % 290).alias("k"),
        F.when(F.col("id") % 100 != 3, x % 17).alias("a"), (x % 5).alias("b"), (x % 17 * 2 + x % 5).alias("y"),
    )


@pytest.fixture
def set_during_write(spark, monkeypatch):
    seen, plain = [], DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        seen.append(spark.conf.get(AT_ONCE, "0"))
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def test_partitioned_writes_do_not_sort(spark, rows, set_during_write):
    before = spark.conf.get(AT_ONCE, None)
    sinks.write_parquet(rows.withColumn("side", F.col("b") > 2), fresh_path(spark, "sides"), partition_by=["side"])
    train_plan.write_processed(rows, "y", ["k"], fresh_path(spark, "processed"))
    assert set_during_write[:2] == [str(sinks.FOLDERS_AT_ONCE)] * 2
    assert spark.conf.get(AT_ONCE, None) == before


def test_setting_returns_after_a_failed_write(spark):
    before = spark.conf.get(AT_ONCE, None)
    with pytest.raises(ZeroDivisionError), sinks.few_folders(spark):
        1 / 0
    assert spark.conf.get(AT_ONCE, None) == before


def test_more_folders_than_are_open_at_once(spark, rows):
    path = sinks.write_parquet(rows.coalesce(1), fresh_path(spark, "many"), partition_by=["a"])
    back = spark.read.parquet(path).select(*rows.columns)
    assert rows.select("a").distinct().count() > sinks.FOLDERS_AT_ONCE
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_a_fit_without_a_search_hashes_no_folds(spark, rows, monkeypatch):
    path = fresh_path(spark, "processed")
    counts = train_plan.write_processed(rows, "y", ["k"], path)

    def no_folds(*args, **kwargs):
        raise AssertionError("folds are for a search")

    monkeypatch.setattr(split, "with_folds", no_folds)
    small = {"numTrees": 3, "maxDepth": 3}
    raw = train_plan.train(rows, training.REGRESSION, "y", ["k"], params=small)
    stored = train_plan.train_processed(train_plan.read_processed(spark, path), training.REGRESSION, params=small)
    assert counts["dropped_rows"] == 3
    assert raw.extra["training_rows"] == stored.extra["training_rows"] == counts["train_rows"]
    assert raw.holdout_metrics.first()["n_rows"] == stored.holdout_metrics.first()["n_rows"] == counts["test_rows"]
    assert raw.best_params == stored.best_params == small
