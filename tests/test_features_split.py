"""Feature edge cases, column choice, hash split properties, scaler."""

import datetime as dt

import pytest

from orchard.functions.features import add_calendar, derive_features, numeric_columns
from orchard.operators import profile, split
from orchard.operators.scaling import fit_scaler
from orchard.sources.readers import METRICS_CSV_SCHEMA, read_csv

from conftest import SF_SMALL


def _rows(spark):
    rows = [
        (1, 0, 10.0, None, 5.0, 7.0),   # null cpu
        (2, 3600 * 5, 11.0, 0.0, 5.0, 7.0),  # zero cpu
        (3, 86400 * 40, 12.0, -2.0, 5.0, 7.0),  # negative cpu
        (4, 86400 * 400, 13.0, 4.0, 5.0, 8.0),
    ]
    return spark.createDataFrame(
        rows, "id int, timestamp int, query_latency double, cpu_utilization double, "
              "memory_utilization double, system_load double"
    )


def test_guarded_ratio_and_calendar(spark):
    out = {r.id: r for r in derive_features(_rows(spark)).collect()}
    assert out[1].load_per_core == 0.0 and out[2].load_per_core == 0.0 and out[3].load_per_core == 0.0
    assert out[4].load_per_core == pytest.approx(2.0)
    assert out[1].cpu_memory_product is None
    # epoch seconds, UTC: 1970-01-01 is a Thursday (dayofweek 5)
    assert (out[1].hour, out[1].day_of_week, out[1].month) == (0, 5, 1)
    assert out[2].hour == 5
    assert "timestamp" not in derive_features(_rows(spark)).columns


def test_calendar_only_when_column_exists(spark):
    df = _rows(spark).drop("timestamp")
    assert add_calendar(df).columns == df.columns


def test_string_timestamps(spark):
    df = spark.createDataFrame([("2024-03-05 17:00:00",)], "timestamp string")
    r = add_calendar(df).first()
    assert (r.hour, r.day_of_week, r.month) == (17, 3, 3)


def test_numeric_columns_excludes_strings_and_timestamps(spark):
    df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1), 2.0, True)], "k int, s string, t timestamp, x double, b boolean")
    assert numeric_columns(df, exclude=["k"]) == ["x", "b"]


def test_hash_split_disjoint_complete_and_partition_free(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    a = split.with_split(li, keys).select(*keys, "split")
    b = split.with_split(li.repartition(13), keys).select(*keys, "split")
    assert a.exceptAll(b).count() == 0
    tr, te = split.hash_split(li, keys)
    assert tr.count() + te.count() == li.count()
    assert tr.join(te, keys, "inner").count() == 0
    frac = te.count() / li.count()
    assert 0.17 < frac < 0.23


def test_folds_cover_train(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    tr, _ = split.hash_split(li, keys)
    sizes = {r.fold: r.n_rows for r in split.fold_sizes(split.with_folds(tr, keys)).collect()}
    assert set(sizes) == {0, 1, 2} and sum(sizes.values()) == tr.count()


def test_scaler_constant_column_and_values(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    sc = fit_scaler(df, ["x", "c"])
    out = sc.transform(df).collect()
    assert [r.c for r in out] == [0.0, 0.0, 0.0]
    assert [round(r.x, 12) for r in out] == [-1.0, 0.0, 1.0]


def test_null_and_column_profile(spark):
    df = _rows(spark)
    nulls = {r.column_name: r.null_count for r in profile.null_profile(df).collect()}
    assert nulls["cpu_utilization"] == 1 and nulls["id"] == 0
    prof = {r.column_name: r for r in profile.column_profile(df).collect()}
    assert prof["memory_utilization"].is_constant and not prof["id"].is_constant
    assert prof["cpu_utilization"].n_distinct == 3 and prof["cpu_utilization"].min_value == -2.0


def test_csv_reader_requires_schema_or_infer(spark, tmp_path):
    p = str(tmp_path / "m.csv")
    with open(p, "w") as f:
        f.write(",".join(x.name for x in METRICS_CSV_SCHEMA.fields) + "\r\n")
        f.write("0,1,22.5,35.1,21.7,80.2,5.5,529.8,3,39.3,29.7,0\r\n")
    df = read_csv(spark, p, schema=METRICS_CSV_SCHEMA)
    r = derive_features(df).first()
    assert r.node_id == 1 and r.load_per_core == pytest.approx(39.3 / 35.1)
    with pytest.raises(ValueError):
        read_csv(spark, p)
    assert read_csv(spark, p, infer=True).schema["active_queries"].dataType.simpleString() == "int"
