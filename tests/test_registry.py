"""Registry tables: alias resolution, promotion rules, swap, retraining."""

from pyspark.sql import functions as F

from orchard.operators import registry

RUNS = "run_id string, kind string, key string, value string, num_value double, event_id bigint"


def _tables(spark):
    versions = spark.createDataFrame(
        [("m", 1, "r1", "p1", 1), ("m", 2, "r2", "p2", 2), ("m", 3, "r3", "p3", 3), ("n", 1, "s1", "q1", 4)],
        "model string, version int, run_id string, path string, event_id bigint",
    )
    runs = spark.createDataFrame(
        [("r1", "metric", "auc", "0.7", 0.7, 1), ("r2", "metric", "auc", "0.7", 0.7, 2),
         ("r3", "metric", "auc", "0.8", 0.8, 3), ("s1", "param", "x", "1", None, 4)],
        RUNS,
    )
    aliases = spark.createDataFrame(
        [(1, "m", "champion", 1), (2, "m", "challenger", 2), (3, "m", "challenger", 3)],
        "event_id bigint, model string, alias string, version int",
    )
    return versions, runs, aliases


def test_resolve_latest_wins(spark):
    _, _, aliases = _tables(spark)
    cur = {(r.model, r.alias): r.version for r in registry.resolve_aliases(aliases).collect()}
    assert cur == {("m", "champion"): 1, ("m", "challenger"): 3}


def test_champion_metrics_with_missing(spark):
    v, r, a = _tables(spark)
    cm = {x.model: x for x in registry.champion_metrics(a, v, r, ["auc"]).collect()}
    assert cm["m"].champion_version == 1 and cm["m"].auc == 0.7
    assert cm["n"].champion_version is None and cm["n"].auc is None


def test_promotion_history_strict(spark):
    v, r, _ = _tables(spark)
    h = {(x.model, x.version): x.decision for x in registry.promotion_history(v, r, "auc", True).collect()}
    # v2 equals the best so far -> stays challenger (strict comparison)
    assert h[("m", 1)] == "champion" and h[("m", 2)] == "challenger" and h[("m", 3)] == "champion"
    assert h[("n", 1)] == "NO_METRIC"


def test_promote_new_first_and_missing_baseline(spark):
    v, r, a = _tables(spark)
    champs = registry.champion_metrics(a, v, r, ["auc"])
    cand = spark.createDataFrame([("m", 4, 0.75), ("n", 2, 0.9), ("z", 1, 0.5)], "model string, version int, auc double")
    d = {x.model: x for x in registry.promote_new(cand, champs, "auc", True).collect()}
    assert d["m"].decision == "IMPROVED" and d["m"].alias == "champion"
    assert abs(d["m"].improvement_pct - (0.75 - 0.7) / 0.7 * 100) < 1e-9
    assert d["n"].decision == "FIRST_MODEL"  # n has versions but no champion alias
    assert d["z"].decision == "FIRST_MODEL"


def test_alias_swap_appends_and_keeps_history(spark):
    _, _, a = _tables(spark)
    cur = registry.resolve_aliases(a)
    dec = spark.createDataFrame([("m", "PROMOTE")], "model string, decision string")
    ev = registry.alias_swap_events(cur, dec, 10)
    after = {(x.model, x.alias): x.version for x in registry.resolve_aliases(a.unionByName(ev)).collect()}
    assert after[("m", "champion")] == 3 and after[("m", "challenger")] == 3
    assert a.unionByName(ev).count() == 4


def test_register_numbers_after_max(spark):
    v, _, _ = _tables(spark)
    new = spark.createDataFrame([("m", "r9", "p", 20), ("m", "r10", "p", 21), ("new", "x", "p", 22)],
                                "model string, run_id string, path string, event_id bigint")
    got = {x.run_id: x.version for x in registry.register(v, new).collect()}
    assert got == {"r9": 4, "r10": 5, "x": 1}


def test_retraining_report(spark):
    v, _, a = _tables(spark)
    runs = spark.createDataFrame(
        [("r1", "metric", "rmse", "2", 2.0, 1), ("r3", "metric", "rmse", "1.5", 1.5, 3), ("s1", "metric", "rmse", "1", 1.0, 4)],
        RUNS,
    )
    rep = {x.model: x.status for x in registry.retraining_report(v, runs, a, "rmse").collect()}
    assert rep == {"m": "IMPROVED", "n": "NO_DATA"}


def test_run_rows_long_form(spark):
    df = spark.createDataFrame([(1, 0.5, "PROMOTE")], "id int, rmse double, decision string")
    rows = registry.run_rows(df, F.lit("run"), F.lit(7).cast("bigint"), metrics=["rmse"], tags=["decision"]).collect()
    assert [(r.kind, r.key, r.value) for r in rows] == [("metric", "rmse", "0.500000"), ("tag", "decision", "PROMOTE")]
