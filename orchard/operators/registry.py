"""Tracking and registry kept as tables.

Three append-only tables replace a tracking server:

* ``runs``           run_id, kind (param|metric|tag), key, value, num_value, event_id
* ``model_versions`` model, version, run_id, path, event_id
* ``alias_events``   event_id, model, alias, version

"Current" state is derived, never updated in place: the latest alias event
of a (model, alias) wins, so moving an alias is one appended row and nothing
is ever deleted.  Every operator works on all models at once.  Per-model
running values use ``prefix_aggregate`` so one very active model does not end
up in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.operators.scan import prefix_aggregate, row_number_within

CHAMPION, CHALLENGER = "champion", "challenger"
RUN_COLUMNS = ["run_id", "kind", "key", "value", "num_value", "event_id"]


# --------------------------------------------------------------------------
# R-1, R-2, R-3: logging rows
# --------------------------------------------------------------------------


def run_rows(
    df: DataFrame,
    run_id: Column,
    event_id: Column,
    metrics: list[str] = (),
    params: list[str] = (),
    tags: list[str] = (),
) -> DataFrame:
    """Long-form ``runs`` rows from a wide result table (one run per row).

    Metrics keep a numeric value and a fixed-format text value; params and
    tags are text.  Append the result with ``sinks.append_table``.
    """
    entries = (
        [F.struct(F.lit("metric").alias("kind"), F.lit(m).alias("key"),
                  F.format_string("%.6f", F.col(m).cast("double")).alias("value"),
                  F.col(m).cast("double").alias("num_value")) for m in metrics]
        + [F.struct(F.lit("param").alias("kind"), F.lit(p).alias("key"),
                    F.col(p).cast("string").alias("value"),
                    F.lit(None).cast("double").alias("num_value")) for p in params]
        + [F.struct(F.lit("tag").alias("kind"), F.lit(t).alias("key"),
                    F.col(t).cast("string").alias("value"),
                    F.lit(None).cast("double").alias("num_value")) for t in tags]
    )
    return df.select(
        run_id.alias("run_id"), event_id.alias("event_id"), F.explode(F.array(*entries)).alias("e")
    ).select("run_id", "e.kind", "e.key", "e.value", "e.num_value", "event_id")


def run_metrics_wide(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Pivot metric rows to one row per run (explicit pivot values: no extra
    job to discover them).  A metric logged twice keeps its latest value."""
    metrics = runs.where(F.col("kind") == "metric").where(F.col("key").isin(keys))
    latest = metrics.groupBy("run_id", "key").agg(
        F.max_by("num_value", "event_id").alias("num_value")
    )
    return latest.groupBy("run_id").pivot("key", keys).agg(F.first("num_value"))


# --------------------------------------------------------------------------
# R-4, R-5: alias resolution and champion metrics
# --------------------------------------------------------------------------


def resolve_aliases(alias_events: DataFrame) -> DataFrame:
    """R-4: current version of every (model, alias): the latest event wins.

    An aggregate (``max_by``) rather than a window: partial aggregation keeps
    a hot model cheap.
    """
    return alias_events.groupBy("model", "alias").agg(
        F.max_by("version", "event_id").alias("version"),
        F.max("event_id").alias("event_id"),
    )


def champion_metrics(
    alias_events: DataFrame, versions: DataFrame, runs: DataFrame, metric_keys: list[str]
) -> DataFrame:
    """R-5: per model, the champion's version, run and metrics.

    Every registered model appears; models without a champion (or whose
    champion run lacks a metric) get nulls — the caller decides what a missing
    baseline means, instead of a swallowed exception.
    """
    models = versions.select("model").distinct()
    champ = resolve_aliases(alias_events).where(F.col("alias") == CHAMPION).select(
        "model", F.col("version").alias("champion_version")
    )
    vers = versions.select("model", F.col("version").alias("champion_version"), "run_id")
    wide = run_metrics_wide(runs, metric_keys)
    return (
        models.join(champ, "model", "left")
        .join(vers, ["model", "champion_version"], "left")
        .join(wide, "run_id", "left")
        .select("model", "champion_version", "run_id", *metric_keys)
    )


# --------------------------------------------------------------------------
# R-6: registration
# --------------------------------------------------------------------------


def next_versions(versions: DataFrame) -> DataFrame:
    """R-6: the next free version number of every model."""
    return versions.groupBy("model").agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("next_version"))


def register(versions: DataFrame, new_runs: DataFrame) -> DataFrame:
    """R-6: version rows for ``new_runs`` (model, run_id, path, event_id).

    New runs of one model are numbered after its current maximum, in event
    order; a model seen for the first time starts at 1.  Append the result to
    ``model_versions``.
    """
    base = next_versions(versions)
    numbered = row_number_within(new_runs, ["model"], "event_id", out_col="_k")
    return numbered.join(base, "model", "left").select(
        "model",
        (F.coalesce(F.col("next_version"), F.lit(1)) + F.col("_k") - 1).cast("int").alias("version"),
        "run_id",
        "path",
        "event_id",
    )


# --------------------------------------------------------------------------
# R-7, R-8, R-9: promotion rules
# --------------------------------------------------------------------------


def relative_improvement(new: Column, best: Column, higher_is_better: bool) -> Column:
    """R-9: improvement of ``new`` over ``best`` in percent (null if best is 0)."""
    diff = (new - best) if higher_is_better else (best - new)
    return F.when(best != 0, diff / best * 100.0)


def promotion_history(
    versions: DataFrame, runs: DataFrame, metric: str, higher_is_better: bool
) -> DataFrame:
    """R-7 / R-8 over a whole history: replay the promotion rule for every
    version in registration order.

    A version becomes champion when no earlier version has the metric, or when
    it strictly beats the best earlier value (the champion is always the best
    so far, because promotion needs a strict improvement); otherwise it is a
    challenger.  A version without the metric cannot be compared:
    ``NO_METRIC``.  The running best is an exclusive prefix max/min per
    model, computed without a single-task window.
    """
    wide = run_metrics_wide(runs, [metric])
    v = versions.select("model", "version", "run_id", "event_id").join(wide, "run_id", "left")
    op = "max" if higher_is_better else "min"
    hist = prefix_aggregate(v, ["model"], "event_id", [("best_before", op, F.col(metric))], inclusive=False)
    m, best = F.col(metric), F.col("best_before")
    better = (m > best) if higher_is_better else (m < best)
    decision = (
        F.when(m.isNull(), F.lit("NO_METRIC"))
        .when(best.isNull() | better, F.lit(CHAMPION))
        .otherwise(F.lit(CHALLENGER))
    )
    return hist.select(
        "model", "version", "event_id", metric, "best_before",
        decision.alias("decision"),
        relative_improvement(m, best, higher_is_better).alias("improvement_pct"),
    )


def promote_new(
    candidates: DataFrame, champions: DataFrame, metric: str, higher_is_better: bool
) -> DataFrame:
    """R-7 / R-8 for one new run per model (the training job's step).

    ``candidates``: model, version, <metric>; ``champions``: output of
    ``champion_metrics``.  No champion -> champion; a champion without the
    metric -> ``NO_BASELINE_METRIC`` (not silently promoted); else a strict
    comparison.  ``alias`` is the alias event to append.
    """
    c = champions.select("model", F.col("champion_version"), F.col(metric).alias("champion_metric"))
    j = candidates.join(c, "model", "left")
    m, best = F.col(metric), F.col("champion_metric")
    better = (m > best) if higher_is_better else (m < best)
    decision = (
        F.when(F.col("champion_version").isNull(), F.lit("FIRST_MODEL"))
        .when(best.isNull() | m.isNull(), F.lit("NO_BASELINE_METRIC"))
        .when(better, F.lit("IMPROVED"))
        .otherwise(F.lit("NOT_IMPROVED"))
    )
    alias = F.when(decision.isin("FIRST_MODEL", "IMPROVED"), F.lit(CHAMPION)).otherwise(F.lit(CHALLENGER))
    return j.select(
        "model", "version", metric, "champion_version", "champion_metric",
        decision.alias("decision"), alias.alias("alias"),
        relative_improvement(m, best, higher_is_better).alias("improvement_pct"),
    )


# --------------------------------------------------------------------------
# R-10: alias swap after an A/B win
# --------------------------------------------------------------------------


def alias_swap_events(current: DataFrame, decisions: DataFrame, event_id: int) -> DataFrame:
    """R-10: for every model whose A/B decision is PROMOTE, one new alias
    event moving ``champion`` to the current challenger version.

    ``current``: output of ``resolve_aliases``; ``decisions``: model, decision.
    ``event_id`` is the commit id of this batch (greater than every existing
    event); the old champion needs no delete because the latest event wins.
    """
    chall = current.where(F.col("alias") == CHALLENGER).select("model", F.col("version"))
    promoted = decisions.where(F.col("decision") == "PROMOTE").select("model")
    return promoted.join(chall, "model", "inner").select(
        F.lit(event_id).cast("bigint").alias("event_id"),
        "model",
        F.lit(CHAMPION).alias("alias"),
        F.col("version").cast("int").alias("version"),
    )


# --------------------------------------------------------------------------
# R-11: retraining report
# --------------------------------------------------------------------------


def retraining_report(
    versions: DataFrame, runs: DataFrame, alias_events: DataFrame, metric: str = "rmse"
) -> DataFrame:
    """R-11: compare each model's latest run with the champion it met (lower is
    better): the one in force before the latest run's own event, so a run that
    was promoted still shows what it improved on.

    ``IMPROVED`` / ``NOT_IMPROVED`` / ``NO_DATA`` (no champion then, or a metric
    is missing).
    """
    latest = versions.groupBy("model").agg(
        F.max_by("run_id", "event_id").alias("latest_run_id"),
        F.max("version").alias("latest_version"),
        F.max("event_id").alias("latest_event"),
    )
    since = latest.select(F.col("model").alias("_m"), "latest_event")
    alias_events = alias_events.join(since, (F.col("model") == F.col("_m")) & (F.col("event_id") < F.col("latest_event"))).drop("_m", "latest_event")
    wide = run_metrics_wide(runs, [metric]).select("run_id", F.col(metric).alias("new_metric"))
    champ = champion_metrics(alias_events, versions, runs, [metric]).select(
        "model", "champion_version", F.col(metric).alias("champion_metric")
    )
    j = latest.join(wide, latest.latest_run_id == wide.run_id, "left").drop("run_id").join(champ, "model", "left")
    new, old = F.col("new_metric"), F.col("champion_metric")
    status = (
        F.when(new.isNull() | old.isNull(), F.lit("NO_DATA"))
        .when(new < old, F.lit("IMPROVED"))
        .otherwise(F.lit("NOT_IMPROVED"))
    )
    return j.select(
        "model", "latest_version", "champion_version",
        F.col("new_metric").alias(f"new_{metric}"), F.col("champion_metric").alias(f"champion_{metric}"),
        status.alias("status"),
    )
