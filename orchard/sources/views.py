"""Views that map the driver's test tables onto the job inputs.

* ``metrics_view``  – per-measurement metrics with ``query_latency`` as label
  (regression jobs), built from ``lineitem``;
* ``label_view``    – the same rows with a binary ``fraud`` label
  (classification jobs);
* ``registry_*``    – model versions, runs and alias events built from
  ``events`` (one event = one registered version; purchase/view events move
  the champion/challenger alias).

Each view keeps the source key columns so that splits are reproducible and
predictions can be joined back to their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators.scan import row_number_within

# Key columns of the metrics view (lineitem line identity).
METRICS_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

# Event types that move an alias, and the alias they move.
ALIAS_OF_EVENT = {"purchase": "champion", "view": "challenger"}


def _metric_columns() -> list:
    return [
        *METRICS_KEYS,
        F.col("l_shipdate").alias("timestamp"),
        (F.col("l_suppkey") % 5 + 1).alias("node_id"),
        F.col("l_extendedprice").alias("query_latency"),
        (F.col("l_discount") * 100).alias("cpu_utilization"),
        F.col("l_quantity").alias("memory_utilization"),
        (F.col("l_tax") * 100).alias("system_load"),
    ]


def metrics_view(lineitem: DataFrame) -> DataFrame:
    """Raw metrics rows: timestamp, node, latency label and utilisation columns."""
    return lineitem.select(*_metric_columns())


def label_view(lineitem: DataFrame, extra: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Metrics rows plus the binary label ``fraud`` (returned lines).

    ``extra`` keeps further source columns unchanged (e.g. string columns).
    """
    return lineitem.select(
        *_metric_columns(), (F.col("l_returnflag") == "R").cast("int").alias("fraud"), *extra
    )


def signal_view(lineitem: DataFrame) -> DataFrame:
    """Metrics rows whose ``query_latency`` depends on the utilisation columns
    (the test table's own columns are independent of each other), with a rest
    that none of them explains."""
    latency = F.lit(2.0) * F.col("l_quantity") + F.lit(300.0) * F.col("l_tax") + F.col("l_extendedprice") / F.lit(10000.0)
    return lineitem.select(*_metric_columns(), latency.alias("_latency")).withColumn("query_latency", F.col("_latency")).drop("_latency")


def signal_labels(lineitem: DataFrame) -> DataFrame:
    """The same rows with ``fraud`` = a latency above 70 in place of the latency."""
    rows = signal_view(lineitem)
    return rows.withColumn("fraud", (F.col("query_latency") > 70.0).cast("int")).drop("query_latency")


# --------------------------------------------------------------------------
# Registry tables from ``events``
# --------------------------------------------------------------------------


def _registry_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("model"),
        F.concat(F.lit("run_"), F.col("event_id").cast("string")).alias("run_id"),
        "event_type",
        F.col("value").alias("metric"),
    )


def registry_versions(events: DataFrame) -> DataFrame:
    """``model_versions``: every event registers the next version of its model.

    Version numbers are a running count per model in event order, computed
    with the hot-group-safe prefix count (one model may own most events).
    """
    ev = _registry_events(events)
    numbered = row_number_within(ev, ["model"], "event_id", out_col="version")
    return numbered.select(
        "model",
        F.col("version").cast("int").alias("version"),
        "run_id",
        F.concat(F.lit("models/"), F.col("model"), F.lit("/v"), F.col("version").cast("string")).alias(
            "path"
        ),
        "event_id",
        "event_type",
        "metric",
    )


def registry_runs(events: DataFrame) -> DataFrame:
    """``runs`` in long form: one row per (run, kind, key).

    Each event's value is logged as both an ``auc`` metric (higher is better)
    and an ``rmse`` metric (lower is better) so both promotion rules can be
    exercised; the event type is logged as a parameter.
    """
    ev = _registry_events(events)
    metrics = ev.select(
        "run_id",
        F.lit("metric").alias("kind"),
        F.explode(F.array(F.lit("auc"), F.lit("rmse"))).alias("key"),
        F.col("metric").cast("string").alias("value"),
        F.col("metric").alias("num_value"),
        "event_id",
    )
    params = ev.select(
        "run_id",
        F.lit("param").alias("kind"),
        F.lit("event_type").alias("key"),
        F.col("event_type").alias("value"),
        F.lit(None).cast("double").alias("num_value"),
        "event_id",
    )
    return metrics.unionByName(params)


def registry_alias_events(versions: DataFrame) -> DataFrame:
    """``alias_events``: purchase -> champion, view -> challenger, on that version."""
    mapping = F.create_map(*[x for kv in ALIAS_OF_EVENT.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return versions.where(F.col("event_type").isin(list(ALIAS_OF_EVENT))).select(
        "event_id", "model", mapping[F.col("event_type")].alias("alias"), "version"
    )
