"""A/B jobs: champion against challenger on the rebuilt hold-out.

The hold-out is the hash split of the training job, so the two jobs agree on
it whatever the partitioning.  Models come from the registry by alias; a
missing challenger yields a SKIPPED report instead of an exception.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators import abtest, bootstrap, metrics, registry, scoring, split
from orchard.sources import sinks
from orchard.sources.models import RegistryStore


REPORT_SCHEMA = ", ".join(
    [f"{m}_{k} double" for m in ("champion", "challenger") for k in ("auc", "f1", "accuracy")]
    + ["f1_improvement double", "p_value double", "effect_size double", "is_significant boolean", "decision string",
       "share_without_gain double", "gain_low double", "gain_high double",
       "test_set_size bigint", "champion_model string", "challenger_model string"]
)


def _long(scored: DataFrame, label: str, segments: list[str]) -> DataFrame:
    models = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.col(f"score_{m}").alias("score"),
                     F.col(f"pred_{m}").alias("prediction"))
            for m in ("champion", "challenger")
        ]
    )
    return scored.select(*segments, F.col(label).cast("double").alias("label"), F.explode(models).alias("m")).select(
        *segments, "label", "m.*"
    )


def classification_ab(
    scored: DataFrame,
    keys: list[str],
    label: str,
    segments: list[str] | None = None,
    replicates: int = 1000,
    seed: int = 42,
    method: str = "multinomial",
    champion_uri: str = "",
    challenger_uri: str = "",
) -> DataFrame:
    """B-1 ... B-9 on a frame with ``score_*``/``pred_*`` of both models.

    ``method='multinomial'`` (B-1, cell counts + numpy draws) or ``'poisson'``
    (B-1b, hash weights, SQL-reproducible)."""
    seg = segments or []
    if method == "poisson":
        reps = bootstrap.poisson_bootstrap(scored, keys, label, "pred_champion", "pred_challenger", seg, replicates, seed)
    else:
        reps = bootstrap.multinomial_bootstrap(scored, label, "pred_champion", "pred_challenger", seg, replicates, seed)
    tested = abtest.with_decision(abtest.with_effect_size(abtest.welch_test(abtest.replicate_summary(reps, seg))))
    long = _long(scored, label, seg)
    cls = metrics.classification_metrics(long, segments=["model", *seg])
    roc = metrics.auc(long, segments=["model", *seg])
    return abtest.ab_report(cls, roc, tested, seg, champion_uri=champion_uri, challenger_uri=challenger_uri)


def run_classification_ab(
    data: DataFrame, store: RegistryStore, model_name: str, keys: list[str], label: str,
    report_path: str, log_path: str, test_size: float = 0.2, seed: int = 42, replicates: int = 1000,
    run_id: str | None = None, timestamp: str = "",
) -> DataFrame:
    """The whole job: hold-out -> two models -> report (JSON) -> run rows ->
    promotion event when significant -> log lines (text).  A skipped comparison
    gives a report of the same columns."""
    run_id = run_id or uuid.uuid4().hex
    keys = keys or list(data.columns)
    _, test = split.hash_split(data, keys, test_size, seed)
    champ, chall = load_pair(store, model_name)
    if champ is None or chall is None:
        report = data.sparkSession.createDataFrame([], REPORT_SCHEMA)
        skipped = report.sparkSession.range(1).select(F.lit(abtest.SKIPPED).alias("decision"))
        report = report.unionByName(skipped, allowMissingColumns=True)
    else:
        # The bootstrap, the metrics and the AUC (with its slice bounds) all
        # read the scored hold-out: keep a narrow projection so each forest
        # scores it once.
        scored = scoring.score_two(champ, chall, test, keep=[*dict.fromkeys([*keys, label])]).select(
            *dict.fromkeys([*keys, label]), "pred_champion", "score_champion", "pred_challenger", "score_challenger"
        ).persist(StorageLevel.MEMORY_AND_DISK)
        report = one_row(classification_ab(
            scored, keys, label, [], replicates, seed,
            champion_uri=f"models:/{model_name}@champion", challenger_uri=f"models:/{model_name}@challenger",
        ))
        scored.unpersist()
    report = report.withColumn("run_id", F.lit(run_id)).withColumn("timestamp", F.lit(timestamp))
    log_comparison(store, report, run_id)
    promote(store, model_name, report)
    sinks.write_json(report, report_path)
    sinks.write_text(sinks.format_lines(report, report.columns, sep=" | "), log_path)
    return report


def one_row(report: DataFrame) -> DataFrame:
    """A report without segments, computed once and kept as a literal row, so
    that writing, logging and promotion neither compute it again nor leave
    anything persisted."""
    row = report.first()
    return report.sparkSession.createDataFrame([tuple(row)] if row is not None else [], report.schema)


def log_comparison(store: RegistryStore, report: DataFrame, run_id: str) -> None:
    """R-1 ... R-3 for a comparison: metrics, compared models, decision."""
    numbers = [f.name for f in report.schema.fields if f.dataType.simpleString() in ("double", "bigint")]
    params = [c for c in ("champion_model", "challenger_model") if c in report.columns]
    rows = registry.run_rows(report, F.lit(run_id), F.lit(store.next_event_id()).cast("bigint"), numbers, params, ["decision"])
    store.append_runs(rows.where(F.when(F.col("kind") == "metric", F.col("num_value").isNotNull()).otherwise(F.length("value") > 0)))


def load_pair(store: RegistryStore, model_name: str):
    """(champion, challenger); no challenger when both aliases name the same
    version, as they do after a promotion: a model is not compared with itself."""
    a, b = store.resolve(model_name, "champion"), store.resolve(model_name, "challenger")
    champ = store.load(model_name, "champion")
    return champ, None if a == b else store.load(model_name, "challenger")


def promote(store: RegistryStore, model_name: str, report: DataFrame) -> None:
    """R-10: append a champion event for the challenger when the report says
    PROMOTE (the old champion needs no delete)."""
    decisions = report.select(F.lit(model_name).alias("model"), "decision")
    events = registry.alias_swap_events(registry.resolve_aliases(store.alias_events()), decisions,
                                        store.next_event_id())
    store.append_aliases(events)


def run_regression_ab(
    data: DataFrame, store: RegistryStore, model_name: str, keys: list[str], label: str,
    report_path: str, test_size: float = 0.2, seed: int = 42, run_id: str | None = None, timestamp: str = "",
    log_path: str | None = None,
) -> DataFrame:
    """B-7 / B-8: RMSE comparison; SKIPPED when there is no challenger."""
    run_id = run_id or uuid.uuid4().hex
    _, test = split.hash_split(data, keys or list(data.columns), test_size, seed)
    champ, chall = load_pair(store, model_name)
    if champ is None and chall is None:
        raise ValueError(f"no champion registered for {model_name}")
    found = {name: model for name, model in (("champion", champ), ("challenger", chall)) if model is not None}
    if len(found) == 2:  # one pass over the hold-out for both
        both = scoring.score_two(champ, chall, test, keep=[label])
        models = [F.struct(F.lit(m).alias("model"), F.col(f"pred_{m}").alias("prediction")) for m in found]
        scored = both.select(label, F.explode(F.array(*models)).alias("m")).select(label, "m.*")
    else:
        scored = scoring.score(*found.values(), test, keep=[label]).withColumn("model", F.lit(*found))
    long = metrics.regression_metrics(scored, label=label, segments=["model"])
    report = one_row(abtest.decide_regression(long)).withColumn("run_id", F.lit(run_id)).withColumn("timestamp", F.lit(timestamp))
    log_comparison(store, report, run_id)
    if report.first()["decision"] == abtest.PROMOTE:
        promote(store, model_name, report)
    sinks.write_json(report, report_path)
    if log_path:
        sinks.write_text(sinks.format_lines(report, report.columns, sep=" | "), log_path)
    return report
