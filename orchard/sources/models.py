"""Registry tables on a shared folder, and loading a model by alias (S-4, K-6).

Layout under ``root``::

    runs/            long-form params / metrics / tags     (append)
    model_versions/  model, version, run_id, path, event_id (commit files)
    alias_events/    event_id, model, alias, version        (append)
    models/<name>/<run>-<id>/   saved PipelineModel directories

Event ids order everything; a job takes its id from ``next_event_id``.  A
version is a commit file that only one writer can create, so two jobs that
register at once get two versions; its model directory is named by the run and
written before the commit, so a version that can be seen can be loaded.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.operators import registry
from orchard.sources.commits import CommitLog
from orchard.sources.sinks import append_table, save_model

RUNS_SCHEMA = "run_id string, kind string, key string, value string, num_value double, event_id bigint"
VERSIONS_SCHEMA = "model string, version int, run_id string, path string, event_id bigint"
ALIASES_SCHEMA = "event_id bigint, model string, alias string, version int"


class RegistryStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.commits = CommitLog(spark, f"{self.root}/model_versions", VERSIONS_SCHEMA)

    # -- tables -------------------------------------------------------------
    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self._path(name)
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)  # no table yet

    def runs(self) -> DataFrame:
        return self._read("runs", RUNS_SCHEMA)

    def versions(self) -> DataFrame:
        return self.commits.table()

    def alias_events(self) -> DataFrame:
        return self._read("alias_events", ALIASES_SCHEMA)

    def append_runs(self, rows: DataFrame) -> None:
        append_table(rows.select(*registry.RUN_COLUMNS), self._path("runs"))

    def append_aliases(self, rows: DataFrame) -> None:
        append_table(rows.select("event_id", "model", "alias", "version"), self._path("alias_events"))

    # -- ids ----------------------------------------------------------------
    def next_event_id(self) -> int:
        """One past the largest event id in any table (a one-row aggregate)."""
        ids = self.runs().select("event_id").unionByName(self.versions().select("event_id")).unionByName(self.alias_events().select("event_id"))
        return (ids.agg(F.max("event_id")).first()[0] or 0) + 1

    # -- models -------------------------------------------------------------
    def model_path(self, model: str, run_id: str) -> str:
        return f"{self.root}/models/{model}/{run_id}-{uuid.uuid4().hex[:8]}"

    def register_model(self, model_obj: PipelineModel, model: str, run_id: str, event_id: int) -> int:
        """K-5 + K-6 + R-6: save the model directory, then commit its version."""
        path = save_model(model_obj, self.model_path(model, run_id), overwrite=False)
        return self.commits.append(model, lambda n: {"model": model, "version": n, "run_id": run_id, "path": path, "event_id": event_id})

    def set_alias(self, model: str, alias: str, version: int, event_id: int) -> None:
        self.append_aliases(
            self.spark.createDataFrame([(event_id, model, alias, version)], ALIASES_SCHEMA)
        )

    def resolve(self, model: str, alias: str) -> tuple[int, str] | None:
        """S-4: version and path behind ``models:/<model>@<alias>``, or None."""
        cur = registry.resolve_aliases(self.alias_events()).where(
            (F.col("model") == model) & (F.col("alias") == alias)
        )
        row = (
            cur.join(self.versions().select("model", "version", "path"), ["model", "version"], "left")
            .select("version", "path")
            .first()
        )
        if row is None or row["path"] is None:
            return None
        return int(row["version"]), row["path"]

    def load(self, model: str, alias: str) -> PipelineModel | None:
        found = self.resolve(model, alias)
        if found is None:
            return None
        return PipelineModel.load(found[1])


def parse_model_uri(uri: str) -> tuple[str, str]:
    """``models:/<name>@<alias>`` -> (name, alias)."""
    if not uri.startswith("models:/") or "@" not in uri:
        raise ValueError(f"expected models:/<name>@<alias>, got {uri!r}")
    name, alias = uri[len("models:/"):].split("@", 1)
    return name, alias
