"""Run log as a small append-only Parquet table, model registry as committed versions.

A stage change adds a row; the current stage of a version is its latest row. Changes are built from the
state they follow, and of two writers the later one builds its own again, so there is never more than
one Production version.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestream.constants import MODEL_NAME
from tidestream.operators.propensity import Candidate
from tidestream.schemas import REGISTRY_SCHEMA, RUN_SCHEMA
from tidestream.sinks.versions import VersionLog

STAGING, PRODUCTION, ARCHIVED = "Staging", "Production", "Archived"


class ModelRegistry:
    """Runs, registered versions and saved models below one root folder."""

    def __init__(self, spark: SparkSession, root: str, name: str = MODEL_NAME):
        self.spark = spark
        self.root = root.rstrip("/")
        self.name = name
        self._log = VersionLog(spark, f"{self.root}/model_registry/{name}")

    # -- runs ---------------------------------------------------------------
    def log_run(self, candidate: Candidate, run_id: str | None = None) -> str:
        """Append the metrics and params of a candidate; returns the run id."""
        run_id = run_id or uuid.uuid4().hex
        entries = [("metric", n, v) for n, v in candidate.metrics.items()]
        entries += [("param", n, v) for n, v in candidate.params.items()]
        rows = [(run_id, candidate.model_type, kind, n, str(v)) for kind, n, v in entries]
        self._append("runs", rows, RUN_SCHEMA)
        return run_id

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.root}/runs")

    def compare_runs(self) -> DataFrame:
        """One row per run with its scores side by side, best test AUC first."""
        metrics = ["train_auc", "test_auc", "train_pr_auc", "test_pr_auc"]
        table = (
            self.runs()
            .where(F.col("kind") == "metric")
            .groupBy("run_id", "model_type")
            .pivot("name", metrics)
            .agg(F.first(F.col("value").cast("double")))
        )
        return table.orderBy(F.desc("test_auc"), F.desc("model_type"))

    # -- registry -----------------------------------------------------------
    def register(self, candidate: Candidate, run_id: str, description: str = "") -> int:
        """Save the whole pipeline as the next version, in Staging.

        The model is saved under a name of its own and gets its version when that is committed, so two
        writers get two versions.
        """
        path = f"{self.root}/models/{self.name}/{uuid.uuid4().hex}"
        candidate.model.write().save(path)
        given = []

        def build(state: dict) -> dict:
            version = max((row["version"] for row in state.values()), default=0) + 1
            given[:] = [version]
            return self._changes(state, [{"version": version, "run_id": run_id, "description": description, "path": path, "stage": STAGING}])

        self._log.commit(build)
        return given[0]

    def promote(self, version: int) -> None:
        """Move a Staging version to Production and archive the one that was there, in one commit."""

        def build(state: dict) -> dict:
            current = {row["version"]: row for _, row in sorted(state.items())}
            chosen = current.get(version)
            if chosen is None or chosen["stage"] != STAGING:
                raise ValueError(f"version {version} is not in {STAGING}")
            older = [row for row in current.values() if row["stage"] == PRODUCTION]
            return self._changes(state, [*({**row, "stage": ARCHIVED} for row in older), {**chosen, "stage": PRODUCTION}])

        self._log.commit(build)

    def history(self) -> DataFrame:
        """Every stage change of every version."""
        _, state = self._log.read()
        rows = [
            (int(seq), self.name, r["version"], r["run_id"], r["stage"], r["description"], r["path"], dt.datetime.fromisoformat(r["changed_at"]))
            for seq, r in sorted(state.items())
        ]
        return self.spark.createDataFrame(rows, REGISTRY_SCHEMA)

    def current(self) -> DataFrame:
        """The latest row of every version; the table has one row per stage change."""
        columns = [c for c in self.history().columns if c not in ("name", "version")]
        latest = F.max_by(F.struct(*columns), "seq").alias("latest")
        return self.history().groupBy("name", "version").agg(latest).select(
            "name", "version", "latest.*"
        )

    def load_production(self, fallback: PipelineModel | None = None) -> PipelineModel:
        """The Production model, or the fallback where none has been promoted."""
        row = self.current().where(F.col("stage") == PRODUCTION).orderBy(F.desc("version")).first()
        if row is not None:
            return PipelineModel.load(row["path"])
        if fallback is None:
            raise LookupError(f"no {PRODUCTION} version of {self.name}")
        return fallback

    # -- storage ------------------------------------------------------------
    @staticmethod
    def _changes(state: dict, rows: list[dict]) -> dict:
        """The commit that adds stage changes after those there are."""
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        seq = max(map(int, state), default=0) + 1
        return {"set": {f"{seq + i:012}": {**row, "changed_at": now} for i, row in enumerate(rows)}}

    def _append(self, table: str, rows: list[tuple], schema: str) -> None:
        frame = self.spark.createDataFrame(rows, schema)
        frame.coalesce(1).write.mode("append").parquet(f"{self.root}/{table}")
