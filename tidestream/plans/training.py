"""From session features to a promoted model and stored predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidestream.constants import CATEGORIES
from tidestream.operators import predictions as p
from tidestream.operators.features import engineer_features, feature_columns
from tidestream.operators.propensity import (
    feature_importance,
    metrics_table,
    pick_champion,
    prepare,
    score,
    train_candidates,
)
from tidestream.operators.registry import ModelRegistry
from tidestream.operators.sketches import score_sketch
from tidestream.session import stored
from tidestream.sinks.lake import append_baseline, append_sketch, read_baseline, write_csv
from tidestream.sinks.warehouse import save_predictions


@dataclass
class TrainingResult:
    champion: str
    version: int
    run_ids: dict[str, str]
    export: DataFrame
    saved_to: str
    drift: DataFrame | None = None  # against the baseline of the run before, if there is one


def train_and_publish(
    inputs: DataFrame,
    registry: ModelRegistry,
    categories: Sequence[str] = CATEGORIES,
    settings: dict[str, dict] | None = None,
    jdbc: Mapping[str, str] | None = None,
) -> TrainingResult:
    """Train both models, promote the better one and score the test sessions with it.

    Leaves behind the run log, the registered version, the feature importance (CSV), the
    prediction baseline, a sketch of the scores and the prediction table.
    """
    spark = inputs.sparkSession
    columns = feature_columns(categories)
    prepared = prepare(engineer_features(inputs, categories))
    candidates = train_candidates(prepared, columns, settings)
    run_ids = {name: registry.log_run(c) for name, c in candidates.items()}
    champion = pick_champion(metrics_table(spark, candidates)).first()["model_type"]
    best = candidates[champion]

    importance = feature_importance(spark, best.model, columns)
    write_csv(importance, f"{registry.root}/feature_importance/{run_ids[champion]}")
    sessions = best.params["train_size"]
    version = registry.register(
        best, run_ids[champion], f"Purchase propensity, {champion} on {sessions} sessions"
    )
    registry.promote(version)

    model = registry.load_production(fallback=best.model)
    scored = score(model, prepared.where("split = 'test'"))
    summary = stored(p.monitoring_metrics(p.prediction_summary(scored)), "monitoring")
    baseline = f"{registry.root}/prediction_baseline"
    append_baseline(summary, baseline, run_ids[champion])
    append_sketch(score_sketch(scored), f"{registry.root}/score_sketches", run_ids[champion])
    earlier = read_baseline(spark, baseline, before=run_ids[champion])
    drift = None if earlier is None else p.prediction_drift(summary, earlier)
    export = p.prediction_export(scored, str(version))
    return TrainingResult(champion, version, run_ids, export, save_predictions(export, jdbc), drift)
