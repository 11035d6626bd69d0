"""Training, comparison, registry and scoring on sessions with a real signal."""

from __future__ import annotations

import pytest
from helpers import one
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidestream.constants import CATEGORIES
from tidestream.operators import features, predictions, propensity
from tidestream.operators.registry import ModelRegistry
from tidestream.operators.sketches import quantiles
from tidestream.plans.training import train_and_publish

QUICK = {propensity.BOOSTING: {"maxIter": 5}}


@pytest.fixture(scope="module")
def inputs(spark):
    """Sessions whose conversion follows from the cart additions, with some noise."""
    n = F.col("id")

    def noise(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000

    carts = F.floor(noise(1) * 5).cast("int")
    return spark.range(1500).select(
        F.concat(F.lit("s"), n).alias("session_id"),
        F.concat(F.lit("u"), n % 300).alias("user_id"),
        F.date_add(F.to_date(F.lit("2024-01-01")), (n % 30).cast("int")).alias("event_date"),
        (n % 24).cast("int").alias("event_hour"),
        (n % 7).cast("int").alias("day_of_week"),
        (carts + 1 + n % 4).alias("page_views"),
        (1 + n % 2).alias("unique_products_viewed"),
        carts.alias("add_to_cart_events"),
        (n % 3).alias("search_events"),
        (noise(2) * 600).alias("session_duration_seconds"),
        F.element_at(F.array(*map(F.lit, ("desktop", "mobile", "tablet"))), (n % 3 + 1).cast("int"))
        .alias("device_type"),
        F.array(F.element_at(F.array(*map(F.lit, CATEGORIES)), (n % 6 + 1).cast("int")))
        .alias("categories_viewed"),
        (noise(3) < 0.05 + 0.15 * carts).alias("converted_to_purchase"),
    )


@pytest.fixture(scope="module")
def trained(inputs):
    prepared = propensity.prepare(features.engineer_features(inputs))
    columns = features.feature_columns()
    return prepared, propensity.train_candidates(prepared, columns, QUICK)


def test_split_is_stable_and_near_its_share(inputs):
    split = propensity.assign_split(inputs).select("session_id", "split")
    again = propensity.assign_split(inputs.repartition(7)).select("session_id", "split")
    assert sorted(split.collect()) == sorted(again.collect())
    assert 0.75 < split.where("split = 'train'").count() / 1500 < 0.85


def test_scaler_sees_training_rows_only(spark, trained):
    prepared, candidates = trained
    scaling = candidates[propensity.LOGISTIC].model
    table = propensity.scaling_table(spark, type(scaling)(stages=scaling.stages[:2]))
    mean = prepared.where("split = 'train'").agg(F.avg("log_add_to_cart")).first()[0]
    row = one(table.where("feature = 'log_add_to_cart'"))
    assert row["mean"] == pytest.approx(mean)


def test_models_find_the_signal(spark, trained):
    _, candidates = trained
    for candidate in candidates.values():
        assert candidate.metrics["test_auc"] > 0.6
        assert set(candidate.metrics) == {
            "train_auc", "test_auc", "train_pr_auc", "test_pr_auc", "test_accuracy", "test_f1",
        }
    table = propensity.metrics_table(spark, candidates)
    best = max(candidates.values(), key=lambda c: c.metrics["test_auc"])
    assert one(propensity.pick_champion(table))["model_type"] == best.model_type


def test_a_tie_goes_to_the_logistic_regression(spark):
    rows = [(m, "test_auc", 0.7) for m in (propensity.BOOSTING, propensity.LOGISTIC)]
    table = spark.createDataFrame(rows, "model_type STRING, metric STRING, value DOUBLE")
    assert one(propensity.pick_champion(table))["model_type"] == propensity.LOGISTIC


def test_scores_and_importance(spark, trained):
    prepared, candidates = trained
    columns = features.feature_columns()
    for candidate in candidates.values():
        scored = propensity.score(candidate.model, prepared)
        low, high = scored.agg(
            F.min("probability_purchase"), F.max("probability_purchase")
        ).first()
        assert 0 <= low <= high <= 1
        ranked = propensity.feature_importance(spark, candidate.model, columns)
        assert ranked.count() == 19
        assert "log_add_to_cart" in [r["feature"] for r in ranked.limit(3).collect()]
    export = predictions.prediction_export(scored)
    assert {"probability_bucket", "model_version", "actual_converted"} <= set(export.columns)
    assert export.count() == 1500


def test_models_score_in_a_session_that_has_observed_rows(spark, inputs):
    """A session that was used for an observation can't be sent to tasks, so no model may hold it."""
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 3
    prepared = propensity.prepare(features.engineer_features(inputs))
    found = propensity.train_candidates(prepared, features.feature_columns(), QUICK)
    for candidate in found.values():
        scored = propensity.score(candidate.model, prepared)
        assert scored.groupBy("prediction_label").count().agg(F.sum("count")).first()[0] == 1500
        assert 0.6 < candidate.metrics["test_auc"] < 1


def test_registry_and_publication(spark, inputs, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    with pytest.raises(LookupError):
        registry.load_production()
    first = train_and_publish(inputs, registry, settings=QUICK)
    second = train_and_publish(inputs, registry, settings=QUICK)
    assert (first.version, second.version) == (1, 2)
    assert first.drift is None
    assert [r["drift_detected"] for r in second.drift.collect()] == [False, False]
    stages = {r["version"]: r["stage"] for r in registry.current().collect()}
    assert stages == {1: "Archived", 2: "Production"}
    assert registry.history().count() == 5
    assert registry.compare_runs().count() == 4
    with pytest.raises(ValueError):
        registry.promote(1)
    model = registry.load_production()
    scored = propensity.score(model, features.engineer_features(inputs))
    assert scored.count() == 1500
    assert spark.read.parquet(f"{tmp_path}/prediction_baseline").count() == 12
    both = one(quantiles(spark.read.parquet(f"{tmp_path}/score_sketches")))
    assert both["events"] == 2 * second.export.count() and 0 <= both["p50"] <= both["p95"] <= 1
    stored = spark.table("ml_purchase_predictions")
    assert stored.count() == second.export.count()
