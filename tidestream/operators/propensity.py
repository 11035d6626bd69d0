"""Training, evaluation and scoring of purchase-propensity models with Spark ML."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidestream.constants import BOOSTING_SETTINGS, LOGISTIC_SETTINGS, TRAIN_PERCENT
from tidestream.functions import hash_percent, rate
from tidestream.operators.features import LABEL
from tidestream.session import ensure_checkpoint_dir, stored

LOGISTIC = "logistic_regression"
BOOSTING = "gradient_boosted_trees"
# On equal test scores the simpler model wins.
MODEL_PRIORITY = (LOGISTIC, BOOSTING)


@dataclass
class Candidate:
    """A fitted pipeline with the numbers of its run."""

    model_type: str
    model: PipelineModel
    metrics: dict[str, float] = field(default_factory=dict)
    params: dict[str, object] = field(default_factory=dict)


def assign_split(rows: DataFrame, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """A `split` of train or test by a hash of the session id.

    The same session lands on the same side whatever the partitioning, a retried task or a
    later run, and all days of one session stay together.
    """
    in_train = hash_percent(F.col("session_id")) < train_percent
    return rows.withColumn("split", F.when(in_train, "train").otherwise("test"))


def add_label(features: DataFrame) -> DataFrame:
    return features.withColumn("label", F.col(LABEL).cast("double"))


def split_stats(labelled: DataFrame) -> DataFrame:
    """Rows, positives and positive rate of each split, in one job."""
    positives = F.count_if(F.col("label") == 1.0)
    return labelled.groupBy("split").agg(
        F.count("*").alias("rows"),
        positives.alias("positives"),
        rate(positives, F.count("*")).alias("positive_rate"),
    )


def prepare(features: DataFrame) -> DataFrame:
    """Labelled and split training rows, cut off from the lineage that made them.

    Fitting passes over these rows many times, so they are first dealt out evenly. They are
    stored as a table: a lost executor does not cost the event scan, de-duplication and session
    aggregation again, and each pass reads its own columns. Sessions without a valid time are
    left out, as their hour and weekday are placeholders.
    """
    dated = features.where("event_date is not null")
    return stored(assign_split(add_label(dated)).hint("rebalance", "session_id"), "training")


def fit_scaling(train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Assembler and standard scaler, fitted on training rows only."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="raw_features")
    scaler = StandardScaler(
        inputCol="raw_features", outputCol="features", withMean=True, withStd=True
    ).fit(assembler.transform(train))
    return PipelineModel(stages=[assembler, scaler])


def scaling_table(spark: SparkSession, scaling: PipelineModel) -> DataFrame:
    """Mean and standard deviation per feature, one row each."""
    assembler, scaler = scaling.stages
    assert isinstance(scaler, StandardScalerModel)
    rows = [
        (name, float(m), float(s))
        for name, m, s in zip(assembler.getInputCols(), scaler.mean, scaler.std)
    ]
    return spark.createDataFrame(rows, "feature STRING, mean DOUBLE, std DOUBLE")


def _estimator(model_type: str, settings: dict | None):
    if model_type == LOGISTIC:
        return LogisticRegression(
            featuresCol="features", labelCol="label", **{**LOGISTIC_SETTINGS, **(settings or {})}
        )
    return GBTClassifier(
        featuresCol="features", labelCol="label", **{**BOOSTING_SETTINGS, **(settings or {})}
    )


def _without_summary(spark: SparkSession, fitted):
    """A fitted classifier as its saved form gives it back, which has no training summary.

    The summary holds the session. Scoring sends the model to the tasks with all it holds, and a
    session in which anything has been observed cannot be sent.
    """
    if not getattr(fitted, "hasSummary", False):
        return fitted
    path = f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    fitted.write().save(path)
    return type(fitted).load(path)


def fit_candidate(
    scaled_train: DataFrame,
    scaling: PipelineModel,
    model_type: str,
    settings: dict | None = None,
) -> Candidate:
    """Fit one classifier on scaled rows; the result scores plain feature rows."""
    estimator = _estimator(model_type, settings)
    fitted = _without_summary(scaled_train.sparkSession, estimator.fit(scaled_train))
    return Candidate(
        model_type,
        PipelineModel(stages=[*scaling.stages, fitted]),
        params={"model_type": model_type, "feature_count": fitted.numFeatures},
    )


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Feature rows with prediction_label and probability_purchase added."""
    scored = model.transform(features)
    return scored.withColumns(
        {
            "prediction_label": F.col("prediction").cast("int"),
            "probability_purchase": vector_to_array("probability")[1],
        }
    )


def score_metrics(scored: DataFrame, score: str = "rawPrediction") -> dict[str, float]:
    """Area under ROC and PR on both splits, accuracy and F1 on the test split.

    `scored` has split, label, prediction and a score that ranks the rows. The curves use every
    distinct score. Rows are folded to counts per score, these are sorted once, in ranges, and each
    range begins with the totals of those above it; every point of both curves then follows from its own
    row. Without positives the areas are 0, without negatives 1, and a split without rows has 0.
    """
    vector = isinstance(scored.schema[score].dataType, VectorUDT)
    ranked = vector_to_array(score)[1] if vector else F.col(score).cast("double")
    positive, predicted = F.col("label") == 1, F.col("prediction") == 1
    counts = scored.groupBy("split", ranked.alias("score")).agg(
        F.count_if(positive).alias("pos"),
        F.count_if(~positive).alias("neg"),
        F.count_if(positive & predicted).alias("hits"),
        F.count_if(~positive & predicted).alias("false_hits"),
    )
    ranges = counts.repartitionByRange("split", F.desc("score")).withColumn("range", F.spark_partition_id())
    ranges = stored(ranges, "score-ranges")
    # One row per range and split.
    sums = ranges.groupBy("split", "range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    earlier = Window.partitionBy("split").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("split")
    carried = sums.select(
        "split",
        "range",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_above") for c in "pn"],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in "pn"],
    )
    inside = Window.partitionBy("split", "range").orderBy(F.desc("score"))
    tp, fp = F.col("p_above") + F.sum("pos").over(inside), F.col("n_above") + F.sum("neg").over(inside)
    points = ranges.join(carried, ["split", "range"]).withColumns({"tp": tp, "fp": fp})
    points = points.withColumns({"tp0": F.col("tp") - F.col("pos"), "fp0": F.col("fp") - F.col("neg")})
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    before = F.when(F.col("tp0") + F.col("fp0") > 0, F.col("tp0") / (F.col("tp0") + F.col("fp0"))).otherwise(precision)
    areas = points.groupBy("split").agg(
        F.sum(F.col("neg") * (F.col("tp0") + F.col("tp")) / 2.0).alias("above"),
        F.sum(F.col("pos") * (before + precision) / 2.0).alias("under_pr"),
        *[F.sum(c).alias(c) for c in ("pos", "neg", "hits", "false_hits")],
    )
    found = {row["split"]: row for row in areas.collect()}
    metrics = {}
    for split in ("train", "test"):
        row = found.get(split)
        pos, neg = (row["pos"], row["neg"]) if row else (0, 0)
        metrics[f"{split}_auc"] = row["above"] / (pos * neg) if pos and neg else float(bool(pos))
        metrics[f"{split}_pr_auc"] = row["under_pr"] / pos if pos else 0.0
    row = found.get("test")
    cells = (row["hits"], row["false_hits"], row["pos"] - row["hits"], row["neg"] - row["false_hits"]) if row else (0, 0, 0, 0)
    return {**metrics, **_label_metrics(*cells)}


def _label_metrics(tp: int, fp: int, fn: int, tn: int) -> dict[str, float]:
    """Accuracy, and F1 of both labels weighted by how often each occurs."""
    total = tp + fp + fn + tn
    if not total:
        return {"test_accuracy": 0.0, "test_f1": 0.0}

    def f1(hits: int, false: int, missed: int) -> float:
        return 2 * hits / (2 * hits + false + missed) if hits else 0.0

    weighted = (tp + fn) * f1(tp, fp, fn) + (tn + fp) * f1(tn, fn, fp)
    return {"test_accuracy": (tp + tn) / total, "test_f1": weighted / total}


def evaluate(candidate: Candidate, prepared: DataFrame) -> dict[str, float]:
    """The metrics of a fitted candidate."""
    return score_metrics(candidate.model.transform(prepared))


def train_candidates(
    prepared: DataFrame,
    columns: Sequence[str],
    settings: dict[str, dict] | None = None,
) -> dict[str, Candidate]:
    """Both classifiers over one shared scaling, evaluated on both splits."""
    train = prepared.where(F.col("split") == "train")
    scaling = fit_scaling(train, columns)
    scaled = scaling.transform(train).select("features", "label").persist()
    sizes = {r["split"]: r["count"] for r in prepared.groupBy("split").count().collect()}
    candidates = {}
    for model_type in MODEL_PRIORITY:
        candidate = fit_candidate(scaled, scaling, model_type, (settings or {}).get(model_type))
        candidate.params |= {f"{s}_size": sizes.get(s, 0) for s in ("train", "test")}
        candidate.metrics = evaluate(candidate, prepared)
        candidates[model_type] = candidate
    scaled.unpersist()
    return candidates


def metrics_table(spark: SparkSession, candidates: dict[str, Candidate]) -> DataFrame:
    """One row per model and metric."""
    rows = [(c.model_type, n, v) for c in candidates.values() for n, v in c.metrics.items()]
    return spark.createDataFrame(rows, "model_type STRING, metric STRING, value DOUBLE")


def pick_champion(metrics: DataFrame) -> DataFrame:
    """The model with the best test AUC; on a tie the logistic regression."""
    order = F.array_position(F.array(*[F.lit(m) for m in MODEL_PRIORITY]), F.col("model_type"))
    ranked = (
        metrics.where(F.col("metric") == "test_auc")
        .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("value"), order)))
        .where(F.col("rank") == 1)
    )
    return ranked.select("model_type", F.col("value").alias("test_auc"))


def feature_importance(
    spark: SparkSession, model: PipelineModel, columns: Sequence[str]
) -> DataFrame:
    """Features by tree importance, or by absolute weight for the logistic regression."""
    classifier = model.stages[-1]
    if hasattr(classifier, "featureImportances"):
        values = [(c, float(v)) for c, v in zip(columns, classifier.featureImportances.toArray())]
        table = spark.createDataFrame(values, "feature STRING, importance DOUBLE")
        return table.orderBy(F.desc("importance"), "feature")
    values = [(c, float(v)) for c, v in zip(columns, classifier.coefficients.toArray())]
    table = spark.createDataFrame(values, "feature STRING, coefficient DOUBLE")
    table = table.withColumn("abs_coefficient", F.abs("coefficient"))
    return table.orderBy(F.desc("abs_coefficient"), "feature")
