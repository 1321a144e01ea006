"""Training and scoring of the score models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.operators.aggregates import baseline_metrics, regression_metrics
from panelworks.operators.features import LEAKING_COLUMNS, encode_codes, season_split, select_features
from panelworks.operators.models import (
    drawn_settings,
    ensemble_mean,
    feature_importance,
    fit_by_position,
    fit_forest,
    fit_score_model,
    log_run,
    persist_model,
    predict,
    split_metrics,
    tune_by_position,
)
from panelworks.operators.windows import lead_target
from panelworks.panel import Panel
from panelworks.session import stored_table
from panelworks.sources.tables import export_csv, read_table, write_table

# Text columns that become codes, and columns that are no features.
CODED = ["position", "primary_position", "team", "opponent", "ground_condition", "weather_condition"]
NOT_FEATURES = ["target_score", "score", "year", "round", "split"]


def training_rows(gold: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Rows with a next-round target, coded categories and a split."""
    rows = lead_target(gold, panel)
    coded = encode_codes(rows, [c for c in CODED if c in rows.columns])
    return season_split(coded, season=panel.season[0])


def metric_rows(scored: DataFrame, label: str, predictions: Sequence[str]) -> DataFrame:
    """Errors per prediction column and split."""
    tables = [
        split_metrics(scored, label, p).withColumn("model", F.lit(p)) for p in predictions
    ]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result.select("model", "split", "n", "mae", "rmse")


def feature_set(rows: DataFrame, name: str = "known_before") -> list[str]:
    """``known_before``: without the columns known only after the round; ``all``: every number but the target."""
    left_out = {"all": NOT_FEATURES, "known_before": [*NOT_FEATURES, *LEAKING_COLUMNS]}[name]
    return select_features(rows, left_out)


def train_scores(
    rows: DataFrame,
    features: Sequence[str] | None = None,
    label: str = "target_score",
    boosting: Mapping[str, Any] = {},
    forest: Mapping[str, Any] = {},
) -> tuple[DataFrame, dict[str, Any]]:
    """Fit both learners; return all rows with their predictions, and the models."""
    features = list(features or select_features(rows, NOT_FEATURES))
    rows = stored_table(rows)
    models = {
        "boosted": fit_score_model(rows, features, label, boosting),
        "forest": fit_forest(rows, features, label, forest),
    }
    scored = predict(models["boosted"], rows, features, "boosted")
    scored = predict(models["forest"], scored, features, "forest")
    return ensemble_mean(scored, "boosted", "forest"), {**models, "features": features}


def position_errors(scored: DataFrame, label: str, prediction: str, position: str) -> DataFrame:
    """(position, n, mae, rmse) of every position, the worst first."""
    errors = regression_metrics(scored, label, prediction, by=position, min_rows=1)
    return errors.withColumnRenamed(position, "position").orderBy(F.col("mae").desc(), "position")


def run_training(
    spark: SparkSession,
    gold_path: str,
    out: str,
    run_name: str,
    params: Mapping[str, Any] = {},
    features: str = "known_before",
    position: str = "primary_position",
) -> None:
    """Fit on a named feature set; errors per split, per position of the test season and of naive predictions are logged."""
    rows = training_rows(read_table(spark, gold_path))
    scored, fitted = train_scores(rows, feature_set(rows, features), boosting=params)
    scored = stored_table(scored)
    table = metric_rows(scored, "target_score", ["boosted", "forest", "ensemble"])
    validation = scored.filter(F.col("split") == "val")
    naive = baseline_metrics(validation, "target_score", ["score_lag_1", "rolling_avg_3"])
    metrics = {f"{r.model}_{r.split}_{m}": r[m] for r in table.collect() for m in ("mae", "rmse")}
    metrics |= {f"baseline_{r.baseline}_{m}": r[m] for r in naive.collect() for m in ("mae", "rmse")}
    tested = scored.filter(F.col("split") == "test")
    by_position = position_errors(tested, "target_score", "ensemble", position)
    metrics |= {f"test_{r.position}_{m}": r[m] for r in by_position.collect() for m in ("mae", "rmse")}
    log_run(spark, f"{out}/runs", run_name, params, metrics, {"features": features})
    importance = feature_importance(spark, fitted["boosted"], fitted["features"])
    export_csv(importance, f"{out}/importance", F.col("importance").desc(), "feature")
    persist_model(fitted["boosted"], f"{out}/boosted")
    persist_model(fitted["forest"], f"{out}/forest")


def run_position_training(
    spark: SparkSession, gold_path: str, out: str, params: Mapping[str, Any] = {}
) -> None:
    """One model per position, each logged as its own run."""
    rows = stored_table(training_rows(read_table(spark, gold_path)))
    features = select_features(rows, NOT_FEATURES)
    for value, model in fit_by_position(rows, features, "target_score", params=params).items():
        own = predict(model, rows.filter(F.col("primary_position") == value), features)
        errors = split_metrics(own, "target_score", "prediction").collect()
        metrics = {f"{r.split}_{m}": r[m] for r in errors for m in ("mae", "rmse")}
        log_run(spark, f"{out}/runs", f"position {value}", params, metrics, {"position": value})
        persist_model(model, f"{out}/position={value}")


def run_tuning(
    spark: SparkSession,
    gold_path: str,
    out: str,
    settings: Sequence[Mapping[str, Any]] | None = None,
    features: str = "known_before",
    position: str = "primary_position",
    **search: Any,
) -> None:
    """Tune boosted trees for each position; all trials, the winners with their errors, and the models are kept.

    ``settings`` are 50 drawn ones by default, ``search`` goes to ``tune_by_position``. The summary lists the
    positions by their error on the validation season.
    """
    rows = training_rows(read_table(spark, gold_path))
    settings = drawn_settings(50) if settings is None else settings
    found, trials, errors = tune_by_position(rows, feature_set(rows, features), "target_score", settings, position, **search)
    write_table(trials, f"{out}/trials")
    errors = stored_table(errors)
    metrics: dict[str, dict[str, float]] = {}
    for r in errors.collect():  # a few numbers for each position
        metrics.setdefault(r.position, {}).update({f"{r.split}_{m}": r[m] for m in ("mae", "rmse")})
    for value, tuned in found.items():
        log_run(spark, f"{out}/runs", f"tuning {value}", tuned.settings, metrics[value], {"position": value, "features": features})
        persist_model(tuned.model, f"{out}/position={value}")
    named = [F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s in ("val", "test") for m in ("mae", "rmse")]
    export_csv(errors.groupBy("position").agg(*named), f"{out}/summary", "val_mae", "position")
