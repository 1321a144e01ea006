"""Score regressors and player states with MLlib."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool
from random import Random
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.operators.aggregates import regression_metrics
from panelworks.operators.features import MISSING, fill_sentinel
from panelworks.session import ensure_checkpoint_dir
from panelworks.sources.tables import write_table

# The boosted-tree budget.
BOOSTING = {
    "maxIter": 500,
    "maxDepth": 6,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}

IMPORTANCE_SCHEMA = "feature string, importance double"
RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def assemble(df: DataFrame, features: Sequence[str], name: str = "features") -> DataFrame:
    """Feature vector with nulls as the missing-value sentinel."""
    filled = fill_sentinel(df, features)
    return VectorAssembler(inputCols=list(features), outputCol=name).transform(filled)


def fit_score_model(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    params: Mapping[str, Any] = {},
    split: str = "split",
) -> Model:
    """Boosted trees on the training seasons, stopped early on the validation season."""
    ensure_checkpoint_dir(df.sparkSession)  # long boosting runs cut their lineage there
    rows = (
        assemble(df.filter(F.col(split).isin("train", "val")), features)
        .select("features", F.col(label).cast("double").alias("label"), split)
        .withColumn("validation", F.col(split) == "val")
    )
    learner = GBTRegressor(
        featuresCol="features",
        labelCol="label",
        validationIndicatorCol="validation",
        validationTol=0.001,
        **{**BOOSTING, **params},
    )
    return learner.fit(rows)


def fit_best_rounds(
    rows: DataFrame,
    label: str,
    params: Mapping[str, Any] = {},
    patience: int = 20,
    split: str = "split",
    features: str = "features",
) -> tuple[Model, list[float]]:
    """Boosted trees on the training seasons, cut off after the round that is best on the validation season.

    ``rows`` have a feature vector. The search for the best round ends where ``patience`` rounds in a row bring no
    improvement. Returns the model of that many trees and the mean absolute error of every round; without validation
    rows all trees stay.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    rows = rows.withColumn("_label", F.col(label).cast("double"))
    learner = GBTRegressor(featuresCol=features, labelCol="_label", **{**BOOSTING, **params})
    model = learner.fit(rows.filter(F.col(split) == "train"))
    held = rows.filter(F.col(split) == "val")
    if not held.limit(1).count():
        return model, []
    errors = list(model.evaluateEachIteration(held, "absolute"))
    return first_rounds(model, best_round(errors, patience)), errors


def best_round(errors: Sequence[float], patience: int) -> int:
    """Number of rounds up to the least error, before ``patience`` rounds in a row are no better."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_rounds(model: Model, rounds: int) -> Model:
    """A boosted model of the first trees of another one."""
    java, sc = model._java_obj, SparkSession.active().sparkContext
    jvm = sc._jvm
    trees = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(jvm.double, rounds)
    all_trees, all_weights = java.trees(), java.treeWeights()
    for i in range(rounds):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    own = jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"{model.uid}_{rounds}", trees, weights)
    own.setFeaturesCol(model.getFeaturesCol())
    own.setPredictionCol(model.getPredictionCol())
    return GBTRegressionModel(own)


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    params: Mapping[str, Any] = {},
    split: str = "split",
) -> Model:
    """Second learner of the ensemble: a random forest on the training seasons."""
    rows = assemble(df.filter(F.col(split) == "train"), features).select(
        "features", F.col(label).cast("double").alias("label")
    )
    settings = {"numTrees": 100, "maxDepth": 6, "subsamplingRate": 0.8, "seed": 42, **params}
    return RandomForestRegressor(featuresCol="features", labelCol="label", **settings).fit(rows)


def predict(
    model: Model, df: DataFrame, features: Sequence[str], name: str = "prediction"
) -> DataFrame:
    """The rows as they were, plus the model's prediction."""
    model = model.copy().setPredictionCol(name)
    vector = VectorAssembler(
        inputCols=[f"_f_{i}" for i in range(len(features))], outputCol="features"
    )
    filled = df.withColumns(
        {
            f"_f_{i}": F.coalesce(F.col(c).cast("double"), F.lit(float(MISSING)))
            for i, c in enumerate(features)
        }
    )
    scored = model.transform(vector.transform(filled))
    return scored.drop("features", *[f"_f_{i}" for i in range(len(features))])


def split_metrics(scored: DataFrame, label: str, prediction: str, split: str = "split") -> DataFrame:
    """MAE and RMSE per split."""
    return regression_metrics(scored, label, prediction, by=split, min_rows=1)


def ensemble_mean(df: DataFrame, a: str, b: str, name: str = "ensemble") -> DataFrame:
    return df.withColumn(name, 0.5 * F.col(a) + 0.5 * F.col(b))


def position_values(df: DataFrame, col: str) -> list[str]:
    """Positions to fit a model for, in order; one model each, for as many as there are."""
    values = df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)
    return [r[0] for r in values.toLocalIterator()]


def fit_by_position(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    position: str = "primary_position",
    params: Mapping[str, Any] = {},
) -> dict[str, Model]:
    """One distributed fit per position that has rows in both splits."""
    counted = df.groupBy(position).agg(
        F.count_if(F.col("split") == "train").alias("t"),
        F.count_if(F.col("split") == "val").alias("v"),
    )
    usable = counted.filter((F.col("t") > 0) & (F.col("v") > 0))
    return {
        value: fit_score_model(df.filter(F.col(position) == value), features, label, params)
        for value in position_values(usable, position)
    }


def tune_fixed_validation(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    grid: Mapping[str, Sequence[Any]],
) -> tuple[dict[str, Any], DataFrame, Model]:
    """Try every combination, keep the one with the least validation MAE.

    The validation season is fixed, so the folds are never random. Returns the
    best settings, one row per trial and the fitted model.
    """
    spark = df.sparkSession
    trials, best = [], None
    names = list(grid)
    for values in product(*grid.values()):
        settings = dict(zip(names, values))
        model = fit_score_model(df, features, label, settings)
        scored = predict(model, df.filter(F.col("split") == "val"), features)
        row = regression_metrics(scored, label, "prediction").first()
        trials.append((str(settings), row["mae"], row["rmse"]))
        if best is None or row["mae"] < best[0]:
            best = (row["mae"], settings, model)
    table = spark.createDataFrame(trials, "params string, val_mae double, val_rmse double")
    return best[1], table, best[2]


@dataclass
class Tuned:
    """The best settings, the model fitted with them, and one entry for each trial."""

    settings: dict[str, Any]
    model: Model
    trials: list[dict[str, Any]]


def drawn_settings(count: int, seed: int = 42) -> list[dict[str, Any]]:
    """Settings of boosted trees, drawn independently from the ranges of the search."""
    draw = Random(seed)
    return [
        {
            "maxDepth": draw.randint(3, 10),
            "stepSize": round(0.01 * 30 ** draw.random(), 4),
            "subsamplingRate": round(draw.uniform(0.5, 1.0), 3),
            "featureSubsetStrategy": str(round(draw.uniform(0.5, 0.999), 3)),
            "minInstancesPerNode": draw.randint(5, 50),
        }
        for _ in range(count)
    ]


def successive_halving(
    rows: DataFrame,
    label: str,
    settings: Sequence[Mapping[str, Any]],
    rungs: Sequence[int] = (25, 50, 100),
    budget: int = 500,
    patience: int = 20,
    split: str = "split",
    features: str = "features",
) -> Tuned:
    """Try settings with growing numbers of trees; after each rung the better half goes on.

    ``rows`` have a feature vector, and rows of both splits. A trial is judged by the least mean absolute error of any of its rounds on
    the validation season, which is fixed; of equal ones the earlier setting stays. The last one left is
    fitted again with ``budget`` trees, cut off after its best round.
    """
    alive, trials = list(range(len(settings))), []
    for rung, trees in enumerate(rungs):
        error = {}
        for i in alive:
            _, errors = fit_best_rounds(rows, label, {**settings[i], "maxIter": trees}, patience, split, features)
            error[i] = errors[best_round(errors, patience) - 1]
        better = sorted(alive, key=lambda i: (error[i], i))
        kept = better[: 1 if rung == len(rungs) - 1 else (len(better) + 1) // 2]
        trials += [
            {"rung": rung, "trees": trees, "trial": i, "params": str(dict(settings[i])), "val_mae": error[i], "kept": i in kept}
            for i in alive
        ]
        alive = kept
    best = dict(settings[alive[0]])
    model, _ = fit_best_rounds(rows, label, {**best, "maxIter": budget}, patience, split, features)
    return Tuned(best, model, trials)


TRIAL_SCHEMA = "position string, rung int, trees int, trial int, params string, val_mae double, kept boolean"


def tune_by_position(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    settings: Sequence[Mapping[str, Any]],
    position: str = "primary_position",
    rungs: Sequence[int] = (25, 50, 100),
    budget: int = 500,
    patience: int = 20,
    parallelism: int = 4,
) -> tuple[dict[str, Tuned], DataFrame, DataFrame]:
    """The best boosted trees of every position that has rows in the training and the validation season.

    The feature vector is made once and stored in a folder for each position, so a trial reads the rows
    of its own only. ``parallelism`` positions are tuned at a time; every fit is a distributed job. Returns what was found,
    all trials (position, rung, trees, trial, params, val_mae, kept) and the errors of the models (position, split, n, mae, rmse).
    """
    spark = rows.sparkSession
    at = f"{ensure_checkpoint_dir(spark)}/vectors-{uuid.uuid4().hex}"
    vectors = assemble(rows.filter(F.col(position).isNotNull()), features, "_vector").select(
        F.col(position).cast("string").alias("position"), "split", F.col(label).cast("double").alias("target"), F.col("_vector").alias("features")
    )
    write_table(vectors, at, ["position"])
    vectors = spark.read.schema(vectors.schema).parquet(at)
    usable = vectors.groupBy("position").agg(F.count_if(F.col("split") == "train").alias("t"), F.count_if(F.col("split") == "val").alias("v"))
    values = position_values(usable.filter((F.col("t") > 0) & (F.col("v") > 0)), "position")

    def tuned(value: str) -> Tuned:
        return successive_halving(vectors.filter(F.col("position") == value), "target", settings, rungs, budget, patience)

    with ThreadPool(max(1, parallelism)) as pool:
        found = dict(zip(values, pool.map(inheritable_thread_target(spark)(tuned), values)))
    trials = [{"position": value, **trial} for value, t in found.items() for trial in t.trials]
    errors = spark.createDataFrame([], "position string, split string, n long, mae double, rmse double")
    for value, t in found.items():
        own = split_metrics(t.model.transform(vectors.filter(F.col("position") == value)), "target", "prediction")
        errors = errors.unionByName(own.select(F.lit(value).alias("position"), "split", "n", "mae", "rmse"))
    return found, spark.createDataFrame(trials, TRIAL_SCHEMA), errors


def feature_importance(spark: SparkSession, model: Model, features: Sequence[str]) -> DataFrame:
    weights = model.featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(features, weights)]
    return spark.createDataFrame(rows, IMPORTANCE_SCHEMA)


def latent_and_anomaly(df: DataFrame, cols: Sequence[str], k: int = 8) -> tuple[DataFrame, Model]:
    """``latent`` vector of size ``k`` and reconstruction error of centred columns.

    The components are orthonormal, so the squared residual of a row is its
    squared length minus the squared length of its latent vector.
    """
    vectors = VectorAssembler(inputCols=list(cols), outputCol="_vector").transform(df)
    model = PCA(k=min(k, len(cols)), inputCol="_vector", outputCol="latent").fit(vectors)

    def square_sum(vector: str):
        return F.aggregate(vector_to_array(vector), F.lit(0.0), lambda acc, x: acc + x * x)

    residual = (square_sum("_vector") - square_sum("latent")) / len(cols)
    projected = model.transform(vectors)
    return projected.withColumn("anomaly_score", F.greatest(residual, F.lit(0.0))).drop("_vector"), model


def cluster_states(
    df: DataFrame, order_by: str, k: int = 6, seed: int = 42, vector: str = "latent"
) -> tuple[DataFrame, Model]:
    """k-means labels, renumbered by the ascending mean of ``order_by``."""
    model = KMeans(k=k, seed=seed, featuresCol=vector, predictionCol="_label").fit(df)
    labelled = model.transform(df)
    means = labelled.groupBy("_label").agg(F.avg(F.col(order_by).cast("double")).alias("m"))
    ranked = sorted(means.collect(), key=lambda r: (r["m"] is not None, r["m"], r["_label"]))
    numbers = F.create_map(*[F.lit(x) for i, r in enumerate(ranked) for x in (r["_label"], i)])
    return labelled.withColumn("cluster", numbers[F.col("_label")]).drop("_label"), model


def spread_vector(df: DataFrame, vector: str, size: int, prefix: str) -> DataFrame:
    """Vector entries as columns."""
    values = vector_to_array(vector)
    return df.withColumns({f"{prefix}{i}": values[i] for i in range(size)}).drop(vector)


def array_features(df: DataFrame, col: str, name: str = "latent") -> DataFrame:
    """Array column as vector column."""
    return df.withColumn(name, array_to_vector(F.col(col).cast("array<double>")))


def persist_model(model: Model, path: str) -> None:
    stages = model if isinstance(model, PipelineModel) else PipelineModel([model])
    stages.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_run(
    spark: SparkSession,
    path: str,
    run_name: str,
    params: Mapping[str, Any] = {},
    metrics: Mapping[str, float] = {},
    tags: Mapping[str, str] = {},
) -> None:
    """Append the settings and results of one run to the runs table."""

    def rows(kind: str, entries: Mapping[str, Any]) -> Iterable[tuple[str, str, str, str]]:
        return [(run_name, kind, k, str(v)) for k, v in entries.items()]

    table = [*rows("param", params), *rows("metric", metrics), *rows("tag", tags)]
    spark.createDataFrame(table, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
