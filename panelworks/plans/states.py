"""Player states: latent position, anomaly and cluster of every player-round."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.operators.features import impute_median, one_hot, standardise
from panelworks.operators.models import (
    cluster_states,
    latent_and_anomaly,
    persist_model,
    spread_vector,
)
from panelworks.session import stored_table
from panelworks.sources.tables import read_table, write_table

# Numeric inputs of the state model.
STATE_FEATURES = [
    "score_lag_1", "score_lag_2", "score_lag_3",
    "rolling_avg_3", "rolling_std_3", "career_avg", "season_avg_to_date",
    "price", "ppm", "price_momentum_3", "price_change_lag_1",
    "be_gap", "be_gap_lag_1",
    "base_avg", "scoring_avg", "create_avg", "bppm",
    "opponent_avg_pts_allowed", "matchup_adjusted_avg", "mins_lag_1",
]

IDENTITY = [
    "player_name", "year", "round", "position", "team", "price", "score", "be_gap", "games_played",
]


def state_inputs(
    gold: DataFrame, features: Sequence[str] = STATE_FEATURES, position: str = "primary_position"
) -> tuple[DataFrame, list[str]]:
    """Standardised numeric features and position flags, under new names."""
    rows = gold.filter(F.col("score_lag_3").isNotNull())
    named = {f: f"in_{f}" for f in features if f in gold.columns}
    rows = rows.withColumns({new: F.col(old) for old, new in named.items()})
    rows, flags = one_hot(impute_median(rows, list(named.values())), position, prefix="in_pos_")
    inputs = [*named.values(), *flags]
    return standardise(rows, inputs), inputs


def player_states(
    gold: DataFrame,
    features: Sequence[str] = STATE_FEATURES,
    k_latent: int = 8,
    k_clusters: int = 6,
    order_by: str = "price_momentum_3",
    model_path: str | None = None,
) -> DataFrame:
    """Identity columns with cluster, anomaly score and latent columns."""
    rows, inputs = state_inputs(gold, features)
    keep = [c for c in dict.fromkeys([*IDENTITY, order_by]) if c in rows.columns]
    rows = stored_table(rows.select(*keep, *inputs))
    size = min(k_latent, len(inputs))
    projected, pca = latent_and_anomaly(rows, inputs, size)
    clustered, kmeans = cluster_states(projected.drop(*inputs), order_by, k_clusters)
    if model_path:
        persist_model(pca, f"{model_path}/pca")
        persist_model(kmeans, f"{model_path}/kmeans")
    identity = [c for c in IDENTITY if c in rows.columns]
    latent = [f"latent_{i}" for i in range(size)]
    spread = spread_vector(clustered, "latent", size, "latent_")
    return spread.select(*identity, "cluster", "anomaly_score", *latent)


def run_states(spark: SparkSession, gold_path: str, path: str, model_path: str) -> None:
    write_table(player_states(read_table(spark, gold_path), model_path=model_path), path, ["year"])
