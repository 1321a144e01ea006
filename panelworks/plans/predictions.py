"""Predicted scores of one round."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.functions.scalars import CLUSTER_BONUS, TEAM_CODES
from panelworks.operators.joins import (
    join_latest_matchup,
    join_opponents,
    join_sentiment,
    join_states,
    round_fixtures,
    round_opponents,
)
from panelworks.panel import Panel
from panelworks.sources.tables import read_optional, read_table, write_table

STATES_SCHEMA = T.StructType(
    [
        T.StructField("player_name", T.StringType()),
        T.StructField("year", T.LongType()),
        T.StructField("round", T.IntegerType()),
        T.StructField("cluster", T.IntegerType()),
        T.StructField("anomaly_score", T.DoubleType()),
    ]
)
SENTIMENT_SCHEMA = T.StructType(
    [
        T.StructField("player_name", T.StringType()),
        T.StructField("sentiment_score", T.DoubleType()),
    ]
)


def adjusted_score(anomaly_weight: float = 0.5) -> Column:
    return (
        F.col("round_predicted_score")
        + F.col("cluster_bonus")
        - anomaly_weight * F.col("anomaly_score")
        + F.col("sentiment_boost")
    )


def round_predictions(
    registry: DataFrame,
    fixtures: DataFrame,
    gold: DataFrame,
    states: DataFrame,
    sentiment: DataFrame,
    round_num: int,
    season: int = 2026,
    team: str | None = None,
    codes: Mapping[str, str] | None = TEAM_CODES,
    bonus: Mapping[int, float] = CLUSTER_BONUS,
    panel: Panel = Panel(),
) -> DataFrame:
    """Registry rows with opponent, bye flag, matchup score and adjusted score.

    ``team`` is the team column of the registry, ``team_<season>`` unless named. Empty ``states`` and ``sentiment`` frames stand for missing inputs.
    """
    opponents = round_opponents(fixtures, season, round_num, codes)
    df = join_opponents(registry, opponents, team or f"team_{season}")
    df = join_latest_matchup(df, gold, panel)
    df = join_states(df, states, bonus, panel)
    df = join_sentiment(df, sentiment)
    return df.withColumn("adjusted_predicted_score", adjusted_score())


def run_predictions(
    spark: SparkSession,
    round_num: int,
    registry_path: str,
    fixtures_path: str,
    gold_path: str,
    states_path: str,
    sentiment_path: str,
    path: str,
    season: int = 2026,
) -> None:
    fixtures = read_table(spark, fixtures_path)
    if round_fixtures(fixtures, season, round_num).isEmpty():
        raise ValueError(f"no fixtures for round {round_num} of {season}")
    predictions = round_predictions(
        read_table(spark, registry_path),
        fixtures,
        read_table(spark, gold_path),
        read_optional(spark, states_path, STATES_SCHEMA),
        read_optional(spark, sentiment_path, SENTIMENT_SCHEMA),
        round_num,
        season,
    )
    write_table(predictions, path)
