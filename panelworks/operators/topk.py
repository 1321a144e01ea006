"""Ranked extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, by: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The ``n`` largest values, nulls counted as largest; each task keeps ``n`` rows."""
    return df.orderBy(F.col(by).desc_nulls_first(), *ties).limit(n)


def top_predictions(predictions: DataFrame, n: int = 20) -> DataFrame:
    """Best predicted players that have a match and are likely to play."""
    rows = predictions.filter(~F.col("is_bye") & F.col("likely_to_play"))
    return top_n(rows, "round_predicted_score", n, ["player_name"])


def top_features(importance: DataFrame, n: int = 30) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)


def metric_leaderboard(metrics: DataFrame, by: str = "val_mae") -> DataFrame:
    return metrics.orderBy(by)


def roster_listing(roster: DataFrame, score: str) -> DataFrame:
    return roster.orderBy("assigned_position", F.col(score).desc(), "player_name")
