"""Checks of the panel: score reconciliation, null counts, key counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelworks.functions.scalars import action_sum, weighted_action_score
from panelworks.operators.aggregates import count_by
from panelworks.operators.windows import ACTION_SCORE_COLUMNS
from panelworks.panel import Panel


def reconcile_scores(df: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Weighted and plain action scores next to the score, with the differences."""
    weighted, plain = weighted_action_score(df), action_sum(df, ACTION_SCORE_COLUMNS)
    return df.withColumns(
        {
            "weighted_score": weighted,
            "weighted_diff": F.col(panel.score) - weighted,
            "action_score": plain,
            "action_diff": F.col(panel.score) - plain,
        }
    )


def season_quality(df: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Per season: rows, rows without an action score, largest differences."""
    season = panel.season[0]
    checked = reconcile_scores(df, panel)
    return checked.groupBy(season).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("action_score").isNull()).alias("action_score_nulls"),
        F.count_if(F.col(panel.score).isNull()).alias("score_nulls"),
        F.max(F.abs("weighted_diff")).alias("max_weighted_diff"),
        F.max(F.abs("action_diff")).alias("max_action_diff"),
    )


def null_score_seasons(df: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Rows without an action score, counted per season."""
    missing = action_sum(df, ACTION_SCORE_COLUMNS).isNull()
    return count_by(df.filter(missing), panel.season[0], name="rows").orderBy(panel.season[0])


def leftover_positions(df: DataFrame, marks: Sequence[str] = ("5/8",)) -> DataFrame:
    """Positions that should have been rewritten; empty when all is well."""
    return count_by(df.filter(F.col("primary_position").isin(*marks)), "primary_position")
