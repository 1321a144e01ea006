"""Player registry of the running season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.functions.scalars import flip_name, likely_to_play, sentiment_adjust
from panelworks.operators.aggregates import career_stats, last_by, recent_form
from panelworks.operators.cleaning import (
    POSITION_DENY,
    cast_tolerant,
    keep_numeric_id,
    parse_money,
    replace_first,
    require_text,
    split_positions,
)
from panelworks.operators.joins import join_player_stats
from panelworks.panel import Panel
from panelworks.sources.tables import export_csv, read_table, table_if_there, write_table


def current_players(bronze: DataFrame, season: int = 2026, dedupe: bool = True) -> DataFrame:
    """Players of the running season from its grid.

    ``dedupe`` keeps one row per player, the latest round; the totals row counts
    as the earliest.
    """
    rows = require_text(keep_numeric_id(bronze), ["Name", "Posn"], {"Posn": POSITION_DENY})
    primary, secondary = split_positions(replace_first("Posn", "5/8", "5_8"))
    players = rows.select(
        F.col("Name").alias("player_name"),
        F.col("Team").alias(f"team_{season}"),
        parse_money("Price", strict=True).alias(f"price_{season}"),
        cast_tolerant("BE", "int").alias(f"break_even_{season}"),
        primary.alias(f"position_{season}"),
        secondary.alias(f"secondary_position_{season}"),
        cast_tolerant("Rd", "int").alias("_round"),
        F.col("id").alias("_id"),
    )
    cols = [c for c in players.columns if c not in ("player_name", "_round", "_id")]
    if not dedupe:
        return players.select("player_name", *cols)
    return last_by(players, ["player_name"], cols, ["_round", "_id"])


def players_from_gold(
    gold: DataFrame, from_season: int, season: int = 2026, panel: Panel = Panel()
) -> DataFrame:
    """Stand-in where the season has no grid yet: last row of the season before."""
    picked = {
        panel.price: f"price_{season}",
        panel.position: f"position_{season}",
        panel.team: f"team_{season}",
        panel.break_even: f"break_even_{season}",
    }
    rows = gold.filter(F.col(panel.season[0]) == from_season)
    last = last_by(rows, list(panel.entity), picked, list(panel.seq))
    return last.withColumn(f"secondary_position_{season}", F.lit(None).cast("string"))


def predicted_score(career: str = "career_avg", recent: str = "last3_avg") -> Column:
    """60 % career and 40 % recent form, or career alone."""
    blended = F.col(career) * 0.6 + F.col(recent) * 0.4
    return F.when(F.col(recent).isNotNull(), blended).otherwise(F.col(career))


def eligible(min_games: int = 10) -> Column:
    return (F.col("career_games") >= min_games) | F.col("career_avg").isNull()


def join_expert_view(registry: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Expert sentiment under the flipped name, and the score adjusted by it.

    Of names that flip to the same one, the most confident view counts.
    """
    view = (
        sentiment.groupBy(flip_name("player_name").alias("player_name"))
        .agg(F.max(F.struct("confidence", "sentiment_score", "recommendation", "key_insight")).alias("_view"))
        .select(
            "player_name",
            F.col("_view.sentiment_score").alias("sentiment_score"),
            F.col("_view.confidence").alias("sentiment_confidence"),
            F.col("_view.recommendation").alias("expert_recommendation"),
            F.col("_view.key_insight").alias("expert_insight"),
        )
    )
    joined = registry.join(view, "player_name", "left")
    adjusted = sentiment_adjust("predicted_score", "sentiment_score", "sentiment_confidence")
    return joined.withColumn("predicted_score", adjusted)


def player_registry(
    gold: DataFrame,
    players: DataFrame,
    form_season: int = 2025,
    sentiment: DataFrame | None = None,
    panel: Panel = Panel(),
) -> DataFrame:
    stats = join_player_stats(
        players, career_stats(gold, panel), recent_form(gold, form_season, panel), panel
    )
    registry = stats.filter(eligible()).withColumns(
        {
            "predicted_score": predicted_score(),
            "likely_to_play": likely_to_play("last3_avg_mins"),
        }
    )
    return registry if sentiment is None else join_expert_view(registry, sentiment)


def run_registry(
    spark: SparkSession,
    gold_path: str,
    bronze_path: str | None,
    path: str,
    csv_path: str | None = None,
    sentiment_path: str | None = None,
    season: int = 2026,
) -> None:
    """Registry from the season's grid, or from last season where there is no grid yet.

    The sentiment table is used if it is there.
    """
    gold = read_table(spark, gold_path)
    bronze = table_if_there(spark, bronze_path)
    if bronze is not None:
        players = current_players(bronze, season)
    else:
        players = players_from_gold(gold, season - 1, season)
    sentiment = table_if_there(spark, sentiment_path)
    write_table(player_registry(gold, players, season - 1, sentiment), path)
    if csv_path:
        ranked = F.col("predicted_score").desc_nulls_first()
        export_csv(read_table(spark, path), csv_path, ranked, "player_name")
