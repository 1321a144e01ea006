"""Lookup joins of a panel with context, fixtures, states and sentiment.

The lookups grow with the data, so none is broadcast unseen. Derived ones go
through ``attach``, which stores and counts them first; stored ones are joined
plainly, and adaptive execution broadcasts them on measured size or splits the
partition of a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelworks.functions.scalars import (
    MIN_PRICE,
    TEAM_CODES,
    clip_lower,
    coalesce_default,
    flip_name,
    is_code,
    is_min_price,
    map_default,
    recode_strict,
    round_score,
    without_apostrophe,
)
from panelworks.operators.aggregates import last_by
from panelworks.operators.layout import attach
from panelworks.panel import Panel

CONTEXT_COLUMNS = ("is_home", "ground_condition", "weather_condition")


def context_keys(panel: Panel) -> list[str]:
    return [*panel.season, panel.round, panel.team]


def join_context(
    df: DataFrame,
    context: DataFrame,
    panel: Panel = Panel(),
    cols: Sequence[str] = CONTEXT_COLUMNS,
) -> DataFrame:
    """Left join of match context on season, round and team."""
    keys = context_keys(panel)
    return df.join(context.select(*keys, *cols), keys, "left")


def derive_byes(df: DataFrame, context: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """(season, round, team) with players but without a match."""
    keys = context_keys(panel)
    seen = df.select(*keys).filter(is_code(panel.team)).distinct()
    return seen.join(context.select(*keys), keys, "left_anti").withColumn("is_bye", F.lit(True))


def flag_byes(df: DataFrame, byes: DataFrame, panel: Panel = Panel()) -> DataFrame:
    joined = attach(df, byes, context_keys(panel))
    return joined.withColumn("is_bye", coalesce_default("is_bye", False))


def add_match_context(
    df: DataFrame,
    context: DataFrame,
    panel: Panel = Panel(),
    cols: Sequence[str] = CONTEXT_COLUMNS,
) -> DataFrame:
    """``join_context`` and ``flag_byes`` in one join.

    A row is in a bye if its team has a code, its keys are known and the context
    join found nothing.
    """
    keys = context_keys(panel)
    joined = join_context(df, context.withColumn("_played", F.lit(True)), panel, [*cols, "_played"])
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    bye = F.col("_played").isNull() & known & is_code(panel.team)
    return joined.withColumn("is_bye", coalesce_default(bye, False)).drop("_played")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would multiply rows in a lookup join."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)


def add_initial_price(df: DataFrame, panel: Panel = Panel(), floor: int = MIN_PRICE) -> DataFrame:
    """Price in round 1 of the season, and the price signals that follow from it."""
    initial = df.filter(F.col(panel.round) == 1).select(
        *panel.keys, F.col(panel.price).alias("initial_price")
    )
    per_point = F.col(panel.price) / clip_lower(F.col(panel.avg_score).cast("double"), 1.0)
    return df.join(initial, panel.keys, "left").select(
        "*",
        (F.col(panel.price) - F.col("initial_price")).alias("price_vs_initial"),
        per_point.alias("price_per_point"),
        is_min_price(panel.price, floor).alias("is_min_price"),
    )


def round_fixtures(fixtures: DataFrame, season: int, round_num: int) -> DataFrame:
    """The matches of one round of one season."""
    return fixtures.filter((F.col("year") == season) & (F.col("round") == round_num))


def round_opponents(
    fixtures: DataFrame, season: int, round_num: int, codes: Mapping[str, str] | None = TEAM_CODES
) -> DataFrame:
    """Team and opponent for every known pairing of a round, in both directions.

    Only matches of ``season`` count: a team that plays the round in another season has a bye.

    ``codes=None`` means the fixtures hold codes already. A team listed twice
    keeps its last match.
    """

    def code(col: str) -> Column:
        return F.col(col) if codes is None else recode_strict(col, codes)

    pairs = round_fixtures(fixtures, season, round_num).select(
        code("home_team").alias("home"), code("away_team").alias("away"), "match_date"
    )
    sides = F.array(
        F.struct(F.col("home").alias("team"), F.col("away").alias("round_opponent")),
        F.struct(F.col("away").alias("team"), F.col("home").alias("round_opponent")),
    )
    both = (
        pairs.filter(F.col("home").isNotNull() & F.col("away").isNotNull())
        .select("match_date", F.explode(sides).alias("_side"))
        .select("match_date", "_side.*")
    )
    return both.groupBy("team").agg(
        F.max_by("round_opponent", F.struct("match_date", "round_opponent")).alias("round_opponent")
    )


def join_opponents(df: DataFrame, opponents: DataFrame, team: str) -> DataFrame:
    joined = df.join(opponents.withColumnRenamed("team", team), [team], "left")
    return joined.withColumn("is_bye", F.col("round_opponent").isNull())


def latest_matchup(gold: DataFrame, panel: Panel = Panel()) -> DataFrame:
    return last_by(
        gold,
        [*panel.entity, panel.opponent],
        {"matchup_adjusted_avg": "round_matchup_avg"},
        panel.timeline,
    )


def join_latest_matchup(df: DataFrame, gold: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Last blended matchup mean against the round's opponent, and the score it gives.

    Only the pairs of ``df`` are looked up, so the history of all others is left out before it is
    aggregated.
    """
    pair = [*panel.entity, panel.opponent]
    wanted = df.select(*panel.entity, F.col("round_opponent").alias(panel.opponent)).distinct()
    latest = latest_matchup(gold.join(wanted, pair, "left_semi"), panel)
    joined = df.join(
        latest.withColumnRenamed(panel.opponent, "round_opponent"), [*panel.entity, "round_opponent"], "left"
    )
    return joined.withColumn(
        "round_predicted_score", round_score("is_bye", "round_matchup_avg", "career_avg")
    )


def join_states(
    df: DataFrame, states: DataFrame, bonus: Mapping[int, float], panel: Panel = Panel()
) -> DataFrame:
    """Latest cluster and anomaly per entity; -1 and 0 where there is no history."""
    entity = list(panel.entity)
    known = states.join(df.select(*entity).distinct(), entity, "left_semi")
    latest = last_by(known, entity, ["cluster", "anomaly_score"], panel.timeline)
    joined = df.join(latest, entity, "left")
    return joined.withColumns(
        {
            "cluster": coalesce_default("cluster", -1).cast("int"),
            "anomaly_score": coalesce_default(F.col("anomaly_score").cast("double"), 0.0),
            "cluster_bonus": map_default("cluster", bonus),
        }
    )


def join_sentiment(
    df: DataFrame, sentiment: DataFrame, weight: float = 5.0, player: str = "player_name"
) -> DataFrame:
    """Score boost from expert sentiment; names are flipped to ``Last, First`` first.

    Names that flip to the same one are one player with the mean of their sentiments.
    """
    boosts = sentiment.groupBy(flip_name(player).alias(player)).agg(
        (F.avg(F.col("sentiment_score").cast("double")) * weight).alias("sentiment_boost")
    )
    joined = df.join(boosts, player, "left")
    return joined.withColumn("sentiment_boost", coalesce_default("sentiment_boost", 0.0))


def join_player_stats(
    current: DataFrame, career: DataFrame, form: DataFrame, panel: Panel = Panel()
) -> DataFrame:
    entity = list(panel.entity)
    return current.join(career.join(form, entity, "left"), entity, "left")


def exclude_by_name(
    df: DataFrame, others: DataFrame, player: str = "player_name", other: str = "player_name"
) -> DataFrame:
    """Drop rows whose name, without apostrophes, is among the others."""
    names = others.select(without_apostrophe(other).alias("_name"))
    return df.join(names, without_apostrophe(df[player]) == F.col("_name"), "left_anti")


def exclude_list(df: DataFrame, names: Sequence[str], player: str = "player_name") -> DataFrame:
    if not names:
        return df
    return df.filter(F.coalesce(~F.col(player).isin(*names), F.lit(True)))
