"""Aggregates and ranked extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.checks.book import frame_mean, r8, register
from panelworks.checks.panels import (
    CO,
    EV,
    EVENTS,
    LI,
    SUPPLY,
    event_panel,
    match_panel,
    rounded,
    supply_panel,
    table,
)
from panelworks.operators import aggregates as a
from panelworks.operators.topk import top_n
from panelworks.operators.windows import add_features, lags, lead, rolling_mean

OVER = "PARTITION BY player_name, year ORDER BY ts, event_id"


@register(
    "best_form_top_20",
    f"""WITH {EV}, f AS (SELECT player_name, year, ts, event_id,
      {frame_mean('score', -2, 0, 3, OVER)} AS form FROM ev),
    l AS (SELECT player_name, form, row_number() OVER
      (PARTITION BY player_name ORDER BY year DESC, ts DESC, event_id DESC) AS rn FROM f),
    c AS (SELECT player_name, avg(score) AS career_avg FROM ev GROUP BY 1)
    SELECT player_name, {r8('form', 'form')}, {r8('career_avg', 'career_avg')}
    FROM l JOIN c USING (player_name) WHERE rn = 1
    ORDER BY l.form DESC NULLS FIRST, player_name LIMIT 20""",
)
def best_form(spark: SparkSession, sf: str) -> DataFrame:
    """Entities ranked by their latest rolling mean, next to their career mean."""
    panel = event_panel(spark, sf)
    latest = a.latest_rolling_mean(panel, EVENTS, "score", 3, "form")
    careers = a.mean_score(panel, ["player_name"], "score", "career_avg")
    return rounded(top_n(latest.join(careers, "player_name"), "form", 20, ["player_name"]))


@register(
    "career_average",
    f"""WITH {EV} SELECT event_id, {r8('avg(score) OVER (PARTITION BY player_name)', 'career_avg')}
    FROM ev""",
)
def career_average(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(a.add_career_avg(event_panel(spark, sf), EVENTS), "event_id", "career_avg")


CAREER = """SELECT player_name, avg(score) AS career_avg, stddev_samp(score) AS career_std,
    avg(mins) AS career_avg_mins, count(score) AS career_games FROM {t} GROUP BY player_name"""


@register(
    "career_stats",
    f"""WITH {EV}, c AS ({CAREER.format(t='ev')}) SELECT player_name, career_games,
    {r8('career_avg', 'career_avg')}, {r8('career_std', 'career_std')},
    {r8('career_avg_mins', 'career_avg_mins')} FROM c""",
)
def career_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(a.career_stats(event_panel(spark, sf), EVENTS))


FORM = """SELECT player_name,
    avg(score) AS last5_avg, avg(score) FILTER (rn <= 3) AS last3_avg,
    avg(mins) FILTER (rn <= 3) AS last3_avg_mins, max(round) AS last_round_played,
    max(primary_position) FILTER (rn = 1) AS primary_position
    FROM (SELECT *, row_number() OVER (PARTITION BY player_name ORDER BY {o}) AS rn
          FROM {t} WHERE year = 2025) WHERE rn <= 5 GROUP BY player_name"""


@register(
    "recent_form",
    f"""WITH {EV}, f AS ({FORM.format(t='ev', o='ts DESC, event_id DESC')})
    SELECT player_name, {r8('last5_avg', 'last5_avg')}, {r8('last3_avg', 'last3_avg')},
    {r8('last3_avg_mins', 'last3_avg_mins')}, last_round_played, primary_position FROM f""",
)
def recent_form(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(a.recent_form(event_panel(spark, sf), 2025, EVENTS))


@register(
    "last_state_per_player",
    f"""WITH {EV} SELECT player_name, score, price FROM (
      SELECT *, row_number() OVER (PARTITION BY player_name ORDER BY year DESC, ts DESC, event_id DESC)
      AS rn FROM ev) WHERE rn = 1""",
)
def last_state(spark: SparkSession, sf: str) -> DataFrame:
    panel = event_panel(spark, sf)
    return rounded(a.last_by(panel, ["player_name"], ["score", "price"], EVENTS.timeline))


STRENGTH = """SELECT opponent, primary_position, avg(lagged) AS opponent_avg_pts_allowed FROM (
      SELECT *, lag(score) OVER (PARTITION BY opponent, primary_position
        ORDER BY {o}) AS lagged FROM {t}) GROUP BY opponent, primary_position"""


@register(
    "opponent_strength",
    f"""WITH {EV}, s AS ({STRENGTH.format(t='ev', o='year, ts, event_id, player_name')})
    SELECT event_id, {r8('opponent_avg_pts_allowed', 'opponent_avg_pts_allowed')}
    FROM ev LEFT JOIN s USING (opponent, primary_position)""",
)
def opponent_strength(spark: SparkSession, sf: str) -> DataFrame:
    df = a.add_opponent_strength(event_panel(spark, sf), EVENTS)
    return rounded(df, "event_id", "opponent_avg_pts_allowed")


def turn_records(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as insight records about the document languages."""
    text = F.col("text")
    return table(spark, sf, "conversations").select(
        F.concat(F.lit("Player "), F.col("conv_id") % 37).alias("player_name"),
        F.when(F.col("turn") > 0, F.col("role")).alias("team"),
        F.col("role").alias("position"),
        ((F.length(text) % 21 - 10) / 10).cast("float").alias("sentiment_score"),
        (F.length(text) % 11 / 10).cast("float").alias("confidence"),
        F.when(F.length(text) % 2 == 0, F.lit("buy")).otherwise(F.lit("hold")).alias("recommendation"),
        F.concat(F.lit("said "), F.length(text)).alias("key_insight"),
        F.concat(F.lit("u/"), "conv_id", F.lit("/"), "turn").alias("source_url"),
        "conv_id",
        "turn",
    )


TURNS = """
tr AS (
  SELECT 'Player ' || (conv_id % 37) AS player_name, CASE WHEN turn > 0 THEN role END AS team,
         role AS position, CAST((length(text) % 21 - 10) / 10 AS FLOAT) AS sentiment_score,
         CAST((length(text) % 11) / 10 AS FLOAT) AS confidence,
         CASE WHEN length(text) % 2 = 0 THEN 'buy' ELSE 'hold' END AS recommendation,
         'said ' || length(text) AS key_insight, 'u/' || conv_id || '/' || turn AS source_url,
         conv_id, turn
  FROM conversations
)"""


@register(
    "insights_per_player",
    f"""WITH {TURNS}, n AS (SELECT *, row_number() OVER (PARTITION BY player_name
      ORDER BY conv_id DESC, turn DESC) AS rn, row_number() OVER (PARTITION BY player_name
      ORDER BY sentiment_score DESC, conv_id DESC, turn DESC) AS best FROM tr)
    SELECT player_name, max(team) FILTER (rn = 1) AS team, max(position) FILTER (rn = 1) AS position,
    round(avg(CAST(sentiment_score AS DOUBLE)), 3) AS sentiment_score,
    round(avg(CAST(confidence AS DOUBLE)), 3) AS confidence,
    max(recommendation) FILTER (best = 1) AS recommendation,
    max(key_insight) FILTER (rn = 1) AS key_insight,
    string_agg(source_url, ', ' ORDER BY conv_id, turn) AS sources FROM n GROUP BY player_name""",
)
def insights_per_player(spark: SparkSession, sf: str) -> DataFrame:
    return a.aggregate_insights(turn_records(spark, sf), ["conv_id", "turn"])


@register(
    "insight_source_rows",
    f"""WITH {TURNS} SELECT player_name, row_number() OVER (PARTITION BY player_name ORDER BY conv_id, turn) AS no,
    source_url FROM tr""",
)
def insight_source_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = a.source_rows(turn_records(spark, sf), ["player_name"], "source_url", ["conv_id", "turn"])
    return rows.select("player_name", "no", "source_url")


@register(
    "context_rows_per_season",
    f"WITH {CO} SELECT year, count(*) AS count FROM co GROUP BY year",
)
def context_rows_per_season(spark: SparkSession, sf: str) -> DataFrame:
    return a.count_by(match_panel(spark, sf), "year")


@register(
    "playing_teams",
    f"WITH {CO} SELECT DISTINCT year, round, team FROM co",
)
def playing_teams(spark: SparkSession, sf: str) -> DataFrame:
    return a.distinct_keys(match_panel(spark, sf), "year", "round", "team")


@register("number_of_teams", f"WITH {CO} SELECT count(DISTINCT team) AS teams FROM co")
def number_of_teams(spark: SparkSession, sf: str) -> DataFrame:
    return a.count_distinct(match_panel(spark, sf), "team", "teams")


@register(
    "null_and_flag_profile",
    f"""WITH {EV} SELECT count(*) AS rows, count(*) - count(score) AS score_nulls,
    count(*) FILTER (mins >= 40) AS long_true FROM ev""",
)
def null_and_flag_profile(spark: SparkSession, sf: str) -> DataFrame:
    panel = event_panel(spark, sf).withColumn("long", F.col("mins") >= 40)
    return a.profile(panel, nulls=["score"], flags=["long"])


@register(
    "cluster_profile",
    f"""WITH {LI} SELECT primary_position, count(*) AS n, {r8('avg(price)', 'avg_price')},
    {r8('avg(score)', 'avg_score')} FROM li GROUP BY primary_position""",
)
def cluster_profile(spark: SparkSession, sf: str) -> DataFrame:
    panel = supply_panel(spark, sf)
    return rounded(a.cluster_profile(panel, ["price", "score"], by="primary_position"))


METRICS = """count(*) AS n, round(avg(abs(score - price / 10000.0)), 8) AS mae,
    round(sqrt(avg((score - price / 10000.0) ** 2)), 8) AS rmse"""


@register(
    "regression_metrics",
    f"WITH {EV} SELECT {METRICS} FROM ev WHERE score IS NOT NULL",
)
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    panel = event_panel(spark, sf).filter(F.col("score").isNotNull())
    guess = panel.withColumn("guess", F.col("price") / 10000)
    return rounded(a.regression_metrics(guess, "score", "guess"))


@register(
    "regression_metrics_by_position",
    f"""WITH {EV} SELECT primary_position, {METRICS} FROM ev WHERE score IS NOT NULL
    GROUP BY primary_position HAVING count(*) >= 10""",
)
def regression_metrics_by_position(spark: SparkSession, sf: str) -> DataFrame:
    panel = event_panel(spark, sf).filter(F.col("score").isNotNull())
    guess = panel.withColumn("guess", F.col("price") / 10000)
    return rounded(a.regression_metrics(guess, "score", "guess", by="primary_position"))


def baseline_sql(col: str) -> str:
    gap = f"(target - coalesce({col}, 0))"
    return f"""SELECT '{col}' AS baseline, count(*) AS n, {r8(f'avg(abs({gap}))', 'mae')},
      {r8(f'sqrt(avg({gap} * {gap}))', 'rmse')} FROM t WHERE target IS NOT NULL"""


@register(
    "baseline_metrics",
    f"""WITH {EV}, t AS (SELECT lead(score) OVER ({OVER}) AS target,
      lag(score) OVER ({OVER}) AS score_lag_1,
      {frame_mean('score', -2, 0, 3, OVER)} AS rolling_avg_3 FROM ev)
    {baseline_sql('score_lag_1')} UNION ALL {baseline_sql('rolling_avg_3')}""",
)
def baseline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    families = [
        lags("score", (1,), "score"),
        rolling_mean("score", 3, "rolling_avg_3"),
        lead("score", "target"),
    ]
    rows = add_features(event_panel(spark, sf), EVENTS, families)
    known = rows.filter(F.col("target").isNotNull())
    return rounded(a.baseline_metrics(known, "target", ["score_lag_1", "rolling_avg_3"]))


@register(
    "top_scores_nulls_first",
    f"""WITH {EV} SELECT event_id, score FROM ev
    ORDER BY score DESC NULLS FIRST, event_id LIMIT 20""",
)
def top_scores(spark: SparkSession, sf: str) -> DataFrame:
    panel = event_panel(spark, sf).select("event_id", "score")
    return rounded(top_n(panel, "score", 20, ["event_id"]))


@register(
    "supply_career_stats",
    f"""WITH {LI}, c AS ({CAREER.format(t='li')}) SELECT player_name, career_games,
    {r8('career_avg', 'career_avg')}, {r8('career_std', 'career_std')},
    {r8('career_avg_mins', 'career_avg_mins')} FROM c""",
)
def supply_career_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(a.career_stats(supply_panel(spark, sf), SUPPLY))
