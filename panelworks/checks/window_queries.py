"""Window features on the events panel and the supply panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.checks.book import frame_mean, r8, register
from panelworks.checks.panels import (
    EV,
    EVENTS,
    FLAGS,
    LI,
    SUPPLY,
    event_panel,
    rounded,
    stored,
    supply_panel,
    table,
)
from panelworks.operators import windows as w
from panelworks.operators.aggregates import add_career_avg, add_opponent_strength

OVER = "PARTITION BY player_name, year ORDER BY ts, event_id"
LI_OVER = "PARTITION BY player_name, year ORDER BY round"
LI_KEYS = ("player_name", "year", "round")


@register(
    "score_lags",
    f"""WITH {EV} SELECT event_id,
    lag(score, 1) OVER ({OVER}) AS score_lag_1,
    lag(score, 2) OVER ({OVER}) AS score_lag_2,
    lag(score, 3) OVER ({OVER}) AS score_lag_3,
    lag(round_price_change, 1) OVER ({OVER}) AS price_change_lag_1,
    lag(round_price_change, 2) OVER ({OVER}) AS price_change_lag_2 FROM ev""",
)
def score_lags(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        w.add_lags(event_panel(spark, sf), EVENTS),
        "event_id", "score_lag_1", "score_lag_2", "score_lag_3",
        "price_change_lag_1", "price_change_lag_2",
    )


@register(
    "rolling_mean_and_deviation",
    f"""WITH {EV} SELECT event_id,
    {r8(frame_mean('score', -2, 0, 3, OVER), 'rolling_avg_3')},
    {r8(frame_mean('score', -4, 0, 5, OVER), 'rolling_avg_5')},
    {r8(frame_mean('score', -2, 0, 3, OVER, 'stddev_samp'), 'rolling_std_3')},
    {r8(frame_mean('score', -4, 0, 5, OVER, 'stddev_samp'), 'rolling_std_5')},
    {r8(frame_mean('round_price_change', -2, 0, 3, OVER), 'price_momentum_3')} FROM ev""",
)
def rolling(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        w.add_rolling(event_panel(spark, sf), EVENTS),
        "event_id", "rolling_avg_3", "rolling_avg_5", "rolling_std_3", "rolling_std_5",
        "price_momentum_3",
    )


ACTION_SUM = " + ".join(f for f in FLAGS)


@register(
    "action_score",
    f"""WITH {LI}, s AS (SELECT *, {ACTION_SUM} AS action_score FROM li)
    SELECT player_name, year, round, action_score,
    lag(action_score) OVER ({LI_OVER}) AS action_score_lag_1,
    {r8(frame_mean('action_score', -2, 0, 3, LI_OVER), 'action_score_rolling_3')},
    {r8(frame_mean('action_score', -4, 0, 5, LI_OVER), 'action_score_rolling_5')} FROM s""",
)
def action_score(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        w.add_action_score(stored(supply_panel(spark, sf)), SUPPLY),
        *LI_KEYS, "action_score", "action_score_lag_1", "action_score_rolling_3",
        "action_score_rolling_5",
    )


@register(
    "form_trend",
    f"""WITH {EV} SELECT event_id,
    {r8('(' + frame_mean('score', -2, 0, 3, OVER) + ') - (' + frame_mean('score', -5, -3, 3, OVER) + ')', 'form_trend')}
    FROM ev""",
)
def form_trend(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(w.add_form_trend(event_panel(spark, sf), EVENTS), "event_id", "form_trend")


@register(
    "season_average_to_date",
    f"""WITH {EV} SELECT event_id,
    {r8(frame_mean('score', -27, -1, 1, OVER), 'season_avg_to_date')} FROM ev""",
)
def season_average_to_date(spark: SparkSession, sf: str) -> DataFrame:
    df = w.add_average_to_date(event_panel(spark, sf), EVENTS)
    return rounded(df, "event_id", "season_avg_to_date")


BEATEN = " + ".join(f"CAST(lag(be_gap, {i}) OVER ({OVER}) > 0 AS INTEGER)" for i in (1, 2, 3))


@register(
    "break_even_features",
    f"""WITH {EV}, g AS (SELECT *, score - break_even AS be_gap FROM ev)
    SELECT event_id, be_gap,
    {r8(frame_mean('be_gap', -2, 0, 3, OVER), 'avg_be_gap_3rd')},
    lag(be_gap) OVER ({OVER}) AS be_gap_lag_1,
    {BEATEN} AS consecutive_be_beaten FROM g""",
)
def break_even(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        w.add_break_even(event_panel(spark, sf), EVENTS),
        "event_id", "be_gap", "avg_be_gap_3rd", "be_gap_lag_1", "consecutive_be_beaten",
    )


STATS = [*[c for c in w.ACTION_STAT_COLUMNS if c in FLAGS], "mins", "bppm"]


def lagged_sql(over: str) -> str:
    parts = []
    for c in STATS:
        lag = f"lag({c}) OVER ({over})"
        parts.append(r8(lag, f"{c}_lag_1") if c == "bppm" else f"{lag} AS {c}_lag_1")
        parts.append(r8(frame_mean(c, -3, -1, 3, over), f"{c}_roll_avg_3"))
        parts.append(r8(frame_mean(c, -5, -1, 5, over), f"{c}_roll_avg_5"))
    return ",\n".join(parts)


LAGGED_NAMES = [f"{c}_{s}" for c in STATS for s in ("lag_1", "roll_avg_3", "roll_avg_5")]


@register(
    "lagged_action_stats",
    f"WITH {LI} SELECT player_name, year, round, {lagged_sql(LI_OVER)} FROM li",
)
def lagged_action_stats(spark: SparkSession, sf: str) -> DataFrame:
    df = w.add_lagged_stats(stored(supply_panel(spark, sf)), SUPPLY)
    return rounded(df, *LI_KEYS, *LAGGED_NAMES)


BY_OPPONENT = "PARTITION BY player_name, year ORDER BY opponent, round"


@register(
    "lagged_action_stats_by_opponent",
    f"WITH {LI} SELECT player_name, year, round, {lagged_sql(BY_OPPONENT)} FROM li",
)
def lagged_action_stats_by_opponent(spark: SparkSession, sf: str) -> DataFrame:
    panel = stored(supply_panel(spark, sf))
    df = w.add_lagged_stats(panel, SUPPLY, order=["opponent", "round"])
    return rounded(df, *LI_KEYS, *LAGGED_NAMES)


VS = "PARTITION BY player_name, opponent ORDER BY year, ts, event_id"
ENCOUNTERS = f"""
lagged AS (SELECT *, lag(score) OVER ({VS}) AS prev FROM ev),
enc AS (
  SELECT *, CAST(count(prev) OVER ({VS} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS games_vs_opponent,
  CASE WHEN prev IS NOT NULL THEN sum(prev) OVER ({VS} ROWS UNBOUNDED PRECEDING)
       / count(prev) OVER ({VS} ROWS UNBOUNDED PRECEDING) END AS player_vs_opponent_avg
  FROM lagged
)"""


@register(
    "prior_encounters",
    f"""WITH {EV}, {ENCOUNTERS} SELECT event_id, games_vs_opponent,
    {r8('player_vs_opponent_avg', 'player_vs_opponent_avg')} FROM enc""",
)
def prior_encounters(spark: SparkSession, sf: str) -> DataFrame:
    df = w.add_prior_encounters(event_panel(spark, sf), EVENTS)
    return rounded(df, "event_id", "games_vs_opponent", "player_vs_opponent_avg")


@register(
    "matchup_blend",
    f"""WITH {EV}, {ENCOUNTERS},
    career AS (SELECT player_name, avg(score) AS career_avg FROM ev GROUP BY 1),
    b AS (SELECT *, least(games_vs_opponent / 5.0, 1.0) AS w FROM enc JOIN career USING (player_name))
    SELECT event_id, {r8('''CASE WHEN games_vs_opponent = 0 THEN career_avg
      ELSE w * player_vs_opponent_avg + (1 - w) * career_avg END''', 'matchup_adjusted_avg')} FROM b""",
)
def matchup_blend(spark: SparkSession, sf: str) -> DataFrame:
    df = w.add_prior_encounters(event_panel(spark, sf), EVENTS)
    return rounded(w.blend_with_career(add_career_avg(df, EVENTS)), "event_id", "matchup_adjusted_avg")


def rank_sql(col: str, by: str, name: str) -> str:
    return (
        f"CAST(CASE WHEN {col} IS NOT NULL THEN rank() OVER (PARTITION BY {by} ORDER BY {col} NULLS LAST)"
        f" + (count(*) OVER (PARTITION BY {by}, {col}) - 1) / 2.0 END AS DOUBLE) AS {name}"
    )


@register(
    "average_ranks",
    f"""WITH {EV} SELECT event_id,
    {rank_sql('price', 'year, round, primary_position', 'price_rank_in_position')},
    {rank_sql('score', 'year, round, primary_position', 'score_rank_in_position')}
    FROM ev""",
)
def average_ranks(spark: SparkSession, sf: str) -> DataFrame:
    df = w.add_price_ranks(event_panel(spark, sf), EVENTS)
    return rounded(df, "event_id", "price_rank_in_position", "score_rank_in_position")


@register(
    "next_round_target",
    f"""WITH {EV}, t AS (SELECT *, lead(score) OVER ({OVER}) AS target FROM ev)
    SELECT event_id, target AS target_score FROM t WHERE target IS NOT NULL AND mins >= 5""",
)
def next_round_target(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(w.lead_target(event_panel(spark, sf), EVENTS), "event_id", "target_score")


@register(
    "carry_forward_speaker",
    """SELECT conv_id, turn, last_value(CASE WHEN role <> 'assistant' THEN role END IGNORE NULLS)
    OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS asked_by FROM conversations""",
)
def carry_forward(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    asked = turns.withColumn("_asked", F.when(F.col("role") != "assistant", F.col("role")))
    carried = w.carry_forward(asked, ["conv_id"], ["turn"], "_asked", "asked_by")
    return carried.select("conv_id", "turn", "asked_by")


PIT = "ORDER BY year, ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@register(
    "career_average_as_of",
    f"""WITH {EV} SELECT event_id,
    {r8(f'avg(score) OVER (PARTITION BY player_name {PIT})', 'career_avg')} FROM ev""",
)
def career_average_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(w.add_career_avg_as_of(event_panel(spark, sf), EVENTS), "event_id", "career_avg")


@register(
    "opponent_strength_as_of",
    f"""WITH {EV} SELECT event_id,
    {r8(f'avg(score) OVER (PARTITION BY opponent, primary_position {PIT})', 'opponent_avg_pts_allowed')}
    FROM ev""",
)
def opponent_strength_as_of(spark: SparkSession, sf: str) -> DataFrame:
    df = add_opponent_strength(event_panel(spark, sf), EVENTS, expanding=True)
    return rounded(df, "event_id", "opponent_avg_pts_allowed")
