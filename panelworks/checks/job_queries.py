"""The composed jobs, run on the panels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.checks.book import frame_mean, r8, register
from panelworks.checks.cleaning_queries import BZ, SILVER
from panelworks.checks.join_queries import BYES, CONTEXT, SEASON, coded_context, opponents_sql
from panelworks.checks.panels import (
    FX,
    LI,
    NATION_CODES,
    SUPPLY,
    bronze_grid,
    fixture_list,
    pick,
    rounded,
    sql_list,
    sql_map,
    stored,
    supply_panel,
    table,
)
from panelworks.checks.source_queries import (
    FEED_ROWS,
    PAGE_ROWS,
    reply_texts,
    season_feeds,
    weather_pages,
)
from panelworks.checks.roster_queries import searched
from panelworks.checks.summary_queries import CAREER, FORM, STRENGTH, TURNS
from panelworks.checks.window_queries import ACTION_SUM, LI_OVER, rank_sql
from panelworks.operators.cleaning import conform_silver
from panelworks.operators.joins import latest_matchup
from panelworks.operators.roster import RosterRules
from panelworks.operators.topk import top_predictions
from panelworks.plans import quality
from panelworks.plans.context import match_context
from panelworks.plans.gold import gold_features
from panelworks.plans.insights import insight_weights
from panelworks.plans.predictions import round_predictions
from panelworks.plans.registry import current_players, player_registry, players_from_gold
from panelworks.plans.squad import round_roster, season_rules
from panelworks.plans.states import player_states
from panelworks.plans.training import metric_rows, train_scores, training_rows
from panelworks.sources.tables import union_drift

KEYS = ("player_name", "year", "round")


@register(
    "silver_from_drifting_seasons",
    f"""WITH {BZ}, {SILVER} SELECT * REPLACE (CASE WHEN year >= 2022 THEN "TR" END AS "TR") FROM silver""",
)
def silver_from_seasons(spark: SparkSession, sf: str) -> DataFrame:
    """Early seasons lack a column; each part is conformed on its own, then united."""
    grid = bronze_grid(spark, sf)
    early, late = grid.filter(F.col("year") < 2022).drop("TR"), grid.filter(F.col("year") >= 2022)
    return rounded(union_drift([conform_silver(early), conform_silver(late)]))


# --- gold ---------------------------------------------------------------------------

GOLD = f"""
strength AS ({STRENGTH.format(t='li', o='year, round, player_name')}),
career AS (SELECT player_name, avg(score) AS career_avg FROM li GROUP BY 1),
first_price AS (SELECT player_name, year, price AS initial_price FROM li WHERE round = 1),
byes AS ({BYES}),
lagged AS (SELECT *, score - break_even AS be_gap, lag(score) OVER
  (PARTITION BY player_name, opponent ORDER BY year, round) AS prev FROM li),
enc AS (SELECT *,
  count(prev) OVER (PARTITION BY player_name, opponent ORDER BY year, round ROWS UNBOUNDED PRECEDING) AS games,
  sum(prev) OVER (PARTITION BY player_name, opponent ORDER BY year, round ROWS UNBOUNDED PRECEDING) AS total
  FROM lagged),
gold AS (SELECT enc.*, initial_price, opponent_avg_pts_allowed, career_avg, is_home,
  coalesce(is_bye, false) AS is_bye,
  lag(score, 1) OVER ({LI_OVER}) AS score_lag_1,
  lag(score, 3) OVER ({LI_OVER}) AS score_lag_3,
  lag(round_price_change, 2) OVER ({LI_OVER}) AS price_change_lag_2,
  {frame_mean('score', -4, 0, 5, LI_OVER)} AS rolling_avg_5,
  {frame_mean('score', -2, 0, 3, LI_OVER, 'stddev_samp')} AS rolling_std_3,
  ({frame_mean('score', -2, 0, 3, LI_OVER)}) - ({frame_mean('score', -5, -3, 3, LI_OVER)}) AS form_trend,
  {frame_mean('score', -27, -1, 1, LI_OVER)} AS season_avg_to_date,
  {frame_mean('be_gap', -2, 0, 3, LI_OVER)} AS avg_be_gap_3rd,
  {frame_mean('"TR"', -3, -1, 3, LI_OVER)} AS tr_roll,
  {frame_mean('mins', -5, -1, 5, LI_OVER)} AS mins_roll,
  CASE WHEN games = 0 THEN career_avg ELSE
    least(games / 5.0, 1.0) * (CASE WHEN prev IS NOT NULL THEN total / games END)
    + (1 - least(games / 5.0, 1.0)) * career_avg END AS matchup_adjusted_avg,
  {rank_sql('price', 'year, round, primary_position', 'price_rank')},
  {rank_sql('score', 'year, round, primary_position', 'score_rank')}
  FROM enc LEFT JOIN strength USING (opponent, primary_position) LEFT JOIN career USING (player_name)
  LEFT JOIN first_price USING (player_name, year)
  LEFT JOIN (SELECT year, round, team, is_home FROM cx) USING (year, round, team)
  LEFT JOIN byes USING (year, round, team))"""
GOLD_CTE = f"{LI}, {CONTEXT}, {GOLD}"


def gold(spark: SparkSession, sf: str, silver: DataFrame | None = None) -> DataFrame:
    silver = silver or stored(supply_panel(spark, sf))
    return gold_features(silver, coded_context(spark, sf), SUPPLY)


@register(
    "gold_features",
    f"""WITH {GOLD_CTE} SELECT player_name, year, round, score_lag_1, score_lag_3, price_change_lag_2,
    {r8('rolling_avg_5', 'rolling_avg_5')}, {r8('rolling_std_3', 'rolling_std_3')},
    {r8('form_trend', 'form_trend')}, {r8('season_avg_to_date', 'season_avg_to_date')}, be_gap,
    {r8('avg_be_gap_3rd', 'avg_be_gap_3rd')}, {r8('tr_roll', 'tr_roll')}, {r8('mins_roll', 'mins_roll')},
    price - initial_price AS price_vs_initial, {r8('opponent_avg_pts_allowed', 'opponent_avg_pts_allowed')},
    {r8('career_avg', 'career_avg')}, CAST(games AS BIGINT) AS games_vs_opponent,
    {r8('matchup_adjusted_avg', 'matchup_adjusted_avg')}, price_rank,
    score_rank, is_home, is_bye FROM gold""",
)
def gold_query(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        gold(spark, sf).select(
            *KEYS, "score_lag_1", "score_lag_3", "price_change_lag_2", "rolling_avg_5",
            "rolling_std_3", "form_trend", "season_avg_to_date", "be_gap", "avg_be_gap_3rd",
            F.col("TR_roll_avg_3").alias("tr_roll"), F.col("mins_roll_avg_5").alias("mins_roll"),
            "price_vs_initial", "opponent_avg_pts_allowed", "career_avg", "games_vs_opponent",
            "matchup_adjusted_avg", F.col("price_rank_in_position").alias("price_rank"),
            F.col("score_rank_in_position").alias("score_rank"), "is_home", "is_bye",
        )
    )


#: The statistics of the supply panel that become lagged features.
LAGGED = ("TR", "TA", "GO", "FG", "TB", "MT", "mins", "bppm")


def _every_feature() -> dict[str, str]:
    """SQL of each feature of the gold table by its name, over the rows of ``wide``."""

    def lag(col: str, n: int) -> str:
        return f"lag({col}, {n}) OVER ({LI_OVER})"

    def mean(col: str, n: int, skip: int = 0, fn: str = "avg") -> str:
        return f"CAST({frame_mean(col, 1 - n - skip, -skip, n, LI_OVER, fn)} AS DOUBLE)"

    features = {
        "price_rank_in_position": "price_rank",
        "score_rank_in_position": "score_rank",
        "initial_price": "initial_price",
        "price_vs_initial": "price - initial_price",
        "price_per_point": "price / greatest(CAST(avg_score AS DOUBLE), 1.0)",
        "is_min_price": "price <= 102400 * 1.1",
        "is_home": "is_home",
        "ground_condition": "ground_condition",
        "weather_condition": "weather_condition",
        "is_bye": "is_bye",
        "opponent_avg_pts_allowed": "opponent_avg_pts_allowed",
        "action_score": "action_score",
        "be_gap": "be_gap",
        "career_avg": "career_avg",
        "games_vs_opponent": "CAST(games AS BIGINT)",
        "player_vs_opponent_avg": "CASE WHEN prev IS NOT NULL THEN total / games END",
        "matchup_adjusted_avg": "matchup_adjusted_avg",
        "score_lag_1": lag("score", 1),
        "score_lag_2": lag("score", 2),
        "score_lag_3": lag("score", 3),
        "price_change_lag_1": lag("round_price_change", 1),
        "price_change_lag_2": lag("round_price_change", 2),
        "action_score_lag_1": lag("action_score", 1),
        "action_score_rolling_3": mean("action_score", 3),
        "action_score_rolling_5": mean("action_score", 5),
        "rolling_avg_3": mean("score", 3),
        "rolling_avg_5": mean("score", 5),
        "rolling_std_3": mean("score", 3, fn="stddev_samp"),
        "rolling_std_5": mean("score", 5, fn="stddev_samp"),
        "price_momentum_3": mean("round_price_change", 3),
        "form_trend": f"{mean('score', 3)} - {mean('score', 3, 3)}",
        "season_avg_to_date": frame_mean("score", -27, -1, 1, LI_OVER),
        "avg_be_gap_3rd": mean("be_gap", 3),
        "be_gap_lag_1": lag("be_gap", 1),
        "consecutive_be_beaten": " + ".join(f"CAST({lag('be_gap', n)} > 0 AS INTEGER)" for n in (1, 2, 3)),
    }
    for stat in LAGGED:
        features[f"{stat}_lag_1"] = lag(f'"{stat}"', 1)
        features[f"{stat}_roll_avg_3"] = mean(f'"{stat}"', 3, 1)
        features[f"{stat}_roll_avg_5"] = mean(f'"{stat}"', 5, 1)
    return features


EVERY_FEATURE = _every_feature()
#: Features with fractions, which are rounded before they are compared.
FRACTIONS = {
    name for name in EVERY_FEATURE
    if name.startswith(("rolling", "price_momentum", "price_per", "form", "season", "avg", "career", "opponent_avg",
                        "player_vs", "matchup", "action_score_rolling", "bppm"))
    or "_roll_avg_" in name
}
GOLD_WIDE_SQL = (
    f"WITH {GOLD_CTE}, wide AS (SELECT gold.*, {ACTION_SUM} AS action_score, ground_condition, weather_condition FROM gold"
    " LEFT JOIN (SELECT year, round, team, ground_condition, weather_condition FROM cx) USING (year, round, team))"
    " SELECT player_name, year, round, "
    + ", ".join(r8(f"({sql})", f'"{name}"') if name in FRACTIONS else f'{sql} AS "{name}"' for name, sql in EVERY_FEATURE.items())
    + " FROM wide"
)


@register("gold_every_feature", GOLD_WIDE_SQL)
def gold_every_feature(spark: SparkSession, sf: str) -> DataFrame:
    """All features of the gold table."""
    return rounded(gold(spark, sf).select(*KEYS, *EVERY_FEATURE))


#: Rows of a player who missed a round; players with more are cut into ranges by the query below.
FULL_SEASONS = 79


@register("gold_from_one_layout", GOLD_WIDE_SQL)
def gold_from_one_layout(spark: SparkSession, sf: str) -> DataFrame:
    """The same, the players with all their rounds cut into ranges."""
    silver = stored(supply_panel(spark, sf))
    wide = gold_features(silver, coded_context(spark, sf), SUPPLY, hot_rows=FULL_SEASONS)
    return rounded(wide.select(*KEYS, *EVERY_FEATURE))


# --- registry -----------------------------------------------------------------------


def season_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Grid of the running season: each supplier in two rounds, and some junk rows."""
    key = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").withColumn("Rd", F.explode(F.array(F.lit("01"), F.lit("02"))))
    first = pick(key % 7, ["HOK", "FRF", "2RF", "HFB", "5/8", "CTW", "FLB"])
    second = pick(key % 5, ["", " HFB", "", " CTW", ""])
    thousands = F.floor(F.abs("s_acctbal")).cast("bigint")
    cents = F.concat(thousands.cast("string"), F.lit(","), F.lpad((key % 1000).cast("string"), 3, "0"))
    return rows.select(
        F.when(F.col("s_nationkey") == 3, "Any").otherwise(key.cast("string")).alias("id"),
        F.concat(key.cast("string"), F.lit(", Supplier")).alias("Name"),
        F.concat(first, second).alias("Posn"),
        F.concat(F.lit("N"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("Team"),
        F.concat(F.lit("$"), F.col("Rd"), cents).alias("Price"),
        F.when(F.col("Rd") == "02", (key % 90).cast("string")).otherwise("n/a").alias("BE"),
        "Rd",
    )


_FIRST = sql_list(["HOK", "FRF", "2RF", "HFB", "5_8", "CTW", "FLB"])
_SECOND = "['', ' HFB', '', ' CTW', '']"
PLAYERS = f"""
players AS (
  SELECT s_suppkey || ', Supplier' AS player_name,
    'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS team_2026,
    CAST('02' || CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) AS VARCHAR)
      || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') AS BIGINT) AS price_2026,
    CAST(s_suppkey % 90 AS INTEGER) AS break_even_2026,
    {_FIRST}[s_suppkey % 7 + 1] AS position_2026,
    nullif(trim({_SECOND}[s_suppkey % 5 + 1]), '') AS secondary_position_2026
  FROM supplier WHERE s_nationkey <> 3
)"""

REGISTRY = f"""{PLAYERS},
c AS ({CAREER.format(t='li')}), f AS ({FORM.format(t='li', o='round DESC')}),
registry AS (
  SELECT players.*, career_avg, career_std, career_avg_mins, career_games, last5_avg, last3_avg,
    last3_avg_mins, last_round_played, primary_position,
    CASE WHEN last3_avg IS NOT NULL THEN career_avg * 0.6 + last3_avg * 0.4 ELSE career_avg END
      AS predicted_score,
    coalesce(last3_avg_mins >= 40, false) AS likely_to_play
  FROM players LEFT JOIN c USING (player_name) LEFT JOIN f USING (player_name)
  WHERE career_games >= 10 OR career_avg IS NULL
)"""


def registry(spark: SparkSession, sf: str, silver: DataFrame | None = None) -> DataFrame:
    players = current_players(season_grid(spark, sf))
    return player_registry(silver or supply_panel(spark, sf), players, 2025, panel=SUPPLY)


REGISTRY_FRACTIONS = (
    "career_avg", "career_std", "career_avg_mins", "last5_avg", "last3_avg", "last3_avg_mins",
    "predicted_score",
)
ROUNDED_REGISTRY = ", ".join(f"round({c}, 8) AS {c}" for c in REGISTRY_FRACTIONS)


@register(
    "player_registry",
    f"WITH {LI}, {REGISTRY} SELECT * REPLACE ({ROUNDED_REGISTRY}) FROM registry",
)
def registry_query(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(registry(spark, sf))


def sentiment_table(spark: SparkSession, sf: str) -> DataFrame:
    """Expert view of some suppliers under the name ``Supplier n``."""
    return table(spark, sf, "supplier").filter(F.col("s_nationkey") % 2 == 0).select(
        F.concat(F.lit("Supplier "), "s_suppkey").alias("player_name"),
        (F.col("s_nationkey") / 32).alias("sentiment_score"),
        F.lit(0.75).alias("confidence"),
        F.lit("hold").alias("recommendation"),
        F.col("s_name").alias("key_insight"),
    )


SENTIMENT = """
sentiment AS (
  SELECT s_suppkey || ', Supplier' AS player_name, s_nationkey / 32 AS sentiment_score,
    CAST(0.75 AS DOUBLE) AS confidence, s_name FROM supplier WHERE s_nationkey % 2 = 0
)"""


@register(
    "registry_with_expert_view",
    f"""WITH {LI}, {REGISTRY}, {SENTIMENT} SELECT player_name, {r8('''CASE WHEN sentiment_score IS NOT NULL
    THEN predicted_score * (1.0 + sentiment_score * confidence * 0.10) ELSE predicted_score END''', 'predicted_score')},
    s_name AS expert_insight FROM registry LEFT JOIN sentiment USING (player_name)""",
)
def registry_with_expert_view(spark: SparkSession, sf: str) -> DataFrame:
    players = current_players(season_grid(spark, sf))
    viewed = player_registry(
        supply_panel(spark, sf), players, 2025, sentiment_table(spark, sf), SUPPLY
    )
    return rounded(viewed, "player_name", "predicted_score", "expert_insight")


@register(
    "players_from_last_season",
    f"""WITH {LI} SELECT player_name, price AS price_2026, primary_position AS position_2026,
    team AS team_2026, break_even AS break_even_2026, CAST(NULL AS VARCHAR) AS secondary_position_2026
    FROM (SELECT *, row_number() OVER (PARTITION BY player_name ORDER BY round DESC) AS rn
          FROM li WHERE year = 2025) WHERE rn = 1""",
)
def players_from_last_season(spark: SparkSession, sf: str) -> DataFrame:
    return players_from_gold(supply_panel(spark, sf), 2025, panel=SUPPLY)


# --- predictions --------------------------------------------------------------------

BONUS = {0: 1, 1: 0, 2: -2, 3: 3, 4: -4, 5: 2}
PREDICTIONS = f"""
opps_named AS (SELECT team AS team_2026, round_opponent FROM opps),
latest AS (SELECT player_name, opponent AS round_opponent, matchup_adjusted_avg AS round_matchup_avg FROM
  (SELECT *, row_number() OVER (PARTITION BY player_name, opponent ORDER BY year DESC, round DESC) AS rn
   FROM gold) WHERE rn = 1),
states AS (SELECT player_name, avg_score % 6 AS cluster, bppm / 10 AS anomaly FROM
  (SELECT *, row_number() OVER (PARTITION BY player_name ORDER BY year DESC, round DESC) AS rn
   FROM li) WHERE rn = 1),
base AS (
  SELECT r.*, o.round_opponent, o.round_opponent IS NULL AS is_bye, l.round_matchup_avg,
    coalesce(CASE WHEN o.round_opponent IS NULL THEN 0.0 ELSE coalesce(l.round_matchup_avg, r.career_avg)
      END, r.career_avg) AS round_predicted_score,
    coalesce(s.cluster, -1) AS cluster, coalesce(s.anomaly, 0.0) AS anomaly_score,
    CAST(coalesce({sql_map(BONUS)}[s.cluster], 0) AS DOUBLE) AS cluster_bonus,
    coalesce(t.sentiment_score * 5.0, 0.0) AS sentiment_boost
  FROM registry r LEFT JOIN opps_named o USING (team_2026)
  LEFT JOIN latest l ON l.player_name = r.player_name AND l.round_opponent = o.round_opponent
  LEFT JOIN states s ON s.player_name = r.player_name
  LEFT JOIN sentiment t ON t.player_name = r.player_name),
predictions AS (SELECT *, round_predicted_score + cluster_bonus - 0.5 * anomaly_score + sentiment_boost
  AS adjusted_predicted_score FROM base)"""
PREDICTION_CTE = f"{GOLD_CTE}, {FX}, {opponents_sql(SEASON, 5)}, {REGISTRY}, {SENTIMENT}, {PREDICTIONS}"


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    silver = stored(supply_panel(spark, sf))
    states = silver.withColumns({"cluster": F.col("avg_score") % 6, "anomaly_score": F.col("bppm") / 10})
    return round_predictions(
        registry(spark, sf, silver),
        fixture_list(spark, sf),
        gold(spark, sf, silver),
        states,
        sentiment_table(spark, sf),
        round_num=5,
        season=SEASON,
        team="team_2026",
        codes=NATION_CODES,
        bonus=BONUS,
        panel=SUPPLY,
    )


@register(
    "round_predictions",
    f"""WITH {PREDICTION_CTE} SELECT player_name, round_opponent, is_bye, cluster, cluster_bonus,
    {r8('round_matchup_avg', 'round_matchup_avg')}, {r8('round_predicted_score', 'round_predicted_score')},
    {r8('anomaly_score', 'anomaly_score')}, {r8('sentiment_boost', 'sentiment_boost')},
    {r8('adjusted_predicted_score', 'adjusted_predicted_score')} FROM predictions""",
)
def predictions_query(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        predictions(spark, sf), "player_name", "round_opponent", "is_bye", "cluster", "cluster_bonus",
        "round_matchup_avg", "round_predicted_score", "anomaly_score", "sentiment_boost",
        "adjusted_predicted_score",
    )


@register(
    "top_predictions",
    f"""WITH {PREDICTION_CTE} SELECT player_name, {r8('p.round_predicted_score', 'round_predicted_score')}
    FROM predictions p WHERE NOT is_bye AND likely_to_play
    ORDER BY p.round_predicted_score DESC NULLS FIRST, player_name LIMIT 20""",
)
def top_predictions_query(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(top_predictions(predictions(spark, sf)), "player_name", "round_predicted_score")


@register(
    "latest_matchup_means",
    f"""WITH {GOLD_CTE} SELECT player_name, opponent, {r8('matchup_adjusted_avg', 'round_matchup_avg')} FROM
    (SELECT *, row_number() OVER (PARTITION BY player_name, opponent ORDER BY year DESC, round DESC) AS rn
     FROM gold) WHERE rn = 1""",
)
def latest_matchup_means(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(latest_matchup(gold(spark, sf), SUPPLY))


# --- roster -------------------------------------------------------------------------

#: A squad of 26 from slots and under a cap that the test registry can meet.
JOB_RULES = RosterRules(
    slots={"HOK": 3, "FRF": 5, "2RF": 5, "HFB": 4, "5_8": 3, "CTW": 3, "FLB": 2}, cap=520_000_000
)


def job_roster(
    spark: SparkSession, sf: str, both_positions: bool
) -> tuple[DataFrame, DataFrame]:
    rows = predictions(spark, sf).withColumn(
        "adjusted_predicted_score", F.round("adjusted_predicted_score", 4)
    )
    return round_roster(rows, None, season_rules(2026, JOB_RULES), both_positions)


JOB_ROSTER = f"""{PREDICTION_CTE},
pool AS (SELECT player_name, position_2026 AS position, price_2026 AS price, false AS locked,
  CAST(round(round(adjusted_predicted_score, 4) * 1000) AS BIGINT) AS points
  FROM predictions WHERE likely_to_play AND NOT is_bye),
{searched(JOB_RULES, sql_map(JOB_RULES.slots))}"""


@register(
    "round_roster",
    f"""WITH {JOB_ROSTER} SELECT player_name, assigned_position, price AS price_2026,
    CAST(sum(price) OVER () AS BIGINT) AS total_price FROM capped""",
)
def roster_query(spark: SparkSession, sf: str) -> DataFrame:
    roster, _ = job_roster(spark, sf, both_positions=False)
    return roster.select("player_name", "assigned_position", "price_2026", "total_price")


@register("round_roster_audit")
def round_roster_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Rule audit of the roster that uses both positions."""
    return job_roster(spark, sf, both_positions=True)[1]


# --- context, insights, quality --------------------------------------------------------


@register(
    "context_from_feeds_and_pages",
    f"""SELECT year, round, team, opponent, is_home, team_tries, CAST(NULL AS VARCHAR) AS weather FROM ({FEED_ROWS})
    UNION ALL SELECT year, round, team, opponent, is_home, NULL, weather_condition FROM ({PAGE_ROWS})""",
)
def context_query(spark: SparkSession, sf: str) -> DataFrame:
    fixtures = fixture_list(spark, sf).withColumnRenamed("path", "match_centre_url")
    feeds = season_feeds(spark, sf)
    context = match_context(feeds, fixtures, weather_pages(spark, sf))
    return context.select(
        "year", "round", "team", "opponent", "is_home", "team_tries",
        F.col("weather_condition").alias("weather"),
    )


@register(
    "insight_weights",
    f"""WITH {TURNS}, t AS (SELECT *, row_number() OVER (PARTITION BY player_name ORDER BY source_url DESC)
      AS rn FROM tr WHERE turn % 4 <> 3)
    SELECT player_name, round(avg(CAST(sentiment_score AS DOUBLE)), 3) AS sentiment_score,
    round(avg(CAST(confidence AS DOUBLE)), 3) AS confidence, max(key_insight) FILTER (rn = 1) AS key_insight,
    string_agg(source_url, ', ' ORDER BY source_url) AS sources FROM t GROUP BY player_name""",
)
def insights_query(spark: SparkSession, sf: str) -> DataFrame:
    replies = reply_texts(spark, sf).withColumn("body", F.lit("text"))
    weights, _ = insight_weights(replies)
    return weights.select("player_name", "sentiment_score", "confidence", "key_insight", "sources")


@register(
    "season_quality",
    f"""WITH {LI}, q AS (SELECT *, "TR" * 17 + "TA" * 12 + "GO" * 4 + "FG" * 5 + "TB" * 2 - "MT" AS weighted,
      "TR" + "TA" + "GO" + "FG" + "TB" + "MT" AS plain FROM li)
    SELECT year, count(*) AS rows, count(*) - count(plain) AS action_score_nulls,
    count(*) - count(score) AS score_nulls, max(abs(score - weighted)) AS max_weighted_diff,
    max(abs(score - plain)) AS max_action_diff FROM q GROUP BY year""",
)
def season_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.season_quality(supply_panel(spark, sf), SUPPLY)


@register(
    "null_action_scores_per_season",
    f"""WITH {LI} SELECT year, count(*) AS rows FROM li
    WHERE "TR" + "TA" + "GO" + "FG" + "TB" + "MT" IS NULL GROUP BY year ORDER BY year""",
)
def null_action_scores(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_score_seasons(supply_panel(spark, sf), SUPPLY)


@register(
    "positions_in_use",
    f"""WITH {BZ}, {SILVER} SELECT primary_position, count(*) AS count FROM silver
    WHERE primary_position IN ('5_8', 'HOK') GROUP BY 1""",
)
def positions_in_use(spark: SparkSession, sf: str) -> DataFrame:
    silver = conform_silver(bronze_grid(spark, sf))
    return quality.leftover_positions(silver, ["5/8", "5_8", "HOK"])


# --- states and training ---------------------------------------------------------------

@register(
    "player_states",
    f"""WITH {GOLD_CTE}, s AS (SELECT year, lag(score, 3) OVER (PARTITION BY player_name, year ORDER BY round) AS third
      FROM gold)
    SELECT year, count(*) AS states, true AS in_range FROM s WHERE third IS NOT NULL GROUP BY year""",
)
def states_query(spark: SparkSession, sf: str) -> DataFrame:
    """All inputs, all latent columns: the states per season, and whether their clusters are numbered from 0."""
    states = player_states(stored(gold(spark, sf)), order_by="price_momentum_3")
    latent = [F.col(f"latent_{i}").isNotNull() for i in range(8)]
    sound = F.col("cluster").between(0, 5) & (F.col("anomaly_score") >= 0) & reduce(lambda a, b: a & b, latent)
    return states.groupBy("year").agg(F.count(F.lit(1)).alias("states"), F.bool_and(sound).alias("in_range"))


@register(
    "score_training",
    f"""WITH {GOLD_CTE}, t AS (SELECT *, lead(score) OVER (PARTITION BY player_name, year ORDER BY round) AS target
      FROM gold), r AS (SELECT CASE WHEN year <= 2023 THEN 'train' WHEN year = 2024 THEN 'val' ELSE 'test' END AS split
      FROM t WHERE target IS NOT NULL AND mins >= 5 AND year <= 2025)
    SELECT model, split, count(*) AS n, true AS sound FROM r, (VALUES ('boosted'), ('forest'), ('ensemble')) AS m(model)
    GROUP BY model, split""",
)
def training_query(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of both learners and their mean, per split, with the whole budgets and all features."""
    scored, _ = train_scores(training_rows(stored(gold(spark, sf)), SUPPLY))
    errors = metric_rows(scored, "target_score", ["boosted", "forest", "ensemble"])
    mean = scored.filter("split = 'train'").agg(F.avg("target_score")).scalar()
    naive = metric_rows(scored.withColumn("mean", mean), "target_score", ["mean"])
    both = errors.join(naive.select("split", F.col("rmse").alias("_naive")), "split")
    # on the training seasons a constant learner is not better than their mean
    better = (F.col("split") != "train") | (F.col("rmse") < F.col("_naive") * 0.999)
    return both.select("model", "split", "n", (better & (F.col("mae") <= F.col("rmse"))).alias("sound"))
