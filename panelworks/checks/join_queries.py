"""Lookup joins: context, byes, prices, fixtures, states, sentiment, exclusions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.checks.book import r8, register
from panelworks.checks.panels import (
    CO,
    CODED_CO,
    FX,
    LI,
    NATION_CODES,
    PO,
    SUPPLY,
    candidates,
    fixture_list,
    match_panel,
    reserve_list,
    rounded,
    sql_map,
    supply_panel,
    table,
)
from panelworks.checks.summary_queries import CAREER, FORM, STRENGTH
from panelworks.operators import joins as j
from panelworks.operators.aggregates import career_stats, last_by, opponent_strength, recent_form
from panelworks.plans.gold import conform_context

CONTEXT = f"{CO}, {CODED_CO}"
KEYS = ("player_name", "year", "round")


def coded_context(spark: SparkSession, sf: str) -> DataFrame:
    return conform_context(match_panel(spark, sf), NATION_CODES)


@register(
    "context_join",
    f"""WITH {LI}, {CONTEXT} SELECT player_name, year, round, is_home, ground_condition,
    weather_condition FROM li LEFT JOIN cx USING (year, round, team)""",
)
def context_join(spark: SparkSession, sf: str) -> DataFrame:
    df = j.join_context(supply_panel(spark, sf), coded_context(spark, sf), SUPPLY)
    return df.select(*KEYS, *j.CONTEXT_COLUMNS)


BYES = """SELECT DISTINCT year, round, team, true AS is_bye FROM li
    WHERE length(team) = 3 AND NOT EXISTS (SELECT 1 FROM cx
      WHERE cx.year = li.year AND cx.round = li.round AND cx.team = li.team)"""


@register("bye_rounds", f"WITH {LI}, {CONTEXT} {BYES}")
def bye_rounds(spark: SparkSession, sf: str) -> DataFrame:
    return j.derive_byes(supply_panel(spark, sf), coded_context(spark, sf), SUPPLY)


FLAGGED = f"""WITH {LI}, {CONTEXT}, b AS ({BYES}) SELECT player_name, year, round,
    coalesce(is_bye, false) AS is_bye FROM li LEFT JOIN b USING (year, round, team)"""


@register("bye_flags", FLAGGED)
def bye_flags(spark: SparkSession, sf: str) -> DataFrame:
    panel = supply_panel(spark, sf)
    byes = j.derive_byes(panel, coded_context(spark, sf), SUPPLY)
    return j.flag_byes(panel, byes, SUPPLY).select(*KEYS, "is_bye")


@register(
    "match_context",
    f"""WITH {LI}, {CONTEXT}, b AS ({BYES}) SELECT player_name, year, round, is_home,
    ground_condition, coalesce(is_bye, false) AS is_bye
    FROM li LEFT JOIN cx USING (year, round, team) LEFT JOIN b USING (year, round, team)""",
)
def match_context(spark: SparkSession, sf: str) -> DataFrame:
    df = j.add_match_context(supply_panel(spark, sf), coded_context(spark, sf), SUPPLY)
    return df.select(*KEYS, "is_home", "ground_condition", "is_bye")


@register(
    "initial_price",
    f"""WITH {LI}, i AS (SELECT player_name, year, price AS initial_price FROM li WHERE round = 1)
    SELECT player_name, year, round, initial_price, price - initial_price AS price_vs_initial,
    {r8('price / greatest(CAST(avg_score AS DOUBLE), 1.0)', 'price_per_point')},
    price <= 102400 * 1.1 AS is_min_price FROM li LEFT JOIN i USING (player_name, year)""",
)
def initial_price(spark: SparkSession, sf: str) -> DataFrame:
    df = j.add_initial_price(supply_panel(spark, sf), SUPPLY)
    return rounded(
        df, *KEYS, "initial_price", "price_vs_initial", "price_per_point", "is_min_price"
    )


@register(
    "repeated_context_keys",
    f"""WITH {CO} SELECT year, round, ground_condition, count(*) AS n FROM co
    GROUP BY year, round, ground_condition HAVING count(*) > 1""",
)
def repeated_context_keys(spark: SparkSession, sf: str) -> DataFrame:
    return j.duplicate_keys(match_panel(spark, sf), ["year", "round", "ground_condition"])


#: The season of the round that the queries look at.
SEASON = 2021


def opponents_sql(season: int, round_num: int) -> str:
    return f"""
pairs AS (SELECT {sql_map(NATION_CODES)}[home_team] AS h, {sql_map(NATION_CODES)}[away_team] AS a,
          match_date FROM fx WHERE year = {season} AND round = {round_num}),
sides AS (SELECT h AS team, a AS opp, match_date FROM pairs WHERE h IS NOT NULL AND a IS NOT NULL
          UNION ALL SELECT a, h, match_date FROM pairs WHERE h IS NOT NULL AND a IS NOT NULL),
opps AS (SELECT team, opp AS round_opponent FROM (SELECT *, row_number() OVER
         (PARTITION BY team ORDER BY match_date DESC, opp DESC) AS rn FROM sides) WHERE rn = 1)"""


@register(
    "round_opponents",
    f"""WITH {LI}, {CO}, {FX}, {opponents_sql(SEASON, 5)},
    t AS (SELECT DISTINCT team FROM li)
    SELECT team, round_opponent, round_opponent IS NULL AS is_bye FROM t LEFT JOIN opps USING (team)""",
)
def round_opponents(spark: SparkSession, sf: str) -> DataFrame:
    teams = supply_panel(spark, sf).select("team").distinct()
    opponents = j.round_opponents(fixture_list(spark, sf), SEASON, 5, NATION_CODES)
    return j.join_opponents(teams, opponents, "team")


BYE_ROUND = f"""
teams AS (SELECT DISTINCT home_team AS name FROM fx),
grid AS (SELECT t.name, r.year, r.round FROM teams t, (SELECT DISTINCT year, round FROM fx) r),
away AS (SELECT g.year, g.round, count(*) AS byes FROM grid g
         WHERE NOT EXISTS (SELECT 1 FROM fx WHERE fx.year = g.year AND fx.round = g.round
                           AND g.name IN (fx.home_team, fx.away_team))
         AND EXISTS (SELECT 1 FROM fx WHERE fx.year <> g.year AND fx.round = g.round
                     AND g.name IN (fx.home_team, fx.away_team))
         GROUP BY g.year, g.round)"""


@register(
    "byes_in_spite_of_other_seasons",
    f"WITH {CO}, {FX}, {BYE_ROUND} SELECT year, round, byes FROM away",
)
def byes_in_spite_of_other_seasons(spark: SparkSession, sf: str) -> DataFrame:
    """Teams without an opponent in a round that they play in another season."""
    fixtures = fixture_list(spark, sf)
    sides = fixtures.select("year", "round", F.explode(F.array("home_team", "away_team")).alias("team"))
    plays = sides.groupBy("round", "team").agg(F.collect_set("year").alias("_years"))
    rounds = fixtures.select("year", "round").distinct()
    named = plays.join(fixtures.select(F.col("home_team").alias("team")).distinct(), "team", "left_semi")
    missing = named.join(rounds, "round").filter(~F.array_contains("_years", F.col("year")))
    return missing.groupBy("year", "round").agg(F.count(F.lit(1)).alias("byes"))


LATEST = """SELECT player_name, opponent AS round_opponent, bppm AS round_matchup_avg FROM
    (SELECT *, row_number() OVER (PARTITION BY player_name, opponent ORDER BY year DESC, round DESC)
     AS rn FROM li) WHERE rn = 1"""


@register(
    "latest_matchup",
    f"""WITH {LI}, {CO}, {FX}, {opponents_sql(SEASON, 5)}, m AS ({LATEST}),
    c AS (SELECT player_name, max(team) AS team, avg(score) AS career_avg FROM li GROUP BY 1)
    SELECT player_name, round_opponent, {r8('round_matchup_avg', 'round_matchup_avg')},
    {r8('''CASE WHEN round_opponent IS NULL THEN 0.0
           ELSE coalesce(round_matchup_avg, career_avg) END''', 'round_predicted_score')}
    FROM c LEFT JOIN opps USING (team) LEFT JOIN m USING (player_name, round_opponent)""",
)
def latest_matchup(spark: SparkSession, sf: str) -> DataFrame:
    panel = supply_panel(spark, sf)
    players = panel.groupBy("player_name").agg(
        F.max("team").alias("team"), F.avg("score").alias("career_avg")
    )
    opponents = j.round_opponents(fixture_list(spark, sf), SEASON, 5, NATION_CODES)
    gold = panel.withColumnRenamed("bppm", "matchup_adjusted_avg")
    df = j.join_latest_matchup(j.join_opponents(players, opponents, "team"), gold, SUPPLY)
    return rounded(
        df, "player_name", "round_opponent", "round_matchup_avg", "round_predicted_score"
    )


BONUS = {0: 1, 1: 0, 2: -2, 3: 3, 4: -4}


@register(
    "state_join",
    f"""WITH {LI}, s AS (SELECT player_name, avg_score % 6 AS cluster, bppm AS anomaly FROM
      (SELECT *, row_number() OVER (PARTITION BY player_name ORDER BY year DESC, round DESC) AS rn
       FROM li WHERE team <> 'NATION_24') WHERE rn = 1)
    SELECT DISTINCT player_name, coalesce(cluster, -1) AS cluster,
    {r8('coalesce(anomaly, 0.0)', 'anomaly_score')},
    CAST(coalesce({sql_map(BONUS)}[cluster], 0) AS DOUBLE) AS cluster_bonus
    FROM li LEFT JOIN s USING (player_name)""",
)
def state_join(spark: SparkSession, sf: str) -> DataFrame:
    panel = supply_panel(spark, sf)
    states = panel.filter(F.col("team") != "NATION_24").withColumns(
        {"cluster": F.col("avg_score") % 6, "anomaly_score": F.col("bppm")}
    )
    players = panel.select("player_name").distinct()
    return rounded(j.join_states(players, states, BONUS, SUPPLY))


@register(
    "sentiment_join",
    f"""WITH {LI}, s AS (SELECT s_suppkey || ', Supplier' AS player_name, s_acctbal / 10000 AS sentiment
      FROM supplier WHERE s_nationkey > 5)
    SELECT DISTINCT player_name, {r8('coalesce(sentiment * 5.0, 0.0)', 'sentiment_boost')}
    FROM li LEFT JOIN s USING (player_name)""",
)
def sentiment_join(spark: SparkSession, sf: str) -> DataFrame:
    players = supply_panel(spark, sf).select("player_name").distinct()
    sentiment = table(spark, sf, "supplier").filter(F.col("s_nationkey") > 5).select(
        F.concat(F.lit("Supplier "), "s_suppkey").alias("player_name"),
        (F.col("s_acctbal") / 10000).alias("sentiment_score"),
    )
    return rounded(j.join_sentiment(players, sentiment))


@register(
    "player_stats_join",
    f"""WITH {LI}, c AS ({CAREER.format(t='li')}), f AS ({FORM.format(t='li', o='round DESC')}),
    p AS (SELECT s_suppkey || ', Supplier' AS player_name, s_nationkey FROM supplier)
    SELECT player_name, s_nationkey, career_games, last_round_played, primary_position,
    {r8('career_avg', 'career_avg')}, {r8('career_std', 'career_std')},
    {r8('career_avg_mins', 'career_avg_mins')}, {r8('last5_avg', 'last5_avg')},
    {r8('last3_avg', 'last3_avg')}, {r8('last3_avg_mins', 'last3_avg_mins')}
    FROM p LEFT JOIN c USING (player_name) LEFT JOIN f USING (player_name)""",
)
def player_stats_join(spark: SparkSession, sf: str) -> DataFrame:
    panel = supply_panel(spark, sf)
    players = table(spark, sf, "supplier").select(
        F.concat(F.col("s_suppkey").cast("string"), F.lit(", Supplier")).alias("player_name"), "s_nationkey"
    )
    career, form = career_stats(panel, SUPPLY), recent_form(panel, 2025, SUPPLY)
    return rounded(j.join_player_stats(players, career, form, SUPPLY))


@register(
    "without_reserves",
    f"""WITH {PO} SELECT player_name, position FROM po WHERE replace(player_name, '''', '') NOT IN
    (SELECT 'Part' || p_partkey FROM part WHERE p_size > 17)""",
)
def without_reserves(spark: SparkSession, sf: str) -> DataFrame:
    reserves = reserve_list(spark, sf).filter(F.col("status") == "reserve")
    return j.exclude_by_name(candidates(spark, sf), reserves).select("player_name", "position")


@register(
    "without_listed_players",
    f"WITH {PO} SELECT player_name, price FROM po WHERE player_name NOT IN ('Part''1', 'Part''12')",
)
def without_listed_players(spark: SparkSession, sf: str) -> DataFrame:
    kept = j.exclude_list(candidates(spark, sf), ["Part'1", "Part'12"])
    return kept.select("player_name", "price")


@register(
    "strength_by_position",
    f"""WITH {LI}, s AS ({STRENGTH.format(t='li', o='year, round, player_name')})
    SELECT opponent, primary_position, {r8('opponent_avg_pts_allowed', 'opponent_avg_pts_allowed')} FROM s""",
)
def strength_by_position(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(opponent_strength(supply_panel(spark, sf), SUPPLY))


@register(
    "last_price_per_player",
    f"""WITH {LI} SELECT player_name, price AS price_2026, team AS team_2026 FROM
    (SELECT *, row_number() OVER (PARTITION BY player_name ORDER BY year DESC, round DESC) AS rn FROM li)
    WHERE rn = 1""",
)
def last_price(spark: SparkSession, sf: str) -> DataFrame:
    renamed = {"price": "price_2026", "team": "team_2026"}
    return last_by(supply_panel(spark, sf), ["player_name"], renamed, SUPPLY.timeline)
