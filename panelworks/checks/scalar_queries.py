"""Column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.checks.book import r8, register
from panelworks.checks.panels import (
    CO,
    EV,
    FLAGS,
    LI,
    NATION_CODES,
    event_panel,
    match_panel,
    rounded,
    sql_map,
    supply_panel,
    table,
)
from panelworks.functions import scalars as s
from panelworks.operators.windows import ACTION_SCORE_COLUMNS
from panelworks.plans.predictions import adjusted_score
from panelworks.plans.registry import eligible, predicted_score

CODES = sql_map(NATION_CODES)


@register(
    "recoded_teams",
    f"""WITH {CO} SELECT year, round, team, coalesce({CODES}[team], team) AS code,
    {CODES}[team] AS strict_code, length(coalesce({CODES}[team], team)) = 3 AS is_code FROM co""",
)
def recoded_teams(spark: SparkSession, sf: str) -> DataFrame:
    code = s.recode("team", NATION_CODES)
    return match_panel(spark, sf).select(
        "year", "round", "team", code.alias("code"),
        s.recode_strict("team", NATION_CODES).alias("strict_code"), s.is_code(code).alias("is_code"),
    )


BONUS = {0: 1, 1: 0, 2: -2, 3: 3}


@register(
    "mapped_bonus",
    f"""WITH {EV} SELECT event_id, CAST(coalesce({sql_map(BONUS)}[mins % 7], 0) AS DOUBLE) AS bonus FROM ev""",
)
def mapped_bonus(spark: SparkSession, sf: str) -> DataFrame:
    bonus = s.map_default(F.col("mins") % 7, BONUS)
    return event_panel(spark, sf).select("event_id", bonus.alias("bonus"))


FLIP = r"""CASE WHEN len(words) >= 2
    THEN words[-1] || ', ' || array_to_string(words[1:len(words) - 1], ' ') ELSE {x} END"""


@register(
    "flipped_names",
    rf"""SELECT p_partkey AS key, {FLIP.format(x='p_name')} AS name FROM (SELECT *,
    regexp_split_to_array(regexp_replace(p_name, '^\s+|\s+$', '', 'g'), '\s+') AS words FROM part)
    UNION ALL SELECT c_custkey, {FLIP.format(x='name')} FROM (SELECT *,
    regexp_split_to_array(regexp_replace(name, '^\s+|\s+$', '', 'g'), '\s+') AS words FROM
    (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name
      ELSE ' ' || c_name || '  ' || c_mktsegment || ' ' || c_nationkey END AS name FROM customer))""",
)
def flipped_names(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))
    long_name = F.concat(F.lit(" "), "c_name", F.lit("  "), "c_mktsegment", F.lit(" "), "c_nationkey")
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(long_name).alias("name"),
    )
    return parts.unionByName(customers).select("key", s.flip_name("name").alias("name"))


@register(
    "names_without_apostrophe",
    "SELECT page_id, replace(html, '''', '') AS html FROM pages",
)
def names_without_apostrophe(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", s.without_apostrophe("html").alias("html"))


@register(
    "jersey_bands",
    """SELECT p_partkey, CASE WHEN p_size <= 13 THEN 'starter' WHEN p_size <= 17 THEN 'bench'
    ELSE 'reserve' END AS status FROM part""",
)
def jersey_bands(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", s.classify_band("p_size").alias("status"))


@register(
    "clipped_scores",
    f"""WITH {EV} SELECT event_id, CASE WHEN score IS NOT NULL THEN greatest(score, 1000) END AS low,
    CASE WHEN score IS NOT NULL THEN least(score, 5000) END AS high, coalesce(score, 0) AS filled,
    CAST(mins % 2 = 0 AS VARCHAR) = 'true' AS flag FROM ev""",
)
def clipped_scores(spark: SparkSession, sf: str) -> DataFrame:
    text = F.initcap((F.col("mins") % 2 == 0).cast("string"))
    return event_panel(spark, sf).select(
        "event_id",
        s.clip_lower("score", 1000).cast("bigint").alias("low"),
        s.clip_upper("score", 5000).cast("bigint").alias("high"),
        s.coalesce_default("score", 0).cast("bigint").alias("filled"),
        s.string_to_bool(text).alias("flag"),
    )


@register(
    "round_score_choice",
    f"""WITH {LI} SELECT player_name, year, round, {r8('''CASE WHEN mins < 45 THEN 0.0
    WHEN "TR" IS NOT NULL THEN "TR" ELSE bppm END''', 'round_predicted_score')} FROM li""",
)
def round_score_choice(spark: SparkSession, sf: str) -> DataFrame:
    panel = supply_panel(spark, sf).withColumns(
        {"is_bye": F.col("mins") < 45, "matchup": F.col("TR").cast("double")}
    )
    chosen = s.round_score("is_bye", "matchup", "bppm").alias("round_predicted_score")
    return rounded(panel.select("player_name", "year", "round", chosen))


WEIGHTED = " + ".join(f'"{c}" * {w}' if w >= 0 else f'"{c}" * ({w})' for c, w in s.ACTION_WEIGHTS.items() if c in FLAGS)
PLAIN = " + ".join(f'"{c}"' for c in ACTION_SCORE_COLUMNS if c in FLAGS)


@register(
    "weighted_and_plain_action_scores",
    f"""WITH {LI} SELECT player_name, year, round, CAST({WEIGHTED} AS BIGINT) AS weighted,
    CAST(score - ({WEIGHTED}) AS BIGINT) AS diff, CAST({PLAIN} AS BIGINT) AS plain FROM li""",
)
def action_scores(spark: SparkSession, sf: str) -> DataFrame:
    panel = supply_panel(spark, sf)
    weighted = s.weighted_action_score(panel)
    return panel.select(
        "player_name", "year", "round", weighted.alias("weighted"),
        (F.col("score") - weighted).alias("diff"),
        s.action_sum(panel, ACTION_SCORE_COLUMNS).alias("plain"),
    )


@register(
    "price_and_minutes_flags",
    f"""WITH {EV} SELECT event_id, price <= 102400 * 1.1 AS is_min_price,
    coalesce(nullif(mins, 50) >= 40, false) AS likely_to_play FROM ev""",
)
def price_and_minutes_flags(spark: SparkSession, sf: str) -> DataFrame:
    return event_panel(spark, sf).select(
        "event_id",
        s.is_min_price("price").alias("is_min_price"),
        s.likely_to_play(F.nullif(F.col("mins"), F.lit(50))).alias("likely_to_play"),
    )


@register(
    "sentiment_adjusted_score",
    f"""WITH {EV} SELECT event_id, {r8('''CASE WHEN mins % 3 <> 0 THEN
    score * (1.0 + ((mins - 40) / 40) * (break_even / 100) * 0.10) ELSE score END''', 'adjusted')} FROM ev""",
)
def sentiment_adjusted(spark: SparkSession, sf: str) -> DataFrame:
    sentiment = F.when(F.col("mins") % 3 != 0, (F.col("mins") - 40) / 40)
    adjusted = s.sentiment_adjust("score", sentiment, F.col("break_even") / 100)
    return rounded(event_panel(spark, sf).select("event_id", adjusted.cast("double").alias("adjusted")))


@register(
    "predicted_and_eligible",
    f"""WITH {EV} SELECT event_id, {r8('''CASE WHEN mins > 20 THEN avg_score * 0.6 + mins * 0.4
    ELSE avg_score END''', 'predicted_score')} FROM ev WHERE break_even >= 10 OR avg_score IS NULL""",
)
def predicted_and_eligible(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_panel(spark, sf).select(
        "event_id",
        F.col("avg_score").cast("double").alias("career_avg"),
        F.when(F.col("mins") > 20, F.col("mins").cast("double")).alias("last3_avg"),
        F.col("break_even").alias("career_games"),
    )
    return rounded(rows.filter(eligible()).select("event_id", predicted_score().alias("predicted_score")))


@register(
    "adjusted_round_score",
    f"""WITH {EV} SELECT event_id,
    {r8('score + break_even - 0.5 * (mins / 10) + avg_score', 'adjusted')} FROM ev""",
)
def adjusted_round_score(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_panel(spark, sf).select(
        "event_id",
        F.col("score").cast("double").alias("round_predicted_score"),
        F.col("break_even").alias("cluster_bonus"),
        (F.col("mins") / 10).alias("anomaly_score"),
        F.col("avg_score").alias("sentiment_boost"),
    )
    return rounded(rows.select("event_id", adjusted_score().alias("adjusted")))
