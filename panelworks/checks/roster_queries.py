"""Candidate pools, slots, capped rosters and their audit."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.checks.book import r8, register
from panelworks.checks.panels import PO, candidates, reserve_list, rounded, sql_map
from panelworks.operators import roster as r
from panelworks.operators.aggregates import roster_totals
from panelworks.operators.topk import roster_listing

LOCKED = ("Part'3", "Part'44")
EXCLUDED = ("Part'7", "Part'19")
RULES = r.RosterRules(locked=LOCKED, excluded=EXCLUDED)
NEED = sql_map(r.SLOTS)


def quoted(names: tuple[str, ...]) -> str:
    return ", ".join("'" + n.replace("'", "''") + "'" for n in names)


POOL = f"""{PO}, pool AS (
  SELECT player_name, position, secondary_position, price, adjusted_predicted_score, is_bye,
         player_name IN ({quoted(LOCKED)}) AS locked FROM po
  WHERE likely_to_play AND NOT is_bye AND p_size <= 17 AND player_name NOT IN ({quoted(EXCLUDED)})
)"""


def pool(spark: SparkSession, sf: str) -> DataFrame:
    return r.candidate_pool(candidates(spark, sf), RULES, reserve_list(spark, sf))


@register("candidate_pool", f"WITH {POOL} SELECT player_name, price FROM pool")
def candidate_pool(spark: SparkSession, sf: str) -> DataFrame:
    return pool(spark, sf).select("player_name", "price")


@register(
    "slot_eligibility",
    f"""WITH {POOL} SELECT player_name, position AS slot, {NEED}[position] AS need FROM pool
    UNION ALL SELECT player_name, secondary_position, {NEED}[secondary_position] FROM pool
    WHERE secondary_position IS NOT NULL""",
)
def slot_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    return r.slot_eligibility(pool(spark, sf), RULES).select("player_name", "slot", "need")


def filled(source: str, value: str, per: str = "", need: str = NEED) -> str:
    """SQL that fills the slots, then takes the best of the rest as flex."""
    best = f"locked DESC, {value} DESC, player_name"
    slots = f"PARTITION BY {per}{', ' if per else ''}position"
    spare = f"place > coalesce({need}[position], 0)"
    rest = f"PARTITION BY {per}{', ' if per else ''}{spare}"
    return f"""(SELECT *, {spare} AS is_flex,
      CASE WHEN {spare} THEN 'FLEX' ELSE position END AS assigned_position
      FROM (SELECT *, row_number() OVER ({rest} ORDER BY {best}) AS rest
        FROM (SELECT *, row_number() OVER ({slots} ORDER BY {best}) AS place FROM {source}))
      WHERE NOT ({spare}) OR rest <= 1)"""


def searched(rules: r.RosterRules, need: str = NEED) -> str:
    """SQL that narrows the penalties of ``pool`` in six passes down to the least one within the cap, as ``capped``."""
    powers = ", ".join(f"({p})" for p in (0, *(2**k for k in range(31))))
    parts = [f"grid0(penalty) AS (VALUES {powers})", "range0 AS (SELECT -1 AS lo)"]
    for k in range(6):
        value = f"(SELECT *, points * 1000 - penalty * price AS value FROM pool, grid{k})"
        parts.append(f"rosters{k} AS MATERIALIZED (SELECT * FROM {filled(value, 'value', 'penalty', need)})")
        parts.append(f"""totals{k} AS MATERIALIZED (SELECT penalty, count(*) = {rules.size} AS complete,
          sum(price) <= {rules.cap} AS within, sum(value) + penalty * CAST({rules.cap} AS BIGINT) AS top FROM rosters{k} GROUP BY penalty)""")
        parts.append(f"""range{k + 1} AS MATERIALIZED (SELECT min(penalty) FILTER (complete AND within) AS hi,
          greatest(max(penalty) FILTER (complete AND NOT within), (SELECT lo FROM range{k})) AS lo FROM totals{k})""")
        parts.append(f"""grid{k + 1} AS MATERIALIZED (SELECT DISTINCT least(hi, lo + 1 + j * CAST(ceil((hi - lo - 1) / 64.0) AS BIGINT)) AS penalty
          FROM range{k + 1}, range(65) AS s(j) WHERE hi IS NOT NULL)""")
    tops = " UNION ALL ".join(f"SELECT penalty, top FROM totals{k} WHERE complete" for k in range(6))
    parts.append(f"""capped AS (SELECT *, (SELECT min(top) FROM ({tops})) / 1e6 AS score_bound FROM rosters5
      WHERE penalty = (SELECT hi FROM range6))""")
    return ", ".join(parts)


@register(
    "best_per_slot",
    f"""WITH {POOL} SELECT player_name, assigned_position, is_flex, price FROM
    {filled('pool', 'adjusted_predicted_score')}""",
)
def best_per_slot(spark: SparkSession, sf: str) -> DataFrame:
    roster = r.slot_topk(pool(spark, sf), RULES)
    return roster.select("player_name", "assigned_position", "is_flex", "price")


def capped_sql(rules: r.RosterRules) -> str:
    points = "CAST(round(adjusted_predicted_score * 1000) AS BIGINT) AS points"
    return f"{POOL.replace('pool AS (', 'found AS (')}, pool AS (SELECT *, {points} FROM found), {searched(rules)}"


CAPPED = capped_sql(RULES)


@register(
    "capped_roster",
    f"""WITH {CAPPED} SELECT player_name, assigned_position, is_flex, price,
    adjusted_predicted_score, {r8('score_bound', 'score_bound')} FROM capped""",
)
def capped_roster(spark: SparkSession, sf: str) -> DataFrame:
    roster = r.capped_roster(pool(spark, sf), RULES)
    columns = ["player_name", "assigned_position", "is_flex", "price", "adjusted_predicted_score"]
    return roster.select(*columns, F.round("score_bound", 8).alias("score_bound"))


def rule_sql(name: str, found: str, need: object, op: str = "=") -> str:
    return (
        f"SELECT '{name}' AS rule, CAST({found} AS BIGINT) AS found, CAST({need} AS BIGINT) AS needed,"
        f" {found} {op} {need} AS holds FROM capped"
    )


AUDIT = " UNION ALL ".join(
    [
        rule_sql("size", "count(*)", RULES.size),
        rule_sql("cap", "sum(price)", RULES.cap, "<="),
        rule_sql("flex", "count(*) FILTER (is_flex)", RULES.flex),
        rule_sql("repeated", "(count(*) - count(DISTINCT player_name))", 0),
        rule_sql("misplaced", "count(*) FILTER (NOT is_flex AND assigned_position <> position)", 0),
        rule_sql("byes", "count(*) FILTER (is_bye)", 0),
        rule_sql("locked", "count(*) FILTER (locked)", "(SELECT count(*) FROM pool WHERE locked)"),
        *[
            rule_sql(f"slot {s}", f"count(*) FILTER (assigned_position = '{s}')", n)
            for s, n in RULES.slots.items()
        ],
    ]
)


@register("roster_audit", f"WITH {CAPPED} {AUDIT}")
def roster_audit(spark: SparkSession, sf: str) -> DataFrame:
    players = pool(spark, sf)
    return r.audit_roster(r.capped_roster(players, RULES), players, RULES)


@register(
    "audit_of_costly_roster",
    f"WITH {POOL}, capped AS (SELECT * FROM {filled('pool', 'adjusted_predicted_score')}) {AUDIT}",
)
def audit_of_costly_roster(spark: SparkSession, sf: str) -> DataFrame:
    """The best roster without a cap breaks the cap rule."""
    players = pool(spark, sf)
    return r.audit_roster(r.slot_topk(players, RULES), players, RULES)


@register(
    "annotated_roster",
    f"""WITH {CAPPED} SELECT player_name, assigned_position, is_flex,
    CAST(sum(price) OVER () AS BIGINT) AS total_price,
    CAST({RULES.cap} - sum(price) OVER () AS BIGINT) AS remaining,
    {r8('sum(adjusted_predicted_score) OVER ()', 'total_score')} FROM capped""",
)
def annotated_roster(spark: SparkSession, sf: str) -> DataFrame:
    roster = r.annotate_roster(r.capped_roster(pool(spark, sf), RULES), RULES)
    return rounded(
        roster, "player_name", "assigned_position", "is_flex", "total_price", "remaining", "total_score"
    )


@register(
    "roster_totals",
    f"""WITH {CAPPED} SELECT count(*) AS players, CAST(sum(price) AS BIGINT) AS total_price,
    CAST({RULES.cap} - sum(price) AS BIGINT) AS remaining,
    {r8('sum(adjusted_predicted_score)', 'total_score')} FROM capped""",
)
def totals(spark: SparkSession, sf: str) -> DataFrame:
    roster = r.capped_roster(pool(spark, sf), RULES)
    return rounded(roster_totals(roster, RULES.cap, RULES.price, RULES.score))


@register(
    "roster_listing",
    f"""WITH {CAPPED} SELECT assigned_position, player_name, adjusted_predicted_score FROM capped
    ORDER BY assigned_position, adjusted_predicted_score DESC, player_name""",
)
def listing(spark: SparkSession, sf: str) -> DataFrame:
    roster = r.capped_roster(pool(spark, sf), RULES)
    return roster_listing(roster, RULES.score).select(
        "assigned_position", "player_name", "adjusted_predicted_score"
    )


@register(
    "roster_for_tight_cap",
    f"""WITH {capped_sql(replace(RULES, cap=6_000_000))} SELECT player_name, assigned_position, price FROM capped""",
)
def tight_roster(spark: SparkSession, sf: str) -> DataFrame:
    rules = replace(RULES, cap=6_000_000)
    return r.capped_roster(pool(spark, sf), rules).select("player_name", "assigned_position", "price")


@register(
    "slot_counts",
    f"WITH {CAPPED} SELECT assigned_position, count(*) AS filled FROM capped GROUP BY 1",
)
def slot_counts(spark: SparkSession, sf: str) -> DataFrame:
    roster = r.capped_roster(pool(spark, sf), RULES)
    return roster.groupBy("assigned_position").agg(F.count(F.lit(1)).alias("filled"))


@register("roster_over_both_positions")
def roster_over_both_positions(spark: SparkSession, sf: str) -> DataFrame:
    """The capped roster in which players may fill their second position."""
    roster = r.capped_roster(pool(spark, sf), RULES, both_positions=True)
    return roster.select("player_name", "assigned_position", "is_flex", "price")
