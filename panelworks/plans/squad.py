"""Roster of one round."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from panelworks.operators.roster import (
    RosterRules,
    annotate_roster,
    audit_roster,
    candidate_pool,
    capped_roster,
)
from panelworks.session import persist_point
from panelworks.sources.tables import read_optional, read_table, write_table

TEAM_LIST_SCHEMA = "team string, jersey int, player_name_raw string, player_name string, status string"


def season_rules(season: int = 2026, rules: RosterRules = RosterRules()) -> RosterRules:
    """Rules over the season's registry columns."""
    return replace(
        rules,
        position=f"position_{season}",
        secondary=f"secondary_position_{season}",
        price=f"price_{season}",
    )


def round_roster(
    predictions: DataFrame,
    reserves: DataFrame | None,
    rules: RosterRules,
    both_positions: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The roster with totals, and its rule audit."""
    pool = candidate_pool(predictions, rules, reserves)
    roster = persist_point(capped_roster(pool, rules, both_positions))
    return annotate_roster(roster, rules), audit_roster(roster, pool, rules)


def run_roster(
    spark: SparkSession,
    predictions_path: str,
    team_lists_path: str,
    path: str,
    rules: RosterRules = RosterRules(),
    season: int = 2026,
) -> None:
    schema = StructType.fromDDL(TEAM_LIST_SCHEMA)
    reserves = read_optional(spark, team_lists_path, schema)
    roster, audit = round_roster(
        read_table(spark, predictions_path), reserves, season_rules(season, rules)
    )
    write_table(roster, f"{path}/roster")
    write_table(audit, f"{path}/audit")
