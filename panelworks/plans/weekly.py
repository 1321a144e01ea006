"""The weekly run: refresh the tables, score the insights, select the round's roster."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelworks.operators.roster import RosterRules
from panelworks.plans.context import run_context, run_fixtures
from panelworks.plans.gold import run_gold
from panelworks.plans.insights import run_insights
from panelworks.plans.predictions import run_predictions
from panelworks.plans.registry import run_registry
from panelworks.plans.silver import run_silver
from panelworks.plans.squad import run_roster
from panelworks.plans.states import run_states
from panelworks.sources.tables import read_optional, table_if_there, write_table
from panelworks.sources.markup import team_lists

# Words that mark a team logo on a team-list page.
TEAM_WORDS = [
    "Knights", "Cowboys", "Bulldogs", "Dragons", "Storm", "Eels", "Warriors", "Roosters", "Broncos",
    "Panthers", "Sharks", "Titans", "Sea Eagles", "Raiders", "Dolphins", "Rabbitohs", "Tigers",
]


@dataclass(frozen=True)
class Lake:
    """Where the datasets live; ``root`` is any folder Spark can reach."""

    root: str

    def __call__(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])


def refresh(spark: SparkSession, lake: Lake) -> None:
    """Bronze to silver, fixtures, context, gold and states; draw pages, feeds and match pages may be missing."""
    run_silver(spark, lake("bronze/stats"), lake("silver/player_rounds"))
    run_fixtures(spark, lake("raw/draw_pages"), lake("bronze/fixtures"), lake("rejected/draw_pages"))
    run_context(
        spark,
        lake("raw/season_feeds"),
        lake("bronze/fixtures"),
        lake("raw/match_pages"),
        lake("bronze/match_context"),
        lake("rejected/season_feeds"),
    )
    run_gold(
        spark, lake("silver/player_rounds"), [lake("bronze/match_context")], lake("gold/features")
    )
    run_states(spark, lake("gold/features"), lake("gold/player_states"), lake("models/states"))


def score_insights(spark: SparkSession, lake: Lake) -> None:
    """Sentiment from the replies, if there are any; what was stored before stays otherwise."""
    if table_if_there(spark, lake("raw/replies")) is not None:
        run_insights(
            spark, lake("raw/replies"), lake("squad/sentiment"), lake("squad/rejected_replies")
        )


def select_round(
    spark: SparkSession, lake: Lake, round_num: int, season: int, rules: RosterRules
) -> None:
    """Team lists, predictions and roster of one round."""
    schema = StructType.fromDDL("round int, html string")
    pages = read_optional(spark, lake("raw/team_pages"), schema).filter(F.col("round") == round_num)
    lists = lake(f"squad/team_lists/round={round_num}")
    write_table(team_lists(pages.select("html"), TEAM_WORDS), lists)
    predictions = lake(f"squad/predictions/round={round_num}")
    run_predictions(
        spark,
        round_num,
        lake("squad/registry"),
        lake("bronze/fixtures"),
        lake("gold/features"),
        lake("gold/player_states"),
        lake("squad/sentiment"),
        predictions,
        season,
    )
    run_roster(spark, predictions, lists, lake(f"squad/round={round_num}"), rules, season)


def run_week(
    spark: SparkSession,
    lake: Lake,
    round_num: int,
    season: int = 2026,
    rules: RosterRules = RosterRules(),
    skip_refresh: bool = False,
    skip_sentiment: bool = False,
) -> None:
    """All steps in order. Insights come before the registry, which uses them."""
    if not skip_refresh:
        refresh(spark, lake)
    if not skip_sentiment:
        score_insights(spark, lake)
    if not (skip_refresh and skip_sentiment):
        # the registry holds the sentiment, so either renews it
        run_registry(
            spark,
            lake("gold/features"),
            lake(f"bronze/stats/stats_{season}.parquet"),
            lake("squad/registry"),
            lake("squad/registry_csv"),
            lake("squad/sentiment"),
            season,
        )
    select_round(spark, lake, round_num, season, rules)
