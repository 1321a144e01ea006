"""Match feeds: fixtures and nested season JSON to (season, round, team) rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.functions.scalars import col_of, strip

# Feed keys of the numeric team statistics and their column names.
STAT_KEYS = {
    "all_runs": "all_runs",
    "all_run_metres": "all_run_metres",
    "post_contact_metres": "post_contact_metres",
    "line_breaks": "line_breaks",
    "tackle_breaks": "tackle_breaks",
    "offloads": "offloads",
    "kicks": "kicks",
    "kicking_metres": "kicking_metres",
    "tackles_made": "tackles_made",
    "missed_tackles": "missed_tackles",
    "errors": "errors",
    "penalties_conceded": "penalties_conceded",
    "interchanges_used": "interchanges_used",
    "Completion Rate": "completion_rate_pct",
    "Average_Play_Ball_Speed": "avg_play_ball_speed_s",
    "Kick_Defusal": "kick_defusal_pct",
    "Effective_Tackle": "effective_tackle_pct",
    "tries": "tries",
}

# In rotated blocks, the key that really holds each statistic.
ROTATED_SOURCE = {
    "Average_Play_Ball_Speed": "Completion Rate",
    "Kick_Defusal": "Average_Play_Ball_Speed",
    "Effective_Tackle": "Kick_Defusal",
    "Completion Rate": "Effective_Tackle",
}

META_KEYS = ("ground_condition", "weather_condition", "main_ref")
STATS = ["time_in_possession", *STAT_KEYS.values()]

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
_MATCH = T.StructType(
    [T.StructField("match", _TEXT_MAP), T.StructField("home", _TEXT_MAP), T.StructField("away", _TEXT_MAP)]
)
FEED_SCHEMA = T.StructType(
    [
        T.StructField(
            "NRL",
            T.ArrayType(T.MapType(T.StringType(), T.ArrayType(T.MapType(T.StringType(), _MATCH)))),
        )
    ]
)

_TEAM = T.StructType([T.StructField("nickName", T.StringType()), T.StructField("score", T.StringType())])
FIXTURES_SCHEMA = T.StructType(
    [
        T.StructField(
            "fixtures",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("type", T.StringType()),
                        T.StructField("roundTitle", T.StringType()),
                        T.StructField("homeTeam", _TEAM),
                        T.StructField("awayTeam", _TEAM),
                        T.StructField("venue", T.StringType()),
                        T.StructField(
                            "clock",
                            T.StructType([T.StructField("kickOffTimeLong", T.StringType())]),
                        ),
                        T.StructField("matchState", T.StringType()),
                        T.StructField("matchCentreUrl", T.StringType()),
                    ]
                )
            ),
        )
    ]
)


def fixtures_from_json(df: DataFrame, host: str, data: str = "data") -> DataFrame:
    """Matches of parsed draw pages; needs the columns ``year`` and ``round``."""

    def text(path: str) -> Column:
        return F.coalesce(F.col(f"_f.{path}"), F.lit(""))

    matches = df.select(
        F.col("year").cast("int").alias("year"),
        F.col("round").cast("int").alias("round"),
        F.explode(f"{data}.fixtures").alias("_f"),
    ).filter(F.col("_f.type") == "Match")
    return matches.select(
        "year",
        "round",
        text("roundTitle").alias("round_title"),
        text("homeTeam.nickName").alias("home_team"),
        F.col("_f.homeTeam.score").try_cast("int").alias("home_score"),
        text("awayTeam.nickName").alias("away_team"),
        F.col("_f.awayTeam.score").try_cast("int").alias("away_score"),
        text("venue").alias("venue"),
        text("clock.kickOffTimeLong").alias("match_date"),
        text("matchState").alias("match_state"),
        F.concat(F.lit(host), text("matchCentreUrl")).alias("match_centre_url"),
    )


def round_key(col: Column | str) -> tuple[Column, Column]:
    """Round number and type; a key that is no number is itself the type."""
    col = col_of(col)
    number = col.try_cast("int")
    return number, F.when(number.isNotNull(), F.lit("regular")).otherwise(col)


def matchup_split(df: DataFrame, col: str, sep: str = " v ") -> DataFrame:
    """Home and away team of ``A v B``; rows without exactly two parts go."""
    parts = F.split(F.col(col), sep)
    return df.filter(F.size(parts) == 2).withColumns(
        {"home_team": strip(parts[0]), "away_team": strip(parts[1])}
    )


def parse_messy_number(col: Column | str) -> Column:
    """Number in text like ``78%``, ``3.49s`` or ``1,870``; -1 means missing."""
    col = col_of(col)
    number = strip(F.regexp_replace(col, "[%s,]", "")).try_cast("double")
    return F.when(col != "-1", number)


def is_rotated(home: Column) -> Column:
    """Whether the home completion rate looks like a time."""
    return F.coalesce(F.endswith(F.try_element_at(home, F.lit("Completion Rate")), F.lit("s")), F.lit(False))


def repaired_stat(side: Column, key: str, rotated: Column) -> Column:
    """Raw text of one statistic, read from the right key of a rotated block."""
    straight = F.try_element_at(side, F.lit(key))
    if key not in ROTATED_SOURCE:
        return straight
    moved = F.coalesce(F.try_element_at(side, F.lit(ROTATED_SOURCE[key])), F.lit("-1"))
    return F.when(rotated, moved).otherwise(straight)


def team_stats(side: Column, rotated: Column) -> Column:
    """Struct of the cleaned statistics of one side."""
    fields = [F.try_element_at(side, F.lit("time_in_possession")).alias("time_in_possession")]
    fields += [
        parse_messy_number(repaired_stat(side, key, rotated)).alias(name)
        for key, name in STAT_KEYS.items()
    ]
    return F.struct(*fields)


def feed_flatten(df: DataFrame, raw: str = "raw") -> DataFrame:
    """One row per match of a nested season feed: round key, matchup, three text maps.

    Feeds that cannot be read give no row here; ``unreadable_feeds`` keeps them aside.
    """
    rounds = df.select(
        "year", F.explode(F.from_json(raw, FEED_SCHEMA)["NRL"]).alias("_round")
    ).select("year", F.explode("_round").alias("round_key", "_matches"))
    matches = rounds.select("year", "round_key", F.explode("_matches").alias("_match")).select(
        "year", "round_key", F.explode("_match").alias("matchup", "_data")
    )
    nothing = F.from_json(F.lit("{}"), _TEXT_MAP)
    return matches.select(
        "year",
        "round_key",
        "matchup",
        *[F.coalesce(F.col(f"_data.{part}"), nothing).alias(part) for part in ("match", "home", "away")],
    )


def unreadable_feeds(df: DataFrame, raw: str = "raw") -> DataFrame:
    """(year, rejected): the feeds that give no rounds because their text cannot be read."""
    rounds = F.from_json(raw, FEED_SCHEMA)["NRL"]
    return df.filter(rounds.isNull()).select("year", F.col(raw).alias("rejected"))


def mirror_match_rows(
    df: DataFrame, home: str = "home_team", away: str = "away_team", stats: Sequence[str] = ()
) -> DataFrame:
    """Each match twice, once per team.

    ``stats`` are read from the structs ``home_stats`` and ``away_stats`` and
    come out as ``team_*`` and ``opp_*``.
    """

    def side(team: str, opponent: str, own: str, other: str, is_home: bool) -> Column:
        fields = [
            F.col(team).alias("team"),
            F.col(opponent).alias("opponent"),
            F.lit(is_home).alias("is_home"),
        ]
        fields += [F.col(f"{own}.{s}").alias(f"team_{s}") for s in stats]
        fields += [F.col(f"{other}.{s}").alias(f"opp_{s}") for s in stats]
        return F.struct(*fields)

    both = F.array(
        side(home, away, "home_stats", "away_stats", True),
        side(away, home, "away_stats", "home_stats", False),
    )
    keep = [c for c in df.columns if c not in ("home_stats", "away_stats")]
    return df.select(*keep, F.explode(both).alias("_side")).select(*keep, "_side.*")


def feed_context(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Season feeds to context rows with both teams' statistics."""
    matches = matchup_split(feed_flatten(df, raw), "matchup")
    number, kind = round_key("round_key")
    rotated = is_rotated(F.col("home"))
    flat = matches.select(
        F.col("year").cast("int").alias("year"),
        number.alias("round"),
        kind.alias("round_type"),
        "home_team",
        "away_team",
        *[F.try_element_at("match", F.lit(k)).alias(k) for k in META_KEYS],
        rotated.alias("fields_shifted"),
        team_stats(F.col("home"), rotated).alias("home_stats"),
        team_stats(F.col("away"), rotated).alias("away_stats"),
    )
    return mirror_match_rows(flat, stats=STATS)


def completed_only(fixtures: DataFrame, state: str = "FullTime") -> DataFrame:
    return fixtures.filter(F.col("match_state") == state)


def page_context(fixtures: DataFrame, weather: DataFrame) -> DataFrame:
    """Completed matches with the conditions read from their pages, one row per team."""
    joined = completed_only(fixtures).join(weather, "match_centre_url", "left")
    rows = joined.select(
        "year",
        "round",
        "home_team",
        "away_team",
        F.coalesce("ground_condition", F.lit("")).alias("ground_condition"),
        F.coalesce("weather_condition", F.lit("")).alias("weather_condition"),
    )
    return mirror_match_rows(rows)


WEATHER_LABELS: Mapping[str, str] = {"Ground": "ground_condition", "Weather": "weather_condition"}
