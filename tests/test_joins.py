from __future__ import annotations

import pytest

from panelworks.operators import joins as j
from panelworks.operators.aggregates import career_stats, recent_form
from panelworks.operators.roster import RosterRules, candidate_pool
from panelworks.plans.gold import conform_context


@pytest.fixture
def players(spark):
    return spark.createDataFrame(
        [("A", 2024, 1, "MEL"), ("A", 2024, 2, "MEL"), ("B", 2024, 1, "PAR"), ("C", 2024, None, "PAR"),
         ("D", 2024, 1, "")],
        "player_name string, year bigint, round int, team string",
    )


@pytest.fixture
def context(spark):
    raw = spark.createDataFrame(
        [(2024, 1, "Storm", "Eels", True, "Dry", "Fine"), (2024, 1, "Parramatta", "Storm", False, "Dry", None),
         (2024, 1, "Unknown Team", "Storm", False, "Dry", None)],
        "year bigint, round int, team string, opponent string, is_home boolean, ground_condition string, "
        "weather_condition string",
    )
    return conform_context(raw)


def test_context_has_codes_only(context):
    found = sorted((r["team"], r["opponent"]) for r in context.collect())
    assert found == [("MEL", "PAR"), ("PAR", "MEL")]


def test_byes(players, context, rows):
    byes = j.derive_byes(players, context)
    assert rows(byes, "round", "team", "is_bye") == [(None, "PAR", True), (2, "MEL", True)]
    flagged = j.flag_byes(players, byes)
    wanted = [("A", 1, False), ("A", 2, True), ("B", 1, False), ("C", None, False), ("D", 1, False)]
    assert rows(flagged, "player_name", "round", "is_bye") == wanted


def test_one_join_gives_context_and_byes(players, context, rows):
    step_by_step = j.flag_byes(j.join_context(players, context), j.derive_byes(players, context))
    fused = j.add_match_context(players, context)
    cols = ["player_name", "round", "is_home", "ground_condition", "weather_condition", "is_bye"]
    assert rows(fused, *cols) == rows(step_by_step, *cols)


def test_initial_price(spark, rows):
    df = spark.createDataFrame(
        [("A", 2024, 1, 100000, 0), ("A", 2024, 2, 130000, 50), ("A", 2025, 2, 150000, None)],
        "player_name string, year bigint, round int, price bigint, avg_score int",
    )
    found = rows(
        j.add_initial_price(df), "year", "round", "initial_price", "price_vs_initial", "price_per_point",
        "is_min_price",
    )
    assert found == [
        (2024, 1, 100000, 0, 100000.0, True),
        (2024, 2, 100000, 30000, 2600.0, False),
        (2025, 2, None, None, None, False),
    ]


def test_initial_price_repeats_rows_for_repeated_keys(spark):
    df = spark.createDataFrame(
        [("A", 2024, 1, 100, 1), ("A", 2024, 1, 200, 1)],
        "player_name string, year bigint, round int, price bigint, avg_score int",
    )
    assert j.add_initial_price(df).count() == 4
    assert j.duplicate_keys(df, ["player_name", "year", "round"]).first()["n"] == 2


@pytest.fixture
def fixtures(spark):
    return spark.createDataFrame(
        [
            (2026, 1, "Storm", "Eels", "a"),
            (2026, 1, "Nobody", "Sharks", "a"),
            (2026, 2, "Eels", "Storm", "b"),
            (2025, 3, "Eels", "Storm", "c"),
            (2026, 3, "Sharks", "Eels", "d"),
        ],
        "year int, round int, home_team string, away_team string, match_date string",
    )


def test_opponents_in_both_directions(fixtures, rows):
    found = rows(j.round_opponents(fixtures, 2026, 1), "team", "round_opponent")
    assert found == [("MEL", "PAR"), ("PAR", "MEL")]
    assert j.round_opponents(fixtures, 2026, 9).count() == 0


def test_a_match_of_another_season_does_not_end_a_bye(spark, fixtures, rows):
    """Melbourne plays round 3 in 2025 and has a bye in 2026."""
    df = spark.createDataFrame([("A", "MEL"), ("B", "PAR")], "player_name string, team_2026 string")
    joined = j.join_opponents(df, j.round_opponents(fixtures, 2026, 3), "team_2026")
    assert rows(joined, "player_name", "is_bye") == [("A", True), ("B", False)]
    assert rows(j.round_opponents(fixtures, 2025, 3), "team", "round_opponent") == [("MEL", "PAR"), ("PAR", "MEL")]


def test_a_team_without_match_has_a_bye(spark, fixtures, rows):
    df = spark.createDataFrame([("A", "MEL"), ("B", "SHA")], "player_name string, team_2026 string")
    joined = j.join_opponents(df, j.round_opponents(fixtures, 2026, 1), "team_2026")
    assert rows(joined, "player_name", "round_opponent", "is_bye") == [
        ("A", "PAR", False),
        ("B", None, True),
    ]


def test_states_take_the_last_row_even_if_null(spark, rows):
    states = spark.createDataFrame(
        [("A", 2024, 9, 3, 1.0), ("A", 2025, 1, 4, None), ("B", 2024, 1, 5, 2.0)],
        "player_name string, year bigint, round int, cluster int, anomaly_score double",
    )
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "player_name string")
    found = rows(
        j.join_states(df, states, {3: 3, 4: -4, 5: 2}),
        "player_name", "cluster", "anomaly_score", "cluster_bonus",
    )
    assert found == [("A", 4, 0.0, -4.0), ("B", 5, 2.0, 2.0), ("C", -1, 0.0, 0.0)]


def test_sentiment_meets_flipped_names(spark, rows):
    sentiment = spark.createDataFrame([("Tom Smith", 0.8)], "player_name string, sentiment_score float")
    df = spark.createDataFrame([("Smith, Tom",), ("Tom Smith",)], "player_name string")
    found = rows(j.join_sentiment(df, sentiment), "player_name", "sentiment_boost")
    assert found == [("Smith, Tom", pytest.approx(4.0)), ("Tom Smith", 0.0)]


def test_player_stats(spark):
    gold = spark.createDataFrame(
        [("A", 2025, r, 10 * r, 30 + r, "HOK") for r in range(1, 8)] + [("A", 2024, 1, None, 10, "FRF")],
        "player_name string, year bigint, round int, score int, mins int, primary_position string",
    )
    current = spark.createDataFrame([("A",), ("Z",)], "player_name string")
    stats = j.join_player_stats(current, career_stats(gold), recent_form(gold, 2025))
    a, z = stats.orderBy("player_name").collect()
    assert (a["career_games"], a["career_avg"], a["last5_avg"], a["last3_avg"]) == (7, 40, 50, 60)
    assert (a["last3_avg_mins"], a["last_round_played"], a["primary_position"]) == (36, 7, "HOK")
    assert z["career_avg"] is None and z["last3_avg"] is None


def test_pool_leaves_out_reserves_byes_and_listed(spark, rows):
    df = spark.createDataFrame(
        [("O'Neil, A", True, False), ("B", True, False), ("C", False, False), ("D", True, True),
         ("E", True, False)],
        "player_name string, likely_to_play boolean, is_bye boolean",
    )
    lists = spark.createDataFrame([("ONeil, A", "reserve"), ("B", "bench")], "player_name string, status string")
    pool = candidate_pool(df, RosterRules(excluded=("E",)), lists)
    assert rows(pool, "player_name") == [("B",)]
