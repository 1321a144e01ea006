from __future__ import annotations

import pytest

from panelworks import Panel
from panelworks.operators import windows as w
from panelworks.operators.aggregates import add_career_avg, add_opponent_strength, opponent_strength

SCHEMA = (
    "player_name string, year bigint, round int, score int, break_even int, price bigint, "
    "round_price_change bigint, mins int, opponent string, primary_position string"
)


def panel(spark, rows):
    """Rows of (player, year, round, score), the rest filled from the round."""
    full = [
        (p, y, r, s, 20, 1000 * (r or 1), 100 * (r or 1), 60, "XXX", "HOK") for p, y, r, s in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def one(values):
    return [("A", 2024, i + 1, v) for i, v in enumerate(values)]


def series(df, col):
    return [r[col] for r in df.orderBy("player_name", "year", "round").collect()]


def close(found, wanted):
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted):
        assert (a is None) == (b is None), (found, wanted)
        assert a is None or a == pytest.approx(b)


def test_a_rolling_mean_needs_three_values_not_three_rows(spark):
    df = w.add_rolling(panel(spark, one([10, None, 30, 30, 50])))
    close(series(df, "rolling_avg_3"), [None, None, None, None, 110 / 3])


def test_rolling_deviation_is_the_sample_deviation(spark):
    df = w.add_rolling(panel(spark, one([10, 20, 30, 60, 10])))
    close(series(df, "rolling_std_3"), [None, None, 10.0, 20.816659994661325, 25.166114784235834])
    close(series(df, "rolling_std_5"), [None] * 4 + [20.73644135332772])


def test_average_to_date_leaves_out_the_current_row(spark):
    df = w.add_average_to_date(panel(spark, one([10, None, 30, 30, 50])))
    close(series(df, "season_avg_to_date"), [None, 10, 10, 20, 70 / 3])


def test_average_to_date_reaches_27_rows(spark):
    df = w.add_average_to_date(panel(spark, one([1000] + [0] * 29)))
    found = series(df, "season_avg_to_date")
    assert found[27] == pytest.approx(1000 / 27)
    assert found[28] == 0.0


def test_lags_do_not_cross_players_or_seasons(spark):
    rows = [(p, y, r, 100 * y + r) for p in "AB" for y in (2023, 2024) for r in (1, 2, 3, 4)]
    df = w.add_lags(panel(spark, rows))
    for lag in (1, 2, 3):
        for row in df.collect():
            before = row["score"] - lag if row["round"] > lag else None
            assert row[f"score_lag_{lag}"] == before
    assert {c for c in df.columns if c.startswith("price_change")} == {
        "price_change_lag_1",
        "price_change_lag_2",
    }


def test_form_trend_compares_two_runs_of_three(spark):
    df = w.add_form_trend(panel(spark, one([10, 20, 30, 40, 50, 60, 0])))
    close(series(df, "form_trend"), [None] * 5 + [30.0, 110 / 3 - 30.0])


def test_beaten_count_is_a_count_and_null_safe(spark):
    df = w.add_break_even(panel(spark, one([30, 10, 40, 25, None, 50, 50, 50, 50])))
    assert series(df, "consecutive_be_beaten") == [None, None, None, 2, 2, None, None, None, 3]
    assert series(df, "be_gap")[:3] == [10, -10, 20]
    assert series(df, "be_gap_lag_1")[:3] == [None, 10, -10]


def test_action_score_sums_the_columns_that_exist(spark):
    df = panel(spark, one([1, 2, 3, 4])).selectExpr("*", "round as TR", "2 as TA", "score as KD")
    df = w.add_action_score(df)
    assert series(df, "action_score") == [3, 4, 5, 6]
    close(series(df, "action_score_rolling_3"), [None, None, 4, 5])


def test_lagged_stats_shift_before_rolling(spark):
    df = w.add_lagged_stats(panel(spark, one([1] * 6)).selectExpr("*", "round * 10 as TR"))
    close(series(df, "TR_lag_1"), [None, 10, 20, 30, 40, 50])
    close(series(df, "TR_roll_avg_3"), [None, None, None, 20, 30, 40])
    close(series(df, "TR_roll_avg_5"), [None] * 5 + [30])


def test_lagged_stats_may_follow_another_order(spark):
    df = panel(spark, one([1, 2, 3])).selectExpr("*", "round as TR").drop("opponent")
    df = df.selectExpr("*", "case round when 1 then 'C' when 2 then 'A' else 'B' end as opponent")
    found = w.add_lagged_stats(df, order=["opponent", "round"])
    assert series(found, "TR_lag_1") == [3, None, 2]


def test_target_is_taken_before_low_minutes_are_dropped(spark):
    df = panel(spark, one([10, 20, 30])).selectExpr(
        "* except (mins)", "case when round = 2 then 2 else 60 end as mins"
    )
    found = w.lead_target(df)
    assert [(r["round"], r["target_score"]) for r in found.collect()] == [(1, 20)]


def test_prior_encounters_and_blend(spark):
    scores = [10, 20, None, 40, 50, 60, 70, 80]
    df = add_career_avg(w.add_prior_encounters(panel(spark, one(scores))))
    df = w.blend_with_career(df)
    assert series(df, "games_vs_opponent") == [0, 1, 2, 2, 3, 4, 5, 6]
    close(series(df, "player_vs_opponent_avg"), [None, 10, 15, None, 70 / 3, 30, 36, 250 / 6])
    career = sum(s for s in scores if s is not None) / 7
    blended = series(df, "matchup_adjusted_avg")
    close(
        blended,
        [
            career, 0.2 * 10 + 0.8 * career, 0.4 * 15 + 0.6 * career, None,
            0.6 * 70 / 3 + 0.4 * career, 0.8 * 30 + 0.2 * career, 36, 250 / 6,
        ],
    )


def test_average_rank_shares_ties_and_skips_nulls(spark):
    rows = [(p, 2024, 1, s) for p, s in zip("ABCDE", [10, None, 30, 30, 50])]
    df = w.add_price_ranks(panel(spark, rows))
    assert series(df, "score_rank_in_position") == [1.0, None, 2.5, 2.5, 4.0]
    assert series(df, "price_rank_in_position") == [3.0] * 5


def test_opponent_strength_drops_the_last_row_of_the_group(spark):
    df = panel(spark, one([10, 20, 30]))
    assert opponent_strength(df).first()["opponent_avg_pts_allowed"] == 15.0
    single = panel(spark, one([10]))
    assert opponent_strength(single).first()["opponent_avg_pts_allowed"] is None
    last_null = panel(spark, one([10, 20, None]))
    assert opponent_strength(last_null).first()["opponent_avg_pts_allowed"] == 15.0


@pytest.mark.parametrize("op", ["career", "strength"])
def test_point_in_time_values_ignore_later_rows(spark, op):
    def value(scores):
        df = panel(spark, one(scores))
        if op == "career":
            return series(w.add_career_avg_as_of(df), "career_avg")[:4]
        return series(add_opponent_strength(df, expanding=True), "opponent_avg_pts_allowed")[:4]

    assert value([10, 20, 30, 40, 50]) == value([10, 20, 30, 40, 9999])
    close(value([10, 20, 30, 40, 50]), [None, 10, 15, 20])


def test_carry_forward_keeps_the_last_value(spark):
    df = spark.createDataFrame(
        [("u", 0, None), ("u", 1, "H"), ("u", 2, None), ("u", 3, "K"), ("v", 0, None)],
        "page string, round int, head string",
    )
    found = w.carry_forward(df, ["page"], ["round"], "head", "name").orderBy("page", "round")
    assert [r["name"] for r in found.collect()] == [None, "H", "H", "K", None]


def test_ties_need_a_unique_order(spark):
    """A sequence ending in a unique column makes the lag independent of input order."""
    rows = [("A", 2024, 1, s) for s in (5, 6, 7)]
    df = panel(spark, rows).selectExpr("*", "score as tie")
    ordered = Panel(seq=("round", "tie"))
    one_way = w.add_lags(df, ordered).orderBy("tie").select("score_lag_1").collect()
    other = w.add_lags(df.orderBy("score", ascending=False), ordered).orderBy("tie")
    assert one_way == other.select("score_lag_1").collect()
