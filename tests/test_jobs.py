"""The weekly run from raw tables to a roster, on a small made season."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from panelworks.functions.scalars import TEAM_CODES
from panelworks.operators import layout
from panelworks.operators.cleaning import FLOAT_COLUMNS, INT_COLUMNS
from panelworks.operators.roster import SLOTS, RosterRules
from panelworks.plans import quality
from panelworks.plans.gold import gold_features
from panelworks.plans.registry import current_players, player_registry, players_from_gold
from panelworks.plans.training import run_position_training, run_training, run_tuning
from panelworks.plans.weekly import Lake, run_week

NAMES = {code: name for name, code in TEAM_CODES.items()}
TEAMS = sorted(NAMES)[:4]
POSITIONS = ["HOK", "FRF", "2RF HOK", "HFB", "5/8 HFB", "CTW", "FLB"]
RULES = RosterRules(slots={s: 1 for s in SLOTS}, cap=3_000_000)


def season_rows(year, rounds):
    pick = random.Random(year)
    for p in range(28):
        for rnd in rounds:
            score = pick.randrange(10, 90)
            row = {c: str(pick.randrange(0, 9)) for c in INT_COLUMNS}
            row |= {c: f"{pick.randrange(0, 90)}.5" for c in FLOAT_COLUMNS}
            row |= {
                "year": year, "id": str(p + 1), "Name": f"Player{p:02d}, Al", "Posn": POSITIONS[p % 7],
                "Team": TEAMS[p % 4], "vs": TEAMS[(p + rnd) % 4], "Rd": f"{rnd:02d}",
                "Price": f"${200 + p},{rnd:03d}", "RoundPriceChange": f"$-{rnd},000",
                "SeasonPriceChange": "$0", "Score": str(score), "Mins": str(50 + p), "BE": str(30),
                "AvgScore": str(score),
            }
            yield row
    yield {"year": year, "id": "Any", "Name": "", "Posn": "Pos Pos", "Rd": "Totals"}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = Lake(str(tmp_path_factory.mktemp("lake")))
    for year, rounds in ((2023, range(1, 8)), (2024, range(1, 8)), (2025, range(1, 8)), (2026, (1,))):
        rows = list(season_rows(year, rounds))
        names = sorted({k for r in rows for k in r if k != "year"} - ({"KD"} if year == 2023 else set()))
        schema = ", ".join(["year bigint", *[f"`{n}` string" for n in names]])
        data = [(r["year"], *[r.get(n) for n in names]) for r in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(root(f"stage/stats_{year}.parquet"))
    copy_files(spark, root)
    feed = {"NRL": [
        {str(r): [{f"{NAMES[TEAMS[0]]} v {NAMES[TEAMS[1]]}": {
            "match": {"ground_condition": "Dry"}, "home": {"tries": r}, "away": {"tries": 2}}}]}
        for r in range(1, 8)
    ]}
    feeds = [(y, json.dumps(feed)) for y in (2023, 2024)]
    spark.createDataFrame(feeds, "year int, raw string").write.parquet(root("raw/season_feeds"))
    fixtures = [
        (y, r, NAMES[TEAMS[0]], NAMES[TEAMS[1]], f"{y}-{r:02d}", "FullTime" if y == 2025 else "Upcoming", f"u/{y}/{r}")
        for y in (2025, 2026) for r in range(1, 8)
    ] + [(2026, 3, NAMES[TEAMS[2]], NAMES[TEAMS[3]], "2026-03", "Upcoming", "u/x")]
    schema = "year int, round int, home_team string, away_team string, match_date string, match_state string, match_centre_url string"
    spark.createDataFrame(fixtures, schema).write.parquet(root("bronze/fixtures"))
    pages = [(f"u/2025/{r}", '<p class="match-weather__text">Weather <span>Fine</span></p>') for r in range(1, 8)]
    spark.createDataFrame(pages, "match_centre_url string, html string").write.parquet(root("raw/match_pages"))
    reply = json.dumps([{"player_name": "Al Player03", "team": "x", "position": "HFB", "sentiment_score": 0.8,
                         "confidence": 0.5, "recommendation": "buy", "key_insight": "good"}])
    spark.createDataFrame(
        [("u1", "body", reply), ("u2", "body", "no json"), ("u3", "", reply)], "url string, body string, reply string"
    ).write.parquet(root("raw/replies"))
    html = '<img alt="Storm"><strong>18.</strong> Al Player06'
    spark.createDataFrame([(3, html)], "round int, html string").write.parquet(root("raw/team_pages"))
    return root


def copy_files(spark, root):
    """One parquet file per season, side by side."""
    from pathlib import Path

    target = Path(root("bronze/stats"))
    target.mkdir(parents=True)
    for folder in Path(root("stage")).iterdir():
        part = next(folder.glob("part-*.parquet"))
        (target / folder.name).write_bytes(part.read_bytes())


@pytest.fixture(scope="module")
def week(spark, lake):
    run_week(spark, lake, 3, 2026, RULES)
    return lake


def test_silver_has_all_seasons(spark, week):
    silver = spark.read.parquet(week("silver/player_rounds"))
    assert silver.count() == 28 * (7 * 3 + 1)
    assert silver.filter("KD is null").select("year").distinct().collect()[0]["year"] == 2023
    assert quality.leftover_positions(silver).count() == 0


def test_gold_has_context_and_features(spark, week):
    gold = spark.read.parquet(week("gold/features"))
    assert gold.count() == 28 * 22
    byes = gold.groupBy("team").agg(F.min("is_bye").alias("always"), F.count("is_home").alias("known"))
    found = {r["team"]: (r["always"], r["known"]) for r in byes.collect()}
    # two teams play the seasons before 2026; the others are in no match at all
    assert [found[t][1] for t in TEAMS] == [7 * 21, 7 * 21, 0, 0]
    assert [found[t][0] for t in TEAMS] == [False, False, True, True]
    assert len([c for c in gold.columns if c.endswith(("_lag_1", "_roll_avg_3", "_roll_avg_5"))]) == 88
    fine = gold.filter("year = 2025 and is_home").select("weather_condition").distinct().collect()
    assert [r[0] for r in fine] == ["Fine"]


def test_states_cover_rows_with_three_lags(spark, week):
    gold = spark.read.parquet(week("gold/features"))
    states = spark.read.parquet(week("gold/player_states"))
    assert states.count() == gold.filter("score_lag_3 is not null").count()
    assert {f"latent_{i}" for i in range(8)} < set(states.columns)
    assert states.select("cluster").distinct().count() == 6
    assert states.filter("anomaly_score < 0").count() == 0


def test_registry(spark, week):
    registry = spark.read.parquet(week("squad/registry"))
    assert registry.count() == 28
    row = registry.filter("player_name = 'Player03, Al'").first()
    base = row["career_avg"] * 0.6 + row["last3_avg"] * 0.4
    assert row["predicted_score"] == pytest.approx(base * (1 + 0.8 * 0.5 * 0.1))
    assert (row["expert_recommendation"], row["price_2026"]) == ("buy", 203001)
    assert registry.filter("likely_to_play").count() == 28


def test_predictions_and_roster(spark, week):
    predictions = spark.read.parquet(week("squad/predictions/round=3"))
    assert predictions.count() == 28 and predictions.filter("is_bye").count() == 0
    row = predictions.filter("player_name = 'Player03, Al'").first()
    assert row["sentiment_boost"] == pytest.approx(4.0)
    assert row["adjusted_predicted_score"] == pytest.approx(
        row["round_predicted_score"] + row["cluster_bonus"] - 0.5 * row["anomaly_score"] + 4.0
    )
    roster = spark.read.parquet(week("squad/round=3/roster"))
    audit = spark.read.parquet(week("squad/round=3/audit"))
    assert roster.count() == 8 and roster.filter("player_name = 'Player06, Al'").count() == 0
    assert audit.filter("not holds").count() == 0
    assert spark.read.parquet(week("squad/rejected_replies")).count() == 1


def test_a_round_without_fixtures_is_an_error(spark, week):
    with pytest.raises(ValueError, match="round 20"):
        run_week(spark, week, 20, 2026, RULES, skip_refresh=True, skip_sentiment=True)


def test_training_logs_models_and_metrics(spark, week, tmp_path):
    out = str(tmp_path / "models")
    run_training(spark, week("gold/features"), out, "small", {"maxIter": 2, "maxDepth": 2})
    logged = {r["name"] for r in spark.read.parquet(f"{out}/runs").filter("kind = 'metric'").collect()}
    assert {"boosted_val_mae", "ensemble_test_rmse", "baseline_score_lag_1_mae", "test_HOK_mae"} <= logged
    assert (tmp_path / "models" / "boosted" / "metadata").exists()
    run_position_training(spark, week("gold/features"), out, {"maxIter": 1, "maxDepth": 1})
    names = {r["run_name"] for r in spark.read.parquet(f"{out}/runs").collect()}
    assert "position HOK" in names and len(names) == 8


def test_tuning_logs_all_trials_and_the_errors_of_the_winners(spark, week, tmp_path):
    out = str(tmp_path / "tuned")
    settings = [{"maxDepth": d, "stepSize": s, "minInstancesPerNode": 1} for d, s in ((1, 0.1), (3, 0.1), (2, 0.3))]
    run_tuning(spark, week("gold/features"), out, settings, rungs=(1, 2), budget=3)
    trials = spark.read.parquet(f"{out}/trials").collect()
    positions = {r["position"] for r in trials}
    assert "HOK" in positions
    for p in positions:
        own = [r for r in trials if r["position"] == p]
        assert [sum(r["rung"] == i for r in own) for i in (0, 1)] == [3, 2]
        assert sum(r["kept"] for r in own if r["rung"] == 1) == 1
    runs = spark.read.parquet(f"{out}/runs").collect()
    assert {r["run_name"] for r in runs} == {f"tuning {p}" for p in positions}
    assert {"test_mae", "test_rmse", "val_mae", "maxDepth"} <= {r["name"] for r in runs}
    summary = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/summary").collect()
    assert {r["position"] for r in summary} == positions
    assert all(r["test_mae"] <= r["test_rmse"] + 1e-9 for r in summary)
    assert (tmp_path / "tuned" / "position=HOK" / "metadata").exists()


def test_gold_is_the_same_with_split_groups(spark, week, monkeypatch):
    """And hot entities are cut once for all windows."""
    silver = spark.read.parquet(week("silver/player_rounds"))
    cut, of_keys = layout._cut, []
    monkeypatch.setattr(layout, "_cut", lambda df, keys, *more: of_keys.append(keys) or cut(df, keys, *more))
    for point_in_time in (False, True):
        plain = gold_features(silver, point_in_time=point_in_time)
        of_keys.clear()
        split = gold_features(silver, point_in_time=point_in_time, hot_rows=15)
        assert [k for k in of_keys if "player_name" in k] == [("player_name",)]
        cols = sorted(plain.columns)

        def table(df):
            key = [F.round(c, 6).alias(c) if t in ("double", "float") else F.col(c) for c, t in sorted(df.dtypes)]
            return sorted(map(repr, df.select(key).collect()))

        assert sorted(split.columns) == cols
        assert table(plain) == table(split)


def test_registry_keeps_one_row_per_player_unless_told(spark):
    grid = spark.createDataFrame(
        [("1", "A, B", "HOK", "MEL", "$100", "5", "01"), ("1", "A, B", "5/8 HFB", "MEL", "$200", "x", "02"),
         ("1", "A, B", "HOK", "MEL", "$900", "5", "Totals")],
        "id string, Name string, Posn string, Team string, Price string, BE string, Rd string",
    )
    row = current_players(grid).collect()
    assert [(r["price_2026"], r["position_2026"], r["secondary_position_2026"], r["break_even_2026"]) for r in row] == [
        (200, "5_8", "HFB", None)
    ]
    assert current_players(grid, dedupe=False).count() == 3


def test_players_without_enough_games_go(spark):
    schema = "player_name string, year bigint, round int, score int, mins int, primary_position string, price bigint, team string, break_even int"
    data = [("A", 2025, r, 50, 60, "HOK", 100, "MEL", 5) for r in range(1, 11)]
    data += [("B", 2025, r, 50, 60, "HOK", 100, "MEL", 5) for r in range(1, 10)]
    gold = spark.createDataFrame(data, schema)
    players = players_from_gold(gold, 2025).unionByName(
        spark.createDataFrame([("N", 1, "HOK", "MEL", 5, None)],
                              "player_name string, price_2026 bigint, position_2026 string, team_2026 string, "
                              "break_even_2026 int, secondary_position_2026 string")
    )
    found = sorted((r["player_name"], r["predicted_score"], r["likely_to_play"]) for r in player_registry(gold, players).collect())
    assert found == [("A", 50.0, True), ("N", None, False)]


def test_quality(spark):
    df = spark.createDataFrame([(2024, 1, 17, 1), (2024, None, 5, 2), (2025, 2, 30, 3)], "year bigint, TR int, score int, n int")
    found = quality.season_quality(df).orderBy("year").collect()
    assert [(r["rows"], r["action_score_nulls"], r["max_weighted_diff"], r["max_action_diff"]) for r in found] == [
        (2, 1, 0, 16), (1, 0, 4, 28),
    ]
    assert [tuple(r) for r in quality.null_score_seasons(df).collect()] == [(2024, 1)]
