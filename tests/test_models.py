from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelworks.operators import features as f
from panelworks.operators import models as m
from panelworks.operators import prepared
from panelworks.operators.aggregates import (
    aggregate_insights,
    baseline_metrics,
    regression_metrics,
)
from panelworks.operators.topk import metric_leaderboard, top_features

FEATURES = ["x", "y", "z"]


@pytest.fixture(scope="module")
def planted(spark):
    """A target the features explain: 3x - 2y plus a little that they do not."""
    df = spark.range(900).selectExpr(
        "id",
        "cast(2020 + id % 6 as bigint) as year",
        "(id * 37 % 101) / 10.0 as x",
        "(id * 53 % 97) / 10.0 as y",
        "if(id % 7 = 0, null, id % 5) as z",
        "concat('P', floor(id / 6) % 2) as primary_position",
    )
    target = F.expr("3 * x - 2 * y + (id % 3) / 10.0").alias("target")
    return f.season_split(df.select("*", target)).cache()


def test_split_leaves_other_seasons_out(spark):
    df = spark.createDataFrame([(2015,), (2023,), (2024,), (2025,), (2026,)], "year bigint")
    found = {r["year"]: r["split"] for r in f.season_split(df).collect()}
    assert found == {2015: "train", 2023: "train", 2024: "val", 2025: "test"}


def test_boosting_beats_the_naive_baseline_and_repeats(spark, planted):
    params = {"maxIter": 30, "maxDepth": 4, "stepSize": 0.2}
    model = m.fit_score_model(planted, FEATURES, "target", params)
    scored = m.predict(model, planted, FEATURES)
    val = scored.filter("split = 'val'").withColumn("naive", F.lit(5.0))
    assert regression_metrics(val, "target", "prediction").first()["mae"] < 0.3 * (
        regression_metrics(val, "target", "naive").first()["mae"]
    )
    again = m.predict(m.fit_score_model(planted, FEATURES, "target", params), planted, FEATURES)
    total = lambda df: df.agg(F.sum("prediction")).first()[0]
    assert total(scored) == pytest.approx(total(again))
    assert "_f_0" not in scored.columns and scored.count() == planted.count()


def test_importance_names_the_features_that_matter(spark, planted):
    model = m.fit_score_model(planted, FEATURES, "target", {"maxIter": 5, "maxDepth": 4})
    ranked = top_features(m.feature_importance(spark, model, FEATURES), 2).collect()
    assert [r["feature"] for r in ranked] == ["x", "y"]


def test_one_model_per_position(planted):
    fitted = m.fit_by_position(planted, FEATURES, "target", params={"maxIter": 2, "maxDepth": 2})
    assert set(fitted) == {"P0", "P1"}


def test_tuning_keeps_the_best_trial(planted):
    best, trials, model = m.tune_fixed_validation(
        planted, FEATURES, "target", {"maxIter": [2], "maxDepth": [1, 4], "stepSize": [0.5]}
    )
    ranked = metric_leaderboard(trials).collect()
    assert ranked[0]["params"] == str(best) and best["maxDepth"] == 4
    assert model.getOrDefault("maxDepth") == 4


def test_halving_drops_the_worse_half_and_fits_the_winner_again(planted):
    rows = m.assemble(planted, FEATURES)
    settings = [{"maxDepth": d, "stepSize": step, "subsamplingRate": 1.0} for d in (1, 4) for step in (0.01, 0.4)]
    tuned = m.successive_halving(rows, "target", settings, rungs=(2, 6), budget=25)
    assert tuned.settings == settings[3]
    assert [(t["rung"], t["trees"], t["trial"]) for t in tuned.trials[:4]] == [(0, 2, i) for i in range(4)]
    for rung, kept in ((0, 2), (1, 1)):
        own = sorted((t for t in tuned.trials if t["rung"] == rung), key=lambda t: (t["val_mae"], t["trial"]))
        assert [t["kept"] for t in own] == [True] * kept + [False] * (len(own) - kept)
    assert {t["trial"] for t in tuned.trials if t["rung"] == 1} == {t["trial"] for t in tuned.trials if t["rung"] == 0 and t["kept"]}
    assert 6 < tuned.model.getNumTrees <= 25


def test_every_position_is_tuned_on_its_own_rows(spark, planted):
    rows = planted.withColumn("primary_position", F.when(F.col("id") > 890, "late").otherwise(F.col("primary_position")))
    rows = rows.filter("primary_position <> 'late' or split = 'train'")
    settings = [{"maxDepth": 1, "stepSize": 0.01}, {"maxDepth": 4, "stepSize": 0.4}, {"maxDepth": 2, "stepSize": 0.1}]
    found, trials, errors = m.tune_by_position(rows, FEATURES, "target", settings, rungs=(2, 4), budget=10)
    assert set(found) == {"P0", "P1"} and all(t.settings == settings[1] for t in found.values())
    assert {(r["position"], r["n"]) for r in trials.groupBy("position").agg(F.count(F.lit(1)).alias("n")).collect()} == {("P0", 5), ("P1", 5)}
    wanted = rows.filter("primary_position <> 'late'").groupBy("primary_position", "split").count().collect()
    assert {(r["position"], r["split"], r["n"]) for r in errors.collect()} == {tuple(r) for r in wanted}
    deviation = planted.agg(F.stddev_pop("target")).first()[0]
    assert all(r["rmse"] < 0.5 * deviation for r in errors.collect())


def test_drawn_settings_stay_in_their_ranges():
    drawn = m.drawn_settings(200)
    assert drawn == m.drawn_settings(200) and drawn[:5] == m.drawn_settings(5)
    assert all(3 <= s["maxDepth"] <= 10 and 0.01 <= s["stepSize"] <= 0.3 and 5 <= s["minInstancesPerNode"] <= 50 for s in drawn)
    assert all(0.5 <= s["subsamplingRate"] <= 1 and 0.5 <= float(s["featureSubsetStrategy"]) < 1 for s in drawn)


def test_ensemble_is_the_mean(spark):
    df = m.ensemble_mean(spark.createDataFrame([(1.0, 3.0)], "a double, b double"), "a", "b")
    assert df.first()["ensemble"] == 2.0


def test_models_are_stored(spark, planted, tmp_path):
    model = m.fit_forest(planted, FEATURES, "target", {"numTrees": 3, "maxDepth": 3})
    m.persist_model(model, str(tmp_path / "forest"))
    loaded = m.load_model(str(tmp_path / "forest")).stages[0]
    assert loaded.getNumTrees == 3


def test_runs_are_appended(spark, tmp_path):
    path = str(tmp_path / "runs")
    m.log_run(spark, path, "one", {"maxDepth": 3}, {"mae": 1.5}, {"note": "x"})
    m.log_run(spark, path, "two", metrics={"mae": 1.0})
    found = spark.read.parquet(path).filter("name = 'mae'").orderBy("run_name").collect()
    assert [(r["run_name"], r["value"]) for r in found] == [("one", "1.5"), ("two", "1.0")]


def test_anomaly_is_the_reconstruction_error(spark):
    df = spark.range(200).selectExpr("cast(id % 10 as double) as a", "id % 10 * 2.0 as b", "cast(id % 3 as double) as c")
    df = f.standardise(df, ["a", "b", "c"])
    errors = {}
    for k in (1, 2, 3):
        projected, _ = m.latent_and_anomaly(df, ["a", "b", "c"], k)
        errors[k] = projected.agg(F.avg("anomaly_score"), F.min("anomaly_score")).first()
    assert errors[1][0] > errors[2][0] >= errors[3][0]
    assert errors[3][0] == pytest.approx(0, abs=1e-9) and errors[1][1] >= 0
    # a and b are one dimension, so two components explain all of it
    assert errors[2][0] == pytest.approx(0, abs=1e-9)


def test_clusters_are_numbered_by_the_profile(spark):
    df = spark.range(60).selectExpr("cast(id as double) as id", "array(id % 3 * 100.0, 1.0) as v", "-(id % 3) as momentum")
    states, _ = m.cluster_states(m.array_features(df, "v"), "momentum", k=3)
    means = states.groupBy("cluster").agg(F.avg("momentum").alias("mean")).orderBy("cluster").collect()
    assert [(r["cluster"], r["mean"]) for r in means] == [(0, -2.0), (1, -1.0), (2, 0.0)]


def test_medians_are_exact(spark):
    df = spark.createDataFrame([(1.0, 5), (None, 1), (3.0, 9), (10.0, 2), (2.0, None)], "a double, b int")
    found = {r["column"]: r["median"] for r in f.exact_medians(df, ["a", "b"]).collect()}
    assert found == {"a": 2.5, "b": 3.5}
    filled = f.impute_median(df, ["a", "b"]).orderBy("a", "b")
    assert sorted(r["a"] for r in filled.collect()) == [1.0, 2.0, 2.5, 3.0, 10.0]


@pytest.mark.parametrize("rows, accuracy", [(1, 10_000), (2, 10_000), (999, 10), (1000, 10), (3000, 200), (3000, 10_000)])
def test_medians_by_bracket_are_exact_with_ties_and_hot_values(spark, rows, accuracy):
    df = spark.range(rows).selectExpr(
        "(id * 7919 % 1009) / 7.0 as spread",
        "if(id % 3 = 0, id % 50, 4) as hot",
        "if(id % 5 = 0, null, id * id % 13) as ties",
        "if(id % 2 = 0, double('-infinity'), id) as ends",
        "cast(null as double) as nothing",
    ).repartition(7)
    found = {r["column"]: r["median"] for r in f.exact_medians(df, df.columns, accuracy=accuracy).collect()}
    own = df.toPandas()
    wanted = {c: float(np.median(own[c].dropna().astype(float))) for c in df.columns if own[c].notna().any()}
    assert found == wanted


def test_a_bracket_that_misses_the_middle_gives_nothing(spark):
    df = spark.range(100).selectExpr("id as x")
    for low, high in ((60.0, 80.0), (0.0, 20.0), (50.0, 50.0), (0.0, 49.0)):
        assert f._medians_within(df, {"x": (100, low, high)}, None) == {}
    assert f._medians_within(df, {"x": (100, 49.0, 50.0)}, None) == {"x": 49.5}


def test_all_null_columns_stay_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert [r["a"] for r in f.impute_median(df, ["a"]).collect()] == [None, None]


def test_codes(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "t string")
    assert rows(f.encode_codes(df, ["t"]), "t", "t_enc") == [(None, None), ("a", 0), ("b", 1), ("c", 2)]
    seen = df.filter("t is null or t <> 'c'")
    found = rows(f.label_encode(df, seen, ["t"]), "t", "t_enc")
    assert found == [(None, 2), ("a", 0), ("b", 1), ("c", -1)]


def test_features_leave_out_text_and_leaks(spark):
    df = spark.createDataFrame([("a", 1, 2.0, True, 5)], "n string, score int, ok double, flag boolean, mins int")
    assert f.select_features(df) == ["ok", "flag"]
    assert len(set(f.LEAKING_COLUMNS)) == 61
    assert f.fill_sentinel(df.selectExpr("cast(null as int) as q"), ["q"]).first()["q"] == -999.0


def test_one_hot_and_scaling(spark):
    df = spark.createDataFrame([("b", 1.0, 4), (None, 3.0, 4)], "p string, v double, k int")
    flagged, names = f.one_hot(df, "p")
    assert names == ["pos_UNK", "pos_b"]
    assert sorted(tuple(r) for r in flagged.select(names).collect()) == [(0.0, 1.0), (1.0, 0.0)]
    scaled = f.standardise(df, ["v", "k"]).orderBy("v").collect()
    assert [(r["v"], r["k"]) for r in scaled] == [(-1.0, 0.0), (1.0, 0.0)]


def test_metrics(spark):
    df = spark.createDataFrame(
        [("A", 10.0, 7.0, None)] * 10 + [("B", 1.0, 0.0, 1.0)] * 9 + [(None, 0.0, 0.0, 0.0)],
        "p string, t double, g double, l double",
    )
    grouped = regression_metrics(df, "t", "g", by="p").collect()
    assert [(r["p"], r["n"], r["mae"], r["rmse"]) for r in grouped] == [("A", 10, 3.0, 3.0)]
    naive = {r["baseline"]: r["mae"] for r in baseline_metrics(df, "t", ["g", "l"]).collect()}
    assert naive == {"g": pytest.approx(39 / 20), "l": pytest.approx(100 / 20)}


def test_insights(spark):
    records = spark.createDataFrame(
        [
            ("A", "T1", "HOK", 0.5, 0.5, "buy", "first", "u1", 1),
            ("A", None, "FRF", 0.1, 1.0, "hold", "second", "u2", 2),
            ("A", None, "FRF", None, None, "avoid", "third", None, 3),
            ("B", "T2", "CTW", -0.2, 0.3, "avoid", "x", "u1", 1),
        ],
        "player_name string, team string, position string, sentiment_score float, confidence float, "
        "recommendation string, key_insight string, source_url string, n int",
    )
    a, b = aggregate_insights(records, ["n"]).orderBy("player_name").collect()
    assert (a["team"], a["position"], a["key_insight"]) == (None, "FRF", "third")
    assert (a["sentiment_score"], a["confidence"]) == (0.3, 0.75)
    assert (a["recommendation"], a["sources"]) == ("buy", "u1, u2")
    assert b["sources"] == "u1"


def test_a_stored_pipeline_prepares_rows_as_it_did_at_first(spark, tmp_path):
    train = spark.createDataFrame([("b", 1.0, 5), ("a", None, 7), (None, 3.0, 9), ("a", 8.0, None)], "p string, x double, n int")
    fitted = prepared.fit_preparation(train, ["p"], ["x", "n"])
    m.persist_model(fitted, str(tmp_path / "pipeline"))
    loaded = m.load_model(str(tmp_path / "pipeline"))
    new = spark.createDataFrame([("a", None, 7), ("z", 3.0, None), (None, 1.0, 9)], "p string, x double, n int")
    rows = loaded.transform(new).collect()
    assert [r["p_enc"] for r in rows] == [0.0, -1.0, 2.0]
    x, n = [1.0, 3.0, 3.0, 8.0], [5.0, 7.0, 9.0, 7.0]  # nulls are the medians
    scale = lambda v, own: (v - np.mean(own)) / np.std(own)
    wanted = [[0, scale(3.0, x), scale(7, n)], [-1, scale(3.0, x), scale(7, n)], [2, scale(1.0, x), scale(9, n)]]
    assert np.allclose([r["features"].toArray() for r in rows], wanted)
    assert loaded.transform(new).columns == ["p", "x", "n", "p_enc", "features"]
    assert prepared.feature_names(loaded) == ["p_enc", "x", "n"]


def test_trees_after_the_best_round_are_cut_off(spark, tmp_path):
    """Labels of chance: more trees fit the training rows better and the validation rows worse."""
    rows = spark.range(400).selectExpr(
        "if(id % 2 = 0, 'train', 'val') as split", "rand(1) as x", "rand(2) as y", "id % 4 as z", "randn(3) + if(id % 4 = 0, 1, 0) as target"
    )
    vectors = m.assemble(rows, ["x", "y", "z"]).cache()
    model, errors = m.fit_best_rounds(vectors, "target", {"maxIter": 40, "maxDepth": 4, "stepSize": 0.3}, patience=100)
    kept = m.best_round(errors, 100)
    assert model.getNumTrees == kept < len(errors) == 40 and errors[kept - 1] == min(errors[: kept + 100])
    own = m.split_metrics(model.transform(vectors), "target", "prediction").filter("split = 'val'").first()
    assert abs(own["mae"] - errors[kept - 1]) < 1e-9
    m.persist_model(model, str(tmp_path / "cut"))
    again = m.load_model(str(tmp_path / "cut")).transform(vectors)
    assert m.split_metrics(again, "target", "prediction").filter("split = 'val'").first()["mae"] == own["mae"]


def test_best_round_and_patience():
    assert m.best_round([5, 4, 3, 4, 5, 2], 10) == 6
    assert m.best_round([5, 4, 3, 4, 5, 2], 2) == 3
    assert m.best_round([1.0], 3) == 1


def test_medians_compute_their_input_once(spark):
    """Sketch, counts and result read stored rows, whatever the input is made of."""
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(100).select("id", F.col("id").alias("a")).mapInArrow(noted, "id long, a long")
    assert f.exact_medians(df, ["a"]).first()["median"] == 49.5
    assert seen.value == 100
    filled = f.impute_median(df, ["a"])
    assert filled.count() == 100 and filled.agg(F.sum("a")).first()[0] == 4950.0
    assert seen.value == 200
