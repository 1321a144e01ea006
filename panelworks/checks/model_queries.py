"""Feature preparation and MLlib models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.checks.book import r8, register
from panelworks.checks.panels import EV, EVENTS, LI, event_panel, rounded, stored, supply_panel, table
from panelworks.checks.source_queries import scratch
from panelworks.checks.window_queries import OVER
from panelworks.operators import features as f
from panelworks.operators import models as m
from panelworks.operators.aggregates import cluster_profile
from panelworks.operators.prepared import fit_preparation, with_learner
from panelworks.operators.topk import metric_leaderboard, top_features
from panelworks.operators.windows import add_features, lags, lead_target, rolling_mean
from panelworks.sources.tables import read_table as table_at
from panelworks.sources.tables import union_drift


@register(
    "season_split",
    f"""WITH {EV} SELECT event_id, CASE WHEN year <= 2023 THEN 'train' WHEN year = 2024 THEN 'val'
    ELSE 'test' END AS split FROM ev WHERE year <= 2025""",
)
def season_split(spark: SparkSession, sf: str) -> DataFrame:
    return f.season_split(event_panel(spark, sf)).select("event_id", "split")


@register(
    "category_codes",
    f"""WITH {LI} SELECT player_name, year, round,
    CAST(dense_rank() OVER (ORDER BY position) - 1 AS INTEGER) AS position_enc,
    CASE WHEN secondary_position IS NOT NULL THEN CAST(dense_rank() OVER
      (ORDER BY secondary_position NULLS LAST) - 1 AS INTEGER) END AS secondary_position_enc FROM li""",
)
def category_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded = f.encode_codes(supply_panel(spark, sf), ["position", "secondary_position"])
    return coded.select("player_name", "year", "round", "position_enc", "secondary_position_enc")


@register(
    "label_codes_with_unseen",
    f"""WITH {LI}, v AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM
      (SELECT DISTINCT coalesce(secondary_position, 'unknown') AS value FROM li
       WHERE year <= 2023 AND coalesce(secondary_position, '') <> 'FLB'))
    SELECT player_name, year, round, CAST(coalesce(code, -1) AS INTEGER) AS secondary_position_enc
    FROM li LEFT JOIN v ON coalesce(secondary_position, 'unknown') = value WHERE year > 2023""",
)
def label_codes(spark: SparkSession, sf: str) -> DataFrame:
    panel = supply_panel(spark, sf)
    known = F.coalesce(F.col("secondary_position"), F.lit("")) != "FLB"
    fitted_on = panel.filter((F.col("year") <= 2023) & known)
    coded = f.label_encode(panel.filter(F.col("year") > 2023), fitted_on, ["secondary_position"])
    return coded.select("player_name", "year", "round", "secondary_position_enc")


@register(
    "filled_sentinel",
    f"""WITH {LI} SELECT player_name, year, round, CAST(coalesce("TR", -999) AS DOUBLE) AS tr,
    CAST(coalesce(score, -999) AS DOUBLE) AS score FROM li""",
)
def filled_sentinel(spark: SparkSession, sf: str) -> DataFrame:
    panel = supply_panel(spark, sf)
    wanted = [c for c in f.select_features(panel, exclude=()) if c in ("TR", "score")]
    filled = f.fill_sentinel(panel, wanted)
    return filled.select("player_name", "year", "round", F.col("TR").alias("tr"), "score")


MEDIANS = ("score", "price", "TR", "bppm")


@register(
    "exact_medians",
    f"WITH {LI} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r8(f'median({c})', 'median')} FROM li" for c in MEDIANS
    ),
)
def exact_medians(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(f.exact_medians(supply_panel(spark, sf), MEDIANS))


@register(
    "imputed_medians",
    f"""WITH {LI} SELECT player_name, year, round, {r8('coalesce(score, (SELECT median(score) FROM li))', 'score')},
    {r8('coalesce("TR", (SELECT median("TR") FROM li))', 'tr')} FROM li""",
)
def imputed_medians(spark: SparkSession, sf: str) -> DataFrame:
    panel = supply_panel(spark, sf).select("player_name", "year", "round", "score", "TR")
    filled = f.impute_median(panel, ["score", "TR"])
    return rounded(filled.select("player_name", "year", "round", "score", F.col("TR").alias("tr")))


@register(
    "one_hot_positions",
    f"""WITH {LI} SELECT player_name, year, round,
    CAST(secondary_position IS NULL AS DOUBLE) AS "pos_UNK",
    CAST(coalesce(secondary_position = 'HOK', false) AS DOUBLE) AS "pos_HOK" FROM li""",
)
def one_hot_positions(spark: SparkSession, sf: str) -> DataFrame:
    flagged, _ = f.one_hot(supply_panel(spark, sf), "secondary_position")
    return flagged.select("player_name", "year", "round", "pos_UNK", "pos_HOK")


@register(
    "standardised_columns",
    f"""WITH {LI} SELECT player_name, year, round,
    {r8('(price - avg(price) OVER ()) / stddev_pop(price) OVER ()', 'price')},
    {r8('(mins - avg(mins) OVER ()) / stddev_pop(mins) OVER ()', 'mins')} FROM li""",
)
def standardised_columns(spark: SparkSession, sf: str) -> DataFrame:
    scaled = f.standardise(supply_panel(spark, sf), ["price", "mins"])
    return rounded(scaled, "player_name", "year", "round", "price", "mins")


# --- models ------------------------------------------------------------------------

FEATURES = ["score_lag_1", "score_lag_2", "rolling_avg_3", "price", "avg_score", "mins"]

#: The labelled rows with their split; the same rows the learners get.
ROWS = f"""{EV}, t AS (SELECT *, lead(score) OVER ({OVER}) AS target FROM ev),
    rows AS (SELECT event_id, primary_position, CASE WHEN year <= 2023 THEN 'train' WHEN year = 2024 THEN 'val'
      ELSE 'test' END AS split FROM t WHERE target IS NOT NULL AND mins >= 5 AND year <= 2025)"""


def model_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Event rows with lagged features, a next-row target and a split."""
    families = [lags("score", (1, 2), "score"), rolling_mean("score", 3, "rolling_avg_3")]
    rows = add_features(event_panel(spark, sf), EVENTS, families)
    return stored(
        f.season_split(lead_target(rows, EVENTS)).select(
            "event_id", "primary_position", "split", "target_score", *FEATURES
        )
    )


def against_mean(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Rows per split, and whether the learner fits the training rows better than their mean does."""
    mean = scored.filter("split = 'train'").agg(F.avg("target_score")).scalar()
    naive = m.split_metrics(scored.withColumn("_mean", mean), "target_score", "_mean")
    errors = m.split_metrics(scored, "target_score", prediction)
    both = errors.join(naive.select("split", F.col("rmse").alias("_naive")), "split")
    # a constant learner is not better
    better = (F.col("split") != "train") | (F.col("rmse") < F.col("_naive") * 0.999)
    return both.select("split", F.col("n"), better.alias("better_than_mean"))


PER_SPLIT = f"WITH {ROWS} SELECT split, count(*) AS n, true AS better_than_mean FROM rows GROUP BY split"


@register("boosted_trees", PER_SPLIT)
def boosted_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees with the whole budget, stopped early on the validation season."""
    rows = model_rows(spark, sf)
    model = m.fit_score_model(rows, FEATURES, "target_score")
    return against_mean(m.predict(model, rows, FEATURES))


@register("ensemble_of_learners", PER_SPLIT)
def ensemble(spark: SparkSession, sf: str) -> DataFrame:
    rows = model_rows(spark, sf)
    boosted = m.fit_score_model(rows, FEATURES, "target_score")
    forest = m.fit_forest(rows, FEATURES, "target_score")
    scored = m.predict(forest, m.predict(boosted, rows, FEATURES, "a"), FEATURES, "b")
    return against_mean(m.ensemble_mean(scored, "a", "b"), "ensemble")


@register(
    "important_features",
    "SELECT unnest(['"
    + "', '".join(FEATURES)
    + "']) AS feature, true AS is_share, true AS adds_up",
)
def important_features(spark: SparkSession, sf: str) -> DataFrame:
    """Importances are shares that add up to one."""
    model = m.fit_score_model(model_rows(spark, sf), FEATURES, "target_score")
    listed = top_features(m.feature_importance(spark, model, FEATURES), 20)
    total = listed.agg(F.abs(F.sum("importance") - 1) < 1e-9).scalar()
    return listed.select("feature", F.col("importance").between(0, 1).alias("is_share"), total.alias("adds_up"))


@register(
    "model_per_position",
    f"""WITH {ROWS}, u AS (SELECT primary_position FROM rows GROUP BY 1
      HAVING count(*) FILTER (split = 'train') > 0 AND count(*) FILTER (split = 'val') > 0)
    SELECT primary_position AS position, split, count(*) AS n, true AS better_than_mean
    FROM rows JOIN u USING (primary_position) GROUP BY primary_position, split""",
)
def model_per_position(spark: SparkSession, sf: str) -> DataFrame:
    rows = model_rows(spark, sf)
    fitted = m.fit_by_position(rows, FEATURES, "target_score")
    parts = []
    for p, model in fitted.items():
        scored = m.predict(model, rows.filter(F.col("primary_position") == p), FEATURES)
        parts.append(against_mean(scored).withColumn("position", F.lit(p)))
    return union_drift(parts).select("position", "split", "n", "better_than_mean")


TUNING = {"maxDepth": [4, 6], "stepSize": [0.05, 0.1]}
TRIALS = ", ".join(
    f"($${{'maxDepth': {d}, 'stepSize': {s}}}$$)" for d in TUNING["maxDepth"] for s in TUNING["stepSize"]
)


@register(
    "tuned_on_validation_season",
    f"SELECT params, true AS has_errors FROM (VALUES {TRIALS}) AS t(params)",
)
def tuned(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each setting that was tried, best first."""
    _, trials, _ = m.tune_fixed_validation(model_rows(spark, sf), FEATURES, "target_score", TUNING)
    return metric_leaderboard(trials).select("params", (F.col("val_mae") <= F.col("val_rmse")).alias("has_errors"))


@register(
    "tuned_per_position",
    f"""WITH {EV}, t AS (SELECT *, lead(score) OVER ({OVER}) AS target, lag(score) OVER ({OVER}) AS before FROM ev),
    rows AS (SELECT primary_position AS position, target, coalesce(before, 0) AS before, year FROM t
      WHERE target IS NOT NULL AND mins >= 5 AND year <= 2025)
    SELECT position, count(*) FILTER (year = 2025) AS n, {r8('avg(abs(before - target)) FILTER (year = 2025)', 'naive_mae')},
    true AS better_than_naive, true AS better_than_mean, CAST(6 AS BIGINT) AS trials, CAST(1 AS BIGINT) AS winners
    FROM rows GROUP BY position
    HAVING count(*) FILTER (year <= 2023) > 0 AND count(*) FILTER (year = 2024) > 0 AND n > 0""",
)
def tuned_per_position(spark: SparkSession, sf: str) -> DataFrame:
    """Four settings a position, halved twice; the winner against the score before on the test season.

    ``better_than_mean`` looks at all positions together: whether the winners fit the training rows better than
    the means of the positions do. A winner cut off after its first round need not, a constant learner never does.
    """
    rows = model_rows(spark, sf)
    _, trials, errors = m.tune_by_position(
        rows, FEATURES, "target_score", m.drawn_settings(4), rungs=(4, 8), budget=40, parallelism=8
    )
    errors = stored(errors)
    test, train = (rows.filter(F.col("split") == s) for s in ("test", "train"))
    before = test.withColumn("_before", F.coalesce(F.col("score_lag_1"), F.lit(0)))
    naive = m.regression_metrics(before, "target_score", "_before", by="primary_position", min_rows=1)
    naive = naive.select(F.col("primary_position").alias("position"), F.col("mae").alias("naive_mae"))
    counted = trials.groupBy("position").agg(
        F.count(F.lit(1)).alias("trials"), F.count_if((F.col("rung") == 1) & F.col("kept")).alias("winners")
    )
    # the squared error of a mean is the variance
    variance = train.groupBy(F.col("primary_position").alias("position")).agg(F.var_pop("target_score").alias("_variance"))
    fitted = errors.filter("split = 'train'").join(variance, "position")
    squares = [F.sum(F.col("n") * x) for x in (F.col("rmse") * F.col("rmse"), F.col("_variance"))]
    better = fitted.agg((squares[0] < squares[1] * 0.99).alias("better_than_mean")).scalar()
    tested = errors.filter("split = 'test'").join(naive, "position").join(counted, "position")
    return rounded(
        tested.select(
            "position",
            "n",
            "naive_mae",
            (F.col("mae") < F.col("naive_mae")).alias("better_than_naive"),
            better.alias("better_than_mean"),
            "trials",
            "winners",
        )
    )


def vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    rows = table(spark, sf, "embeddings")
    names = [f"e{i}" for i in range(64)]
    columns = [F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]
    return f.standardise(stored(rows.select("vec_id", "label", *columns)), names), names


USABLE = "embeddings WHERE embedding IS NOT NULL"


@register(
    "latent_and_anomaly",
    f"SELECT count(*) AS vectors, CAST(count(*) * 64 AS DOUBLE) AS total_variance, true AS not_negative FROM {USABLE}",
)
def latent(spark: SparkSession, sf: str) -> DataFrame:
    """What the latent columns keep and what the anomaly leaves add up to the variance of the input."""
    rows, names = vectors(spark, sf)
    projected, _ = m.latent_and_anomaly(rows, names)
    spread = m.spread_vector(projected.drop(*names), "latent", 8, "latent_")
    kept = sum(F.col(f"latent_{i}") * F.col(f"latent_{i}") for i in range(8))
    return spread.agg(
        F.count(F.lit(1)).alias("vectors"),
        F.round(F.sum(kept + F.col("anomaly_score") * len(names)), 4).alias("total_variance"),
        (F.min("anomaly_score") >= 0).alias("not_negative"),
    )


@register(
    "clustered_states",
    f"SELECT CAST(6 AS BIGINT) AS clusters, count(*) AS vectors, true AS ascending FROM {USABLE}",
)
def clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters hold all vectors, and their numbers follow the mean of the profile column."""
    rows, names = vectors(spark, sf)
    projected, _ = m.latent_and_anomaly(rows, names)
    states, _ = m.cluster_states(projected.drop(*names), "label")
    profile = cluster_profile(states, ["label", "anomaly_score"])
    means = F.transform(F.sort_array(F.collect_list(F.struct("cluster", "avg_label"))), lambda x: x["avg_label"])
    sizes = states.agg(F.count(F.lit(1))).scalar()
    return profile.agg(
        F.count(F.lit(1)).alias("clusters"), (means == F.sort_array(means)).alias("ascending")
    ).select("clusters", sizes.alias("vectors"), "ascending")


ENTRIES = ", ".join(r8(f"embedding[{i + 1}]", f"latent_{i}") for i in range(64))


@register("array_vectors", f"SELECT vec_id, label, {ENTRIES} FROM embeddings")
def array_vectors(spark: SparkSession, sf: str) -> DataFrame:
    rows = m.array_features(table(spark, sf, "embeddings"), "embedding")
    return rounded(m.spread_vector(rows.drop("embedding"), "latent", 64, "latent_"))


@register("stored_model", f"WITH {ROWS} SELECT event_id, true AS same FROM rows")
def stored_model(spark: SparkSession, sf: str) -> DataFrame:
    """A model that was saved and loaded again predicts what it did before."""
    rows = model_rows(spark, sf)
    path = scratch(spark, "model")
    model = m.fit_score_model(rows, FEATURES, "target_score")
    m.persist_model(model, path)
    scored = m.predict(m.load_model(path).stages[0], m.predict(model, rows, FEATURES, "before"), FEATURES, "after")
    return scored.select("event_id", (F.col("before") == F.col("after")).alias("same"))


NUMERIC = ["score_lag_1", "rolling_avg_3", "price", "mins"]


@register(
    "scored_by_stored_pipeline",
    f"""WITH {ROWS}, c AS (SELECT primary_position, row_number() OVER (ORDER BY primary_position) - 1 AS code FROM
      (SELECT DISTINCT coalesce(primary_position, 'unknown') AS primary_position FROM rows
       WHERE split = 'train' AND primary_position <> (SELECT max(primary_position) FROM rows)))
    SELECT event_id, CAST(coalesce(code, -1) AS DOUBLE) AS primary_position_enc, true AS scored, true AS better_than_mean
    FROM rows LEFT JOIN c ON coalesce(rows.primary_position, 'unknown') = c.primary_position""",
)
def scored_by_stored_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Codes, medians, scaling and learner stored as one pipeline, which scores rows of a position it has not seen."""
    rows = model_rows(spark, sf)
    last = rows.agg(F.max("primary_position")).scalar()
    train = rows.filter((F.col("split") == "train") & (F.col("primary_position") != last))
    preparation = fit_preparation(train, ["primary_position"], NUMERIC)
    known = preparation.transform(rows.filter((F.col("primary_position") != last) & F.col("split").isin("train", "val")))
    model, _ = m.fit_best_rounds(known, "target_score", {"maxIter": 60}, patience=20)
    path = scratch(spark, "pipeline")
    m.persist_model(with_learner(preparation, model), path)
    scored = stored(m.load_model(path).transform(rows).drop("features"))
    naive = train.agg(F.avg("target_score")).scalar()
    own = scored.filter(F.col("split") == "train").filter(F.col("primary_position") != last)
    errors = own.agg(F.avg(F.pow(F.col("prediction") - F.col("target_score"), 2)).alias("e"), F.avg(F.pow(naive - F.col("target_score"), 2)).alias("n"))
    better = errors.select((F.col("e") < F.col("n") * 0.999)).scalar()
    return scored.select("event_id", "primary_position_enc", F.col("prediction").isNotNull().alias("scored"), better.alias("better_than_mean"))


LOGGED = ", ".join(
    f"('depth {d}', '{kind}', '{name}')"
    for d in (4, 6)
    for kind, name in (("param", "maxDepth"), *(("metric", f"{x}_mae") for x in ("train", "val", "test")))
)


@register("logged_runs", f"SELECT run_name, kind, name FROM (VALUES {LOGGED}) AS t(run_name, kind, name)")
def logged_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The entries of the runs table after two runs of different depth."""
    rows, path = model_rows(spark, sf), scratch(spark, "runs")
    for depth in (4, 6):
        params = {"maxDepth": depth}
        scored = m.predict(m.fit_score_model(rows, FEATURES, "target_score", params), rows, FEATURES)
        errors = m.split_metrics(scored, "target_score", "prediction").collect()
        metrics = {f"{r.split}_mae": round(r.mae, 6) for r in errors}
        m.log_run(spark, path, f"depth {depth}", params, metrics)
    return table_at(spark, path).select("run_name", "kind", "name")
