"""Splitting hot groups must not change a single value."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelworks import Panel
from panelworks.operators import aggregates as a
from panelworks.operators import features as f
from panelworks.operators import layout
from panelworks.operators import windows as w

PANEL = Panel(seq=("round", "id"))


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows belong to one player, some to a null player."""
    pick = random.Random(7)
    rows = []
    for i in range(240):
        player = "hot" if i % 2 else pick.choice(["a", "b", "c", None])
        score = pick.choice([None, *range(0, 60, 3)])
        rows.append(
            (i, player, 2024, pick.randrange(30), score, pick.randrange(50), pick.randrange(5) * 100,
             pick.randrange(80), pick.choice(["X", "Y"]), "HOK")
        )
    schema = (
        "id int, player_name string, year bigint, round int, score int, break_even int, price bigint, "
        "mins int, opponent string, primary_position string"
    )
    return spark.createDataFrame(rows, schema).withColumn("round_price_change", F.col("price") - 200).cache()


OPERATIONS = {
    "lags": lambda df, h: w.add_lags(df, PANEL, hot_rows=h),
    "rolling": lambda df, h: w.add_rolling(df, PANEL, hot_rows=h),
    "trend": lambda df, h: w.add_form_trend(df, PANEL, hot_rows=h),
    "to date": lambda df, h: w.add_average_to_date(df, PANEL, hot_rows=h),
    "break even": lambda df, h: w.add_break_even(df, PANEL, hot_rows=h),
    "target": lambda df, h: w.lead_target(df, PANEL, hot_rows=h),
    "encounters": lambda df, h: w.add_prior_encounters(df, PANEL, hot_rows=h),
    "career as of": lambda df, h: w.add_career_avg_as_of(df, PANEL, hot_rows=h),
    "strength as of": lambda df, h: a.add_opponent_strength(df, PANEL, expanding=True, hot_rows=h),
    "ranks": lambda df, h: w.add_average_ranks(
        df, ["year", "primary_position"], {"price": "p", "score": "s"}, hot_rows=h
    ),
    "carry forward": lambda df, h: w.carry_forward(
        df.withColumn("c", F.when(F.col("id") % 5 == 0, F.col("score"))),
        ["player_name"], ["round", "id"], "c", "carried", hot_rows=h,
    ),
    "joined text": lambda df, h: a.joined_text(
        df.withColumn("t", F.concat(F.lit("t"), "id")), ["player_name"], "t", ["id"], "id", hot_rows=h
    ),
    "codes": lambda df, h: f.vocabulary(
        df.withColumn("c", F.col("id").cast("string")), ["c", "opponent"], hot_rows=h
    ).select(F.struct("column", "value").alias("id"), "code"),
    "medians": lambda df, h: f.exact_medians(df, ["score", "price", "id"], hot_rows=h).select(
        F.col("column").alias("id"), "median"
    ),
}


@pytest.mark.parametrize("limit", [7, 60])
@pytest.mark.parametrize("name", OPERATIONS)
def test_split_groups_give_the_same_values(spark, skewed, name, limit):
    op = OPERATIONS[name]
    plain, split = op(skewed, None), op(skewed, limit)
    assert sorted(plain.columns) == sorted(split.columns)

    def table(df):
        cols = sorted(plain.columns)
        return sorted(
            [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()],
            key=repr,
        )

    assert table(plain) == table(split)


def test_no_task_gets_a_whole_hot_group(spark, skewed):
    """The chunks of the split window stay near the limit."""
    limit = 20
    hot = layout.hot_groups(skewed, ["player_name"], limit)
    split = layout.split_groups(skewed, ["player_name"], ["round", "id"], hot)
    sizes = split.hot.groupBy(*split.chunk_keys).count().agg(F.max("count")).first()[0]
    assert sizes <= 2 * limit
    assert split.hot.count() + split.cold.count() == skewed.count()


def test_frames_reach_over_several_small_chunks(spark):
    """A frame of 27 rows over chunks of about one row each."""
    df = spark.range(60).selectExpr("'p' as k", "id", "id * id as v")
    build = lambda win: [F.sum("v").over(win.rowsBetween(-27, 3)).alias("s")]
    plain = df.select("*", *build(Window.partitionBy("k").orderBy("id")))
    split = layout.apply_windows(df, ["k"], ["id"], build, before=27, after=3, hot_rows=2)
    assert sorted(plain.collect()) == sorted(split.select(*plain.columns).collect())


def test_few_groups_need_one_shuffle(spark, skewed):
    plan = w.add_features(
        skewed,
        PANEL,
        [*w.score_lags(PANEL), *w.score_rolling(PANEL), w.form_trend("score"), w.average_to_date("score")],
    )
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_lookups_are_broadcast_by_their_stored_bytes(spark):
    """No hint: the planner sees the bytes of the stored lookup and its own threshold."""
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    lookup = spark.range(7).select(F.col("id").alias("v"), (F.col("id") * 2).alias("w"))
    joined = layout.attach(df, lookup, ["v"])
    logical = joined._jdf.queryExecution().logical().toString().lower()
    assert "resolvedhint" not in logical
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
        large = layout.attach(df, lookup, ["v"])
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_hot_limit_is_in_bytes(spark):
    narrow, wide = spark.range(1), spark.range(1).selectExpr("id", *[f"'x' as c{i}" for i in range(63)])
    assert layout.hot_rows_limit(narrow, None) == layout.HOT_BYTES // 8
    assert layout.hot_rows_limit(wide, None) == layout.HOT_BYTES // (8 + 63 * 32)


def test_a_hot_join_key_is_split_by_adaptive_execution(spark):
    """A lookup too large to broadcast divides the partition of a hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(0, 60000, 1, 12).selectExpr(
            "if(id % 3 = 0, 'hot', concat('p', id % 500)) as player_name", "id as score", "id"
        )
        joined = a.add_career_avg(df, Panel())
        assert joined.count() == 60000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


LAID_OUT = {
    "encounters": lambda df, lay: w.add_prior_encounters(df, PANEL, layout=lay),
    "career as of": lambda df, lay: w.add_career_avg_as_of(df, PANEL, layout=lay),
    "lags": lambda df, lay: w.add_features(df, PANEL, w.score_lags(PANEL), layout=lay),
    "target": lambda df, lay: w.add_features(df, PANEL, [w.lead("score", "target")], layout=lay),
    "trend": lambda df, lay: w.add_features(
        df, PANEL, [*w.score_rolling(PANEL), w.form_trend("score"), w.average_to_date("score")], layout=lay
    ),
}


@pytest.mark.parametrize("limit", [7, 60])
@pytest.mark.parametrize("seasons", [1, 3])
def test_one_layout_serves_windows_of_several_keys(spark, skewed, limit, seasons):
    """Every operator alone and all in a row, on one cut along the timeline, as on the plain rows."""
    df = skewed.withColumn("year", F.when(F.col("id") % 7 != 0, 2020 + F.col("id") % seasons))
    hot = layout.hot_groups(df, ["player_name"], limit)
    lay = layout.lay_out(df, ["player_name"], ["year", "round", "id"], hot)
    laid = lay.rows()
    assert laid.filter(F.col(layout.CHUNK) >= 0).select(layout.CHUNK).distinct().count() > 1

    def table(df, cols):
        rows = df.select(*cols).collect()
        return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows], key=repr)

    plain_all, laid_all = df, laid
    for op in LAID_OUT.values():
        plain, split = op(df, None), op(laid, lay).drop(layout.CHUNK)
        assert sorted(plain.columns) == sorted(split.columns)
        assert table(plain, plain.columns) == table(split, plain.columns)
        plain_all, laid_all = op(plain_all, None), op(laid_all, lay)
    assert table(plain_all, plain_all.columns) == table(laid_all, plain_all.columns)


def test_many_small_hot_groups_need_few_tasks(spark):
    """Chunks follow the limit, tasks the bytes; rows of equal order stay together."""
    df = spark.range(2400).selectExpr("id div 12 as k", "id % 12 div 2 as o", "id")
    hot = layout.hot_groups(df, ["k"], 4)
    split = layout.split_groups(df, ["k"], ["o"], hot)
    assert (hot.groups, split.cold.count(), split.hot.count()) == (200, 0, 2400)
    assert split.hot.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = split.hot.groupBy(*split.chunk_keys).count()
    assert sizes.count() >= 1200 and sizes.agg(F.max("count")).first()[0] == 2
    assert split.hot.groupBy("k", "o").agg(F.count_distinct(layout.CHUNK).alias("n")).filter("n > 1").count() == 0
    # a chunk is a range of the order
    ends = split.hot.groupBy(*split.chunk_keys).agg(F.min("o").alias("a"), F.max("o").alias("b"))
    before = Window.partitionBy("k").orderBy(layout.CHUNK)
    assert ends.withColumn("p", F.lag("b").over(before)).filter("p >= a").count() == 0
