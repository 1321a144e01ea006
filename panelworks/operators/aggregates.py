"""Grouped summaries. All of them combine partial results before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelworks.operators.layout import (
    CHUNK,
    attach,
    hot_groups,
    null_safe_join,
    running_before,
    split_groups,
)
from panelworks.panel import Panel


def last_by(
    df: DataFrame, keys: Sequence[str], cols: Mapping[str, str] | Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Values of the last row per key, nulls included. ``cols`` may rename."""
    named = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    last = F.max_by(
        F.struct(*[F.col(c).alias(out) for c, out in named.items()]), F.struct(*order)
    )
    return (
        df.groupBy(*keys)
        .agg(last.alias("_last"))
        .select(*keys, *[F.col(f"_last.{out}").alias(out) for out in named.values()])
    )


def mean_score(df: DataFrame, keys: Sequence[str], score: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.col(score).cast("double")).alias(name))


def add_career_avg(df: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Mean score of the entity over all rows, on every row."""
    means = mean_score(df, panel.entity, panel.score, "career_avg")
    return attach(df, means, panel.entity)


def career_stats(df: DataFrame, panel: Panel = Panel()) -> DataFrame:
    score = F.col(panel.score).cast("double")
    return df.groupBy(*panel.entity).agg(
        F.avg(score).alias("career_avg"),
        F.stddev_samp(score).alias("career_std"),
        F.avg(F.col(panel.mins).cast("double")).alias("career_avg_mins"),
        F.count(panel.score).alias("career_games"),
    )


def latest_rolling_mean(df: DataFrame, panel: Panel, col: str, rows: int, name: str) -> DataFrame:
    """The rolling mean of ``rows`` rows at the last row of each entity, null with fewer values.

    Only the last rows of an entity can count, and that limit is applied in each map task; the
    frame ends at the season of the last row.
    """
    latest = Window.partitionBy(*panel.entity).orderBy(*[F.col(c).desc() for c in panel.timeline])
    few = df.withColumn("_place", F.row_number().over(latest)).filter(F.col("_place") <= rows)
    value = F.col(col).cast("double")
    mean = F.when(F.count(value) >= rows, F.avg(value)).alias("_mean")
    by_season = few.groupBy(*panel.entity, *panel.season).agg(mean)
    return by_season.groupBy(*panel.entity).agg(
        F.max_by(F.struct("_mean"), F.struct(*panel.season))["_mean"].alias(name)
    )


def recent_form(df: DataFrame, season: int, panel: Panel = Panel()) -> DataFrame:
    """Means over the last rows of one season, and its last round and position.

    The rank filter is pushed below the shuffle, so each task forwards at most
    five rows per entity.
    """
    window = Window.partitionBy(*panel.entity).orderBy(*[F.col(c).desc() for c in panel.seq])
    tail = (
        df.filter(F.col(panel.season[0]) == season)
        .select(
            *dict.fromkeys(
                [*panel.entity, *panel.seq, panel.round, panel.score, panel.mins, panel.position]
            )
        )
        .withColumn("_back", F.row_number().over(window))
        .filter(F.col("_back") <= 5)
    )

    def tail_mean(col: str, n: int) -> Column:
        return F.avg(F.when(F.col("_back") <= n, F.col(col).cast("double")))

    return tail.groupBy(*panel.entity).agg(
        tail_mean(panel.score, 5).alias("last5_avg"),
        tail_mean(panel.score, 3).alias("last3_avg"),
        tail_mean(panel.mins, 3).alias("last3_avg_mins"),
        F.max(panel.round).alias("last_round_played"),
        F.max(F.when(F.col("_back") == 1, F.col(panel.position))).alias("primary_position"),
    )


def opponent_strength(df: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Mean lagged score per (opponent, position).

    Lagging inside the group drops its last row and nothing else, so the mean
    follows from the sum, the count and the last score. No window is needed and
    a group of any size is combined map-side.
    """
    score = F.col(panel.score).cast("double")
    order = F.struct(*panel.timeline, *panel.entity)
    grouped = df.groupBy(panel.opponent, panel.position).agg(
        F.sum(score).alias("_sum"),
        F.count(score).alias("_count"),
        F.max_by(F.struct(score.alias("s")), order).alias("_last"),
    )
    last = F.col("_last.s")
    mean = F.try_divide(
        F.col("_sum") - F.coalesce(last, F.lit(0.0)), F.col("_count") - last.isNotNull().cast("int")
    )
    return grouped.select(panel.opponent, panel.position, mean.alias("opponent_avg_pts_allowed"))


def add_opponent_strength(
    df: DataFrame, panel: Panel = Panel(), expanding: bool = False, hot_rows: int | None = None
) -> DataFrame:
    """Points allowed per opponent and position; ``expanding`` uses earlier rows only."""
    df = df.drop("opponent_avg_pts_allowed")
    keys = [panel.opponent, panel.position]
    if not expanding:
        return attach(df, opponent_strength(df, panel), keys)
    counted = running_before(
        df,
        keys,
        [*panel.timeline, *panel.entity],
        panel.score,
        sum_as="_sum",
        count_as="_count",
        hot_rows=hot_rows,
    )
    mean = F.try_divide(F.col("_sum").cast("double"), F.col("_count"))
    return counted.withColumn("opponent_avg_pts_allowed", mean).drop("_sum", "_count")


def joined_text(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    order: Sequence[str],
    name: str,
    sep: str = ", ",
    hot_rows: int | None = None,
) -> DataFrame:
    """Join the texts of each key in order. Hot keys are first joined per chunk."""

    def joined(rows: DataFrame, by: Sequence[str], value: str, ordered: Sequence[str]) -> DataFrame:
        items = F.sort_array(F.collect_list(F.struct(*ordered, F.col(value).alias("_text"))))
        return rows.groupBy(*by).agg(F.array_join(items.getField("_text"), sep).alias(name))

    slim = df.select(*dict.fromkeys([*keys, *order, col])).filter(F.col(col).isNotNull())
    hot = hot_groups(slim, keys, hot_rows)
    if hot is None:
        return joined(slim, keys, col, order)
    split = split_groups(slim, keys, order, hot)
    parts = joined(split.hot, split.chunk_keys, col, order)
    return joined(split.cold, keys, col, order).unionByName(joined(parts, keys, name, [CHUNK]))


def source_rows(
    df: DataFrame, keys: Sequence[str], col: str, order: Sequence[str], hot_rows: int | None = None
) -> DataFrame:
    """(keys, no, text): the texts of each key as numbered rows, for keys of any size."""
    slim = df.select(*dict.fromkeys([*keys, *order, col])).filter(F.col(col).isNotNull())
    counted = running_before(
        slim.withColumn("_one", F.lit(1)), keys, order, "_one", sum_as="_before", hot_rows=hot_rows
    )
    number = (F.coalesce(F.col("_before"), F.lit(0)) + 1).cast("bigint")
    return counted.select(*keys, number.alias("no"), col)


def aggregate_insights(
    records: DataFrame, order: Sequence[str], hot_rows: int | None = None
) -> DataFrame:
    """One row per player: last facts, mean sentiment, most bullish advice, sources.

    ``sources`` is one text for a listing; ``source_rows`` gives the sources of players with any number of them.
    """
    position = F.struct(*order)
    strongest = F.struct(F.col("sentiment_score"), position)
    grouped = records.groupBy("player_name").agg(
        F.max_by(F.struct("team", "position", "key_insight"), position).alias("_last"),
        F.round(F.avg(F.col("sentiment_score").cast("double")), 3).alias("sentiment_score"),
        F.round(F.avg(F.col("confidence").cast("double")), 3).alias("confidence"),
        F.max_by(F.struct("recommendation"), strongest).alias("_best"),
    )
    sources = joined_text(records, ["player_name"], "source_url", order, "sources", hot_rows=hot_rows)
    facts = grouped.select(
        "player_name",
        "_last.team",
        "_last.position",
        "sentiment_score",
        "confidence",
        "_best.recommendation",
        "_last.key_insight",
    )
    return null_safe_join(facts, sources, ["player_name"], "left")


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def count_distinct(df: DataFrame, col: str, name: str) -> DataFrame:
    """Exact number of distinct values, null counted as one, from a distinct first."""
    return df.select(col).distinct().agg(F.count(F.lit(1)).alias(name))


def profile(df: DataFrame, nulls: Sequence[str] = (), flags: Sequence[str] = ()) -> DataFrame:
    """Rows, null counts and true counts in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in nulls],
        *[F.count_if(F.col(c)).alias(f"{c}_true") for c in flags],
    )


def cluster_profile(
    states: DataFrame, cols: Sequence[str] = ("price", "score", "be_gap"), by: str = "cluster"
) -> DataFrame:
    return states.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col(c).cast("double")).alias(f"avg_{c}") for c in cols],
    )


def _errors(actual: str, predicted: Column) -> list[Column]:
    gap = F.col(actual).cast("double") - predicted.cast("double")
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(gap)).alias("mae"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
    ]


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: str | None = None, min_rows: int = 10
) -> DataFrame:
    """MAE and RMSE, overall or per group with at least ``min_rows`` rows."""
    errors = _errors(actual, F.col(predicted))
    if by is None:
        return df.agg(*errors)
    grouped = df.filter(F.col(by).isNotNull()).groupBy(by).agg(*errors)
    return grouped.filter(F.col("n") >= min_rows)


def baseline_metrics(df: DataFrame, actual: str, baselines: Sequence[str]) -> DataFrame:
    """Errors of naive predictions, null counted as 0; one row per baseline, one scan."""
    named = [
        F.struct(
            F.lit(c).alias("baseline"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("p")
        )
        for c in baselines
    ]
    long = df.select(actual, F.explode(F.array(*named)).alias("_b")).select(actual, "_b.*")
    return long.groupBy("baseline").agg(*_errors(actual, F.col("p")))


def roster_totals(roster: DataFrame, cap: int, price: str, score: str) -> DataFrame:
    return roster.agg(
        F.count(F.lit(1)).alias("players"),
        F.sum(price).alias("total_price"),
        (F.lit(cap) - F.sum(price)).alias("remaining"),
        F.sum(score).alias("total_score"),
    )
