"""Lag, rolling, trend and target features inside one (entity, season).

Every feature family says which neighbour rows and frames it needs and how its
columns follow from them. ``add_features`` joins any number of families into one
window pass, so all of them together cost one shuffle and one sort, and takes
each neighbour once however many features use it. A rolling value is null until
its frame holds ``n`` non-null values, not ``n`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelworks.functions.scalars import action_sum
from panelworks.operators.layout import (
    CHUNK,
    HALO,
    Layout,
    apply_windows,
    attach,
    hot_groups,
    null_safe_join,
    running_before,
    split_groups,
)
from panelworks.panel import Panel

# The action columns whose unweighted sum is the action score.
ACTION_SCORE_COLUMNS = [
    "TR", "TA", "GO", "FG", "TB", "MT", "FD", "OL", "IO",
    "LB", "LA", "IT", "PC", "ER", "HG", "HU", "KB", "SS",
    "TS", "LT", "MG", "MF", "H8",
]

# The per-round statistics that become lagged features.
ACTION_STAT_COLUMNS = [
    "TR", "TS", "LT", "GO", "MG", "FG", "MF", "TA", "MT",
    "TB", "FD", "OL", "IO", "LB", "LA", "FT", "KB", "H8",
    "HU", "HG", "IT", "KD", "PC", "ER", "SS",
    "mins", "bppm", "cv",
]


class Neighbours:
    """The window columns of one pass, each computed once under its own name."""

    def __init__(self) -> None:
        self.wanted: dict[str, Callable[[WindowSpec], Column]] = {}

    def back(self, col: str, n: int) -> Column:
        """Value ``n`` rows back; ahead if negative."""
        if n == 0:
            return F.col(col)
        return self.frame(f"_back_{n}_{col}", lambda w: F.lag(col, n).over(w))

    def frame(self, name: str, column: Callable[[WindowSpec], Column]) -> Column:
        self.wanted.setdefault(name, column)
        return F.col(name)

    def columns(self, window: WindowSpec) -> list[Column]:
        return [column(window).alias(name) for name, column in self.wanted.items()]


@dataclass(frozen=True)
class Features:
    """A family of feature columns and how far its frames reach."""

    build: Callable[[Neighbours], Sequence[Column]]
    before: int = 0
    after: int = 0


def mean_of_last(near: Neighbours, col: str, n: int, skip: int = 0) -> Column:
    """Mean of ``n`` rows, the newest of them ``skip`` rows back; null if any is.

    A frame as long as the number of values it needs has a value only where all
    its rows have one. Adding the neighbours says the same and is cheaper than
    going through the frame again for every row.
    """
    values = [near.back(col, i).cast("double") for i in range(skip, skip + n)]
    return reduce(lambda a, b: a + b, values) / n


def framed_mean(near: Neighbours, col: str, n: int, skip: int = 0) -> Column:
    """The same mean from a frame; cheaper where many columns share few frames."""

    def mean(window: WindowSpec) -> Column:
        frame = window.rowsBetween(1 - n - skip, -skip)
        average = F.avg(F.col(col).cast("double")).over(frame)
        return F.when(F.count(col).over(frame) >= n, average)

    return near.frame(f"_mean_{n}_{skip}_{col}", mean)


def add_features(
    df: DataFrame,
    panel: Panel,
    families: Sequence[Features],
    order: Sequence[str] | None = None,
    hot_rows: int | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """Evaluate all families in one pass over (entity, season) in sequence order."""
    near = Neighbours()
    features = [column for family in families for column in family.build(near)]
    wide = apply_windows(
        df,
        panel.keys,
        list(order or panel.seq),
        near.columns,
        before=max((f.before for f in families), default=0),
        after=max((f.after for f in families), default=0),
        hot_rows=hot_rows,
        layout=layout,
    )
    return wide.select(*df.columns, *features)


# --- families -----------------------------------------------------------------


def lags(col: str, offsets: Sequence[int], name: str) -> Features:
    """``name`` + ``_lag_n`` for each offset."""
    return Features(
        lambda near: [near.back(col, n).alias(f"{name}_lag_{n}") for n in offsets],
        before=max(offsets),
    )


def rolling_mean(col: str, n: int, name: str) -> Features:
    """Mean of the last ``n`` rows including the current one."""
    return Features(lambda near: [mean_of_last(near, col, n).alias(name)], before=n - 1)


def rolling_std(col: str, n: int, name: str) -> Features:
    """Sample standard deviation of the last ``n`` rows including the current one."""

    def build(near: Neighbours) -> list[Column]:
        deviation = F.stddev_samp(F.col(col).cast("double"))
        framed = near.frame(f"_std_{n}_{col}", lambda w: deviation.over(w.rowsBetween(1 - n, 0)))
        return [F.when(mean_of_last(near, col, n).isNotNull(), framed).alias(name)]

    return Features(build, before=n - 1)


def form_trend(col: str, n: int = 3, name: str = "form_trend") -> Features:
    """Mean of the last ``n`` rows minus the mean of the ``n`` rows before those."""
    return Features(
        lambda near: [(mean_of_last(near, col, n) - mean_of_last(near, col, n, n)).alias(name)],
        before=2 * n - 1,
    )


def average_to_date(col: str, n: int = 27, name: str = "season_avg_to_date") -> Features:
    """Mean of up to ``n`` earlier rows; null only where none has a value."""
    mean = F.avg(F.col(col).cast("double"))
    return Features(
        lambda near: [near.frame(f"_mean_{n}_{col}", lambda w: mean.over(w.rowsBetween(-n, -1))).alias(name)],
        before=n,
    )


def beaten_count(col: str, n: int = 3, name: str = "consecutive_be_beaten") -> Features:
    """How many of the last ``n`` earlier rows were above 0; null if any is null."""

    def build(near: Neighbours) -> list[Column]:
        above = [(near.back(col, i) > 0).cast("int") for i in range(1, n + 1)]
        return [reduce(lambda a, b: a + b, above).alias(name)]

    return Features(build, before=n)


def lead(col: str, name: str) -> Features:
    """Value of the next row."""
    return Features(lambda near: [near.back(col, -1).alias(name)], after=1)


def lagged_stats(cols: Sequence[str]) -> Features:
    """Last value, and the mean of the 3 and 5 earlier rows, for each column."""

    def build(near: Neighbours) -> list[Column]:
        return (
            [near.back(c, 1).alias(f"{c}_lag_1") for c in cols]
            + [framed_mean(near, c, 3, 1).alias(f"{c}_roll_avg_3") for c in cols]
            + [framed_mean(near, c, 5, 1).alias(f"{c}_roll_avg_5") for c in cols]
        )

    return Features(build, before=5)


def score_lags(panel: Panel) -> list[Features]:
    return [
        lags(panel.score, (1, 2, 3), "score"),
        lags(panel.price_change, (1, 2), "price_change"),
    ]


def score_rolling(panel: Panel) -> list[Features]:
    return [
        rolling_mean(panel.score, 3, "rolling_avg_3"),
        rolling_mean(panel.score, 5, "rolling_avg_5"),
        rolling_std(panel.score, 3, "rolling_std_3"),
        rolling_std(panel.score, 5, "rolling_std_5"),
        rolling_mean(panel.price_change, 3, "price_momentum_3"),
    ]


def action_score(name: str = "action_score") -> list[Features]:
    return [
        lags(name, (1,), name),
        rolling_mean(name, 3, f"{name}_rolling_3"),
        rolling_mean(name, 5, f"{name}_rolling_5"),
    ]


def break_even(name: str = "be_gap") -> list[Features]:
    return [rolling_mean(name, 3, "avg_be_gap_3rd"), lags(name, (1,), name), beaten_count(name)]


# --- operators ----------------------------------------------------------------


def with_action_score(df: DataFrame, name: str = "action_score") -> DataFrame:
    return df.withColumn(name, action_sum(df, ACTION_SCORE_COLUMNS))


def with_break_even_gap(df: DataFrame, panel: Panel, name: str = "be_gap") -> DataFrame:
    return df.withColumn(name, F.col(panel.score) - F.col(panel.break_even))


def add_lags(df: DataFrame, panel: Panel = Panel(), hot_rows: int | None = None) -> DataFrame:
    """Score 1, 2 and 3 rows back, price change 1 and 2 rows back."""
    return add_features(df, panel, score_lags(panel), hot_rows=hot_rows)


def add_rolling(df: DataFrame, panel: Panel = Panel(), hot_rows: int | None = None) -> DataFrame:
    """Rolling means and deviations of the score, rolling mean of the price change."""
    return add_features(df, panel, score_rolling(panel), hot_rows=hot_rows)


def add_action_score(
    df: DataFrame, panel: Panel = Panel(), hot_rows: int | None = None
) -> DataFrame:
    """Sum of the action columns, its last value and its rolling means."""
    return add_features(with_action_score(df), panel, action_score(), hot_rows=hot_rows)


def add_form_trend(df: DataFrame, panel: Panel = Panel(), hot_rows: int | None = None) -> DataFrame:
    return add_features(df, panel, [form_trend(panel.score)], hot_rows=hot_rows)


def add_average_to_date(
    df: DataFrame, panel: Panel = Panel(), hot_rows: int | None = None
) -> DataFrame:
    return add_features(df, panel, [average_to_date(panel.score)], hot_rows=hot_rows)


def add_break_even(df: DataFrame, panel: Panel = Panel(), hot_rows: int | None = None) -> DataFrame:
    """Gap to the break-even score, its rolling mean, last value and beaten count."""
    return add_features(with_break_even_gap(df, panel), panel, break_even(), hot_rows=hot_rows)


def add_lagged_stats(
    df: DataFrame,
    panel: Panel = Panel(),
    cols: Sequence[str] = ACTION_STAT_COLUMNS,
    order: Sequence[str] | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Lagged value and lagged rolling means of every listed column that exists.

    ``order`` defaults to the panel sequence. Passing (opponent, *seq) gives the
    opponent-sorted variant.
    """
    present = [c for c in cols if c in df.columns]
    return add_features(df, panel, [lagged_stats(present)], order=order, hot_rows=hot_rows)


def lead_target(
    df: DataFrame,
    panel: Panel = Panel(),
    min_mins: int = 5,
    name: str = "target_score",
    hot_rows: int | None = None,
) -> DataFrame:
    """Next row's score in the season; rows without one go, then rows with few minutes."""
    return (
        add_features(df, panel, [lead(panel.score, name)], hot_rows=hot_rows)
        .filter(F.col(name).isNotNull())
        .filter(F.col(panel.mins) >= min_mins)
    )


def add_prior_encounters(
    df: DataFrame, panel: Panel = Panel(), hot_rows: int | None = None, layout: Layout | None = None
) -> DataFrame:
    """Number and mean of earlier scores against the same opponent.

    The mean is null where the previous encounter has no score.
    """
    counted = running_before(
        df,
        [*panel.entity, panel.opponent],
        panel.timeline,
        panel.score,
        sum_as="_sum_vs",
        count_as="games_vs_opponent",
        previous_as="_previous_vs",
        hot_rows=hot_rows,
        layout=layout,
    )
    mean = F.try_divide(F.col("_sum_vs").cast("double"), F.col("games_vs_opponent"))
    return counted.withColumn(
        "player_vs_opponent_avg", F.when(F.col("_previous_vs").isNotNull(), mean)
    ).drop("_sum_vs", "_previous_vs")


def blend_with_career(
    df: DataFrame, threshold: int = 5, name: str = "matchup_adjusted_avg"
) -> DataFrame:
    """Shrink the matchup mean towards the career mean while encounters are few."""
    weight = F.least(F.col("games_vs_opponent").cast("double") / threshold, F.lit(1.0))
    blended = weight * F.col("player_vs_opponent_avg") + (1 - weight) * F.col("career_avg")
    return df.withColumn(
        name, F.when(F.col("games_vs_opponent") == 0, F.col("career_avg")).otherwise(blended)
    )


def add_career_avg_as_of(
    df: DataFrame, panel: Panel = Panel(), hot_rows: int | None = None, layout: Layout | None = None
) -> DataFrame:
    """Career mean from earlier rows only."""
    counted = running_before(
        df,
        list(panel.entity),
        panel.timeline,
        panel.score,
        sum_as="_sum",
        count_as="_count",
        hot_rows=hot_rows,
        layout=layout,
    )
    mean = F.try_divide(F.col("_sum").cast("double"), F.col("_count"))
    return counted.withColumn("career_avg", mean).drop("_sum", "_count")


def add_average_ranks(
    df: DataFrame,
    by: Sequence[str],
    names: Mapping[str, str],
    counted_on: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Ascending rank of each column in the group; ties share the mean rank, null stays null.

    One window pass ranks all columns. If a group is hot, its rows are counted
    per distinct value instead, and the rank follows from the number of rows with
    a smaller value. ``counted_on`` is a cheaper frame with the same groups.
    """
    if hot_groups(df if counted_on is None else counted_on, by, hot_rows) is not None:
        for col, name in names.items():
            ranked = _ranked_values(df, by, col, name, hot_rows)
            df = attach(df, ranked, [*by, col], null_safe=True)
        return df

    def mean_rank(col: str) -> Column:
        window = Window.partitionBy(*by).orderBy(F.col(col).asc_nulls_last())
        ties = F.count(F.lit(1)).over(window.rangeBetween(Window.currentRow, Window.currentRow))
        return F.when(F.col(col).isNotNull(), F.rank().over(window) + (ties - 1) / 2)

    return df.select("*", *[mean_rank(col).alias(name) for col, name in names.items()])


def _ranked_values(
    df: DataFrame, by: Sequence[str], col: str, name: str, hot_rows: int | None
) -> DataFrame:
    """Distinct values with their mean rank."""
    values = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_before(values, by, [col], "_n", sum_as="_smaller", hot_rows=hot_rows)
    rank = F.coalesce("_smaller", F.lit(0)) + (F.col("_n") + 1) / 2
    return ranked.select(*by, col, rank.alias(name))


def add_price_ranks(
    df: DataFrame, panel: Panel = Panel(), hot_rows: int | None = None
) -> DataFrame:
    """Mean-tie ranks of price and score within season, round and position."""
    by = [*panel.season, panel.round, panel.position]
    names = {panel.price: "price_rank_in_position", panel.score: "score_rank_in_position"}
    return add_average_ranks(df, by, names, hot_rows=hot_rows)


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    col: str,
    name: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """Last non-null value of ``col`` up to and including the current row.

    In a split group the value may come from an earlier chunk; it is then the
    last one of the nearest chunk that has any.
    """
    hot = hot_groups(df, keys, hot_rows)
    if hot is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.last(col, ignorenulls=True).over(window))
    split = split_groups(df, keys, order, hot)
    inside = Window.partitionBy(*split.chunk_keys).orderBy(*order)
    rows = split.with_halo(0, 0).withColumn(
        name, F.last(col, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    chunks = split.hot.groupBy(*split.chunk_keys).agg(
        F.max_by(F.col(col), F.when(F.col(col).isNotNull(), F.struct(*order))).alias("_last")
    )
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    earlier = chunks.select(*split.chunk_keys, F.last("_last", ignorenulls=True).over(before).alias("_before"))
    joined = null_safe_join(rows, earlier, split.chunk_keys, "left")
    return joined.withColumn(name, F.coalesce(name, "_before")).drop(CHUNK, HALO, "_before")
