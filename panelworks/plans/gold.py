"""Silver panel to the gold feature table.

The narrow silver rows are ranked and joined with the lookups first. They are
then shuffled once by entity, and every window of an entity, by season or by
opponent, is evaluated on that one layout, so the many feature columns come into
being after the last shuffle. If one entity is too large for a task, the hot entities are
counted and cut into ranges of their timeline once, and all windows work on those ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelworks.functions.scalars import PLACE_CODES, TEAM_CODES, is_code, recode
from panelworks.operators import windows as w
from panelworks.operators.aggregates import add_opponent_strength, mean_score, opponent_strength
from panelworks.operators.joins import add_initial_price, add_match_context
from panelworks.operators.layout import CHUNK, UNCHECKED, Layout, attach, hot_groups, lay_out
from panelworks.panel import Panel
from panelworks.sources.tables import read_table, table_if_there, union_drift, write_table

ALL_TEAM_NAMES = {**TEAM_CODES, **PLACE_CODES}


def conform_context(context: DataFrame, names: dict[str, str] = ALL_TEAM_NAMES) -> DataFrame:
    """Context with team codes, without rows whose team has no code."""
    coded = context.withColumns(
        {"team": recode("team", names), "opponent": recode("opponent", names)}
    )
    return coded.filter(is_code("team"))


def with_row_values(df: DataFrame, panel: Panel) -> DataFrame:
    """What the windows take from a row beside its own columns."""
    return w.with_break_even_gap(w.with_action_score(df), panel)


def window_features(
    df: DataFrame, panel: Panel, hot_rows: int | None = None, layout: Layout | None = None
) -> DataFrame:
    """Every feature inside (entity, season), in one pass; ``df`` comes from ``with_row_values``."""
    stats = [c for c in w.ACTION_STAT_COLUMNS if c in df.columns]
    families = [
        *w.score_lags(panel),
        *w.action_score(),
        *w.score_rolling(panel),
        w.form_trend(panel.score),
        w.average_to_date(panel.score),
        *w.break_even(),
        w.lagged_stats(stats),
    ]
    return w.add_features(df, panel, families, hot_rows=hot_rows, layout=layout)


def gold_features(
    silver: DataFrame,
    context: DataFrame | None = None,
    panel: Panel = Panel(),
    point_in_time: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """The full feature table; ``point_in_time`` keeps later rounds out of the means.

    ``silver`` should be a stored table, since its groups and lookups are counted
    before the plan is built.
    """
    df = w.add_price_ranks(silver, panel, hot_rows)
    df = add_initial_price(df, panel)
    if context is not None:
        df = add_match_context(df, context, panel)
    if point_in_time:
        # on the narrow rows, before the features come into being
        df = add_opponent_strength(df, panel, expanding=True, hot_rows=hot_rows)
    else:
        df = attach(df, opponent_strength(silver, panel), [panel.opponent, panel.position])
    df = with_row_values(df, panel)
    hot, layout = hot_groups(silver, panel.entity, hot_rows), None
    if hot is None:
        # one shuffle by entity serves every window and join below
        df, hot_rows = df.repartition(*panel.entity), UNCHECKED
    else:
        layout = lay_out(df, panel.entity, panel.timeline, hot)
        df = layout.rows()
    if point_in_time:
        df = w.add_career_avg_as_of(df, panel, hot_rows, layout)
    else:
        careers = mean_score(silver, panel.entity, panel.score, "career_avg")
        df = attach(df, careers, panel.entity)
    df = w.blend_with_career(w.add_prior_encounters(df, panel, hot_rows, layout))
    df = window_features(df, panel, hot_rows, layout)
    return df if layout is None else df.drop(CHUNK)


def run_gold(
    spark: SparkSession, silver_path: str, context_paths: list[str], path: str, panel: Panel = Panel()
) -> None:
    found = [table_if_there(spark, p) for p in context_paths]
    contexts = [c for c in found if c is not None]
    context = conform_context(union_drift(contexts)) if contexts else None
    write_table(gold_features(read_table(spark, silver_path), context, panel), path, ["year"])
