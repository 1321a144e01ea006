"""Match context from season feeds and match pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelworks.sources.feeds import (
    FIXTURES_SCHEMA,
    WEATHER_LABELS,
    feed_context,
    fixtures_from_json,
    page_context,
    unreadable_feeds,
)
from panelworks.sources.markup import embedded_json, labelled_values
from panelworks.sources.tables import table_if_there, union_drift, write_table


def match_context(
    feeds: DataFrame | None, fixtures: DataFrame | None, pages: DataFrame | None
) -> DataFrame:
    """Context of all seasons.

    ``feeds`` holds (year, raw JSON); ``pages`` holds (match_centre_url, html) of
    the matches listed in ``fixtures``.
    """
    parts = []
    if feeds is not None:
        parts.append(feed_context(feeds))
    if fixtures is not None and pages is not None:
        parts.append(page_context(fixtures, labelled_values(pages, WEATHER_LABELS)))
    return union_drift(parts)


def run_context(
    spark: SparkSession,
    feeds_path: str,
    fixtures_path: str,
    pages_path: str,
    path: str,
    rejected_path: str | None = None,
) -> bool:
    """Write the context of the inputs that are there; False if there are none.

    Feeds that cannot be read go to ``rejected_path``.
    """
    feeds, fixtures, pages = (table_if_there(spark, p) for p in (feeds_path, fixtures_path, pages_path))
    if feeds is not None and rejected_path is not None:
        write_table(unreadable_feeds(feeds), rejected_path)
    if feeds is None and (fixtures is None or pages is None):
        return False
    write_table(match_context(feeds, fixtures, pages), path, ["year"])
    return True


def run_fixtures(
    spark: SparkSession, pages_path: str, path: str, rejected_path: str, host: str = ""
) -> bool:
    """Draw pages (year, round, html) to the fixture table; False if there are none. ``host`` precedes the match paths.

    Pages whose data cannot be read go to ``rejected_path``.
    """
    pages = table_if_there(spark, pages_path)
    if pages is None:
        return False
    good, rejected = embedded_json(pages, FIXTURES_SCHEMA, "vue-draw", "q-data")
    write_table(fixtures_from_json(good, host), path)
    write_table(rejected, rejected_path)
    return True
