"""Expert insights: replies to the sentiment table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelworks.operators.aggregates import aggregate_insights
from panelworks.sources.articles import parse_insight_reply, with_body
from panelworks.sources.tables import read_table, write_table


def insight_weights(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sentiment per player from (url, body, reply) rows, and the unreadable replies."""
    records, rejects = parse_insight_reply(with_body(replies).select("url", "reply"))
    return aggregate_insights(records, ["source_url", "item_no"]), rejects


def run_insights(spark: SparkSession, replies_path: str, path: str, rejects_path: str) -> None:
    weights, rejects = insight_weights(read_table(spark, replies_path))
    write_table(weights, path)
    write_table(rejects, rejects_path)
