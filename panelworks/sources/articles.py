"""Commentary articles, the list of article URLs, and the insight replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.functions.scalars import col_of, strip

ARTICLE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("url", "title", "scraped_at", "body")]
)

INSIGHT_SCHEMA = T.StructType(
    [
        T.StructField("player_name", T.StringType()),
        T.StructField("team", T.StringType()),
        T.StructField("position", T.StringType()),
        T.StructField("sentiment_score", T.FloatType()),
        T.StructField("confidence", T.FloatType()),
        T.StructField("recommendation", T.StringType()),
        T.StructField("key_insight", T.StringType()),
    ]
)

_WORKLIST = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def with_body(articles: DataFrame) -> DataFrame:
    return articles.filter(F.col("body").isNotNull() & (F.col("body") != ""))


def read_articles(spark: SparkSession, folder: str) -> DataFrame:
    """JSON documents of a folder, without those that have no body."""
    files = spark.read.schema(ARTICLE_SCHEMA).option("multiLine", "true")
    return with_body(files.option("pathGlobFilter", "*.json").json(folder))


def worklist_urls(
    df: DataFrame, round_num: int, col: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """URLs a JSON worklist names for a round; none if the round is missing."""
    urls = F.try_element_at(F.from_json(col, _WORKLIST), F.lit(str(round_num)))
    return df.select(*keep, F.posexplode(urls).alias("url_no", "url"))


def read_worklist(spark: SparkSession, path: str, round_num: int) -> DataFrame:
    return worklist_urls(spark.read.text(path, wholetext=True), round_num)


def unfenced(reply: Column | str) -> Column:
    """Reply text without a code fence and its language tag."""
    text = strip(reply)
    inner = F.get(F.split(text, "```"), F.lit(1))
    return F.when(F.startswith(text, F.lit("```")), F.regexp_replace(inner, r"^json", "")).otherwise(
        text
    )


def parse_insight_reply(
    df: DataFrame, reply: str = "reply", url: str = "url"
) -> tuple[DataFrame, DataFrame]:
    """Insight rows of JSON replies with their source, and the unreadable replies."""
    text = unfenced(col_of(reply))
    parsed = df.withColumn("_items", _json_array(text))
    good = parsed.select(
        F.col(url).alias("source_url"), F.posexplode("_items").alias("item_no", "_item")
    ).select("_item.*", "source_url", "item_no")
    return good, parsed.filter(F.col("_items").isNull()).select(*df.columns)


def _json_array(text: Column) -> Column:
    """Parsed array, or null for anything that is not a JSON array of objects."""
    items = F.from_json(text, T.ArrayType(INSIGHT_SCHEMA), {"mode": "PERMISSIVE"})
    return F.when(F.json_array_length(text).isNotNull(), items)
