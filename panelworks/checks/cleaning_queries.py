"""Cleaning steps on the bronze grid built from orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.checks.book import register
from panelworks.checks.panels import BZ, bronze_grid, rounded, table
from panelworks.functions.scalars import strip
from panelworks.operators import cleaning as c

STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def strip_sql(x: str) -> str:
    return STRIP.format(x=x)


@register(
    "numeric_ids",
    f"""WITH {BZ} SELECT year, count(*) AS n FROM bz WHERE regexp_full_match(id, '[0-9]+') GROUP BY year""",
)
def numeric_ids(spark: SparkSession, sf: str) -> DataFrame:
    kept = c.keep_numeric_id(bronze_grid(spark, sf))
    return kept.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@register(
    "without_totals",
    f"""WITH {BZ} SELECT id, "Rd" FROM bz WHERE "Rd" <> 'Totals' """,
)
def without_totals(spark: SparkSession, sf: str) -> DataFrame:
    return c.drop_totals(bronze_grid(spark, sf)).select("id", "Rd")


@register(
    "required_text",
    f"""WITH {BZ} SELECT "Posn", count(*) AS n FROM bz WHERE id <> '' AND "Posn" <> ''
    AND "Posn" <> 'Pos Pos' GROUP BY 1""",
)
def required_text(spark: SparkSession, sf: str) -> DataFrame:
    kept = c.require_text(bronze_grid(spark, sf), ["id", "Posn"], {"Posn": c.POSITION_DENY})
    return kept.groupBy("Posn").agg(F.count(F.lit(1)).alias("n"))


MONEY = "TRY_CAST(replace(replace({x}, '$', ''), ',', '') AS BIGINT)"


@register(
    "money_columns",
    f"""WITH {BZ} SELECT id, "Rd", "Price" AS raw, {MONEY.format(x='"Price"')} AS price,
    {MONEY.format(x='"RoundPriceChange"')} AS change FROM bz""",
)
def money_columns(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_grid(spark, sf).select(
        "id",
        "Rd",
        F.col("Price").alias("raw"),
        c.parse_money("Price", strict=True).alias("price"),
        c.parse_money("RoundPriceChange").alias("change"),
    )


# the whole-number cast of the comparison engine accepts '44.0', so it is guarded
TO_INT = r"CASE WHEN regexp_full_match({x}, '\s*[+-]?[0-9]+\s*') THEN TRY_CAST({x} AS INTEGER) END"


@register(
    "tolerant_casts",
    f"""WITH {BZ} SELECT id, "Price" AS raw, {TO_INT.format(x='"Score"')} AS score,
    {TO_INT.format(x='"Rd"')} AS round, CAST(TRY_CAST("AvgMins" AS FLOAT) AS DOUBLE) AS avg_mins FROM bz""",
)
def tolerant_casts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        bronze_grid(spark, sf).select(
            "id",
            F.col("Price").alias("raw"),
            c.cast_tolerant("Score", "int").alias("score"),
            c.cast_tolerant("Rd", "int").alias("round"),
            c.cast_tolerant("AvgMins", "float").alias("avg_mins"),
        )
    )


@register(
    "trimmed_text",
    f"""SELECT doc_id, {strip_sql('text')} AS text, length({strip_sql('text')}) AS chars FROM documents""",
)
def trimmed_text(spark: SparkSession, sf: str) -> DataFrame:
    trimmed = c.trim_columns(table(spark, sf, "documents").select("doc_id", "text"), ["text"])
    return trimmed.withColumn("chars", F.length("text").cast("bigint"))


@register(
    "first_occurrence_replaced",
    """SELECT doc_id, CASE WHEN strpos(text, 'th') > 0 THEN substring(text, 1, strpos(text, 'th') - 1)
    || 't_h' || substring(text, strpos(text, 'th') + 2) ELSE text END AS text FROM documents""",
)
def first_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", c.replace_first("text", "th", "t_h").alias("text")
    )


@register(
    "split_positions",
    f"""WITH {BZ} SELECT id, "Rd", "Price" AS raw, split_part(p, ' ', 1) AS first_position,
    CASE WHEN contains(p, ' ') THEN split_part(p, ' ', 2) END AS second_position
    FROM (SELECT *, {strip_sql('"Posn"')} AS p FROM bz)""",
)
def split_positions(spark: SparkSession, sf: str) -> DataFrame:
    first, second = c.split_positions(strip("Posn"))
    return bronze_grid(spark, sf).select(
        "id", "Rd", F.col("Price").alias("raw"),
        first.alias("first_position"), second.alias("second_position"),
    )


SILVER = f"""
kept AS (
  SELECT *, {strip_sql('"Name"')} AS trimmed, {strip_sql('"Posn"')} AS place FROM bz
  WHERE regexp_full_match(id, '[0-9]+') AND "Rd" <> 'Totals' AND "Name" <> '' AND "Posn" <> ''
    AND "Posn" <> 'Pos Pos'
),
five AS (
  SELECT *, CASE WHEN strpos(place, '5/8') > 0 THEN substring(place, 1, strpos(place, '5/8') - 1)
    || '5_8' || substring(place, strpos(place, '5/8') + 3) ELSE place END AS position
  FROM kept WHERE trimmed <> '' AND place <> ''
),
silver AS (
  SELECT year, trimmed AS player_name, position, "Team" AS team, CAST("Rd" AS INTEGER) AS round,
    {MONEY.format(x='"Price"')} AS price, {MONEY.format(x='"RoundPriceChange"')} AS round_price_change,
    {TO_INT.format(x='"Score"')} AS score, {TO_INT.format(x='"BE"')} AS break_even,
    CAST("AvgMins" AS DOUBLE) AS avg_mins, TRY_CAST("TR" AS INTEGER) AS "TR",
    TRY_CAST("TA" AS INTEGER) AS "TA", split_part(position, ' ', 1) AS primary_position,
    CASE WHEN contains(position, ' ') THEN split_part(position, ' ', 2) END AS secondary_position
  FROM five
)"""


@register("silver_panel", f"WITH {BZ}, {SILVER} SELECT * FROM silver")
def silver_panel(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(c.conform_silver(bronze_grid(spark, sf)))
