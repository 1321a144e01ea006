"""Panels built from the test tables, once with DataFrames and once as SQL text.

The SQL texts are common table expressions for the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.functions.scalars import classify_band
from panelworks.panel import Panel
from panelworks.session import persist_point
from panelworks.sources.tables import read_table

DECIMALS = 8
SLOT_NAMES = ["HOK", "FRF", "2RF", "HFB", "5_8", "CTW", "FLB"]
#: Codes of the test teams; the last team has none.
NATION_CODES = {f"NATION_{i}": f"N{i:02d}" for i in range(24)}

EVENTS = Panel(seq=("ts", "event_id"))
SUPPLY = Panel()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns (default all), fractions rounded, for comparison."""
    picked = df.select(*cols) if cols else df

    def tidy(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.round(col.cast("double"), DECIMALS)
        return col.alias(field.name)

    return picked.select(*[tidy(f) for f in picked.schema.fields])


def stored(df: DataFrame) -> DataFrame:
    """The frame as a stored intermediate table, as between two jobs."""
    return persist_point(df)


def pick(index: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index.cast("int") + 1)


def sql_list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def sql_map(mapping: dict) -> str:
    def lit(x: object) -> str:
        return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)

    entries = ", ".join(f"{lit(k)}: {lit(v)}" for k, v in mapping.items())
    return "MAP {" + entries + "}"


# --- events: many rows per entity and season ------------------------------------


def event_panel(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    day = F.dayofmonth("ts")
    return table(spark, sf, "events").select(
        F.concat(F.lit("U"), "user_id").alias("player_name"),
        (F.floor((day - 1) / 7) + 2021).cast("int").alias("year"),
        day.alias("round"),
        "ts",
        "event_id",
        F.when(k % 11 != 0, F.round(F.col("value") * 100).cast("bigint")).alias("score"),
        k.alias("break_even"),
        ((k - 50) * 100).cast("bigint").alias("round_price_change"),
        (k * 1000 + 90000).cast("bigint").alias("price"),
        (k % 40).alias("avg_score"),
        (k % 81).alias("mins"),
        F.col("event_type").alias("opponent"),
        F.concat(F.lit("P"), F.col("user_id") % 7).alias("primary_position"),
    )


EV = """
ev AS (
  SELECT 'U' || user_id AS player_name,
         (dayofmonth(ts) - 1) // 7 + 2021 AS year,
         CAST(dayofmonth(ts) AS INTEGER) AS round, ts, event_id,
         CASE WHEN k % 11 <> 0 THEN CAST(round(value * 100) AS BIGINT) END AS score,
         k AS break_even, CAST((k - 50) * 100 AS BIGINT) AS round_price_change,
         CAST(k * 1000 + 90000 AS BIGINT) AS price, k % 40 AS avg_score, k % 81 AS mins,
         event_type AS opponent, 'P' || (user_id % 7) AS primary_position
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""


# --- supply: one row per supplier and month -------------------------------------

FLAGS = {
    "TR": ("R", "O"),
    "TA": ("A", "O"),
    "GO": ("N", "O"),
    "FG": ("R", "F"),
    "TB": ("A", "F"),
    "MT": ("N", "F"),
}


def supply_panel(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
    )
    dates = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        (F.year("o_orderdate") + 24).cast("bigint").alias("year"),
        F.month("o_orderdate").alias("round"),
    )
    months = (
        lines.join(dates, "l_orderkey")
        .groupBy("l_suppkey", "year", "round")
        .agg(
            F.sum("qty").alias("qty"),
            F.sum("cents").alias("cents"),
            (F.max("cents") - F.min("cents")).alias("spread"),
            F.max("qty").cast("int").alias("break_even"),
            F.min("qty").cast("int").alias("avg_score"),
            F.count(F.lit(1)).alias("n"),
            F.sum("l_partkey").alias("parts"),
            *[
                F.sum(F.when((F.col("l_returnflag") == r) & (F.col("l_linestatus") == s), F.col("qty"))).alias(a)
                for a, (r, s) in FLAGS.items()
            ],
        )
    )
    supplier = F.col("l_suppkey")
    nation = F.lpad((supplier % 25).cast("string"), 2, "0")
    primary = pick(supplier % 7, SLOT_NAMES)
    other = pick(F.floor(supplier / 7) % 7, SLOT_NAMES)
    secondary = F.when(other != primary, other)
    return months.select(
        F.concat(supplier.cast("string"), F.lit(", Supplier")).alias("player_name"),
        "year",
        "round",
        F.when(F.col("qty") % 11 != 0, F.col("qty")).alias("score"),
        F.expr("cents div 100").alias("price"),
        (F.col("spread") - 4_000_000).alias("round_price_change"),
        "break_even",
        "avg_score",
        (F.col("n") * 9).cast("int").alias("mins"),
        F.col("n").alias("games_played"),
        (F.col("qty") / F.col("n")).alias("bppm"),
        F.when(supplier % 25 == 24, F.lit("NATION_24"))
        .otherwise(F.concat(F.lit("N"), nation))
        .alias("team"),
        F.concat(F.lit("N"), F.lpad((F.col("parts") % 25).cast("string"), 2, "0")).alias("opponent"),
        primary.alias("primary_position"),
        secondary.alias("secondary_position"),
        F.concat_ws(" ", primary, secondary).alias("position"),
        *FLAGS,
    )


_FLAG_SQL = ",\n         ".join(
    f"CAST(sum(qty) FILTER (l_returnflag = '{r}' AND l_linestatus = '{s}') AS BIGINT) AS {a}"
    for a, (r, s) in FLAGS.items()
)

LI = f"""
li_lines AS (
  SELECT l_suppkey, l_partkey, l_returnflag, l_linestatus,
         CAST(l_quantity AS BIGINT) AS qty,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         year(o_orderdate) + 24 AS year, CAST(month(o_orderdate) AS INTEGER) AS round
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
li_months AS (
  SELECT l_suppkey, year, round, CAST(sum(qty) AS BIGINT) AS qty,
         CAST(sum(cents) AS BIGINT) AS cents, max(cents) - min(cents) AS spread,
         CAST(max(qty) AS INTEGER) AS break_even, CAST(min(qty) AS INTEGER) AS avg_score, count(*) AS n,
         CAST(sum(l_partkey) AS BIGINT) AS parts,
         {_FLAG_SQL}
  FROM li_lines GROUP BY l_suppkey, year, round
),
li_named AS (
  SELECT *, {sql_list(SLOT_NAMES)}[l_suppkey % 7 + 1] AS primary_position,
         {sql_list(SLOT_NAMES)}[(l_suppkey // 7) % 7 + 1] AS other
  FROM li_months
),
li AS (
  SELECT l_suppkey || ', Supplier' AS player_name, year, round,
         CASE WHEN qty % 11 <> 0 THEN qty END AS score, cents // 100 AS price,
         spread - 4000000 AS round_price_change, break_even, avg_score,
         CAST(n * 9 AS INTEGER) AS mins, n AS games_played, qty / n AS bppm,
         CASE WHEN l_suppkey % 25 = 24 THEN 'NATION_24'
              ELSE 'N' || lpad(CAST(l_suppkey % 25 AS VARCHAR), 2, '0') END AS team,
         'N' || lpad(CAST(parts % 25 AS VARCHAR), 2, '0') AS opponent,
         primary_position,
         CASE WHEN other <> primary_position THEN other END AS secondary_position,
         primary_position || CASE WHEN other <> primary_position THEN ' ' || other ELSE '' END
           AS position,
         {", ".join(FLAGS)}
  FROM li_named
)"""


# --- match context and fixtures ---------------------------------------------------


def match_panel(spark: SparkSession, sf: str) -> DataFrame:
    """A nation plays in the months in which some of its orders are urgent and finished.

    All orders are aggregated; the count of those two kinds decides what is a match.
    """
    orders = table(spark, sf, "orders")
    played = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    months = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            (F.year("o_orderdate") + 24).cast("bigint").alias("year"),
            F.month("o_orderdate").alias("round"),
            "c_nationkey",
        )
        .agg(
            F.count(F.when(played, 1)).alias("n"),
            F.min(F.when(played, F.col("c_mktsegment"))).alias("ground_condition"),
            F.max(F.when(played, F.col("c_mktsegment"))).alias("weather_condition"),
        )
        .filter("n > 0")
    )
    rival = (F.col("c_nationkey") + F.col("round")) % 25
    return months.select(
        "year",
        "round",
        F.concat(F.lit("NATION_"), "c_nationkey").alias("team"),
        F.concat(F.lit("NATION_"), rival).alias("opponent"),
        (F.col("n") % 2 == 0).alias("is_home"),
        "n",
        "ground_condition",
        "weather_condition",
    )


CO = """
co AS (
  SELECT year(o_orderdate) + 24 AS year, CAST(month(o_orderdate) AS INTEGER) AS round,
         'NATION_' || c_nationkey AS team,
         'NATION_' || ((c_nationkey + month(o_orderdate)) % 25) AS opponent,
         count(*) FILTER (played) % 2 = 0 AS is_home, count(*) FILTER (played) AS n,
         min(c_mktsegment) FILTER (played) AS ground_condition,
         max(c_mktsegment) FILTER (played) AS weather_condition
  FROM (SELECT *, o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AS played FROM orders)
  JOIN customer ON o_custkey = c_custkey
  GROUP BY year(o_orderdate), month(o_orderdate), c_nationkey
  HAVING count(*) FILTER (played) > 0
)"""

CODED_CO = f"""
cx AS (
  SELECT * REPLACE (coalesce({sql_map(NATION_CODES)}[team], team) AS team,
                    coalesce({sql_map(NATION_CODES)}[opponent], opponent) AS opponent)
  FROM co WHERE length(coalesce({sql_map(NATION_CODES)}[team], team)) = 3
)"""


def fixture_list(spark: SparkSession, sf: str) -> DataFrame:
    """The matches as fixtures, home side first."""
    return match_panel(spark, sf).select(
        "year",
        "round",
        F.concat(F.lit("Round "), "round").alias("round_title"),
        F.col("team").alias("home_team"),
        F.when(F.col("n") > 1, F.col("n").cast("int")).alias("home_score"),
        F.col("opponent").alias("away_team"),
        (F.col("n") - 1).cast("int").alias("away_score"),
        F.col("ground_condition").alias("venue"),
        F.concat("year", F.lit("-"), F.lpad(F.col("round").cast("string"), 2, "0")).alias("match_date"),
        F.when(F.col("is_home"), F.lit("FullTime")).otherwise(F.lit("Upcoming")).alias("match_state"),
        F.concat(F.lit("/draw/"), "year", F.lit("/"), "round", F.lit("/"), "team").alias("path"),
    )


FX = """
fx AS (
  SELECT year, round, 'Round ' || round AS round_title, team AS home_team,
         CASE WHEN n > 1 THEN CAST(n AS INTEGER) END AS home_score, opponent AS away_team,
         CAST(n - 1 AS INTEGER) AS away_score, ground_condition AS venue,
         year || '-' || lpad(CAST(round AS VARCHAR), 2, '0') AS match_date,
         CASE WHEN is_home THEN 'FullTime' ELSE 'Upcoming' END AS match_state,
         '/draw/' || year || '/' || round || '/' || team AS path
  FROM co
)"""


# --- bronze grid ------------------------------------------------------------------


def bronze_grid(spark: SparkSession, sf: str) -> DataFrame:
    """All-text grid with the junk a scraped grid has."""
    rows = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    thousands = F.concat(
        F.expr("cents div 1000").cast("string"),
        F.lit(","),
        F.lpad((F.col("cents") % 1000).cast("string"), 3, "0"),
    )
    month = F.month("o_orderdate")
    priority = F.substring("o_orderpriority", 1, 1)
    return rows.withColumn("cents", cents).select(
        (F.year("o_orderdate") + 24).cast("bigint").alias("year"),
        F.when(priority == "5", "Any")
        .when((priority == "4") & (F.col("o_orderstatus") == "P"), "")
        .otherwise(F.col("o_orderkey").cast("string"))
        .alias("id"),
        F.lit("x").alias("cb"),
        F.when((priority == "1") & (F.col("o_orderstatus") == "P"), "  ")
        .otherwise(F.concat(F.lit("  "), "c_name", F.lit("\n")))
        .alias("Name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "5/8")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "2RF FRF")
        .when(F.col("c_mktsegment") == "MACHINERY", "Pos Pos")
        .when(F.col("c_mktsegment") == "FURNITURE", " HOK ")
        .otherwise("5/8 5/8")
        .alias("Posn"),
        F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("Team"),
        F.when(month == 12, "Totals").otherwise(F.lpad(month.cast("string"), 2, "0")).alias("Rd"),
        F.concat(F.lit("$"), thousands).alias("Price"),
        F.when(F.col("o_orderstatus") == "P", "")
        .otherwise(F.concat(F.lit("$-"), thousands))
        .alias("RoundPriceChange"),
        F.when(F.col("o_orderstatus") == "O", "44.0")
        .otherwise((F.col("cents") % 120).cast("string"))
        .alias("Score"),
        (F.col("cents") % 60).cast("string").alias("BE"),
        F.concat((F.col("cents") % 80).cast("string"), F.lit(".25")).alias("AvgMins"),
        F.when(month > 2, (F.col("cents") % 7).cast("string")).alias("TR"),
        (F.col("cents") % 5).cast("string").alias("TA"),
    )


BZ = """
bz_rows AS (
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         month(o_orderdate) AS m, substring(o_orderpriority, 1, 1) AS pr
  FROM orders JOIN customer ON o_custkey = c_custkey
),
bz_text AS (
  SELECT *, CAST(cents // 1000 AS VARCHAR) || ',' || lpad(CAST(cents % 1000 AS VARCHAR), 3, '0')
         AS thousands FROM bz_rows
),
bz AS (
  SELECT year(o_orderdate) + 24 AS year,
         CASE WHEN pr = '5' THEN 'Any' WHEN pr = '4' AND o_orderstatus = 'P' THEN ''
              ELSE CAST(o_orderkey AS VARCHAR) END AS id,
         CASE WHEN pr = '1' AND o_orderstatus = 'P' THEN '  '
              ELSE '  ' || c_name || chr(10) END AS "Name",
         CASE c_mktsegment WHEN 'BUILDING' THEN '5/8' WHEN 'AUTOMOBILE' THEN '2RF FRF'
              WHEN 'MACHINERY' THEN 'Pos Pos' WHEN 'FURNITURE' THEN ' HOK '
              ELSE '5/8 5/8' END AS "Posn",
         'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS "Team",
         CASE WHEN m = 12 THEN 'Totals' ELSE lpad(CAST(m AS VARCHAR), 2, '0') END AS "Rd",
         '$' || thousands AS "Price",
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE '$-' || thousands END AS "RoundPriceChange",
         CASE WHEN o_orderstatus = 'O' THEN '44.0' ELSE CAST(cents % 120 AS VARCHAR) END AS "Score",
         CAST(cents % 60 AS VARCHAR) AS "BE",
         CAST(cents % 80 AS VARCHAR) || '.25' AS "AvgMins",
         CASE WHEN m > 2 THEN CAST(cents % 7 AS VARCHAR) END AS "TR",
         CAST(cents % 5 AS VARCHAR) AS "TA"
  FROM bz_text
)"""


# --- roster candidates ------------------------------------------------------------


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    primary = pick(F.col("p_size") % 7, SLOT_NAMES)
    other = pick(key % 7, SLOT_NAMES)
    tenths = F.round(F.col("p_retailprice") * 10).cast("bigint")
    return table(spark, sf, "part").select(
        F.concat(F.lit("Part'"), key).alias("player_name"),
        primary.alias("position"),
        F.when(other != primary, other).alias("secondary_position"),
        ((tenths - 9000) * 800 + 100000).alias("price"),
        (key * 7919 % 10007 / 100).alias("adjusted_predicted_score"),
        (F.col("p_brand") == "Brand#1").alias("is_bye"),
        (F.col("p_type") != "PROMO").alias("likely_to_play"),
        "p_size",
    )


PO = f"""
po AS (
  SELECT 'Part''' || p_partkey AS player_name,
         {sql_list(SLOT_NAMES)}[p_size % 7 + 1] AS position,
         CASE WHEN p_size % 7 <> p_partkey % 7
              THEN {sql_list(SLOT_NAMES)}[p_partkey % 7 + 1] END AS secondary_position,
         (CAST(round(p_retailprice * 10) AS BIGINT) - 9000) * 800 + 100000 AS price,
         (p_partkey * 7919 % 10007) / 100 AS adjusted_predicted_score,
         p_brand = 'Brand#1' AS is_bye, p_type <> 'PROMO' AS likely_to_play, p_size
  FROM part
)"""


def reserve_list(spark: SparkSession, sf: str) -> DataFrame:
    """Large parts as listed reserves, written without the apostrophe."""
    return table(spark, sf, "part").select(
        F.concat(F.lit("Part"), "p_partkey").alias("player_name"),
        classify_band("p_size").alias("status"),
    )
