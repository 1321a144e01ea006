"""Reading, landing and extracting.

The HTML and JSON texts are derived from the tables row by row, so the rows that
come out can be compared with the tables themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.checks.book import register
from panelworks.checks.panels import CO, FX, fixture_list, match_panel, rounded, table
from panelworks.checks.summary_queries import TURNS, turn_records
from panelworks.operators.aggregates import count_by
from panelworks.session import ensure_checkpoint_dir
from panelworks.sources import articles, feeds, markup, tables
from panelworks.streaming.landing import land_season_files


@register("scanned_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def scanned_table(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_table(spark, f"{sf}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


@register(
    "season_files_with_drift",
    """SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS mktsegment
    FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier""",
)
def season_files_with_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Two files of different columns, each cleaned on its own, then united."""

    def clean(df: DataFrame) -> DataFrame:
        short = df.toDF(*[c.split("_", 1)[1] for c in df.columns])
        return short.withColumnsRenamed({"custkey": "key", "suppkey": "key"}).drop("acctbal")

    paths = tables.season_files(spark, sf, "{customer,supplier}.parquet")
    return tables.read_seasons(spark, paths, clean).select("key", "name", "nationkey", "mktsegment")


@register(
    "optional_table",
    "SELECT c_custkey, CAST(NULL AS DOUBLE) AS sentiment_score FROM customer",
)
def optional_table(spark: SparkSession, sf: str) -> DataFrame:
    """A missing input joins as an empty table."""
    schema = T.StructType(
        [T.StructField("c_custkey", T.LongType()), T.StructField("sentiment_score", T.DoubleType())]
    )
    missing = tables.read_optional(spark, f"{sf}/no_such_table.parquet", schema)
    return table(spark, sf, "customer").select("c_custkey").join(missing, "c_custkey", "left")


@register(
    "unlanded_seasons",
    """WITH o AS (SELECT *, year(o_orderdate) AS year FROM orders)
    SELECT o_orderkey, year FROM o WHERE year NOT IN
    (SELECT year FROM o WHERE o_orderstatus = 'F' AND year < 2000) OR year = 1998""",
)
def unlanded_seasons(spark: SparkSession, sf: str) -> DataFrame:
    incoming = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    landed = incoming.filter((F.col("o_orderstatus") == "F") & (F.col("year") < 2000))
    return tables.new_seasons(incoming, landed, current=1998).select("o_orderkey", "year")


@register(
    "numbered_header",
    """SELECT CAST(2026 AS BIGINT) AS year, p_partkey AS col_0, p_name AS col_1, p_brand AS col_2,
    p_type AS col_3, p_size AS col_4, p_retailprice AS col_5 FROM part""",
)
def numbered_header(spark: SparkSession, sf: str) -> DataFrame:
    return tables.apply_header(table(spark, sf, "part"), ["only", "two"], 2026)


# --- pages ----------------------------------------------------------------------

HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"


def visible_sql(x: str) -> str:
    return f"regexp_replace({x}, '{HIDDEN}', '', 'g')"


def text_sql(x: str) -> str:
    x = rf"regexp_replace(regexp_replace({x}, '(?i)<br\s*/?>', chr(10), 'g'), '<[^>]*>', '', 'g')"
    for entity, char in markup.ENTITIES.items():
        quoted = char.replace("'", "''")
        x = f"replace({x}, '{entity}', '{quoted}')"
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def cut_sql(x: str, tag: str) -> str:
    return rf"regexp_split_to_array({x}, '(?i)<{tag}(?:\s[^>]*)?>')[2:]"


def elements_sql(x: str, tag: str) -> str:
    ends = "|".join((tag, *markup.PARENTS.get(tag, ())))
    return rf"list_transform({cut_sql(x, tag)}, lambda e: regexp_split_to_array(e, '(?i)</(?:{ends})\s*>')[1])"


@register(
    "page_list_cells",
    f"""WITH p AS (SELECT page_id, list_transform({elements_sql(visible_sql('html'), 'ul')},
      lambda r: list_transform({elements_sql('r', 'li')}, lambda t: {text_sql('t')})) AS grid FROM pages),
    k AS (SELECT page_id, list_filter(grid, lambda r: len(list_filter(r, lambda t: t <> '')) > 0) AS grid FROM p)
    SELECT page_id, CAST(generate_subscripts(grid, 1) - 1 AS INTEGER) AS row_no,
      array_to_string(unnest(grid), '|') AS cells FROM k""",
)
def page_list_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = markup.grid_rows(table(spark, sf, "pages"), row="ul", cell="li")
    return rows.select("page_id", "row_no", F.array_join("cells", "|").alias("cells"))


HEADING = r"regexp_split_to_array(section, '(?i)</(?:h1)\s*>')[1]"


@register(
    "page_paragraphs_by_heading",
    rf"""WITH s AS (SELECT page_id, unnest({cut_sql(visible_sql('html'), 'h1')}) AS section FROM pages),
    i AS (SELECT page_id, upper(replace(replace({text_sql(HEADING)},
      'ß', 'SS'), ' ', '_')) AS "group", unnest({elements_sql('section', 'p')}) AS item FROM s)
    SELECT page_id, "group", {text_sql('item')} AS text FROM i WHERE {text_sql('item')} <> ''""",
)
def page_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    tokens = markup.token_stream(table(spark, sf, "pages").select("page_id", "html"), "h1", "p")
    return tokens.select("page_id", "group", "text")


EDGE = r"(?i)</?(?:article|main)(?:\s[^>]*)?>"


@register(
    "page_articles",
    rf"""WITH v AS (SELECT page_id, {visible_sql('html')} AS page FROM pages),
    e AS (SELECT page_id, page, regexp_split_to_array(page, '{EDGE}') AS pieces,
      list_transform(regexp_extract_all(page, '{EDGE}'),
        lambda x: CASE WHEN starts_with(x, '</') THEN -1 ELSE 1 END) AS steps FROM v),
    d AS (SELECT page_id, page, list_filter(list_transform(range(1, len(pieces)), lambda i:
      CASE WHEN list_reduce(list_prepend(0, steps[1:i]), lambda x, y: greatest(x + y, 0)) > 0
      THEN pieces[i + 1] END), lambda x: x IS NOT NULL) AS regions FROM e),
    t AS (SELECT page_id, page, list_filter(flatten(list_transform(regions,
      lambda r: list_transform({elements_sql('r', 'p')}, lambda x: {text_sql('x')}))),
      lambda x: x <> '') AS texts FROM d)
    SELECT page_id, {text_sql(f"coalesce({elements_sql('page', 'title')}[1], '')")} AS title,
    CASE WHEN len(texts) > 0 THEN array_to_string(texts, chr(10) || chr(10)) ELSE
      array_to_string(list_filter(list_transform({elements_sql('page', 'p')}, lambda x: {text_sql('x')}),
      lambda x: length(x) > 30), chr(10) || chr(10)) END AS body FROM t""",
)
def page_articles(spark: SparkSession, sf: str) -> DataFrame:
    return markup.article_text(table(spark, sf, "pages").select("page_id", "html"))


@register(
    "url_slugs",
    r"""SELECT page_id, substring(regexp_replace(regexp_replace(regexp_replace(url, 'https?://[^/]+/', '', 'g'),
    '[^a-zA-Z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80) AS slug FROM pages""",
)
def url_slugs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", markup.url_slug("url").alias("slug"))


@register(
    "worklist_urls",
    "SELECT page_id, 0 AS url_no, url FROM pages",
)
def worklist_urls(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON worklist per page; round 2 names the page's own URL."""
    lists = F.create_map(F.lit("1"), F.array(F.lit("other")), F.lit("2"), F.array(F.col("url")))
    rows = table(spark, sf, "pages").select("page_id", F.to_json(lists).alias("value"))
    return articles.worklist_urls(rows, 2, keep=["page_id"])


# --- fixtures and match pages -------------------------------------------------------


def draw_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One draw page per round with the round's matches in an attribute, and one bye item."""
    f = fixture_list(spark, sf)
    match = F.struct(
        F.lit("Match").alias("type"),
        F.col("round_title").alias("roundTitle"),
        F.struct(F.col("home_team").alias("nickName"), F.col("home_score").alias("score")).alias("homeTeam"),
        F.struct(F.col("away_team").alias("nickName"), F.col("away_score").alias("score")).alias("awayTeam"),
        F.col("venue"),
        F.struct(F.col("match_date").alias("kickOffTimeLong")).alias("clock"),
        F.col("match_state").alias("matchState"),
        F.col("path").alias("matchCentreUrl"),
    )
    # one page per match keeps the pages small for any number of matches
    bye = F.lit('{"type":"Bye","roundTitle":"none"}')
    data = F.concat(F.lit('{"fixtures":['), F.to_json(match), F.lit(","), bye, F.lit("]}"))
    page = F.concat(
        F.lit('<html><div class="draw" id="vue-draw" q-data="'),
        F.replace(data, F.lit('"'), F.lit("&quot;")),
        F.lit('"></div></html>'),
    )
    return f.select("year", "round", page.alias("html"))


@register(
    "draw_page_fixtures",
    f"""WITH {CO}, {FX} SELECT CAST(year AS INTEGER) AS year, CAST(round AS INTEGER) AS round, round_title,
    home_team, home_score, away_team, away_score, venue, match_date, match_state,
    'https://example.org' || path AS match_centre_url FROM fx""",
)
def draw_page_fixtures(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = markup.embedded_json(
        draw_pages(spark, sf), feeds.FIXTURES_SCHEMA, "vue-draw", "q-data"
    )
    return feeds.fixtures_from_json(good, "https://example.org")


@register(
    "rejected_draw_pages",
    f"""WITH {CO}, {FX} SELECT year, round, count(*) AS n FROM fx WHERE home_score IS NULL GROUP BY 1, 2""",
)
def rejected_draw_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose JSON breaks off are kept aside."""
    pages = draw_pages(spark, sf)
    has_score = F.col("html").rlike("homeTeam&quot;:[{][^}]*score")
    broken = F.replace(F.col("html"), F.lit("]}"), F.lit(""))
    cut = F.when(has_score, F.col("html")).otherwise(broken)
    _, rejected = markup.embedded_json(
        pages.withColumn("html", cut), feeds.FIXTURES_SCHEMA, "vue-draw", "q-data"
    )
    return count_by(rejected, "year", "round", name="n")


def weather_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A match page per fixture; the weather line is missing in odd rounds."""
    m = match_panel(spark, sf)
    opened = F.lit('<p class="match-weather__text">')

    def line(label: str, value: Column) -> Column:
        return F.concat(opened, F.lit(f"{label}: <span> "), value, F.lit(" </span></p>"))

    weather = F.when(F.col("round") % 2 == 0, line("Weather", F.col("weather_condition"))).otherwise("")
    html = F.concat(
        F.lit("<html><p>Ground</p>"), line("Ground Conditions", F.col("ground_condition")), weather
    )
    path = F.concat(F.lit("/draw/"), "year", F.lit("/"), "round", F.lit("/"), "team")
    return m.select(path.alias("match_centre_url"), html.alias("html"))


@register(
    "match_page_conditions",
    f"""WITH {CO} SELECT '/draw/' || year || '/' || round || '/' || team AS match_centre_url,
    ground_condition, CASE WHEN round % 2 = 0 THEN weather_condition ELSE '' END AS weather_condition FROM co""",
)
def match_page_conditions(spark: SparkSession, sf: str) -> DataFrame:
    return markup.labelled_values(weather_pages(spark, sf), feeds.WEATHER_LABELS)


PAGE_ROWS = f"""WITH {CO}, {FX}, w AS (SELECT '/draw/' || year || '/' || round || '/' || team AS path,
    ground_condition, CASE WHEN round % 2 = 0 THEN weather_condition ELSE '' END AS weather_condition FROM co),
    d AS (SELECT year, round, home_team, away_team, ground_condition, weather_condition
      FROM fx JOIN w USING (path) WHERE match_state = 'FullTime')
    SELECT *, home_team AS team, away_team AS opponent, true AS is_home FROM d
    UNION ALL SELECT *, away_team, home_team, false FROM d"""


@register("completed_match_rows", PAGE_ROWS)
def completed_match_rows(spark: SparkSession, sf: str) -> DataFrame:
    fixtures = fixture_list(spark, sf).withColumnRenamed("path", "match_centre_url")
    weather = markup.labelled_values(weather_pages(spark, sf), feeds.WEATHER_LABELS)
    return feeds.page_context(fixtures, weather)


# --- season feeds -------------------------------------------------------------------


def season_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """One feed text per match; every third month is a finals round, some are rotated."""
    m = match_panel(spark, sf)
    n, rnd = F.col("n").cast("string"), F.col("round")
    key = F.when(rnd % 3 == 0, F.concat(F.lit("Finals "), rnd)).otherwise(rnd.cast("string"))
    matchup = F.when(rnd == 11, F.col("team")).otherwise(
        F.concat("team", F.lit(" v "), "opponent", F.lit(" "))
    )
    meta = F.create_map(F.lit("ground_condition"), F.col("ground_condition"))
    rotated = F.col("is_home")
    percent, speed = F.concat(n, F.lit("7%")), F.concat(F.lit("3."), n, F.lit("s"))
    home = F.create_map(
        F.lit("time_in_possession"), F.concat(n, F.lit(":05")),
        F.lit("all_runs"), F.concat(F.lit("1,"), F.lpad(n, 3, "0")),
        F.lit("tries"), F.when(F.col("n") > 2, F.lit("-1")).otherwise(n),
        F.lit("Completion Rate"), F.when(rotated, speed).otherwise(percent),
        F.lit("Average_Play_Ball_Speed"), F.when(rotated, F.lit("66%")).otherwise(speed),
        F.lit("Kick_Defusal"), F.when(rotated, F.lit("55%")).otherwise(F.lit("66%")),
        F.lit("Effective_Tackle"), F.when(rotated, percent).otherwise(F.lit("55%")),
    )
    away = F.create_map(F.lit("tries"), n, F.lit("Effective_Tackle"), F.lit("bad"))
    match = F.create_map(F.lit("match"), meta, F.lit("home"), home)
    full = F.map_concat(match, F.create_map(F.lit("away"), away))
    data = F.when(rnd == 5, F.to_json(match)).otherwise(F.to_json(full))
    raw = F.concat(
        F.lit('{"NRL":[{"'), key, F.lit('":[{"'), matchup, F.lit('":'), data, F.lit("}]}]}")
    )
    return m.select("year", raw.alias("raw"))


@register(
    "feed_matches",
    f"""WITH {CO}, k AS (SELECT *, round % 3 = 0 AS finals FROM co WHERE round <> 11)
    SELECT year, CASE WHEN NOT finals THEN round END AS round,
    CASE WHEN finals THEN 'Finals ' || round ELSE 'regular' END AS round_type,
    team AS home_team, opponent AS away_team, ground_condition, round = 5 AS no_away FROM k""",
)
def feed_matches(spark: SparkSession, sf: str) -> DataFrame:
    flat = feeds.matchup_split(feeds.feed_flatten(season_feeds(spark, sf)), "matchup")
    number, kind = feeds.round_key("round_key")
    return flat.select(
        "year", number.alias("round"), kind.alias("round_type"), "home_team", "away_team",
        F.try_element_at("match", F.lit("ground_condition")).alias("ground_condition"),
        (F.size("away") == 0).alias("no_away"),
    )


@register(
    "rejected_feeds",
    f"WITH {CO} SELECT year, count(*) AS n FROM co WHERE round = 7 GROUP BY year",
)
def rejected_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """The feeds of one round break off; they are kept aside, the others are not."""
    raw = F.col("raw")
    broken = F.when(raw.contains('"NRL":[{"7"'), F.substring(raw, 1, 25)).otherwise(raw)
    rejected = feeds.unreadable_feeds(season_feeds(spark, sf).withColumn("raw", broken))
    return count_by(rejected, "year", name="n")


@register(
    "team_list_rows",
    """SELECT p_partkey, upper(replace(p_brand, '#', '_')) || '_LOGO' AS team, p_size AS jersey,
    'Al B. Part' || p_partkey AS player_name_raw, 'Part' || p_partkey || ', Al B.' AS player_name,
    CASE WHEN p_size <= 13 THEN 'starter' WHEN p_size <= 17 THEN 'bench' ELSE 'reserve' END AS status
    FROM part""",
)
def team_list_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A page for each part: another image, the logo of its brand, and one numbered player."""
    brand = F.replace("p_brand", F.lit("#"), F.lit(" "))
    html = F.concat(
        F.lit('<p><img alt="Sponsor"><b>x</b> <img src="l.png" alt="'), brand, F.lit(' logo"></p><strong>'),
        F.col("p_size").cast("string"), F.lit(".</strong> Al B. Part"), F.col("p_partkey").cast("string"),
        F.lit("<br><strong>Coach</strong> Nobody"),
    )
    pages = table(spark, sf, "part").select("p_partkey", html.alias("html"))
    return markup.team_lists(pages, ["Brand"]).select(
        "p_partkey", "team", "jersey", "player_name_raw", "player_name", "status"
    )


FEED_ROWS = f"""WITH {CO}, k AS (SELECT *, round % 3 = 0 AS finals,
      CAST(n || '7' AS DOUBLE) AS pct, CAST('3.' || n AS DOUBLE) AS speed FROM co WHERE round <> 11),
    h AS (SELECT CAST(year AS INTEGER) AS year, CASE WHEN NOT finals THEN round END AS round, team AS home_team,
      opponent AS away_team, is_home AS fields_shifted, n || ':05' AS h_time, 1000.0 + n AS h_runs,
      CASE WHEN n <= 2 THEN CAST(n AS DOUBLE) END AS h_tries, pct AS h_completion, speed AS h_speed,
      66.0 AS h_defusal, 55.0 AS h_effective,
      CASE WHEN round <> 5 THEN CAST(n AS DOUBLE) END AS a_tries FROM k)
    SELECT year, round, fields_shifted, home_team AS team, away_team AS opponent, true AS is_home,
      h_time AS team_time_in_possession, CAST(h_runs AS DOUBLE) AS team_all_runs, h_tries AS team_tries,
      h_completion AS team_completion_rate_pct, h_speed AS team_avg_play_ball_speed_s,
      CAST(h_defusal AS DOUBLE) AS team_kick_defusal_pct, CAST(h_effective AS DOUBLE) AS team_effective_tackle_pct,
      a_tries AS opp_tries, CAST(NULL AS DOUBLE) AS opp_completion_rate_pct FROM h
    UNION ALL SELECT year, round, fields_shifted, away_team, home_team, false, NULL, NULL, a_tries, NULL,
      NULL, NULL, NULL, h_tries, h_completion FROM h"""


@register("feed_context_rows", FEED_ROWS)
def feed_context_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        feeds.feed_context(season_feeds(spark, sf)),
        "year", "round", "fields_shifted", "team", "opponent", "is_home",
        "team_time_in_possession", "team_all_runs", "team_tries", "team_completion_rate_pct",
        "team_avg_play_ball_speed_s", "team_kick_defusal_pct", "team_effective_tackle_pct",
        "opp_tries", "opp_completion_rate_pct",
    )


# --- insight replies ------------------------------------------------------------------


def reply_texts(spark: SparkSession, sf: str) -> DataFrame:
    """One reply per conversation turn: plain, fenced, tagged or unreadable."""
    records = turn_records(spark, sf)
    item = F.to_json(
        F.struct(
            "player_name", "team", "position", "sentiment_score", "confidence", "recommendation", "key_insight"
        )
    )
    body = F.concat(F.lit("["), item, F.lit("]"))
    fence = F.lit("```")
    reply = (
        F.when(F.col("turn") % 4 == 0, body)
        .when(F.col("turn") % 4 == 1, F.concat(fence, body, fence))
        .when(F.col("turn") % 4 == 2, F.concat(fence, F.lit("json\n"), body, F.lit("\n"), fence))
        .otherwise(F.lit("I could not find any player."))
    )
    return records.select(F.col("source_url").alias("url"), reply.alias("reply"), "turn")


@register(
    "insight_replies",
    f"""WITH {TURNS} SELECT player_name, team, position, round(CAST(sentiment_score AS DOUBLE), 4) AS sentiment_score,
    round(CAST(confidence AS DOUBLE), 4) AS confidence, recommendation, key_insight, source_url
    FROM tr WHERE turn % 4 <> 3""",
)
def insight_replies(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = articles.parse_insight_reply(reply_texts(spark, sf))
    return good.drop("item_no").withColumns(
        {c: F.round(F.col(c).cast("double"), 4) for c in ("sentiment_score", "confidence")}
    )


@register("unreadable_replies", f"WITH {TURNS} SELECT source_url AS url FROM tr WHERE turn % 4 = 3")
def unreadable_replies(spark: SparkSession, sf: str) -> DataFrame:
    _, rejects = articles.parse_insight_reply(reply_texts(spark, sf))
    return rejects.select("url")


@register(
    "articles_with_body",
    "SELECT doc_id, text AS body FROM documents WHERE lang <> 'de' AND text <> ''",
)
def articles_with_body(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    body = F.when(F.col("lang") != "de", F.col("text"))
    return articles.with_body(docs.select("doc_id", body.alias("body")))


# --- writing ---------------------------------------------------------------------------


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which all executors can reach."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def season_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year")
    )


@register(
    "written_season_table",
    "SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
)
def written_season_table(spark: SparkSession, sf: str) -> DataFrame:
    """A dataset partitioned by season, written and read back."""
    path = scratch(spark, "written")
    tables.write_table(season_orders(spark, sf), path, ["year"])
    return tables.read_table(spark, path).select("o_orderkey", "o_orderstatus", "year")


@register(
    "landed_seasons",
    """SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    WHERE year(o_orderdate) > 1998 OR o_orderstatus = 'F'""",
)
def landed_seasons(spark: SparkSession, sf: str) -> DataFrame:
    """Old seasons hold finished orders only; a later landing leaves them alone."""
    path = scratch(spark, "landed")
    orders = season_orders(spark, sf)
    first = orders.filter((F.col("year") <= 1998) & (F.col("o_orderstatus") == "F"))
    tables.land_new_seasons(first, path)
    tables.land_new_seasons(orders, path)
    return tables.read_table(spark, path).select("o_orderkey", "o_orderstatus", "year")


@register(
    "landed_in_parts",
    "SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
)
def landed_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Seasons that arrive in two parts each, the second of which is landed twice."""
    path = scratch(spark, "parts")
    orders = season_orders(spark, sf)
    finished = F.col("o_orderstatus") == "F"
    tables.land_part(orders.filter(finished), path, 1)
    for _ in range(2):
        tables.land_part(orders.filter(~finished), path, 2)
    return tables.read_table(spark, path).select("o_orderkey", "o_orderstatus", "year")


@register(
    "landed_by_file",
    "SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
)
def landed_by_file(spark: SparkSession, sf: str) -> DataFrame:
    """Two feeds land in one table, and the first of them once more after its progress is lost."""
    path, orders = scratch(spark, "by-file"), season_orders(spark, sf)
    finished = F.col("o_orderstatus") == "F"
    feeds_of = {scratch(spark, "feed"): own for own in (finished, ~finished)}
    for folder, own in feeds_of.items():
        orders.filter(own).write.parquet(folder)
    for folder in [*feeds_of, next(iter(feeds_of))]:
        land_season_files(spark, orders.schema, folder, path, scratch(spark, "progress"), clean=lambda df: df)
    return tables.read_table(spark, path).select("o_orderkey", "o_orderstatus", "year")


@register(
    "exported_csv",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size FROM part",
)
def exported_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "csv")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    tables.export_csv(parts, path, F.col("p_size").desc_nulls_first(), "p_partkey")
    return spark.read.schema("p_partkey string, p_name string, p_size string").csv(path, header=True)
