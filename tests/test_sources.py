from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.sources import articles, feeds, markup, tables


def test_seasons_are_read_file_by_file(spark, tmp_path, rows):
    spark.range(2).selectExpr("2015 as year", "id").write.parquet(f"{tmp_path}/a/stats_2015.parquet")
    for year, extra in ((2015, "id"), (2016, "id, id * 2 as more")):
        folder = f"{tmp_path}/w{year}"
        spark.range(2).selectExpr(f"{year} as year", *extra.split(", ")).coalesce(1).write.parquet(folder)
    (tmp_path / "flat" / "nested").mkdir(parents=True)
    for year in (2016, 2015):
        part = next((tmp_path / f"w{year}").glob("part-*.parquet"))
        (tmp_path / "flat" / f"stats_{year}.parquet").write_bytes(part.read_bytes())
        (tmp_path / "flat" / "nested" / f"stats_{year}.parquet").write_bytes(part.read_bytes())
    found = tables.season_files(spark, str(tmp_path / "flat"))
    assert [f.rsplit("/", 1)[1] for f in found] == ["stats_2015.parquet", "stats_2016.parquet"]
    both = tables.read_seasons(spark, found, lambda df: df.filter("id > 0"))
    assert rows(both, "year", "id", "more") == [(2015, 1, None), (2016, 1, 2)]


def test_optional_table(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert tables.read_optional(spark, str(tmp_path / "none"), schema).count() == 0
    tables.write_table(spark.createDataFrame([(1,)], schema), str(tmp_path / "some"))
    assert tables.read_optional(spark, str(tmp_path / "some"), schema).count() == 1


def test_write_replaces_the_whole_dataset(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([(2024, 1), (2025, 2)], "year int, a int"), path, ["year"])
    tables.write_table(spark.createDataFrame([(2025, 3)], "year int, a int"), path, ["year"])
    assert [tuple(r) for r in spark.read.parquet(path).select("year", "a").collect()] == [(2025, 3)]


def test_landing_skips_closed_seasons_and_renews_the_running_one(spark, tmp_path, rows):
    path = str(tmp_path / "landed")
    first = spark.createDataFrame([(2024, 1), (2025, 1)], "year int, a int")
    tables.land_new_seasons(first, path, current=2025)
    second = spark.createDataFrame([(2024, 9), (2025, 9), (2026, 9)], "year int, a int")
    tables.land_new_seasons(second, path, current=2025)
    assert rows(spark.read.parquet(path), "year", "a") == [(2024, 1), (2025, 9), (2026, 9)]


def test_csv_export_is_ranked(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", None)], "name string, score double")
    path = tmp_path / "csv"
    tables.export_csv(df, str(path), F.col("score").desc_nulls_first(), "name")
    parts = sorted(path.glob("part-*.csv"))
    lines = [line for p in parts for line in p.read_text().splitlines() if not line.startswith("name")]
    assert [line.split(",")[0] for line in lines] == ["c", "b", "a"]


def test_header_falls_back_to_numbers(spark):
    df = spark.createDataFrame([("1", "2")], "x string, y string")
    assert tables.apply_header(df, ["id", "Name"], 2026).columns == ["year", "id", "Name"]
    assert tables.apply_header(df, ["id"], 2026).columns == ["year", "col_0", "col_1"]
    assert tables.apply_header(df, ["id"], 2026).first()["year"] == 2026


def page(spark, html):
    return spark.createDataFrame([(1, html)], "page_id int, html string")


def test_grid_rows(spark):
    html = (
        "<table><tr><th>head</th></tr><tr><td> a </td><td>b &amp; <b>c</b></td></tr>"
        "<tr><td></td><td> </td></tr><!-- <tr><td>no</td></tr> --><tr class='x'><td>1<td>2</table><p>end"
    )
    found = markup.grid_rows(page(spark, html)).orderBy("row_no").collect()
    assert [r["cells"] for r in found] == [["a", "b & c"], ["1", "2"]]


def test_scripts_do_not_count(spark):
    html = "<script>var x='<p>no</p>'</script><article><p>yes</p></article>"
    assert markup.article_text(page(spark, html)).first()["body"] == "yes"


def test_article_falls_back_to_long_paragraphs(spark):
    long = "x" * 31
    html = f"<title> T &amp; U </title><article><p> </p></article><p>{long}</p><p>{'y' * 30}</p>"
    row = markup.article_text(page(spark, html)).first()
    assert (row["title"], row["body"]) == ("T & U", long)


def test_article_joins_paragraphs_with_blank_lines(spark):
    html = "<main><p>one<p> two<br>more</p></main><p>outside the article, but long enough to count</p>"
    assert markup.article_text(page(spark, html)).first()["body"] == "one\n\ntwo\nmore"


def test_paragraphs_of_nested_articles_all_count(spark):
    html = "</main><main><p>a</p><article><p>b</p></article><p>c</p></main><p>d</p><article class=x><p>e"
    assert markup.article_text(page(spark, html)).first()["body"] == "a\n\nb\n\nc\n\ne"


def test_team_lists(spark):
    html = (
        "<strong>1.</strong> Nobody Yet <img src='x' alt=\"sponsor\"><img alt=\"Newcastle Knights\">"
        "<p><strong>1.</strong> Kalyn Ponga <strong>14.</strong> Dom O'Neil<br>"
        "<strong>Notes</strong> none <img alt=\"advert\"><strong>18.</strong> Al Smith</p>"
        "<img width=1 alt=\"Sea Eagles\"/><strong>17.</strong> Tom Jones<strong>2.</strong>"
    )
    found = markup.team_lists(page(spark, html), ["Knights", "Sea Eagles"]).collect()
    assert [(r["team"], r["jersey"], r["player_name"], r["status"]) for r in found] == [
        ("NEWCASTLE_KNIGHTS", 1, "Ponga, Kalyn", "starter"),
        ("NEWCASTLE_KNIGHTS", 14, "O'Neil, Dom", "bench"),
        ("NEWCASTLE_KNIGHTS", 18, "Smith, Al", "reserve"),
        ("SEA_EAGLES", 17, "Jones, Tom", "bench"),
    ]


def test_labelled_values(spark):
    html = (
        '<p class="match-weather__text">Ground Conditions: <span> Good </span></p>'
        '<p class="other">Weather: <span>no</span></p>'
    )
    row = markup.labelled_values(page(spark, html), feeds.WEATHER_LABELS).first()
    assert (row["ground_condition"], row["weather_condition"]) == ("Good", "")


@pytest.mark.parametrize(
    ("url", "slug"),
    [
        ("https://x.org/blog/2026/02/24/round-1?a=b#c", "blog-2026-02-24-round-1-a-b-c"),
        ("http://x.org/", ""),
        ("https://x.org/" + "a" * 100, "a" * 80),
    ],
)
def test_slug(spark, url, slug):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(markup.url_slug("url")).first()[0] == slug


def draw(items):
    data = json.dumps({"fixtures": items}).replace('"', "&quot;")
    return f'<div class="a" id="vue-draw" q-data="{data}">x</div>'


def test_draw_pages(spark):
    match = {"type": "Match", "homeTeam": {"nickName": "Eels", "score": 0}, "awayTeam": {}, "venue": None}
    df = spark.createDataFrame(
        [(2026, 1, draw([match, {"type": "Bye"}])), (2026, 2, "<div>none</div>"),
         (2026, 3, '<div id="vue-draw" q-data="{broken">')],
        "year int, round int, html string",
    )
    good, bad = markup.embedded_json(df, feeds.FIXTURES_SCHEMA, "vue-draw", "q-data")
    found = feeds.fixtures_from_json(good, "https://h").collect()
    assert len(found) == 1
    row = found[0]
    assert (row["home_team"], row["home_score"], row["away_team"], row["away_score"]) == ("Eels", 0, "", None)
    assert (row["venue"], row["match_centre_url"]) == ("", "https://h")
    assert [r["round"] for r in bad.collect()] == [3]


def feed(spark, rounds):
    return spark.createDataFrame([(2016, json.dumps({"NRL": rounds}))], "year int, raw string")


def test_feed_rows(spark):
    match = {
        "match": {"ground_condition": "Dry", "main_ref": "R"},
        "home": {"all_runs": "1,870", "Completion Rate": "78%", "tries": -1, "time_in_possession": "29:10"},
        "away": {"Completion Rate": "70%", "errors": 7},
    }
    df = feeds.feed_context(feed(spark, [{"1": [{"A v B": match}, {"A v B v C": match}]}, {"Finals": [{"C v D": {}}]}]))
    assert len([c for c in df.columns if c.startswith("team_")]) == 19
    found = df.orderBy("round_type", "team").collect()
    assert [(r["round"], r["round_type"], r["team"], r["opponent"], r["is_home"]) for r in found] == [
        (None, "Finals", "C", "D", True), (None, "Finals", "D", "C", False),
        (1, "regular", "A", "B", True), (1, "regular", "B", "A", False),
    ]
    a, b = found[2], found[3]
    assert (a["team_all_runs"], a["team_completion_rate_pct"], a["team_tries"]) == (1870.0, 78.0, None)
    assert (a["opp_errors"], b["team_errors"], b["opp_all_runs"]) == (7.0, 7.0, 1870.0)
    assert a["team_time_in_possession"] == "29:10" and not a["fields_shifted"]


def test_rotated_feed_rows_are_repaired_on_both_sides(spark):
    side = {
        "Completion Rate": "3.49s",
        "Average_Play_Ball_Speed": "64%",
        "Kick_Defusal": "88%",
        "Effective_Tackle": "78%",
    }
    away = {"Completion Rate": "3.1s", "Effective_Tackle": "70%"}
    df = feeds.feed_context(feed(spark, [{"2": [{"A v B": {"home": side, "away": away}}]}]))
    a = df.filter("is_home").first()
    assert a["fields_shifted"]
    assert (a["team_avg_play_ball_speed_s"], a["team_kick_defusal_pct"]) == (3.49, 64.0)
    assert (a["team_effective_tackle_pct"], a["team_completion_rate_pct"]) == (88.0, 78.0)
    assert (a["opp_avg_play_ball_speed_s"], a["opp_completion_rate_pct"]) == (3.1, 70.0)
    assert a["opp_kick_defusal_pct"] is None and a["opp_effective_tackle_pct"] is None


def test_page_context_keeps_finished_matches(spark, rows):
    fixtures = spark.createDataFrame(
        [(2025, 1, "A", "B", "FullTime", "u1"), (2025, 1, "C", "D", "Upcoming", "u2"),
         (2025, 2, "E", "F", "FullTime", "u3")],
        "year int, round int, home_team string, away_team string, match_state string, match_centre_url string",
    )
    weather = spark.createDataFrame(
        [("u1", "Good", None)], "match_centre_url string, ground_condition string, weather_condition string"
    )
    found = rows(
        feeds.page_context(fixtures, weather), "team", "opponent", "is_home", "ground_condition", "weather_condition"
    )
    assert found == [
        ("A", "B", True, "Good", ""), ("B", "A", False, "Good", ""), ("E", "F", True, "", ""),
        ("F", "E", False, "", ""),
    ]


def test_articles(spark, tmp_path, rows):
    for name, body in (("a", "text"), ("b", ""), ("c", None)):
        doc = {"url": name, "title": "t", "scraped_at": "2026", "body": body}
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "note.txt").write_text("no article")
    assert rows(articles.read_articles(spark, str(tmp_path)), "url", "body") == [("a", "text")]


def test_worklist(spark, tmp_path):
    path = tmp_path / "urls.json"
    path.write_text(json.dumps({"1": ["u1", "u2"], "2": []}, indent=1))
    read = lambda n: [r["url"] for r in articles.read_worklist(spark, str(path), n).collect()]
    assert (read(1), read(2), read(3)) == (["u1", "u2"], [], [])


def test_replies(spark, rows):
    record = '{"player_name": "A B", "sentiment_score": 0.5}'
    df = spark.createDataFrame(
        [("u1", f"[{record}]"), ("u2", f"```json\n[{record}, {record}]\n```"), ("u3", f"```[{record}]```"),
         ("u4", "sorry"), ("u5", record), ("u6", " [] "), ("u7", f"[{record}")],
        "url string, reply string",
    )
    good, bad = articles.parse_insight_reply(df)
    assert rows(good, "source_url", "item_no", "player_name") == [
        ("u1", 0, "A B"), ("u2", 0, "A B"), ("u2", 1, "A B"), ("u3", 0, "A B"),
    ]
    assert rows(bad, "url") == [("u4",), ("u5",), ("u7",)]


def test_grid_in_a_cell(spark):
    """Cells after an inner grid stay in their row; the inner rows come last."""
    html = (
        "<table><tr><td>a</td><td>x<table><tr><td>i</td><td>j</td></tr><tr><td>k</td></tr></table></td><td>b</td></tr>"
        "<tr><td>c</td></tr></table>"
    )
    found = markup.grid_rows(spark.createDataFrame([(1, html)], "n int, html string")).orderBy("row_no").collect()
    assert [[" ".join(c.split()) for c in r["cells"]] for r in found] == [["a", "x i j k", "b"], ["c"], ["i", "j"], ["k"]]


def test_draw_data_with_angle_brackets_and_entities(spark):
    data = (
        "{&quot;fixtures&quot;:[{&quot;type&quot;:&quot;Match&quot;,&quot;venue&quot;:&quot;A &amp; B > C&quot;,"
        "&quot;homeTeam&quot;:{&quot;nickName&quot;:&quot;Sea &#39;Eagles&quot;}}]}"
    )
    pages = [
        (1, f'<p title="1 > 0">x</p><div class="a" id="vue-draw" q-data="{data}"></div>'),
        (2, f"<div id='vue-draw' q-data=\"{data}\"></div>"),
        (3, '<div id="vue-draw" q-data="{&quot;fixtures&quot;:[{ > "></div>'),
        (4, '<div id="other" q-data="{}"></div>'),
    ]
    df = spark.createDataFrame(pages, "round int, html string").selectExpr("2026 as year", "round", "html")
    good, bad = markup.embedded_json(df, feeds.FIXTURES_SCHEMA, "vue-draw", "q-data")
    found = feeds.fixtures_from_json(good, "").orderBy("round").collect()
    assert [(r["round"], r["venue"], r["home_team"]) for r in found] == [
        (1, "A & B > C", "Sea 'Eagles"),
        (2, "A & B > C", "Sea 'Eagles"),
    ]
    assert [(r["round"], r["rejected"]) for r in bad.collect()] == [
        (3, '<div id="vue-draw" q-data="{&quot;fixtures&quot;:[{ > ">')
    ]


@pytest.mark.parametrize(
    "html, body",
    [
        ('<div class="x entry-content y"><p>one</p><div><p>two</p></div><p>three</p></div><p>out</p>', "one|two|three"),
        ("<section class='post-content'><p>one</p></section><p>out</p>", "one"),
        ('<article><div class="entry-content"><p>once</p></div><p>more</p></article><p>out</p>', "once|more"),
        ('<div class="not-entry-content"><p>short</p></div>', ""),
    ],
)
def test_article_containers(spark, html, body):
    found = markup.article_text(spark.createDataFrame([(html,)], "html string")).first()["body"]
    assert found == body.replace("|", "\n\n")


def test_unreadable_feeds_are_kept_aside(spark):
    good = '{"NRL":[{"1":[{"A v B":{"match":{}}}]}]}'
    df = spark.createDataFrame([(2025, good), (2026, '{"NRL":[{"1":[{"A v'), (2027, None)], "year int, raw string")
    assert feeds.feed_flatten(df).count() == 1
    rejected = feeds.unreadable_feeds(df).collect()
    assert sorted((r["year"], r["rejected"]) for r in rejected) == [(2026, '{"NRL":[{"1":[{"A v'), (2027, None)]


HARD_PAGE = """<html><!-- <tr><td>no</td></tr> --><script>var a = "<tr><td>no</td></tr>";</script>
<table title='2 > 1 <b>'><tr data-x="a>b"><td class='cell first' title="x < y > z">O&#8217;Neil</td><td>&#x41;&#66; &#39;q&#39;</td>
<tr><td alt='say "hi" > now'>open<td>3 < 4</table>
<p class='match-weather__text big'>Weather: <span>Wet &amp; cold</span></p>
<p title="a > b" class="small match-weather__text">Ground: <span>Good&#160;one</span></p>
<p class="match-weather__texts">Weather: <span>other</span></p>
<img alt='Team logo > big' src="x"><div><strong title="1 > 0">1.</strong> Ann Lee</div>
<article data-a="</article>"><p>First &gt; second</p><p title='</p>'>Next &#9731;</article></html>"""


def test_pages_with_brackets_in_attributes_and_open_tags(spark):
    page = spark.createDataFrame([(1, HARD_PAGE)], "page_id long, html string")
    rows = markup.grid_rows(page).orderBy("row_no").collect()
    assert [r["cells"] for r in rows] == [["O’Neil", "AB 'q'"], ["open", "3 < 4"]]
    values = markup.labelled_values(page, {"Weather": "weather", "Ground": "ground"}).first()
    assert (values["weather"], values["ground"]) == ("Wet & cold", "Good one")
    items = markup.token_stream(page, "img", "strong", header_attr="alt", keywords=["logo"], item_pattern=r"^(\d+)\.$").collect()
    assert [(r["label"], r["text"]) for r in items] == [("1", "Ann Lee")]
    assert markup.article_text(page).first()["body"] == "First > second\n\nNext ☃"


def test_numeric_entities(spark):
    texts = ["&#8217;", "&#x1F600; &#x1f600;", "&#0; &#55296; &#x110000;", "&amp;#65;", "a &# b", "&#99999999;", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(markup.decode(F.col("t"))).collect()]
    assert found == ["’", "😀 😀", "&#0; &#55296; &#x110000;", "&#65;", "a &# b", "&#99999999;", None]


def test_plain_pages_read_the_same_either_way(spark):
    text = '<ul id="a"><li>x</li><li>y<style>li {}</style></ul><!-- - --> 1 &lt; 2 <br/>'
    df = spark.createDataFrame([(text,)], "html string")
    row = df.select(markup.visible("html").alias("a"), F.array_join(markup.page_tokens("html"), "").alias("b")).first()
    assert row["a"] == row["b"]
