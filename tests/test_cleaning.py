from __future__ import annotations

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from panelworks.operators import cleaning as c
from panelworks.sources.tables import union_drift

HEADERS = "year bigint, id string, cb string, Name string, Posn string, Team string, Price string, Score string, BE string, Rd string, RoundPriceChange string, AvgMins string, TR string"


def grid(spark, *rows):
    base = (2025, "12", "x", "Smith, Al", "HOK", "MEL", "$198,800", "44", "20", "03", "$-12,400", "61.5", "2")
    names = [h.split()[0] for h in HEADERS.split(", ")]
    return spark.createDataFrame(
        [tuple(row.get(n, base[i]) for i, n in enumerate(names)) for row in rows], HEADERS
    )


def test_a_clean_row_is_typed_and_renamed(spark):
    df = c.conform_silver(grid(spark, {}))
    row = df.first().asDict()
    assert row == {
        "year": 2025, "player_name": "Smith, Al", "position": "HOK", "team": "MEL", "price": 198800,
        "score": 44, "break_even": 20, "round": 3, "round_price_change": -12400, "avg_mins": 61.5,
        "TR": 2, "primary_position": "HOK", "secondary_position": None,
    }
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types["price"] == "bigint" and types["score"] == "int" and types["avg_mins"] == "float"


@pytest.mark.parametrize(
    "junk",
    [
        {"id": "Any"}, {"id": ""}, {"id": None}, {"id": "Page  of 1"}, {"id": "12\n"},
        {"Rd": "Totals"}, {"Rd": None}, {"Name": ""}, {"Name": None}, {"Name": "  \n"},
        {"Posn": "Pos Pos"}, {"Posn": None}, {"Posn": " "},
    ],
)
def test_junk_rows_go(spark, junk):
    assert c.conform_silver(grid(spark, {}, junk)).count() == 1


def test_unreadable_numbers_become_null(spark):
    df = c.conform_silver(grid(spark, {"Score": "44.0", "Price": "", "AvgMins": "", "TR": "x"}))
    row = df.first()
    assert (row["score"], row["price"], row["avg_mins"], row["TR"]) == (None, None, None, None)


@pytest.mark.parametrize(
    ("raw", "position", "primary", "secondary"),
    [
        ("5/8", "5_8", "5_8", None),
        ("5/8 HFB", "5_8 HFB", "5_8", "HFB"),
        (" 2RF FRF ", "2RF FRF", "2RF", "FRF"),
        ("5/8 5/8", "5_8 5/8", "5_8", "5/8"),
    ],
)
def test_positions(spark, raw, position, primary, secondary):
    row = c.conform_silver(grid(spark, {"Posn": raw})).first()
    assert (row["position"], row["primary_position"], row["secondary_position"]) == (
        position,
        primary,
        secondary,
    )


def test_missing_columns_are_no_error(spark):
    df = c.conform_silver(grid(spark, {}).drop("TR", "AvgMins", "cb"))
    assert "TR" not in df.columns and df.count() == 1


def test_seasons_of_different_columns_are_united(spark):
    old = c.conform_silver(grid(spark, {"year": 2015}).drop("TR"))
    new = c.conform_silver(grid(spark, {"year": 2025}))
    both = union_drift([old, new]).orderBy("year").collect()
    assert [r["TR"] for r in both] == [None, 2]


def test_strict_money_raises(spark):
    df = grid(spark, {"Price": "n/a"})
    with pytest.raises(NumberFormatException):
        df.select(c.parse_money("Price", strict=True)).collect()


def test_replace_first_keeps_null(spark):
    df = spark.createDataFrame([("a-a",), (None,), ("b",)], "x string")
    assert [r[0] for r in df.select(c.replace_first("x", "a", "zz")).collect()] == ["zz-a", None, "b"]


def test_casts_stay_jvm_side(spark):
    plan = c.conform_silver(grid(spark, {})).select(F.count("score"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")
