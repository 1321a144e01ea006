from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelworks.functions import scalars as s


def values(spark, expression, data, schema="x string"):
    df = spark.createDataFrame([(d,) for d in data], schema)
    return [r[0] for r in df.select(expression).collect()]


def test_recode_passes_unknown_names_through(spark):
    assert values(spark, s.recode("x", {"Eels": "PAR"}), ["Eels", "Who", None]) == ["PAR", "Who", None]
    assert values(spark, s.recode_strict("x", {"Eels": "PAR"}), ["Eels", "Who", None]) == ["PAR", None, None]


def test_all_codes_have_three_letters():
    codes = {**s.TEAM_CODES, **s.PLACE_CODES}
    assert len(codes) == 34
    assert all(len(code) == 3 for code in codes.values())
    assert len(set(codes.values())) == 17


def test_map_default(spark):
    assert values(spark, s.map_default("x", {1: 3}), [1, 2, None], "x int") == [3.0, 0.0, 0.0]


@pytest.mark.parametrize(
    ("name", "flipped"),
    [
        ("Tom Trbojevic", "Trbojevic, Tom"),
        ("  Daly  Cherry Evans ", "Evans, Daly Cherry"),
        ("Pele", "Pele"),
        ("", ""),
        (None, None),
    ],
)
def test_flip_name(spark, name, flipped):
    assert values(spark, s.flip_name("x"), [name]) == [flipped]


def test_flipped_names_match_a_plain_python_rule(spark):
    words = st.lists(st.text("abcXYZ'-", min_size=1, max_size=5), min_size=0, max_size=4)

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(words, min_size=20, max_size=20))
    def check(lists):
        names = [" ".join(parts) for parts in lists]
        wanted = [
            f"{p[-1]}, {' '.join(p[:-1])}" if len(p) >= 2 else n for p, n in zip(lists, names)
        ]
        assert values(spark, s.flip_name("x"), names) == wanted

    check()


def test_bands(spark):
    found = values(spark, s.classify_band("x"), [1, 13, 14, 17, 18, None], "x int")
    assert found == ["starter", "starter", "bench", "bench", "reserve", None]


def test_clips_keep_null(spark):
    assert values(spark, s.clip_lower("x", 1), [None, 0, 5], "x int") == [None, 1, 5]
    assert values(spark, s.clip_upper("x", 1), [None, 0, 5], "x int") == [None, 0, 1]


def test_round_score_has_three_cases_and_a_fallback(spark):
    df = spark.createDataFrame(
        [(True, 5.0, 9.0), (False, 5.0, 9.0), (False, None, 9.0), (False, None, None)],
        "is_bye boolean, m double, c double",
    )
    found = [r[0] for r in df.select(s.round_score("is_bye", "m", "c")).collect()]
    assert found == [0.0, 5.0, 9.0, None]


def test_weighted_score_skips_missing_columns_and_spreads_null(spark):
    df = spark.createDataFrame([(1, 2), (None, 1)], "TR int, SS int")
    assert [r[0] for r in df.select(s.weighted_action_score(df)).collect()] == [17 - 16, None]


def test_flags(spark):
    assert values(spark, s.is_min_price("x"), [112640, 112641, None], "x bigint") == [True, False, None]
    assert values(spark, s.likely_to_play("x"), [40.0, 39.9, None], "x double") == [True, False, False]
    assert values(spark, s.string_to_bool("x"), ["True", "true", None]) == [True, False, None]


def test_sentiment_adjust(spark):
    df = spark.createDataFrame(
        [(50.0, 0.5, 1.0), (50.0, None, 1.0)], "p double, s double, c double"
    )
    found = [r[0] for r in df.select(s.sentiment_adjust("p", "s", "c")).collect()]
    assert found == [pytest.approx(52.5), 50.0]


def test_apostrophes(spark):
    assert values(spark, s.without_apostrophe("x"), ["O'Neil, D'A", None]) == ["ONeil, DA", None]


def test_strip_removes_all_whitespace_kinds(spark):
    assert values(spark, s.strip("x"), ["\n\t a b \r\n"]) == ["a b"]


def test_literal_maps_do_not_need_a_join(spark):
    df = spark.range(3).select(F.lit("Eels").alias("x")).select(s.recode("x", s.TEAM_CODES))
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
