"""Column expressions: recoding, names, flags, scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Team names and their three-letter codes.
TEAM_CODES = {
    "Sea Eagles": "MNL",
    "Rabbitohs": "STH",
    "Roosters": "SYD",
    "Broncos": "BRO",
    "Knights": "NEW",
    "Raiders": "CBR",
    "Storm": "MEL",
    "Warriors": "NZL",
    "Panthers": "PTH",
    "Bulldogs": "BUL",
    "Sharks": "SHA",
    "Tigers": "WST",
    "Wests Tigers": "WST",
    "Eels": "PAR",
    "Titans": "GCT",
    "Cowboys": "NQC",
    "Dragons": "STG",
    "Dolphins": "DOL",
}

# Place names some older feeds use for the same teams.
PLACE_CODES = {
    "Manly": "MNL",
    "South Sydney": "STH",
    "Sydney Roosters": "SYD",
    "Brisbane": "BRO",
    "Newcastle": "NEW",
    "Canberra": "CBR",
    "Melbourne": "MEL",
    "New Zealand": "NZL",
    "Penrith": "PTH",
    "Canterbury": "BUL",
    "Cronulla": "SHA",
    "Parramatta": "PAR",
    "Gold Coast": "GCT",
    "North Queensland": "NQC",
    "St George Illawarra": "STG",
    "St. George Illawarra": "STG",
}

# Points per action.
ACTION_WEIGHTS = {
    "TR": 17, "TA": 12, "TC": 4, "GO": 4, "FG": 5,
    "TB": 2, "MT": -1, "FD": 6, "OL": 4, "IO": 2,
    "LB": 10, "LA": 8, "IT": 5, "PC": -2, "ER": -2,
    "HG": 1, "HU": -1, "KB": -3, "SS": -8,
}

# Score bonus per player-state cluster.
CLUSTER_BONUS = {0: 1, 1: 0, 2: -2, 3: 3, 4: -4, 5: 2}

MIN_PRICE = 102400
WHITESPACE = " \t\n\r\x0b\x0c"


def col_of(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def recode(column: Column | str, mapping: Mapping[str, str]) -> Column:
    """Mapped value; values outside the map pass through."""
    column = col_of(column)
    return F.coalesce(recode_strict(column, mapping), column)


def recode_strict(column: Column | str, mapping: Mapping[str, str]) -> Column:
    """Mapped value; values outside the map become null."""
    return F.try_element_at(literal_map(mapping), col_of(column))


def map_default(column: Column | str, mapping: Mapping, default: float = 0.0) -> Column:
    """Mapped number as double; ``default`` outside the map and for null."""
    mapped = F.try_element_at(literal_map(mapping), col_of(column)).cast("double")
    return F.coalesce(mapped, F.lit(float(default)))


def is_code(column: Column | str, length: int = 3) -> Column:
    return F.length(col_of(column)) == length


def strip(column: Column | str) -> Column:
    """Trim all whitespace at both ends, not only blanks."""
    return F.btrim(col_of(column), F.lit(WHITESPACE))


def flip_name(column: Column | str) -> Column:
    """``First Middle Last`` to ``Last, First Middle``; one word stays as it is."""
    column = col_of(column)
    words = F.split(strip(column), r"\s+")
    flipped = F.concat(
        F.element_at(words, -1),
        F.lit(", "),
        F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " "),
    )
    return F.when(F.size(words) >= 2, flipped).otherwise(column)


def without_apostrophe(column: Column | str) -> Column:
    return F.replace(col_of(column), F.lit("'"), F.lit(""))


def classify_band(column: Column | str, starters: int = 13, bench: int = 17) -> Column:
    """Jersey number to starter, bench or reserve."""
    column = col_of(column)
    band = F.when(column <= starters, "starter").when(column <= bench, "bench")
    return F.when(column.isNotNull(), band.otherwise("reserve"))


def clip_lower(column: Column | str, bound: float) -> Column:
    """At least ``bound``; null stays null."""
    column = col_of(column)
    return F.when(column.isNotNull(), F.greatest(column, F.lit(bound)))


def clip_upper(column: Column | str, bound: float) -> Column:
    """At most ``bound``; null stays null."""
    column = col_of(column)
    return F.when(column.isNotNull(), F.least(column, F.lit(bound)))


def coalesce_default(column: Column | str, default: object) -> Column:
    return F.coalesce(col_of(column), F.lit(default))


def round_score(is_bye: str, matchup: str, career: str) -> Column:
    """0 in a bye, the matchup mean where there is one, else the career mean."""
    chosen = F.when(F.col(is_bye), F.lit(0.0)).when(F.col(matchup).isNotNull(), F.col(matchup))
    return F.coalesce(chosen.otherwise(F.col(career)), F.col(career))


def string_to_bool(column: Column | str) -> Column:
    return col_of(column) == "True"


def _sum_columns(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def weighted_action_score(df: DataFrame, weights: Mapping[str, int] = ACTION_WEIGHTS) -> Column:
    """Sum of count times weight over the columns that exist; null if any is null."""
    return _sum_columns([F.col(c) * w for c, w in weights.items() if c in df.columns])


def action_sum(df: DataFrame, cols: Sequence[str]) -> Column:
    """Plain sum of the columns that exist; null if any is null."""
    return _sum_columns([F.col(c) for c in cols if c in df.columns])


def is_min_price(column: Column | str, floor: int = MIN_PRICE, slack: float = 1.1) -> Column:
    """Price close to the floor; null stays null."""
    return col_of(column) <= floor * slack


def likely_to_play(column: Column | str, minutes: int = 40) -> Column:
    """Recent minutes reach the limit; null counts as no."""
    return F.coalesce(col_of(column) >= minutes, F.lit(False))


def sentiment_adjust(
    score: Column | str, sentiment: Column | str, confidence: Column | str, share: float = 0.10
) -> Column:
    """Scale the score by up to ``share``, in step with sentiment and confidence."""
    score, sentiment = col_of(score), col_of(sentiment).cast("double")
    scaled = score * (1.0 + sentiment * col_of(confidence).cast("double") * share)
    return F.when(sentiment.isNotNull(), scaled).otherwise(score)
