"""Conforming scraped all-text grids to typed tables (bronze to silver)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelworks.functions.scalars import col_of, strip

# Columns of the grid that carry nothing for later steps.
DROP_COLUMNS = ["cb", "Photo", "Namedot", "Team2", "Jersey", "weather", "Name2", "id"]

# Columns written as money.
MONEY_COLUMNS = ["Price", "RoundPriceChange", "SeasonPriceChange"]

# Columns with fractions.
FLOAT_COLUMNS = [
    "PPM", "CVRd", "AvgMins", "TwoRdAvg", "ThreeRdAvg", "FiveRdAvg",
    "ThreeRdMins", "FiveRdMins", "Avg1to10", "Avg11to18", "Avg19to26",
    "SixtySixty", "BPPM", "BasePowerPPM", "BasePower", "AvgPC", "AvgER",
    "AvgPCER", "H8percent", "TBPERCENT", "MTPERCENT", "OLILPERCENT",
    "BasePercent", "BaseAvg", "ScoringAvg", "CreateAvg", "EvadeAvg",
    "NegativeAvg", "BasePowerAvg",
]

# Whole-number columns.
INT_COLUMNS = [
    "Score", "Mins", "AvgScore", "BE", "Played",
    "Base", "Attack", "Playmaking", "Power", "Negative",
    "TR", "TS", "LT", "GO", "MG", "FG", "MF", "TA", "MT",
    "TB", "FD", "OL", "IO", "LB", "LA", "FT", "KB", "H8",
    "HU", "HG", "IT", "KD", "PC", "ER", "SS",
]

# Grid headers and their table names.
SILVER_NAMES = {
    "Name": "player_name",
    "Posn": "position",
    "Team": "team",
    "Price": "price",
    "Score": "score",
    "Mins": "mins",
    "AvgScore": "avg_score",
    "BE": "break_even",
    "CVRd": "cv",
    "AvgMins": "avg_mins",
    "PPM": "ppm",
    "SeasonPriceChange": "season_price_change",
    "Played": "games_played",
    "Rd": "round",
    "RoundPriceChange": "round_price_change",
    "vs": "opponent",
    "TwoRdAvg": "avg_2rd",
    "ThreeRdAvg": "avg_3rd",
    "FiveRdAvg": "avg_5rd",
    "ThreeRdMins": "avg_3rd_mins",
    "FiveRdMins": "avg_5rd_mins",
    "Avg1to10": "avg_1_10",
    "Avg11to18": "avg_11_18",
    "Avg19to26": "avg_19_26",
    "SixtySixty": "sixty_sixty",
    "BPPM": "bppm",
    "BasePowerPPM": "base_power_ppm",
    "BasePower": "base_power",
    "AvgPC": "avg_pc",
    "AvgER": "avg_er",
    "AvgPCER": "avg_pc_er",
    "H8percent": "h8_pct",
    "TBPERCENT": "tb_pct",
    "MTPERCENT": "mt_pct",
    "OLILPERCENT": "ol_il_pct",
    "BasePercent": "base_pct",
    "Base": "base",
    "Attack": "attack",
    "Playmaking": "playmaking",
    "Power": "power",
    "Negative": "negative",
    "BaseAvg": "base_avg",
    "ScoringAvg": "scoring_avg",
    "CreateAvg": "create_avg",
    "EvadeAvg": "evade_avg",
    "NegativeAvg": "negative_avg",
    "BasePowerAvg": "base_power_avg",
}

POSITION_DENY = ("Pos Pos",)


def keep_numeric_id(df: DataFrame, col: str = "id") -> DataFrame:
    return df.filter(F.col(col).rlike(r"^[0-9]+\z"))


def drop_totals(df: DataFrame, col: str = "Rd", marker: str = "Totals") -> DataFrame:
    return df.filter(F.col(col) != marker)


def drop_existing(df: DataFrame, cols: Sequence[str] = DROP_COLUMNS) -> DataFrame:
    return df.drop(*cols)


def has_text(col: Column | str, deny: Sequence[str] = ()) -> Column:
    """Not null, not empty and none of the denied texts."""
    col = col_of(col)
    return col.isNotNull() & ~col.isin("", *deny)


def require_text(df: DataFrame, cols: Sequence[str], deny: Mapping[str, Sequence[str]] = {}) -> DataFrame:
    for col in cols:
        df = df.filter(has_text(col, deny.get(col, ())))
    return df


def parse_money(col: Column | str, strict: bool = False) -> Column:
    """``$-12,400`` to -12400. Other text gives null, or an error if ``strict``."""
    digits = F.regexp_replace(col_of(col), r"[$,]", "")
    return digits.cast("bigint") if strict else digits.try_cast("bigint")


def cast_tolerant(col: Column | str, to: str) -> Column:
    return col_of(col).try_cast(to)


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: strip(c) for c in cols})


def rename_existing(df: DataFrame, names: Mapping[str, str] = SILVER_NAMES) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def replace_first(col: Column | str, old: str, new: str) -> Column:
    """Replace the first occurrence only."""
    col = col_of(col)
    at = F.instr(col, old)
    return F.when(at > 0, F.overlay(col, F.lit(new), at, F.lit(len(old)))).otherwise(col)


def split_positions(col: Column | str) -> tuple[Column, Column]:
    """First and second position; the second is null if there is one only."""
    words = F.split(col_of(col), " ")
    return F.get(words, F.lit(0)), F.get(words, F.lit(1))


def typed_columns(df: DataFrame) -> dict[str, Column]:
    """Tolerant casts for whichever of the known grid columns exist."""
    casts = {c: parse_money(c) for c in MONEY_COLUMNS}
    casts["Rd"] = cast_tolerant("Rd", "int")
    casts.update({c: cast_tolerant(c, "int") for c in INT_COLUMNS})
    casts.update({c: cast_tolerant(c, "float") for c in FLOAT_COLUMNS})
    return {c: cast for c, cast in casts.items() if c in df.columns}


def conform_silver(df: DataFrame) -> DataFrame:
    """One season of the scraped grid to its typed table."""
    rows = drop_totals(keep_numeric_id(df))
    rows = require_text(rows, ["Name", "Posn"], {"Posn": POSITION_DENY})
    rows = rows.withColumns({**typed_columns(rows), "Name": strip("Name"), "Posn": strip("Posn")})
    rows = rename_existing(require_text(drop_existing(rows), ["Name", "Posn"]))
    position = replace_first("position", "5/8", "5_8")
    primary, secondary = split_positions(position)
    return rows.withColumns(
        {"position": position, "primary_position": primary, "secondary_position": secondary}
    )
