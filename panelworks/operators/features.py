"""Preparing features: splits, codes, medians, scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.operators.layout import running_before
from panelworks.session import persist_point, stored_table

# Columns known only after the round, and identifiers.
LEAKING_COLUMNS = [
    "score", "player_name", "season_price_change", "avg_score",
    "avg_2rd", "avg_3rd", "avg_5rd",
    "TR", "TS", "LT", "GO", "MG", "FG", "MF", "TA", "MT",
    "TB", "FD", "OL", "IO", "LB", "LA", "FT", "KB", "H8",
    "HU", "HG", "IT", "KD", "PC", "ER", "SS",
    "mins", "bppm", "cv",
    "base", "attack", "playmaking", "power", "negative",
    "base_power", "base_avg", "scoring_avg", "create_avg",
    "evade_avg", "negative_avg", "base_power_avg", "base_pct",
    "base_power_ppm", "h8_pct", "tb_pct", "mt_pct", "ol_il_pct",
    "be_gap", "avg_be_gap_3rd", "ppm", "avg_pc", "avg_er",
    "avg_pc_er", "sixty_sixty", "score_rank_in_position",
]

MISSING = -999


def season_split(
    df: DataFrame, train_to: int = 2023, val: int = 2024, test: int = 2025, season: str = "year"
) -> DataFrame:
    """Add ``split``; seasons outside the three parts are left out."""
    part = (
        F.when(F.col(season) <= train_to, "train")
        .when(F.col(season) == val, "val")
        .when(F.col(season) == test, "test")
    )
    return df.withColumn("split", part).filter(F.col("split").isNotNull())


def vocabulary(
    df: DataFrame, cols: Sequence[str], null_as: str | None = None, hot_rows: int | None = None
) -> DataFrame:
    """(column, value, code) with codes in alphabetical order, from 0, per column."""

    def entry(col: str) -> Column:
        value = F.col(col).cast("string")
        if null_as is not None:
            value = F.coalesce(value, F.lit(null_as))
        return F.struct(F.lit(col).alias("column"), value.alias("value"))

    values = (
        df.select(F.explode(F.array(*[entry(c) for c in cols])).alias("_e"))
        .select("_e.*", F.lit(1).alias("_one"))
        .filter(F.col("value").isNotNull())
        .distinct()
    )
    numbered = running_before(values, ["column"], ["value"], "_one", "_code", hot_rows=hot_rows)
    return numbered.select(
        "column", "value", F.coalesce("_code", F.lit(0)).cast("int").alias("code")
    )


def apply_codes(
    df: DataFrame,
    codes: DataFrame,
    cols: Mapping[str, str],
    null_as: str | None = None,
    unseen: int | None = None,
) -> DataFrame:
    """Add the code of each column under a new name; ``unseen`` for unknown values."""
    codes = stored_table(codes)
    for col, name in cols.items():
        own = codes.filter(F.col("column") == col).select(
            F.col("value").alias("_value"), F.col("code").alias(name)
        )
        value = F.col(col).cast("string")
        if null_as is not None:
            value = F.coalesce(value, F.lit(null_as))
        df = df.withColumn("_key", value).join(own, F.col("_key") == F.col("_value"), "left")
        df = df.drop("_key", "_value")
        if unseen is not None:
            df = df.withColumn(name, F.coalesce(F.col(name), F.lit(unseen)))
    return df


def encode_codes(df: DataFrame, cols: Sequence[str], suffix: str = "_enc") -> DataFrame:
    """Alphabetical integer codes; null stays null."""
    return apply_codes(df, vocabulary(df, cols), {c: f"{c}{suffix}" for c in cols})


def label_encode(
    df: DataFrame, fitted_on: DataFrame, cols: Sequence[str], suffix: str = "_enc"
) -> DataFrame:
    """Codes fitted on one frame and applied to another; unseen values become -1."""
    codes = vocabulary(fitted_on, cols, null_as="unknown")
    named = {c: f"{c}{suffix}" for c in cols}
    return apply_codes(df, codes, named, null_as="unknown", unseen=-1)


def select_features(df: DataFrame, exclude: Sequence[str] = LEAKING_COLUMNS) -> list[str]:
    """Numeric and boolean columns that are not excluded."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in exclude and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def fill_sentinel(df: DataFrame, cols: Sequence[str], value: float = MISSING) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(value))) for c in cols})


LEAST, LARGEST = float("-inf"), float("nan")  # the ends of Spark's order of doubles


def exact_medians(
    df: DataFrame, cols: Sequence[str], hot_rows: int | None = None, accuracy: int = 10_000
) -> DataFrame:
    """(column, median) of every column that holds a value, exact, in two passes over the rows.

    The first pass sketches the quantiles of all columns and takes two values that lie around the middle of each, by a
    share of ``4 / accuracy`` of the rows. The second counts the values between them, and as one number those
    below; running counts give each value its ranks, and the middle ranks are read off. Only what lies
    in a bracket is shuffled, counted before, and no task holds a whole column. Should a bracket miss a
    middle rank, its column is counted whole. The columns are stored first, so what ``df`` is made of is computed once.
    """
    medians = _medians(stored_table(df.select(*dict.fromkeys(cols))), cols, hot_rows, accuracy) if cols else {}
    if not medians:
        return df.sparkSession.createDataFrame([], "column string, median double")
    rows = [F.struct(F.lit(c).alias("column"), F.lit(m).cast("double").alias("median")) for c, m in medians.items()]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def _medians(df: DataFrame, cols: Sequence[str], hot_rows: int | None, accuracy: int = 10_000) -> dict[str, float]:
    """Median of every column that holds a value; ``df``, a stored table, is read twice or three times."""
    margin = 2.0 / accuracy
    value = {c: F.col(c).cast("double") for c in cols}
    sketched = [F.percentile_approx(value[c], [0.5 - margin, 0.5 + margin], accuracy) for c in cols]
    found = df.agg(F.array(*(F.count(value[c]) for c in cols)), F.array(*sketched)).first()
    brackets = {c: (n, *ends) for c, n, ends in zip(cols, *found) if n}
    medians = _medians_within(df, brackets, hot_rows)
    missed = {c: (n, LEAST, LARGEST) for c, (n, *_) in brackets.items() if c not in medians}
    return medians | _medians_within(df, missed, hot_rows)


def _medians_within(
    df: DataFrame, brackets: Mapping[str, tuple[int, float, float]], hot_rows: int | None
) -> dict[str, float]:
    """Medians of the columns whose middle ranks lie in their bracket (number of values, least, largest)."""
    if not brackets:
        return {}
    entries = []
    for c, (_, low, high) in brackets.items():
        v = F.col(c).cast("double")
        inside = F.when(v < F.lit(low), F.lit(LEAST)).otherwise(v)
        entries.append(F.when(v <= F.lit(high), F.struct(F.lit(c).alias("column"), inside.alias("value"))))
    counts = persist_point(
        df.select(F.explode(F.array(*entries)).alias("_e"))
        .filter(F.col("_e").isNotNull())
        .select("_e.*")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    below = F.coalesce(F.col("_below"), F.lit(0))
    ranked = running_before(counts, ["column"], ["value"], "n", "_below", hot_rows=hot_rows)
    total = F.create_map(*(F.lit(x) for c, (n, *_) in brackets.items() for x in (c, n)))[F.col("column")]

    def covers(rank: Column) -> Column:
        return ((rank > below) & (rank <= below + F.col("n"))).cast("int")

    ranked = ranked.withColumn("total", total)
    times = covers(F.expr("(total + 1) div 2")) + covers(F.expr("(total + 2) div 2"))
    middle = ranked.withColumn("times", times).filter("times > 0")
    clamped = F.col("column").isin([c for c, (_, low, _) in brackets.items() if low != LEAST])
    middle = middle.filter(~(clamped & (F.col("value") == F.lit(LEAST))))
    share = F.sum(F.col("value") * F.col("times") / 2).alias("median")
    rows = middle.groupBy("column").agg(share, F.sum("times").alias("times")).filter("times = 2").collect()
    return {r["column"]: r["median"] for r in rows}


def impute_median(df: DataFrame, cols: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Fill nulls with the column median; one number per column passes the driver.

    The rows are stored once; the medians and the result read the stored rows.
    """
    if not cols:
        return df
    df = stored_table(df)
    medians = _medians(df, cols, hot_rows)
    return df.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c]))
            if c in medians
            else F.col(c).cast("double")
            for c in cols
        }
    )


def categories(df: DataFrame, col: str, null_as: str = "UNK") -> list[str]:
    """Sorted categories of a column, for as many as there are; they become columns, so they pass the driver."""
    values = df.select(F.coalesce(F.col(col), F.lit(null_as)).alias("v")).distinct().orderBy("v")
    return [r.v for r in values.toLocalIterator()]


def one_hot(
    df: DataFrame, col: str, prefix: str = "pos_", null_as: str = "UNK"
) -> tuple[DataFrame, list[str]]:
    """One 0/1 column per category, and their names. For many categories see ``one_hot_vector``."""
    value = F.coalesce(F.col(col), F.lit(null_as))
    named = {f"{prefix}{c}": (value == c).cast("double") for c in categories(df, col, null_as)}
    return df.withColumns(named), list(named)


def one_hot_vector(df: DataFrame, col: str, name: str = "one_hot", null_as: str = "UNK") -> tuple[DataFrame, Model]:
    """Categories as one sparse vector, one place each in alphabetical order, and the fitted encoder."""
    filled = df.withColumn("_category", F.coalesce(F.col(col), F.lit(null_as)))
    stages = [
        StringIndexer(inputCol="_category", outputCol="_index", stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCol="_index", outputCol=name, dropLast=False, handleInvalid="keep"),
    ]
    fitted = Pipeline(stages=stages).fit(filled)
    return fitted.transform(filled).drop("_category", "_index"), fitted


def standardise(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population deviation; a constant column is only centred."""
    stats = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(cols)],
    ).first()
    return df.withColumns(
        {
            f"{c}{suffix}": (F.col(c).cast("double") - F.lit(stats[f"m_{i}"]))
            / F.lit(stats[f"s_{i}"] or 1.0)
            for i, c in enumerate(cols)
        }
    )
