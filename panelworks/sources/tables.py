"""Reading and writing the stored datasets."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def season_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> list[str]:
    """Sorted season files directly inside a folder; works on any Hadoop file system.

    Only file names come to the driver, one per season.
    """
    names = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "false")
        .load(folder)
        .select("path")
        .distinct()
        .orderBy("path")
    )
    return [row.path for row in names.toLocalIterator()]


def union_drift(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames; a column missing in one of them is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_seasons(
    spark: SparkSession, paths: Sequence[str], clean: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Clean each season on its own schema, then put the seasons together.

    Files of one schema are one scan, so the plan grows with the number of schemas and not of files.
    Only the footers of the files are read for that.
    """
    groups: dict[str, list[str]] = {}
    for path in paths:
        groups.setdefault(read_table(spark, path).schema.json(), []).append(path)
    return union_drift([clean(spark.read.parquet(*same)) for same in groups.values()])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame of the schema where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def table_if_there(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The table with its own schema, or None where there is none."""
    if path is None:
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the dataset; rows are grouped by partition before writing.

    ``rebalance`` lets adaptive execution split a partition that is too large
    for one file, so one big season does not end up in one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def new_seasons(
    incoming: DataFrame, landed: DataFrame, current: int | None = None, key: str = "year"
) -> DataFrame:
    """Rows of seasons not landed yet; the running season always counts as new."""
    seasons = landed.select(key).distinct()
    if current is not None:
        seasons = seasons.filter(F.col(key) != current)
    return incoming.join(seasons, key, "left_anti")


def land_new_seasons(
    incoming: DataFrame, path: str, current: int | None = None, key: str = "year"
) -> None:
    """Add the new seasons to a season-partitioned dataset, replacing the running one.

    For tables that hold whole seasons. Seasons that arrive in several parts go to ``land_part``.
    """
    schema = T.StructType([incoming.schema[key]])
    landed = read_optional(incoming.sparkSession, path, schema)
    rows = new_seasons(incoming, landed, current, key)
    (
        rows.hint("rebalance", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )


def land_part(incoming: DataFrame, path: str, part: str | int, key: str = "year") -> None:
    """Add the rows that arrived together as one part of a dataset, in ``part`` and season folders.

    Parts add up: a season may arrive in any number of them, over any number of runs. Landing a part again
    replaces that part, so a run that is repeated neither loses nor doubles a row.
    """
    (
        incoming.withColumn("part", F.lit(str(part)))
        .hint("rebalance", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("part", key)
        .parquet(path)
    )


#: Column with the name of the file that a row comes from.
SOURCE_FILE = "_source_file"


def land_files(incoming: DataFrame, cleaned: DataFrame, path: str, key: str = "year") -> None:
    """Add the rows of files to a dataset, in folders by the file they come from (``part``) and by season.

    Both frames have the column ``_source_file``; ``cleaned`` holds the rows to land, ``incoming`` is what they were made
    of. A file that is landed again replaces all its rows: the seasons it still has in one commit of
    the write, those it no longer has right after. An interrupted run is put right by running it again.
    A file without any row leaves the table as it is.
    """
    if SOURCE_FILE not in cleaned.columns:
        raise ValueError(f"the cleaning has to keep the column {SOURCE_FILE}")
    spark = incoming.sparkSession
    # begins with a letter that no number begins with, so the folder name is read back as text
    part = F.concat(F.lit("file-"), F.substring(F.sha2(F.col(SOURCE_FILE), 256), 1, 32)).alias("part")
    rows = cleaned.select(*(c for c in cleaned.columns if c not in (SOURCE_FILE, "part")), part)
    schema = T.StructType([T.StructField("part", T.StringType()), cleaned.schema[key]])

    def folders(df: DataFrame) -> set[tuple[str, str | None]]:
        """(part, season) pairs, one for each folder of the files at hand."""
        found = df.select("part", F.col(key).cast("string").alias("season")).distinct()
        return {(r.part, r.season) for r in found.toLocalIterator()}

    arrived = incoming.select(part).distinct()
    before = folders(read_optional(spark, path, schema).join(arrived, "part", "left_semi"))
    gone = before - folders(rows) if before else before
    (
        rows.hint("rebalance", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("part", key)
        .parquet(path)
    )
    for own, season in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part={own}/{key}={'__HIVE_DEFAULT_PARTITION__' if season is None else season}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def export_csv(df: DataFrame, path: str, *order: Column | str) -> None:
    """Ranked listing as CSV; range-partitioned, so the files follow the order."""
    df.orderBy(*order).write.mode("overwrite").option("header", "true").csv(path)


def apply_header(df: DataFrame, names: Sequence[str], season: int) -> DataFrame:
    """Name positional columns, or number them if the counts differ; add the season."""
    if not names or len(names) != len(df.columns):
        names = [f"col_{i}" for i in range(len(df.columns))]
    return df.toDF(*names).select(F.lit(season).cast("bigint").alias("year"), "*")
