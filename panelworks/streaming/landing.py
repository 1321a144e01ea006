"""Landing season files as they arrive.

The file source keeps track of the files it has read, so each run takes the new
ones only. Every batch goes through the same cleaning as the batch job, and the rows of
a file are landed as a part of their own, so a season may arrive in several files over several runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.operators.cleaning import conform_silver
from panelworks.sources.tables import SOURCE_FILE, land_files


def land_season_files(
    spark: SparkSession,
    schema: T.StructType,
    folder: str,
    path: str,
    progress: str,
    clean: Callable[[DataFrame], DataFrame] = conform_silver,
    key: str = "year",
) -> None:
    """Clean the new season files of a folder and land them; returns when all are done.

    ``progress`` is the folder, on shared storage, where the stream notes which
    files it has taken. Rows are kept by the file they come from, so a batch that is run again, or a whole
    folder after ``progress`` is lost, replaces what it landed before: no row is repeated and none lost. Feeds
    of any number of folders may land in one table, each with a ``progress`` of its own. A file that
    is written again under its old name is taken again only with a new ``progress``.

    ``clean`` has to keep the column ``_source_file``.
    """

    def land(batch: DataFrame, number: int) -> None:
        land_files(batch, clean(batch), path, key)

    arriving = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(folder)
    query = (
        arriving.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
