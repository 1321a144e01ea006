"""Bronze grids to the silver panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelworks.operators.cleaning import conform_silver
from panelworks.sources.tables import read_seasons, season_files, write_table


def silver_panel(spark: SparkSession, bronze_folder: str) -> DataFrame:
    paths = season_files(spark, bronze_folder)
    if not paths:
        raise FileNotFoundError(f"no season files in {bronze_folder}")
    return read_seasons(spark, paths, conform_silver)


def run_silver(spark: SparkSession, bronze_folder: str, path: str) -> None:
    write_table(silver_panel(spark, bronze_folder), path, ["year"])
