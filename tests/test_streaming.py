from __future__ import annotations

from panelworks.streaming.landing import land_season_files


def test_new_files_land_once(spark, tmp_path, rows):
    folder, path, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def arrive(year, value):
        df = spark.createDataFrame([(year, value)], "year int, v int").coalesce(1)
        df.write.mode("append").parquet(folder)

    def land():
        schema = spark.read.parquet(folder).schema
        land_season_files(spark, schema, folder, path, progress, clean=lambda df: df)
        return rows(spark.read.parquet(path), "year", "v")

    arrive(2024, 1)
    assert land() == [(2024, 1)]
    assert land() == [(2024, 1)]
    arrive(2025, 1)
    assert land() == [(2024, 1), (2025, 1)]
    arrive(2024, 9)  # more of a season that has landed
    arrive(2025, 9)
    assert land() == [(2024, 1), (2024, 9), (2025, 1), (2025, 9)]
    assert land() == [(2024, 1), (2024, 9), (2025, 1), (2025, 9)]


def test_a_part_landed_again_replaces_itself(spark, tmp_path, rows):
    from panelworks.sources.tables import land_part

    path = str(tmp_path / "out")
    first = spark.createDataFrame([(2024, 1), (2025, 2)], "year int, v int")
    second = spark.createDataFrame([(2025, 3)], "year int, v int")
    for part, df in (("a", first), ("b", second), ("b", second)):
        land_part(df, path, part)
    assert rows(spark.read.parquet(path), "year", "v") == [(2024, 1), (2025, 2), (2025, 3)]


def feed(spark, tmp_path, rows):
    """Write one file of (year, v) rows into a feed, and land a feed with or without its progress."""
    out = str(tmp_path / "out")

    def arrive(name, *values):
        df = spark.createDataFrame(list(values), "year int, v int").coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / name))

    def land(name, progress):
        schema = spark.createDataFrame([], "year int, v int").schema
        land_season_files(spark, schema, str(tmp_path / name), out, str(tmp_path / progress), clean=lambda df: df)
        return rows(spark.read.schema("year int, v int").parquet(out), "year", "v")

    return arrive, land


def test_a_lost_progress_folder_and_a_second_feed_keep_all_rows(spark, tmp_path, rows):
    arrive, land = feed(spark, tmp_path, rows)
    arrive("a", (2024, 1), (2024, 1), (None, 5))
    arrive("a", (2025, 2))
    first = [(None, 5), (2024, 1), (2024, 1), (2025, 2)]
    assert land("a", "p1") == first
    arrive("b", (2024, 1), (2025, 7))
    both = sorted([*first, (2024, 1), (2025, 7)], key=lambda r: (r[0] is not None, r))
    assert land("b", "p2") == both
    arrive("a", (2025, 3))
    assert land("a", "lost") == sorted([*both, (2025, 3)], key=lambda r: (r[0] is not None, r))
    assert land("b", "lost too") == sorted([*both, (2025, 3)], key=lambda r: (r[0] is not None, r))


def test_a_file_written_again_loses_the_seasons_it_no_longer_has(spark, tmp_path, rows):
    from panelworks.sources.tables import SOURCE_FILE, land_files

    path = str(tmp_path / "out")

    def land(*values):
        df = spark.createDataFrame(list(values), f"{SOURCE_FILE} string, year int, v int")
        land_files(df, df, path)
        return rows(spark.read.parquet(path), "year", "v")

    assert land(("x", 2024, 1), ("x", None, 2), ("y", 2024, 3)) == [(None, 2), (2024, 1), (2024, 3)]
    assert land(("x", 2025, 4)) == [(2024, 3), (2025, 4)]
    assert set(r["part"][:5] for r in spark.read.parquet(path).select("part").collect()) == {"file-"}


def test_a_cleaning_that_forgets_the_file_is_refused(spark, tmp_path):
    import pytest

    from panelworks.sources.tables import SOURCE_FILE, land_files

    df = spark.createDataFrame([("x", 2024)], f"{SOURCE_FILE} string, year int")
    with pytest.raises(ValueError, match=SOURCE_FILE):
        land_files(df, df.drop(SOURCE_FILE), str(tmp_path / "out"))
