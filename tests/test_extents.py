"""Files pruned by the times they hold, and lookups by key in a merged table."""

import os
from datetime import timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F

from helpers import ONE, at
from slotwise import Period
from slotwise.operators import merge_staged, read_target
from slotwise.sources import (
    files_of_period,
    in_period,
    read_extents,
    reading_schema,
    scan_csv,
    stage,
    time_extents,
    update_extents,
    with_day_parts,
)

HEADER = "ts,id,x\n"
SECOND = Period.of("2024-01-02", "2024-01-03")


def day_file(folder, name, *lines):
    (folder / name).write_text(HEADER + "".join(f"{line}\n" for line in lines))


@pytest.fixture
def source(spark, tmp_path):
    folder = tmp_path / "readings of + days"
    folder.mkdir()
    for day in range(1, 5):
        day_file(folder, f"day {day}.csv", f"2024-01-0{day} 00:00:00,1,{day}", f"2024-01-0{day} 23:00:00,2,{day}.5")
    day_file(folder, "empty.csv")
    return folder


def update(spark, folder):
    scan = partial(scan_csv, spark, schema=reading_schema(ONE))
    return scan, update_extents(spark, f"{folder}/*.csv", scan, ONE, f"{folder.parent}/extents")


def names(paths):
    return [os.path.basename(p) for p in paths]


def test_a_period_opens_only_its_files(spark, source):
    scan, read = update(spark, source)
    assert len(read) == 5
    extents = read_extents(spark, f"{source.parent}/extents")
    files = files_of_period(extents, SECOND)
    assert names(files) == ["day 2.csv"]
    assert names(files_of_period(extents, SECOND, closed_end=True)) == ["day 2.csv", "day 3.csv"]
    pruned, whole = (in_period(scan(f), ONE, SECOND, True) for f in (files_of_period(extents, SECOND, True), f"{source}/*.csv"))
    assert sorted(pruned.collect()) == sorted(whole.collect()) and pruned.count() == 3
    assert len(pruned.inputFiles()) == 2
    assert files_of_period(extents, Period.of("2030-01-01", "2030-01-02")) == []


def test_only_new_and_changed_files_are_read_again(spark, source):
    update(spark, source)
    assert names(update(spark, source)[1]) == ["empty.csv"]
    day_file(source, "day 4.csv", "2024-01-02 12:00:00,1,4", "2024-01-09 00:00:00,1,4")
    day_file(source, "day 5.csv", "2024-01-05 00:00:00,1,5")
    (source / "day 1.csv").unlink()
    assert names(update(spark, source)[1]) == ["day 4.csv", "day 5.csv", "empty.csv"]
    extents = read_extents(spark, f"{source.parent}/extents")
    assert sorted(names(r["path"] for r in extents.collect())) == [f"day%20{i}.csv" for i in range(2, 6)]
    assert names(files_of_period(extents, SECOND)) == ["day 2.csv", "day 4.csv"]


def test_rows_without_a_time_are_found_if_asked_for(spark, source):
    day_file(source, "untimed.csv", ",1,2")
    update(spark, source)
    extents = read_extents(spark, f"{source.parent}/extents")
    assert names(files_of_period(extents, SECOND)) == ["day 2.csv"]
    assert names(files_of_period(extents, SECOND, keep_untimed=True)) == ["day 2.csv", "untimed.csv"]


def test_extents_of_a_file(spark, source):
    found = {os.path.basename(r["path"]): r for r in time_extents(scan_csv(spark, f"{source}/*.csv", reading_schema(ONE)), ONE).collect()}
    first = found["day%201.csv"]
    assert (first["first"], first["last"], first["untimed"]) == (at("2024-01-01T00:00:00"), at("2024-01-01T23:00:00"), 0)


def rows_scanned(df) -> int:
    """Rows that the scan of a frame, which has run, handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_key_is_found_in_few_pages(spark, tmp_path):
    """One device of 40,000 in a table merged twice, whose rows came in no order."""
    rows = spark.range(0, 80_000, 2).select(
        F.col("id"), F.lit(at("2024-01-02T00:00:00")).cast("timestamp_ntz").alias("ts"), F.rand(1).alias("x")
    )
    path = f"{tmp_path}/table"
    for part, mixed in enumerate((rows.where("id % 6 = 0"), rows.where("id % 6 <> 0"))):
        merge_staged(stage(mixed.orderBy("x"), str(tmp_path), f"rows{part}"), path, ["ts", "id"], "ts", lookup=["id"])
    table = read_target(spark, path, with_day_parts(rows, "ts").schema)
    assert table.count() == 40_000 and table.select("id").distinct().count() == 40_000
    wanted = table.where("id = 41000")
    assert [r["id"] for r in wanted.collect()] == [41_000]
    assert rows_scanned(wanted) <= 20_000  # a page has 20,000 rows at most
    assert rows_scanned(table.where("id = 41001")) == 0  # within the ends of a page, but the Bloom filter knows better
    assert wanted.select(F.max("ts") - F.min("ts")).first()[0] == timedelta(0)
