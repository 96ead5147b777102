from datetime import date
from statistics import mean, stdev

import pytest

from helpers import ONE, DEVICES, at
from slotwise import SeriesSpec
from slotwise.operators import daily_summary

POWER = SeriesSpec(entity="device_id", ts="timestamp", metrics="power")


def test_daily_statistics(spark):
    """Three devices over a turn of the year; the last reading of a day is one second before midnight."""
    given = {
        (date(2023, 12, 31), 40): [2.0, 2.0, 8.0, 4.0],
        (date(2024, 1, 1), 40): [-3.0],
        (date(2024, 1, 1), 41): [0.5, 1.5],
        (date(2024, 1, 2), 55): [10.0, 10.0, 10.0],
    }
    times = ("00:00:00", "06:30:00", "12:00:00", "23:59:59")
    rows = [(at(f"{d}T{t}"), i, x) for (d, i), xs in given.items() for t, x in zip(reversed(times), xs)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, device_id int, power double")
    result = daily_summary(df, POWER)
    assert result.columns == [
        "date", "device_id",
        "power_mean", "power_min", "power_max", "power_stddev",
    ]
    found = {(r.date, r.device_id): tuple(r)[2:] for r in result.collect()}
    assert found.keys() == given.keys()
    for key, xs in given.items():
        spread = pytest.approx(stdev(xs)) if len(xs) > 1 else None
        assert found[key] == (pytest.approx(mean(xs)), min(xs), max(xs), spread)


def test_empty_cells_are_skipped_and_single_rows_have_no_deviation(spark):
    df = spark.createDataFrame(
        [(1, at("2022-03-01T00:00:00"), 5.0), (1, at("2022-03-01T01:00:00"), None), (2, at("2022-03-01"), None)],
        "id int, ts timestamp_ntz, x double",
    )
    found = {r.id: tuple(r)[2:] for r in daily_summary(df, ONE).collect()}
    assert found == {1: (5.0, 5.0, 5.0, None), 2: (None, None, None, None)}


def test_the_last_metric_is_summarised_unless_others_are_named(spark):
    assert DEVICES.summary_metrics == ("power",)
    both = SeriesSpec(entity="id", ts="ts", metrics=("x", "y"), summary_metrics=("x", "y"))
    df = spark.createDataFrame([(1, at("2022-03-01"), 5.0, 6.0)], "id int, ts timestamp_ntz, x double, y double")
    row = daily_summary(df, both).first()
    assert (row.x_mean, row.y_mean) == (5.0, 6.0)


def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    zone("Pacific/Auckland")
    df = spark.createDataFrame([(1, at("2022-03-01T23:30:00"), 1.0)], "id int, ts timestamp_ntz, x double")
    assert daily_summary(df, ONE).first().date == date(2022, 3, 1)
