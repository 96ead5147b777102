"""The baseline kept day by day, against the one over all readings at once."""

import math
import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import ONE, at, daily_at_midnight, one_metric
from slotwise import Period, SeriesSpec
from slotwise.operators import (
    daily_state,
    entity_profiles,
    hourly_baseline,
    moving_windows,
    read_state,
    state_profiles,
    update_state,
)
from slotwise.operators.state import spans

QUARTERS = SeriesSpec(entity=("site", "id"), ts="ts", metrics=("x", "y"), slot=timedelta(minutes=15))
PERIOD = Period.of("2024-01-01", "2024-01-09")
SCHEMA = "site string, id int, ts timestamp_ntz, x double, y double"


def random_rows(seed: int, n: int) -> list[tuple]:
    """Readings with gaps, repeated slots, missing cells, times off the slots and outside of the period."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        ts = PERIOD.start + timedelta(minutes=15 * r.randrange(-96, 9 * 96), seconds=r.choice([0, 0, 0, 1]))
        rows.append((r.choice("ab"), r.randrange(3), ts, r.choice([None, 1e9 + r.random()]), r.choice([2.5, r.random()])))
    return [*rows, ("a", None, PERIOD.start, 1.0, 1.0), ("a", 1, None, 1.0, 1.0), ("b", 7, PERIOD.start, None, math.nan)]


def by_hour(frame, spec, period):
    keys = [*spec.entity, "hour"]
    rows = hourly_baseline(frame, spec, period).toPandas()
    return rows.sort_values(keys).reset_index(drop=True)


def assert_close(ours, theirs):
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, rtol=1e-9, atol=1e-6)


@pytest.mark.parametrize("seed", range(3))
def test_states_of_days_make_the_baseline_of_the_period(spark, tmp_path, seed):
    readings = spark.createDataFrame(random_rows(seed, 3000), SCHEMA).repartition(5)
    path = str(tmp_path / "state")
    for end in ("2024-01-04", "2024-01-09"):
        update_state(readings, QUARTERS, Period.of("2024-01-01", end), path)
    states = read_state(spark, path, daily_state(readings, QUARTERS, PERIOD).schema, PERIOD)
    inside = readings.where(F.col("ts").between(F.lit(PERIOD.start), F.lit(PERIOD.end - timedelta(seconds=1))))
    whole = entity_profiles(inside.where("ts is not null"), QUARTERS, PERIOD).where("readings > 0")
    assert_close(by_hour(state_profiles(states, QUARTERS), QUARTERS, PERIOD), by_hour(whole, QUARTERS, PERIOD))


def test_equal_values_of_several_days_do_not_deviate(spark):
    readings = one_metric(spark, daily_at_midnight([0.1] * 7))
    found = hourly_baseline(state_profiles(daily_state(readings, ONE, PERIOD), ONE), ONE, PERIOD).where("hour = 0")
    assert found.select("x_stddev").first()[0] == 0.0


def test_only_days_that_are_absent_are_read(spark, tmp_path):
    rows = daily_at_midnight([1.0, 2.0, 3.0, 4.0])
    path = str(tmp_path / "state")
    first, longer = Period.of("2024-01-01", "2024-01-03"), Period.of("2024-01-01", "2024-01-05")
    assert update_state(one_metric(spark, rows[:2]), ONE, first, path) == [date(2024, 1, 1), date(2024, 1, 2)]
    changed = one_metric(spark, [(1, "2024-01-01T00:00:00", 9.0), *rows[1:]])
    assert update_state(changed, ONE, longer, path) == [date(2024, 1, 3), date(2024, 1, 4)]
    schema = daily_state(changed, ONE, longer).schema
    sums = {r["date"].day: r["_state"]["x"]["s"] for r in read_state(spark, path, schema, longer).collect()}
    assert sums == {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0}
    assert update_state(changed, ONE, longer, path, refresh=[date(2024, 1, 1)]) == [date(2024, 1, 1)]
    sums = {r["date"].day: r["_state"]["x"]["s"] for r in read_state(spark, path, schema, first).collect()}
    assert sums == {1: 9.0, 2: 2.0}


def test_days_without_readings_and_no_table(spark, tmp_path):
    path = str(tmp_path / "state")
    none = one_metric(spark, [])
    schema = daily_state(none, ONE, PERIOD).schema
    assert read_state(spark, path, schema, PERIOD).count() == 0
    assert len(update_state(none, ONE, PERIOD, path)) == PERIOD.days
    assert state_profiles(read_state(spark, path, schema, PERIOD), ONE).count() == 0


def test_states_start_at_midnight(spark, tmp_path):
    with pytest.raises(ValueError, match="midnight"):
        update_state(one_metric(spark, []), ONE, Period(at("2024-01-01T06:00:00"), PERIOD.end), str(tmp_path / "state"))


def test_days_in_a_row_make_one_span():
    found = spans([date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 5)])
    assert found == [Period.of("2024-01-01", "2024-01-03"), Period.of("2024-01-05", "2024-01-06")]


@pytest.mark.parametrize(("days", "step"), [(1, 1), (3, 2), (2, 3), (8, 1), (9, 1)])
def test_windows_hold_the_days_they_name(spark, days, step):
    states = spark.createDataFrame([(PERIOD.start.date() + timedelta(days=i),) for i in range(PERIOD.days)], "date date")
    found = {(r["_from"], r["date"]) for r in moving_windows(states, PERIOD, days, step).collect()}
    starts = [PERIOD.start.date() + timedelta(days=i) for i in range(0, PERIOD.days - days + 1, step)]
    assert found == {(s, s + timedelta(days=i)) for s in starts for i in range(days)}


def test_a_state_needs_one_shuffle_of_partial_sums(spark):
    plan = daily_state(one_metric(spark, daily_at_midnight([1.0])), ONE, PERIOD)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("partial_sum") > plan.index("Exchange")
