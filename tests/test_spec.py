from datetime import date, datetime, timedelta, timezone

import pytest

from slotwise import Period, SeriesSpec, clean
from slotwise.operators import missing_slots
from slotwise.operators.baseline import JoinLimits


def test_defaults_follow_the_last_metric():
    spec = SeriesSpec(entity="id", ts="ts", metrics=["a", "b"])
    assert spec.entity == ("id",)
    assert spec.summary_metrics == ("b",)
    assert spec.anomaly_metric == "b"
    assert (spec.mask_sigma, spec.anomaly_sigma) == (3.0, 2.0)
    assert spec.cleaned_columns == [
        "id", "hour", "ts", "a", "b", "a_mean", "b_mean", "a_stddev", "b_stddev",
    ]


@pytest.mark.parametrize("minutes", [0, -60, 7, 50, 2000])
def test_slot_must_divide_a_day(minutes):
    with pytest.raises(ValueError):
        SeriesSpec(entity="id", ts="ts", metrics="x", slot=timedelta(minutes=minutes))


def test_an_entity_is_needed():
    with pytest.raises(ValueError):
        SeriesSpec(entity=(), ts="ts", metrics="x")


def test_period_counts_whole_days():
    assert Period.of("2022-03-01", date(2022, 4, 1)).days == 31
    assert Period.of("2022-03-01", "2022-03-02T12:00:00").days == 1
    assert Period.of("2022-03-02", "2022-03-01").days == 0
    assert Period.of(datetime(2022, 3, 1, 0, 30), "2022-03-02").days == 0


def test_zoned_times_are_refused():
    with pytest.raises(ValueError):
        Period.of(datetime(2022, 3, 1, tzinfo=timezone.utc), "2022-03-02")


@pytest.mark.parametrize("name", ["hour", "date", "_x", "a.b", "a`b"])
def test_names_that_results_use_are_refused(name):
    with pytest.raises(ValueError, match="not usable"):
        SeriesSpec(entity="id", ts="ts", metrics=name)
    with pytest.raises(ValueError, match="not usable"):
        SeriesSpec(entity=("id", name), ts="ts", metrics="x")


def test_periods_start_on_whole_seconds():
    with pytest.raises(ValueError):
        Period.of("2022-03-01T00:00:00.5", "2022-03-02")


@pytest.mark.parametrize("name", ["Hour", "DATE", "day", "Year", "month", "outlier", "copies"])
def test_reserved_names_in_any_case(name):
    with pytest.raises(ValueError, match="not usable"):
        SeriesSpec(entity=name, ts="ts", metrics="x")


@pytest.mark.parametrize(
    "names", [(("id",), "ts", ("x", "x_mean")), (("id", "ID"), "ts", ("x",)), (("id",), "X", ("x",)), (("zscore_x",), "ts", ("x",))]
)
def test_names_must_differ_from_each_other_and_from_what_is_derived(names):
    entity, ts, metrics = names
    with pytest.raises(ValueError, match="must differ"):
        SeriesSpec(entity=entity, ts=ts, metrics=metrics)


@pytest.mark.parametrize("name", ["n", "seen", "stats", "first", "start", "number", "rows", "entities", "key"])
def test_other_names_work(spark, name):
    spec = SeriesSpec(entity=name, ts="ts", metrics="x")
    df = spark.createDataFrame([(4, datetime(2024, 5, 1, 3), 2.0)], f"{name} int, ts timestamp_ntz, x double")
    days = Period.of("2024-05-01", "2024-05-02")
    for limits in (JoinLimits(), JoinLimits(broadcast_bytes=0, task_rows=1)):
        assert clean(df, spec, days, limits=limits).where("x = 2").count() == 1
    assert missing_slots(df, spec, days).count() == 23
