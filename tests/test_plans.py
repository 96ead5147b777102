"""What the executed plans look like, and how work is spread over tasks."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.queries import PERIOD, series
from helpers import ONE, assert_frames, at, brute_fill, one_metric
from slotwise import Period, SeriesSpec, clean
from slotwise.functions import slot_floor
from slotwise.operators import (
    anomalies,
    daily_summary,
    expand_gaps,
    expected_grid,
    expected_slots,
    fill_gaps,
    measured_profiles,
    missing_slots,
    upsert,
)
from slotwise.operators.baseline import JoinLimits, counted_profiles, gathered, heavy_entities, partitions_for
from slotwise.sources import in_period, scan_parquet

DATA = "/root/testdata/sf0.001"
SHUFFLED = JoinLimits(broadcast_bytes=0)


def executed(df) -> str:
    """The final adaptive plan, after running it."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def exchanges(plan: str) -> int:
    """Shuffles that really ran."""
    return sum("Exchange " in line and "Reused" not in line and "Broadcast" not in line for line in plan.splitlines())


def scans(plan: str, of: str = "") -> int:
    """Scans (of a file whose path holds ``of``) outside reused exchanges."""
    lines, count, hidden = plan.splitlines(), 0, None
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-"))
        if hidden is not None and depth > hidden:
            continue
        hidden = depth if "ReusedExchange" in line else None
        count += "FileScan" in line and of in line
    return count


@pytest.fixture(scope="module")
def sensor_file(spark, tmp_path_factory):
    """Events as readings on the slot grid, several per slot."""
    path = str(tmp_path_factory.mktemp("sensor") / "readings")
    df = scan_parquet(spark, f"{DATA}/events.parquet")
    spec = SeriesSpec(entity="user_id", ts="slot_ts", metrics=("v", "mx", "n"))
    df.select(
        "user_id",
        slot_floor("ts", spec, PERIOD).alias("slot_ts"),
        F.col("value").alias("v"),
        F.col("value").alias("mx"),
        F.col("value").alias("n"),
        "props",
    ).write.parquet(path)
    return path


@pytest.fixture
def sensor(spark, sensor_file):
    return in_period(scan_parquet(spark, sensor_file), series("user_id"), PERIOD)


def test_gate_and_profiles_are_one_pass(spark, sensor):
    plan = executed(counted_profiles(sensor, series("user_id"), PERIOD))
    assert scans(plan) == 1 and exchanges(plan) == 2
    assert "props" not in plan
    assert "PushedFilters: [IsNotNull(slot_ts)" in plan


def test_few_entities_move_no_readings(sensor):
    plan = executed(clean(sensor, series("user_id"), PERIOD))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 1
    assert exchanges(plan) == 1  # of profiles, for the gaps
    assert scans(plan, "sensor") == 1 and scans(plan, "seasons") == 2
    assert "props" not in plan
    assert "PushedFilters: [IsNotNull(slot_ts)" in plan


def test_many_entities_move_the_readings_once(sensor):
    plan = executed(clean(sensor, series("user_id"), PERIOD, limits=SHUFFLED))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan
    assert plan.count("ShuffledHashJoin") == 1
    assert scans(plan, "sensor") == 1
    assert exchanges(plan) == 3  # readings, and profiles for the join and for the gaps


def test_heavy_entities_cost_no_pass_over_the_readings(sensor, tmp_path):
    limits = JoinLimits(broadcast_bytes=0, task_rows=1)
    few = sensor.where("user_id < 3")
    profiles = measured_profiles(few, series("user_id"), PERIOD, str(tmp_path))
    assert heavy_entities(profiles, series("user_id"), limits) is not None
    plan = executed(clean(few, series("user_id"), PERIOD, profiles=profiles, limits=limits))
    assert scans(plan, "sensor") == 1 and plan.count("ShuffledHashJoin") == 1


def test_profiles_too_large_to_hash_are_sorted(spark, sensor):
    limits = JoinLimits(broadcast_bytes=0, build_bytes=-1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(clean(sensor, series("user_id"), PERIOD, limits=limits))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 1
    assert scans(plan, "sensor") == 1


def test_a_rollup_is_computed_once_for_the_profiles_and_once_for_the_rows(spark):
    plan = executed(entry.queries()["mask_outliers_by_user"](spark, DATA))
    assert scans(plan, "events") == 1


def test_profiles_count_exactly(spark, tmp_path):
    rows = [(i, f"2024-01-01T{h:02}:{m}:00", float(h)) for i in range(7) for h in range(24) for m in ("00", "30")]
    df = one_metric(spark, rows + rows[:100] + [(None, "2024-01-01T00:00:00", 1.0), (9, None, 1.0), (8, "2024-01-01T00:00:00", None)])
    silent = spark.createDataFrame([(50,), (3,), (None,)], "id int")
    found = measured_profiles(df, ONE, DAYS, str(tmp_path), silent)
    assert found.entities == 10
    assert found.largest == 96  # the first two entities have all their rows twice
    assert (found.audit.rows, found.audit.off_slot) == (len(rows) + 103, 7 * 24 + 50)
    assert found.audit.missing == {"id": 1, "ts": 1, "x": 1}
    assert found.bytes == sum(64 + len(str(i)) + 24 * 48 for i in [*range(10)][:7] + [8, 9, 50])
    readings = {r["id"]: r["readings"] for r in found.frame.collect()}
    assert readings == {0: 48, 1: 48, 2: 26, 3: 24, 4: 24, 5: 24, 6: 24, 8: 1, 9: 0, 50: 0}


def test_the_audit_shuffles_only_one_row_per_task(spark, sensor):
    from slotwise.operators import audit

    plan = executed(audit(sensor, series("user_id"), PERIOD))
    assert exchanges(plan) == 1 and "SinglePartition" in plan


def test_daily_summary_reads_only_what_it_needs(spark, sensor, tmp_path):
    spec = series("user_id")
    path = str(tmp_path / "cleaned")
    clean(sensor, spec, PERIOD).write.parquet(path)
    plan = executed(daily_summary(scan_parquet(spark, path), spec))
    assert "ReadSchema: struct<user_id:bigint,slot_ts:timestamp_ntz,v:double>" in plan
    assert exchanges(plan) == 1


def test_anomalies_need_no_shuffle(spark, sensor, tmp_path):
    spec = series("user_id")
    path = str(tmp_path / "cleaned")
    clean(sensor, spec, PERIOD).write.parquet(path)
    assert exchanges(executed(anomalies(scan_parquet(spark, path), spec))) == 0


def test_expansion_joins_nothing(sensor):
    assert "Join" not in executed(expand_gaps(sensor, series("user_id"), PERIOD))


def test_upsert_joins_by_key(spark):
    df = spark.range(100).select("id", F.rand(1).alias("x"))
    plan = upsert(df, df.where("id > 50"), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "NestedLoop" not in plan


# One device holds two thirds of the readings, all copies of a few rows.
HOT = [(1, f"2024-01-01T0{h}:00:00", float(h)) for h in range(3)] * 400
REST = [(i, f"2024-01-0{d}T05:00:00", float(i + d)) for i in range(2, 152) for d in range(1, 5)]
DAYS = Period.of("2024-01-01", "2024-01-06")


@pytest.fixture
def skewed(spark):
    return one_metric(spark, HOT + REST).repartition(16)


def test_a_heavy_entity_is_spread(spark, skewed, tmp_path):
    limits = JoinLimits(broadcast_bytes=0, task_rows=50)
    profiles = measured_profiles(skewed, ONE, DAYS, str(tmp_path))
    parts = heavy_entities(profiles, ONE, limits)
    assert [tuple(r) for r in parts.collect()] == [(1, 24)]
    partitions = partitions_for(profiles, limits)
    assert partitions == (len(HOT) + len(REST)) // 50
    spread = gathered(skewed, ONE, parts, partitions)
    loads = [r["count"] for r in spread.where("id = 1").groupBy("_part").count().collect()]
    assert len(loads) >= 12 and max(loads) < len(HOT) / 6
    biggest = spread.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest < (len(HOT) + len(REST)) / 2


@pytest.mark.parametrize("task_rows", [1, 50, 10**6])
@pytest.mark.parametrize("broadcast", [0, 1 << 20])
def test_skew_changes_no_result(spark, skewed, task_rows, broadcast):
    limits = JoinLimits(broadcast_bytes=broadcast, task_rows=task_rows)
    rows = [(i, at(t), x) for i, t, x in HOT + REST]
    assert_frames(fill_gaps(skewed, ONE, DAYS, limits=limits), brute_fill(rows, ONE, DAYS), ONE)


def test_the_number_of_tasks_follows_the_rows(spark, skewed, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        profiles = measured_profiles(skewed, ONE, DAYS, str(tmp_path))
        assert partitions_for(profiles, JoinLimits(task_rows=100)) == 18
        assert partitions_for(profiles, JoinLimits()) == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_number_of_tasks_follows_the_slots_to_come(spark, skewed, monkeypatch):
    monkeypatch.setattr("slotwise.operators.spine.TASK_SLOTS", 1000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        grid = expected_grid(skewed.select("id").distinct(), ONE, DAYS)
        assert grid.rdd.getNumPartitions() == -(-151 * 5 * 24 // 1000) == 19
        gaps = fill_gaps(skewed, ONE, DAYS).where("x is null")
        assert tasks_with_rows(gaps) >= 15
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def tasks_with_rows(df):
    return df.groupBy(F.spark_partition_id()).count().count()


def test_one_entity_is_made_by_several_tasks(spark):
    spec = SeriesSpec(entity="id", ts="ts", metrics="x", slot=timedelta(minutes=1))
    year = Period.of("2023-01-01", "2024-01-01")
    one = one_metric(spark, [(1, "2023-01-01", 1.0)])
    grid = expected_grid(one.select("id"), spec, year)
    assert grid.count() == 365 * 1440 and tasks_with_rows(grid) > 2
    gaps = missing_slots(one, spec, year)
    assert gaps.count() == 365 * 1440 - 1 and tasks_with_rows(gaps) > 2
    assert tasks_with_rows(expected_slots(spark, spec, year)) > 2


def test_an_upsert_sorts_nothing_and_shuffles_each_side_once(spark, tmp_path):
    from slotwise.operators.upsert import key_span, touched
    from slotwise.sources import with_day_parts

    rows = spark.range(200).selectExpr("id", "date_add(date'2024-01-01', cast(id % 9 as int)) as date", "1.0D as x")
    rows = with_day_parts(rows, "date")
    rows.write.partitionBy("year", "month", "day").parquet(str(tmp_path / "t"))
    target = spark.read.schema(rows.schema).parquet(str(tmp_path / "t"))
    found = key_span(rows, ["date", "id"], "date")
    assert (found["keys"], found["copies"], str(found["first"]), str(found["last"])) == (200, 1, "2024-01-01", "2024-01-09")
    for hash_build in (True, False):
        plan = executed(upsert(touched(target, rows, found["first"], found["last"]), rows, ["date", "id"], hash_build))
        assert "Sort " not in plan and "SortMergeJoin" not in plan and "SortAggregate" not in plan
        shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "year#" not in x.split("hashpartitioning(")[1].split(")")[0]]
        assert len(shuffles) == (2 if hash_build else 0)


def test_many_map_tasks_send_few_rows_per_heavy_entity(spark):
    """The profile aggregate combines before it shuffles."""
    rows = spark.range(200_000, numPartitions=8).select(
        F.lit(1).alias("id"), F.lit("2024-01-01 03:00:00").cast("timestamp_ntz").alias("ts"), F.lit(2.0).alias("x")
    )
    from slotwise.operators import entity_profiles

    df = entity_profiles(rows, ONE, DAYS)
    df.collect()
    assert "partial_sum" in df._jdf.queryExecution().executedPlan().toString()
    assert df.first().readings == 200_000


def test_long_periods_use_several_words(spark):
    spec = SeriesSpec(entity="id", ts="ts", metrics="x", slot=timedelta(minutes=15))
    period = Period.of("2024-01-01", "2024-02-20")
    rows = [(1, period.start + i * spec.slot, 1.0) for i in range(0, period.days * 96, 97)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, x double")
    gaps = expand_gaps(df, spec, period)
    assert gaps.count() == period.days * 96
    assert gaps.where("x is not null").count() == len(rows)
