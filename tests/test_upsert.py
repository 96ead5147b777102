import os
import shutil
import sys
import threading
import time
from datetime import date
from pathlib import Path

import pytest

from slotwise.operators import RepeatedKeys, read_target, upsert, upsert_table
from slotwise.operators.upsert import merging_folder
from slotwise.operators.upsert import merge_staged
from slotwise.sources import Lease, LeaseHeld, LeaseLost, shared_folder, with_day_parts

upsert_module = sys.modules["slotwise.operators.upsert"]

SCHEMA = "date date, id int, x double"
KEYS = ["date", "id"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def day(n, i, x):
    return (date(2024, 1, n), i, x)


def table(spark, path):
    schema = with_day_parts(spark.createDataFrame([], SCHEMA), "date").schema
    return rows(read_target(spark, str(path), schema).select("date", "id", "x"))


def files(path):
    return {str(f.relative_to(path)) for f in Path(path).rglob("*.parquet")}


def test_equal_keys_are_replaced_and_new_ones_added(spark):
    target = spark.createDataFrame([day(1, 1, 1.0), day(1, 2, 2.0)], SCHEMA)
    staged = spark.createDataFrame([day(1, 2, 20.0), day(1, 3, 30.0)], SCHEMA)
    wanted = [day(1, 1, 1.0), day(1, 2, 20.0), day(1, 3, 30.0)]
    once = upsert(target, staged, KEYS)
    assert rows(once) == wanted
    assert rows(upsert(once, staged, KEYS)) == wanted


def test_a_table_is_made_on_first_use_and_reruns_change_nothing(spark, tmp_path):
    path = tmp_path / "table"
    first = spark.createDataFrame([day(1, 1, 1.0), day(1, 2, 2.0), day(3, 1, 3.0)], SCHEMA)
    second = spark.createDataFrame([day(1, 2, 20.0), day(2, 1, 5.0)], SCHEMA)
    assert table(spark, path) == []
    upsert_table(first, str(path), KEYS, "date")
    assert table(spark, path) == [day(1, 1, 1.0), day(1, 2, 2.0), day(3, 1, 3.0)]
    wanted = [day(1, 1, 1.0), day(1, 2, 20.0), day(2, 1, 5.0), day(3, 1, 3.0)]
    for _ in range(2):
        upsert_table(second, str(path), KEYS, "date")
        assert table(spark, path) == wanted


def test_the_first_load_joins_nothing(spark, tmp_path):
    staged = spark.createDataFrame([day(1, 1, 1.0)], SCHEMA)
    target = read_target(spark, str(tmp_path / "none"), staged.schema)
    plan = upsert(target, staged, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_only_touched_days_are_rewritten(spark, tmp_path):
    path = tmp_path / "table"
    upsert_table(spark.createDataFrame([day(n, 1, 0.0) for n in range(1, 6)], SCHEMA), str(path), KEYS, "date")
    before = files(path)
    upsert_table(spark.createDataFrame([day(2, 1, 9.0), day(4, 2, 9.0)], SCHEMA), str(path), KEYS, "date")
    kept = before & files(path)
    assert {f.split("/")[2] for f in kept} == {"day=1", "day=3", "day=5"}
    assert {f.split("/")[2] for f in files(path)} == {f"day={n}" for n in range(1, 6)}
    assert table(spark, path) == [
        day(1, 1, 0.0), day(2, 1, 9.0), day(3, 1, 0.0), day(4, 1, 0.0), day(4, 2, 9.0), day(5, 1, 0.0),
    ]


def test_repeated_keys_stop_the_upsert_before_the_target(spark, tmp_path):
    path = tmp_path / "table"
    twice = spark.createDataFrame([day(1, 1, 1.0), day(1, 1, 2.0)], SCHEMA)
    with pytest.raises(RepeatedKeys):
        upsert_table(twice, str(path), KEYS, "date")
    assert not path.exists()


def test_no_updates_leave_the_table_alone(spark, tmp_path):
    path = tmp_path / "table"
    upsert_table(spark.createDataFrame([day(1, 1, 1.0)], SCHEMA), str(path), KEYS, "date")
    upsert_table(spark.createDataFrame([], SCHEMA), str(path), KEYS, "date")
    assert table(spark, path) == [day(1, 1, 1.0)]


def test_the_day_must_be_part_of_the_key(spark, tmp_path):
    with pytest.raises(ValueError):
        upsert_table(spark.createDataFrame([day(1, 1, 1.0)], SCHEMA), str(tmp_path / "t"), ["id"], "date")


def test_staging_leaves_nothing_behind(spark, tmp_path):
    work = tmp_path / "work"
    upsert_table(spark.createDataFrame([day(1, 1, 1.0)], SCHEMA), str(tmp_path / "t"), KEYS, "date", str(work))
    assert table(spark, tmp_path / "t") == [day(1, 1, 1.0)]
    assert [x for x in work.rglob("*") if x.is_file()] == [] and not Path(merging_folder(str(tmp_path / "t"))).exists()
    before = set(Path(shared_folder(spark)).iterdir())
    upsert_table(spark.createDataFrame([day(1, 2, 1.0)], SCHEMA), str(tmp_path / "t"), KEYS, "date")
    assert set(Path(shared_folder(spark)).iterdir()) == before


def test_a_lost_driver_loses_no_row(spark, tmp_path, monkeypatch):
    """The merge stops when all is written but not moved; the table's day is gone by then."""
    path = tmp_path / "t"
    upsert_table(spark.createDataFrame([day(1, 1, 1.0), day(1, 2, 2.0)], SCHEMA), str(path), KEYS, "date")
    finish = upsert_module.finish_merge
    calls = []

    def stop(*args):
        calls.append(args)
        if len(calls) == 1:
            shutil.rmtree(path / "year=2024")
            raise KeyboardInterrupt
        finish(*args)

    monkeypatch.setattr(upsert_module, "finish_merge", stop)
    with pytest.raises(KeyboardInterrupt):
        upsert_table(spark.createDataFrame([day(1, 2, 9.0)], SCHEMA), str(path), KEYS, "date")
    monkeypatch.setattr(upsert_module, "finish_merge", finish)
    upsert_table(spark.createDataFrame([day(1, 3, 3.0)], SCHEMA), str(path), KEYS, "date")
    assert table(spark, path) == [day(1, 1, 1.0), day(1, 2, 9.0), day(1, 3, 3.0)]


@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_batches_that_share_a_day_are_all_kept(spark, tmp_path, file_format):
    path = str(tmp_path / "t")
    for rows_ in ([day(1, 1, 1.0)], [day(1, 2, 2.0), day(2, 1, None)], [day(1, 1, 5.0)]):
        upsert_table(spark.createDataFrame(rows_, SCHEMA), path, KEYS, "date", file_format=file_format)
    schema = with_day_parts(spark.createDataFrame([], SCHEMA), "date").schema
    found = rows(read_target(spark, path, schema, file_format).select("date", "id", "x"))
    assert found == [day(1, 1, 5.0), day(1, 2, 2.0), day(2, 1, None)]


def test_key_columns_of_any_name(spark, tmp_path):
    path = str(tmp_path / "t")
    for x in (1.0, 2.0):
        df = spark.createDataFrame([(date(2024, 1, 1), 1, x)], "date date, copies int, first double")
        upsert_table(df, path, ["date", "copies"], "date")
    schema = with_day_parts(df, "date").schema
    assert [r["first"] for r in read_target(spark, path, schema).collect()] == [2.0]


def test_a_second_merge_does_not_touch_one_that_has_begun(spark, tmp_path, monkeypatch):
    path, beside = str(tmp_path / "t"), Path(merging_folder(str(tmp_path / "t")))
    upsert_table(spark.createDataFrame([day(1, 1, 1.0)], SCHEMA), path, KEYS, "date")
    write, finish, met = upsert_module.write_partitions, upsert_module.finish_merge, []

    def second(when):
        before = {f for f in beside.rglob("*") if f.is_file()}
        with pytest.raises(LeaseHeld):
            merge_staged(spark.createDataFrame([day(1, 3, 30.0)], SCHEMA), path, KEYS, "date")
        assert {f for f in beside.rglob("*") if f.is_file()} == before
        met.append(when)

    def writing(*args, **options):
        second("before it has written")
        write(*args, **options)
        second("before it has moved")

    def finishing(*args):
        finish(*args)
        second("after it has moved")

    monkeypatch.setattr(upsert_module, "write_partitions", writing)
    monkeypatch.setattr(upsert_module, "finish_merge", finishing)
    merge_staged(spark.createDataFrame([day(1, 2, 20.0)], SCHEMA), path, KEYS, "date")
    monkeypatch.undo()
    assert len(met) == 3 and not beside.exists()
    merge_staged(spark.createDataFrame([day(1, 3, 30.0)], SCHEMA), path, KEYS, "date")
    assert table(spark, path) == [day(1, 1, 1.0), day(1, 2, 20.0), day(1, 3, 30.0)]


def test_a_merge_may_wait_for_another(spark, tmp_path):
    path = str(tmp_path / "t")
    with Lease(spark, merging_folder(path)) as first:
        threading.Timer(1.5, lambda: os.unlink(tmp_path / "t-merging" / "_lease")).start()
        merge_staged(spark.createDataFrame([day(1, 1, 1.0)], SCHEMA), path, KEYS, "date", wait=30)
        with pytest.raises(LeaseLost):
            first.check()
    assert table(spark, path) == [day(1, 1, 1.0)]


def lost_merge(spark, path, rows_, complete):
    """What a driver that was lost has left: a lease that nobody renews, and merged days."""
    folder = Path(merging_folder(path)) / "0123"
    with_day_parts(spark.createDataFrame(rows_, SCHEMA), "date").write.partitionBy("year", "month", "day").parquet(str(folder))
    if not complete:
        (folder / "_SUCCESS").unlink()
    lease = folder.parent / "_lease"
    lease.write_text("0123")
    os.utime(lease, (1e9, 1e9))


@pytest.mark.parametrize("complete", [True, False])
def test_a_stale_lease_is_taken_over(spark, tmp_path, complete):
    path = str(tmp_path / "t")
    upsert_table(spark.createDataFrame([day(1, 1, 1.0), day(2, 1, 1.0)], SCHEMA), path, KEYS, "date")
    lost_merge(spark, path, [day(1, 1, 7.0), day(1, 2, 7.0)], complete)
    upsert_table(spark.createDataFrame([day(1, 3, 3.0)], SCHEMA), path, KEYS, "date")
    first = [day(1, 1, 7.0), day(1, 2, 7.0)] if complete else [day(1, 1, 1.0)]
    assert table(spark, path) == [*first, day(1, 3, 3.0), day(2, 1, 1.0)]
    assert not Path(merging_folder(path)).exists()


def test_a_fresh_lease_of_a_lost_driver_holds_until_it_is_stale(spark, tmp_path):
    path, rows_ = str(tmp_path / "t"), spark.createDataFrame([day(1, 3, 3.0)], SCHEMA)
    lost_merge(spark, path, [day(1, 1, 7.0)], True)
    os.utime(Path(merging_folder(path)) / "_lease")
    with pytest.raises(LeaseHeld):
        merge_staged(rows_, path, KEYS, "date", stale=60)
    merge_staged(rows_, path, KEYS, "date", stale=0.5, wait=30)
    assert table(spark, path) == [day(1, 1, 7.0), day(1, 3, 3.0)]


def test_a_holder_renews_its_lease(spark, tmp_path):
    with Lease(spark, str(tmp_path / "x"), stale=1.0) as held:
        time.sleep(3)
        with pytest.raises(LeaseHeld):
            Lease(spark, str(tmp_path / "x"), stale=1.0).__enter__()
        held.check()
    assert not (tmp_path / "x").exists()


def test_a_merge_that_has_lost_its_lease_moves_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert_table(spark.createDataFrame([day(1, 1, 1.0)], SCHEMA), path, KEYS, "date")
    write = upsert_module.write_partitions

    def robbed(*args, **options):
        write(*args, **options)
        Path(merging_folder(path), "_lease").write_text("another")

    monkeypatch.setattr(upsert_module, "write_partitions", robbed)
    with pytest.raises(LeaseLost):
        merge_staged(spark.createDataFrame([day(1, 1, 9.0)], SCHEMA), path, KEYS, "date")
    assert table(spark, path) == [day(1, 1, 1.0)]
    assert Path(merging_folder(path), "_lease").read_text() == "another"


def test_a_move_that_stopped_half_way_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert_table(spark.createDataFrame([day(n, 1, 1.0) for n in (1, 2, 3)], SCHEMA), path, KEYS, "date")
    move, moved = upsert_module.move_folder, []

    def stop(*args):
        if moved:
            shutil.rmtree(tmp_path / "t" / "year=2024" / "month=1" / "day=2")
            raise KeyboardInterrupt
        moved.append(args)
        move(*args)

    monkeypatch.setattr(upsert_module, "move_folder", stop)
    with pytest.raises(KeyboardInterrupt):
        merge_staged(spark.createDataFrame([day(n, 2, 2.0) for n in (1, 2, 3)], SCHEMA), path, KEYS, "date")
    monkeypatch.undo()
    merge_staged(spark.createDataFrame([day(4, 1, 4.0)], SCHEMA), path, KEYS, "date")
    assert table(spark, path) == [day(n, i, float(i)) for n in (1, 2, 3) for i in (1, 2)] + [day(4, 1, 4.0)]


@pytest.mark.parametrize("hash_build", [False, True])
def test_empty_parts_of_a_key_are_equal(spark, hash_build):
    target = spark.createDataFrame([(date(2024, 1, 1), None, 1.0), day(1, 1, 1.0)], SCHEMA)
    staged = spark.createDataFrame([(date(2024, 1, 1), None, 2.0)], SCHEMA)
    found = upsert(target, staged, KEYS, hash_build).collect()
    assert sorted((r["id"] or 0, r["x"]) for r in found) == [(0, 2.0), (1, 1.0)]


def events_of(spark, n, x):
    """Rows of 40 days, with an empty part of a key among them."""
    keyed = "if(id % 50 = 0, null, cast(id % 50 as int)) as id"
    return spark.range(n).selectExpr("date_add(date'2024-01-01', cast(id div 50 as int)) as date", keyed, f"{x}D as x")


@pytest.mark.parametrize("file_format", ["parquet", "json"])
@pytest.mark.parametrize("lookup", [(), ("id",)])
def test_many_rows_meet_the_target_in_one_shuffle(spark, tmp_path, monkeypatch, file_format, lookup):
    monkeypatch.setattr(upsert_module, "JOINED_ROWS", 10)
    monkeypatch.setattr(upsert_module, "TASK_ROWS", 70)
    path, written = str(tmp_path / "t"), []
    write = upsert_module.write_partitions
    monkeypatch.setattr(upsert_module, "write_partitions", lambda df, *a, **o: (written.append(df), write(df, *a, **o)))
    merge_staged(events_of(spark, 2000, 1.0), path, KEYS, "date", file_format, lookup=lookup)
    merge_staged(events_of(spark, 2000, 2.0).where("id % 2 = 0 or id is null"), path, KEYS, "date", file_format, lookup=lookup)
    schema = with_day_parts(spark.createDataFrame([], SCHEMA), "date").schema
    found = read_target(spark, path, schema, file_format).select("date", "id", "x").collect()
    assert len(found) == 2000 == len({(r["date"], r["id"]) for r in found})
    assert all(r["x"] == (2.0 if r["id"] is None or r["id"] % 2 == 0 else 1.0) for r in found)
    for df in written:
        plan = df.sortWithinPartitions("year", "month", "day", *lookup)._jdf.queryExecution().executedPlan().toString()
        shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
        assert sum("_bucket" in x for x in shuffles) == 1
        assert all("_bucket" in x or "year" in x for x in shuffles)  # the other one lists the days
        assert plan.count("Sort [") == 1 and "SortMergeJoin" not in plan


def test_repeated_keys_among_many_rows_stop_the_upsert_before_the_target(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert_module, "JOINED_ROWS", 10)
    path = tmp_path / "t"
    rows_ = events_of(spark, 200, 1.0)
    with pytest.raises(RepeatedKeys):
        merge_staged(rows_.unionByName(rows_.where("id is null").limit(1)), str(path), KEYS, "date")
    assert not path.exists() and not Path(merging_folder(str(path))).exists()


def test_no_task_of_a_merge_holds_more_rows_than_it_is_given(spark, monkeypatch):
    """One group of days, one time of day: buckets of the other keys part them."""
    monkeypatch.setattr(upsert_module, "TASK_ROWS", 1000)
    new = with_day_parts(spark.range(40_000).selectExpr("date'2024-01-01' as date", "cast(id as int) as id", "1.0D as x"), "date")
    found = upsert_module.day_span(new, "date")
    assert (found["rows"], found["most"], found["groups"]) == (40_000, 40_000, 1)
    rows_ = upsert_module.met_in_one_shuffle(new.limit(0), new, KEYS, "date", found["most"], found["groups"])
    counts = rows_.rdd.mapPartitions(lambda rs: [sum(1 for _ in rs)]).collect()
    assert len(counts) == 80 and max(counts) < 8000 and sum(counts) == 40_000


@pytest.mark.parametrize("name", ["upsert_cleaned_by_user", "upsert_daily", "json_merge_roundtrip_by_user"])
def test_queries_that_merge_many_rows_match_their_sql(spark, monkeypatch, name):
    merged_by_query(spark, monkeypatch, name)


def merged_by_query(spark, monkeypatch, name):
    """The query with every merge in one shuffle, in small tasks."""
    from checks.oracle import all_oracles
    from checks.queries import all_queries
    from compare import assert_same

    monkeypatch.setattr(upsert_module, "JOINED_ROWS", 0)
    monkeypatch.setattr(upsert_module, "TASK_ROWS", 5000)
    monkeypatch.setattr(upsert_module, "key_span", None)  # no keys are counted beside the shuffle
    data = "/root/testdata/sf0.01"
    assert assert_same(all_queries()[name](spark, data), all_oracles()[name], data) > 0


def test_a_lookup_in_a_table_merged_from_many_rows_matches_its_sql(spark, monkeypatch):
    """The lookup's order is that of the one sort, and the uniqueness of keys needs no hash table of them."""
    merged_by_query(spark, monkeypatch, "device_history_by_user")
