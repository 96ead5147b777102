from datetime import date
from pathlib import Path

import pytest

from helpers import ONE, ONE_SCHEMA, DEVICES, at, one_metric
from slotwise import Period, SeriesSpec
from slotwise.operators import IncompleteReadings, incomplete_rows, require_complete
from slotwise.sources import (
    CORRUPT,
    JdbcTarget,
    in_period,
    read_json,
    reading_schema,
    scan_csv,
    scan_json,
    scan_parquet,
    stage,
    staging_name,
    write_csv,
    write_jdbc,
    write_json,
)

DAY = Period.of("2022-03-01", "2022-03-02")
HEADER = "timestamp,device_id,speed,direction,power\n"


def csv(folder: Path, name: str, text: str) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_csv_files_by_glob_with_a_declared_schema(spark, tmp_path):
    csv(tmp_path, "a.csv", HEADER + "2022-03-01 00:00:00,1,10.5,123,1.5\n")
    csv(tmp_path, "b.csv", HEADER + "2022-03-01 01:00:00,2,11,90,2.5\n")
    csv(tmp_path, "c.txt", "not a reading\n")
    df = scan_csv(spark, f"{tmp_path}/*.csv", reading_schema(DEVICES))
    assert [f.dataType.simpleString() for f in df.schema] == ["timestamp_ntz", "int", "double", "double", "double"]
    assert sorted(tuple(r) for r in df.collect()) == [
        (at("2022-03-01T00:00:00"), 1, 10.5, 123.0, 1.5),
        (at("2022-03-01T01:00:00"), 2, 11.0, 90.0, 2.5),
    ]


def test_a_csv_header_in_another_order_is_an_error(spark, tmp_path):
    csv(tmp_path, "a.csv", "device_id,timestamp,speed,direction,power\n1,2022-03-01 00:00:00,1,2,3\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        scan_csv(spark, str(tmp_path), reading_schema(DEVICES)).collect()


def test_a_csv_cell_that_does_not_parse_reaches_the_audit(spark, tmp_path):
    csv(tmp_path, "a.csv", HEADER + "2022-03-01 00:00:00,1,n/a,90,3\n2022-03-01 01:00:00,1,1,90,\n")
    df = scan_csv(spark, str(tmp_path), reading_schema(DEVICES))
    with pytest.raises(IncompleteReadings, match="speed: 1, power: 1"):
        require_complete(df, DEVICES, DAY)


def test_lines_with_too_many_cells_reach_the_audit(spark, tmp_path):
    csv(tmp_path, "a.csv", HEADER + "2022-03-01 00:00:00,1,1,90,3,7.5\n2022-03-01 01:00:00,1,1,90,2\n")
    df = scan_csv(spark, str(tmp_path), reading_schema(DEVICES), keep_corrupt=True)
    with pytest.raises(IncompleteReadings, match="corrupt lines: 1"):
        require_complete(df, DEVICES, DAY)
    assert [r[CORRUPT] for r in incomplete_rows(df, DEVICES).collect()] == ["2022-03-01 00:00:00,1,1,90,3,7.5"]


def test_entity_types_can_be_declared():
    spec = SeriesSpec(entity=("site", "id"), ts="ts", metrics="x")
    schema = reading_schema(spec, {"site": "string"})
    assert [f.dataType.simpleString() for f in schema] == ["timestamp_ntz", "string", "int", "double"]


def test_range_ends(spark):
    df = one_metric(spark, [(1, "2022-02-28T23:59:59", 0.0), (2, "2022-03-01", 0.0), (3, "2022-03-02", 0.0), (4, None, 0.0)])
    ids = lambda **kw: sorted(r.id for r in in_period(df, ONE, DAY, **kw).collect())
    assert ids() == [2]
    assert ids(closed_end=True) == [2, 3]
    assert ids(keep_untimed=True) == [2, 4]


def test_json_lines_and_parquet(spark, tmp_path):
    df = one_metric(spark, [(1, "2022-03-01T01:00:00", 0.1), (2, "2022-03-01T02:00:00", None)])
    df.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").json(str(tmp_path / "json"))
    df.write.parquet(str(tmp_path / "parquet"))
    wanted = sorted(map(tuple, df.collect()), key=str)
    for scanned in (scan_json(spark, str(tmp_path / "json"), df.schema), scan_parquet(spark, str(tmp_path / "parquet"))):
        assert sorted(map(tuple, scanned.collect()), key=str) == wanted


def daily(spark, *rows):
    return spark.createDataFrame([(date(2024, 1, d), i, x) for d, i, x in rows], "date date, id int, x double")


def test_json_keeps_other_days_and_empty_cells(spark, tmp_path):
    path = str(tmp_path / "daily")
    first = daily(spark, (1, 1, 0.5), (2, 1, None), (2, 2, 7.0))
    write_json(first, path, "date")
    write_json(daily(spark, (1, 1, 9.0)), path, "date")
    assert (tmp_path / "daily/year=2024/month=1/day=2").is_dir()
    found = read_json(spark, path, first.schema)
    assert found.columns == ["date", "id", "x", "year", "month", "day"]
    assert sorted(map(tuple, found.collect())) == [
        (date(2024, 1, 1), 1, 9.0, 2024, 1, 1),
        (date(2024, 1, 2), 1, None, 2024, 1, 2),
        (date(2024, 1, 2), 2, 7.0, 2024, 1, 2),
    ]


def test_csv_times_are_plain(spark, tmp_path, zone):
    zone("America/New_York")
    df = one_metric(spark, [(1, "2022-03-13T02:00:00", 0.1)])
    write_csv(df, str(tmp_path / "out"))
    write_csv(df, str(tmp_path / "out"))
    lines = "".join(f.read_text() for f in (tmp_path / "out").glob("*.csv")).splitlines()
    assert set(lines) == {"id,ts,x", "1,2022-03-13 02:00:00,0.1"}
    assert scan_csv(spark, str(tmp_path / "out"), df.schema).collect() == df.collect()


def test_staged_tables_are_read_back(spark, tmp_path):
    df = spark.createDataFrame([], ONE_SCHEMA)
    assert stage(df, str(tmp_path), "empty").schema == df.schema
    filled = one_metric(spark, [(1, "2022-03-01", 1.0)])
    again = stage(filled, str(tmp_path), "filled")
    assert again.collect() == filled.collect()
    assert "FileScan parquet" in again._jdf.queryExecution().toString()


TARGET = JdbcTarget(
    "jdbc:somewhere:db", "no.such.Driver", "me", "secret", connections=4, properties={"sslmode": "require"}
)


def test_jdbc_options():
    assert TARGET.options("load_table") == {
        "url": "jdbc:somewhere:db",
        "driver": "no.such.Driver",
        "dbtable": "load_table",
        "user": "me",
        "password": "secret",
        "numPartitions": "4",
        "batchsize": "10000",
        "sslmode": "require",
    }
    assert "secret" not in repr(TARGET)


def test_jdbc_writes_beside_the_table_it_is_given():
    names = {staging_name("app.daily") for _ in range(3)}
    assert len(names) == 3 and all(x.startswith("app.daily_staging_") for x in names)


def test_jdbc_write_reaches_the_driver_class(spark):
    """No database is started for tests, so this ends at the missing driver."""
    with pytest.raises(Exception, match="no.such.Driver"):
        write_jdbc(daily(spark, (1, 1, 1.0)), TARGET, "load_table")


def test_json_is_compressed_and_rows_of_several_days_are_dealt_together(spark, tmp_path):
    path = tmp_path / "json"
    days = "date_add(date'2024-01-01', cast(id % 6 as int)) as date"
    df = spark.range(60).selectExpr(days, "cast(id as int) as id", "1.5D as a_long_name_of_a_metric")
    write_json(df, str(path), "date")
    found = [f.name for f in path.rglob("part-*")]
    assert len(found) == 6 and all(name.endswith(".json.gz") for name in found)
    assert len({name.split("-")[1] for name in found}) == 1  # one task had all six days
    assert sorted(read_json(spark, str(path), df.schema).select(*df.columns).collect()) == sorted(df.collect())
