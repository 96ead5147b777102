"""Every operator applied to the ``events`` table.

Events are irregular, so hourly readings are rolled up first: per entity and
hour the mean value ``v``, the largest value ``mx`` and the count ``n``. The
entity is ``event_type`` (dense series) or ``user_id`` (sparse series, queries
named ``*_by_user``). Some queries repeat the work with slots of 15 minutes or
two hours, or with the join that large numbers of entities lead to.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DoubleType

from slotwise import Period, SeriesSpec, clean
from slotwise import operators as op
from slotwise import sources
from slotwise.functions import slot_floor
from slotwise.operators.baseline import JoinLimits

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
PERIOD = Period.of("2024-01-01", "2024-01-31")
FIRST_DAY = Period.of("2024-01-01", "2024-01-02")
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

Query = Callable[[SparkSession, str], DataFrame]


HOUR = timedelta(hours=1)

# Every join by shuffle, and entities spread over tasks from 500 readings on.
SHUFFLED = JoinLimits(broadcast_bytes=0, task_rows=500)


def series(entity: str, slot: timedelta = HOUR) -> SeriesSpec:
    return SeriesSpec(
        entity=entity,
        ts="slot_ts",
        metrics=("v", "mx", "n"),
        slot=slot,
        summary_metrics="v",
        anomaly_metric="v",
    )


def event_series(entity: str) -> SeriesSpec:
    return SeriesSpec(entity=entity, ts="ts", metrics="value")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, with their schema declared so that no file is opened for it."""
    return sources.scan_parquet(spark, f"{sf_dir}/events.parquet", DataType.fromDDL(EVENTS))


def work_folder(spark: SparkSession) -> str | None:
    """None where the session names a shared folder. A session of one process,
    whose tasks see the driver's folders, may do without."""
    master = spark.conf.get("spark.master", "")
    if spark.conf.get("spark.checkpoint.dir", None) or not (master == "local" or master.startswith("local[")):
        return None
    return tempfile.mkdtemp(prefix="slotwise-checks-")


def readings_hourly(spark: SparkSession, sf_dir: str, entity: str, slot: timedelta = HOUR) -> DataFrame:
    return rolled_up(events(spark, sf_dir), entity, slot)


def rolled_up(raw: DataFrame, entity: str, slot: timedelta = HOUR) -> DataFrame:
    spec = series(entity, slot)
    in_range = sources.in_period(raw, event_series(entity), PERIOD)
    return in_range.groupBy(entity, slot_floor("ts", spec, PERIOD).alias(spec.ts)).agg(
        F.avg("value").alias("v"),
        F.max("value").alias("mx"),
        F.count(F.lit(1)).cast("double").alias("n"),
    )


def cleaned(
    spark: SparkSession,
    sf_dir: str,
    entity: str,
    slot: timedelta = HOUR,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    readings = readings_hourly(spark, sf_dir, entity, slot)
    return clean(readings, series(entity, slot), PERIOD, limits=limits, work=work_folder(spark))


def daily(spark: SparkSession, sf_dir: str, entity: str, slot: timedelta = HOUR) -> DataFrame:
    """The daily summary looks at ``v`` only, so only ``v`` is cleaned."""
    spec = series(entity, slot).only("v")
    cleaned_v = clean(readings_hourly(spark, sf_dir, entity, slot), spec, PERIOD, work=work_folder(spark))
    return op.daily_summary(cleaned_v, spec)


def digits(column: str) -> int:
    """Decimals that survive a comparison.

    Sums of doubles differ in the last bits between engines and between runs.
    Means of two-decimal values may end in an exact 5 up to the ninth decimal,
    where short rounding would turn on those bits. Deviations and scores have
    no such ties, so fewer digits make an accidental one less likely.
    """
    return 6 if column.endswith("_stddev") or column.startswith("zscore_") else 9


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded once, at the very end of a query."""
    return df.select(
        *[
            F.round(f.name, digits(f.name)).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.in_period(events(spark, sf_dir), event_series("user_id"), FIRST_DAY, closed_end=True)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events through CSV files, scanned with a declared schema."""
    path = f"{sources.run_folder(spark, work_folder(spark))}/events"
    sources.write_csv(events(spark, sf_dir), path, MICROSECONDS)
    scanned = sources.scan_csv(spark, f"{path}/*.csv", DataType.fromDDL(EVENTS), MICROSECONDS)
    return sources.in_period(scanned, event_series("user_id"), FIRST_DAY, closed_end=True)


def null_audit(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    spec = series(entity)
    grid = op.expand_gaps(readings_hourly(spark, sf_dir, entity), spec, PERIOD)
    return op.audit(grid, spec, PERIOD).select("rows", *[f"null_{c}" for c in spec.reading_columns])


def readings_audit(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The audit of the raw events, nearly all of which lie off the slots."""
    spec = event_series(entity)
    found = op.audit(events(spark, sf_dir), spec, PERIOD)
    return found.select("rows", *[f"null_{c}" for c in spec.reading_columns], "off_slot")


def repeated_slots(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Slots of an entity that hold more than one event."""
    spec = series(entity)
    in_range = sources.in_period(events(spark, sf_dir), event_series(entity), PERIOD)
    slotted = in_range.select(entity, slot_floor("ts", spec, PERIOD).alias(spec.ts))
    return op.repeated_keys(slotted, [entity, spec.ts])


def distinct_entities(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    spec = event_series(entity)
    return op.distinct_entities(sources.in_period(events(spark, sf_dir), spec, PERIOD), spec)


def hourly_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slots of the whole days that the events span."""
    span = op.observed_period(events(spark, sf_dir), event_series("user_id"))
    return op.slot_spine(span, series("user_id"))


def expected_grid(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return op.expected_grid(distinct_entities(spark, sf_dir, entity), series(entity), PERIOD)


def gap_expand(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return rounded(op.expand_gaps(readings_hourly(spark, sf_dir, entity), series(entity), PERIOD))


def missing_slots(spark: SparkSession, sf_dir: str, entity: str, slot: timedelta = HOUR) -> DataFrame:
    return op.missing_slots(readings_hourly(spark, sf_dir, entity, slot), series(entity, slot), PERIOD)


def hourly_baseline(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    spec = series(entity)
    profiles = op.entity_profiles(readings_hourly(spark, sf_dir, entity), spec, PERIOD)
    return rounded(op.hourly_baseline(profiles, spec, PERIOD))


def filled(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return op.fill_gaps(readings_hourly(spark, sf_dir, entity), series(entity), PERIOD, work=work_folder(spark))


def zscores(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    spec = series(entity)
    scored = op.with_zscores(filled(spark, sf_dir, entity), spec)
    return rounded(scored.select(entity, "hour", spec.ts, *[f"zscore_{m}" for m in spec.metrics]))


def anomalies(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return op.anomalies(cleaned(spark, sf_dir, entity), series(entity))


def date_partition_cols(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    spec = series(entity)
    return rounded(sources.with_day_parts(cleaned(spark, sf_dir, entity), spec.ts))


def upserted(
    spark: SparkSession, rows: DataFrame, keys: list[str], day_column: str, marked: str
) -> DataFrame:
    """A target table up to 01-20 with one column set to -1, then an upsert of
    everything from 01-11 on. Both updates are parts of one staged table."""
    folder = sources.run_folder(spark, work_folder(spark))
    rows = sources.stage(rows, folder, "rows")
    day = F.to_date(day_column)
    old = rows.where(day < F.lit("2024-01-21").cast("date")).withColumn(marked, F.lit(-1.0))
    new = rows.where(day >= F.lit("2024-01-11").cast("date"))
    for updates in (old, new):
        op.merge_staged(updates, f"{folder}/target", keys, day_column)
    target_schema = sources.with_day_parts(rows, day_column).schema
    return rounded(op.read_target(spark, f"{folder}/target", target_schema).select(*rows.columns))


def json_merge_roundtrip(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The cleaned rows in two batches that share all days, merged into JSON."""
    folder = sources.run_folder(spark, work_folder(spark))
    rows = sources.stage(cleaned(spark, sf_dir, entity), folder, "rows")
    for half in (0, 1):
        batch = rows.where(F.col("hour") % 2 == half)
        op.merge_staged(batch, f"{folder}/target", ["slot_ts", entity], "slot_ts", "json")
    schema = sources.with_day_parts(rows, "slot_ts").schema
    return rounded(op.read_target(spark, f"{folder}/target", schema, "json").select(*rows.columns))


def csv_corrupt_audit(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """All events as CSV lines, every tenth with a cell too many, audited."""
    path = f"{sources.run_folder(spark, work_folder(spark))}/lines"
    spec = event_series(entity)
    cells = F.concat_ws(",", F.date_format("ts", MICROSECONDS), entity, "value")
    line = F.concat(cells, F.when(F.col("event_id") % 10 == 0, ",7.5").otherwise(""))
    events(spark, sf_dir).select(line.alias(f"ts,{entity},value")).write.options(header=True, sep="|").csv(path)
    schema = DataType.fromDDL(f"ts timestamp_ntz, {entity} {'bigint' if entity == 'user_id' else 'string'}, value double")
    lines = sources.scan_csv(spark, path, schema, MICROSECONDS, keep_corrupt=True)
    return op.audit(lines, spec, PERIOD).select("rows", "corrupt", *[f"null_{c}" for c in spec.reading_columns])


def incomplete_rows(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The rows of the expanded grid that the gate would refuse."""
    spec = series(entity)
    grid = op.expand_gaps(readings_hourly(spark, sf_dir, entity), spec, PERIOD)
    return op.incomplete_rows(grid, spec).select(entity, spec.ts, "hour")


def upsert_daily(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return upserted(spark, daily(spark, sf_dir, entity), ["date", entity], "date", "v_mean")


def upsert_cleaned(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return upserted(spark, cleaned(spark, sf_dir, entity), ["slot_ts", entity], "slot_ts", "v")


def json_sink_roundtrip(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    summary = daily(spark, sf_dir, entity)
    path = f"{sources.run_folder(spark, work_folder(spark))}/daily"
    sources.write_json(summary, path, "date")
    return rounded(sources.read_json(spark, path, summary.schema))


def json_cleaned_roundtrip(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    rows = cleaned(spark, sf_dir, entity)
    path = f"{sources.run_folder(spark, work_folder(spark))}/cleaned"
    sources.write_json(rows, path, "slot_ts")
    return rounded(sources.read_json(spark, path, rows.schema))


def csv_sink_roundtrip(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    found = anomalies(spark, sf_dir, entity)
    path = f"{sources.run_folder(spark, work_folder(spark))}/anomalies"
    sources.write_csv(found, path)
    return rounded(sources.scan_csv(spark, path, found.schema))


def stage_roundtrip(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return rounded(sources.stage(daily(spark, sf_dir, entity), sources.run_folder(spark, work_folder(spark)), "daily"))


def pruned_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day out of all events as CSV files in order of time, of which
    only the files of that day are opened."""
    folder = sources.run_folder(spark, work_folder(spark))
    sources.write_csv(events(spark, sf_dir).repartitionByRange(30, "ts"), f"{folder}/events", MICROSECONDS)
    scan = partial(sources.scan_csv, spark, schema=DataType.fromDDL(EVENTS), time_format=MICROSECONDS)
    spec = event_series("user_id")
    sources.update_extents(spark, f"{folder}/events/*.csv", scan, spec, f"{folder}/extents")
    files = sources.files_of_period(sources.read_extents(spark, f"{folder}/extents"), FIRST_DAY, closed_end=True)
    return sources.in_period(scan(files), spec, FIRST_DAY, closed_end=True)


def baseline_state(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The state of all days, kept in a table that is extended twice."""
    spec = series(entity)
    path = f"{sources.run_folder(spark, work_folder(spark))}/state"
    readings = readings_hourly(spark, sf_dir, entity)
    for end in ("2024-01-12", "2024-01-31"):
        op.update_state(readings, spec, Period.of("2024-01-01", end), path)
    return op.read_state(spark, path, op.daily_state(readings, spec, PERIOD).schema, PERIOD)


def baseline_from_state(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    profiles = op.state_profiles(baseline_state(spark, sf_dir, entity), series(entity))
    return rounded(op.hourly_baseline(profiles, series(entity), PERIOD))


def moving_baseline(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The baselines of spans of 14 days, one beginning every fourth day, with its first day as ``date``."""
    spec = series(entity)
    windows = op.moving_windows(baseline_state(spark, sf_dir, entity), PERIOD, 14, 4)
    profiles = op.state_profiles(windows, spec, "_from")
    by_window = SeriesSpec(entity=("first_day", entity), ts=spec.ts, metrics=spec.metrics)
    found = op.hourly_baseline(profiles.withColumnRenamed("_from", "first_day"), by_window, PERIOD)
    return rounded(found.withColumnRenamed("first_day", "date"))


def device_history(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The cleaned rows of the smallest entity, looked up in a merged table laid out for it."""
    folder = sources.run_folder(spark, work_folder(spark))
    rows = sources.stage(cleaned(spark, sf_dir, entity), folder, "rows")
    op.merge_staged(rows, f"{folder}/target", ["slot_ts", entity], "slot_ts", lookup=[entity])
    table = op.read_target(spark, f"{folder}/target", sources.with_day_parts(rows, "slot_ts").schema)
    wanted = table.agg(F.min(entity).alias("_wanted")).first()["_wanted"]
    return rounded(table.where(F.col(entity) == F.lit(wanted)).select(*rows.columns))


SINGLE: dict[str, Query] = {
    "range_scan": range_scan,
    "csv_scan": csv_scan,
    "pruned_csv_scan": pruned_csv_scan,
    "hourly_slots": hourly_slots,
}

PER_ENTITY: dict[str, Callable[[SparkSession, str, str], DataFrame]] = {
    "daily_summary": lambda *args: rounded(daily(*args)),
    "readings_hourly": lambda *args: rounded(readings_hourly(*args)),
    "null_audit": null_audit,
    "readings_audit": readings_audit,
    "incomplete_rows": incomplete_rows,
    "csv_corrupt_audit": csv_corrupt_audit,
    "json_merge_roundtrip": json_merge_roundtrip,
    "repeated_slots": repeated_slots,
    "distinct_entities": distinct_entities,
    "expected_grid": expected_grid,
    "gap_expand": gap_expand,
    "missing_slots": missing_slots,
    "hourly_baseline": hourly_baseline,
    "baseline_from_state": baseline_from_state,
    "moving_baseline": moving_baseline,
    "device_history": device_history,
    "impute_gaps": lambda *args: rounded(filled(*args)),
    "zscores": zscores,
    "mask_outliers": lambda *args: rounded(cleaned(*args)),
    "anomalies": lambda *args: rounded(anomalies(*args)),
    "date_partition_cols": date_partition_cols,
    "upsert_daily": upsert_daily,
    "upsert_cleaned": upsert_cleaned,
    "json_sink_roundtrip": json_sink_roundtrip,
    "json_cleaned_roundtrip": json_cleaned_roundtrip,
    "csv_sink_roundtrip": csv_sink_roundtrip,
    "stage_roundtrip": stage_roundtrip,
    "mask_outliers_one_shuffle": lambda *args: rounded(cleaned(*args, limits=SHUFFLED)),
}

OTHER_SLOTS = {"quarter_hourly": timedelta(minutes=15), "two_hourly": timedelta(hours=2)}

PER_SLOT: dict[str, Callable[[SparkSession, str, str, timedelta], DataFrame]] = {
    "missing_slots": missing_slots,
    "mask_outliers": lambda *args: rounded(cleaned(*args)),
    "daily_summary": lambda *args: rounded(daily(*args)),
}


def all_queries() -> dict[str, Query]:
    found = dict(SINGLE)
    for name, query in PER_ENTITY.items():
        found[name] = partial(_applied, query, ("event_type",))
        found[f"{name}_by_user"] = partial(_applied, query, ("user_id",))
    for name, query in PER_SLOT.items():
        for label, slot in OTHER_SLOTS.items():
            found[f"{name}_{label}"] = partial(_applied, query, ("event_type", slot))
    found["missing_slots_minutely"] = partial(_applied, missing_slots, ("event_type", timedelta(minutes=1)))
    return found


def _applied(query, arguments: tuple, spark: SparkSession, sf_dir: str) -> DataFrame:
    return query(spark, sf_dir, *arguments)
