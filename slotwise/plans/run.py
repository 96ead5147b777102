"""A whole run: scan, check, clean, summarise, store, report anomalies."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import time
from typing import ClassVar, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from slotwise.operators.baseline import JoinLimits, measured_profiles, staged_profiles
from slotwise.operators.quality import Audit
from slotwise.operators.summary import anomalies, daily_summary
from slotwise.operators.upsert import merge_staged
from slotwise.plans.clean import clean
from slotwise.sources.files import in_period
from slotwise.sources.sinks import JdbcTarget, write_csv, write_jdbc
from slotwise.sources.staging import file_marks, read_note, remove, run_folder, shared_folder, stage, write_note
from slotwise.spec import Period, SeriesSpec


class Store(Protocol):
    """Takes the two result tables of a run, both staged; says where they went."""

    def write_daily(self, daily: DataFrame, spec: SeriesSpec) -> str: ...

    def write_cleaned(self, cleaned: DataFrame, spec: SeriesSpec) -> str: ...


@dataclass(frozen=True)
class TableStore:
    """Partitioned Parquet tables with one row per key; a rerun upserts. The cleaned
    table is laid out for lookups by entity."""

    daily_path: str
    cleaned_path: str
    file_format: ClassVar[str] = "parquet"

    def write_daily(self, daily: DataFrame, spec: SeriesSpec) -> str:
        merge_staged(daily, self.daily_path, ["date", *spec.entity], "date", self.file_format)
        return self.daily_path

    def write_cleaned(self, cleaned: DataFrame, spec: SeriesSpec) -> str:
        merge_staged(cleaned, self.cleaned_path, [spec.ts, *spec.entity], spec.ts, self.file_format, lookup=spec.entity)
        return self.cleaned_path


@dataclass(frozen=True)
class JsonStore(TableStore):
    """The same as partitioned JSON."""

    file_format: ClassVar[str] = "json"


@dataclass(frozen=True)
class JdbcStore:
    """New staging tables in a database, beside the tables named."""

    target: JdbcTarget
    daily_table: str
    cleaned_table: str

    def write_daily(self, daily: DataFrame, spec: SeriesSpec) -> str:
        return write_jdbc(daily, self.target, self.daily_table)

    def write_cleaned(self, cleaned: DataFrame, spec: SeriesSpec) -> str:
        return write_jdbc(cleaned, self.target, self.cleaned_table)


@dataclass(frozen=True)
class Report:
    """What a run found and where it stored its tables."""

    audit: Audit
    entities: int
    daily: str
    cleaned: str
    anomalies: str


class Stages:
    """The staged tables of a run, and notes beside them of which are finished."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def begin(self, mark: str) -> None:
        """Keep what an earlier run of the same ``mark`` has left; remove anything else."""
        if read_note(self.spark, f"{self.folder}/run.json") != mark:
            remove(self.spark, self.folder)
            write_note(self.spark, f"{self.folder}/run.json", mark)

    def noted(self, name: str) -> dict | None:
        found = read_note(self.spark, f"{self.folder}/{name}.json")
        return None if found is None else json.loads(found)

    def note(self, name: str, details: dict) -> None:
        write_note(self.spark, f"{self.folder}/{name}.json", json.dumps(details))

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A scan of the staged table, which is made unless it is finished."""
        if (noted := self.noted(name)) is not None:
            schema = StructType.fromJson(noted["schema"])
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        made = stage(make(), self.folder, name)
        self.note(name, {"schema": made.schema.jsonValue()})
        return made


def fingerprint(readings: DataFrame, spec: SeriesSpec, period: Period, closed_end: bool) -> str:
    """What a run depends on: series, period, schema, and length and time of change of each input file."""
    files = file_marks(readings.sparkSession, readings.inputFiles())
    parts = [repr(spec), repr(period), closed_end, readings.schema.jsonValue(), files]
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def run(
    readings: DataFrame,
    spec: SeriesSpec,
    period: Period,
    store: Store,
    anomalies_path: str,
    entities: DataFrame | None = None,
    closed_end: bool = False,
    limits: JoinLimits = JoinLimits(),
    work: str | None = None,
    resume: str | None = None,
) -> Report:
    """Clean a period and write its daily summary, cleaned rows and anomalies.

    The period must start at midnight: the daily rows of a part of a day would
    replace those of the whole. The readings are read twice: for the gate and the
    profiles, and for the cleaned frame. That is computed once, into a staged table that the three outputs read, each only the columns it needs.
    Staged tables are in a folder of their own, in ``work`` or the folder that
    the session names, and are removed when all is written.

    With ``resume``, a name for this run, a run that was cut off goes on from
    the last table it had staged when it is started again under that name with the same
    period, series and unchanged input files; otherwise it begins anew. What
    ``entities`` holds, and what was done to the readings since they were
    scanned, must be the same for the same name.
    """
    if period.start.time() != time.min:
        raise ValueError(f"a run must start at midnight, not at {period.start}")
    spark = readings.sparkSession
    if resume is None:
        stages = Stages(spark, run_folder(spark, work))
    else:
        stages = Stages(spark, f"{work or shared_folder(spark)}/slotwise-run-{resume}")
        stages.begin(fingerprint(readings, spec, period, closed_end))
    folder = stages.folder
    if (noted := stages.noted("profiles")) is None:
        # the gate sees rows without a time, too
        timed_or_not = in_period(readings, spec, period, closed_end, keep_untimed=True)
        profiles = measured_profiles(timed_or_not, spec, period, folder, entities)
        profiles.audit.require_complete()
        stages.note("profiles", {"audit": asdict(profiles.audit), "numbers": [profiles.entities, profiles.bytes, profiles.largest]})
    else:
        profiles = staged_profiles(spark, spec, folder, Audit(**noted["audit"]), *noted["numbers"])
    source = in_period(readings, spec, period, closed_end)
    cleaned = stages.table("cleaned", lambda: clean(source, spec, period, entities, profiles, limits))
    daily = stages.table("daily", lambda: daily_summary(cleaned, spec))
    stored = store.write_daily(daily, spec), store.write_cleaned(cleaned, spec)
    write_csv(anomalies(cleaned, spec).hint("rebalance"), anomalies_path)
    remove(spark, folder)
    return Report(profiles.audit, profiles.entities, *stored, anomalies_path)
