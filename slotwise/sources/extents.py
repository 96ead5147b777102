"""Which files of a source hold readings of a period: a small table of each file's first and last time.

Lines of text carry no statistics that a scan could skip files by. The table
is made in one pass, kept as Parquet, and brought up to date by reading only the files that
are new or changed since.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotwise.functions import ntz
from slotwise.sources.staging import file_system, move_folder
from slotwise.spec import Period, SeriesSpec

EXTENTS = "path string, length bigint, changed timestamp, first timestamp_ntz, last timestamp_ntz, untimed bigint"
FILE = {"path": "_metadata.file_path", "length": "_metadata.file_size", "changed": "_metadata.file_modification_time"}

Scan = Callable[[Sequence[str]], DataFrame]


def listed_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, length, changed)`` of the files that a path or glob names; no file is opened."""
    found = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return found.select(*[F.col(column).alias(name) for name, column in FILE.items()])


def time_extents(scanned: DataFrame, spec: SeriesSpec) -> DataFrame:
    """A row per file of a scan: first and last time, and how many rows lack one."""
    ts = F.col(spec.ts).cast("timestamp_ntz")
    return (
        scanned.select(*[F.col(column).alias(name) for name, column in FILE.items()], ts.alias("_ts"))
        .groupBy(*FILE)
        .agg(
            F.min("_ts").alias("first"),
            F.max("_ts").alias("last"),
            (F.count(F.lit(1)) - F.count("_ts")).alias("untimed"),
        )
    )


def update_extents(spark: SparkSession, paths: str | Sequence[str], scan: Scan, spec: SeriesSpec, table: str) -> list[str]:
    """Bring the table of extents at ``table`` up to date with the files of ``paths``;
    returns the files that were read for it.

    ``scan`` reads files by their paths. Files whose length and time of change are
    known are not read again, files that are gone leave the table. Files without
    a row are not in it and are looked at each time. The names of new files pass
    through the driver, as those of every scan do.
    """
    now = listed_files(spark, paths)
    old = read_extents(spark, table)
    kept = old.join(now, list(FILE), "left_semi")
    new = [unquote(r["path"]) for r in now.join(old, list(FILE), "left_anti").select("path").orderBy("path").collect()]
    known = kept.unionByName(time_extents(scan(new), spec)) if new else kept
    draft = f"{table.rstrip('/')}-{uuid4().hex}"
    known.write.parquet(draft)
    move_folder(spark, draft, table)
    return new


def read_extents(spark: SparkSession, table: str) -> DataFrame:
    location, files = file_system(spark, table)
    if not files.exists(location):
        return spark.createDataFrame([], EXTENTS)
    return spark.read.schema(EXTENTS).parquet(table)


def files_of_period(extents: DataFrame, period: Period, closed_end: bool = False, keep_untimed: bool = False) -> list[str]:
    """The files that may hold rows which ``in_period`` keeps, given the same arguments."""
    first, last = F.col("first"), F.col("last")
    begun = first <= ntz(period.end) if closed_end else first < ntz(period.end)
    wanted = begun & (last >= ntz(period.start))
    if keep_untimed:
        wanted = F.coalesce(wanted, F.lit(False)) | (F.col("untimed") > 0)
    return [unquote(r["path"]) for r in extents.where(wanted).select("path").orderBy("path").collect()]
