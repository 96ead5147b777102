"""Where results go: partitioned files, CSV, JDBC staging tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from slotwise.functions import day_parts
from slotwise.sources.files import TIME_FORMAT, scan_json

PARTITIONS = ("year", "month", "day")
# Days of a month that are dealt to tasks together: what an entity's rows have in common is then moved once, not once a day.
DAYS_TOGETHER = 6
# JSON repeats each column's name in each row. Spark reads files with and without compression.
COMPRESSED_JSON = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def with_day_parts(df: DataFrame, day_column: str) -> DataFrame:
    """Add the partition columns year, month and day."""
    return df.withColumns(day_parts(day_column))


def with_days_together(df: DataFrame) -> DataFrame:
    """Add ``_days`` to a frame that has the partition columns: which of the month's groups of days a row is in."""
    return df.withColumn("_days", F.expr(f"cast((day - 1) div {DAYS_TOGETHER} as int)"))


def write_partitions(
    df: DataFrame,
    path: str,
    file_format: str,
    time_format: str = TIME_FORMAT,
    replace_days: bool = True,
    lookup: Sequence[str] = (),
    dealt: bool = False,
) -> None:
    """Write a frame that has the partition columns, replacing only the days
    it holds rows for, or else all there is.

    The rebalance gives each day few files and lets the adaptive planner split
    days that are too large for one task; it is left out for rows that are ``dealt`` by days already. A task gets
    some days of a month together, so that shuffled rows of an entity lie side by side and compress well.
    Within a file rows are in the order of the columns
    ``lookup``, and Parquet files get Bloom filters on these, so that a search
    for a key reads few row groups and pages. JSON files are compressed.
    """
    if not dealt:
        df = with_days_together(df).hint("rebalance", *PARTITIONS[:2], "_days").drop("_days")
    if lookup:
        df = df.sortWithinPartitions(*PARTITIONS, *lookup)
    filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in lookup} if file_format == "parquet" else {}
    (
        df.write.mode("overwrite")
        .options(**filters, **(COMPRESSED_JSON if file_format == "json" else {}))
        .option("partitionOverwriteMode", "dynamic" if replace_days else "static")
        .option("timestampNTZFormat", time_format)
        .partitionBy(*PARTITIONS)
        .format(file_format)
        .save(path)
    )


def write_json(df: DataFrame, path: str, day_column: str, time_format: str = TIME_FORMAT) -> None:
    """Compressed JSON lines under ``year=/month=/day=`` folders. Days that the frame has rows
    for are replaced whole; ``merge_staged`` keeps their other rows."""
    write_partitions(with_day_parts(df, day_column), path, "json", time_format)


def read_json(
    spark: SparkSession, path: str, schema: StructType, time_format: str = TIME_FORMAT
) -> DataFrame:
    """Read what ``write_json`` wrote; ``schema`` is that of the frame given to
    it. Declared, because the writer leaves NULL fields out."""
    parts = [part for part in PARTITIONS if part not in schema.names]
    full = StructType(list(schema.fields))
    for part in parts:
        full = full.add(part, IntegerType())
    return scan_json(spark, path, full, time_format).select(*schema.names, *parts)


def write_csv(df: DataFrame, path: str, time_format: str = TIME_FORMAT) -> None:
    """CSV with a header."""
    df.write.mode("overwrite").options(header=True, timestampNTZFormat=time_format).csv(path)


@dataclass(frozen=True)
class JdbcTarget:
    """A database, with a bound on the connections that one write opens."""

    url: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)
    connections: int = 16
    batch_rows: int = 10_000
    properties: Mapping[str, str] = field(default_factory=dict)

    def options(self, table: str) -> dict[str, str]:
        chosen = {
            **self.properties,
            "url": self.url,
            "driver": self.driver,
            "dbtable": table,
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_rows),
        }
        if self.user:
            chosen.update(user=self.user, password=self.password)
        return chosen


def staging_name(table: str) -> str:
    """A table beside ``table`` that no other run uses."""
    return f"{table}_staging_{uuid.uuid4().hex[:12]}"


def write_jdbc(df: DataFrame, target: JdbcTarget, table: str) -> str:
    """Write a new staging table beside ``table``, which stays as it is, and
    return its name. Merging it is the database's own work."""
    name = staging_name(table)
    df.write.format("jdbc").options(**target.options(name)).mode("errorifexists").save()
    return name
