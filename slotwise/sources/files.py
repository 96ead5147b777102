"""Scans of reading files with a declared schema, and the range filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, StructField, StructType, TimestampNTZType

from slotwise.functions import ntz
from slotwise.spec import Period, SeriesSpec

# Fixed value: how times are written in CSV and JSON files by default.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Holds the lines of a CSV file that do not fit their header; the audit counts them.
CORRUPT = "_corrupt"


def reading_schema(spec: SeriesSpec, entity_types: Mapping[str, str] | None = None) -> StructType:
    """Schema of a readings file; entity columns are ``int`` unless told otherwise."""
    types = entity_types or {}
    schema = StructType().add(spec.ts, TimestampNTZType())
    for column in spec.entity:
        schema = schema.add(column, DataType.fromDDL(types.get(column, "int")))
    for metric in spec.metrics:
        schema = schema.add(metric, DoubleType())
    return schema


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    time_format: str = TIME_FORMAT,
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV files with a header, by path or glob.

    The schema is declared, so no pass is spent on inferring it, and a header
    that does not match it is an error. A cell that does not parse becomes
    NULL, which the audit reports. ``keep_corrupt`` adds the column
    ``_corrupt``: the line, if it has too many or too few cells or one that does
    not parse, else NULL. The audit counts such lines and the gate refuses them.
    """
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, timestampNTZFormat=time_format, columnNameOfCorruptRecord=CORRUPT)
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def scan_json(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType, time_format: str = TIME_FORMAT
) -> DataFrame:
    """JSON lines; fields missing from a line read as NULL."""
    return (
        spark.read.schema(schema)
        .options(timestampNTZFormat=time_format)
        .json(paths if isinstance(paths, str) else list(paths))
    )


def scan_parquet(spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def in_period(
    readings: DataFrame,
    spec: SeriesSpec,
    period: Period,
    closed_end: bool = False,
    keep_untimed: bool = False,
) -> DataFrame:
    """Readings in ``[start, end)``, or ``[start, end]`` with ``closed_end``.

    ``keep_untimed`` also keeps rows without a time, for an audit that should
    see them; the filter still reaches the file scan.
    """
    ts = F.col(spec.ts)
    before_end = ts <= ntz(period.end) if closed_end else ts < ntz(period.end)
    wanted = (ts >= ntz(period.start)) & before_end
    return readings.where(wanted | ts.isNull() if keep_untimed else wanted)
