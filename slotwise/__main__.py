"""Command line: ``python -m slotwise --input 'readings/*.csv' --start ... --end ...``."""

from __future__ import annotations

import argparse
from datetime import timedelta
from pathlib import Path

from pyspark.sql import SparkSession

from slotwise.plans.run import JdbcStore, JsonStore, Store, TableStore, run
from slotwise.sources.files import TIME_FORMAT, reading_schema, scan_csv, scan_json, scan_parquet
from slotwise.sources.sinks import JdbcTarget
from slotwise.spec import ANOMALY_SIGMA, MASK_SIGMA, Period, SeriesSpec


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="slotwise", description="Clean and summarise regular sensor readings.")
    p.add_argument("--input", required=True, help="path or glob of the readings")
    p.add_argument("--format", choices=["csv", "json", "parquet"], default="csv")
    p.add_argument("--time-format", default=TIME_FORMAT)
    p.add_argument("--start", required=True, help="first day, e.g. 2022-03-01")
    p.add_argument("--end", required=True, help="day after the last one")
    p.add_argument("--closed-end", action="store_true", help="also scan readings at exactly --end")
    p.add_argument("--entity", nargs="+", required=True, metavar="COLUMN[:TYPE]")
    p.add_argument("--ts", default="timestamp")
    p.add_argument("--metrics", nargs="+", required=True)
    p.add_argument("--summary-metrics", nargs="*", default=[])
    p.add_argument("--anomaly-metric", default="")
    p.add_argument("--slot-minutes", type=int, default=60)
    p.add_argument("--mask-sigma", type=float, default=MASK_SIGMA)
    p.add_argument("--anomaly-sigma", type=float, default=ANOMALY_SIGMA)
    p.add_argument("--store", choices=["json", "table", "jdbc"], default="json")
    p.add_argument("--daily", required=True, help="path or table of the daily summary")
    p.add_argument("--cleaned", required=True, help="path or table of the cleaned readings")
    p.add_argument("--anomalies", required=True, help="path of the anomalies CSV")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-user", default="")
    p.add_argument("--jdbc-password-file")
    p.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    return p


def series(args: argparse.Namespace) -> tuple[SeriesSpec, dict[str, str]]:
    """The series spec and the declared entity types."""
    entity = [column.partition(":") for column in args.entity]
    spec = SeriesSpec(
        entity=tuple(name for name, _, _ in entity),
        ts=args.ts,
        metrics=tuple(args.metrics),
        slot=timedelta(minutes=args.slot_minutes),
        mask_sigma=args.mask_sigma,
        anomaly_sigma=args.anomaly_sigma,
        summary_metrics=tuple(args.summary_metrics),
        anomaly_metric=args.anomaly_metric,
    )
    return spec, {name: kind for name, _, kind in entity if kind}


def store(args: argparse.Namespace) -> Store:
    if args.store == "json":
        return JsonStore(args.daily, args.cleaned)
    if args.store == "table":
        return TableStore(args.daily, args.cleaned)
    if not (args.jdbc_url and args.jdbc_driver):
        raise SystemExit("--store jdbc needs --jdbc-url and --jdbc-driver")
    password = Path(args.jdbc_password_file).read_text().strip() if args.jdbc_password_file else ""
    target = JdbcTarget(
        args.jdbc_url,
        args.jdbc_driver,
        args.jdbc_user,
        password,
        properties=dict(item.split("=", 1) for item in args.jdbc_property),
    )
    return JdbcStore(target, args.daily, args.cleaned)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spec, types = series(args)
    sink = store(args)
    spark = SparkSession.builder.appName("slotwise").config("spark.ui.enabled", "false").getOrCreate()
    schema = reading_schema(spec, types)
    if args.format == "parquet":
        readings = scan_parquet(spark, args.input, schema)
    else:
        scan = scan_csv if args.format == "csv" else scan_json
        readings = scan(spark, args.input, schema, args.time_format)
    found = run(
        readings, spec, Period.of(args.start, args.end), sink, args.anomalies, closed_end=args.closed_end
    )
    print(f"{found.audit.rows} readings of {found.entities} entities, {found.audit.off_slot} off the slot grid")
    print(f"stored in {found.daily} and {found.cleaned}")


if __name__ == "__main__":
    main()
