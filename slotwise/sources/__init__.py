from slotwise.sources.extents import files_of_period, read_extents, time_extents, update_extents
from slotwise.sources.files import CORRUPT, in_period, reading_schema, scan_csv, scan_json, scan_parquet
from slotwise.sources.lease import Lease, LeaseHeld, LeaseLost
from slotwise.sources.sinks import (
    JdbcTarget,
    read_json,
    staging_name,
    with_day_parts,
    write_csv,
    write_jdbc,
    write_json,
    write_partitions,
)
from slotwise.sources.staging import remove, run_folder, shared_folder, stage

__all__ = [
    "CORRUPT",
    "JdbcTarget",
    "Lease",
    "LeaseHeld",
    "LeaseLost",
    "files_of_period",
    "in_period",
    "read_extents",
    "read_json",
    "reading_schema",
    "remove",
    "run_folder",
    "scan_csv",
    "scan_json",
    "scan_parquet",
    "shared_folder",
    "stage",
    "staging_name",
    "time_extents",
    "update_extents",
    "with_day_parts",
    "write_csv",
    "write_jdbc",
    "write_json",
    "write_partitions",
]
