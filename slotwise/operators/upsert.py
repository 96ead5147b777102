"""Keyed upsert of frames and of partitioned tables."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from slotwise.functions import quoted
from slotwise.operators.quality import require_unique
from slotwise.sources.files import TIME_FORMAT
from slotwise.sources.lease import STALE_SECONDS, Lease
from slotwise.sources.sinks import PARTITIONS, with_day_parts, with_days_together, write_partitions
from slotwise.sources.staging import file_system, is_complete, move_folder, remove, run_folder, stage, subfolders

# Staged rows up to which their keys are counted and joined, for which Spark may broadcast them; more meet the target in one shuffle.
JOINED_ROWS = 1_000_000
# Rows that one task is given in that shuffle; keys are unique, so no key is heavier than another.
TASK_ROWS = 1_000_000
REPEATED = "slotwise: repeated keys"


def upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str], hash_build: bool = False) -> DataFrame:
    """The target with rows of equal key replaced and new keys added.

    Keys are expected to be unique on both sides, so neither side of the join
    has a heavy key. Empty parts of a key equal each other. With ``hash_build`` the staged keys are hashed
    after a shuffle, so that the target's rows are not sorted.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    found = staged.select(*[F.col(quoted(k)).alias(name) for k, name in zip(keys, names, strict=True)])
    same = reduce(operator.and_, [F.col(quoted(k)).eqNullSafe(F.col(name)) for k, name in zip(keys, names, strict=True)])
    kept = target.join(found.hint("shuffle_hash") if hash_build else found, same, "left_anti")
    return kept.select(*map(quoted, target.columns)).unionByName(staged)


def read_target(spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet") -> DataFrame:
    """The target table, or an empty frame of its schema if there is none yet.

    The limit lets the optimizer know that it is empty and drop joins to it.
    """
    location, files = file_system(spark, path)
    if not files.exists(location):
        return spark.createDataFrame([], schema).limit(0)
    return spark.read.schema(schema).option("timestampNTZFormat", TIME_FORMAT).format(file_format).load(path)


def upsert_table(
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    day_column: str,
    work: str | None = None,
    file_format: str = "parquet",
) -> None:
    """Stage the updates in a folder of their own, ``merge_staged``, and remove
    the folder. ``work`` is a shared folder to stage in, by default the one
    that the session names."""
    spark = updates.sparkSession
    folder = run_folder(spark, work)
    merge_staged(stage(updates, folder, "upsert-staging"), path, keys, day_column, file_format)
    remove(spark, folder)


def merge_staged(
    staged: DataFrame,
    path: str,
    keys: Sequence[str],
    day_column: str,
    file_format: str = "parquet",
    wait: float = 0.0,
    stale: float = STALE_SECONDS,
    lookup: Sequence[str] = (),
) -> None:
    """Upsert staged rows into a table of files partitioned by year, month and
    day, which is made if there is none.

    Only the days that the rows fall on are read and rewritten, and a rerun
    with the same rows leaves the same table. ``day_column`` must be one of the
    keys, so that a key never moves to another partition. Repeated keys are an
    error.

    One merge works on a table at a time: it holds a lease, and another raises
    ``LeaseHeld``, after ``wait`` seconds if it may wait. The merged days are written once, in
    a folder of this merge beside the table, and moved to their places when all
    are there. If the driver is lost, its lease is void after ``stale`` seconds,
    and the next merge starts by moving what was complete and removing what was
    not, so no row is lost.

    The merged days are written in the order of ``lookup``, with Bloom filters on
    these columns in Parquet files: a search for one key then reads little of a day.
    """
    if day_column not in keys:
        raise ValueError(f"{day_column} must be part of the key {tuple(keys)}")
    spark = staged.sparkSession
    schema = with_day_parts(staged, day_column).schema
    beside = merging_folder(path)
    with Lease(spark, beside, stale, wait) as lease:
        for left in subfolders(spark, beside):
            finish_merge(spark, left, path, lease)
        new = with_day_parts(staged, day_column)
        found = day_span(new, day_column)
        if not found["rows"]:
            return
        target = touched(read_target(spark, path, schema, file_format), new, found["first"], found["last"])
        folder = f"{beside}/{lease.name}"
        if found["rows"] <= JOINED_ROWS:
            if key_span(staged, keys, day_column)["copies"] > 1:
                require_unique(staged, keys)
            write_partitions(upsert(target, new, keys), folder, file_format, replace_days=False, lookup=lookup)
        else:
            most = found["most"] + (rows_together(target).agg(F.max("_rows")).first()[0] or 0)
            rows = met_in_one_shuffle(target, new, keys, day_column, most, found["groups"], lookup)
            try:
                write_partitions(rows, folder, file_format, replace_days=False, lookup=lookup, dealt=True)
            except Exception as error:
                if REPEATED in str(error):
                    remove(spark, folder)
                    require_unique(staged, keys)
                raise
        finish_merge(spark, folder, path, lease)


def rows_together(df: DataFrame) -> DataFrame:
    """``_rows`` of each group of days that ``write_partitions`` deals together, of a frame with the partition columns."""
    return with_days_together(df).groupBy(*PARTITIONS[:2], "_days").agg(F.count(F.lit(1)).alias("_rows"))


def day_span(new: DataFrame, day_column: str) -> Row:
    """Of rows with the partition columns: how many there are, the most in one group
    of days, the groups, the first and the last day. No key is gathered for it."""
    day = F.to_date(day_column)
    dated = with_days_together(new).groupBy(*PARTITIONS[:2], "_days")
    counted = dated.agg(F.count(F.lit(1)).alias("_rows"), F.min(day).alias("_first"), F.max(day).alias("_last"))
    return counted.agg(
        F.sum("_rows").alias("rows"),
        F.max("_rows").alias("most"),
        F.count(F.lit(1)).alias("groups"),
        F.min("_first").alias("first"),
        F.max("_last").alias("last"),
    ).first()


def met_in_one_shuffle(
    target: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    day_column: str,
    most: int,
    groups: int,
    lookup: Sequence[str] = (),
) -> DataFrame:
    """``upsert`` of frames with the partition columns, with one shuffle that also deals the rows for the write.

    Rows meet by group of days and by a bucket of their key, as many buckets as
    the ``most`` rows of one of the ``groups`` ask for, and there are tasks enough for all. The bucket looks at the time of day
    instead of the time, so that an entity's rows of several days stay side by
    side, which compresses them, and no entity fills a bucket alone. Repeated new keys fail the job.
    Rows are sorted once, to find equal keys, in an order that suits the write as well, if ``lookup`` is part of the key.
    """
    buckets = -(-most // TASK_ROWS)
    clock = [part(day_column) for part in (F.hour, F.minute, F.second)]
    others = [k for k in keys if k != day_column]
    both = target.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    both = with_days_together(both).withColumn("_bucket", F.pmod(F.hash(*clock, *map(quoted, others)), F.lit(buckets)))
    by = [*PARTITIONS[:2], "_days", "_bucket"]
    tasks = 2 * groups * buckets
    session = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(tasks, *by) if tasks > session else both.repartition(*by)
    order = dict.fromkeys([*PARTITIONS, *(quoted(c) for c in lookup if c in others), quoted(day_column), *map(quoted, others), *by])
    copies = F.sum("_new").over(Window.partitionBy(*order))
    marked = dealt.withColumn("_copies", copies)
    repeated = F.raise_error(F.lit(REPEATED)).cast("boolean")
    kept = F.when(F.col("_copies") > 1, repeated).otherwise((F.col("_new") == 1) | (F.col("_copies") == 0))
    return marked.where(kept).select(*map(quoted, target.columns))


def key_span(staged: DataFrame, keys: Sequence[str], day_column: str) -> Row:
    """In one pass over the keys of the staged rows: how many there are, the most
    copies of one, the first and the last day."""
    day = F.to_date(day_column)
    counted = staged.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.agg(
        F.max("_copies").alias("copies"),
        F.count(F.lit(1)).alias("keys"),
        F.min(day).alias("first"),
        F.max(day).alias("last"),
    ).first()


def merging_folder(path: str) -> str:
    """Where merges keep their lease, and their results until these have reached the table at ``path``."""
    return f"{path.rstrip('/')}-merging"


def finish_merge(spark: SparkSession, folder: str, path: str, lease: Lease) -> None:
    """Move the days that a merge has written to ``folder`` to their places, if
    it has written all. Days that were moved already are no longer there, so
    this can be done again."""
    if is_complete(spark, folder):
        for year in subfolders(spark, folder):
            for month in subfolders(spark, year):
                for day in subfolders(spark, month):
                    lease.check()
                    move_folder(spark, day, "/".join([path.rstrip("/"), *day.split("/")[-3:]]))
    lease.check()
    remove(spark, folder)


def touched(target: DataFrame, staged: DataFrame, first: date, last: date) -> DataFrame:
    """Target rows in the partitions that staged rows fall into. The range of
    days, as literals, prunes the listing of the target's partitions; the days
    themselves are as many as the calendar has in that range, so they are
    broadcast."""
    day = F.make_date(*[F.col(part) for part in PARTITIONS])
    days = staged.select(*PARTITIONS).distinct()
    return target.where(day.between(F.lit(first), F.lit(last))).join(F.broadcast(days), list(PARTITIONS), "left_semi")
