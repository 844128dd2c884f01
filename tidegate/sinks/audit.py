"""Job audit: an append-only log of states, and a view of each job's latest state.

The log has a folder per day. A snapshot holds the latest states of all jobs up to a day, so that
later reads take it and the days since then; older days are neither read nor listed.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.session import folder_names, remove_folder, rename_folder

STARTED, COMPLETED = "STARTED", "COMPLETED"

AUDIT_SCHEMA = (
    "job_id string, job_description string, total_record_count bigint, load_record_count bigint, "
    "error_record_count bigint, job_start_time string, job_end_time string, source_path string, "
    "dq_file_path string, status string, event_ts timestamp"
)


SNAPSHOTS = "_snapshots"
DAY = "event_date"
# Days that stay out of a snapshot, since states of a day may be written a little after it.
OPEN_DAYS = 2


def now() -> datetime:
    return datetime.now(timezone.utc)


def compact(moment: datetime) -> str:
    return moment.strftime("%Y%m%d%H%M%S")


def audit_row(
    spark: SparkSession,
    job_id: str,
    description: str,
    status: str,
    source_path: str,
    started: datetime,
    at: datetime,
    total: int = 0,
    loaded: int = 0,
    rejected: int = 0,
    dq_path: str = "",
) -> DataFrame:
    row = (job_id, description, total, loaded, rejected, compact(started), compact(at), source_path, dq_path, status, at)
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def append_audit(row: DataFrame, path: str) -> None:
    """Add one state, in a folder per day so that readers can skip old days."""
    row.withColumn("event_date", F.to_date("event_ts")).coalesce(1).write.mode("append").partitionBy(
        "event_date"
    ).parquet(path)


def latest_state(log: DataFrame, key: str = "job_id", order: str = "event_ts") -> DataFrame:
    """The last row of each job, reduced map-side before the shuffle.

    States of the same moment are told apart by their other columns, so the
    answer does not depend on row order.
    """
    others = [name for name in log.columns if name not in (key, order)]
    last = F.max(F.struct(order, *others)).alias("last")
    return log.groupBy(key).agg(last).select(key, "last.*").select(*log.columns)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def latest_snapshot(spark: SparkSession, path: str) -> str | None:
    """The day up to which there is a snapshot, as text."""
    days = [name for name in folder_names(spark, f"{path.rstrip('/')}/{SNAPSHOTS}") if not name.startswith(("next-", "."))]
    return max(days, default=None)


def _states_since(spark: SparkSession, path: str, after: str | None, upto: str | None = None) -> DataFrame:
    """The latest snapshot's states and those of the log's days after it, up to a day where one is given."""
    root = path.rstrip("/")
    days = sorted(name for name in folder_names(spark, root) if name.startswith(f"{DAY}="))
    chosen = [f"{root}/{name}" for name in days
              if (after is None or name > f"{DAY}={after}") and (upto is None or name <= f"{DAY}={upto}")]
    folders = ([f"{root}/{SNAPSHOTS}/{after}"] if after else []) + chosen
    reader = spark.read.schema(AUDIT_SCHEMA)
    return reader.parquet(*folders) if folders else spark.createDataFrame([], AUDIT_SCHEMA)


def snapshot_audit(spark: SparkSession, path: str, upto: str | date | None = None) -> str | None:
    """Write the latest states of all jobs up to a day (by default the last that is surely over); gives the snapshot's day.

    It is made from the snapshot before and the days since, and takes its name in one rename. The
    one before is kept for readers that began with it. A day that has a snapshot already, or lies
    before one, changes nothing. States that are logged later for a day that a snapshot covers are not seen.
    """
    day = str(upto or now().date() - timedelta(days=OPEN_DAYS))
    before, root = latest_snapshot(spark, path), f"{path.rstrip('/')}/{SNAPSHOTS}"
    if before is not None and day <= before:
        return before
    latest_state(_states_since(spark, path, before, day)).write.mode("overwrite").parquet(f"{root}/next-{day}")
    rename_folder(spark, f"{root}/next-{day}", f"{root}/{day}")
    for name in folder_names(spark, root):
        if name not in (day, before):
            remove_folder(spark, f"{root}/{name}")
    return day


def latest_audit(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of each job, from the latest snapshot and the days since then."""
    return latest_state(_states_since(spark, path, latest_snapshot(spark, path)))
