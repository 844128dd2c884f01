"""Snapshots of the audit log."""

import os
import shutil
from datetime import datetime, timezone

import pytest
from conftest import rows

from tidegate.sinks import audit


def log_states(spark, path, *states):
    for job, status, day, hour in states:
        moment = datetime(2024, 9, day, hour, tzinfo=timezone.utc)
        audit.append_audit(audit.audit_row(spark, job, "d", status, "s", moment, moment, total=hour), path)


FIRST = [("a", "STARTED", 1, 1), ("a", "COMPLETED", 1, 2), ("b", "STARTED", 2, 1), ("c", "STARTED", 3, 1)]
LATER = [("b", "COMPLETED", 4, 5), ("d", "STARTED", 5, 1)]


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_snapshot_and_tail_equal_the_whole_log(spark, folder):
    log = folder()
    log_states(spark, log, *FIRST)
    assert audit.snapshot_audit(spark, log, "2024-09-02") == "2024-09-02"
    log_states(spark, log, *LATER)
    whole = rows(audit.latest_state(audit.read_audit(spark, log)).drop("event_date"))
    assert rows(audit.latest_audit(spark, log)) == whole
    assert {r["job_id"]: r["status"] for r in whole} == {"a": "COMPLETED", "b": "COMPLETED", "c": "STARTED", "d": "STARTED"}
    # Days that the snapshot covers are not needed any more.
    for day in (1, 2):
        shutil.rmtree(local(f"{log}/event_date=2024-09-0{day}"))
    assert rows(audit.latest_audit(spark, log)) == whole
    assert audit.snapshot_audit(spark, log, "2024-09-04") == "2024-09-04"
    for day in (3, 4):
        shutil.rmtree(local(f"{log}/event_date=2024-09-0{day}"))
    assert rows(audit.latest_audit(spark, log)) == whole
    assert sorted(os.listdir(local(f"{log}/_snapshots"))) == ["2024-09-02", "2024-09-04"]


def test_snapshots_do_not_go_back_and_are_not_made_twice(spark, folder):
    log = folder()
    log_states(spark, log, *FIRST)
    audit.snapshot_audit(spark, log, "2024-09-03")
    before = os.stat(local(f"{log}/_snapshots/2024-09-03")).st_mtime_ns
    assert audit.snapshot_audit(spark, log, "2024-09-01") == audit.snapshot_audit(spark, log, "2024-09-03") == "2024-09-03"
    assert os.stat(local(f"{log}/_snapshots/2024-09-03")).st_mtime_ns == before


def test_a_snapshot_that_broke_off_is_not_read(spark, folder, monkeypatch):
    log = folder()
    log_states(spark, log, *FIRST[:2])
    with monkeypatch.context() as patched:
        patched.setattr(audit, "rename_folder", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            audit.snapshot_audit(spark, log, "2024-09-02")
    assert audit.latest_snapshot(spark, log) is None and audit.latest_audit(spark, log).count() == 1
    assert audit.snapshot_audit(spark, log, "2024-09-02") == "2024-09-02"
    assert os.listdir(local(f"{log}/_snapshots")) == ["2024-09-02"]


def test_no_log_and_open_days(spark, folder):
    log = folder()
    assert audit.latest_audit(spark, log).count() == 0
    moment = audit.now()
    audit.append_audit(audit.audit_row(spark, "j", "d", "STARTED", "s", moment, moment), log)
    assert audit.snapshot_audit(spark, log) < str(moment.date())
    assert [r.job_id for r in audit.latest_audit(spark, log).collect()] == ["j"]
