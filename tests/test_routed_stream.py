"""One stream over files of all datasets."""

import os
from urllib.parse import unquote

import pytest
from conftest import rows
from test_plans import PAGES

from tidegate.plans import ingest as plans
from tidegate.sinks import audit
from tidegate.sinks import files as sink
from tidegate.streaming.ingest import start_routed, watch_folder


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def files_of(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(local(root)) for f in names}


def land(write_file):
    write_file("in/Invoices_1.json", PAGES[:1])
    write_file("in/2024/09 15/invoices [2].json", PAGES[1:])
    write_file("in/x/TPSPayments_1.txt", "PaymentIdentifier|OrgIdentifier\n1|o\n2|\n")
    write_file("in/x/TPSPayments_2.txt", "OrgIdentifier|PayeeName|PaymentIdentifier\np|Ann|3\n")
    write_file("in/notes.txt", "nothing\n")
    return f"{write_file.folder}/in"


def run(spark, source, out, checkpoint, **options):
    start_routed(spark, source, out, checkpoint, load_date="2024-09-15", **options).awaitTermination()


def state(spark, out):
    return {
        name: {status: rows(sink.read_loads(spark, f"{out}/{name}", status).drop("job_id")) for status in (sink.LOADED, sink.QUARANTINED)}
        for name in ("invoice", "trizetto_payments")
    }


@pytest.mark.parametrize("files_per_batch", [None, 1, 2])
def test_stream_equals_a_folder_load(spark, write_file, folder, files_per_batch):
    source, out, checkpoint, batch = land(write_file), folder(), folder(), folder()
    run(spark, source, out, checkpoint, files_per_batch=files_per_batch)
    plans.run_folder(spark, source, "j", batch, load_date="2024-09-15")
    assert state(spark, out) == state(spark, batch)
    assert [unquote(r.path).rsplit("/", 1)[1] for r in spark.read.parquet(f"{out}/unrouted").collect()] == ["notes.txt"]


def test_files_that_come_later_are_taken_once(spark, write_file, folder):
    source, out, checkpoint, log = land(write_file), folder(), folder(), folder()
    run(spark, source, out, checkpoint, audit=log)
    before = files_of(f"{out}/invoice")
    write_file("in/later/TPSPAYMENTS_3.txt", "PaymentIdentifier|OrgIdentifier\n4|o\n")
    run(spark, source, out, checkpoint, audit=log)
    run(spark, source, out, checkpoint, audit=log)
    assert files_of(f"{out}/invoice") == before
    assert sorted(r.pay_id for r in sink.read_loads(spark, f"{out}/trizetto_payments").collect()) == ["1", "3", "4"]
    states = audit.latest_state(audit.read_audit(spark, log)).collect()
    assert {r.status for r in states} == {"COMPLETED"}
    assert os.listdir(local(f"{checkpoint}/routed")) == ["1"]


def test_a_batch_that_broke_off_goes_on_with_the_next_dataset(spark, write_file, folder, monkeypatch):
    source, out, checkpoint = land(write_file), folder(), folder()
    ingest, tried = plans.ingest, []

    def broken(spark, spec, *args, **options):
        tried.append(spec.name)
        if spec.name == "invoice":
            raise RuntimeError("lost")
        return ingest(spark, spec, *args, **options)

    monkeypatch.setattr(plans, "ingest", broken)
    with pytest.raises(Exception, match="lost"):
        run(spark, source, out, checkpoint)
    assert tried == ["trizetto_payments", "invoice"]
    done = files_of(f"{out}/trizetto_payments")
    monkeypatch.setattr(plans, "ingest", lambda spark, spec, *args, **options: tried.append(spec.name) or ingest(spark, spec, *args, **options))
    run(spark, source, out, checkpoint)
    assert tried[2:] == ["invoice"] and files_of(f"{out}/trizetto_payments") == done
    batch = folder()
    plans.run_folder(spark, source, "j", batch, load_date="2024-09-15")
    assert state(spark, out) == state(spark, batch)


def test_a_dataset_that_broke_off_replaces_its_load(spark, write_file, folder, monkeypatch):
    source, out, checkpoint = land(write_file), folder(), folder()
    load, seen = plans.load_rows, []

    def broken(spark, rows, job_id, output, **options):
        result = load(spark, rows, job_id, output, **options)
        seen.append(output.rsplit("/", 1)[1])
        if seen == ["trizetto_payments"]:
            raise RuntimeError("lost after the write")
        return result

    monkeypatch.setattr(plans, "load_rows", broken)
    with pytest.raises(Exception, match="lost after the write"):
        run(spark, source, out, checkpoint)
    run(spark, source, out, checkpoint)
    assert seen == ["trizetto_payments", "trizetto_payments", "invoice"]
    assert sorted(r.pay_id for r in sink.read_loads(spark, f"{out}/trizetto_payments").collect()) == ["1", "3"]


def test_the_stream_carries_paths_only(spark, write_file):
    write_file("in/a.txt", "x")
    stream = watch_folder(spark, f"{write_file.folder}/in")
    assert stream.columns == ["path"] and stream.isStreaming
