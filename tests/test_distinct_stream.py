"""Duplicates across the batches of a stream that loads."""

import time
from dataclasses import replace

import pytest
from conftest import rows
from test_plans import PAGES, page

from tidegate.plans import ingest as plans
from tidegate.sinks import files as sink
from tidegate.spec import SpecError
from tidegate.specs import SET_A, SET_B
from tidegate.streaming import ingest as stream

INVOICE = SET_A["invoice"]


def run(spark, source, out, checkpoint, within="1 hour", spec=INVOICE, **options):
    documents = stream.read_stream(spark, spec, source, files_per_batch=1)
    query = stream.start_ingest(documents, spec, out, checkpoint, load_date="2024-09-15", distinct_within=within, **options)
    query.awaitTermination()
    return query


def without_lineage(df):
    return rows(df.drop("job_id", "file_name"))


@pytest.mark.parametrize("salts", [0, 3])
def test_rows_of_earlier_batches_are_dropped(spark, write_file, folder, salts):
    out, checkpoint, once = folder(), folder(), folder()
    source = f"{write_file.folder}/in"
    write_file("in/a.json", PAGES)
    write_file("in/b.json", PAGES + [page("c9", {"id": "77", "invoiceNumber": "n77"})])
    run(spark, source, out, checkpoint, salts=salts)
    write_file("in/c.json", PAGES[::-1])
    run(spark, source, out, checkpoint, salts=salts)
    plans.ingest(spark, INVOICE, f"{source}/b.json", "j", once, load_date="2024-09-15")
    for status in (sink.LOADED, sink.QUARANTINED):
        assert without_lineage(sink.read_loads(spark, out, status)) == without_lineage(sink.read_loads(spark, once, status))
    loaded = sink.read_loads(spark, out).collect()
    assert {row.job_id for row in loaded} == {"invoice_0", "invoice_1"}
    assert {row.file_name.rsplit("/", 1)[1] for row in loaded if row.invoice_id == "77"} == {"b.json"}


def test_state_forgets_rows_after_their_time(spark, write_file, folder):
    out, checkpoint, sizes = folder(), folder(), []
    for n in range(4):
        write_file(f"in/{n}.json", [page("c1", *({"id": str(10 * n + k), "invoiceNumber": "n"} for k in range(5)))])
        query = run(spark, f"{write_file.folder}/in", out, checkpoint, within="1 second")
        sizes.append(sum(operator["numRowsTotal"] for operator in query.lastProgress["stateOperators"]))
        time.sleep(2.5)
    assert sink.read_loads(spark, out).count() == 20
    assert max(sizes) <= 10, sizes


def test_a_batch_that_broke_off_is_loaded_once(spark, write_file, folder, monkeypatch):
    out, checkpoint = folder(), folder()
    write_file("in/a.json", PAGES)
    load, tried = stream.load_rows, []

    def broken(*args, **options):
        result = load(*args, **options)
        tried.append(args[2])
        if len(tried) == 1:
            raise RuntimeError("lost after the write")
        return result

    monkeypatch.setattr(stream, "load_rows", broken)
    with pytest.raises(Exception, match="lost after the write"):
        run(spark, f"{write_file.folder}/in", out, checkpoint)
    run(spark, f"{write_file.folder}/in", out, checkpoint)
    assert tried[:2] == ["invoice_0", "invoice_0"] and sink.read_loads(spark, out).count() == 3


def test_nulls_misfits_and_values_that_look_alike(spark, write_file, folder):
    spec, out, checkpoint = SET_B["codat_bills"], folder(), folder()
    bill = lambda key, **values: {"results": [{"id": key, **values}]}
    write_file("in/a.json", [bill("1"), bill("1", currency=""), bill("2", totalAmount="x"), bill("2", totalAmount="y")])
    write_file("in/b.json", [bill("1", currency=""), bill("1"), bill("2", totalAmount="y"), bill("2", totalAmount=3)])
    run(spark, f"{write_file.folder}/in", out, checkpoint, spec=spec)
    assert sorted((r.bill_id, r.curr, r.total_amt) for r in sink.read_loads(spark, out).collect() if r.curr is not None) == [("1", "", None)]
    assert sink.read_loads(spark, out).count() == 3
    assert sorted(r.corrupt_record for r in sink.read_loads(spark, out, sink.QUARANTINED).collect()) == [
        '{"results_totalAmount":"x"}', '{"results_totalAmount":"y"}']


def test_tenant_of_the_file_is_refused(spark, write_file, folder):
    write_file("in/a.json", PAGES)
    with pytest.raises(SpecError):
        run(spark, f"{write_file.folder}/in", folder(), folder(), spec=replace(INVOICE, tenant_scope="file"))
