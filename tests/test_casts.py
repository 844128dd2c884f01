"""Values that do not fit a dataset's declared casts: kept, quarantined and counted."""

import json
from dataclasses import replace

import pytest
from conftest import rows

from tidegate.operators import shape
from tidegate.plans import ingest as plans
from tidegate.sinks import files as sink
from tidegate.specs import SET_A, SET_B

BILLS = SET_B["codat_bills"]


def bill(key, **values):
    return {"_links": {"self": {"href": f"/companies/c{key}/bills"}}, "results": [{"id": str(key), **values}]}


def test_misfits_of_json_are_quarantined_with_name_and_text(spark, write_file, folder):
    out = folder()
    path = write_file("bills.json", [
        bill(1, totalAmount=1.5, issueDate="2024-01-31", dueDate=""),
        bill(2, totalAmount=2, issueDate="not a date", dueDate="31/31/2024"),
        bill(3, totalAmount="12,5", amountDue=" "),
        bill(4, totalAmount=None),
        bill(2, totalAmount=2, issueDate="not a date", dueDate="31/31/2024"),
    ])
    result = plans.ingest(spark, BILLS, path, "j", out)
    assert (result.loaded, result.rejected, result.corrupt) == (2, 2, 2)
    assert result.misfits == {"results_issueDate": 1, "results_dueDate": 1, "results_totalAmount": 1}
    bad = {row.bill_id: row for row in sink.read_loads(spark, out, sink.QUARANTINED).collect()}
    assert json.loads(bad["2"].corrupt_record) == {"results_issueDate": "not a date", "results_dueDate": "31/31/2024"}
    assert sorted(bad["2"].misfit_columns) == ["results_dueDate", "results_issueDate"]
    assert json.loads(bad["3"].corrupt_record) == {"results_totalAmount": "12,5"} and bad["3"].total_amt is None
    good = sink.read_loads(spark, out)
    assert shape.CORRUPT not in good.columns and shape.MISFITS not in good.columns
    assert {r.bill_id: (r.total_amt, str(r.bills_issue_dt), r.bills_due_dt) for r in good.collect()} == {
        "1": (1.5, "2024-01-31", None), "4": (None, "None", None)}


def test_a_broken_record_keeps_its_own_text_and_is_no_misfit(spark, write_file, folder):
    out = folder()
    text = json.dumps(bill(1, totalAmount="x"))
    result = plans.ingest(spark, BILLS, write_file("bills.json", f"{text}\n{text[:-9]}\n"), "j", out)
    assert (result.rejected, result.corrupt, result.misfits) == (2, 2, {"results_totalAmount": 1})
    assert text[:-9] in {row.corrupt_record for row in sink.read_loads(spark, out, sink.QUARANTINED).collect()}


def test_misfits_of_pipe_files(spark, write_file, folder):
    out = folder()
    spec = replace(SET_A["trizetto_payments"], casts={"PaymentAmount": "double", "PaymentDate": "date", "CheckDate": "date"})
    path = write_file("p.txt", "PaymentIdentifier|OrgIdentifier|PaymentAmount|PaymentDate\n1|o|5|2024-01-01\n2|o|five|2024-01-01\n3|o||x\n4||y|z\n")
    result = plans.ingest(spark, spec, path, "j", out)
    assert (result.loaded, result.rejected, result.corrupt) == (1, 3, 3)
    assert result.misfits == {"PaymentAmount": 2, "PaymentDate": 2}
    (good,) = sink.read_loads(spark, out).collect()
    assert (good.pay_amt, str(good.pay_dt), good.check_dt) == (5.0, "2024-01-01", None)


def test_a_load_run_again_counts_once(spark, write_file, folder):
    out, path = folder(), write_file("bills.json", [bill(1, totalAmount="x"), bill(2, amountDue="y")])
    results = [plans.ingest(spark, BILLS, path, "j", out) for _ in range(2)]
    assert [r.misfits for r in results] == [{"results_totalAmount": 1, "results_amountDue": 1}] * 2


def test_datasets_without_casts_have_no_column_of_misfits(spark, write_file, folder):
    out = folder()
    result = plans.ingest(spark, SET_A["codat_bills"], write_file("bills.json", [bill(1, totalAmount="x"), bill(2)]), "j", out)
    assert result.misfits == {} and result.corrupt == 1
    assert shape.MISFITS not in sink.read_loads(spark, out, sink.QUARANTINED).columns


@pytest.mark.parametrize(("value", "kind", "fits"), [
    (1.0, "integer", False), (7, "double", True), (True, "boolean", True), (" ", "date", True), ("", "long", True), ("1e3", "double", True),
    ("2024-02-30", "date", False), ("maybe", "boolean", False), ("9999999999", "integer", False), (None, "date", True), ("x", "string", True),
])
def test_what_fits_a_type(spark, value, kind, fits):
    name = {str: "string", float: "double", int: "int", bool: "boolean", type(None): "string"}[type(value)]
    df = spark.createDataFrame([(value,)], f"`a.b` {name}")
    (row,) = shape.settle_types(df, {}, casts={"a.b": kind, "other": "date"}, misfits="bad").collect()
    assert row.bad == (None if fits else ["a.b"]) and (row.corrupt_record is None) == fits


def test_typed_text_and_declared_casts_in_one_step(spark):
    df = spark.createDataFrame([("1", "x", "y"), ("z", "2", ""), (None, None, None)], "a string, b string, c string")
    got = rows(shape.settle_types(df, {"a": "int", "b": "int"}, casts={"b": "double", "c": "date"}, misfits="bad"))
    assert [(r["a"], r["b"], r["c"], r["bad"]) for r in got] == [
        (1, None, None, ["b", "c"]), (None, 2.0, None, ["a"]), (None, None, None, None)]


def test_every_dataset_of_both_sets_names_its_table():
    for specs in (SET_A, SET_B):
        tables = [spec.table for spec in specs.values()]
        assert all(tables) and len(set(tables)) == len(tables)
