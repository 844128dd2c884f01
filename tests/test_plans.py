import json
import re
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidegate.operators.quality import FLAG
from tidegate.plans import ingest as plans
from tidegate.plans.medallion import BRONZE_RUNS, clean_runs, clean_users, runner_performances
from tidegate.sinks import audit
from tidegate.sinks import files as sink
from tidegate.sources.files import read_csv
from tidegate.spec import DatasetSpec, SpecError
from tidegate.specs import MONTHLY_INVOICE, SET_A, SET_B

INVOICE = SET_A["invoice"]


def page(tenant, *results):
    return {"_links": {"self": {"href": f"/companies/{tenant}/data"}}, "results": list(results)}


PAGES = [
    page("c1", {"id": "1", "invoiceNumber": "n1", "totalAmount": 2.5, "lines": [{"amount": 1}, {"amount": 2}]},
         {"id": "1", "invoiceNumber": "n1", "totalAmount": 2.5}, {"id": None, "invoiceNumber": "n2"}),
    page("c2", {"id": "2", "invoiceNumber": "n3", "metadata": {"isDeleted": True}}, {"id": "3", "invoiceNumber": ""}),
    page("c3"),
]


def test_invoice_load(spark, write_file, folder):
    path, out, log = write_file("Invoices_1.json", PAGES), folder(), folder()
    result = plans.ingest(spark, INVOICE, path, "job_1", out, audit=log, load_date="2024-09-15", file_name="f")
    assert (result.total, result.loaded, result.rejected) == (5, 3, 2)
    loaded = sink.read_loads(spark, out)
    assert loaded.columns == [*INVOICE.targets, "company_id"]
    assert rows(loaded.select("invoice_id", "invoice_no", "total_amt", "company_id", "job_id", "file_name", "file_load_dt")) == [
        {"invoice_id": i, "invoice_no": n, "total_amt": a, "company_id": c, "job_id": "job_1", "file_name": "f",
         "file_load_dt": "2024-09-15"} for i, n, a, c in [("1", "n1", 2.5, "c1"), ("2", "n3", None, "c2"), ("3", "", None, "c2")]
    ]
    bad = spark.read.parquet(result.quarantine_path)
    assert {(row.invoice_no, row.company_id) for row in bad.collect()} == {("n2", "c1"), (None, "c3")}
    state = audit.latest_state(audit.read_audit(spark, log)).first()
    assert (state.status, state.total_record_count, state.dq_file_path) == ("COMPLETED", 5, result.quarantine_path)


def test_rerun_gives_the_same_table(spark, write_file, folder):
    path, out = write_file("i.json", PAGES), folder()
    plans.ingest(spark, INVOICE, path, "job_1", out, load_date="2024-09-15")
    before = rows(sink.read_loads(spark, out))
    plans.ingest(spark, INVOICE, path, "job_1", out, load_date="2024-09-15")
    assert rows(sink.read_loads(spark, out)) == before


def test_each_row_names_its_own_file(spark, write_file, folder):
    write_file("in/a.json", PAGES[:1])
    write_file("in/b.json", PAGES[1:2])
    out = folder()
    plans.ingest(spark, INVOICE, f"{write_file.folder}/in", "j", out)
    assert {(row.company_id, row.file_name.rsplit("/", 1)[1]) for row in sink.read_loads(spark, out).collect()} == {
        ("c1", "a.json"), ("c2", "b.json"),
    }


def test_tenant_of_the_whole_file(spark, write_file, folder):
    path, out = write_file("i.json", PAGES), folder()
    plans.ingest(spark, replace(INVOICE, tenant_scope="file"), path, "j", out)
    assert {row.company_id for row in sink.read_loads(spark, out).collect()} == {"c1"}


def test_inferred_schema_pads_absent_columns(spark, write_file, folder):
    path, out = write_file("i.json", [page("c1", {"id": "1"})]), folder()
    result = plans.ingest(spark, replace(INVOICE, input_schema=None), path, "j", out)
    assert result.loaded == 1
    assert sink.read_loads(spark, out).first().invoice_no == ""


def test_files_without_link_get_no_tenant(spark, write_file, folder):
    spec = DatasetSpec("plain", ("id", "amount", "job_id"), {"id": "key"}, ("key",), {"amount": "double"})
    path, out = write_file("p.json", [{"id": 1, "amount": "7"}, {"id": 2, "amount": "?"}]), folder()
    plans.ingest(spark, spec, path, "j", out)
    assert rows(sink.read_loads(spark, out)) == [
        {"key": 1, "amount": 7.0, "job_id": "j"},
    ]
    assert rows(sink.read_loads(spark, out, sink.QUARANTINED)) == [
        {"key": 2, "amount": None, "job_id": "j", "corrupt_record": '{"amount":"?"}', "misfit_columns": ["amount"]},
    ]


def test_pipe_file(spark, write_file, folder):
    path, out = write_file("TPSClaims_x.txt", "Identifier|OrgIdentifier|Extra\n1|2|z\n1|2|z\n3||z\n"), folder()
    result = plans.ingest(spark, SET_A["trizetto_claims"], path, "j", out, load_date="2024-09-15")
    assert (result.total, result.loaded, result.rejected, result.quarantine_path) == (2, 2, 0, "")
    got = sink.read_loads(spark, out)
    assert got.columns == list(SET_A["trizetto_claims"].targets)
    assert {(row.claim_id, row.org_id, row.bill_prov_npi) for row in got.collect()} == {("1", "2", ""), ("3", None, "")}


def test_bank_feed_multiplies_accounts_and_transactions(spark, write_file, folder):
    feed = {
        "accounts": [{"account_id": "a1", "balances": {"current": 1.0}}, {"account_id": "a2"}],
        "transactions": [{"transaction_id": f"t{n}", "category": ["x", "y"][: n % 3]} for n in range(3)],
    }
    path, out = write_file("transaction.json", [feed]), folder()
    result = plans.ingest(spark, SET_A["transactions"], path, "j", out)
    # Categories of the three transactions: none, one, two.
    assert result.loaded == 2 * (1 + 1 + 2)


def test_report_with_casts(spark, write_file, folder):
    report = {
        "reportInfo": {"companyName": "Co", "generatedDate": "2024-09-15"},
        "reportItems": [{"accountId": "1", "balance": 5, "date": "soon", "accountCategory": {
            "id": "k", "levels": [{"confidence": 9, "levelName": "L1"}, {"confidence": 8, "levelName": "L2"}]}}],
        "_links": {"self": {"href": "/companies/c9"}},
    }
    path, out = write_file("BalanceSheet.json", [report]), folder()
    plans.ingest(spark, SET_B["balance_sheet"], path, "j", out)
    # A date that is none is kept aside with its text instead of being loaded as null.
    got = sink.read_loads(spark, out, sink.QUARANTINED)
    assert {row.corrupt_record for row in got.collect()} == {'{"reportItems_date":"soon"}'}
    assert dict(got.dtypes)["gen_dt"] == "date" and dict(got.dtypes)["confidence"] == "int"
    assert {(row.level_name, row.bal_dt, row.comp_id, row.bal_amt) for row in got.collect()} == {
        ("L1", None, "c9", 5.0), ("L2", None, "c9", 5.0),
    }


def test_empty_file(spark, write_file, folder):
    result = plans.ingest(spark, INVOICE, write_file("e.json", ""), "j", folder())
    assert (result.total, result.loaded, result.rejected) == (0, 0, 0)


def test_wrong_spec_stops_before_reading(spark, folder):
    with pytest.raises(SpecError):
        plans.ingest(spark, SET_A["accounts"], "/does/not/exist", "j", folder())


def test_table_gets_loaded_rows(spark, write_file, folder):
    spark.sql("DROP TABLE IF EXISTS tidegate_staged")
    try:
        plans.ingest(spark, INVOICE, write_file("i.json", PAGES), "j", folder(), table="tidegate_staged")
        assert spark.table("tidegate_staged").count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS tidegate_staged")


def test_plan_has_one_shuffle_one_generator_and_no_python(spark, write_file):
    raw = plans.read_raw(spark, INVOICE, write_file("i.json", PAGES))
    plan = plans.shape_rows(raw, INVOICE, "j", "f", "d")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Generate explode") == 1
    assert "Python" not in plan
    scan = raw.schema["results"].dataType.elementType.fieldNames()
    assert "lines" not in scan and "id" in scan


def test_file_tenant_lookup_reads_only_links(spark, write_file):
    spec = replace(INVOICE, tenant_scope="file")
    raw = plans.read_raw(spark, spec, write_file("i.json", PAGES))
    plan = plans.shape_rows(raw, spec, "j")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1


def test_tenant_of_a_file_parses_the_files_once(spark, write_file):
    spec = replace(INVOICE, tenant_scope="file")
    raw = plans.read_raw(spark, spec, write_file("i.json", PAGES))
    plan = plans.shape_rows(raw, spec, "j")._jdf.queryExecution().executedPlan().toString().lower()
    assert "scan json" not in plan and plan.count("filescan parquet") == 2


def test_nothing_is_lost_in_parsing(spark, write_file, folder):
    good, misfit = json.dumps(page("c1", {"id": "1", "invoiceNumber": "n", "totalAmount": 1.5})), page("c1", {"id": "2", "invoiceNumber": "n", "totalAmount": "12,5"})
    path, out = write_file("i.json", "\n".join([good, json.dumps(misfit), good[:-4]])), folder()
    for spec in (INVOICE, replace(INVOICE, required=())):
        result = plans.ingest(spark, spec, path, "j", out)
        assert (result.loaded, result.rejected, result.corrupt) == (1, 2, 2)
        bad = sorted((row.corrupt_record for row in sink.read_loads(spark, out, sink.QUARANTINED).collect()), key=len)
        assert bad == ['{"results_totalAmount":"12,5"}', good[:-4]]
        loaded = sink.read_loads(spark, out)
        assert "corrupt_record" not in loaded.columns and loaded.first().total_amt == 1.5


def test_run_dataset_and_mixed_folder(spark, write_file, folder):
    invoice = write_file("in/sub_invoices/part.json", PAGES)
    write_file("in/tpspayments_1.txt", "PaymentIdentifier|OrgIdentifier\n1|o\n2|\n")
    write_file("in/Supplier_Invoices.json", [page("c1", {"id": "7", "invoiceNumber": "n7"})])
    write_file("in/readme.txt", "nothing")
    results = plans.run_folder(spark, f"{write_file.folder}/in", "j", folder())
    assert {name: (r.loaded, r.rejected) for name, r in results.items()} == {
        "invoice": (4, 2), "trizetto_payments": (1, 1), "unrouted": (0, 1),
    }
    listed = spark.read.parquet(results["unrouted"].folder).collect()
    assert [row.path.rsplit("/", 1)[1] for row in listed] == ["readme.txt"]
    assert plans.run_dataset(spark, invoice, folder(), "j").loaded == 3
    assert re.fullmatch(r"Invoices_\d{14}_[0-9a-f]{6}", plans.run_dataset(spark, invoice, folder()).job_id)
    assert plans.run_dataset(spark, f"{write_file.folder}/in/readme.txt", folder()) is None


def test_export_flat_csv(spark, write_file, folder):
    write_file("m/1.json", json.dumps({"id": 1, "items": [{"v": "a,b"}, {"v": None}], "s": {"t": True}}, indent=2))
    write_file("m/2.json", json.dumps([{"id": 2, "items": []}], indent=2))
    out = folder()
    plans.export_flat_csv(spark, f"{write_file.folder}/m", out, "id int, items array<struct<v: string>>, s struct<t: boolean>, m map<string, int>")
    got = read_csv(spark, out)
    assert {(row.id, row.items_v, row.s_t) for row in got.collect()} == {("1", "a,b", "true"), ("1", None, "true"), ("2", None, None)}
    plans.export_flat_csv(spark, f"{write_file.folder}/m", out, "id int, items array<struct<v: string>>, s struct<t: boolean>, m map<string, int>")
    assert read_csv(spark, out).count() == 6


def test_validate_files(spark, write_file, folder):
    docs = write_file("d.json", [{"results": [{"accountId": "1", "name": "x"}, {"accountId": None, "name": "y"}]}])
    rules = write_file("rules.json", json.dumps({"dq_id": 1, "rules": [
        {"rule_id": 11, "rule_type": "not null", "name": "n", "description": "d", "columns": ["accountId"]},
        {"rule_id": 12, "rule_type": "not null", "name": "n", "description": "d", "columns": ["name"]},
    ]}))
    log, out = folder(), folder()
    result = plans.validate_files(spark, docs, rules, "j", out, audit=log)
    assert (result.total, result.loaded, result.rejected) == (2, 1, 1)
    assert rows(read_csv(spark, result.folder).select("name", "violated_rules")) == [{"name": "y", "violated_rules": "[11]"}]
    assert audit.latest_state(audit.read_audit(spark, log)).first().error_record_count == 1


def test_every_declared_dataset_validates_or_says_why():
    wrong = {(which, name): spec.problems() for which, specs in (("A", SET_A), ("B", SET_B)) for name, spec in specs.items() if spec.problems()}
    assert set(wrong) == {("A", "accounts"), ("A", "trizetto_org"), ("B", "accounts"), ("B", "trizetto_org")}
    assert any("results_currencyRate" in text for text in wrong["B", "accounts"])
    for which, name in wrong:
        (SET_A if which == "A" else SET_B)[name].repaired().validate()
    MONTHLY_INVOICE.validate()
    assert (len(SET_A), len(SET_B)) == (13, 15)


def test_json_specs_find_all_their_columns_in_their_schema(spark):
    from pyspark.sql.types import StructType
    from tidegate.operators.flatten import flatten

    for spec in [*SET_A.values(), *SET_B.values()]:
        if spec.input_schema:
            empty = spark.createDataFrame([], StructType.fromDDL(spec.input_schema))
            assert set(spec.source_columns) <= set(flatten(empty).columns), spec.name


def test_spec_from_a_parsed_document():
    conf = {
        "raw_json_flatten_columns": ["a", "b ", "job_id"], "raw_json_2_database": {"a": "x", "z": "unused"},
        "raw_2_db_cast": {"b": "double"}, "company_id_column": "link", "company_id_regex": "[^/]+",
        "company_id_column_db": "comp_id", "table_bronze_layer": "T",
        "dataquality": {"null_check_columns": "x, b"},
    }
    spec = DatasetSpec.from_mapping("d", conf).validate()
    assert (spec.columns, spec.targets, spec.required) == (("a", "b", "job_id"), ("x", "b", "job_id"), ("x", "b"))
    assert (spec.casts, spec.tenant_target, spec.table) == ({"b": "double"}, "comp_id", "T")
    assert DatasetSpec.from_mapping("d", conf, declared_only=True).tenant_target == "company_id"
    with pytest.raises(SpecError):
        replace(spec, columns=("a", "a")).validate()
    with pytest.raises(SpecError):
        replace(spec, tenant_pattern="[").validate()


def test_spec_from_yaml(write_file):
    yaml = pytest.importorskip("yaml")
    from tidegate.spec import load_yaml

    path = write_file("s.yaml", yaml.safe_dump({"raw_json_flatten_columns": ["a"], "raw_json_2_database": {"a": "b"}}))
    assert DatasetSpec.from_mapping("d", load_yaml(path)).targets == ("b",)


RUNS = """run_id,duration,distance,date,location,temperature,user_id
1,100.5,5000,06/07/2024,"1.0,2.0",12.5°C,1
2,200.5,21097.5,2024/06/11,"1.0,2.0",50°F,2
3,300.5,5000,24-04-2024,"1.0,2.0",-4°F,1
4,400.5,42195,09-06-2024,"1.0,2.0",-1.5°C,1
"""


def test_runs_from_raw_to_curated(spark, write_file):
    bronze = read_csv(spark, write_file("runs.csv", RUNS), BRONZE_RUNS)
    silver = clean_runs(bronze)
    assert silver.select("run_id", "date", "temperature", "distance").orderBy("run_id").collect() == [
        (1, "2024-06-07", 12.5, 5000.0),
        (2, "2024-06-11", 10.0, 21097.5),
        (3, "2024-04-24", -20.0, 5000.0),
        (4, "2024-09-06", -1.5, 42195.0),
    ]
    assert rows(clean_users(bronze)) == [{"user_id": 1}, {"user_id": 2}]
    gold = {row.user_id: row for row in runner_performances(silver).collect()}
    assert gold[1].last_duration_on_5k == 300.5 and gold[1].last_duration_on_marathon == 400.5
    assert gold[1].last_duration_on_10k is None and gold[2].last_duration_on_half_marathon == 200.5


def test_flag_is_the_last_column(spark, write_file):
    raw = plans.read_raw(spark, INVOICE, write_file("i.json", PAGES))
    shaped = plans.shape_rows(raw, INVOICE, "j", load_date=F.lit("2024-01-01"))
    assert shaped.columns[-2:] == ["company_id", FLAG]
