"""Sibling arrays of a document as rows of their own, through one generator."""

import os
from dataclasses import replace

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st

from tidegate.operators.flatten import explode_tagged, flatten, sibling_arrays
from tidegate.plans import ingest as plans
from tidegate.sinks import files as sink
from tidegate.spec import DatasetSpec, SpecError
from tidegate.specs import SET_A

FEED = replace(SET_A["transactions"], arrays="separate").repaired()
SCHEMA = "id int, a array<struct<x: int, deep: array<string>>>, b array<int>, c array<struct<y: string>>"


def documents(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_rows_of_each_array(spark):
    got = flatten(documents(
        spark, (1, [(1, ["p", "q"]), (2, None)], [7, None], [("u",)]), (2, [], None, []), (3, None, [], [None]), (4, None, None, None),
    ), separate="child")
    assert set(got.columns) == {"id", "child", "b", "a_x", "a_deep", "c_y"}
    assert sorted((tuple(r[c] for c in ("id", "child", "a_x", "a_deep", "b", "c_y")) for r in got.collect()), key=str) == sorted([
        (1, "a", 1, "p", None, None), (1, "a", 1, "q", None, None), (1, "a", 2, None, None, None),
        (1, "b", None, None, 7, None), (1, "b", None, None, None, None), (1, "c", None, None, None, "u"),
        (2, "document", None, None, None, None), (3, "c", None, None, None, None), (4, "document", None, None, None, None),
    ], key=str)


def test_siblings_below_a_single_array(spark):
    df = spark.createDataFrame([([([1, 2], ["x"])],)], "results array<struct<m: array<int>, n: array<string>>>")
    assert sibling_arrays(df, {"results_m", "results_n"}) == ["results_m", "results_n"]
    assert sibling_arrays(df, {"results_m"}) == []
    assert rows(flatten(df, separate="child")) == [
        {"child": "results_m", "results_m": 1, "results_n": None}, {"child": "results_m", "results_m": 2, "results_n": None},
        {"child": "results_n", "results_m": None, "results_n": "x"},
    ]


def test_one_generator_and_no_shuffle(spark):
    plan = flatten(documents(spark), separate="child", wanted={"id", "a_x", "b", "c_y"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate ") == 1 and "Exchange" not in plan and "Union" not in plan


def test_names_that_clash(spark):
    with pytest.raises(SpecError):
        explode_tagged(documents(spark), ["a", "b"], "id")


lists = st.one_of(st.none(), st.lists(st.one_of(st.none(), st.integers(0, 3)), max_size=3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(lists, lists), min_size=1, max_size=5))
def test_numbers_of_rows_add_up(spark, data):
    df = spark.createDataFrame([(n, *pair) for n, pair in enumerate(data)], "id int, a array<int>, b array<int>")
    want = sorted(
        (n, name, value) for n, pair in enumerate(data)
        for name, value in ([(name, v) for name, own in zip("ab", pair) for v in own or []] or [("document", None)])
    ) if all(None not in (own or []) for pair in data for own in pair) else None
    got = [(r.id, r.child, r.a if r.child == "a" else r.b) for r in flatten(df, separate="child").collect()]
    assert want is None or sorted(got, key=str) == sorted(want, key=str)
    assert len(got) == sum(max(1, len(a or []) + len(b or [])) for a, b in data)


def feed(key, accounts, payments):
    return {"_links": {"self": {"href": f"/companies/{key}"}}, "accounts": accounts, "transactions": payments}


def test_load_of_separate_arrays(spark, write_file, folder):
    out = folder()
    path = write_file("feed.json", [
        feed("c1", [{"account_id": "a1"}, {"account_id": "a2"}, {"name": "no id"}], [{"transaction_id": "t1", "amount": 1.5, "category": ["x", "y"]}] * 2),
        feed("c2", [], [{"transaction_id": "t2", "amount": "no number"}]), feed("c3", None, []),
    ])
    result = plans.ingest(spark, FEED, path, "j", out)
    assert (result.loaded, result.rejected, result.corrupt) == (4, 3, 1)
    accounts = plans.read_child(spark, out, FEED, "accounts")
    assert {"acc_id", "company_id", "job_id"} <= set(accounts.columns) and not {"trans_id", "child"} & set(accounts.columns)
    assert sorted((r.company_id, r.acc_id) for r in accounts.collect()) == [("c1", "a1"), ("c1", "a2")]
    payments = plans.read_child(spark, out, FEED, "transactions")
    assert "acc_id" not in payments.columns
    assert sorted((r.trans_id, r.trans_amt, r.trans_cat) for r in payments.collect()) == [("t1", 1.5, "x"), ("t1", 1.5, "y")]
    bad = sink.read_loads(spark, out, sink.QUARANTINED).collect()
    assert {(r.company_id, r.child) for r in bad} == {("c1", "accounts"), ("c2", "transactions"), ("c3", "document")}
    assert sorted(os.listdir(f"{out}/load=j/load_status=loaded".removeprefix("file:"))) == ["child=accounts", "child=transactions"]


def test_one_scan_and_one_write(spark, write_file):
    path = write_file("feed.json", [feed("c1", [{"account_id": "a1"}], [{"transaction_id": "t1"}])])
    shaped = plans.shape_rows(plans.read_raw(spark, FEED, path), FEED, "j")
    plan = shaped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") <= 1 and "Union" not in plan
    # One generator for the two arrays, one for the categories of a transaction.
    assert plan.count("Generate ") == 2


def test_spec_with_an_unknown_word():
    with pytest.raises(SpecError):
        DatasetSpec("d", ("a",), arrays="both").validate()
