"""Many multi-line JSON documents in one file."""

import json

import pytest
from conftest import rows

from tidegate.plans import ingest as plans
from tidegate.sinks import files as sink
from tidegate.sources.files import read_json_records
from tidegate.spec import DatasetSpec, SpecError

SCHEMA = "id bigint, inner struct<a: array<struct<b: string>>>, bad string"


def read(spark, path, schema=SCHEMA, **options):
    return read_json_records(spark, path, schema, columnNameOfCorruptRecord="bad", **options)


def document(n):
    return {"id": n, "inner": {"a": [{"b": f"x{n}"}, {"b": "} {\n}"}]}}


def values(df):
    return sorted((r.id, r.inner.a[0].b if r.inner else None, r.bad) for r in df.collect())


@pytest.mark.parametrize("between", ["\n", ",\n", "\n\n  \n", "\r\n"])
def test_documents_one_after_another(spark, write_file, between):
    path = write_file("d.json", between.join(json.dumps(document(n), indent=2) for n in range(5)))
    assert values(read(spark, path)) == [(n, f"x{n}", None) for n in range(5)]


@pytest.mark.parametrize("mark", ["", "﻿"])
def test_an_array_of_documents(spark, write_file, mark):
    path = write_file("d.json", mark + json.dumps([document(n) for n in range(5)], indent=2) + "\n")
    assert values(read(spark, path, record_end="\n  }")) == [(n, f"x{n}", None) for n in range(5)]
    assert values(read(spark, write_file("e.json", "[]\n"), record_end="\n  }")) == []


def test_windows_line_ends(spark, write_file):
    text = "\r\n".join(json.dumps(document(n), indent=2).replace("\n", "\r\n") for n in range(3))
    assert values(read(spark, write_file("d.json", text))) == [(n, f"x{n}", None) for n in range(3)]


def test_many_tasks_read_one_file(spark, write_file):
    path = write_file("d.json", "\n".join(json.dumps(document(n), indent=1) for n in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        found = read(spark, path)
        assert found.rdd.getNumPartitions() > 10
        assert values(found) == [(n, f"x{n}", None) for n in range(2000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_broken_documents_are_kept(spark, write_file):
    texts = [json.dumps(document(n), indent=2) for n in range(5)]
    texts[1] = texts[1].replace('"id":', '"id')
    texts[3] = texts[3][:-2] + ","  # its end is lost: the next one goes with it
    found = read(spark, write_file("d.json", "\n".join(texts) + "\nleft over"))
    assert [v for v in values(found.where("bad IS NULL"))] == [(0, "x0", None), (2, "x2", None)]
    bad = sorted(r.bad for r in found.where("bad IS NOT NULL").collect())
    assert len(bad) == 3 and texts[1] in bad and f"{texts[3]}\n{texts[4]}" in bad and bad[0].startswith("left over") | bad[-1].startswith("left over")


def test_empty_files(spark, write_file):
    write_file("in/a.json", "")
    write_file("in/b.json", "\n \n")
    assert values(read(spark, f"{write_file.folder}/in")) == []
    with pytest.raises(ValueError):
        read_json_records(spark, f"{write_file.folder}/in", None)


def test_load_of_documents(spark, write_file, folder):
    spec = DatasetSpec(
        "d", ("results_id", "results_amount", "job_id", "file_name"), {"results_id": "key"}, ("key",), format="json_records",
        input_schema="_links struct<self: struct<href: string>>, results array<struct<id: string, amount: double>>",
    )
    pages = [{"_links": {"self": {"href": f"/companies/c{n}"}}, "results": [{"id": str(n), "amount": n / 2}, {"amount": 1}]} for n in range(3)]
    texts = [json.dumps(page, indent=2) for page in pages]
    path, out = write_file("in/d.json", "\n".join([*texts, texts[0].replace("0.0", '"many"').replace('"0"', '"9"'), "{\n broken\n}"])), folder()
    result = plans.ingest(spark, spec, path, "j", out)
    assert (result.loaded, result.rejected, result.corrupt) == (3, 5, 2)
    assert [(r["key"], r["results_amount"], r["company_id"], r["file_name"].rsplit("/", 1)[1]) for r in rows(sink.read_loads(spark, out))] == [
        (str(n), n / 2, f"c{n}", "d.json") for n in range(3)]
    with pytest.raises(SpecError):
        DatasetSpec("d", ("a",), format="json_records").validate()
