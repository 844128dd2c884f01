"""Delimited files whose headers differ."""

import pytest
from conftest import rows

from tidegate.operators.shape import SOURCE_FILE, SOURCE_ORDER
from tidegate.plans import ingest as plans
from tidegate.sinks import files as sink
from tidegate.sources import layouts as src
from tidegate.spec import DatasetSpec, SpecError
from tidegate.specs import SET_A

PAYMENTS = SET_A["trizetto_payments"]


def values(df):
    return rows(df.drop(SOURCE_FILE, SOURCE_ORDER))


def test_files_meet_by_name(spark, write_file):
    write_file("in/a.txt", "id|name|amount\n1|x|5\n2||6\n")
    write_file("in/b.txt", "amount|ID\n7|3\n")
    write_file("in/sub dir/c [1]{x}.txt", "name|other|id\nz|o|4\n")
    folder = [f"{write_file.folder}/in", f"{write_file.folder}/in/sub dir"]
    assert values(src.read_layouts(spark, folder, missing_value="")) == values(spark.createDataFrame([
        ("1", "x", "5", ""), ("2", None, "6", ""), ("3", "", "7", ""), ("4", "z", "", "o"),
    ], "ID string, name string, amount string, other string").withColumnRenamed("ID", src.read_layouts(spark, folder).columns[1]))
    got = src.read_layouts(spark, folder, wanted=["id", "OTHER", "absent"])
    assert sorted(name.lower() for name in got.columns) == [SOURCE_FILE, "id", "other"]
    assert sorted((r["other"], r[SOURCE_FILE].rsplit("/", 1)[1]) for r in got.where("other is not null").collect()) == [("o", "c%20%5B1%5D%7Bx%7D.txt")]


def test_one_header_line_per_file_however_it_is_split(spark, write_file):
    body = "".join(f"{n}|{n * n}\n" for n in range(5000))
    path = write_file("in/a.txt", "k|square\n" + body)
    write_file("in/b.txt", "square|k\n1|-1\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        headers = {r["file"].rsplit("/", 1)[1]: r["header"] for r in src.file_headers(spark, f"{write_file.folder}/in").collect()}
        got = src.read_layouts(spark, f"{write_file.folder}/in")
        assert got.rdd.getNumPartitions() > 4 and path
        assert headers == {"a.txt": "k|square", "b.txt": "square|k"}
        assert sorted((int(r.k), int(r.square)) for r in got.collect()) == [(-1, 1), *((n, n * n) for n in range(5000))]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("text", ["", "k|v\n", "k|v"])
def test_files_without_rows(spark, write_file, text):
    write_file("in/a.txt", text)
    write_file("in/b.txt", "k|w\n1|2\n")
    assert values(src.read_layouts(spark, f"{write_file.folder}/in", wanted=["k"])) == [{"k": "1"}]


def test_no_file_has_a_line(spark, write_file):
    write_file("in/a.txt", "")
    assert src.read_layouts(spark, f"{write_file.folder}/in").count() == 0


def test_marks_quotes_and_repeated_names(spark, write_file):
    write_file("in/a.txt", '﻿"first|name"|b\n"x|y"|2\n')
    assert values(src.read_layouts(spark, f"{write_file.folder}/in")) == [{"first|name": "x|y", "b": "2"}]
    assert src.header_columns("a|b|") == ["a", "b", ""]
    for header in ("a|b|A", "a|a"):
        with pytest.raises(SpecError):
            src.header_columns(header)


def test_load_of_drifting_files_equals_loads_of_each(spark, write_file, folder):
    texts = {
        "a.txt": "PaymentIdentifier|OrgIdentifier|PayeeName\n1|o|Ann\n2||Bob\n",
        "b.txt": "payeename|PaymentIdentifier|Unknown\nCid|3|u\n",
        "c.txt": "OrgIdentifier|PaymentIdentifier\np|4\n",
    }
    paths = [write_file(f"in/{name}", text) for name, text in texts.items()]
    together, apart = folder(), folder()
    plans.ingest(spark, PAYMENTS, f"{write_file.folder}/in", "j", together, load_date="2024-09-15")
    for n, path in enumerate(paths):
        plans.ingest(spark, PAYMENTS, path, f"j{n}", apart, load_date="2024-09-15")
    for status in (sink.LOADED, sink.QUARANTINED):
        drop = ("job_id", "corrupt_record")
        assert rows(sink.read_loads(spark, together, status).drop(*drop)) == rows(sink.read_loads(spark, apart, status).drop(*drop))
    assert sorted(r.pay_id for r in sink.read_loads(spark, together).collect()) == ["1", "3", "4"]


def test_tenant_of_the_file_with_drifting_headers(spark, write_file, folder):
    spec = DatasetSpec("t", ("id", "job_id"), tenant_column="link", tenant_scope="file", format="delimited")
    write_file("in/a.txt", "id|link\n1|/c/t1/x\n2|/c/other/x\n")
    write_file("in/b.txt", "link|id\n/c/t2/x|3\n")
    out = folder()
    plans.ingest(spark, spec, f"{write_file.folder}/in", "j", out)
    assert {(r.id, r.company_id) for r in sink.read_loads(spark, out).collect()} == {("1", "t1"), ("2", "t1"), ("3", "t2")}
