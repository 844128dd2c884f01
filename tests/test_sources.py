import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidegate.operators.shape import SOURCE_FILE, SOURCE_ORDER
from tidegate.sources import files as src
from tidegate.sources.database import Database, ReadRange, read_query
from tidegate.sources.partitions import folders_after, list_folders_after
from tidegate.sources.routing import add_route, key_below, route_token, routed_to, spec_name, token_glob


def test_json_lines(spark, write_file):
    path = write_file("a.json", [{"id": 1, "s": {"x": True}}, {"id": 2}])
    assert rows(src.read_json(spark, path)) == [{"id": 1, "s": {"x": True}}, {"id": 2, "s": None}]
    assert rows(src.read_json(spark, path, "id bigint")) == [{"id": 1}, {"id": 2}]


def test_multiline_json_keeps_malformed_documents(spark, write_file):
    write_file("docs/good.json", '{\n "id": 1,\n "n": [\n  1, 2]\n}')
    write_file("docs/list.json", '[\n {"id": 2},\n {"id": 3}\n]')
    write_file("docs/bad.json", '{"id": \n broken')
    folder = f"{write_file.folder}/docs"
    got = src.read_json_multiline(spark, folder, "id bigint, n array<bigint>, bad string", corrupt_column="bad")
    assert sorted((row.id or 0, row.bad is not None) for row in got.collect()) == [(0, True), (1, False), (2, False), (3, False)]


def test_delimited_text(spark, write_file):
    path = write_file("t.txt", "A|B|C\n1|x y|\n2|\"p|q\"|z\n")
    assert rows(src.read_delimited(spark, path)) == [{"A": "1", "B": "x y", "C": None}, {"A": "2", "B": "p|q", "C": "z"}]


def test_files_with_another_header_are_refused(spark, write_file):
    write_file("d/1.txt", "A|B\n1|2\n")
    write_file("d/2.txt", "B|A\n3|4\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        src.read_delimited(spark, f"{write_file.folder}/d").collect()


def test_quoted_comma(spark, write_file):
    path = write_file("runs.csv", 'run_id,location\n1,"14.2,-8.4"\n')
    assert rows(src.read_csv(spark, path, "run_id int, location string")) == [{"run_id": 1, "location": "14.2,-8.4"}]


def test_source_file_and_row_order(spark, write_file):
    lines = [{"n": n} for n in range(50)]
    path = write_file("o.json", lines)
    got = src.with_source(src.read_json(spark, path, "n int"), ordered=True).orderBy(SOURCE_ORDER).collect()
    assert [row.n for row in got] == list(range(50))
    assert {row[SOURCE_FILE].endswith(path) for row in got} == {True}


def test_row_order_holds_over_file_splits(spark, write_file):
    path = write_file("o.json", [{"n": n} for n in range(2000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = src.with_source(src.read_json(spark, path, "n int"), ordered=True)
        assert df.rdd.getNumPartitions() > 4
        assert [row.n for row in df.orderBy(SOURCE_ORDER).collect()] == list(range(2000))
        assert df.groupBy(SOURCE_FILE).agg(F.min_by("n", SOURCE_ORDER)).first()[1] == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_folders_after_a_date(spark, write_file):
    for day, name in (("20240101", "a"), ("20240101", "b"), ("20240103", "a"), ("20231231", "a")):
        write_file(f"raw/import_date={day}/{name}.json", [{"x": 1}])
    write_file("raw/undated/c.json", [{"x": 1}])
    got = [row.folder for row in list_folders_after(spark, f"{write_file.folder}/raw", "20231231").collect()]
    assert [folder.rsplit("/", 1)[1] for folder in got] == ["import_date=20240101", "import_date=20240103"]


def test_first_date_of_a_path_counts(spark):
    df = spark.createDataFrame([("in/20240105/x_20230101.json",), ("in/20230101/x_20240105.json",)], "p string")
    assert [row.folder for row in folders_after(df, "p", 20240101).collect()] == ["in/20240105"]


def test_listing_reads_no_contents(spark, write_file):
    write_file("l/a.txt", "x")
    plan = src.list_files(spark, f"{write_file.folder}/l")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


ROUTED = {
    "x/BALANCESHEET_1.json": ("BalanceSheet", "balance_sheet"),
    "TPSClaims_transaction.txt": ("TPSClaims", "trizetto_claims"),
    "codat_paymnt_Invoices": ("Invoices", "invoice"),
    "Supplier/transaction": ("Supplier", "supplier"),
    "codat_BILLS": ("Codat_bills", "codat_bills"),
    "Codat_billPayments_2": ("Codat_billPayments", "codat_billPayments"),
    "Paymnt.json": ("Paymnt", "payments"),
    "unknown.json": (None, None),
}


def test_routes(spark):
    assert {name: (route_token(name), spec_name(route_token(name))) for name in ROUTED} == ROUTED
    df = add_route(spark.createDataFrame([(name,) for name in ROUTED], "name string"), "name")
    assert {row.name: (row.dataset, row.spec) for row in df.collect()} == ROUTED


def test_route_looks_below_the_folder(spark):
    df = spark.createDataFrame([("s3://b/transaction/in put/Invoices.json".replace(" ", "%20"),)], "p string")
    folder = "s3://b/transaction/in put"
    assert df.select(key_below(folder, F.col("p"))).first()[0] == "Invoices.json"
    assert df.select(routed_to("Invoices", folder, F.col("p"))).first()[0]


def test_glob_finds_any_case(spark, write_file):
    write_file("g/tPsCLAIMS_1.txt", "A\n1\n")
    write_file("g/other.txt", "A\n2\n")
    assert src.read_delimited(spark, token_glob(f"{write_file.folder}/g", "TPSClaims")).count() == 1


def test_database_options():
    db = Database("jdbc:test:x", {"user": "u", "password": "secret"})
    assert "secret" not in repr(db)
    assert db.scan_options("t", ReadRange("id", 0, 100, 8)) == {
        "url": "jdbc:test:x", "user": "u", "password": "secret", "dbtable": "t",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }
    assert db.write_options("t", "append", 4)["numPartitions"] == "4"
    assert "truncate" not in db.write_options("t", "append", 4)
    assert db.write_options("t", "overwrite", 4)["truncate"] == "true"


def test_database_reads_and_writes_pass_their_options(spark):
    """No database is started for tests: only what Spark is asked for is looked at."""
    from unittest.mock import MagicMock

    db, session, df = Database("jdbc:test:x", {"driver": "d"}), MagicMock(), MagicMock()
    loaded = session.read.format.return_value.options
    db.table(session, "t")
    db.query(session, "SELECT 1")
    assert [call.kwargs for call in loaded.call_args_list] == [
        {"url": "jdbc:test:x", "driver": "d", "dbtable": "t"}, {"url": "jdbc:test:x", "driver": "d", "query": "SELECT 1"},
    ]
    db.write(df, "t", "overwrite", connections=2)
    writer = df.write.format.return_value.options
    assert writer.call_args.kwargs["truncate"] == "true" and writer.call_args.kwargs["numPartitions"] == "2"
    writer.return_value.mode.assert_called_once_with("overwrite")


def test_query_parameters_are_values(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    got = read_query(spark, "SELECT id FROM numbers WHERE cast(id AS string) = :n", n="2' OR '1'='1")
    assert got.count() == 0
    assert read_query(spark, "SELECT id FROM numbers WHERE id > :n", n=0).count() == 2


