from datetime import date

from conftest import rows
from pyspark.sql import functions as F

from tidegate import functions as fn
from tidegate.operators import shape


def test_padding_projects_in_declared_order(spark):
    df = spark.createDataFrame([(1, "x", 9)], "a int, b string, extra int")
    padded = shape.pad_and_project(df, ["b", "missing", "a"], optional=["link"])
    assert padded.columns == ["b", "missing", "a"]
    assert rows(padded) == [{"b": "x", "missing": "", "a": 1}]
    assert rows(shape.pad_and_project(df, ["missing"], missing_value=None)) == [{"missing": None}]
    assert shape.pad_and_project(df, ["a"], optional=["extra"]).columns == ["a", "extra"]


def test_column_in_another_case_keeps_its_data(spark):
    df = spark.createDataFrame([("real",)], "x string")
    assert rows(shape.pad_and_project(df, ["X"])) == [{"X": "real"}]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert rows(shape.pad_and_project(df, ["X"])) == [{"X": ""}]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_rename_ignores_unknown_names_and_goes_in_order(spark):
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    assert shape.rename(df, {"a": "b", "none": "c", "b": "d"}).columns == ["d", "z"]


def test_casts_turn_blank_and_junk_into_null(spark):
    df = spark.createDataFrame([("1.5", "2024-02-30"), ("", ""), ("junk", "2024-02-29"), (None, None)], "n string, d string")
    typed = shape.cast_declared(df, {"n": "double", "d": "date", "absent": "double"})
    assert typed.collect() == [(1.5, None), (None, None), (None, date(2024, 2, 29)), (None, None)]
    assert shape.cast_failures(df, {"n": "double", "d": "date"}).collect() == [(1, 1)]


def test_casts_accept_typed_columns(spark):
    df = spark.createDataFrame([(3, 2.0)], "i bigint, x double")
    assert shape.cast_declared(df, {"i": "double", "x": "double"}).collect() == [(3.0, 2.0)]


def test_tenant_of_links_with_few_segments(spark):
    links = [("/companies/c1/data",), ("/only",), ("",), (None,), ("//a//b",)]
    df = spark.createDataFrame(links, "link string")
    got = shape.add_tenant(df, "link")
    assert [row.company_id for row in got.collect()] == ["c1", "", "", "", "b"]
    assert shape.add_tenant(df, "other").columns == ["link"]


def test_tenant_of_a_file_is_that_of_its_first_row(spark):
    data = [("f1", "2", "/x/late"), ("f1", "1", "/x/first"), ("f2", "1", "/x/other"), ("f2", "2", None)]
    df = spark.createDataFrame(data, f"{shape.SOURCE_FILE} string, {shape.SOURCE_ORDER} string, link string")
    tenants = shape.file_tenants(df, "link")
    got = shape.add_file_tenant(df, tenants, "link").select(shape.SOURCE_FILE, "company_id")
    assert sorted(map(tuple, got.collect())) == [("f1", "first"), ("f1", "first"), ("f2", "other"), ("f2", "other")]


def test_import_date_from_path(spark):
    df = spark.createDataFrame([("a/import_date=20240915/f_20200101.json",), ("a/no-date",)], "p string")
    got = shape.add_import_date(df, F.col("p")).drop("p").collect()
    assert tuple(got[0]) == ("20240915", "15", "09", "2024")
    assert tuple(got[1]) == ("", "", "", "")
    assert tuple(shape.add_import_date(df.limit(1), "x/20231231").drop("p").first()) == ("20231231", "31", "12", "2023")


def test_lineage_and_version_stamps(spark):
    df = spark.range(1)
    assert rows(shape.stamp_lineage(df, "j", "f", "2024-01-02")) == [
        {"id": 0, "job_id": "j", "file_name": "f", "file_load_dt": "2024-01-02"}
    ]
    today = shape.stamp_lineage(df, "j", "f").first().file_load_dt
    assert today == spark.sql("SELECT date_format(current_timestamp(), 'yyyy-MM-dd')").first()[0]
    assert tuple(shape.mark_current(df).first()) == (0, "N", "9999-12-31")
    assert tuple(shape.mark_expired(df, "2024-09-15").first()) == (0, "Y", "2024-09-15")


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a", "j1"), (1, "a", "j2"), (1, "a", "j1"), (None, None, "j1")], "k int, v string, job string")
    assert shape.drop_duplicates(df).count() == 3
    assert shape.drop_duplicates(df, ignore=["job"]).count() == 2
    assert shape.drop_duplicates(df, keys=["k"]).count() == 2


def test_dates_in_mixed_layouts(spark):
    cases = {
        "06/07/2024": "2024-06-07", "2024/06/11": "2024-06-11", "24-04-2024": "2024-04-24",
        "09-06-2024": "2024-09-06", "02-30-2024": None, "30-02-2024": None, "2024-06-11": None, "": None, "x": None,
    }
    df = spark.createDataFrame([(text,) for text in cases] + [(None,)], "t string")
    got = df.select("t", fn.iso_date(fn.normalise_date(F.col("t"))).alias("d")).collect()
    assert {row.t: row.d for row in got} == {**cases, None: None}


def test_day_first_order_is_a_parameter(spark):
    df = spark.createDataFrame([("09-06-2024",)], "t string")
    assert df.select(fn.normalise_date(F.col("t"), ["dd-MM-yyyy"])).first()[0] == date(2024, 6, 9)


def test_temperatures(spark):
    cases = {"12.13°C": 12.13, "-28.87°F": (-28.87 - 32) * 5 / 9, "32°F": 0.0, "7": 7.0, "warm": None, "°C": None}
    df = spark.createDataFrame([(text,) for text in cases], "t string")
    got = {row.t: row.c for row in df.select("t", fn.celsius(F.col("t")).alias("c")).collect()}
    assert got == cases


def test_concat_key_skips_nulls(spark):
    df = spark.createDataFrame([(None, "a", "b"), ("a", None, "b")], "x string, y string, z string")
    keys = {row[0] for row in df.select(fn.concat_key(["x", "y", "z"])).collect()}
    assert keys == {"a$$b"}


def test_text_rows_travel_packed_and_stay_what_they_are(spark):
    rows = [
        ("a", "b", 1, None), ("a", "b", 1, None), ("a\x1eb", "", 1, "\x1b"), ("a", "b\x1e", 1, "\x1b2"), (None, None, None, None),
        ("", "", None, ""), ("", "", None, None), ("", "", None, ""), ("\x1b", "\x1b0\x1e1", 2, "\x1b1"),
    ]
    df = spark.createDataFrame(rows, "a string, `b.c` string, n int, d string")
    found = shape.drop_text_duplicates(df)
    assert found.columns == df.columns and found.dtypes == df.dtypes
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(set(rows), key=repr)
    # Four columns would be grouped by four keys.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [__packed" in plan and plan.count("Aggregate") == 1


def test_one_text_column_needs_no_packing(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1)], "a string, n int")
    assert sorted(map(tuple, shape.drop_text_duplicates(df).collect()), key=repr) == [("a", 1), (None, 1)]
