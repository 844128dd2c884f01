import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tidegate.operators import history as ops
from tidegate.plans.history_load import create_history, load_history, read_history
from tidegate.session import new_folder
from tidegate.spec import HistorySpec, SpecError

KEYS, VALUE, DAY = ("k", "l"), "v", "2024-09-15"
STAGE = "k string, l string, v double"
TABLE = STAGE + ", flag_del string, last_updt_dt string"


def stage(spark, *data):
    return spark.createDataFrame(list(data), STAGE)


def table(spark, *data):
    return spark.createDataFrame(list(data), TABLE)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def before(spark):
    return table(
        spark,
        ("same", "x", 1.0, "N", "9999-12-31"),
        ("same", "x", 0.5, "Y", "2024-01-01"),
        ("moved", None, 2.0, "N", "9999-12-31"),
        ("gone", "x", 3.0, "N", "9999-12-31"),
        ("blank", "x", None, "N", "9999-12-31"),
    )


@pytest.fixture
def day(spark):
    return stage(
        spark, ("same", "x", 1.0), ("moved", None, 2.5), ("new", None, 4.0), (None, "moved", 9.0), ("blank", "x", 6.0)
    )


def test_outputs(before, day):
    assert tuples(ops.new_rows(day, before, KEYS)) == [
        ("new", None, 4.0, "N", "9999-12-31"), (None, "moved", 9.0, "N", "9999-12-31"),
    ]
    assert tuples(ops.updated_rows(day, before, KEYS, VALUE)) == [("moved", None, 2.5, "N", "9999-12-31")]
    assert tuples(ops.expired_rows(day, before, KEYS, VALUE, DAY)) == [("moved", None, 2.0, "Y", DAY)]


def test_changes_hold_all_outputs(before, day):
    changes = ops.history_changes(day, before, KEYS, VALUE, DAY)
    kinds = {kind: tuples(changes.where(f"change = '{kind}'").drop("change")) for kind in ("new", "updated", "expired")}
    assert kinds["new"] == tuples(ops.new_rows(day, before, KEYS))
    assert kinds["updated"] == tuples(ops.updated_rows(day, before, KEYS, VALUE))
    assert kinds["expired"] == tuples(ops.expired_rows(day, before, KEYS, VALUE, DAY))


def test_null_amount_changes_only_when_null_aware(before, day):
    changes = ops.history_changes(day, before, KEYS, VALUE, DAY, null_aware=True)
    assert ("blank", "x", 6.0, "N", "9999-12-31", "updated") in tuples(changes)


def test_expired_versions_do_not_match_again(spark, before):
    again = ops.history_changes(stage(spark, ("same", "x", 1.0)), before, KEYS, VALUE, DAY)
    assert again.count() == 0


def test_joined_text_keys_collide_and_column_keys_do_not(spark, before):
    twins = stage(spark, (None, "moved", 9.0))
    assert ops.unknown_rows(twins, before, KEYS).count() == 1
    assert ops.unknown_rows(twins, before, KEYS, "concat").count() == 0


def test_merge_in_one_join(before, day):
    merged = ops.merge_history(day, before, KEYS, VALUE, DAY)
    assert tuples(merged) == sorted([
        ("same", "x", 1.0, "N", "9999-12-31"),
        ("same", "x", 0.5, "Y", "2024-01-01"),
        ("moved", None, 2.0, "Y", DAY),
        ("moved", None, 2.5, "N", "9999-12-31"),
        ("gone", "x", 3.0, "N", "9999-12-31"),
        ("blank", "x", None, "N", "9999-12-31"),
        ("new", None, 4.0, "N", "9999-12-31"),
        (None, "moved", 9.0, "N", "9999-12-31"),
    ], key=str)


def test_grouped_sum_keeps_null_keys_together(spark):
    got = ops.grouped_sum(stage(spark, ("a", None, 1.0), ("a", None, 2.0), ("a", "x", 5.0)), KEYS, VALUE)
    assert tuples(got) == [("a", "x", 5.0), ("a", None, 3.0)]


def test_compare_marks_null_as_unchanged(before, day):
    pairs = ops.compare_rows(day, ops.current_rows(before).select("k", "l", "v"), KEYS)
    flags = {(row.new.k, row.new.l): row.flag for row in pairs.withColumn(
        "flag", ops.changed(pairs["new.v"], pairs["old.v"])).collect()}
    assert flags == {("same", "x"): "NO", ("moved", None): "YES", ("new", None): "NO", (None, "moved"): "NO", ("blank", "x"): "NO"}


@pytest.mark.parametrize("partition", ["k", "l", None])
def test_load_equals_merge_and_is_idempotent(spark, before, day, partition):
    spec = HistorySpec(KEYS, VALUE, partition_column=partition)
    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    create_history(before, path, spec)
    result = load_history(spark, day, path, spec, DAY, "job_1", export)
    assert (result.new, result.updated, result.expired) == (2, 1, 1)
    merged = tuples(ops.merge_history(day, before, KEYS, VALUE, DAY))
    columns = TABLE.replace(" string", "").replace(" double", "").split(", ")
    assert tuples(read_history(spark, path).select(*columns)) == merged
    # The same load again, and the same day under another id.
    again = load_history(spark, day, path, spec, DAY, "job_1", export)
    assert (again.new, again.updated, again.expired) == (2, 1, 1)
    assert tuples(read_history(spark, path).select(*columns)) == merged
    other = load_history(spark, day, path, spec, DAY, "job_2", export)
    assert (other.new, other.updated, other.expired) == (0, 0, 0)
    assert tuples(read_history(spark, path).select(*columns)) == merged


@pytest.mark.parametrize("step", ["changes", "parts", "next"])
def test_cut_off_load_is_finished_by_the_next_run(spark, before, day, step, monkeypatch):
    """The run stops after a step; the same run again gives the whole table."""
    from tidegate.plans import history_load as plan

    class Stop(Exception):
        pass

    def stop(*args, **kwargs):
        raise Stop

    spec = HistorySpec(KEYS, VALUE, partition_column="k")
    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    create_history(before, path, spec)
    following = {"changes": "write_parts", "parts": "switch_parts", "next": "rename_folder"}[step]
    with monkeypatch.context() as patched:
        patched.setattr(plan, following, stop)
        with pytest.raises(Stop):
            load_history(spark, day, path, spec, DAY, "job_1", export)
    load_history(spark, day, path, spec, DAY, "job_1", export)
    columns = [name.split()[0] for name in TABLE.split(", ")]
    assert tuples(read_history(spark, path).select(*columns)) == tuples(ops.merge_history(day, before, KEYS, VALUE, DAY))


def test_late_rerun_does_not_undo_a_newer_load(spark, before):
    spec = HistorySpec(KEYS, VALUE, partition_column="k")
    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    create_history(before, path, spec)
    load_history(spark, stage(spark, ("same", "x", 5.0)), path, spec, "2024-09-15", "d1", export)
    load_history(spark, stage(spark, ("same", "x", 6.0)), path, spec, "2024-09-16", "d2", export)
    load_history(spark, stage(spark, ("same", "x", 5.0)), path, spec, "2024-09-15", "d1", export)
    current = read_history(spark, path).where("flag_del = 'N' AND k = 'same'")
    assert [row.v for row in current.collect()] == [6.0]


def test_publishing_to_a_database(spark, before, day):
    from unittest.mock import MagicMock

    from tidegate.plans.history_load import publish_changes

    database, written = MagicMock(), {}
    database.write.side_effect = lambda df, table, mode: written.update({table: (mode, df.count())})
    publish_changes(ops.history_changes(day, before, KEYS, VALUE, DAY), database, "daily", "work")
    assert written == {"work": ("overwrite", 1), "daily": ("append", 3)}


def test_empty_stage_leaves_the_history_unchanged(spark, before):
    spec = HistorySpec(KEYS, VALUE, partition_column="k")
    path = new_folder(spark, "history")
    create_history(before, path, spec)
    result = load_history(spark, stage(spark), path, spec, DAY, "job_1", new_folder(spark, "export"))
    assert (result.new, result.updated, result.expired) == (0, 0, 0)
    assert read_history(spark, path).count() == before.count()


def parts_of(spark, path):
    from tidegate.plans.history_load import parts_number, read_parts

    return {(row.part, row.load) for row in read_parts(spark, path, parts_number(spark, path)).where("part is not null").collect()}


def test_untouched_parts_keep_their_files(spark, before):
    import glob

    spec = HistorySpec(KEYS, VALUE, partition_column="k")
    path = new_folder(spark, "history")
    create_history(before, path, spec)
    files, parts = set(glob.glob(f"{path}/load=initial/*/*/*.parquet")), parts_of(spark, path)
    load_history(spark, stage(spark, ("moved", None, 7.0)), path, spec, DAY, "job_1", new_folder(spark, "export"))
    assert files == set(glob.glob(f"{path}/load=initial/*/*/*.parquet")) and files
    assert parts_of(spark, path) == {(p, load) for p, load in parts if p != "at-moved"} | {("at-moved", "job_1")}


def test_a_load_reads_the_parts_its_stage_names_only(spark, before):
    """Every other part, and the archive, are gone from the disk while it runs."""
    import glob
    import shutil

    from tidegate.plans.history_load import read_current

    spec = HistorySpec(KEYS, VALUE, partition_column="k")
    path = new_folder(spark, "history")
    create_history(before, path, spec)
    for folder in glob.glob(f"{path}/load=initial/*/*"):
        if not folder.endswith("part=at-moved"):
            shutil.rmtree(folder)
    result = load_history(spark, stage(spark, ("moved", None, 7.0), ("fresh", "x", 1.0)), path, spec, DAY, "job_1", new_folder(spark, "export"))
    assert result.new + result.updated == 2
    only = spark.createDataFrame([("at-moved",), ("at-fresh",), ("at-absent",)], "part string")
    assert {row.k for row in read_current(spark, path, only).collect()} == {"moved", "fresh"}


def test_a_load_that_was_applied_before_the_run_ended_is_not_applied_again(spark, before, monkeypatch):
    from tidegate.plans import history_load as plan

    spec = HistorySpec(KEYS, VALUE, partition_column="k")
    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    create_history(before, path, spec)
    with monkeypatch.context() as patched:
        patched.setattr(plan, "HistoryResult", None)  # the driver ends right after the switch
        with pytest.raises(TypeError):
            load_history(spark, stage(spark, ("same", "x", 5.0)), path, spec, "2024-09-15", "d1", export)
    load_history(spark, stage(spark, ("same", "x", 6.0)), path, spec, "2024-09-16", "d2", export)
    load_history(spark, stage(spark, ("same", "x", 5.0)), path, spec, "2024-09-15", "d1", export)
    assert [row.v for row in read_history(spark, path).where("flag_del = 'N' AND k = 'same'").collect()] == [6.0]


def test_replaced_parts_are_removed_on_request(spark):
    import os

    from tidegate.plans.history_load import remove_replaced

    spec = HistorySpec(KEYS, VALUE, partition_column="k")
    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    assert remove_replaced(spark, path) == 0
    create_history(table(spark, ("a/b c", "x", 1.0, "N", "9999-12-31"), ("z", "x", 1.0, "N", "9999-12-31")), path, spec)
    for number, amount in enumerate([2.0, 3.0, 4.0]):
        load_history(spark, stage(spark, ("a/b c", "x", amount)), path, spec, f"2024-09-0{number + 1}", f"day_{number}", export)
    whole = tuples(read_history(spark, path))
    assert remove_replaced(spark, path) == 2 and remove_replaced(spark, path) == 0
    assert tuples(read_history(spark, path)) == whole and len(whole) == 5
    assert sorted(os.listdir(f"{path}/_parts")) == ["2", "3"]


@pytest.mark.parametrize("name", ["", " ", "a/b", "x=1", "50%", "{a}[b]*?", "ü", "2024-01-01", "__HIVE_DEFAULT_PARTITION__", "none", None])
def test_parts_of_any_name(spark, name):
    spec = HistorySpec(KEYS, VALUE, partition_column="k")
    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    create_history(table(spark, (name, "x", 1.0, "N", "9999-12-31"), ("other", "x", 1.0, "N", "9999-12-31")), path, spec)
    load_history(spark, stage(spark, (name, "x", 2.0)), path, spec, DAY, "j", export)
    assert tuples(read_history(spark, path).where("k IS NULL OR k <> 'other'").select("k", "v", "flag_del")) == sorted(
        [(name, 1.0, "Y"), (name, 2.0, "N")], key=str)


def test_a_history_is_made_once(spark, before):
    spec = HistorySpec(KEYS, VALUE, partition_column="k")
    path = new_folder(spark, "history")
    create_history(before, path, spec)
    with pytest.raises(ValueError, match="already"):
        create_history(before, path, spec)


def test_several_days(spark):
    spec = HistorySpec(KEYS, VALUE, partition_column="k")
    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    create_history(table(spark, ("a", "x", 1.0, "N", "9999-12-31")), path, spec)
    for number, amount in enumerate([2.0, 2.0, 3.0]):
        load_history(spark, stage(spark, ("a", "x", amount)), path, spec, f"2024-09-0{number + 1}", f"day_{number}", export)
    assert tuples(read_history(spark, path).select("v", "flag_del", "last_updt_dt")) == [
        (1.0, "Y", "2024-09-01"), (2.0, "Y", "2024-09-03"), (3.0, "N", "9999-12-31"),
    ]


def test_decimal_sums_do_not_depend_on_row_order(spark):
    amounts = [0.1] * 10 + [1e9, 0.2, -1e9] * 7
    spec = HistorySpec(KEYS, VALUE, value_type="decimal(28,10)")
    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    first = ops.grouped_sum(stage(spark, *[("a", "x", v) for v in amounts]), KEYS, VALUE, spec.value_type)
    create_history(ops.mark_current(first), path, spec)
    for n, order in enumerate((amounts[::-1], sorted(amounts))):
        rows = stage(spark, *[("a", "x", v) for v in order]).repartition(3)
        result = load_history(spark, rows, path, spec, DAY, f"job_{n}", export)
        assert (result.new, result.updated, result.expired) == (0, 0, 0)


def test_daily_balance_from_the_first_load_on(spark):
    from tidegate.specs import DAILY_BALANCE

    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    schema = "company_name string, level_name string, acc_id string, acc_name string, bal_dt string, bal_amt double"
    day = spark.createDataFrame([("c", "l", "1", None, "2024-09-15", 1.5), ("c", "l", "1", None, "2024-09-15", 2.0)], schema)
    assert load_history(spark, day, path, DAILY_BALANCE, DAY, "first", export).new == 1
    result = load_history(spark, day.withColumn("bal_amt", day.bal_amt + 1), path, DAILY_BALANCE, DAY, "second", export)
    assert (result.new, result.updated, result.expired) == (0, 1, 1)
    assert tuples(read_history(spark, path).selectExpr("CAST(bal_amt AS DOUBLE)", "flag_del")) == [(3.5, "Y"), (5.5, "N")]


def test_joined_text_keys_close_the_version_they_match(spark):
    """The old version has its null in another column than the one that replaces it."""
    spec = HistorySpec(KEYS, VALUE, key_style="concat")
    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    create_history(table(spark, ("a", None, 1.0, "N", "9999-12-31"), ("b", "x", 5.0, "N", "9999-12-31")), path, spec)
    result = load_history(spark, stage(spark, (None, "a", 2.0)), path, spec, DAY, "j", export)
    assert (result.new, result.updated, result.expired) == (0, 1, 1)
    columns = [name.split()[0] for name in TABLE.split(", ")]
    assert tuples(read_history(spark, path).select(*columns)) == sorted([
        ("a", None, 1.0, "Y", DAY), (None, "a", 2.0, "N", "9999-12-31"), ("b", "x", 5.0, "N", "9999-12-31"),
    ], key=str)


def test_types_of_the_table_stay(spark):
    """Sums come as decimals, the table holds doubles."""
    spec = HistorySpec(KEYS, VALUE, value_type="decimal(28,10)", partition_column="k")
    path, export = new_folder(spark, "history"), new_folder(spark, "export")
    create_history(table(spark, ("a", "x", 0.3, "N", "9999-12-31"), ("b", "x", 1.0, "N", "9999-12-31")), path, spec)
    day = stage(spark, ("a", "x", 0.1), ("a", "x", 0.2), ("b", "x", 1.5))
    result = load_history(spark, day, path, spec, DAY, "j", export)
    assert (result.new, result.updated, result.expired) == (0, 1, 1)
    got = read_history(spark, path)
    assert dict(got.dtypes)["v"] == "double"
    assert tuples(got.select("k", "v", "flag_del")) == [("a", 0.3, "N"), ("b", 1.0, "Y"), ("b", 1.5, "N")]


@pytest.mark.parametrize("bad", [
    HistorySpec((), "v"), HistorySpec(("k", "k"), "v"), HistorySpec(("k",), "k"),
    HistorySpec(("k",), "v", key_style="fuzzy"), HistorySpec(("k",), "v", key_style="concat", partition_column="k"), HistorySpec(("k",), "v", partition_column="z"),
])
def test_wrong_specs(bad):
    with pytest.raises(SpecError):
        bad.validate()


amounts = st.dictionaries(
    st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", None])), st.integers(0, 2), max_size=6
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(amounts, amounts)
def test_merge_leaves_one_current_row_per_key(spark, old, new):
    history = table(spark, *[(*key, float(v), "N", "9999-12-31") for key, v in old.items()])
    day = stage(spark, *[(*key, float(v)) for key, v in new.items()])
    merged = ops.merge_history(day, history, KEYS, VALUE, DAY).collect()
    current = {(row.k, row.l): row.v for row in merged if row.flag_del == "N"}
    assert current == {**{k: float(v) for k, v in old.items()}, **{k: float(v) for k, v in new.items()}}
    assert len([row for row in merged if row.flag_del == "N"]) == len(current)
    assert len(merged) - len(current) == sum(1 for key in old if key in new and old[key] != new[key])
