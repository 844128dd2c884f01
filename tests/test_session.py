import pytest

from tidegate import session


def shuffles(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_shuffles_fit_the_input_for_one_write(spark, folder):
    path = folder()
    spark.range(100_000).write.parquet(path)
    df = spark.read.parquet(path)
    size, before = session.input_bytes(df.groupBy("id").count()), shuffles(spark)
    assert size > 100_000
    with session.sized_shuffles(df.groupBy("id").count(), partition_bytes=size // 50):
        assert 50 <= shuffles(spark) <= 51
    assert shuffles(spark) == before
    with session.sized_shuffles(df):
        assert shuffles(spark) == before
    with pytest.raises(KeyError), session.sized_shuffles(df, partition_bytes=1):
        assert shuffles(spark) == session.input_bytes(df)
        raise KeyError
    assert shuffles(spark) == before


def test_both_sides_of_a_join_count_and_unknown_sizes_do_not(spark, folder):
    path = folder()
    spark.range(10_000).write.parquet(path)
    df = spark.read.parquet(path)
    assert session.input_bytes(df.alias("a").join(df.alias("b"), "id")) == 2 * session.input_bytes(df)
    assert session.input_bytes(spark.createDataFrame([(1,)], "id int")) < session.UNKNOWN_SIZE


def test_folders_are_below_the_shared_one_and_differ(spark):
    one, other = session.new_folder(spark, "x"), session.new_folder(spark, "x")
    assert one != other and one.startswith(session.shared_root(spark))


def test_marks_and_patterns(spark, folder):
    path = folder()
    assert not session.path_exists(spark, path) and not session.path_matches(spark, f"{path}/*")
    session.leave_mark(spark, f"{path}/done")
    assert session.path_exists(spark, f"{path}/done") and session.path_matches(spark, f"{path}/d*")


def test_tasks_of_a_write_are_bounded_and_settings_come_back(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(name) for name in names]
    with session.sized_shuffles(spark.range(1)):
        assert [spark.conf.get(name) for name in names] == [f"{session.PARTITION_BYTES}b", f"{session.MERGED_BYTES}b"]
    assert [spark.conf.get(name) for name in names] == before
    spark.conf.set(names[0], "1m")
    try:
        with session.bounded_tasks(spark):
            assert spark.conf.get(names[0]) == "1m"
    finally:
        spark.conf.set(names[0], before[0])
    assert session.PARTITION_BYTES <= 64 * 1024 * 1024
