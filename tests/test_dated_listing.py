"""Newer folders of a dated layout, and what is listed to find them."""

import os

from tidegate.sources import partitions as src

DAYS = ("20231231", "20240115", "20240116", "20240201", "20250101")


def lay_out(root):
    for day in DAYS:
        folder = f"{root}/import_year={day[:4]}/import_month={day[4:6]}/import_day={day[6:]}/import_date={day}"
        os.makedirs(folder)
        with open(f"{folder}/part-0.txt", "w") as out:
            out.write("x\n")
    os.makedirs(f"{root}/import_year=__HIVE_DEFAULT_PARTITION__/import_month=01")
    os.makedirs(f"{root}/other=2030")
    return root


def dates(df):
    return [row.folder.rsplit("=", 1)[1] for row in df.collect()]


def test_only_folders_that_can_hold_a_later_day_are_listed(spark, tmp_path, monkeypatch):
    root, listed, names = lay_out(str(tmp_path / "r")), [], src.folder_names
    monkeypatch.setattr(src, "folder_names", lambda spark, path: listed.append(path[len(root):]) or names(spark, path))
    assert dates(src.dated_folders_after(spark, root, 20240115)) == ["20240116", "20240201", "20250101"]
    assert not [path for path in listed if "2023" in path]
    listed.clear()
    assert dates(src.dated_folders_after(spark, f"{root}/", "20240131")) == ["20240201", "20250101"]
    assert not [path for path in listed if "import_month=01/import_day" in path and "2024" in path]
    assert dates(src.dated_folders_after(spark, root, 20250101)) == [] and dates(src.dated_folders_after(spark, root, 0)) == list(DAYS)


def test_digits_of_the_root_are_no_date(spark, tmp_path):
    root = lay_out(str(tmp_path / "run-20990101aa"))
    assert dates(src.list_folders_after(spark, root, 20240115)) == dates(src.dated_folders_after(spark, root, 20240115))


def test_files_modified_before_a_time_are_left_out(spark, tmp_path):
    root = lay_out(str(tmp_path / "r"))
    old = f"{root}/import_year=2024/import_month=01/import_day=16/import_date=20240116/part-0.txt"
    os.utime(old, (1_000_000_000, 1_000_000_000))
    found = src.list_folders_after(spark, root, 20240115, modified_after="2010-01-01T00:00:00")
    assert dates(found) == ["20240201", "20250101"]


def test_no_folder_at_all(spark, tmp_path):
    assert dates(src.dated_folders_after(spark, str(tmp_path / "none"), 20240115)) == []
