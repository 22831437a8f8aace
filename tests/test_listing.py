"""The listing source against os.walk."""

import os

import pytest

from tabula.sources.listing import list_files
from tabula.sources.whole_files import write_whole_files


def tree(root):
    for k in range(6):
        for j in range(k):
            d = root / f"d{k}" / f"e {j}+ü" / "f"
            d.mkdir(parents=True)
            (d / f"x{j}.png").write_bytes(b"p" * j)
            (d / "y.txt").write_bytes(b"")
            (d / "_hidden").write_bytes(b"1")
    (root / "top.png").write_bytes(b"abc")
    (root / ".hid").mkdir()
    (root / ".hid" / "z.png").write_bytes(b"abc")


def walked(root, ending=""):
    out = set()
    for d, dirs, files in os.walk(root):
        dirs[:] = [x for x in dirs if x[0] not in "._"]
        out |= {(f"file:{d}/{f}", os.path.getsize(f"{d}/{f}")) for f in files if f[0] not in "._" and f.endswith(ending)}
    return out


@pytest.mark.parametrize("tasks", [1, 4, 64])
def test_every_file_once(spark, tmp_path, tasks):
    tree(tmp_path)
    got = list_files(spark, str(tmp_path), tasks=tasks).select("path", "length").collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == walked(tmp_path)
    assert any(r["length"] == 0 for r in got)
    png = list_files(spark, f"file:{tmp_path}", glob="*.png", tasks=tasks).select("path", "length").collect()
    assert set(map(tuple, png)) == walked(tmp_path, ".png")


def test_directories_are_dealt_over_tasks_without_a_list_in_the_plan(spark, tmp_path):
    tree(tmp_path)
    df = list_files(spark, str(tmp_path), tasks=8)
    assert df.rdd.getNumPartitions() >= 6
    assert "x3.png" not in df._jdf.queryExecution().toString()


def test_empty_and_missing(spark, tmp_path):
    assert list_files(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        list_files(spark, str(tmp_path / "nowhere")).count()


def test_a_value_that_has_most_lines_is_one_file_of_many_tasks(spark, tmp_path):
    rows = [("en" if i % 7 else "a b/ü" if i % 2 else None, None if i % 50 == 0 else f"line {i} é") for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(9)
    path = str(tmp_path / "out")
    write_whole_files(spark, df, "lang", path)
    folders = {"en": "lang=en", None: "lang=__HIVE_DEFAULT_PARTITION__"}
    got = {r["path"].split("/")[-2]: r for r in list_files(spark, path, glob="*.txt").collect()}
    assert len(got) == 3 and set(folders.values()) < set(got)
    for r in got.values():
        value = next((v for v, f in folders.items() if f == r["path"].split("/")[-2]), "a b/ü")
        with open(r["path"].removeprefix("file:"), encoding="utf-8") as f:
            lines = f.read().split("\n")
        assert lines.pop() == "" and sorted(lines) == sorted(t or "" for v, t in rows if v == value)
    assert not os.path.exists(f"{path}-parts")


def test_no_rows_are_an_empty_directory(spark, tmp_path):
    write_whole_files(spark, spark.createDataFrame([], "lang string, text string"), "lang", str(tmp_path / "out"))
    assert list_files(spark, str(tmp_path / "out")).count() == 0
