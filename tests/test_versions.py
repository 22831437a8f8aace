"""Safe publication: concurrent writers, broken writers, readers."""

import threading

import pytest

from tabula.sources import versions
from tabula.sources.tables import materialize


def test_two_writers_and_a_reader(spark, tmp_path):
    root, errors, seen = str(tmp_path / "t"), [], []

    def write(k):
        try:
            for _ in range(3):
                versions.publish_table(spark, spark.range(1000).selectExpr("id", f"{k} as writer"), root)
        except Exception as exc:  # shown by the assertion
            errors.append(exc)

    writers = [threading.Thread(target=write, args=(k,)) for k in (1, 2)]
    for w in writers:
        w.start()
    while any(w.is_alive() for w in writers):
        df = versions.read_newest(spark, root)
        if df is not None:
            seen.append((df.count(), df.select("writer").distinct().count()))
    for w in writers:
        w.join()
    assert not errors and len(versions.versions(spark, root)) == 6
    assert seen and set(seen) == {(1000, 1)}  # always one whole version


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.newest(spark, root) is None and versions.read_newest(spark, root) is None
    first = versions.publish_table(spark, spark.range(3), root)

    def broken(path):
        spark.range(5).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        versions.publish(spark, root, broken)
    assert versions.newest(spark, root) == first and versions.read_newest(spark, root).count() == 3
    (tmp_path / "t" / "manifest" / "99999999999999999999-x").mkdir()  # an entry that is being written
    assert versions.newest(spark, root) == first


def test_vacuum_keeps_the_newest(spark, tmp_path):
    root = str(tmp_path / "t")
    made = [versions.publish_table(spark, spark.range(n), root) for n in (1, 2, 3)]
    assert versions.vacuum(spark, root, keep=1) == []  # within the grace period
    assert versions.vacuum(spark, root, keep=1, grace_s=0) == made[:2]
    assert versions.read_newest(spark, root).count() == 3 and versions.versions(spark, root) == made[2:]
    with pytest.raises(ValueError):
        versions.vacuum(spark, root, keep=0)


def test_materialize_reuses_and_forces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert materialize(spark, spark.range(2), path).count() == 2
    assert materialize(spark, spark.range(9), path).count() == 2
    assert materialize(spark, spark.range(9), path, force=True).count() == 9
    assert materialize(spark, spark.range(1), path).count() == 9
