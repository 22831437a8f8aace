"""Safe publication of tables and models.

Every write has a folder of its own, ``<root>/versions/<version>``. When it is
complete, a manifest entry ``<root>/manifest/<version>`` is written, in a folder
of its own too, so writers never share one and can't disturb each other's
commits. Readers resolve the newest complete entry; a folder without an entry
(a writer that failed or is still busy) is never read. Versions are named by
time, then at random, so two writers of one moment both stay and all readers
agree on one of them. ``vacuum`` removes old versions after a grace period.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def new_version() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def age_s(version: str) -> float:
    return (time.time_ns() - int(version.split("-")[0])) / 1e9


def remove(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/versions/{version}"


def announce(spark: SparkSession, root: str, version: str, **facts) -> None:
    """Make a complete version known, with facts about it (kept as JSON)."""
    document = json.dumps({"version": version, **facts})
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.text(f"{root.rstrip('/')}/manifest/{version}")


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the complete versions, oldest first: one entry a version, and
    ``vacuum`` keeps them few."""
    fs, path = _fs(spark, f"{root.rstrip('/')}/manifest")
    if not fs.exists(path):
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n for n in names if fs.exists(hadoop(hadoop(path, n), "_SUCCESS")))


def facts(spark: SparkSession, root: str, version: str) -> dict:
    return json.loads(spark.read.text(f"{root.rstrip('/')}/manifest/{version}").first()["value"])


def newest(spark: SparkSession, root: str) -> str | None:
    found = versions(spark, root)
    return found[-1] if found else None


def publish(spark: SparkSession, root: str, write: Callable[[str], None], **facts) -> str:
    """Let ``write`` fill a new version's folder, then announce it; gives the version."""
    version = new_version()
    write(version_path(root, version))
    announce(spark, root, version, **facts)
    return version


def publish_table(spark: SparkSession, df: DataFrame, root: str, fmt: str = "parquet") -> str:
    return publish(spark, root, lambda path: df.write.format(fmt).save(path), format=fmt)


def read_newest(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame | None:
    """The newest complete version; None if there is none."""
    version = newest(spark, root)
    return None if version is None else spark.read.format(fmt).load(version_path(root, version))


def vacuum(spark: SparkSession, root: str, keep: int = 2, grace_s: float = 86_400) -> list[str]:
    """Remove complete versions but the newest ``keep``, if they are older than
    ``grace_s`` (a reader may still be at one). Gives their names."""
    if keep < 1:
        raise ValueError("keep at least one version")
    gone = []
    for version in versions(spark, root)[:-keep]:
        if age_s(version) < grace_s:
            continue
        for path in (f"{root.rstrip('/')}/manifest/{version}", version_path(root, version)):  # no reader finds half of one
            remove(spark, path)
        gone.append(version)
    return gone
