"""Session helpers.

The library never hard-codes a master: on a cluster the submitter decides.
``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on. AQE re-plans joins and
# coalesces shuffle partitions at runtime; skew-join splits hot partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # images and wide rows: keep Arrow batches small so one batch fits a task
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


def get_spark(app_name: str = "tabula", conf: dict[str, str] | None = None) -> SparkSession:
    """Session for cluster use: master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tabula-local", extra: dict[str, str] | None = None) -> SparkSession:
    """Single-JVM session for tests and the bench (UI off, no server port)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` is set by the operator and is a
    shared file system; we only read it. When it is unset, a local session gets
    a fresh scratch folder, removed when the driver ends; any other master is
    refused, since its executors would write to disks of their own.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
        current = tempfile.mkdtemp(prefix="tabula-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, current, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for sinks written by queries)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, *parts])


_SHIPPED: set[str] = set()
_SHIP_LOCK = __import__("threading").Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tabula`` importable in the Python workers (what ``--py-files``
    does at submit time): zip the package once per SparkContext and
    ``addPyFile`` it; Spark serves the file to every executor. Needed by the
    ``mapInPandas`` stages, whose functions import this package."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    with _SHIP_LOCK:
        if key in _SHIPPED:
            return
        import zipfile

        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg_dir)
        zpath = os.path.join(tempfile.mkdtemp(prefix="tabula-pyfiles-"), "tabula.zip")
        with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
            for dirpath, _, files in os.walk(pkg_dir):
                for f in sorted(files):
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(zpath)
        _SHIPPED.add(key)
