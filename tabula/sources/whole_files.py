"""One text file per value of a column, however many lines a value has.

The tasks write the lines they read as parts, a directory a value, without a
shuffle. The lengths of the parts give each its place in the value's file, and
tasks copy the parts to their places at the same time. A copy that is tried
again writes the same bytes to the same place. So no task handles more than the
lines of one input split, also when one value has nearly all of them.

A file can be written at several places on a mounted file system only; on
another, one task writes a value's file. Cases: values without lines have no
file; an empty table gives an empty directory; a null or empty value is
``__HIVE_DEFAULT_PARTITION__``, as Spark's writer names it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabula.session import ship_package
from tabula.sources.listing import _open, list_files

CHUNK = 4 << 20


def write_whole_files(spark: SparkSession, df: DataFrame, column: str, path: str) -> None:
    """The rows of ``df`` (``column`` and a text column) as ``path/column=value/lines.txt``."""
    from pyarrow import fs

    system, top, _ = _open(path)
    if not isinstance(system, fs.LocalFileSystem):
        df.repartition(column).write.partitionBy(column).text(path)
        return
    ship_package(spark)
    parts = f"{path}-parts"
    df.write.partitionBy(column).text(parts)
    os.makedirs(top, exist_ok=True)
    # a row a part: as many as tasks wrote, times the values
    in_file = Window.partitionBy("folder").orderBy("path")
    placed = (list_files(spark, parts, glob="*.txt")
              .select("path", "length", F.regexp_extract("path", "/([^/]*)/[^/]*$", 1).alias("folder"))
              .withColumn("begin", F.sum("length").over(in_file) - F.col("length")))
    tasks = max(8, 2 * spark.sparkContext.defaultParallelism)
    copied = placed.repartition(tasks).mapInArrow(_copied(top), "n long")
    copied.agg(F.sum("n")).collect()
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parts)
    old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def _copied(top: str):
    def run(batches):
        import pyarrow as pa

        from tabula.sources.whole_files import copy_part

        for batch in batches:
            n = [copy_part(r["path"], f"{top}/{r['folder']}", r["begin"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n"])

    return run


def copy_part(part: str, folder: str, begin: int) -> int:
    """Copy the file ``part`` to the place ``begin`` of the folder's file; its length."""
    os.makedirs(folder, exist_ok=True)
    done = 0
    out = os.open(f"{folder}/lines.txt", os.O_WRONLY | os.O_CREAT, 0o644)
    try:
        with open(_open(part)[1], "rb") as lines:
            while chunk := lines.read(CHUNK):
                view = memoryview(chunk)
                while view:
                    n = os.pwrite(out, view, begin + done)
                    done, view = done + n, view[n:]
    finally:
        os.close(out)
    return done
