"""Files listed by the tasks, as a Spark data source.

``spark.read.format("file_listing")`` gives one row per file under ``path``:
path, length (0 too, which Spark's own file sources skip) and time of change.
The driver looks at the upper directories only, until there are ``tasks`` of
them; each is one partition whose task walks it and yields Arrow batches. No
list of files passes through the driver or the plan.

Names that begin with ``_`` or ``.`` are hidden, as for Spark's file sources.
Any file system that Arrow opens by URI will do (a plain path is a mounted
one); another scheme is an error. A file that vanishes while being listed has
no row. Options: ``path``, ``glob`` (of the file name), ``tasks``.
"""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tabula.session import ship_package

SCHEMA = "path string, length bigint, modified timestamp"
TASKS = 64
BATCH = 4096


def _open(path: str):
    """File system, its own spelling of ``path``, and what to put before that in results."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path, "file:"
    if path.startswith("file:"):
        bare = path[5:]
        return fs.LocalFileSystem(), "/" + bare.lstrip("/"), "file:"
    system, own = fs.FileSystem.from_uri(path)
    return system, own, path[: len(path) - len(own.lstrip("/"))] if path.endswith(own.lstrip("/")) else ""


def _entries(system, directory: str):
    from pyarrow import fs

    for info in system.get_file_info(fs.FileSelector(directory, allow_not_found=True)):
        if not info.base_name.startswith(("_", ".")):
            yield info


class Part(InputPartition):
    def __init__(self, directory: str, deep: bool):
        super().__init__(directory)
        self.directory, self.deep = directory, deep


class ListingReader(DataSourceReader):
    def __init__(self, options):
        if not options.get("path"):
            raise ValueError("file_listing needs a path")
        self.path, self.glob = options["path"], options.get("glob")
        self.tasks = int(options.get("tasks", TASKS))

    def partitions(self):
        from pyarrow import fs

        system, top, _ = _open(self.path)
        if system.get_file_info(top).type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        done, open_ = [], [top]
        while open_ and len(done) + len(open_) < self.tasks:
            below = []
            for directory in open_:
                done.append(Part(directory, deep=False))  # its own files
                below += [e.path for e in _entries(system, directory) if e.type == fs.FileType.Directory]
            open_ = below
        return done + [Part(directory, deep=True) for directory in open_]

    def read(self, partition):
        import pyarrow as pa
        from pyarrow import fs

        system, _, before = _open(self.path)
        waiting, rows = [partition.directory], []

        def batch():
            path, length, modified = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(path, pa.string()), pa.array(length, pa.int64()), pa.array(modified, pa.timestamp("us", "UTC"))],
                ["path", "length", "modified"])

        while waiting:
            for e in _entries(system, waiting.pop()):
                if e.type == fs.FileType.Directory and partition.deep:
                    waiting.append(e.path)
                elif e.type == fs.FileType.File and (not self.glob or fnmatch.fnmatchcase(e.base_name, self.glob)):
                    rows.append((before + e.path, e.size or 0, e.mtime))
                    if len(rows) >= BATCH:
                        yield batch()
                        rows = []
        if rows:
            yield batch()


class FileListing(DataSource):
    @classmethod
    def name(cls):
        return "file_listing"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ListingReader(self.options)


def list_files(spark: SparkSession, path: str, glob: str | None = None, tasks: int = TASKS) -> DataFrame:
    """path, length and modified of every file under ``path``."""
    ship_package(spark)
    spark.dataSource.register(FileListing)
    reader = spark.read.format("file_listing").option("path", path).option("tasks", str(tasks))
    return (reader.option("glob", glob) if glob else reader).load()
