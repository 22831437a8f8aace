"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.session import scratch_path, ship_package

# White space as the tokenizer libraries see it (the Unicode White_Space property).
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUNS = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")
_DOUBLE = re.compile(r"\s\s")
#: Tokenizer files are a few MB; a larger one is refused rather than shipped to every task.
MAX_VOCABULARY_BYTES = 64 << 20
BATCH_ROWS = 2048
#: Most that a join broadcasts, by counted rows.
BROADCAST_BYTES = 32 << 20
#: Vector components are compared as integers of this many to one.
SCALE = 256


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    return written_at(spark, df, name)[0]


def written_at(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``written``, and the path for ``remove_written``."""
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove_written(spark: SparkSession, *paths: str) -> None:
    """Delete tables that only tables written since were made from."""
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def numbered_rows(spark: SparkSession, df: DataFrame, row: str, name: str) -> DataFrame:
    """``df`` with a running number ``row``, written once: every later step reads
    the same numbers, however Spark plans a scan of ``df`` again."""
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    out = df.withColumn(row, F.monotonically_increasing_id())
    out.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def remove_intermediate(spark: SparkSession) -> None:
    """Delete what ``written`` left in the shared folder, once no result that
    reads it is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "llm"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checked_broadcast(small: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES, rows: int | None = None) -> DataFrame:
    """``small`` with a broadcast hint if its rows, counted (or given as
    ``rows``), take at most ``limit`` bytes; beyond that Spark joins by shuffle.
    ``small`` should be a table read."""
    rows = small.count() if rows is None else rows
    return F.broadcast(small) if rows * row_bytes <= limit else small


def scaled(vector: Column, limit: Column) -> Column:
    """floor(SCALE * x) of every component as long, no further than ``limit`` from 0;
    null for a null vector and one with a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    whole = F.transform(vector, lambda x: F.greatest(-limit, F.least(limit, F.floor(x.cast("double") * SCALE))).cast("long"))
    return F.when(finite, whole)


def vocabulary(path: str) -> bytes:
    """A tokenizer file's bytes, read on the driver and of a checked size, to
    ship with the task closure so that executors need no such file."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


def prepare(spark: SparkSession) -> None:
    """Make the package importable in the Python workers, and keep the Arrow
    batches of whole texts as small as this library's own sessions do."""
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))


def release_memory() -> None:
    """Hand freed memory back to the system: Python workers are used again by
    later stages, and several share an executor's memory with its JVM."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps what it has


def lean(run):
    """A mapInArrow function that releases memory when its task ends."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


def pieces(text: str) -> list[str]:
    """Cut a text before each white-space run: every piece is a run of white
    space (maybe none) and the non-space run after it; the last may be white
    space only. No byte-level BPE pre-token crosses such a cut, so a text's
    ids are its pieces' ids in a row. A text without two white-space
    characters in a row is cut before each space; its pieces may then hold
    a line break, which changes nothing about that."""
    if _DOUBLE.search(text):
        return _RUNS.findall(text)
    first, *rest = text.split(" ")
    out = [" " + p for p in rest]
    if first:
        out.insert(0, first)
    return out


_TWO_BLANKS = (r"[\t-\r\x{1c}-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}")


def coded_pieces(texts: list[str]):
    """``pieces`` of many texts at once: the distinct pieces as an Arrow array, and
    for each text an array of their numbers. Texts without two blanks in a row
    are cut and numbered by Arrow; the others one by one."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    plain = pa.array(texts, pa.large_string())
    odd = pc.match_substring_regex(plain, _TWO_BLANKS).to_numpy(zero_copy_only=False) if texts else []
    regular = [t for t, o in zip(texts, odd) if not o]
    cut = pc.split_pattern(pa.array(regular, pa.large_string()), " ")
    numbered = cut.values.dictionary_encode()
    code = numbered.indices.to_numpy().astype(np.int64)
    ends = cut.offsets.to_numpy()
    own: dict[str, int] = {}

    def number(piece: str) -> int:
        return own.setdefault(piece, len(numbered.dictionary) + len(own))

    # a space begins each piece but a text's first
    for i, t in zip(ends[:-1].tolist(), regular):
        code[i] = number(t.split(" ", 1)[0])
    out, k = [], 0
    for t, o in zip(texts, odd):
        if o:
            out.append(np.fromiter(map(number, pieces(t)), np.int64))
        else:
            out.append(code[ends[k]:ends[k + 1]])
            k += 1
    blank = pa.scalar(" ", pa.large_string())
    spaced = pc.binary_join_element_wise(blank, numbered.dictionary, pa.scalar("", pa.large_string()))
    return pa.concat_arrays([spaced, pa.array(own, pa.large_string())]), out


def stretches(flat, start, size, code):
    """The stretches ``flat[start:start + size]`` of the entries ``code``, in a row."""
    import numpy as np

    n = size[code]
    ends = np.cumsum(n)
    return flat[np.repeat(start[code] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


def segments(text: str, limit: int) -> Iterator[str]:
    """Split a long text before a space that follows a non-space, so that each
    part has about ``limit`` characters; a longer run without such a place
    stays whole."""
    start = 0
    while len(text) - start > limit:
        cut = start + limit
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or not text[cut - 1].isspace():
                break
            cut += 1
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def text_groups(batches, limit: int) -> Iterator[tuple[list, list[str]]]:
    """doc_ids and texts (null as empty) of Arrow batches, whole rows of about
    ``limit`` characters together."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            keys.append(key)
            texts.append(text or "")
            size += len(texts[-1])
            if size >= limit:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def by_bytes(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``limit`` characters together."""
    return by_size(map(len, texts), limit)


def by_size(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``limit``; a larger row is alone."""
    start = size = end = 0
    for i, one in enumerate(sizes):
        if size and size + one > limit:
            yield start, i
            start, size = i, 0
        size += one
        end = i + 1
    if start < end:
        yield start, end
