"""N-gram Jaccard join by MinHash banding.

Every document becomes its set of five-word shingles (words are runs of
non-blank characters). ``BANDS`` bands of ``ROWS`` minima find a pair of
similarity 0.8 with probability 0.99995, one of 0.9 practically always. Band
hashes are shuffled, colliding sets are compared on their full shingle sets
(see ``similar_sets``), and the verified links give each document its number
of links and its class, the component of the links.

Copies (equal shingle sets) are one set with a count, so they are never
expanded into pairs; no pair that shares a band is left out.

Rows are written once with a running number, which names them in every later
reading.

Cases: a null text, or one without words, has no shingles: a class of its own
and no links; a text of one to four words is one shingle; a null doc_id is an
ordinary row and never names a class that has another id; repeated rows are
copies; extra columns are ignored (``keep_one`` keeps them); an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checked_broadcast, lean, numbered_rows, prepare, table, written
from .similar_sets import similar_sets

BANDS, ROWS = 25, 5
NUMERATOR, DENOMINATOR = 4, 5


def ngram_join(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_links, copies, class_docs`` for each row of ``docs``."""
    rows, classes = _classes(numbered_rows(docs.sparkSession, docs.select("doc_id", "text"), "row", "ngram-texts"), "row")
    out = rows.join(classes, "set_id", "left")
    return out.select(
        "doc_id", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("pick.doc_id")).alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
        F.coalesce("class_docs", F.lit(1)).cast("long").alias("class_docs"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, with all columns: the least doc_id, then the
    first in the table; rows without shingles all stay."""
    name = _free(docs, "kept_row")
    numbered = numbered_rows(docs.sparkSession, docs, name, "ngram-texts")
    rows, classes = _classes(numbered, name)
    picks = classes.select(F.col("pick.row").alias("kept_row")).distinct()
    alone = rows.filter("set_id is null").select(F.col("row").alias("kept_row"))
    kept = picks.unionAll(alone).withColumnRenamed("kept_row", name)
    return numbered.join(kept, name, "left_semi").drop(name)


def _free(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _rows(numbered: DataFrame, name: str) -> DataFrame:
    return numbered.select(F.col(name).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def _classes(numbered: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, set_id) of a table with row numbers ``name`` and, for each
    set, copies, links and its class's pick and size."""
    spark = numbered.sparkSession
    prepare(spark)
    texts = _rows(numbered, name)
    rows = written(spark, texts.mapInArrow(lean(_sketch), "row long, doc_id long, set_id binary, bands array<long>"),
                   "ngram-rows")
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("pick")
    sets = rows.filter("set_id is not null").groupBy("set_id").agg(
        F.count("*").alias("copies"), pick, F.first("bands").alias("bands"))
    sets = written(spark, sets, "ngram-sets")

    def shingles_of(members: DataFrame) -> DataFrame:
        named = members.select("set_id", F.col("pick.row").alias("row"))
        return (texts.select("row", "text").join(checked_broadcast(named, 60), "row").select("set_id", "text")
                .mapInArrow(lean(_shingles), "set_id binary, shingles array<long>"))

    linked = similar_sets(spark, sets, shingles_of, NUMERATOR, DENOMINATOR, "ngram")
    every = sets.select("set_id", "copies", "pick").join(linked, "set_id", "left").select(
        "set_id", "copies", "pick", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "set_id").alias("root"))
    least = every.groupBy("root").agg(F.min("pick").alias("pick"), F.sum("copies").alias("class_docs"))
    return rows.drop("bands"), written(spark, every.drop("pick").join(least, "root").drop("root"), "ngram-classes")


def _sets(texts: list[str | None]):
    """The shingle set of each text."""
    import numpy as np

    from tabula.llm import minhash

    hashes, counts, _ = minhash.hashed_words(texts)
    ends = np.cumsum(counts)
    return [minhash.shingles(hashes[a:b]) for a, b in zip(ends - counts, ends)]


def _sketch(batches):
    import pyarrow as pa

    from tabula.llm import minhash
    from tabula.llm.common import by_bytes

    bands = minhash.Bands(BANDS, ROWS)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        ids, hashes = [], []
        for lo, hi in by_bytes([t or "" for t in texts], 4_000_000):
            for grams in _sets(texts[lo:hi]):
                ids.append(minhash.set_id(grams) if len(grams) else None)
                hashes.append(bands.of(grams) if len(grams) else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))],
            ["row", "doc_id", "set_id", "bands"])


def _shingles(batches):
    import numpy as np
    import pyarrow as pa

    from tabula.llm.common import by_bytes

    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for lo, hi in by_bytes(texts, 2_000_000):
            grams = [g.view(np.int64) for g in _sets(texts[lo:hi])]
            yield pa.RecordBatch.from_arrays([batch.column("set_id").slice(lo, hi - lo), pa.array(grams, pa.list_(pa.int64()))],
                                             ["set_id", "shingles"])


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir))
