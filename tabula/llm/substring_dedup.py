"""Substring dedup by paragraph MinHash banding.

Paragraphs come in two sizes. A line of ``LEAST_WORDS`` words or more is a
paragraph, and so is a block of shorter lines in a row, without a blank or a
long line between them, of as many words together. Its five-word shingles get ``BANDS`` bands of ``ROWS`` minima, which
find a pair of similarity 0.8 with probability 0.998. Colliding lines are
compared on their full shingle sets (``similar_sets``), and the components of
the verified links are the classes. So that a passage pasted into the middle of
lines has paragraphs of its own, lines are also cut at places that depend on
the words around them in their line only (the least pair hash within ``REACH``
words); a repeated passage has the same cuts wherever it stands, and equal
lines are cut alike whatever lines they stand between. Such a short paragraph
has one band, all its words, and repeats of it are exact. Adjacent repeated ones
join into passages of ``LEAST_WORDS`` words or more, and passages that share a
paragraph are clustered by components.

The first occurrence (least doc_id, then first in the table) stays, the others
are removals. Copies are counted per distinct paragraph before anything is
compared, so a line that a third of all documents share is one set. Rows are
written once with a running number, which names them in every later reading.

Cases: null and empty texts have no paragraphs; a null doc_id is an ordinary
row, first only among rows that have none; repeated rows are repeats; a
document without repeats has no row; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, lean, numbered_rows, prepare, remove_written, table, written, written_at
from .components import components
from .similar_sets import similar_sets

#: Repeats of fewer words are no removals: short lines and phrases recur in any language.
LEAST_WORDS = 15
BANDS, ROWS = 9, 3
NUMERATOR, DENOMINATOR = 4, 5
REACH = 4


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, kind ("line" or "passage"), begin and end (word places), class_id,
    first_doc_id and removed, for every paragraph or passage with a repeat."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = numbered_rows(docs.sparkSession, rows, "row", "dedup-texts").select("row", "doc_id", "text")
    return _similar_lines(rows).unionAll(_passages(rows))


def _first(*place: str):
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *place)).alias("pick")


def _similar_lines(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    lines = written(spark, rows.mapInArrow(
        lean(_lines), "row long, doc_id long, begin int, words int, set_id binary, bands array<long>"), "dedup-lines")
    sets = lines.groupBy("set_id").agg(F.count("*").alias("copies"), _first("row", "begin", "words"),
                                       F.first("bands").alias("bands"))
    sets = written(spark, sets, "dedup-sets")

    def shingles_of(members: DataFrame) -> DataFrame:
        named = members.select("pick.row", "set_id", "pick.begin", "pick.words")
        # a document's lines together, so that its text goes along once
        lists = named.groupBy("row").agg(*[F.collect_list(c).alias(c) for c in ("set_id", "begin", "words")])
        texts = rows.select("row", "text").join(checked_broadcast(lists, 40, rows=named.count()), "row")
        return texts.select("text", "set_id", "begin", "words").mapInArrow(
            lean(_line_shingles), "set_id binary, shingles array<long>")

    linked = similar_sets(spark, sets, shingles_of, NUMERATOR, DENOMINATOR, "dedup")
    every = sets.select("set_id", "copies", "pick").join(linked, "set_id", "left").filter("links is not null or copies > 1")
    every = every.select("set_id", "pick", F.coalesce("root", "set_id").alias("root"))
    least = every.groupBy("root").agg(F.min("pick").alias("first"))
    classes = every.drop("pick").join(least, "root")
    found = lines.drop("bands").join(classes, "set_id")
    kept = (F.col("row") == F.col("first.row")) & (F.col("begin") == F.col("first.begin"))
    return found.select(
        "doc_id", F.lit("line").alias("kind"), F.col("begin").cast("long").alias("begin"),
        (F.col("begin") + F.col("words")).cast("long").alias("end"), F.concat(F.lit("line:"), F.lower(F.hex("root"))).alias("class_id"),
        F.col("first.doc_id").alias("first_doc_id"), (~kept).alias("removed"))


def _passages(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    cut, cut_path = written_at(spark, rows.mapInArrow(
        lean(_cut_paragraphs), "h long, second int, row long, doc_id long, begin int, words int"), "dedup-paragraphs")
    # which ones repeat is found on counts of their first hash alone, the least to
    # shuffle; their places follow for these, and both hashes decide
    again, again_path = written_at(spark, cut.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "dedup-repeated")
    repeated = written(spark, cut.join(checked_broadcast(again, 32), "h"), "dedup-cut")
    remove_written(spark, cut_path, again_path)
    firsts = repeated.groupBy("h", "second").agg(F.count("*").alias("n"), _first("row", "begin")).filter("n > 1").drop("n")
    repeated = repeated.join(firsts, ["h", "second"])
    by_place = Window.partitionBy("row").orderBy("begin")
    kept = (F.col("row") == F.col("pick.row")) & (F.col("begin") == F.col("pick.begin"))
    runs = repeated.withColumn("removed", ~kept).select(
        "*", F.lag(F.col("begin") + F.col("words")).over(by_place).alias("last"), F.lag("removed").over(by_place).alias("was"),
        F.lag("h").over(by_place).alias("beside"))
    adjacent = F.coalesce((F.col("last") == F.col("begin")) & (F.col("was") == F.col("removed")), F.lit(False))
    runs = runs.withColumn("adjacent", adjacent).withColumn(
        "run", F.sum(F.when(F.col("adjacent"), 0).otherwise(1)).over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("begin").alias("begin"), F.max(F.col("begin") + F.col("words")).alias("end"),
        F.min(F.struct("begin", "h", F.col("pick.doc_id").alias("first_doc_id"))).alias("head"), F.first("removed").alias("removed"))
    spans = spans.filter(F.col("end") - F.col("begin") >= LEAST_WORDS)
    links = runs.filter("adjacent").select(F.col("h").alias("a"), F.col("beside").alias("b")).distinct()
    clusters = components(spark, links, "dedup-clusters").withColumnsRenamed({"node": "of", "root": "cluster"})
    spans = spans.withColumn("h", F.col("head.h")).join(clusters, F.col("h") == F.col("of"), "left")
    return spans.select(
        "doc_id", F.lit("passage").alias("kind"), F.col("begin").cast("long"), F.col("end").cast("long"),
        F.concat(F.lit("passage:"), F.coalesce("cluster", "h")).alias("class_id"),
        F.col("head.first_doc_id").alias("first_doc_id"), "removed")


def _groups(batches):
    """Rows of about 4 million characters together: row, doc_id, texts."""
    from tabula.llm.common import by_bytes

    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for lo, hi in by_bytes(texts, 4_000_000):
            part = batch.slice(lo, hi - lo)
            yield part.column("row"), part.column("doc_id"), texts[lo:hi]


def paragraphs(lines, text_ends, least: int = LEAST_WORDS):
    """First words and sizes of the lines of ``least`` words or more, and of the
    blocks of shorter ones in a row that have as many; ``lines`` gives each word's
    line, counted through all texts, which end at the words ``text_ends``."""
    import numpy as np

    first = np.flatnonzero(np.diff(lines, prepend=-1))
    if not len(first):
        return first, first
    sizes = np.diff(np.append(first, len(lines)))
    owner = np.searchsorted(text_ends, first, side="right")
    short = sizes < least
    goes_on = short[1:] & short[:-1] & (np.diff(lines[first]) == 1) & (np.diff(owner) == 0)
    begin = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    sizes, first = np.add.reduceat(sizes, begin), first[begin]
    return first[sizes >= least], sizes[sizes >= least]


def _lines(batches):
    import numpy as np
    import pyarrow as pa

    from tabula.llm import minhash

    bands = minhash.Bands(BANDS, ROWS)
    for rows, docs, texts in _groups(batches):
        hashes, counts, lines = minhash.hashed_words(texts)
        text_ends = np.cumsum(counts)
        first, sizes = paragraphs(lines, text_ends)
        if not len(first):
            continue
        owner = np.searchsorted(text_ends, first, side="right")
        grams, ends = minhash.many_shingles(hashes, first, sizes)
        name = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(first), [None, pa.py_buffer(minhash.set_names(grams, ends))])
        flat = bands.of_many(grams, ends).reshape(-1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * BANDS), pa.array(flat))
        place = (first - (text_ends - counts)[owner]).astype(np.int32)
        owner = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [rows.take(owner), docs.take(owner), pa.array(place), pa.array(sizes.astype(np.int32)),
             name.cast(pa.binary()), lists], ["row", "doc_id", "begin", "words", "set_id", "bands"])


def _line_shingles(batches):
    import numpy as np
    import pyarrow as pa

    from tabula.llm import minhash

    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            hashes, counts, _ = minhash.hashed_words(part.column("text").to_pylist())
            names, grams = [], []
            starts = np.cumsum(counts) - counts
            for start, ids, begins, sizes in zip(starts, *(part.column(c).to_pylist() for c in ("set_id", "begin", "words"))):
                names += ids
                grams += [minhash.shingles(hashes[start + b:start + b + n]).view(np.int64) for b, n in zip(begins, sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(grams, pa.list_(pa.int64()))],
                                             ["set_id", "shingles"])


def cut_places(hashes, line_begins, reach: int = REACH):
    """Places where a text's words are cut: line begins, and the words whose pair
    hash is the least within ``reach`` words to both sides of their line (the first of equals)."""
    import numpy as np

    from tabula.llm import minhash

    n, most = len(hashes), np.iinfo(np.uint64).max
    line = np.zeros(n + 2 * reach, np.int64)
    line[reach + np.asarray(line_begins, np.int64)] = 1
    line = np.cumsum(line)
    line[:reach], line[reach + n:] = -1, -1
    pair = np.full(n + 2 * reach, most, np.uint64)
    if n > 1:
        pair[reach:reach + n - 1] = minhash.mix(hashes[:-1] * np.uint64(31) + hashes[1:])
        pair[:-1][line[1:] != line[:-1]] = most  # a line's last word has no pair
    own, at = pair[reach:reach + n], line[reach:reach + n]
    cut = own < most
    for d in range(1, reach + 1):
        before, after = slice(reach - d, reach - d + n), slice(reach + d, reach + d + n)
        cut &= ((own < pair[before]) | (line[before] != at)) & ((own <= pair[after]) | (line[after] != at))
    cut[line_begins] = True
    return np.flatnonzero(cut)


def _cut_paragraphs(batches):
    import numpy as np
    import pyarrow as pa

    from tabula.llm import minhash

    for rows, docs, texts in _groups(batches):
        hashes, counts, lines = minhash.hashed_words(texts)
        if not len(hashes):
            continue
        cuts = cut_places(hashes, np.flatnonzero(np.diff(lines, prepend=-1)))
        size = np.diff(np.append(cuts, len(hashes)))
        place = np.arange(len(hashes)) - np.repeat(cuts, size)
        spread = minhash.mix(hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        h = minhash.mix(np.add.reduceat(spread, cuts) + size.astype(np.uint64))
        second = minhash.mix(np.bitwise_xor.reduceat(spread, cuts)) >> np.uint64(32)
        text_ends = np.cumsum(counts)
        owner = np.searchsorted(text_ends, cuts, side="right")
        begin = (cuts - (text_ends - counts)[owner]).astype(np.int32)
        owner = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(second.astype(np.uint32).view(np.int32)), rows.take(owner), docs.take(owner),
             pa.array(begin), pa.array(size.astype(np.int32))], ["h", "second", "row", "doc_id", "begin", "words"])


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir))
