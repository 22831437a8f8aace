"""Target-distribution importance resampling over hashed word features.

Raw texts (``documents``) are weighted by how much more common their features
are in a target (``benchmark``). A ``Split`` pre-tokeniser of the tokenizers
library, which is never trained, cuts an ASCII-lowered text into words with
offsets. Runs of 1 to ``longest`` words are windows of offset pairs; each run's
words, joined by one space, fall into one of ``buckets`` by their CRC-32. A
text becomes its bucket counts, at most ``buckets`` numbers however long it is,
written once. The two histograms are sums of these, the gains a table of
``buckets`` rows, and a weight the sum of count times gain. Documents are drawn
by Gumbel-perturbed weight, highest first.

Ranks are made without a single sorted task: rows are dealt by ranges of
(score, doc_id, row), sorted inside a range and shifted by the sizes of the
ranges before it, one row a range.

Cases: a null text, or one without words, has no features and weight 0; a
document under ``least_words`` words has a score, but is not drawn; rows are
weighted and drawn one by one, so repeated rows have equal scores and ranks in
a row; a null doc_id hashes as the empty string and comes last among equal
scores; extra columns are ignored; with an empty target all its counts are 0;
an empty table gives no rows. Long texts are cut at characters that no word
holds, windows go across the cuts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, lean, numbered_rows, prepare, table, written

BUCKETS = 10_000
#: Histograms and gains go to the driver and to every task: a bound on the parameter bounds them.
MAX_BUCKETS = 1 << 20
LONGEST, LEAST_WORDS, PERCENT, SEED = 1, 20, 10, 2024
PART_CHARS = 20_000
GROUP_CHARS = 4_000_000
#: Spellings whose bucket a task remembers; it forgets them all beyond that.
MEMORY_WORDS = 300_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
COUNTED = "n_words long, n_features long, buckets array<int>, counts array<long>"


def importance(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS,
               least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for each row of ``docs``
    (columns doc_id and text); rank is null for a document that isn't drawn."""
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets: 1 to {MAX_BUCKETS}")
    spark = docs.sparkSession
    prepare(spark)
    raw = written(spark, bucket_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), longest, buckets),
                  "importance-counts")
    aim = bucket_counts(target.select("text"), longest, buckets)
    weights = gains(histogram(aim), histogram(raw), buckets)
    return drawn(weighted(raw, weights, seed), least_words, percent)


def bucket_counts(rows: DataFrame, longest: int, buckets: int) -> DataFrame:
    """``rows`` with the text replaced by its words' and features' numbers and its
    bucket counts."""
    rows = rows.withColumn("text", F.col("text").cast("string"))
    others = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), COUNTED])
    return rows.mapInArrow(lean(_counter([f.name for f in others], longest, buckets)), schema)


def histogram(counted: DataFrame) -> DataFrame:
    """``bucket, n``: features of all rows in each bucket that has any."""
    return (counted.select(F.explode(F.arrays_zip("buckets", "counts")).alias("at"))
            .groupBy(F.col("at.buckets").alias("bucket")).agg(F.sum("at.counts").alias("n")))


def gains(target: DataFrame, raw: DataFrame, buckets: int) -> list[int]:
    """floor(1000 ln) of the ratio of the smoothed shares, by bucket. Both
    histograms have ``buckets`` rows at most."""
    both = target.withColumnRenamed("n", "t").join(raw.withColumnRenamed("n", "s"), "bucket", "full").na.fill(0, ["t", "s"])
    rows = both.collect()
    all_t, all_s = float(sum(r.t for r in rows) + buckets), float(sum(r.s for r in rows) + buckets)
    out = [0] * buckets  # a bucket that neither has occurs in no text
    for r in rows:
        out[r.bucket] = math.floor(1000 * math.log((float(r.t + 1) * all_s) / (float(r.s + 1) * all_t)))
    return out


def weighted(counted: DataFrame, weights: list[int], seed: int) -> DataFrame:
    """``counted`` with ``weight`` and the perturbed ``score`` in place of the bucket counts."""
    spread = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256),
                                1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((spread + 0.5) / 4294967296.0)))
    out = counted.mapInArrow(lean(_weigher(weights)), "doc_id long, n_words long, n_features long, weight long")
    return out.withColumn("score", F.col("weight") + noise)


def drawn(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """``scored`` with ``rank`` 1, 2, ... for the floor(percent * N / 100) highest
    scores among the N rows of ``least_words`` words or more."""
    spark = scored.sparkSession
    scored = numbered_rows(spark, scored, "row", "importance-scored")
    able = scored.filter(F.col("n_words") >= least_words)
    n_drawn = percent * able.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    sorted_ = able.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    sorted_ = written(spark, sorted_, "importance-sorted")
    # one row a range
    sizes = sorted(sorted_.groupBy("part").count().collect())
    before, bases = 0, []
    for part, n in sizes:
        bases.append((part, before))
        before += n
    base = spark.createDataFrame(bases, "part int, base long")
    ranked = sorted_.join(F.broadcast(base), "part").withColumn("rank", F.col("base") + F.col("place") + 1)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(F.col("rank") <= n_drawn, F.col("rank")).alias("rank")).unionAll(
        scored.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long")))


def parts(text: str, limit: int) -> Iterator[str]:
    """Parts of about ``limit`` characters, each but the last ended by a character
    that no word holds; a longer word stays whole."""
    start = 0
    while len(text) - start > limit:
        gap = _GAP.search(text, start + limit)
        if not gap:
            break
        yield text[start:gap.end()]
        start = gap.end()
    yield text[start:]


class Buckets(dict):
    """Bucket of a feature, remembered while there are not too many."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        import zlib

        if len(self) >= MEMORY_WORDS:
            self.clear()
        bucket = zlib.crc32(feature.encode()) % self.buckets
        if len(feature) <= 64:
            self[feature] = bucket
        return bucket


def _splitter():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(WORD), behavior="removed", invert=True)


def features(split, text: str, longest: int, limit: int = PART_CHARS) -> Iterator[tuple[int, list[str]]]:
    """For each part of ``text``: its number of words, and all runs of 1 to
    ``longest`` words that end in it."""
    lower = text.encode().lower().decode()  # bytes.lower() changes A-Z only
    carried: list[str] = []
    for part in parts(lower, limit):
        found = split.pre_tokenize_str(part)
        # word k + i ends a run that begins at word i: a window is a pair of offsets
        pairs = [offsets for _, offsets in found]
        words = carried + [part[a:b] for a, b in pairs]
        old = len(carried)
        runs = words[old:]
        for n in range(2, longest + 1):
            runs = runs + [" ".join(words[i - n + 1:i + 1]) for i in range(max(old, n - 1), len(words))]
        yield len(pairs), runs
        carried = words[-(longest - 1):] if longest > 1 else []


def _counter(others: list[str], longest: int, buckets: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        split, bucket_of = _splitter(), Buckets(buckets)

        def count(text: str):
            n_words, total = 0, None
            for n, runs in features(split, text, longest):
                n_words += n
                ids = np.fromiter(map(bucket_of.__getitem__, runs), np.int64, len(runs))
                if total is None and len(text) <= PART_CHARS:
                    which, times = np.unique(ids, return_counts=True)
                    return n_words, which.astype(np.int32), times.astype(np.int64)
                part = np.bincount(ids, minlength=buckets)
                total = part if total is None else total + part
            which = np.flatnonzero(total)
            return n_words, which.astype(np.int32), total[which].astype(np.int64)

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in by_bytes(texts, GROUP_CHARS):
                made = [count(t) for t in texts[lo:hi]]
                ends = np.concatenate([[0], np.cumsum([len(which) for _, which, _ in made])]).astype(np.int32)
                which = pa.array(np.concatenate([which for _, which, _ in made]))
                times = pa.array(np.concatenate([times for _, _, times in made]))
                sums = [int(t.sum()) for _, _, t in made]
                kept = [batch.column(c).slice(lo, hi - lo) for c in others]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([n for n, _, _ in made], pa.int64()), pa.array(sums, pa.int64()),
                     pa.ListArray.from_arrays(ends, which), pa.ListArray.from_arrays(ends, times)],
                    [*others, "n_words", "n_features", "buckets", "counts"])

    return run


def _weigher(weights: list[int]):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        gain = np.array(weights, np.int64)
        for batch in batches:
            which, counts = batch.column("buckets"), batch.column("counts")
            ends = which.offsets.to_numpy().astype(np.int64)
            first, last = ends[0], ends[-1]
            value = gain[which.values.to_numpy()[first:last]] * counts.values.to_numpy()[
                counts.offsets[0].as_py():counts.offsets[0].as_py() + last - first]
            running = np.concatenate([[0], np.cumsum(value)])
            weight = running[ends[1:] - first] - running[ends[:-1] - first]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), batch.column("n_features"), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"])

    return run


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank (and n_words) of every document:
    single words in 10,000 buckets, a tenth drawn, ``benchmark`` as target."""
    return importance(table(spark, sf_dir), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank", "n_words")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: CRC-32 of a word's UTF-8 bytes, bit by bit: 3988292384 is the reversed polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 1 + octet_length(encode(word))),
    lambda k: ('0x' || substr(hex(encode(word)), 2 * k - 1, 2))::BIGINT)), lambda c, b:
    list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
OP13_SQL = f"""
WITH raw AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
raw_words AS (SELECT r, unnest(words) AS word FROM raw),
aim_words AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
spelled AS (SELECT DISTINCT word FROM (SELECT word FROM raw_words UNION ALL SELECT word FROM aim_words)),
hashed AS (SELECT word, {_CRC} % {BUCKETS} AS bucket FROM spelled),
raw_counts AS (SELECT bucket, count(*) AS s FROM raw_words JOIN hashed USING (word) GROUP BY bucket),
aim_counts AS (SELECT bucket, count(*) AS t FROM aim_words JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM raw_words) AS all_s, (SELECT count(*) FROM aim_words) AS all_t),
gains AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (all_s + {BUCKETS})::DOUBLE)
                 / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + {BUCKETS})::DOUBLE)))::BIGINT AS gain
          FROM (SELECT * FROM raw_counts FULL JOIN aim_counts USING (bucket)), sums),
weights AS (SELECT r, sum(gain)::BIGINT AS w FROM raw_words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT raw.r, doc_id, len(words)::BIGINT AS n_words, coalesce(w, 0)::BIGINT AS weight,
                  (coalesce(w, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
                   + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
           FROM raw LEFT JOIN weights USING (r)),
able AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scored WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_words AS n_features, weight, score,
       CASE WHEN rank <= (SELECT {PERCENT} * count(*) // 100 FROM able) THEN rank END AS rank, n_words
FROM scored LEFT JOIN able USING (r)
"""
