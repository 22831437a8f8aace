"""Benchmark decontamination with an FM-index per training shard.

Each task cuts its documents into shards of about ``SHARD_WORDS`` words and
builds a word-level FM-index of every shard: the suffix order by prefix
doubling, the Burrows-Wheeler transform in a wavelet matrix with bit ranks,
and the suffix positions of every ``SAMPLE``-th place. All test phrases (the
items' windows) are searched backwards at once through the ranks; the rows of
a phrase's interval are walked to sampled positions, which locates every
occurrence, and overlapping occurrences merge into removal spans.

A phrase is a window of ``window`` consecutive item words, or the whole item if
it has fewer words. Documents are never shuffled. The phrases are sent to the
tasks. Items of more than ``SLICE_BYTES``, measured beforehand, are first brought
to one owner for equal texts and dealt into slices of about that many bytes; the
documents are read once for each slice, one after the other, and their spans
merged by document. The owners found then get the ids of all their item rows.

Cases: a null or empty text has no words and no hits; an item without words
matches nothing; repeated items each count (by item_id), null item_ids are
left out of the digest; rows are judged one by one whatever their doc_ids (the
slices meet on a row number given before); a text longer than a shard is
indexed in overlapping parts; extra columns are kept by ``with_hits``; empty
tables give no rows, an empty benchmark no hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, lean, prepare, table, written

WINDOW = 13
SHARD_WORDS = 1_000_000
SHARD_CHARS = 4_000_000
SAMPLE = 16
SLICE_BYTES = 8 << 20
#: A-Z lower-cased, other ASCII letters and digits and all bytes of longer code points kept, the rest blank.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))
HITS = "n_words long, n_hit long, items array<string>, spans array<struct<begin:long,end:long>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class Phrases:
    """The distinct windows of some items, as rows of word numbers."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        import numpy as np

        self.vocabulary: dict[bytes, int] = {}
        self.items = [i for i, _ in items]
        owners: dict[tuple, set[int]] = {}
        for k, (_, text) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[i:i + window]), set()).add(k)
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.words = np.full((len(owners), window), -1, np.int64)
        for r, p in enumerate(owners):
            self.words[r, :len(p)] = p
        self.owners = [sorted(o) for o in owners.values()]


class BitRanks:
    """A bit vector and the number of ones before any place."""

    def __init__(self, bits):
        import numpy as np

        raw = np.packbits(bits, bitorder="little")
        self.blocks = np.concatenate([raw, np.zeros(16 - len(raw) % 8, np.uint8)]).view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int32)])

    def ones(self, i):
        import numpy as np

        b = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[b] + np.bitwise_count(self.blocks[b] & mask)

    def get(self, i):
        import numpy as np

        return (self.blocks[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


def suffix_order(symbols):
    """Suffix array of a text whose symbol 0 ends a document. Each 0 counts as a
    symbol of its own, smaller than all others, so no comparison leaves its
    document and the order is complete. Doubling sorts only what still ties."""
    import numpy as np

    n = len(symbols)
    ends = symbols == 0
    rank = symbols.astype(np.int64) + int(ends.sum()) - 1
    rank[ends] = np.arange(int(ends.sum()))
    base = int(rank.max()) + 1
    pack = 3 if base < 1 << 21 else 2
    key = rank.copy()
    for j in range(1, pack):
        key *= base
        key[:n - j] += rank[j:]
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(first, n))
    rank[order] = np.repeat(first, sizes)
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    step = pack
    while len(slots):
        at = order[slots]
        key = (rank[at] << 32) | rank[np.minimum(at + step, n - 1)]
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[slots] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(slots)))
        rank[at] = np.repeat(slots[first], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order


class FMIndex:
    """FM-index of a sequence of word numbers (0 after each document)."""

    def __init__(self, symbols, sample: int = SAMPLE):
        import numpy as np

        n, sigma = len(symbols), int(symbols.max()) + 1
        order = suffix_order(symbols)
        last = symbols[order - 1]
        self.size = n
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))])
        sampled = (order % sample == 0) | (last == 0)
        self.sampled, self.positions = BitRanks(sampled), order[sampled]
        self.levels = []
        start = np.zeros(sigma, np.int64)
        values = np.arange(sigma)
        for level in range(max(1, (sigma - 1).bit_length()) - 1, -1, -1):
            bits = ((last >> level) & 1).astype(bool)
            ranks, zeros = BitRanks(bits), n - int(bits.sum())
            self.levels.append((level, ranks, zeros))
            start = self._down(start, (values >> level) & 1, ranks, zeros)
            last = np.concatenate([last[~bits], last[bits]])
        self.start = start

    @staticmethod
    def _down(i, bit, ranks, zeros):
        import numpy as np

        ones = ranks.ones(i)
        return np.where(bit == 1, zeros + ones, i - ones)

    def extend(self, i, symbol):
        """Row of the first suffix not before row ``i`` when ``symbol`` is put in front."""
        for level, ranks, zeros in self.levels:
            i = self._down(i, (symbol >> level) & 1, ranks, zeros)
        return self.smaller[symbol] + i - self.start[symbol]

    def search(self, phrases, lengths):
        """Row intervals of phrases (rows of symbols, ``lengths`` of them used)."""
        import numpy as np

        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for back in range(phrases.shape[1] if len(phrases) else 0):
            live = np.flatnonzero((lengths > back) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - back]
            low[live], high[live] = self.extend(low[live], symbol), self.extend(high[live], symbol)
        return low, np.maximum(low, high)

    def locate(self, rows):
        """Text positions of suffix rows, by walking back to sampled ones."""
        import numpy as np

        out, todo, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(todo):
            there = self.sampled.get(rows) == 1
            out[todo[there]] = self.positions[self.sampled.ones(rows[there])] + steps
            todo, rows = todo[~there], rows[~there]
            at, symbol = rows, np.zeros(len(rows), np.int64)
            for level, ranks, zeros in self.levels:
                bit = ranks.get(at).astype(np.int64)
                symbol |= bit << level
                at = self._down(at, bit, ranks, zeros)
            rows = self.smaller[symbol] + at - self.start[symbol]
            steps += 1
        return out


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self) + 1
        return n


def find_hits(documents: list[list[bytes]], phrases: Phrases, shard_words: int = SHARD_WORDS):
    """For each document: a mask of its words inside phrase occurrences (None if
    there are none) and the numbers of the items that occur."""
    import numpy as np

    found: list[tuple] = [(None, set()) for _ in documents]
    window = phrases.words.shape[1]
    shard: list[tuple[int, int, list[bytes]]] = []

    def search():
        numbers = _Numbers()
        symbols = []
        begins = []
        for _, _, words in shard:
            begins.append(len(symbols))
            symbols += map(numbers.__getitem__, words)
            symbols.append(0)
        table = np.array([numbers.get(w, 0) for w in phrases.vocabulary] + [0], np.int64)
        rows = table[phrases.words]
        usable = np.flatnonzero(((rows > 0) | (phrases.words < 0)).all(1))
        index = FMIndex(np.array(symbols, np.int32))
        low, high = index.search(rows[usable], phrases.lengths[usable])
        times = high - low
        if not times.sum():
            return
        which = np.repeat(usable, times)
        at = index.locate(np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum()))
        edge = np.zeros(len(symbols) + 1, np.int32)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + phrases.lengths[which], -1)
        hit = np.cumsum(edge[:-1]) > 0
        part = np.searchsorted(begins, at, side="right") - 1
        pairs = np.unique(part * len(phrases.lengths) + which)
        for p, w in zip((pairs // len(phrases.lengths)).tolist(), (pairs % len(phrases.lengths)).tolist()):
            found[shard[p][0]][1].update(phrases.owners[w])
        for p in np.unique(part).tolist():
            d, offset, words = shard[p]
            mask = found[d][0]
            if mask is None:
                found[d] = (mask := np.zeros(len(documents[d]), bool), found[d][1])
            mask[offset:offset + len(words)] |= hit[begins[p]:begins[p] + len(words)]

    if len(phrases.lengths):
        held = 0
        for d, words in enumerate(documents):
            for offset in range(0, max(1, len(words)), shard_words):
                part = words[offset:offset + shard_words + window - 1]
                if held and held + len(part) > shard_words:
                    search()
                    shard, held = [], 0
                shard.append((d, offset, part))
                held += len(part) + 1
        if held:
            search()
    return found


def _hits(phrases, text_col: str, name: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        own = phrases.value
        kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                          ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            for lo, hi in by_bytes([t or "" for t in texts], SHARD_CHARS):
                documents = [words_of(t) for t in texts[lo:hi]]
                rows = []
                for words, (mask, items) in zip(documents, find_hits(documents, own)):
                    spans = []
                    if mask is not None:
                        turns = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
                        spans = [{"begin": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()]
                    rows.append({"n_words": len(words), "n_hit": 0 if mask is None else int(mask.sum()),
                                 "items": [own.items[i] for i in sorted(items)], "spans": spans})
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, pa.array(rows, kind)],
                                                 [*batch.schema.names, name])

    return run


def with_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "hits",
              window: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (n_words, n_hit, items with an occurrence,
    removal spans as word ranges), and the column's name (``name``, lengthened
    while ``docs`` has such a column)."""
    spark = docs.sparkSession
    prepare(spark)
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    schema = docs.select("*", F.lit(None).cast(
        "struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<begin:bigint,end:bigint>>>").alias(name)).schema
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    bytes_ = F.sum(F.octet_length("text") + 16)

    def phrases_of(part: DataFrame):
        return spark.sparkContext.broadcast(Phrases([tuple(r) for r in part.collect()], window))

    if (items.agg(bytes_).first()[0] or 0) <= slice_bytes:
        return docs.mapInArrow(lean(_hits(phrases_of(items), text, name)), schema), name
    # equal texts are one owner, named by its digest, so copies fill no slice
    items = items.filter("text is not null").withColumn("owner", F.sha2("text", 256))
    owners = written(spark, items.groupBy("owner").agg(F.first("text").alias("text")), "decontaminate-owners")
    slices = -(-(owners.agg(bytes_).first()[0] or 0) // slice_bytes) or 1
    row = "row_" + name
    numbered = written(spark, docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate-rows")
    texts = numbered.select(row, text)
    one = texts.select("*", F.lit(None).cast(schema[name].dataType).alias(name)).schema
    every = None
    for k in range(slices):
        phrases = phrases_of(owners.filter(F.pmod(F.xxhash64("owner"), F.lit(slices)) == k))
        part = texts.mapInArrow(lean(_hits(phrases, text, name)), one).select(row, name)
        # the first slice has every row, the others those with hits; one slice at a time is held
        part = written(spark, part if k == 0 else part.filter(f"{name}.n_hit > 0"), "decontaminate-part")
        phrases.destroy()
        every = part if every is None else every.unionAll(part)
    merged = every.groupBy(row).agg(
        F.max(f"{name}.n_words").alias("n_words"), F.flatten(F.collect_list(f"{name}.items")).alias("owners"),
        F.array_sort(F.flatten(F.collect_list(f"{name}.spans"))).alias("spans"))
    merged = written(spark, merged.withColumn("spans", F.expr(_MERGE_SPANS)), "decontaminate-merged")
    # an owner lies in one slice, so each item row is met once; lists of structs keep null ids
    ids = merged.select(row, F.explode("owners").alias("owner")).join(items.select("owner", "item_id"), "owner")
    ids = ids.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("item_id"))).alias("ids"))
    found = F.coalesce(F.transform("ids", lambda x: x["item_id"]), F.array().cast("array<string>"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    merged = merged.join(ids, row, "left").select(
        row, F.struct("n_words", n_hit.alias("n_hit"), found.alias("items"), "spans").alias(name))
    return numbered.join(merged, row).drop(row), name


_MERGE_SPANS = """
aggregate(spans, cast(array() as array<struct<begin: bigint, end: bigint>>), (done, s) ->
  if(size(done) > 0 and element_at(done, -1).end >= s.begin,
     concat(slice(done, 1, size(done) - 1), array(named_struct('begin', element_at(done, -1).begin,
            'end', greatest(element_at(done, -1).end, s.end)))),
     concat(done, array(s))))
"""


def contaminated(hits: str):
    return (F.col(f"{hits}.n_hit") > 0) & (20 * F.col(f"{hits}.n_hit") >= F.col(f"{hits}.n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row of hits and verdict per document."""
    rows, hits = with_hits(docs.select("doc_id", "text"), benchmark)
    ids = F.array_sort(F.filter(f"{hits}.items", lambda x: x.isNotNull()))
    return rows.select(
        "doc_id", f"{hits}.n_words", f"{hits}.n_hit", F.size(f"{hits}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), contaminated(hits).alias("contaminated"), f"{hits}.spans")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    rows, hits = with_hits(docs, benchmark)
    return rows.filter(~contaminated(hits)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir), table(spark, sf_dir, "benchmark"))
