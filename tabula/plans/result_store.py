"""A store of results by content key that costs what is asked of it.

Results lie in parts, one for each append, and inside a part by key prefix
(``prefix=ab``), so a lookup reads only the prefixes it touches. Beside each
part lies a Bloom filter of its keys: per prefix, bitmaps of 32,768 bits made by
``bitmap_construct_agg``. A lookup tests the filters first (a few bytes a key)
and joins only keys that may be stored with the stored keys themselves, which
makes the answer exact.

Parts are announced one by one (see ``tabula.sources.versions``); a compaction
writes one part with one result per key, which takes the place of the parts it
names, so appends that run meanwhile are not lost. A part that was replaced is
not read any more; ``vacuum`` removes it later.

Cases: a null key is never stored and always pending; a key that is stored
twice has the result of the first part; an empty store has nothing; extra
columns of the looked-up rows stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.sources import versions as vs

HASHES = 4
BITMAP_BITS = 32_768
BITS_A_KEY = 10
#: Filters up to this size are broadcast to a lookup's keys; beyond it they are shuffled.
BROADCAST_BYTES = 32 << 20


class ResultStore:
    """Results under ``root``: a hexadecimal ``key`` column of 40 digits or more
    (as ``memo_key`` gives) and the columns of ``schema``. Keys have 16 to the
    power ``prefix_chars`` prefixes, each written by ``files`` tasks; a store keeps
    the prefixes it was made with."""

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str = "memo_key", prefix_chars: int = 2, files: int = 1):
        if not 1 <= prefix_chars <= 4 or files < 1:
            raise ValueError("prefix_chars from 1 to 4, files at least 1")
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.prefix_chars, self.files = prefix_chars, files
        self.schema = spark.createDataFrame([], schema).schema
        if key not in self.schema.names:
            raise ValueError(f"no key column {key!r} in the schema")

    # ------------------------------------------------------------ parts

    def parts(self) -> list[str]:
        """The parts that count: the newest compacted one and all appended that it doesn't replace."""
        found = vs.versions(self.spark, self.root)
        replaced: set[str] = set()
        for v in found:
            replaced |= set(vs.facts(self.spark, self.root, v).get("replaces", []))
        return [v for v in found if v not in replaced]

    def _read(self, kind: str, schema: str, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{kind}/part={v}" for v in parts]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(*paths)

    def _rows(self, parts: list[str]) -> DataFrame:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        return self._read("data", f"{fields}, part string, prefix string", parts)

    def _filters(self, parts: list[str]) -> DataFrame:
        return self._read("filter", "n_buckets int, bucket int, bits binary, part string, prefix string", parts)

    # ------------------------------------------------------------ writing

    def append(self, results: DataFrame) -> str:
        """Store ``results`` (rows without a key are left out) as one more part."""
        return self._write(results.select(*[F.col(f"`{c}`") for c in self.schema.names]), 4)

    def _write(self, rows: DataFrame, buckets: int, replaces: list[str] | None = None) -> str:
        version = vs.new_version()
        data, bits = (f"{self.root}/{kind}/part={version}" for kind in ("data", "filter"))
        keyed = rows.filter(F.col(self.key).isNotNull()).withColumn("prefix", self._prefix())
        dealt = keyed.repartition("prefix", F.pmod(F.xxhash64(self.key), F.lit(self.files)))
        dealt.sortWithinPartitions("prefix").write.partitionBy("prefix").parquet(data)
        keys = self._rows_at(data).select(self.key, "prefix").distinct()
        places = keys.select("prefix", F.explode(F.array(*[self._place(i, buckets) for i in range(HASHES)])).alias("place"))
        maps = places.groupBy("prefix", F.floor(F.col("place") / BITMAP_BITS).cast("int").alias("bucket")).agg(
            F.bitmap_construct_agg(F.col("place") % BITMAP_BITS).alias("bits"))
        maps.withColumn("n_buckets", F.lit(buckets)).repartition("prefix").write.partitionBy("prefix").parquet(bits)
        vs.announce(self.spark, self.root, version, replaces=replaces or [])
        return version

    def _rows_at(self, path: str) -> DataFrame:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        return self.spark.read.schema(f"{fields}, prefix string").parquet(path)

    def compact(self) -> str | None:
        """One part with one result per key in place of all parts there are now."""
        parts = self.parts()
        if not parts:
            return None
        rest = [F.col(f"`{c}`") for c in self.schema.names if c != self.key]
        one = self._rows(parts).groupBy(self.key).agg(F.min_by(F.struct(*rest), "part").alias("r"))
        one = one.select(self.key, "r.*") if rest else one.select(self.key)
        n = one.count()
        buckets = max(1, -(-BITS_A_KEY * n // (16 ** self.prefix_chars * BITMAP_BITS)))
        return self._write(one.select(*[F.col(f"`{c}`") for c in self.schema.names]), buckets, parts)

    def vacuum(self, grace_s: float = 86_400) -> list[str]:
        """Remove replaced parts once they are older than ``grace_s``, the oldest
        first: what a compacted part replaced goes before that part's entry does."""
        current, gone = set(self.parts()), []
        for v in vs.versions(self.spark, self.root):
            if v in current or vs.age_s(v) < grace_s:
                continue
            for path in (f"{self.root}/manifest/{v}", f"{self.root}/data/part={v}", f"{self.root}/filter/part={v}"):
                vs.remove(self.spark, path)
            gone.append(v)
        return gone

    # ------------------------------------------------------------ reading

    def _prefix(self) -> Column:
        return F.substring(self.key, 1, self.prefix_chars)

    def _place(self, i: int, buckets: int | Column) -> Column:
        """Bit of the key's hash ``i`` among the prefix's bits: 32 bits of the key itself."""
        digits = F.conv(F.substring(self.key, 1 + self.prefix_chars + 8 * i, 8), 16, 10).cast("long")
        return F.pmod(digits, F.lit(buckets) * F.lit(BITMAP_BITS) if isinstance(buckets, int) else buckets * BITMAP_BITS)

    def results(self, prefixes: list[str] | None = None) -> DataFrame:
        """One result per key, of the given prefixes only if there are some."""
        rows = self._rows(self.parts())
        if prefixes is not None:
            rows = rows.filter(F.col("prefix").isin(prefixes))
        rest = [F.col(f"`{c}`") for c in self.schema.names if c != self.key]
        one = rows.groupBy(self.key).agg(F.min_by(F.struct(*rest), "part").alias("r"))
        return one.select(self.key, "r.*").select(*[F.col(f"`{c}`") for c in self.schema.names])

    def touched(self, keys: DataFrame) -> list[str]:
        """The prefixes of ``keys``: 256 at most with two characters."""
        return sorted(r[0] for r in keys.select(self._prefix()).distinct().collect() if r[0] is not None)

    def maybe(self, keys: DataFrame, parts: list[str] | None = None, prefixes: list[str] | None = None) -> DataFrame:
        """The distinct ``keys`` that the filters don't rule out (prefix, key)."""
        parts = self.parts() if parts is None else parts
        prefixes = self.touched(keys) if prefixes is None else prefixes
        keys = keys.select(self.key).filter(F.col(self.key).isNotNull()).distinct().withColumn("prefix", self._prefix())
        filters = self._filters(parts).filter(F.col("prefix").isin(prefixes)).groupBy("prefix", "n_buckets", "bucket").agg(
            F.bitmap_or_agg("bits").alias("bits"))
        # a handful of filter sizes: that of appends and those of compactions
        facts = filters.groupBy("n_buckets").agg(F.count("*").alias("n")).collect()
        if not facts:
            return keys.limit(0).select("prefix", self.key)
        if sum(r["n"] for r in facts) * (BITMAP_BITS // 8) <= BROADCAST_BYTES:
            filters = F.broadcast(filters)
        asked = F.array(*[F.struct(F.lit(r["n_buckets"]).alias("n_buckets"), self._place(i, r["n_buckets"]).alias("place"))
                          for r in facts for i in range(HASHES)])
        bit = F.col("place") % BITMAP_BITS
        byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_set = F.expr("shiftright(byte, shift) & 1") == 1
        at = keys.select("prefix", self.key, F.explode(asked).alias("a")).select("prefix", self.key, "a.*").withColumn(
            "bucket", F.floor(F.col("place") / BITMAP_BITS).cast("int"))
        hit = at.join(filters, ["prefix", "n_buckets", "bucket"]).select(
            "prefix", self.key, "n_buckets", byte.alias("byte"), (bit % 8).cast("int").alias("shift")).filter(is_set)
        return (hit.groupBy("prefix", self.key, "n_buckets").agg(F.count("*").alias("n")).filter(F.col("n") == HASHES)
                .select("prefix", self.key).distinct())

    def stored(self, keys: DataFrame) -> DataFrame:
        """The distinct ``keys`` that have a result: the filters first, then the keys
        themselves, of touched prefixes only."""
        parts, prefixes = self.parts(), self.touched(keys)
        held = self._rows(parts).filter(F.col("prefix").isin(prefixes)).select("prefix", self.key)
        return self.maybe(keys, parts, prefixes).join(held, ["prefix", self.key], "left_semi").select(self.key)

    def pending(self, keyed: DataFrame) -> DataFrame:
        """Rows of ``keyed`` whose key has no result."""
        return keyed.join(self.stored(keyed), self.key, "left_anti")
