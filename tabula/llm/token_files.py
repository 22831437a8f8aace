"""Token-id files with byte-plane shuffling.

``write_token_files`` encodes documents in ascending doc_id order, ends each
with ``end_id`` and writes chunks of whole documents. A chunk's ids are cut
into blocks of ``BLOCK_IDS``; each block is transposed into four byte planes
(lowest byte first) and every plane is compressed on its own with zstandard,
so the near-constant high planes cost almost nothing. The files are Parquet
tables whose row is one chunk:

    part, chunk     place in the order (range partition, running number)
    first, n_ids    ids before the chunk within its part; ids in it
    doc_ids, doc_n  the chunk's documents and their id counts, in order
    frames          index: compressed length of each plane of each block
    body            the frames in a row

so any chunk can be read alone and a reader needs only the index columns to
find a document. Spark's writer commits them, on any store Spark can write.

Cases: a null text is an empty document (its end id alone); null doc_ids come
first; rows of one doc_id are ordered by a hash of their texts, equal ones by the task
that read them; extra columns are ignored; an
empty table gives empty files.
"""

from __future__ import annotations

import uuid
from array import array
from functools import lru_cache
from itertools import chain

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabula.session import scratch_path

from .common import coded_pieces, lean, prepare, segments, stretches, table, text_groups, vocabulary

BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 20
GROUP_CHARS = 12_000_000
ROW_PIECES = 500
SEGMENT_CHARS = 1_000_000
MEMORY_PIECES = 1_200_000
ZSTD_LEVEL = 3
CHUNK_SCHEMA = ("part int, chunk int, first long, n_ids long, doc_ids array<long>, doc_n array<long>, "
                "frames array<int>, body binary")


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2) -> None:
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the text's hash and the task that read the row are part of the range, so that rows of one
    # doc_id can be spread, equal ones too; a repeated task deals its rows as the lost one did
    ordered = (rows.withColumn("salt", F.xxhash64("text")).withColumn("source", F.spark_partition_id())
               .repartitionByRange("doc_id", "salt", "source")
               .sortWithinPartitions("doc_id", "salt", "source", "text").select("doc_id", "text"))
    chunks = ordered.mapInArrow(lean(_packer(vocabulary(tokenizer_path), end_id)), CHUNK_SCHEMA)
    chunks.write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document in the files
    (``ids`` too, as an array, if asked for). Starts come from the index: the
    parts' totals, one row per part, are summed up and joined to the chunks."""
    prepare(spark)
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = (chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(before, F.lit(0)).alias("base")))
    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    read = chunks.mapInArrow(lean(_unpacker(with_ids)), schema)
    cols = ["doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"]
    return read.join(bases, "part").select(*cols, *(["ids"] if with_ids else []))


def encode_block(ids, level: int = ZSTD_LEVEL) -> list[bytes]:
    """Four compressed byte planes of a block of unsigned 32-bit ids."""
    import numpy as np
    import zstandard

    planes = np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 4).T)
    pack = zstandard.ZstdCompressor(level=level)
    return [pack.compress(p.tobytes()) for p in planes]


def decode_block(frames: list[bytes], n: int):
    import numpy as np
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    planes = np.empty((4, n), np.uint8)
    for i, f in enumerate(frames):
        planes[i] = np.frombuffer(unpack.decompress(f, max_output_size=max(n, 1)), np.uint8)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


class _Encoder:
    """Ids of texts by way of their distinct pieces, with a bounded memory of
    pieces met: their spellings as an Arrow array, their ids in a row."""

    def __init__(self, model: bytes):
        import json

        import numpy as np
        import pyarrow as pa
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(model.decode())
        self.tok.no_truncation()
        self.tok.no_padding()
        self.known, self.flat = pa.array([], pa.large_string()), np.empty(0, "<u4")
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        # a byte-level token is spelled with one character a byte, an added token as it is
        bytes_of = {i: len(t) for t, i in self.tok.get_vocab().items()}
        bytes_of.update({a["id"]: len(a["content"].encode()) for a in json.loads(model).get("added_tokens", [])})
        self.bytes_of = np.zeros(max(bytes_of) + 1, np.int64)
        self.bytes_of[list(bytes_of)] = list(bytes_of.values())

    def _encode(self, texts: list[str]):
        """Ids of all texts in a row, and how many each has."""
        import numpy as np

        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), "<u4", int(size.sum())), size

    def _new(self, words):
        """The library's ids of an Arrow array of pieces, in a row, and how many
        each has. Pieces are encoded many in a row and the ids cut at the pieces'
        last bytes; if one begins without a blank or ends with one, or a cut does
        not fall between two ids, each is encoded alone."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        safe = pc.match_substring_regex(words, r"^ (?s:.)*[^\s]$").to_numpy(zero_copy_only=False).astype(bool)
        safe &= pc.equal(words, pc.utf8_rtrim_whitespace(words)).to_numpy(zero_copy_only=False)
        in_row = words.filter(pa.array(safe))
        begins = [*range(0, len(in_row), ROW_PIECES), len(in_row)]
        rows = pc.binary_join(pa.ListArray.from_arrays(pa.array(begins, pa.int32()), in_row.cast(pa.string())), "").to_pylist()
        ids, _ = self._encode(rows)
        ends = np.cumsum(self.bytes_of[ids])
        stops = np.cumsum(pc.binary_length(in_row).to_numpy().astype(np.int64))
        cuts = np.searchsorted(ends, stops)
        if len(in_row) and not (cuts[-1] < len(ids) and (ends[cuts] == stops).all()):
            return self._encode(words.to_pylist())
        others, other_size = self._encode(words.filter(pa.array(~safe)).to_pylist())
        size = np.empty(len(words), np.int64)
        size[safe], size[~safe] = np.diff(cuts + 1, prepend=0), other_size
        flat = np.empty(len(ids) + len(others), "<u4")
        own = np.repeat(safe, size)
        flat[own], flat[~own] = ids, others
        return flat, size

    def _known(self, words):
        """Flat ids and, for each word of an Arrow array of distinct words, its
        start and size among them."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        at = pc.index_in(words, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = at < 0
        fresh = words.filter(pa.array(new))
        flat, fresh_size = self._new(fresh)
        fresh_start = np.cumsum(fresh_size) - fresh_size + len(self.flat)
        start, size = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        start[new], size[new] = fresh_start, fresh_size
        start[~new], size[~new] = self.start[at[~new]], self.size[at[~new]]
        every = np.concatenate([self.flat, flat])
        if (room := min(len(fresh), MEMORY_PIECES - len(self.known))) > 0:
            # made first and set together: the memory outlives the task
            self.known, self.start, self.size, self.flat = (
                pa.concat_arrays([self.known, fresh.slice(0, room)]),
                np.concatenate([self.start, fresh_start[:room]]),
                np.concatenate([self.size, fresh_size[:room]]),
                every[:fresh_start[room - 1] + fresh_size[room - 1]].copy())
        return every, start, size

    def _ids(self, spelled):
        """The same for pieces. Stops and commas after a letter or digit are
        pre-tokens of their own, so a piece is looked up without them."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        cut = pc.extract_regex(spelled, r"(?P<stem>^(?s:.)*[\p{L}\p{N}])(?P<tail>[.,]+)$")
        ends = pc.is_valid(cut).to_numpy(zero_copy_only=False).astype(bool)
        stems = pc.coalesce(pc.struct_field(cut, "stem"), spelled)
        tails = pc.struct_field(cut, "tail").filter(pa.array(ends))
        parts = pa.concat_arrays([stems.cast(pa.large_string()), tails.cast(pa.large_string())]).dictionary_encode()
        flat, start, size = self._known(parts.dictionary)
        code = parts.indices.to_numpy().astype(np.int64)
        # stem and tail of each piece in turn
        turns = np.insert(code[:len(spelled)], np.flatnonzero(ends) + 1, code[len(spelled):])
        piece = np.repeat(np.arange(len(spelled)), 1 + ends)
        size_of = np.bincount(piece, weights=size[turns], minlength=len(spelled)).astype(np.int64)
        return stretches(flat, start, size, turns), np.cumsum(size_of) - size_of, size_of

    def encode(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        parts = [list(segments(t, SEGMENT_CHARS)) for t in texts]
        spelled, codes = coded_pieces([s for p in parts for s in p])
        flat, start, size = self._ids(spelled)
        code = np.concatenate(codes)
        # ids of all texts at once, cut where the texts end
        n_pieces = np.zeros(len(texts) + 1, np.int64)
        n_pieces[1:] = np.cumsum(np.add.reduceat(list(map(len, codes)), np.cumsum([0, *map(len, parts[:-1])])))
        ends = np.concatenate([[0], np.cumsum(size[code])])[n_pieces] * 4
        raw = memoryview(stretches(flat, start, size, code).tobytes())
        return [bytes(raw[a:b]) for a, b in zip(ends[:-1], ends[1:])]


@lru_cache(maxsize=1)
def _encoder(model: bytes) -> _Encoder:
    """One encoder a Python worker, so that the tasks it runs after one another
    share its memory of pieces; which ones it holds changes no result."""
    return _Encoder(model)


def _packer(model: bytes, end_id: int):
    def pack(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, enc, end = TaskContext.get().partitionId(), _encoder(model), array("I", [end_id]).tobytes()
        chunk = first = 0
        docs, held, n = [], [], 0

        def row():
            ids = np.frombuffer(b"".join(held), "<u4")
            frames = [f for i in range(0, len(ids), BLOCK_IDS) for f in encode_block(ids[i:i + BLOCK_IDS])]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([n], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                 pa.array([[len(h) // 4 for h in held]], pa.list_(pa.int64())),
                 pa.array([[len(f) for f in frames]], pa.list_(pa.int32())), pa.array([b"".join(frames)], pa.binary())],
                ["part", "chunk", "first", "n_ids", "doc_ids", "doc_n", "frames", "body"])

        for keys, texts in text_groups(batches, GROUP_CHARS):
            for key, ids in zip(keys, enc.encode(texts)):
                docs.append(key)
                held.append(ids + end)
                n += len(ids) // 4 + 1
                if n >= CHUNK_IDS:
                    yield row()
                    chunk, first, docs, held, n = chunk + 1, first + n, [], [], 0
        if docs:
            yield row()

    return pack


def _unpacker(with_ids: bool):
    def unpack(batches):
        from zlib import crc32

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for r in range(batch.num_rows):
                part, first, n_ids, docs, lens, frames, body = (
                    batch.column(c)[r].as_py() for c in ("part", "first", "n_ids", "doc_ids", "doc_n", "frames", "body"))
                at, blocks = 0, []
                for b in range(0, len(frames), 4):
                    planes = []
                    for size in frames[b:b + 4]:
                        planes.append(body[at:at + size])
                        at += size
                    blocks.append(decode_block(planes, min(BLOCK_IDS, n_ids - b // 4 * BLOCK_IDS)))
                ids = np.concatenate(blocks)
                ends = np.cumsum(lens)
                starts = ends - lens
                raw = memoryview(ids.astype("<u4", copy=False).tobytes())
                cols = [pa.array([part] * len(docs), pa.int32()), pa.array(docs, pa.int64()),
                        pa.array(starts + first, pa.int64()), pa.array(lens, pa.int64()),
                        pa.array([crc32(raw[4 * a:4 * b]) for a, b in zip(starts, ends)], pa.int64())]
                names = ["part", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([ids[a:b].tolist() for a, b in zip(starts, ends)], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return unpack


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm", f"token-files-{uuid.uuid4().hex}")
    write_token_files(table(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, path)
