"""Byte-level BPE encoding and decoding over a global distinct-word shuffle.

Encoding goes in three steps, none of which holds more than one block of
documents or one share of the words:

1. Documents are read in blocks of about ``BLOCK_CHARS``. In each block every
   text is exploded into words (white-space-led pieces made of whole pre-token
   matches) by position; a word is replaced by its number in the block's own
   dictionary. This pre-aggregates the word occurrences before any shuffle, so
   the commonest word costs one entry per block.
2. The blocks' dictionaries are shuffled by word: all entries of a word meet
   in one task, which encodes it once. Each entry's ids go back to its block.
3. The blocks' positions and the ids meet by block, and every document is
   reassembled by position.

The positions are not stored in between: the second reading of the documents
makes them again, which costs less than moving them twice. A block's name
holds a digest of its contents, so if the input gave its rows in another order
the second time, the blocks would not meet and the job fails with an error.
Input that isn't a plain table read should be written first.

Decoding joins each id with the token-byte table (one entry per rank, a size
fixed by the vocabulary file) and concatenates.

Cases: a null text is an empty document (no ids, digests of no bytes); null
and repeated doc_ids, and repeated rows, are encoded row by row; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import coded_pieces, lean, prepare, release_memory, segments, stretches, table, text_groups, vocabulary

BLOCK_CHARS = 10_000_000
SEGMENT_CHARS = 1_000_000
MEMORY_WORDS = 600_000
MAX_BUCKETS = 4096
BLOCK_SCHEMA = "block string, bucket int, body binary, doc_ids array<long>, doc_n array<int>"


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, data.splitlines())}


def encode(docs: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN, then=None,
           schema: str = "doc_id long, ids binary") -> DataFrame:
    """``doc_id, ids`` (ids as little-endian unsigned 32-bit integers in a
    binary) for each row of ``docs``; or what ``then`` makes of an Arrow table of
    these, in the task that reassembled them, with the columns of ``schema``."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = max(16, min(MAX_BUCKETS, 2 * rows.rdd.getNumPartitions()))
    words = rows.mapInArrow(lean(_blocks(buckets, words=True)), BLOCK_SCHEMA)
    known = words.repartition("bucket").mapInArrow(lean(_encode_words(vocabulary(ranks_path), pattern)), BLOCK_SCHEMA)
    positions = rows.mapInArrow(lean(_blocks(buckets, words=False)), BLOCK_SCHEMA)
    return positions.unionAll(known).groupBy("block").applyInArrow(_finish(then), schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The columns of ``encoded`` (one of them ``ids``, as ``encode`` gives
    them) and ``decoded``, the bytes that the ids stand for."""
    prepare(encoded.sparkSession)
    schema = encoded.select("*", F.lit(b"").alias("decoded")).schema
    return encoded.mapInArrow(lean(_decode(vocabulary(ranks_path))), schema)


def _pack(lens, body: bytes) -> bytes:
    """Lengths as byte planes, then the bytes, in one compressed frame."""
    import numpy as np
    import zstandard

    planes = np.ascontiguousarray(lens, "<u4").view("u1").reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(len(lens).to_bytes(8, "little") + planes + body)


def _unpack(blob: bytes):
    """Lengths and the bytes in a row."""
    import numpy as np
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:8], "little")
    lens = np.ascontiguousarray(np.frombuffer(raw, "u1", 4 * n, 8).reshape(4, n).T).view("<u4").reshape(-1)
    return lens.astype(np.int64), raw[8 + 4 * n:]


def _blocks(buckets: int, words: bool):
    def run(batches):
        import hashlib
        from zlib import crc32

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0

        def rows(keys, texts):
            digest = hashlib.blake2b(digest_size=12)
            for key, text in zip(keys, texts):
                digest.update(f"{key}:{len(text)}:".encode())
                digest.update(text.encode())
            name = f"{part}:{number}:{digest.hexdigest()}"
            parts = [list(segments(t, SEGMENT_CHARS)) for t in texts]
            spelled, codes = coded_pieces([s for p in parts for s in p])
            spelled = spelled.cast(pa.large_binary())
            bucket = np.fromiter((crc32(w) % buckets for w in spelled.to_pylist()), np.uint16, len(spelled))
            if not words:
                size = np.fromiter(map(len, codes), np.int64, len(codes))
                firsts = np.cumsum([0, *map(len, parts)])[:-1]
                counts = np.add.reduceat(size, firsts) if len(firsts) else size
                body = np.concatenate(codes).astype("<u4").view("u1").reshape(-1, 4).T.tobytes()
                yield name, None, _pack(bucket, body), list(keys), counts.tolist()
                return
            order = np.argsort(bucket, kind="stable")
            ordered, of = spelled.take(pa.array(order)), bucket[order]
            lens = pc.binary_length(ordered).to_numpy()
            ends = np.cumsum(lens)
            body = b"".join(ordered.to_pylist())
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    yield name, int(of[a]), _pack(lens[a:b], body[ends[a] - lens[a]:ends[b - 1]]), None, None

        def batch_of(keys, texts):
            cols = zip(*rows(keys, texts))
            kinds = [pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              ["block", "bucket", "body", "doc_ids", "doc_n"])

        for keys, texts in text_groups(batches, BLOCK_CHARS):
            if not words or any(texts):
                yield batch_of(keys, texts)
            number += 1

    return run


def _encode_words(ranks: bytes, pattern: str):
    def run(batches):
        from array import array

        import numpy as np
        import pyarrow as pa
        import tiktoken

        enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})
        known: dict[bytes, bytes] = {}

        def ids_of(word: bytes) -> bytes:
            ids = known.get(word)
            if ids is None:
                ids = array("I", enc.encode_ordinary(word.decode())).tobytes()
                if len(known) < MEMORY_WORDS:
                    known[word] = ids
            return ids

        for batch in batches:
            bodies = []
            for blob in batch.column("body"):
                lens, body = _unpack(blob.as_py())
                ends = np.cumsum(lens)
                ids = [ids_of(body[a:b]) for a, b in zip((ends - lens).tolist(), ends.tolist())]
                bodies.append(_pack(np.fromiter(map(len, ids), "<u4", len(ids)), b"".join(ids)))
            i = batch.schema.get_field_index("body")
            yield batch.set_column(i, pa.field("body", pa.binary()), pa.array(bodies, pa.binary()))

    return run


def _reassemble(block):
    import numpy as np
    import pyarrow as pa

    bucket = block.column("bucket").to_pylist()
    bodies = block.column("body")
    if None not in bucket:
        raise RuntimeError("words of a block that the second reading did not give: the input's rows changed order")
    at = bucket.index(None)
    of, codes = _unpack(bodies[at].as_py())
    codes = np.ascontiguousarray(np.frombuffer(codes, "u1").reshape(4, len(codes) // 4).T).view("<u4").reshape(-1)
    start, size = np.zeros(len(of), np.int64), np.full(len(of), -1)
    flat, total = [], 0
    for k, b in enumerate(bucket):
        if b is not None:
            lens, ids = _unpack(bodies[k].as_py())
            mine = np.flatnonzero(of == b)
            if len(mine) != len(lens):
                size[:] = -1
                break
            size[mine] = lens // 4
            start[mine] = total + np.cumsum(lens // 4) - lens // 4
            flat.append(ids)
            total += len(ids) // 4
    if (size < 0).any() and len(codes):
        raise RuntimeError("a block whose words are missing: the input's rows changed order between two readings")
    flat = np.frombuffer(b"".join(flat), "<u4")
    ends = np.cumsum(block.column("doc_n")[at].as_py(), dtype=np.int64)
    out = [stretches(flat, start, size, codes[a:b]).tobytes() for a, b in zip([0, *ends.tolist()], ends.tolist())]
    return pa.table({"doc_id": pa.array(block.column("doc_ids")[at].as_py(), pa.int64()), "ids": pa.array(out, pa.binary())})


def _finish(then):
    def run(block):
        table = _reassemble(block)
        try:
            return table if then is None else then(table)
        finally:
            release_memory()

    return run


class Decoder:
    """Bytes of ids by the token-byte table, which is built once per task."""

    def __init__(self, ranks: bytes):
        self.ranks, self.table = ranks, None

    def __call__(self, ids: bytes | None) -> bytes | None:
        import numpy as np

        if self.table is None:
            spelled = sorted((rank, tok) for tok, rank in read_ranks(self.ranks).items())
            size = np.zeros(spelled[-1][0] + 1, np.int64)
            size[[rank for rank, _ in spelled]] = [len(tok) for _, tok in spelled]
            self.table = np.frombuffer(b"".join(tok for _, tok in spelled), "u1"), np.cumsum(size) - size, size
        return None if ids is None else stretches(*self.table, np.frombuffer(ids, "<u4")).tobytes()


def _decode(ranks: bytes):
    def run(batches):
        import pyarrow as pa

        decode_one = Decoder(ranks)
        for batch in batches:
            out = [decode_one(v.as_py()) for v in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    return run


def _digested(ranks: bytes):
    decode_one = Decoder(ranks)

    def run(encoded):
        from hashlib import sha256

        import pyarrow as pa

        rows = [(len(ids) // 4, sha256(ids).hexdigest(), sha256(decode_one(ids)).hexdigest())
                for ids in (v.as_py() for v in encoded.column("ids"))]
        n, first, second = zip(*rows)
        return pa.table({"doc_id": encoded.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                         "ids_sha256": pa.array(first), "decoded_sha256": pa.array(second)})

    return run


def digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Encode, decode, and return ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return encode(docs, ranks_path, then=_digested(vocabulary(ranks_path)),
                  schema="doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
