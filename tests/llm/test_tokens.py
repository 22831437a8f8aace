"""Operators 1, 8 and 9 against the tokenizer libraries."""

import base64
import collections
import hashlib
import zlib
from array import array

import public_tokenizers as P
import pytest
import tiktoken
from helpers import SF, awkward_docs, awkward_texts, by_row, empty_docs, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabula.llm import bpe, common, token_counts, token_files

MULTI = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def multi():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return awkward_docs(spark, tmp_path_factory.mktemp("tokens")).cache()


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_pieces_cut_only_between_pre_tokens(multi):
    for t in awkward_texts():
        t = (t or "")[:20_000]
        cut = common.pieces(t)
        assert "".join(cut) == t and all(cut)
        assert [i for p in cut for i in multi.encode_ordinary(p)] == multi.encode_ordinary(t)
        assert "".join(common.segments(t, 50)) == t
        assert [i for s in common.segments(t, 50) for i in multi.encode_ordinary(s)] == multi.encode_ordinary(t)


def test_bpe_round_trip(spark, docs, multi):
    want = collections.Counter()
    for r in docs.collect():
        ids = multi.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), sha(array("I", ids).tobytes()), sha((r.text or "").encode())] += 1
    assert by_row(bpe.digests(docs, MULTI), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_bpe_blocks_of_any_size(spark, docs, multi, monkeypatch):
    """Many small blocks, buckets and segments give the same ids."""
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 3000)
    few = docs.filter("doc_id < 60 and length(text) < 5000").select("doc_id", "text")
    got = {(r.doc_id, bytes(r.ids)) for r in bpe.encode(few, MULTI).collect()}
    assert got == {(r.doc_id, array("I", multi.encode_ordinary(r.text)).tobytes()) for r in few.collect()}


def test_bpe_rows_that_change_order_fail_loudly():
    import pyarrow as pa

    table = pa.table({"block": ["b"], "bucket": pa.array([1], pa.int32()), "body": [b""], "doc_ids": pa.array([None], pa.list_(pa.int64())),
                      "doc_n": pa.array([None], pa.list_(pa.int32()))})
    with pytest.raises(RuntimeError, match="changed order"):
        bpe._reassemble(table)


def test_token_counts(docs):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = collections.Counter()
    for r in docs.collect():
        n = len(tok.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id, len((r.text or "").encode()), n, n > 2048] += 1
    got = token_counts.token_counts(docs, P.path("word_bpe_49k.json"))
    assert by_row(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_token_counts_of_a_tokenizer_that_keeps_blanks(spark, docs):
    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    assert token_counts.drops_blanks(Tokenizer.from_file(P.path("word_bpe_49k.json"))) and not token_counts.drops_blanks(tok)
    given = docs.unionByName(spark.createDataFrame([(-1, "two  blanks\n\nand lines", 0)], "doc_id long, text string, n_tokens int"),
                             allowMissingColumns=True)
    want = collections.Counter((r.doc_id, len(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in given.collect())
    assert by_row(token_counts.token_counts(given, path), "doc_id", "n_tokens") == want


def test_batches_are_balanced_by_size():
    assert list(common.by_size([5, 5, 5, 30, 1, 0, 0], 10)) == [(0, 2), (2, 3), (3, 4), (4, 7)]
    assert list(common.by_size([], 10)) == [] and list(common.by_size([0, 0], 10)) == [(0, 2)]


def test_long_texts_split_at_spaces(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SEGMENT_CHARS", 100)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 1000)
    monkeypatch.setattr(token_counts, "MEMORY_WORDS", 50)
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = [r["text"] for r in rows("documents")[:30]]
    known, lengths = {"": 0}, lambda ws: {w: len(tok.encode(w, add_special_tokens=False).ids) for w in ws}
    assert token_counts._count_group(texts, known, lengths) == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert len(known) <= 50


def test_counts_and_ids_stay_the_same_from_task_to_task():
    counted, coded = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
    texts = [t or "" for t in awkward_texts()]
    lengths, enc = (make(open(p, "rb").read()) for make, p in ((token_counts._Lengths, counted), (token_files._Encoder, coded)))
    a, b = Tokenizer.from_file(counted), Tokenizer.from_file(coded)
    for part in (texts[::2], texts, texts[1::2], texts, [""]):  # one worker's tasks
        assert lengths.of(part) == [len(a.encode(t, add_special_tokens=False).ids) for t in part]
        assert enc.encode(part) == [array("I", b.encode(t, add_special_tokens=False).ids).tobytes() for t in part]


def test_token_files(spark, docs, tmp_path, monkeypatch):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, path, P.path("byte_bpe_50k.json"), end_id=2)
    got = token_files.read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    start, seen = 0, collections.Counter()
    for r in got:
        assert (r.start, r.n_tokens) == (start, len(r.ids)) and r.ids[-1] == 2
        assert r.ids_crc32 == zlib.crc32(array("I", r.ids).tobytes())
        start += r.n_tokens
        seen[r.doc_id, tuple(r.ids[:-1])] += 1
    assert seen == collections.Counter((r.doc_id, tuple(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_equal_rows_are_spread_over_parts(spark, tmp_path):
    path = str(tmp_path / "equal")
    spark.createDataFrame([(None, None)] * 4000 + [(k, "a b") for k in range(50)], "doc_id long, text string").repartition(16).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts stay apart
    try:
        token_files.write_token_files(spark.read.parquet(path), str(tmp_path / "files"), P.path("byte_bpe_50k.json"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    chunks = spark.read.parquet(str(tmp_path / "files"))
    assert chunks.filter("doc_ids[0] is null").select("part").distinct().count() > 1
    got = [(r.start, r.doc_id) for r in token_files.read_token_files(spark, str(tmp_path / "files")).orderBy("start").collect()]
    assert got[:4000] == [(k, None) for k in range(4000)] and [d for _, d in got[4000:]] == list(range(50))


def test_byte_planes_round_trip():
    import numpy as np

    for n in (0, 1, 7, 70_000):
        ids = np.random.default_rng(n).integers(0, 1 << 32, n, np.uint32)
        assert (token_files.decode_block(token_files.encode_block(ids), n) == ids).all()


def test_small_memory_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(token_files, "MEMORY_PIECES", 20)
    monkeypatch.setattr(token_files, "SEGMENT_CHARS", 60)
    model = open(P.path("byte_bpe_50k.json"), "rb").read()
    tok, enc = Tokenizer.from_str(model.decode()), token_files._Encoder(model)
    texts = [(t or "")[:5000] for t in awkward_texts()] + ["a, b. 1., x.,. ,. .. é,\n it's, 3.14. \u0301, <|endoftext|>."]
    assert enc.encode(texts) == [array("I", tok.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert len(enc.known) == 20


def test_empty_tables(spark, tmp_path):
    assert bpe.digests(empty_docs(spark), MULTI).count() == 0
    assert token_counts.token_counts(empty_docs(spark), P.path("word_bpe_49k.json")).count() == 0
    token_files.write_token_files(empty_docs(spark), str(tmp_path / "f"), P.path("byte_bpe_50k.json"))
    assert token_files.read_token_files(spark, str(tmp_path / "f")).count() == 0


def test_registered_queries(spark, multi):
    from tabula.llm.registry import QUERIES

    table = {r["doc_id"]: r["text"] for r in rows("documents")}
    got = {r.doc_id: r.n_tokens for r in QUERIES["op1_bpe"](spark, SF).collect()}
    assert got == {d: len(multi.encode_ordinary(t)) for d, t in table.items()}
    files = QUERIES["op9_token_files"](spark, SF)
    total, last = files.agg(F.sum("n_tokens"), F.max(F.col("start") + F.col("n_tokens"))).first()
    assert total == last and files.count() == len(table)
