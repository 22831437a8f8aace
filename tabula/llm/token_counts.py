"""Token counts: batch encoding in an Arrow function that returns lengths only.

Rows are regrouped into batches of about ``BATCH_BYTES`` bytes, so one batch
of long texts costs what one batch of short texts does. Where a tokenizer drops
blanks, a text is split at them, so the parts' counts add up to the text's;
very long texts are split into bounded segments first. Words are encoded in
batches, with a bounded memory of the words met that a Python worker keeps from
task to task. Each worker first tries the tokenizer on strings with blanks between
them (``drops_blanks``); where it doesn't drop them, whole texts are encoded.

Cases: a null text counts as empty (0 bytes, 0 tokens); rows with a null or
repeated doc_id are counted on their own; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_size, lean, prepare, segments, table, vocabulary

BATCH_BYTES = 4_000_000
SEGMENT_CHARS = 1_000_000
MEMORY_WORDS = 500_000
WORDS_A_CALL = 20_000
TOKEN_LIMIT = 2048
#: Strings of many kinds that ``drops_blanks`` puts together.
PROBES = ("", "a", "Zed", "don't", "'s", "7", "42", "1,000.50", ".", "...", "(x)", "#$%", "-", "_", "<", "\u2581", "http://a.b/c?d=e",
          "\u00e9t\u00e9", "e\u0301", "\u0301", "\u00df", "\u0434\u043e\u043c", "\u0645\u0631\u062d", "\u0915\u094d\u0937", "\u4f60\u597d",
          "\uff46\uff55", "\u1100\u1161", "\U0001f642", "\u200d", "\u00a0", "\t", "\r", "\u0000")
#: The blanks that texts are split at, alone and in runs.
GAPS = (" ", "\n", "  ", " \n ")


def token_counts(docs: DataFrame, tokenizer_path: str, token_limit: int = TOKEN_LIMIT,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for each row of ``docs``, by any
    tokenizer file of the library."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(lean(_counter(vocabulary(tokenizer_path))), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > token_limit)


def drops_blanks(tok) -> bool:
    """Whether the tokenizer's ids of strings with blanks between, before or after
    them are the strings' own ids in a row, for every pair of ``PROBES`` and each
    added token beside some, and no added token holds white space."""
    def ids(texts):
        return [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    added = [t.content for t in tok.get_added_tokens_decoder().values()]
    if any(c.isspace() for t in added for c in t):
        return False
    pairs = [*product(PROBES, PROBES), *product(added, PROBES[:3]), *product(PROBES[:3], added)]
    alone = {s: i for s, i in zip((*PROBES, *added), ids([*PROBES, *added]))}
    joined = [x + gap + y for x, y in pairs for gap in GAPS]
    return ids(joined) == [alone[x] + alone[y] for x, y in pairs for _ in GAPS]


class _Lengths:
    """A tokenizer, whether it drops blanks, and a bounded memory of the token
    counts of words met."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(model.decode())
        self.tok.no_truncation()
        self.tok.no_padding()
        self.cut = drops_blanks(self.tok)
        self.known: dict[str, int] = {"": 0}

    def whole(self, texts: list[str]) -> list[int]:
        return list(map(len, self.tok.encode_batch_fast(texts, add_special_tokens=False)))

    def words(self, words: list[str]) -> dict[str, int]:
        out = {}
        for i in range(0, len(words), WORDS_A_CALL):
            part = words[i:i + WORDS_A_CALL]
            out.update(zip(part, self.whole(part)))
        return out

    def of(self, texts: list[str]) -> list[int]:
        return _count_group(texts, self.known, self.words) if self.cut else self.whole(texts)


@lru_cache(maxsize=1)
def _lengths(model: bytes) -> _Lengths:
    """One tokenizer a Python worker, so that the tasks it runs after one another
    share its memory of words; which ones it holds changes no count."""
    return _Lengths(model)


def _counter(model: bytes):
    def count(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import pyarrow as pa
        import pyarrow.compute as pc

        lengths = _lengths(model)
        for batch in batches:
            column = pc.fill_null(batch.column("text"), "")
            texts, n_bytes = column.to_pylist(), pc.binary_length(column).cast(pa.int64())
            n_tokens = []
            for lo, hi in by_size(n_bytes.to_pylist(), BATCH_BYTES):
                n_tokens += lengths.of(texts[lo:hi])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n_bytes, pa.array(n_tokens, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    return count


def _count_group(texts, known, lengths):
    out = []
    parts = [[s.replace("\n", " ").split(" ") for s in segments(t, SEGMENT_CHARS)] for t in texts]
    new: set[str] = set()
    for words in (w for p in parts for w in p):
        new.update(set(words).difference(known))
    fresh = lengths(list(new))
    if len(known) + len(fresh) <= MEMORY_WORDS:
        known.update(fresh)
        of = known.__getitem__
    else:
        for w in list(fresh)[:max(0, MEMORY_WORDS - len(known))]:
            known[w] = fresh[w]
        of = lambda w: known[w] if w in known else fresh[w]
    for p in parts:
        out.append(sum(sum(map(of, words)) for words in p))
    return out


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document by the word-level BPE tokenizer."""
    return token_counts(table(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
