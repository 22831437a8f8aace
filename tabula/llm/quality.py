"""Quality rules: word rules, then tokeniser fertility.

A document first passes base rules on its words. The method then measures how
a public vocabulary takes the whole text: characters per token, share of byte
fallback tokens and entropy of the token distribution. Text in the language it
claims stays inside that language's band; shouting, symbol soup, one repeated
word or undecodable bytes fall outside. Each language has its own band, a text
of another language the band of its main script. All figures come from one
pass over the row itself, so nothing is shuffled and a verdict never depends
on other documents.

Cases: a null or empty text has no words and fails the base rules; a null or
unknown language falls back on the script; rows are judged one by one,
whatever their ids; extra columns are kept by ``with_quality``, and the verdict
column takes a name that is free; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, lean, prepare, segments, table, vocabulary

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
GROUP_CHARS = 4_000_000
SEGMENT_CHARS = 1_000_000

#: (least, most) characters per token by language, then by script.
CHARS_PER_TOKEN = {"en": (1.8, 6.0), "de": (1.7, 5.5), "fr": (1.7, 5.5), "es": (1.6, 5.5),
                   "latin": (1.4, 6.5), "cjk": (0.3, 3.0), "other": (0.4, 5.0)}
#: Most byte-fallback tokens among all tokens.
BYTE_SHARE = {"en": 0.15, "de": 0.15, "fr": 0.15, "es": 0.15, "latin": 0.25, "cjk": 0.6, "other": 0.8}
#: Least entropy of the tokens, in bits, and as a share of the most that so many tokens can have; as that is never
#: more than the vocabulary allows, a text isn't rejected for its length.
MIN_ENTROPY, MIN_ENTROPY_SHARE = 4.2, 0.42

STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
         "kept boolean, band string, chars_per_token double, byte_share double, token_entropy double")
_CJK = re.compile("[぀-ヿ㐀-鿿가-힯]")
_LATIN = re.compile("[A-Za-zÀ-ɏ]")


def with_quality(docs: DataFrame, model_path: str, text: str = "text", lang: str = "lang",
                 name: str = "quality") -> tuple[DataFrame, str]:
    """``docs`` with a struct column of figures and verdict, and its name
    (``name``, lengthened while ``docs`` has such a column)."""
    prepare(docs.sparkSession)
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    figures = _figures(vocabulary(model_path), text, lang if lang in docs.columns else None, name)
    schema = docs.select("*", F.lit(None).cast(f"struct<{STATS.replace(' ', ':').replace(',:', ',')}>").alias(name)).schema
    return docs.mapInArrow(lean(figures), schema), name


def quality(docs: DataFrame, model_path: str) -> DataFrame:
    """One row of figures and verdict per document."""
    rows, name = with_quality(docs.select("doc_id", "text", "lang"), model_path)
    return rows.select("doc_id", f"{name}.*")


def keep_good(docs: DataFrame, model_path: str) -> DataFrame:
    """The documents that pass, with all their columns."""
    rows, name = with_quality(docs, model_path)
    return rows.filter(F.col(f"{name}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def word_figures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    words = raw.split()
    word_chars = len(text) - (len(raw) - len(raw.translate(None, b" \t\n\v\f\r")))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\v\f\r")]
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that the text has twice or more."""
    import numpy as np

    n = len(words) - window + 1
    numbers: dict[bytes, int] = {}
    for w in words:
        if w not in numbers:
            numbers[w] = len(numbers)
    if n < 2 or len(numbers) == len(words):
        return 0
    ids = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    h = ids[:n].copy()
    for j in range(1, window):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[j:j + n]
    _, which, count = np.unique(h, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[which] > 1)
    if not len(at):
        return 0
    # equal hashes only propose: the windows themselves decide
    seen: dict[bytes, list[int]] = {}
    for i, w in zip(at.tolist(), np.lib.stride_tricks.sliding_window_view(ids, window)[at]):
        seen.setdefault(w.tobytes(), []).append(i)
    edge = np.zeros(len(words) + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            edge[places] += 1
            edge[np.array(places) + window] -= 1
    return int((np.cumsum(edge) > 0).sum())


def band_of(lang: str | None, text: str) -> str:
    if lang in CHARS_PER_TOKEN:
        return lang
    cjk, latin = len(_CJK.findall(text)), len(_LATIN.findall(text))
    letters = sum(map(str.isalpha, text))
    return "cjk" if 2 * cjk >= max(letters, 1) else "latin" if 2 * latin >= letters else "other"


def _figures(model: bytes, text_col: str, lang_col: str | None, name: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        fallback = np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])

        def fertility(text: str):
            ids = np.array([i for s in segments(text, SEGMENT_CHARS) for i in sp.encode(s, num_threads=1)], np.int32)
            if not len(ids):
                return None, None, None
            share = np.unique(ids, return_counts=True)[1] / len(ids)
            return len(text) / len(ids), float(fallback[ids].mean()), float(-(share * np.log2(share)).sum()), len(ids)

        def verdict(text: str, lang: str | None) -> dict:
            n_words, word_chars, n_symbols, n_dup, n_repeat = word_figures(text)
            failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
            row = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup,
                   "n_repeat_words": n_repeat, "base_failed": failed, "kept": False}
            band = band_of(lang, text)
            chars, bytes_, entropy, *n = fertility(text)
            if n:
                low, high = CHARS_PER_TOKEN[band]
                row["kept"] = bool(not failed and low <= chars <= high and bytes_ <= BYTE_SHARE[band]
                                   and entropy >= max(MIN_ENTROPY, MIN_ENTROPY_SHARE * math.log2(min(n[0], len(fallback)))))
            return row | {"band": band, "chars_per_token": chars, "byte_share": bytes_, "token_entropy": entropy}

        kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        struct = pa.struct([pa.field(*((c, kinds[k]))) for c, k in (x.split() for x in STATS.split(", "))])
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            langs = batch.column(lang_col).to_pylist() if lang_col else [None] * len(texts)
            for lo, hi in by_bytes(texts, GROUP_CHARS):
                figures = pa.array([verdict(t, g) for t, g in zip(texts[lo:hi], langs[lo:hi])], struct)
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, figures], [*batch.schema.names, name])

    return run


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
