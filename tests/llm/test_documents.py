"""Operators 2, 4, 5 and 7 against brute force."""

import collections
import hashlib
import random

import public_tokenizers as P
from helpers import (SF, awkward_docs, awkward_texts, brute_base, brute_hits, by_row, empty_docs, grams, roots, rows, similar)
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabula.llm import common, decontaminate, minhash, ngram_join, quality, secrets, similar_sets, substring_dedup
from tabula.llm.registry import QUERIES

MODEL = P.path("piece_bpe_32k.model")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_figures(spark, tmp_path):
    docs = awkward_docs(spark, tmp_path)
    got = quality.quality(docs, MODEL)
    assert by_row(got, "doc_id", *BASE) == collections.Counter((r.doc_id, *brute_base(r.text)) for r in docs.collect())
    assert got.filter("kept and base_failed").count() == 0
    kept = quality.keep_good(docs, MODEL)
    assert kept.columns == docs.columns and kept.count() == got.filter("kept").count() > 0
    assert quality.keep_good(empty_docs(spark), MODEL).count() == 0


def test_fertility_verdicts(spark):
    clean = next(r["text"] for r in rows("documents") if r["lang"] == "en" and r["n_chars"] > 1500)
    texts = {1: clean, 2: " ".join(f"w{i % 3}" for i in range(60)), 3: " ".join(chr(0x12000 + i) * 3 for i in range(40)),
             4: " ".join(f"{a}ß" for a in clean.split())}
    df = spark.createDataFrame([(k, t, "en") for k, t in texts.items()], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.quality(df, MODEL).collect()}
    assert got[1].kept and not got[2].kept and not got[3].kept
    assert got[3].byte_share > quality.BYTE_SHARE["en"] and 0 < got[1].chars_per_token < 6
    assert quality.band_of(None, "漢字かな交じり文") == "cjk" and quality.band_of(None, "plain words") == "latin"
    assert quality.band_of("xx", "слова") == "other"


def test_clean_texts_of_any_length_are_kept(spark):
    """Words drawn as often as a language has them: 1 to 10 million characters."""
    rng, texts = random.Random(9), []
    for lang, n in (("en", 10_000_000), ("de", 1_000_000), ("fr", 1_000_000), ("es", 1_000_000), ("fr", 10_000_000)):
        words = [w for r in rows("documents") if r["lang"] == lang for w in r["text"].split()]
        texts.append((len(texts), " ".join(rng.choices(words, k=n // 4))[:n], lang))
    texts.append((len(texts), " ".join(rng.choices([f"w{i}" for i in range(12)], k=300_000)), "en"))
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(3)
    assert {r.doc_id: r.kept for r in quality.quality(df, MODEL).collect()} == {k: k < 5 for k, _, _ in texts}


@given(st.lists(st.sampled_from("abc"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_repeated_words(words):
    assert quality.repeated_words([w.encode() for w in words]) == brute_base(" ".join(words))[4]


ITEMS = st.lists(st.lists(st.sampled_from("abcd"), max_size=8), max_size=6)


@given(ITEMS, ITEMS, st.sampled_from([6, 1000]))
@settings(max_examples=150, deadline=None)
def test_fm_index_finds_every_occurrence(texts, items, shard):
    docs = [[w.encode() for w in t] for t in texts + texts[:1] + [sum(texts, [])]]
    named = [(str(k), " ".join(w)) for k, w in enumerate(items)]
    got = decontaminate.find_hits(docs, decontaminate.Phrases(named, window=4), shard_words=shard)
    for words, (mask, found) in zip(docs, got):
        _, n_hit, want = brute_hits(" ".join(w.decode() for w in words), named, window=4)
        assert {named[i][0] for i in found} == want and (0 if mask is None else int(mask.sum())) == n_hit


def test_suffix_order_and_locate():
    import numpy as np

    rng = np.random.default_rng(3)
    text = np.concatenate([np.append(rng.integers(1, 4, n), 0) for n in (40, 0, 40, 300)] * 2).astype(np.int32)
    index = decontaminate.FMIndex(text, sample=5)
    order = decontaminate.suffix_order(text)
    assert (index.locate(np.arange(len(text))) == order).all()
    phrases = np.array([[1, 2, -1], [3, 3, 3]])
    low, high = index.search(phrases, np.array([2, 3]))
    for p, n, a, b in zip(phrases, (2, 3), low, high):
        want = [i for i in range(len(text) - n) if (text[i:i + n] == p[:n]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def _contract5(docs, items):
    want = collections.Counter()
    for r in docs:
        n, hit, found = brute_hits(r["text"], items)
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        want[r["doc_id"], n, hit, len(found), hashlib.sha256(ids.encode()).hexdigest(), hit > 0 and 20 * hit >= n] += 1
    return want


COLS5 = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontaminate(spark, tmp_path):
    bench = rows("benchmark")
    texts = awkward_texts() + [b["text"] for b in bench[:10]] + ["Before it. " + bench[3]["text"].upper() + " after"]
    docs = awkward_docs(spark, tmp_path, texts)
    items = [(b["item_id"], b["text"]) for b in bench] + [(900, None), (901, ""), (902, "two three"), (903, "!!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = _contract5([r.asDict() for r in docs.collect()], items)
    assert by_row(decontaminate.decontaminate(docs, benchmark), *COLS5) == want
    sliced, hits = decontaminate.with_hits(docs, benchmark, slice_bytes=1500)
    whole, same = decontaminate.with_hits(docs, benchmark)
    assert hits == same == "hits_" and set(docs.columns) < set(sliced.columns)
    pick = lambda d: d.select("doc_id", f"{hits}.n_words", f"{hits}.n_hit", F.size(f"{hits}.items").alias("n"),
                              F.col(f"{hits}.spans").cast("string").alias("s"))
    assert by_row(pick(sliced), "doc_id", "n_words", "n_hit", "n", "s") == by_row(pick(whole), "doc_id", "n_words", "n_hit", "n", "s")
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(v for k, v in want.items() if not k[-1])
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(empty_docs(spark), benchmark).count() == 0


def test_sliced_items_count_as_whole_ones(spark, tmp_path):
    """Repeated and null item_ids, and a third of all items equal."""
    bench = [b["text"] for b in rows("benchmark")[:24]]
    items = [(k % 5 if k % 3 else None, t) for k, t in enumerate(bench)] + [(k, bench[0]) for k in range(20)] + [(7, bench[0]), (None, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [f"Before {a} and {b} after." for a, b in zip(bench, bench[1:])] + ["no hit at all", None]
    docs = awkward_docs(spark, tmp_path, texts)

    def found(**k):
        out, hits = decontaminate.with_hits(docs, benchmark, **k)
        return by_row(out.select("doc_id", f"{hits}.n_words", f"{hits}.n_hit", F.size(f"{hits}.items").alias("n"), F.array_sort(
            f"{hits}.items").cast("string").alias("ids"), F.col(f"{hits}.spans").cast("string").alias("s")), "doc_id", "n_words", "n_hit", "n", "ids", "s")

    assert found(slice_bytes=1500) == found() and max(k[3] for k in found()) > 20


def _brute_join(docs):
    """doc place -> (place of its class's least row, links)."""
    sets = [grams((d["text"] or "").split()) for d in docs]
    pairs = similar(sets)
    links = collections.Counter(x for p in pairs for x in p)
    return roots(len(docs), pairs), links


def test_ngram_join(spark, tmp_path):
    base = [r["text"] for r in rows("documents")[:80]]
    near = [t.replace(" ", " extra ", 1) if i % 2 else t + " some more" for i, t in enumerate(base[:30])]
    docs = awkward_docs(spark, tmp_path, awkward_texts()[:170] + base + near)
    plain = sorted((r.asDict() for r in docs.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    root, links = _brute_join(plain)
    want = collections.Counter((d["doc_id"], plain[root[k]]["doc_id"], links[k]) for k, d in enumerate(plain))
    assert by_row(ngram_join.ngram_join(docs), "doc_id", "class_id", "n_links") == want
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    one = collections.Counter(plain[r]["doc_id"] for r in set(root))
    assert by_row(kept, "doc_id") == collections.Counter({(k,): v for k, v in one.items()})
    assert ngram_join.ngram_join(empty_docs(spark)).count() == 0 and ngram_join.keep_one(empty_docs(spark)).count() == 0


def test_one_large_group_in_blocks(spark, tmp_path, monkeypatch):
    """A group of many different near copies, dealt into blocks: all links counted."""
    monkeypatch.setattr(similar_sets, "BLOCK", 16)
    words = rows("documents")[0]["text"].split()[:80]
    texts = [" ".join(words + [f"tail{i}", f"more{i}"]) for i in range(90)] + [" ".join(words)] * 40
    got = ngram_join.ngram_join(awkward_docs(spark, tmp_path, texts)).filter("doc_id < 130 and class_docs > 50").collect()
    plain = [r.asDict() for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()]
    root, links = _brute_join(plain)
    want = {d["doc_id"]: links[k] for k, d in enumerate(plain)}
    assert len(got) >= 130 and all(r.class_id == 0 and r.n_links == want[r.doc_id] for r in got if r.doc_id not in (3, 5, 129))


def test_scans_planned_anew_name_the_same_rows(spark, tmp_path, monkeypatch):
    """The table's files are dealt to other splits after the first step that is written."""
    base = [r["text"] for r in rows("documents")[:60] if r["n_chars"] > 900]
    texts = [t + f" tail{i}" for i, t in enumerate(base[:12] * 2)] + [f'mail password="{i}x8k2!{i}pq" next' for i in range(9)]
    path = str(tmp_path / "t")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(12, "doc_id").write.parquet(path)
    split = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(split)

    def result(f):
        spark.conf.set(split, "1")
        out = f(spark.read.parquet(path))
        return by_row(out, *out.columns)

    def replanned(*a, own=common.written):
        out = own(*a)
        spark.conf.set(split, str(1 << 30))
        return out

    runs = ngram_join.ngram_join, ngram_join.keep_one, secrets.redact, substring_dedup.repeated_spans
    try:
        want = [result(f) for f in runs]
        for module in (ngram_join, secrets, substring_dedup, similar_sets):
            monkeypatch.setattr(module, "written", replanned)
        for f, w in zip(runs, want):
            assert result(f) == w
    finally:
        spark.conf.set(split, before)


@given(st.lists(st.lists(st.integers(0, 30), max_size=25).map(lambda x: sorted(set(x))), min_size=2, max_size=30))
@settings(max_examples=100, deadline=None)
def test_intersections(sets):
    import numpy as np

    got = similar_sets.intersections([np.array(s, np.uint64) for s in sets])
    for a in range(len(sets)):
        for b in range(len(sets)):
            if a != b:
                assert got[a, b] == len(set(sets[a]) & set(sets[b]))


def test_band_recall():
    """Pairs of similarity 0.8 meet in a band as often as the curve says."""
    import numpy as np

    rng, hit = np.random.default_rng(1), collections.Counter()
    shapes = {"documents": (ngram_join.BANDS, ngram_join.ROWS), "lines": (substring_dedup.BANDS, substring_dedup.ROWS)}
    for name, shape in shapes.items():
        bands = minhash.Bands(*shape)
        for _ in range(300):
            x = rng.integers(0, 1 << 63, 180, np.int64).astype(np.uint64)
            a, b = np.sort(np.append(x[:160], x[160:170][:20])), np.sort(np.append(x[:160], x[170:180]))
            hit[name] += bool((bands.of(a) == bands.of(b)).any())
    assert hit["documents"] >= 299 and hit["lines"] >= 296


def test_substring_dedup(spark, tmp_path):
    base = [r["text"] for r in rows("documents")[:60] if r["n_chars"] > 900]
    passage = " ".join(rows("documents")[1]["text"].split()[:52])
    cut = [" ".join(w[:i] + passage.split() + w[i:]) for i, w in ((7 + k, t.split()) for k, t in enumerate(base[:12]))]
    lines = ["\n".join([f"own first line {k} with words of its own here", base[30].split("\n")[0] + " and a tail", t]) for k, t in enumerate(base[12:16])]
    docs = awkward_docs(spark, tmp_path, [None, "", "a", *cut, *lines, *base[20:30], *base[20:22]])
    got = substring_dedup.repeated_spans(docs).collect()
    covered = collections.defaultdict(set)
    for r in got:
        covered[r.doc_id].update(range(r.begin, r.end))
    owner, texts = collections.defaultdict(set), [r.asDict() for r in docs.collect()]
    for k, d in enumerate(texts):
        w = (d["text"] or "").split()
        for i in range(len(w) - 50):
            owner[tuple(w[i:i + 51])].add(k)
    for k, d in enumerate(texts):
        w = (d["text"] or "").split()
        for i in range(len(w) - 50):
            if len(owner[tuple(w[i:i + 51])]) > 1:
                assert covered[d["doc_id"]] & set(range(i, i + 51))
    by_class = collections.defaultdict(list)
    for r in got:
        by_class[r.class_id].append(r)
    assert all(any(r.removed for r in v) for k, v in by_class.items() if k.startswith("line:"))
    assert all(sum(not r.removed for r in v) == 1 for k, v in by_class.items() if k.startswith("line:"))
    assert substring_dedup.repeated_spans(empty_docs(spark)).count() == 0


def brute_paragraphs(text, least=15):
    """(begin, words) of long lines and of blocks of short ones, word by word."""
    out, at, block = [], 0, []

    def close():
        if len(block) >= least:
            out.append((at - len(block), list(block)))
        block.clear()

    for line in (text or "").split("\n"):
        w = line.split()
        if 0 < len(w) < least:
            block.extend(w)
        else:
            close()
            if w:
                out.append((at, w))
        at += len(w)
    close()
    return out


def _brute_classes(docs):
    place = [(d, at, at + len(w)) for d, text in docs for at, w in brute_paragraphs(text)]
    sets = [grams(w) for _, text in docs for _, w in brute_paragraphs(text)]
    groups = collections.defaultdict(list)
    for k, r in enumerate(roots(len(place), similar(sets))):
        groups[r].append(place[k])
    return {tuple(sorted(g)) for g in groups.values() if len(g) > 1}


def _classes(got):
    found = collections.defaultdict(list)
    for r in got.filter("kind = 'line'").collect():
        found[r.class_id].append((r.doc_id, r.begin, r.end))
    return {tuple(sorted(g)) for g in found.values()}


def test_line_classes_equal_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in rows("documents")]
    assert _classes(QUERIES["op2_substring_dedup"](spark, SF)) == _brute_classes(docs)


def test_wrapped_paragraphs_and_short_lines(spark, tmp_path):
    """Paragraphs wrapped at ten words, near copies of them, and lines of 15 to 19 words."""
    rng = random.Random(6)
    pool = sorted({w for d in rows("documents") for w in (d["text"] or "").split()})
    wrap = lambda w, n=10: "\n".join(" ".join(w[i:i + n]) for i in range(0, len(w), n))
    docs = []
    for k in range(60):
        w = rng.choices(pool, k=rng.randint(60, 120))
        near = list(w)
        near[rng.randrange(len(near))] = "changed"
        short = " ".join(rng.choices(pool, k=rng.randint(15, 19)))
        own = lambda n: " ".join(rng.choices(pool, k=n))
        docs += [(3 * k, f"{own(30)}\n{wrap(w)}\n\n{own(9)}\n{own(4)}\n{short}"),
                 (3 * k + 1, f"{own(25)}\n{own(40)}\n{wrap(near)}\n{own(20)}"), (3 * k + 2, f"{own(21)}\n{short}\n{own(22)}")]
    path = str(tmp_path / "docs")
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(path)
    got = substring_dedup.repeated_spans(spark.read.parquet(path))
    want = _brute_classes(docs)
    assert len(want) >= 110
    found = _classes(got)
    assert found <= want and len(found) >= 0.98 * len(want)
    exact = {g for g in want if len(g) == 2 and g[0][2] - g[0][1] < 20}
    assert exact <= found


def test_equal_lines_are_cut_alike(spark):
    """The pieces of a line don't depend on its neighbours."""
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(200):
        line = rng.integers(0, 1 << 60, rng.integers(1, 40)).astype(np.uint64)
        cuts = []
        for _ in range(2):
            before, after = (rng.integers(0, 1 << 60, rng.integers(1, 30)).astype(np.uint64) for _ in range(2))
            begins = [0, len(before), len(before) + len(line)]
            at = substring_dedup.cut_places(np.concatenate([before, line, after]), begins)
            cuts.append([c - len(before) for c in at if len(before) <= c < len(before) + len(line)])
        assert cuts[0] == cuts[1] and cuts[0][0] == 0


def test_no_repeats_no_rows(spark):
    df = spark.createDataFrame([(1, "one text of few words"), (2, " ".join(f"word{i}" for i in range(200)))], "doc_id long, text string")
    assert substring_dedup.repeated_spans(df).count() == 0


def test_registered_contracts(spark):
    docs, bench = rows("documents"), [(b["item_id"], b["text"]) for b in rows("benchmark")]
    assert by_row(QUERIES["op5_decontaminate"](spark, SF), *COLS5) == _contract5(docs, bench)
    want = collections.Counter((d["doc_id"], *brute_base(d["text"])) for d in docs)
    assert by_row(QUERIES["op4_quality"](spark, SF), "doc_id", *BASE) == want
    root, links = _brute_join(docs)
    want = collections.Counter((d["doc_id"], docs[root[k]]["doc_id"], links[k]) for k, d in enumerate(docs))
    assert by_row(QUERIES["op7_ngram_join"](spark, SF), "doc_id", "class_id", "n_links") == want


def test_dedup_leaves_no_table_of_all_short_paragraphs(spark):
    import os

    from tabula.llm.substring_dedup import repeated_spans
    from tabula.session import scratch_path

    words = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, f"a b {words} c"), (2, f"d {words} e f"), (3, "g h i")], "doc_id long, text string")
    folder = scratch_path(spark, "llm")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = repeated_spans(docs)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert "dedup-cut" in left and not left & {"dedup-paragraphs", "dedup-repeated"}
    passages = found.filter("kind = 'passage'").select("doc_id", "removed").collect()
    assert sorted(map(tuple, passages)) == [(1, False), (2, True)]
