"""Documents with awkward cases, and plain Python versions of the contracts."""

import collections
import random
import re

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, set_id string, hits string, "
          "quality string, ids string, kept_row string")


def rows(table, sf=SF):
    return pq.read_table(f"{sf}/{table}.parquet").to_pylist()


def awkward_texts():
    rng = random.Random(5)
    words = [r["text"].split() for r in rows("documents")[:40]]
    flat = [w for ws in words for w in ws]
    long = " ".join(rng.choice(flat) for _ in range(60_000)) + "\n" + "x" * 5000 + " " + "\n".join(flat[:400])
    alphabet = " \n\t\x0b\x1c\x85\xa0 ab,.'1éß漢😀<|>"
    noise = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    plain = [r["text"] for r in rows("documents")[:60]]
    return [None, "", " ", "\n\n", "\t", "a", "one two three", "one two three four five", "  two  spaces \n lines\n\n", "x" * 3000,
            "<|endoftext|> and <|startoftext|>tail", "it's they'll 12 345!!", long, *noise, *plain, *plain[:5], plain[0] + " tail"]


def awkward_docs(spark, tmp_path, texts=None):
    """A written table: null and repeated ids, repeated rows, extra columns whose
    names the operators use themselves."""
    texts = awkward_texts() if texts is None else texts
    data = [(i, t, ["en", "de", None, "xx"][i % 4], "s", len(t or ""), 7, "s", "h", "q", "i", "k") for i, t in enumerate(texts)]
    data += [data[5], data[-1], data[-1], (None, *data[-2][1:]), (None, None, *data[0][2:]), (3, "another text under id 3", *data[3][2:])]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(df, *cols):
    return collections.Counter(tuple(r[c] for c in cols) for r in df.collect())


WORDS5 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words5(text):
    return WORDS5.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(text, items, window=13):
    """n_words, n_hit, item ids with an occurring window."""
    w = words5(text)
    hit, found = set(), set()
    places = collections.defaultdict(list)
    for j, x in enumerate(w):
        places[x].append(j)
    for item, body in items:
        b = words5(body)
        for i in range(max(1, len(b) - window + 1) if b else 0):
            p = b[i:i + window]
            for j in places[p[0]]:
                if w[j:j + len(p)] == p:
                    hit.update(range(j, j + len(p)))
                    found.add(item)
    return len(w), len(hit), found


def brute_base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    count = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = set()
    for i in range(len(w) - 7):
        if count[tuple(w[i:i + 8])] > 1:
            inside.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def grams(words):
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar(sets):
    """Pairs of places of sets with Jaccard similarity 0.8 or more."""
    inverted, shared = collections.defaultdict(list), collections.Counter()
    for k, s in enumerate(sets):
        for g in s:
            inverted[g].append(k)
    for places in inverted.values():
        for a in range(len(places)):
            for b in range(a):
                shared[places[b], places[a]] += 1
    return [(a, b) for (a, b), n in shared.items() if 9 * n >= 4 * (len(sets[a]) + len(sets[b]))]


def roots(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]
