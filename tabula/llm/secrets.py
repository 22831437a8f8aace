"""Secret scans: pattern candidates, then a random forest against false positives.

Everything runs as DataFrame expressions and MLlib. A text's words are cut at
white space; a word gives candidates (long runs of token characters with a
digit or a key word beside them; values of six characters or more assigned to
a password-like name, also with quotes and blanks between, held by a tag of that
name, following an argument of that name or "is"; passwords of connection
strings and of ``-u name:password``) together with its neighbouring words. A
value ends at white space; a private key is one candidate from its first to its
last line. Features: candidate length, character classes and the
transitions between them, coverage by dictionary words, path marks around it,
and key words beside it. The forest is fitted on labelled findings, at most
``MAX_LABELLED`` distinct ones by hash order, and scores every candidate.

Labelled findings come from the caller as (finding, secret 0/1) or, by default,
from ``format_labels``: published token formats and assigned credentials are
secrets; card-like digit runs, identifiers and placeholders are not; what no
rule knows stays unlabelled and is the forest's to judge. With only one class
labelled there is nothing to fit, and the labels alone decide.

Cases: null and empty texts have no candidates; null and repeated doc_ids and
repeated rows are scanned row by row; a word with several candidates gives a
row for each; extra columns are ignored (``redact`` keeps them); an empty
table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.session import scratch_path

from .common import numbered_rows, table, written

MAX_LABELLED = 20_000
TREES, DEPTH, SEED = 40, 8, 17
REDACTED = "[SECRET]"
KEY_WORDS = "password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential"
ID_WORDS = "sha1|sha256|md5|commit|checksum|hash|uuid|guid|isbn|order|invoice|card|phone|tracking|build|version"
#: Words that placeholders, names and paths are made of.
DICTIONARY = (
    "example sample test dummy fake demo placeholder changeme default your here foo bar none null todo lorem ipsum "
    "user admin root guest name host local server client config service account app file path dir src lib bin usr "
    "var tmp home data index main page image video html http https www com org net version release build debug prod "
    "stage the and for with from this that not are was have has").split()
LONG = "[A-Za-z0-9+/_-]{16,}={0,2}"
#: A key word with what names put behind it ("author" and "secretary" are none), a sign of assignment, an
#: authorization scheme, quotes. A value beside them may hold anything up to white space or its quote.
#: What may follow a key word in a name has at most this many characters, since a pattern that looks behind must be bounded.
TAIL_CHARS = 64
NAME = f"(?:{KEY_WORDS})(?:orization|entication|s|key|value|[0-9]{{1,3}})?(?:[_-][A-Za-z0-9_-]{{0,{TAIL_CHARS}}})?(?![A-Za-z])"
QUOTES = "[\\\\\"'`\\]]{0,3}"
SIGN = "(?::=|=>|={1,2}|:)"
SCHEME = "(?:(?:bearer|basic)(?:\\s|$))?"
OPEN = "[\\\\\"'`(]{0,2}"
VALUE_CHARS, WORTH_CHARS = "[^\\s\"'`,;]", "[^\\s\"'`]"
VALUE = (f"(?<={NAME}{QUOTES}{SIGN}{OPEN})(?!(?:bearer|basic)$)"
         f"(?:(?<=[\"'`])[^\\s\"'`]{{6,}}|(?<![\"'`]){VALUE_CHARS}{{6,}})")
#: The password of a connection string, and what a tag with a key word's name holds.
USER_INFO = "(?<=://[^\\s/@:]{0,128}:)[^\\s/@]{3,}(?=@)"
TAGGED = f"(?<=<{NAME}>)[^\\s<]{{6,}}"
CANDIDATE = f"(?i)(?:{USER_INFO}|{TAGGED}|{VALUE}|{LONG})"
#: A private key from its first to its last line, however its line breaks are spelled.
PEM = "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=:,\\s\\\\-]*?-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----"
#: The words before a value: up to its sign, or up to the name if the sign begins the value's word.
ASSIGNS = f"(?i){NAME}{QUOTES}\\s?{SIGN}\\s?{SCHEME}{OPEN}$"
NAMES = f"(?i){NAME}{QUOTES}$"
#: The words before a value that an argument, or a sentence, gives: --password, -u (with a name and a colon), "password is".
ARGUMENT = f"(?i)(?:^|\\s)--?(?:[a-z0-9]+[_-])*{NAME}$"
USER_ARGUMENT = "(?:^|\\s)(?:-u|--user|--proxy-user)$"
TOLD = f"(?i){NAME}\\s(?:is|was|equals)$"
IN_WORD = f"://[^\\s/@:]{{0,128}}:[^\\s/@]{{3,}}@|<{NAME}>[^\\s<]{{6}}"
#: Cheap tests that a word, a word after an assignment, or a text can hold a candidate at all.
WORTH_WORD = f"(?i)[A-Za-z0-9+/_-]{{16}}|{IN_WORD}|{NAME}{QUOTES}{SIGN}{OPEN}{WORTH_CHARS}{{6}}"
WORTH_VALUE = f"{WORTH_CHARS}{{6}}"
WORTH = (f"(?i)[A-Za-z0-9+/_-]{{16}}|PRIVATE KEY-----|{IN_WORD}|-(?:u|user)\\s+[^\\s:]+:|(?<=-){NAME}\\s+{WORTH_CHARS}{{6}}|"
         f"{NAME}(?:\\s+(?:is|was|equals)\\s+{WORTH_CHARS}{{6}}|"
         f"{QUOTES}\\s*{SIGN}\\s*(?:(?:bearer|basic)\\s+)?{OPEN}\\s*{WORTH_CHARS}{{6}})")
#: Published formats of issued tokens.
ISSUED = ("^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$"
          "|^sk_live_[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_-]{35}$|^glpat-[A-Za-z0-9_-]{20,}$")
#: Private keys are numbered from here, beside the other findings of their first word.
PEM_NO = 1 << 20
FEATURES = ["length", "digit_share", "upper_share", "lower_share", "transitions", "distinct_share", "hex", "digits_only",
            "dictionary", "slashes", "dots", "url", "assigned", "given_name", "quoted", "key_beside", "id_beside"]


def candidates(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, then word_no, finding_no, finding and its context. A
    private key is one finding more, numbered from its first word."""
    worth = docs.filter(F.col("text").rlike(WORTH)).select(*keep, "text", F.split("text", "\\s+").alias("words"))
    # what stands before a word counts as a name or an assignment in front of it
    lead = "concat_ws(' ', get(words, i - 4), get(words, i - 3), get(words, i - 2), get(words, i - 1))"
    last = "get(words, i - 1)"
    # cheap tests first: nearly all words fail them, and their context is never put together
    signed = " or ".join(f"contains(get(words, i - {k}), '{c}')" for k in (1, 2, 3) for c in ":=")
    head = (f"case when ({signed}) and {lead} rlike {_literal(ASSIGNS)} then 'password=' "
            f"when words[i] rlike '^[:=]' and {lead} rlike {_literal(NAMES)} then 'password' "
            f"when startswith({last}, '-') and not startswith(words[i], '-') and ({last} rlike {_literal(ARGUMENT)} "
            f"or ({last} rlike {_literal(USER_ARGUMENT)} and words[i] rlike '^[^:]+:.')) then 'password=' "
            f"when lower({last}) in ('is', 'was', 'equals') and {lead} rlike {_literal(TOLD)} then 'password=' else '' end")
    at = worth.select(*keep, F.explode(F.expr(
        f"transform(filter(sequence(0, size(words) - 1), i -> words[i] rlike {_literal(WORTH_WORD)} "
        f"or (words[i] rlike {_literal(WORTH_VALUE)} and {head} != '')), i -> named_struct("
        "'word_no', i, 'word', words[i], 'before', lower(concat_ws(' ', get(words, i - 2), get(words, i - 1))), "
        f"'after', lower(get(words, i + 1)), 'head', {head}))")).alias("at")).select(*keep, "at.*")
    each = at.select("*", F.posexplode(F.regexp_extract_all(F.concat("head", "word"), F.lit(CANDIDATE), F.lit(0)))
                     .alias("finding_no", "finding"))
    rest = F.concat_ws(" ", "before", F.replace("word", "finding", F.lit(" ")))
    value = (F.col("finding").rlike("[0-9]") | (F.col("head") != "") | rest.rlike(f"(?i){NAME}")
             | F.col("word").rlike(f"(?i)(?:{KEY_WORDS})[:=]") | F.col("word").rlike(IN_WORD))
    blocks = worth.filter(F.col("text").contains("PRIVATE KEY-----")).select(
        *keep, "text", F.posexplode(F.regexp_extract_all("text", F.lit(PEM), F.lit(0))).alias("finding_no", "finding"))
    before = F.expr("substring_index(text, finding, 1)")
    keys = blocks.select(*keep, (F.size(F.split(before, "\\s+")) - 1).alias("word_no"), F.col("finding").alias("word"),
                         F.lit("private key").alias("before"), F.lit(None).cast("string").alias("after"), F.lit("").alias("head"),
                         (F.col("finding_no") + PEM_NO).alias("finding_no"), "finding")
    return each.filter(value).unionAll(keys).withColumn("given", F.col("head") != "").drop("head")


def _literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _share(pattern: str) -> Column:
    return F.regexp_count("finding", F.lit(pattern)) / F.length("finding")


def featured(found: DataFrame) -> DataFrame:
    """``found`` with the feature columns."""
    upper, lower, digit = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    classes = F.translate("finding", upper + lower + digit, "U" * 26 + "l" * 26 + "0" * 10)
    covered = F.aggregate(F.regexp_extract_all(F.lower("finding"), F.lit("|".join(DICTIONARY)), F.lit(0)), F.lit(0),
                          lambda n, w: n + F.length(w))
    beside = F.concat_ws(" ", "before", F.lower("word"))
    number = lambda c: c.cast("double")
    made = {
        "length": F.length("finding"), "digit_share": _share("[0-9]"), "upper_share": _share("[A-Z]"),
        "lower_share": _share("[a-z]"), "transitions": (F.length(F.regexp_replace(classes, "(.)\\1+", "$1")) - 1) / F.length("finding"),
        "distinct_share": F.size(F.array_distinct(F.split("finding", ""))) / F.length("finding"),
        "hex": F.col("finding").rlike("^[0-9a-f]+$"), "digits_only": F.col("finding").rlike("^[0-9 -]+$"),
        "dictionary": covered / F.length("finding"), "slashes": F.regexp_count("finding", F.lit("/")),
        "dots": F.regexp_count("word", F.lit("[.]")), "url": F.col("word").rlike("://|www[.]"),
        "assigned": F.col("word").rlike("[A-Za-z0-9_][\"'`\\]]{0,2}[:=]|^[:=]") | F.col("before").rlike("[:=]>?[\"'`]?$"),
        "given_name": F.col("given"), "quoted": F.col("word").rlike("[\"'`]"), "key_beside": beside.rlike(KEY_WORDS),
        "id_beside": F.concat_ws(" ", beside, "after").rlike(ID_WORDS)}
    return found.select("*", *[number(made[c]).alias(c) for c in FEATURES])


def format_labels(rows: DataFrame) -> Column:
    """1 for issued token formats and assigned credentials, 0 for known
    non-secrets, null for the rest, from a featured row."""
    placeholder = (F.col("dictionary") > 0.4) | (F.col("distinct_share") < 0.2)
    issued = F.col("finding").rlike(ISSUED) | F.col("finding").rlike("^-----BEGIN")
    credential = ((F.col("key_beside") == 1) & ((F.col("assigned") == 1) | F.col("given")) & (F.col("digit_share") > 0)) | F.col("word").rlike(
        "://[^\\s/@:]{0,128}:[^\\s/@]{3,}@")
    other = (F.col("digits_only") == 1) | (F.col("id_beside") == 1) | (F.col("url") == 1) | (F.col("slashes") > 2)
    return (F.when(issued, 1).when(placeholder, 0).when(credential & (F.col("digits_only") == 0), 1)
            .when(other & (F.col("key_beside") == 0), 0))


def fit(spark: SparkSession, rows: DataFrame, labels: DataFrame | None = None):
    """The forest fitted on labelled featured rows (None if one class is missing).

    The sample is ``MAX_LABELLED`` distinct labelled findings, least hash first,
    half of them at most from each class, so a common finding counts once."""
    if labels is None:
        labelled = rows.withColumn("label", format_labels(rows)).filter("label is not null")
    else:
        labelled = rows.join(labels.select("finding", F.col("secret").alias("label")).dropDuplicates(["finding"]), "finding")
    parts = None
    for label in (0, 1):
        each = labelled.filter(F.col("label") == label).groupBy("finding").agg(
            F.min(F.struct(*FEATURES)).alias("f")).withColumn("label", F.lit(float(label)))
        each = each.orderBy(F.xxhash64("finding"), "finding").limit(MAX_LABELLED // 2).select("finding", "label", "f.*")
        parts = each if parts is None else parts.unionAll(each)
    sample = written(spark, parts.coalesce(1), "secret-labels")
    if {r[0] for r in sample.select("label").distinct().collect()} != {0.0, 1.0}:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="vector", labelCol="label")
    # saved and loaded: the model that scores holds nothing of the tables it was fitted on
    path = scratch_path(spark, "llm", f"secret-forest-{uuid.uuid4().hex}")
    forest.fit(_assembled(sample)).write().save(path)
    return RandomForestClassificationModel.load(path)


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(rows)


def scored(rows: DataFrame, model) -> DataFrame:
    """Featured rows with ``score`` and the verdict ``secret``."""
    if model is None:
        label = format_labels(rows)
        return rows.select("*", label.cast("double").alias("score"), F.coalesce(label == 1, F.lit(False)).alias("secret"))
    out = model.transform(_assembled(rows)).withColumn("score", vector_to_array("probability")[1])
    return out.drop("vector", "rawPrediction", "probability", "prediction").withColumn("secret", F.col("score") >= 0.5)


def scan(docs: DataFrame, labels: DataFrame | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every candidate of ``docs`` with its features, score and verdict."""
    spark = docs.sparkSession
    rows = written(spark, featured(candidates(docs, keep)), "secret-candidates")
    return scored(rows, fit(spark, rows, labels))


def redact(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """All rows and columns of ``docs`` (written once with a running number), with
    every secret in a text replaced by ``REDACTED`` (and n_chars, if there is one,
    counted again)."""
    row, found = "scanned_row", "scanned_secrets"
    while {row, found} & {c.lower() for c in docs.columns}:
        row, found = row + "_", found + "_"
    numbered = numbered_rows(docs.sparkSession, docs, row, "secret-texts")
    secrets = (scan(numbered.select(row, "text"), labels, keep=(row,)).filter("secret").groupBy(row)
               .agg(F.collect_set("finding").alias(found)))
    longest = F.array_sort(found, lambda a, b: F.length(b) - F.length(a))
    clean = F.when(F.col(found).isNull(), F.col("text")).otherwise(
        F.aggregate(longest, F.col("text"), lambda t, s: F.replace(t, s, F.lit(REDACTED))))
    out = numbered.join(secrets, row, "left").withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(found).isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings without their plain text: a digest and what is known of them."""
    return scan(table(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "word_no", "finding_no", F.sha2("finding", 256).alias("finding_sha256"),
        F.col("length").cast("int").alias("length"), F.round("score", 6).alias("score"), "secret")
