"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group, each paired (where SQL can say it) with an independent
DuckDB statement over the same parquet tables.

Every query reads whole driver tables. Output columns are named identically
on both sides; floating outputs are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.operators import features as feat
from tabula.operators import stats
from tabula.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        import functools

        from tabula.session import ship_package

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)  # Python stages import this package on the workers
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = _no_negative_zero(sql.strip())
        return fn
    return deco


def _no_negative_zero(sql: str) -> str:
    """DuckDB's round() keeps the sign of a tiny negative (-0.0) where Spark's
    gives 0.0; add 0.0 to every round(...) so both print the same value."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _no_negative_zero(sql[j + 6:k])
        out.append(sql[i:j] + "(" + sql[j:j + 6] + inner + ") + 0.0)")
        i = k + 1


def r6(c):
    return F.round(c, 6)


# Digit-like domain of the embeddings fixture: labels 0..9, 64 features on an
# 8 x 8 grid. (Fixed values of the test domain.)
CLASSES = list(range(10))
N_DIMS = 64
GRID_WIDTH = 8
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# DuckDB long form of embeddings: (vec_id, label, dim, x)
EMB_LONG = ("(SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dim, "
            "unnest(embedding)::DOUBLE AS x FROM embeddings)")


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings")


def emb_long(spark: SparkSession, sf_dir: str, with_label: bool = True) -> DataFrame:
    return feat.vector_to_long(emb(spark, sf_dir), "embedding", "vec_id", "label" if with_label else None)


# ---------------------------------------------------------------- statistics

@register("label_frequency", "SELECT label, COUNT(*) AS count FROM embeddings GROUP BY label")
def q_label_frequency(spark, sf_dir):
    return stats.label_counts(emb(spark, sf_dir).select("label"))


@register("label_frequency_sql", "SELECT label, COUNT(*) AS count FROM embeddings GROUP BY label")
def q_label_frequency_sql(spark, sf_dir):
    return stats.label_counts_sql(spark, emb(spark, sf_dir).select("label"), view="tabula_embeddings")


@register("group_avg_round_sql", """
SELECT l_returnflag, COUNT(*) AS n, ROUND(AVG(l_quantity), 2) AS avg_quantity
FROM lineitem GROUP BY l_returnflag ORDER BY l_returnflag""")
def q_group_avg_round_sql(spark, sf_dir):
    """D3/G1: SQL group aggregate with ROUND(AVG(x), 2) over a temp view."""
    read_table(spark, sf_dir, "lineitem").createOrReplaceTempView("tabula_lineitem")
    return spark.sql("SELECT l_returnflag, COUNT(*) AS n, ROUND(AVG(l_quantity), 2) AS avg_quantity "
                     "FROM tabula_lineitem GROUP BY l_returnflag ORDER BY l_returnflag")


@register("filtered_count_agree", """
SELECT 'sql' AS method, COUNT(*) AS n FROM lineitem WHERE l_discount > 0
UNION ALL
SELECT 'dataframe' AS method, COUNT(*) AS n FROM lineitem WHERE l_discount > 0""")
def q_filtered_count_agree(spark, sf_dir):
    """The same predicate count in SQL form and DataFrame form."""
    li = read_table(spark, sf_dir, "lineitem")
    li.createOrReplaceTempView("tabula_lineitem")
    by_sql = spark.sql("SELECT 'sql' AS method, COUNT(*) AS n FROM tabula_lineitem WHERE l_discount > 0")
    by_df = li.filter(F.col("l_discount") > 0).agg(F.count(F.lit(1)).alias("n")) \
              .select(F.lit("dataframe").alias("method"), "n")
    return by_sql.unionByName(by_df)


def _stats_out(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, r6("mean").alias("mean"), r6("std").alias("std"),
                     r6("min").alias("min"), r6("max").alias("max"), "zeros")


_COLSTATS_WIDE_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(min({c}), 6) AS min, round(max({c}), 6) AS max, "
    f"CAST(sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zeros FROM lineitem"
    for c in LINEITEM_NUMERIC)


@register("column_stats_wide", _COLSTATS_WIDE_SQL)
def q_column_stats_wide(spark, sf_dir):
    """Per-column statistics of a wide table (B2: projected first)."""
    li = read_table(spark, sf_dir, "lineitem")
    long_df = feat.dim_names(feat.wide_to_long(li, LINEITEM_NUMERIC, "l_orderkey"), LINEITEM_NUMERIC)
    return _stats_out(stats.column_stats(long_df, by=("column",)), ["column"])


@register("column_stats_long", f"""
SELECT dim, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min,
       round(max(x), 6) AS max, CAST(sum(CASE WHEN x = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zeros
FROM {EMB_LONG} GROUP BY dim""")
def q_column_stats_long(spark, sf_dir):
    return _stats_out(stats.column_stats(emb_long(spark, sf_dir, with_label=False)), ["dim"])


@register("class_mean", f"SELECT label, dim, round(avg(x), 6) AS mean FROM {EMB_LONG} GROUP BY label, dim")
def q_class_mean(spark, sf_dir):
    return stats.class_means(emb_long(spark, sf_dir)).select("label", "dim", r6("mean").alias("mean"))


_CLASS_MEAN_WIDE_SQL = ("SELECT label, " + ", ".join(
    f"round(avg(embedding[{i + 1}]::DOUBLE), 6) AS f{i}" for i in range(N_DIMS))
    + " FROM embeddings GROUP BY label")


@register("class_mean_wide", _CLASS_MEAN_WIDE_SQL)
def q_class_mean_wide(spark, sf_dir):
    """Class means in the wide sink shape (label + one column per feature)."""
    means = stats.class_means(emb_long(spark, sf_dir)).withColumn("mean", r6("mean"))
    return feat.long_to_wide(means, ["label"], N_DIMS, value="mean", prefix="f")


@register("std_map", f"""
SELECT dim, CAST(dim // {GRID_WIDTH} AS INTEGER) AS row, CAST(dim % {GRID_WIDTH} AS INTEGER) AS col,
       round(stddev_samp(x), 6) AS std
FROM {EMB_LONG} GROUP BY dim""")
def q_std_map(spark, sf_dir):
    s = stats.std_map(emb_long(spark, sf_dir, with_label=False)).withColumn("std", r6("std"))
    return stats.on_grid(s, GRID_WIDTH)


@register("global_mean_vector", f"""
SELECT dim, CAST(dim // {GRID_WIDTH} AS INTEGER) AS row, CAST(dim % {GRID_WIDTH} AS INTEGER) AS col,
       round(avg(x), 6) AS mean, (SELECT max(len(embedding)) FROM embeddings) = {N_DIMS} AS complete
FROM {EMB_LONG} GROUP BY dim""")
def q_global_mean_vector(spark, sf_dir):
    long_df = emb_long(spark, sf_dir, with_label=False)
    vec = stats.global_mean_vector(long_df, N_DIMS)
    # back to one row per dim (K2 table) with the completeness flag of D8
    return (vec.select(F.posexplode("mean_vector").alias("dim", "mean"), "complete")
               .select("dim", *feat.grid_position("dim", GRID_WIDTH), r6("mean").alias("mean"), "complete"))


@register("class_correlation", f"""
WITH cm AS (SELECT label, dim, avg(x) AS m FROM {EMB_LONG} GROUP BY label, dim),
     r AS (SELECT a.label AS label_a, b.label AS label_b, corr(a.m, b.m) AS r
           FROM cm a JOIN cm b ON a.dim = b.dim GROUP BY a.label, b.label),
     grid AS (SELECT a.i::INTEGER AS label_a, b.i::INTEGER AS label_b FROM range(10) a(i), range(10) b(i))
SELECT grid.label_a, grid.label_b, round(coalesce(r.r, 0.0), 6) AS r
FROM grid LEFT JOIN r ON grid.label_a = r.label_a AND grid.label_b = r.label_b""")
def q_class_correlation(spark, sf_dir):
    means = stats.class_means(emb_long(spark, sf_dir))
    return stats.class_correlation(means, CLASSES).select("label_a", "label_b", r6("r").alias("r"))


@register("class_pair_difference", f"""
WITH cm AS (SELECT label, dim, avg(x) AS m FROM {EMB_LONG} GROUP BY label, dim),
     p AS (SELECT * FROM (VALUES (1, 7), (3, 8), (4, 9)) t(label_a, label_b))
SELECT p.label_a, p.label_b, a.dim, round(a.m, 6) AS mean_a, round(b.m, 6) AS mean_b,
       round(abs(a.m - b.m), 6) AS abs_diff
FROM p JOIN cm a ON a.label = p.label_a JOIN cm b ON b.label = p.label_b AND b.dim = a.dim""")
def q_class_pair_difference(spark, sf_dir):
    means = stats.class_means(emb_long(spark, sf_dir))
    d = stats.class_pair_difference(spark, means)
    return d.select("label_a", "label_b", "dim", r6("mean_a").alias("mean_a"),
                    r6("mean_b").alias("mean_b"), r6("abs_diff").alias("abs_diff"))


_ZERO_RATIO_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, COUNT(*) AS n_rows, CAST(sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_empty, "
    f"round(sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) / COUNT(*), 6) AS empty_ratio, "
    f"sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) / COUNT(*) < 0.98 AS keep FROM lineitem"
    for c in LINEITEM_NUMERIC)


@register("zero_ratio_prune", _ZERO_RATIO_SQL)
def q_zero_ratio_prune(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    long_df = feat.wide_to_long(li, LINEITEM_NUMERIC, "l_orderkey")
    sel = feat.select_informative(long_df, 0.98)
    names = F.element_at(F.array(*[F.lit(c) for c in LINEITEM_NUMERIC]), F.col("dim") + 1)
    return sel.select(names.alias("column"), "n_rows", "n_empty", r6("empty_ratio").alias("empty_ratio"), "keep")


@register("empty_ratio_prune", f"""
SELECT dim, COUNT(*) AS n_rows, CAST(sum(CASE WHEN abs(x) < 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS n_empty,
       round(sum(CASE WHEN abs(x) < 0.05 THEN 1 ELSE 0 END) / COUNT(*), 6) AS empty_ratio,
       sum(CASE WHEN abs(x) < 0.05 THEN 1 ELSE 0 END) / COUNT(*) < 0.3 AS keep
FROM {EMB_LONG} GROUP BY dim""")
def q_empty_ratio_prune(spark, sf_dir):
    # embeddings have no exact zeros: |x| < 0.05 plays "blank pixel";
    # threshold 0.3 sits inside the observed ratio range so both outcomes occur
    sel = feat.select_informative(emb_long(spark, sf_dir, with_label=False), 0.3,
                                  is_empty=F.abs(F.col("x")) < 0.05)
    return sel.select("dim", "n_rows", "n_empty", r6("empty_ratio").alias("empty_ratio"), "keep")


@register("null_fill", """
SELECT d.doc_id, CAST(coalesce(l.quality, 0) AS INTEGER) AS quality, CAST(coalesce(l.toxic, 0) AS INTEGER) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_null_fill(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["doc_id"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return feat.fill_nulls(docs.join(labels, "doc_id", "left"), 0, ["quality", "toxic"])


@register("ink_density", """
WITH r AS (SELECT label,
                  len(list_filter(embedding, lambda v: v::DOUBLE > 0)) / len(embedding) AS ink_ratio,
                  list_sum(list_transform(embedding, lambda v: v::DOUBLE)) / len(embedding) AS mean_value
           FROM embeddings)
SELECT label, COUNT(*) AS n, round(avg(ink_ratio), 6) AS avg_ink_ratio, round(avg(mean_value), 6) AS avg_mean_value
FROM r GROUP BY label""")
def q_ink_density(spark, sf_dir):
    d = stats.ink_density(emb(spark, sf_dir))
    return d.select("label", "n", r6("avg_ink_ratio").alias("avg_ink_ratio"),
                    r6("avg_mean_value").alias("avg_mean_value"))


@register("minmax_scale", f"""
WITH l AS {EMB_LONG},
     b AS (SELECT dim, min(x) AS lo, max(x) AS hi FROM l GROUP BY dim)
SELECT l.vec_id, l.dim, round(CASE WHEN b.hi = b.lo THEN 0.5 ELSE (l.x - b.lo) / (b.hi - b.lo) END, 6) AS scaled
FROM l JOIN b ON l.dim = b.dim""")
def q_minmax_scale(spark, sf_dir):
    e = emb(spark, sf_dir).select("vec_id", "embedding")
    lo, hi = feat.minmax_fit(e, "embedding")
    s = feat.minmax_scale_array(e, "embedding", lo, hi)
    return s.select("vec_id", F.posexplode("scaled").alias("dim", "s")).select("vec_id", "dim", r6("s").alias("scaled"))


@register("content_hash", "SELECT doc_id, sha256(text) AS content_key FROM documents")
def q_content_hash(spark, sf_dir):
    from tabula.functions.hashing import content_key

    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return docs.select("doc_id", content_key(F.col("text")).alias("content_key"))


# ---------------------------------------------------------------- splits and samples

def _md5_int_sql(expr: str) -> str:
    return f"('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8))::BIGINT"


@register("hash_sample", f"""
SELECT vec_id, label FROM embeddings WHERE {_md5_int_sql('vec_id')} / 4294967296.0 < 0.2""")
def q_hash_sample(spark, sf_dir):
    from tabula.operators.split import hash_sample

    return hash_sample(emb(spark, sf_dir).select("vec_id", "label"), F.col("vec_id"), 0.2)


@register("hash_split", f"""
SELECT doc_id, CASE WHEN {_md5_int_sql('text')} % 5 = 0 THEN 'validation' ELSE 'train' END AS split
FROM documents""")
def q_hash_split(spark, sf_dir):
    from tabula.operators.split import with_split

    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return with_split(docs, F.col("text"), 5, 0).select("doc_id", "split")


@register("split_balance", f"""
WITH s AS (SELECT sha256(text) AS k,
                  CASE WHEN {_md5_int_sql('text')} % 5 = 0 THEN 'validation' ELSE 'train' END AS split
           FROM documents)
SELECT split, COUNT(*) AS n_rows, COUNT(DISTINCT k) AS n_distinct_content FROM s GROUP BY split""")
def q_split_balance(spark, sf_dir):
    from tabula.functions.hashing import content_key
    from tabula.operators.split import with_split

    docs = read_table(spark, sf_dir, "documents", ["text"])
    s = with_split(docs, F.col("text"), 5, 0).select("split", content_key(F.col("text")).alias("k"))
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("k").alias("n_distinct_content"))


@register("sample_images", f"""
WITH pick AS (SELECT vec_id, label, embedding FROM embeddings
              ORDER BY {_md5_int_sql('vec_id')}, vec_id LIMIT 10)
SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dim,
       CAST((generate_subscripts(embedding, 1) - 1) // {GRID_WIDTH} AS INTEGER) AS row,
       CAST((generate_subscripts(embedding, 1) - 1) % {GRID_WIDTH} AS INTEGER) AS col,
       round(unnest(embedding)::DOUBLE, 6) AS x
FROM pick""")
def q_sample_images(spark, sf_dir):
    from tabula.operators.split import sample_rows

    picked = sample_rows(emb(spark, sf_dir), F.col("vec_id"), 10)
    long_df = feat.vector_to_long(picked, "embedding", "vec_id", "label")
    return long_df.select("vec_id", "label", "dim", *feat.grid_position("dim", GRID_WIDTH), r6("x").alias("x"))


# ---------------------------------------------------------------- evaluation
# Stand-in classifier on the embeddings fixture: predicted class = argmax of
# dims 0-9 (SURVEY 5.3: labels are unrelated to the vectors, so only the
# arithmetic is checked, never the accuracy level).

def emb_predictions(spark, sf_dir, block: int = 0) -> DataFrame:
    from tabula.functions.scoring import argmax, as_double_array, softmax

    logits = F.slice(as_double_array(F.col("embedding")), 10 * block + 1, 10)
    probs = softmax(logits)
    return emb(spark, sf_dir).select("vec_id", "label", argmax(logits).alias("prediction"),
                                     probs.alias("probability"))


_PRED_SQL = """
WITH s AS (SELECT vec_id, label, list_transform(embedding[1:10], lambda v: v::DOUBLE) AS l FROM embeddings),
     pr AS (SELECT vec_id, label, l, list_max(l) AS m FROM s),
     pred AS (SELECT vec_id, label, CAST(list_position(l, m) - 1 AS INTEGER) AS prediction,
                     list_transform(l, lambda v: exp(v - m)) AS e FROM pr),
     counts AS (SELECT label, prediction, COUNT(*) AS count FROM pred GROUP BY label, prediction),
     grid AS (SELECT a.i::INTEGER AS label, b.i::INTEGER AS prediction FROM range(10) a(i), range(10) b(i))"""

_CLASS_TOTALS_SQL = """,
     cls AS (SELECT i::INTEGER AS label FROM range(10) t(i)),
     tot AS (SELECT cls.label,
                    coalesce((SELECT sum(count) FROM counts c WHERE c.label = cls.label AND c.prediction = cls.label), 0) AS tp,
                    coalesce((SELECT sum(count) FROM counts c WHERE c.label = cls.label), 0) AS actual,
                    coalesce((SELECT sum(count) FROM counts c WHERE c.prediction = cls.label), 0) AS predicted
             FROM cls),
     m AS (SELECT label, actual,
                  CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
                  CASE WHEN actual = 0 THEN 0.0 ELSE tp / actual END AS recall FROM tot),
     m2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                           ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM m)"""


@register("confusion_matrix", _PRED_SQL + """
SELECT grid.label, grid.prediction, CAST(coalesce(counts.count, 0) AS BIGINT) AS count
FROM grid LEFT JOIN counts ON grid.label = counts.label AND grid.prediction = counts.prediction""")
def q_confusion_matrix(spark, sf_dir):
    from tabula.operators import evaluate as ev

    counts = ev.label_prediction_counts(emb_predictions(spark, sf_dir))
    return ev.confusion_long(spark, counts, CLASSES)


@register("confusion_matrix_wide", _PRED_SQL + ", " + """
     dense AS (SELECT grid.label, grid.prediction, coalesce(counts.count, 0) AS count
               FROM grid LEFT JOIN counts ON grid.label = counts.label AND grid.prediction = counts.prediction)
SELECT label, """ + ", ".join(f'CAST(sum(CASE WHEN prediction = {c} THEN count END) AS BIGINT) AS "{c}"'
                              for c in CLASSES) + ", CAST(0 AS BIGINT) AS other FROM dense GROUP BY label")
def q_confusion_matrix_wide(spark, sf_dir):
    from tabula.operators import evaluate as ev

    counts = ev.label_prediction_counts(emb_predictions(spark, sf_dir))
    return ev.confusion_wide(ev.confusion_long(spark, counts, CLASSES), CLASSES)


@register("class_metrics", _PRED_SQL + _CLASS_TOTALS_SQL + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(actual AS BIGINT) AS support FROM m2""")
def q_class_metrics(spark, sf_dir):
    from tabula.operators import evaluate as ev

    counts = ev.label_prediction_counts(emb_predictions(spark, sf_dir))
    m = ev.class_metrics(counts, CLASSES, spark)
    return m.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"), "support")


@register("overall_metrics", _PRED_SQL + _CLASS_TOTALS_SQL + """
SELECT round(sum(tp) / sum(actual), 6) AS accuracy,
       round(sum(actual * f1) / sum(actual), 6) AS f1,
       round(sum(actual * precision) / sum(actual), 6) AS weighted_precision,
       round(sum(actual * recall) / sum(actual), 6) AS weighted_recall,
       CAST(sum(actual) AS BIGINT) AS n
FROM m2 JOIN tot USING (label, actual)""")
def q_overall_metrics(spark, sf_dir):
    from tabula.operators import evaluate as ev

    counts = ev.label_prediction_counts(emb_predictions(spark, sf_dir))
    m = ev.overall_metrics(counts)
    return m.select(*[r6(c).alias(c) for c in ("accuracy", "f1", "weighted_precision", "weighted_recall")], "n")


@register("binary_class_metrics", """
WITH counts AS (SELECT quality AS label, toxic AS prediction, COUNT(*) AS count FROM labels GROUP BY 1, 2),
     cls AS (SELECT i::INTEGER AS label FROM range(2) t(i)),
     tot AS (SELECT cls.label,
                    coalesce((SELECT sum(count) FROM counts c WHERE c.label = cls.label AND c.prediction = cls.label), 0) AS tp,
                    coalesce((SELECT sum(count) FROM counts c WHERE c.label = cls.label), 0) AS actual,
                    coalesce((SELECT sum(count) FROM counts c WHERE c.prediction = cls.label), 0) AS predicted
             FROM cls),
     m AS (SELECT label, actual,
                  CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
                  CASE WHEN actual = 0 THEN 0.0 ELSE tp / actual END AS recall FROM tot)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1,
       CAST(actual AS BIGINT) AS support FROM m""")
def q_binary_class_metrics(spark, sf_dir):
    from tabula.operators import evaluate as ev

    lab = read_table(spark, sf_dir, "labels", ["quality", "toxic"])
    counts = ev.label_prediction_counts(lab, label="quality", prediction="toxic")
    m = ev.class_metrics(counts, [0, 1], spark)
    return m.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"), "support")


@register("log_loss", _PRED_SQL + """,
     two AS (SELECT 'softmax' AS scorer, label, prediction, e[label + 1] / list_sum(e) AS p FROM pred
              UNION ALL SELECT 'one_hot' AS scorer, label, prediction, CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END FROM pred)
SELECT scorer, round(avg(-ln(greatest(p, 1e-15))), 6) AS loss,
       round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy, COUNT(*) AS n
FROM two GROUP BY scorer""")
def q_log_loss(spark, sf_dir):
    """D14 for the softmax probabilities and for the same predictions as
    certainties, whose misses have probability 0."""
    from tabula.operators import evaluate as ev

    soft = emb_predictions(spark, sf_dir)
    certain = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: (k == F.col("prediction")).cast("double"))
    scorers = F.array(F.struct(F.lit("softmax").alias("scorer"), F.col("probability").alias("p")),
                      F.struct(F.lit("one_hot").alias("scorer"), certain.alias("p")))
    both = soft.select("label", "prediction", F.inline(scorers))
    out = ev.log_loss(both, probs="p", by=["scorer"])
    return out.select("scorer", r6("loss").alias("loss"), r6("accuracy").alias("accuracy"), "n")


# Candidate scorers for model selection (E5) and a training history (E6),
# both derived from the data: candidate / epoch b predicts argmax of dims
# 10b .. 10b+9, b = 0..5, and is evaluated on the whole table in one pass.
N_BLOCKS = 6


def block_counts(spark, sf_dir) -> DataFrame:
    from tabula.functions.scoring import argmax, as_double_array
    from tabula.operators import evaluate as ev

    arr = as_double_array(F.col("embedding"))
    preds = F.array(*[argmax(F.slice(arr, 10 * b + 1, 10)) for b in range(N_BLOCKS)])
    exploded = emb(spark, sf_dir).select("label", F.posexplode(preds).alias("block", "prediction"))
    return ev.label_prediction_counts(exploded, by=["block"])


_BLOCK_SQL = "WITH s AS (SELECT label, list_transform(embedding, lambda v: v::DOUBLE) AS l FROM embeddings),\n" + \
    "     bp AS (" + "\n            UNION ALL ".join(
        f"SELECT {b} AS block, label, CAST(list_position(l[{10 * b + 1}:{10 * b + 10}], "
        f"list_max(l[{10 * b + 1}:{10 * b + 10}])) - 1 AS INTEGER) AS prediction FROM s" for b in range(N_BLOCKS)) + "),\n" + \
    """     counts AS (SELECT block, label, prediction, COUNT(*) AS count FROM bp GROUP BY 1, 2, 3),
     cls AS (SELECT DISTINCT block, label AS cls FROM counts UNION SELECT DISTINCT block, prediction FROM counts),
     tot AS (SELECT cls.block, cls.cls,
                    coalesce((SELECT sum(count) FROM counts c WHERE c.block = cls.block AND c.label = cls.cls AND c.prediction = cls.cls), 0) AS tp,
                    coalesce((SELECT sum(count) FROM counts c WHERE c.block = cls.block AND c.label = cls.cls), 0) AS actual,
                    coalesce((SELECT sum(count) FROM counts c WHERE c.block = cls.block AND c.prediction = cls.cls), 0) AS predicted
             FROM cls),
     m AS (SELECT block, actual, tp,
                  CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p,
                  CASE WHEN actual = 0 THEN 0.0 ELSE tp / actual END AS r FROM tot),
     res AS (SELECT block, sum(tp) / sum(actual) AS accuracy,
                    sum(actual * CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END) / sum(actual) AS f1
             FROM m GROUP BY block)"""


def block_results(spark, sf_dir) -> DataFrame:
    from tabula.operators import evaluate as ev

    m = ev.overall_metrics(block_counts(spark, sf_dir), by=["block"])
    return m.select(F.concat(F.lit("block_"), F.col("block").cast("string")).alias("model"),
                    F.col("block").alias("ordinal"), "accuracy", "f1", F.lit("ok").alias("status"))


@register("best_model", _BLOCK_SQL + """
SELECT 'block_' || CAST(block AS VARCHAR) AS model, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1
FROM res ORDER BY round(f1, 6) DESC, round(accuracy, 6) DESC, block ASC LIMIT 1""")
def q_best_model(spark, sf_dir):
    from tabula.operators import evaluate as ev

    best = ev.best_row(block_results(spark, sf_dir))
    return best.select("model", r6("accuracy").alias("accuracy"), r6("f1").alias("f1"))


@register("early_stop", _BLOCK_SQL + """,
     h AS (SELECT block + 1 AS epoch, accuracy FROM res),
     h1 AS (SELECT epoch, accuracy,
                   coalesce(accuracy > max(accuracy) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS improved
            FROM h),
     h2 AS (SELECT *, max(CASE WHEN improved THEN epoch END) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_epoch,
                   max(accuracy) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far
            FROM h1),
     h3 AS (SELECT *, CAST(epoch - best_epoch AS INTEGER) AS since_best FROM h2),
     h4 AS (SELECT *, min(CASE WHEN since_best >= 3 THEN epoch END) OVER () AS stop_epoch FROM h3)
SELECT CAST(epoch AS INTEGER) AS epoch, round(accuracy, 6) AS accuracy, improved, CAST(best_epoch AS INTEGER) AS best_epoch,
       since_best, round(best_so_far, 6) AS best_so_far, CAST(stop_epoch AS INTEGER) AS stop_epoch,
       coalesce(epoch = stop_epoch, false) AS stopped_here
FROM h4 WHERE stop_epoch IS NULL OR epoch <= stop_epoch""")
def q_early_stop(spark, sf_dir):
    from tabula.operators import evaluate as ev

    hist = block_results(spark, sf_dir).select(F.lit("argmax_blocks").alias("experiment"),
                                               (F.col("ordinal") + 1).cast("int").alias("epoch"), "accuracy")
    out = ev.early_stopping(hist, ["experiment"], patience=3)
    return out.select("epoch", r6("accuracy").alias("accuracy"), "improved", F.col("best_epoch").cast("int"),
                      "since_best", r6("best_so_far").alias("best_so_far"), F.col("stop_epoch").cast("int"),
                      "stopped_here")


# ---------------------------------------------------------------- scoring and decisions

_SOFTMAX_SQL = """
WITH s AS (SELECT vec_id, list_transform(embedding[1:10], lambda v: v::DOUBLE) AS l FROM embeddings),
     pr AS (SELECT vec_id, l, list_max(l) AS m FROM s),
     sc AS (SELECT vec_id, CAST(list_position(l, m) - 1 AS INTEGER) AS digit,
                   1.0 / list_sum(list_transform(l, lambda v: exp(v - m))) AS confidence FROM pr)"""


def emb_scored(spark, sf_dir) -> DataFrame:
    from tabula.plans.score import score_logits

    return score_logits(emb(spark, sf_dir), "embedding", id_col="vec_id", first=0, n_classes=10)


@register("softmax_argmax", _SOFTMAX_SQL + """
SELECT vec_id, digit, round(confidence, 6) AS confidence,
       digit BETWEEN 0 AND 9 AND confidence BETWEEN 0 AND 1 AS valid FROM sc""")
def q_softmax_argmax(spark, sf_dir):
    s = emb_scored(spark, sf_dir)
    return s.select("vec_id", "digit", r6("confidence").alias("confidence"), "valid")


def _decision_sql(threshold: float) -> str:
    return _SOFTMAX_SQL + f""",
     base AS (SELECT vec_id // 5 AS group_no, CAST(vec_id % 5 + 1 AS INTEGER) AS position, digit, confidence FROM sc),
     g0 AS (SELECT 'whole:' || group_no AS group_id, position, digit, confidence FROM base
            UNION ALL SELECT 'short:' || group_no, position, digit, confidence FROM base WHERE position < 5
            UNION ALL SELECT 'no digit:' || group_no, position, CASE WHEN position <> 3 THEN digit END, confidence FROM base
            UNION ALL SELECT 'no confidence:' || group_no, position, digit, CASE WHEN position <> 2 THEN confidence END FROM base
            UNION ALL SELECT 'far:' || group_no, CASE WHEN position = 5 THEN 70 ELSE position END, digit, confidence FROM base),
     g AS (SELECT *, min(confidence) OVER (PARTITION BY group_id) AS gmin FROM g0),
     a AS (SELECT group_id, COUNT(*) AS n_predictions, min(confidence) AS gc,
                  min(position) FILTER (WHERE confidence = gmin) AS wp,
                  string_agg(CAST(digit AS VARCHAR), '' ORDER BY position) AS code,
                  count(digit) = 5 AND count(confidence) = 5 AND count(*) = 5 AND max(position) = 5
                  AND count(DISTINCT position) = 5 AS valid
           FROM g GROUP BY group_id)
SELECT group_id, n_predictions, valid, CASE WHEN valid THEN code END AS postal_code,
       round(gc, 6) AS global_confidence,
       CASE WHEN NOT valid THEN NULL WHEN gc < {threshold} THEN 'review' ELSE 'auto' END AS decision,
       CASE WHEN NOT valid THEN NULL WHEN gc < {threshold} THEN 'Vérification humaine' ELSE 'Tri automatique' END AS decision_label,
       wp AS weakest_position,
       CASE WHEN valid AND gc < {threshold} THEN 'Le chiffre en position ' || CAST(wp AS VARCHAR) || ' n''atteint que '
            || CAST(CAST(round_even(gc * 100, 0) AS BIGINT) AS VARCHAR) || '% de confiance.' END AS review_reason
FROM a"""


def _group_decision(spark, sf_dir, threshold):
    from tabula.operators.decide import group_analysis

    base = emb_scored(spark, sf_dir).select(
        F.floor(F.col("vec_id") / 5).cast("bigint").alias("group_no"),
        (F.pmod(F.col("vec_id"), F.lit(5)) + 1).cast("int").alias("position"), "digit", "confidence")
    # besides every whole group: the same groups cut short, with a missing digit
    # or confidence, and with a position far outside, all of which are invalid
    p = F.col("position")
    case = lambda name, **new: F.struct(F.lit(name).alias("name"), *[
        new.get(c, F.col(c)).alias(c) for c in ("position", "digit", "confidence")])
    cases = F.array(case("whole"), F.when(p < 5, case("short")), case("no digit", digit=F.when(p != 3, F.col("digit"))),
                    case("no confidence", confidence=F.when(p != 2, F.col("confidence"))),
                    case("far", position=F.when(p == 5, F.lit(70)).otherwise(p)))
    s = base.select("group_no", F.explode(F.filter(cases, lambda c: c.isNotNull())).alias("c")).select(
        F.concat_ws(":", "c.name", "group_no").alias("group_id"), "c.position", "c.digit", "c.confidence")
    out = group_analysis(s, "group_id", threshold=threshold)
    return out.withColumn("global_confidence", r6("global_confidence"))


@register("group_decision", _decision_sql(0.8))
def q_group_decision(spark, sf_dir):
    # groups of five consecutive vec_id stand for five digits of one code
    return _group_decision(spark, sf_dir, 0.8)


@register("group_decision_mixed", _decision_sql(0.12))
def q_group_decision_mixed(spark, sf_dir):
    # same rule with a threshold inside the fixture's confidence range
    # (0.106-0.149), so both the automatic and the review branch occur
    return _group_decision(spark, sf_dir, 0.12)


# ---------------------------------------------------------------- column runs
# Each embedding row is a 64-column strip; a column is "inked" when x > 0.05.

_STRIP_SQL = f"""
WITH p AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim,
                  CASE WHEN unnest(embedding)::DOUBLE > 0.05 THEN 1 ELSE 0 END AS occupied FROM embeddings),
     d AS (SELECT vec_id, dim, occupied,
                  max(occupied) OVER (PARTITION BY vec_id ORDER BY dim ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS dilated
           FROM p),
     isl AS (SELECT vec_id, dim, dim - row_number() OVER (PARTITION BY vec_id ORDER BY dim) AS grp FROM d WHERE dilated > 0),
     runs AS (SELECT vec_id, min(dim) AS start, max(dim) + 1 AS "end" FROM isl GROUP BY vec_id, grp
              HAVING max(dim) + 1 - min(dim) >= 2)"""


def strips(spark, sf_dir) -> DataFrame:
    """(vec_id, occupied): one 64-column strip per embedding row."""
    return emb(spark, sf_dir).select("vec_id", F.transform("embedding", lambda v: (v.cast("double") > 0.05).cast("int")).alias("occupied"))


def strip_runs(spark, sf_dir) -> DataFrame:
    from tabula.operators import runs

    return strips(spark, sf_dir).select(
        "vec_id", "occupied", runs.closed_runs(F.col("occupied"), F.lit(runs.closing_width(N_DIMS))).alias("runs"))


@register("dilate_runs", _STRIP_SQL + """
SELECT vec_id, dim, occupied, dilated FROM d""")
def q_dilate_runs(spark, sf_dir):
    from tabula.operators import runs

    d = strips(spark, sf_dir).withColumn("dilated", runs.dilated(F.col("occupied"), runs.closing_width(N_DIMS)))
    return d.select("vec_id", F.posexplode(F.arrays_zip("occupied", "dilated")).alias("dim", "both")).select("vec_id", "dim", "both.*")


@register("detect_runs", _STRIP_SQL + """
SELECT vec_id, CAST(start AS INTEGER) AS start, CAST("end" AS INTEGER) AS "end" FROM runs""")
def q_detect_runs(spark, sf_dir):
    from tabula.operators import runs

    d = strips(spark, sf_dir).select("vec_id", runs.runs_of(
        runs.dilated(F.col("occupied"), runs.closing_width(N_DIMS)), runs.SHORTEST_RUN).alias("runs"))
    return runs.run_rows(d, "runs", "vec_id").drop("run_index")


_MERGED_SQL = _STRIP_SQL + """,
     g AS (SELECT *, start - lag("end") OVER (PARTITION BY vec_id ORDER BY start) AS gap FROM runs),
     b AS (SELECT *, CASE WHEN gap IS NULL THEN 1
                          WHEN row_number() OVER (PARTITION BY vec_id ORDER BY gap DESC NULLS LAST, start DESC) <= 4 THEN 1
                          ELSE 0 END AS boundary FROM g),
     s AS (SELECT *, sum(boundary) OVER (PARTITION BY vec_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM b),
     m AS (SELECT vec_id, min(start) AS start, max("end") AS "end" FROM s GROUP BY vec_id, seg)"""
_RUN_ROWS_SQL = """
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY start) AS INTEGER) AS run_index,
       CAST(start AS INTEGER) AS start, CAST("end" AS INTEGER) AS "end" FROM """


@register("merge_runs", _MERGED_SQL + _RUN_ROWS_SQL + "m")
def q_merge_runs(spark, sf_dir):
    from tabula.operators import runs

    return runs.run_rows(strip_runs(spark, sf_dir).withColumn("runs", runs.merged(F.col("runs"), 5)), "runs", "vec_id")


def _split_round_sql(k: int) -> str:
    """One round of E4: per strip with fewer than five runs, the widest run (the
    first of equals) is cut at its valley where the rule allows it."""
    return f""",
     w{k} AS (SELECT vec_id, start, "end", "end" - start AS w, count(*) OVER (PARTITION BY vec_id) AS n,
                     row_number() OVER (PARTITION BY vec_id ORDER BY "end" - start DESC, start) AS rk FROM r{k - 1}),
     c{k} AS (SELECT vec_id, start, "end", start + greatest(3, CAST(floor(w * 0.25) AS BIGINT)) AS lo,
                     start + least(w - 3, CAST(floor(w * 0.75) AS BIGINT)) AS hi FROM w{k} WHERE rk = 1 AND n < 5 AND w >= 8),
     v{k} AS (SELECT c.vec_id, c.start, c."end",
                     min(p.occupied * 1000 + p.dim) FILTER (WHERE p.dim >= c.lo AND p.dim < c.hi) AS low, max(p.occupied) AS peak
              FROM c{k} c JOIN p ON p.vec_id = c.vec_id AND p.dim >= c.start AND p.dim < c."end"
              WHERE c.lo < c.hi GROUP BY 1, 2, 3),
     x{k} AS (SELECT vec_id, start, "end", low % 1000 AS cut FROM v{k} WHERE peak > 0 AND low // 1000 <= peak * 0.35),
     r{k} AS (SELECT vec_id, start, "end" FROM r{k - 1} ANTI JOIN x{k} USING (vec_id, start)
              UNION ALL SELECT vec_id, start, cut FROM x{k} UNION ALL SELECT vec_id, cut, "end" FROM x{k})"""


@register("split_runs", _MERGED_SQL + """,
     r0 AS (SELECT vec_id, start, "end" FROM m)""" + "".join(_split_round_sql(k) for k in range(1, 5)) + _RUN_ROWS_SQL + "r4")
def q_split_runs(spark, sf_dir):
    """E4 on the strips: after merging, strips with fewer than five runs get
    their widest run cut at an ink valley, again and again."""
    from tabula.operators import runs

    cut = strip_runs(spark, sf_dir).withColumn(
        "runs", runs.split_wide(runs.merged(F.col("runs"), 5), F.col("occupied"), 5))
    return runs.run_rows(cut, "runs", "vec_id")


# ---------------------------------------------------------------- incremental and streaming scoring

MODEL_TAG = "argmax10"


@register("score_incremental", f"""
WITH k AS (SELECT doc_id, sha256(sha256(text) || ':{MODEL_TAG}:false') AS memo_key FROM documents),
     done AS (SELECT DISTINCT k.memo_key FROM k JOIN labels l ON k.doc_id = l.doc_id)
SELECT doc_id, memo_key FROM k WHERE memo_key NOT IN (SELECT memo_key FROM done)""")
def q_score_incremental(spark, sf_dir):
    """Documents whose memo key (content hash + model + option) has no
    stored result yet. "Already scored" = documents that have a labels row.
    Anti-join on the key: a shuffle join of keys, no broadcast of the store."""
    from tabula.plans.score import memo_key, pending

    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    keyed = docs.select("doc_id", memo_key(F.col("text"), MODEL_TAG, False).alias("memo_key"))
    # the store side: semi-join first, so only the labelled documents' texts are hashed again
    labelled = docs.join(read_table(spark, sf_dir, "labels", ["doc_id"]), "doc_id", "left_semi")
    scored = labelled.select(memo_key(F.col("text"), MODEL_TAG, False).alias("memo_key"))
    return pending(keyed, scored, "memo_key")


_STORED_SQL = ORACLE["score_incremental"]


@register("result_store_pending", _STORED_SQL)
def q_result_store_pending(spark, sf_dir):
    """The same question to a result store that was filled in three appends,
    compacted after the second: only touched prefixes are read, the Bloom
    filters rule out most new keys, the keys themselves decide."""
    from tabula.plans.result_store import ResultStore
    from tabula.plans.score import memo_key

    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    keyed = docs.select("doc_id", memo_key(F.col("text"), MODEL_TAG, False).alias("memo_key"))
    labelled = docs.join(read_table(spark, sf_dir, "labels", ["doc_id"]), "doc_id", "left_semi")
    done = labelled.select(memo_key(F.col("text"), MODEL_TAG, False).alias("memo_key"), "doc_id")
    store = ResultStore(spark, _run_path(spark, "results"), "memo_key string, doc_id long", prefix_chars=1)
    for i in range(3):
        store.append(done.filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == i))
        if i == 1:
            store.compact()
    return store.pending(keyed)


@register("file_listing", """
SELECT coalesce(lang, '__HIVE_DEFAULT_PARTITION__') AS lang, count(DISTINCT lang IS NULL) AS n_files,
       CAST(sum(octet_length(encode(coalesce(text, ''))) + 1) AS BIGINT) AS n_bytes
FROM documents GROUP BY lang""")
def q_file_listing(spark, sf_dir):
    """Files written from the documents, one a language, listed again by the
    tasks of the listing source, a directory each."""
    from tabula.sources.listing import list_files
    from tabula.sources.whole_files import write_whole_files

    path = _run_path(spark, "files")
    write_whole_files(spark, read_table(spark, sf_dir, "documents", ["lang", "text"]), "lang", path)
    lang = F.regexp_extract("path", "/lang=([^/]*)/", 1)
    return list_files(spark, path, glob="*.txt").groupBy(lang.alias("lang")).agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


@register("stream_score_equals_batch", _SOFTMAX_SQL + """
SELECT vec_id, digit, round(confidence, 6) AS confidence FROM sc""")
def q_stream_score_equals_batch(spark, sf_dir):
    """The same scorer as a Structured Streaming query (file source over
    the table's directory, availableNow trigger, Parquet sink with a
    checkpoint in the shared checkpoint folder); returns the sink's rows."""
    from tabula.streaming.score_stream import run_scoring_stream

    out = run_scoring_stream(spark, sf_dir, table="embeddings")
    return out.select("vec_id", "digit", r6("confidence").alias("confidence"))


@register("stream_group_decision", _SOFTMAX_SQL + """,
     base AS (SELECT vec_id // 5 AS group_no, CAST(vec_id % 5 + 1 AS INTEGER) AS position, digit, confidence FROM sc),
     g AS (SELECT 'whole:' || group_no AS group_id, position, digit, confidence FROM base
           UNION ALL SELECT 'short:' || group_no, position, digit, confidence FROM base WHERE position < 5
           UNION ALL SELECT 'twice:' || group_no, position, digit, confidence FROM base
           UNION ALL SELECT 'twice:' || group_no, position, digit, confidence FROM base WHERE position = 2),
     m AS (SELECT *, min(confidence) OVER (PARTITION BY group_id) AS gmin FROM g),
     a AS (SELECT group_id, COUNT(*) AS n_predictions, min(confidence) AS gc,
                  min(position) FILTER (WHERE confidence = gmin) AS wp,
                  string_agg(CAST(digit AS VARCHAR), '' ORDER BY position) AS code,
                  count(*) = 5 AND count(DISTINCT position) = 5 AND max(position) = 5 AS valid
           FROM m GROUP BY group_id)
SELECT group_id, n_predictions, valid, CASE WHEN valid THEN code END AS postal_code, round(gc, 6) AS global_confidence,
       CASE WHEN valid AND gc >= 0.12 THEN 'auto' ELSE 'review' END AS decision,
       CASE WHEN valid AND gc >= 0.12 THEN 'Tri automatique' ELSE 'Vérification humaine' END AS decision_label,
       wp AS weakest_position,
       CASE WHEN valid AND gc < 0.12 THEN 'Le chiffre en position ' || CAST(wp AS VARCHAR) || ' n''atteint que '
            || CAST(CAST(round_even(gc * 100, 0) AS BIGINT) AS VARCHAR) || '% de confiance.' END AS review_reason
FROM a""")
def q_stream_group_decision(spark, sf_dir):
    """Digits arrive one file after another, so every group is split over
    several micro-batches; a keyed state decides it when it is whole. Groups
    cut short and groups with a digit twice are for review."""
    from tabula.streaming.decide_stream import RESULTS, run_decision_stream

    group_no = F.floor(F.col("vec_id") / 5).cast("bigint")
    place = (F.pmod(F.col("vec_id"), F.lit(5)) + 1).cast("int")
    names = F.array(F.lit("whole"), F.when(place < 5, F.lit("short")), F.lit("twice"), F.when(place == 2, F.lit("twice")))
    rows = emb(spark, sf_dir).select("vec_id", "embedding", place.alias("position"), group_no.alias("group_no"),
                                     F.explode(F.filter(names, lambda c: c.isNotNull())).alias("name"))
    rows = rows.select("vec_id", "embedding", "position", F.concat_ws(":", "name", "group_no").alias("group_id"),
                       F.timestamp_seconds(F.col("group_no") * 60 + F.col("position")).alias("scanned_at"))
    arrived = _run_path(spark, "arrived")
    # a micro-batch is one file: small row groups spread it over tasks
    rows.repartitionByRange(4, "position").write.option("parquet.block.size", 4 << 20).parquet(f"{arrived}/digits.parquet")
    out = run_decision_stream(spark, arrived, "digits", "group_id", "position", "scanned_at", "vec_id", threshold=0.12,
                              max_files_per_trigger=1, lateness="1000 days")
    return out.select("group_id", *RESULTS).withColumn("global_confidence", r6("global_confidence"))


# ---------------------------------------------------------------- CSV sources

@register("csv_round_trip", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def q_csv_round_trip(spark, sf_dir):
    """Write the part table as header CSV and read it back with an
    explicit schema (no inference pass)."""
    import uuid

    from tabula.session import scratch_path
    from tabula.sources.tables import load_csv

    part = read_table(spark, sf_dir, "part")
    path = scratch_path(spark, "csv", uuid.uuid4().hex[:12], "part")
    part.write.mode("overwrite").option("header", "true").csv(path)
    schema = ("p_partkey bigint, p_name string, p_brand string, p_type string, "
              "p_size int, p_retailprice double")
    return load_csv(spark, path, schema=schema)


_TYPED_SQL = ("SELECT label::DOUBLE AS label, vec_id::DOUBLE AS vec_id, " + ", ".join(
    f"round(embedding[{i + 1}]::DOUBLE, 6) AS pixel{i}" for i in range(N_DIMS)) + " FROM embeddings")


@register("csv_typed_read", _TYPED_SQL)
def q_csv_typed_read(spark, sf_dir):
    """A labelled wide CSV (label, pixel0..pixel63 written in
    shuffled column order) read back by the typed reader: label first,
    features ordered by the number in their name, every column double.
    ``vec_id`` has no number, so it sorts first among the features."""
    import uuid

    from tabula.session import scratch_path
    from tabula.sources.tables import read_labelled_csv

    e = emb(spark, sf_dir)
    order = [f"pixel{i}" for i in range(N_DIMS)][::-1]
    wide = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"pixel{i}") for i in range(N_DIMS)],
                    "label").select("vec_id", *order, "label")
    path = scratch_path(spark, "csv", uuid.uuid4().hex[:12], "digits")
    wide.write.mode("overwrite").option("header", "true").csv(path)
    typed = read_labelled_csv(spark, path, has_label=True)
    return typed.select("label", "vec_id", *[r6(f"pixel{i}").alias(f"pixel{i}") for i in range(N_DIMS)])


# ---------------------------------------------------------------- MLlib preparation, models, scoring
# Not SQL-expressible: rows-only checks here, property tests in tests/.

def emb_content():
    """Label and features spelled the same way in any SQL engine."""
    cells = F.transform("embedding", lambda v: F.floor(v.cast("double") * 1000000).cast("bigint").cast("string"))
    return F.concat_ws(":", F.col("label").cast("string"), F.array_join(cells, ","))


_SIDES_SQL = f"""
WITH c AS (SELECT embedding, label || ':' || array_to_string(list_transform(embedding,
                  lambda v: CAST(floor(v::DOUBLE * 1000000) AS BIGINT)), ',') AS content FROM embeddings),
     s AS (SELECT embedding, {_md5_int_sql('content')} % 5 = 0 AS held FROM c),
     n AS (SELECT count(*) FILTER (WHERE NOT held) AS train_rows, count(*) FILTER (WHERE held) AS validation_rows FROM s)"""


def _prepared(spark, sf_dir, config, save: bool = True):
    from tabula.plans.prepare import run_configuration

    return run_configuration(spark, emb(spark, sf_dir), config, key_col="vec_id", vector_col="embedding",
                             n_features=N_DIMS, save=save, split_key=emb_content())


@register("prepare_configs", _SIDES_SQL + f""",
     z AS (SELECT generate_subscripts(embedding, 1) AS dim, unnest(embedding) AS x FROM s WHERE NOT held),
     k AS (SELECT count(*) AS kept FROM (SELECT dim FROM z GROUP BY dim
                  HAVING count(*) FILTER (WHERE x = 0) / count(*) < 0.98))
SELECT t.configuration, CAST(CASE WHEN t.prunes THEN k.kept ELSE {N_DIMS} END AS INTEGER) AS kept_columns,
       CAST(CASE WHEN t.pca THEN least(50, k.kept) WHEN t.prunes THEN k.kept ELSE {N_DIMS} END AS INTEGER) AS feature_dimension,
       n.train_rows, n.validation_rows
FROM n, k, (VALUES ('raw', false, false), ('normalized', false, false), ('normalized_compact', true, false),
                   ('normalized_compact_pca', true, true)) t(configuration, prunes, pca)""")
def q_prepare_configs(spark, sf_dir):
    """The four reference configurations on the embeddings table
    (blank = |x| < 0.05 is not used here: the reference prunes exact zeros)."""
    from tabula.plans.prepare import DEFAULT_CONFIGS, summary_frame

    from concurrent.futures import ThreadPoolExecutor

    # the four preparations are independent jobs: submit them from four
    # driver threads so they share the cluster instead of queueing
    with ThreadPoolExecutor(max_workers=len(DEFAULT_CONFIGS)) as pool:
        rows = [r["summary"] for r in pool.map(lambda c: _prepared(spark, sf_dir, c), DEFAULT_CONFIGS)]
    return summary_frame(spark, rows).select("configuration", "kept_columns", "feature_dimension",
                                             "train_rows", "validation_rows")


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    """H4-H8/E5: LR, DT, RF and MLP on the normalised + PCA preparation,
    fitted on the train side of the content-hash split, scored on the other."""
    from tabula.plans.models import build_classifiers, compare_models
    from tabula.plans.prepare import DEFAULT_CONFIGS

    prep = _prepared(spark, sf_dir, DEFAULT_CONFIGS[3], save=False)  # fitted, not written
    data = prep["prepared"]
    train, val = data.filter("split = 'train'"), data.filter("split = 'validation'")
    dim = prep["summary"]["feature_dimension"]
    comp = compare_models(spark, train, val, build_classifiers(dim), parallelism=4)
    return comp.results.select("model", "ordinal", "accuracy", "f1", "weighted_precision",
                               "weighted_recall", "status")


@register("model_comparison_checks", _SIDES_SQL + """
SELECT t.model, CAST(t.ordinal AS INTEGER) AS ordinal, 'ok' AS status, n.validation_rows AS n,
       true AS recall_is_accuracy, true AS in_range
FROM n, (VALUES ('logistic_regression', 0), ('decision_tree', 1), ('random_forest', 2)) t(model, ordinal)""")
def q_model_comparison_checks(spark, sf_dir):
    """H8/D13 on fitted models: every model is evaluated on the whole validation
    side, its weighted recall is its accuracy, and all metrics are shares."""
    from functools import reduce

    from tabula.operators import evaluate as ev
    from tabula.plans.models import build_classifiers, compare_models
    from tabula.plans.prepare import DEFAULT_CONFIGS

    prep = _prepared(spark, sf_dir, DEFAULT_CONFIGS[3])
    train, val = (prep["prepared"].filter(f"split = '{s}'") for s in ("train", "validation"))
    comp = compare_models(spark, train, val, build_classifiers(prep["summary"]["feature_dimension"], include_mlp=False),
                          parallelism=3)
    counts = reduce(DataFrame.unionAll, [c.withColumn("model", F.lit(m)) for m, c in comp.counts.items()])
    again = ev.overall_metrics(counts, by=["model"]).select("model", "n")
    share = lambda c: F.col(c).between(0.0, 1.0)
    return comp.results.join(again, "model").select(
        "model", "ordinal", "status", "n", (F.col("weighted_recall") == F.col("accuracy")).alias("recall_is_accuracy"),
        (share("accuracy") & share("f1") & share("weighted_precision")).alias("in_range"))


@register("neural_epochs", _SIDES_SQL + """
SELECT n.train_rows, n.validation_rows, true AS best_is_published, true AS stopped_by_rule, true AS loss_falls,
       true AS found_again FROM n""")
def q_neural_epochs(spark, sf_dir):
    """Epochs that go on from the weights before, stopped three epochs after
    the best one, whose model is the one published; loaded again, it has the
    accuracy and the loss that the history says."""
    from pyspark.ml.functions import vector_to_array

    from tabula.operators import evaluate as ev
    from tabula.plans import neural
    from tabula.plans.models import load_best
    from tabula.plans.prepare import DEFAULT_CONFIGS

    prep = _prepared(spark, sf_dir, DEFAULT_CONFIGS[1])
    train, val = (prep["prepared"].filter(f"split = '{s}'") for s in ("train", "validation"))
    root = _run_path(spark, "neural")
    run = neural.neural_run(spark, train, val, N_DIMS, len(CLASSES), root, prep["model"], min_accuracy=0.0, passes=5)
    pred = load_best(spark, f"{root}/models")[1].stages[-1].transform(val).withColumn("probability", vector_to_array("probability"))
    again = ev.log_loss(pred).first()  # one row
    # a row an epoch, all in one: the best one is the first of the highest accuracy
    h = run.history.agg(F.max("validation_accuracy").alias("top"), F.max("epoch").alias("last"),
                        F.min_by("epoch", F.struct(-F.col("validation_accuracy"), "epoch")).alias("best"),
                        F.max_by("train_loss", "epoch").alias("final_loss"), F.min_by("train_loss", "epoch").alias("first_loss"),
                        F.max_by("validation_loss", F.struct("validation_accuracy", -F.col("epoch"))).alias("its_loss"))
    return h.select(
        F.lit(run.train_rows).cast("long").alias("train_rows"), F.lit(again["n"]).cast("long").alias("validation_rows"),
        (F.col("best") == run.best_epoch).alias("best_is_published"),
        ((F.col("last") == F.col("best") + neural.PATIENCE) | (F.col("last") == 20)).alias("stopped_by_rule"),
        (F.col("final_loss") < F.col("first_loss")).alias("loss_falls"),
        ((F.abs(F.col("top") - again["accuracy"]) < 1e-9) & (F.abs(F.col("its_loss") - again["loss"]) < 1e-9)).alias("found_again"))


@register("pca_variance", f"""
SELECT count(*) AS n_rows, round(sum(v), 6) AS total_variance, round(sum(v), 6) AS captured_by_all,
       round(sum(v), 6) AS captured_and_left, true AS as_mllib, count(*) = {N_DIMS} AS full_width
FROM (SELECT dim, var_samp(x) AS v FROM {EMB_LONG} GROUP BY dim)""".replace("SELECT count(*) AS n_rows", "SELECT (SELECT count(*) FROM embeddings) AS n_rows"))
def q_pca_variance(spark, sf_dir):
    """Principal components without a width^2 matrix. All components hold
    the whole variance, eight hold what the distance to their reconstruction
    doesn't, and their variances are MLlib's."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    from tabula.operators import pca

    e = emb(spark, sf_dir).select(F.col("embedding").cast("array<double>").alias("v"))
    every, some = pca.fit(e, "v", N_DIMS), pca.fit(e, "v", 8)
    theirs = PCA(k=8, inputCol="x", outputCol="y").fit(e.select(array_to_vector("v").alias("x"))).explainedVariance.toArray()
    as_mllib = bool(abs(every.ratio[:8] - theirs).max() < 1e-9 and abs(some.ratio - theirs).max() < 2e-3)
    # variances along orthonormal components, and what is left beside them
    along = F.sum(F.aggregate("projected", F.lit(0.0), lambda t, y: t + y * y)).alias("along")
    sums = pca.project(e, "v", some).agg(F.sum("projected_error").alias("s"), F.count("projected").alias("n_rows"), along)
    return sums.select(
        "n_rows", F.round(F.lit(every.total_variance), 6).alias("total_variance"),
        F.round(F.lit(float(every.variance.sum())), 6).alias("captured_by_all"),
        F.round((F.col("along") + F.col("s")) / (F.col("n_rows") - 1), 6).alias("captured_and_left"),
        F.lit(as_mllib).alias("as_mllib"), F.lit(len(every.mean) == N_DIMS).alias("full_width"))


@register("batch_score_keys", """
SELECT vec_id, true AS valid FROM embeddings""")
def q_batch_score_keys(spark, sf_dir):
    """Every key of the table once, each with a valid prediction."""
    return q_batch_score(spark, sf_dir).select("vec_id", "valid")


@register("batch_score")
def q_batch_score(spark, sf_dir):
    """A fitted preparation + classifier PipelineModel scores every
    row of the table; the key is carried, never re-matched by order."""
    from pyspark.ml import Pipeline

    from tabula.plans.models import build_classifiers
    from tabula.plans.prepare import build_pipeline
    from tabula.plans.score import score_model

    e = emb(spark, sf_dir)
    prep = build_pipeline(list(range(N_DIMS)), True, None, vector_col="embedding")
    lr = build_classifiers(N_DIMS, include_mlp=False)[0][1]
    model = Pipeline(stages=[*prep.getStages(), lr]).fit(e.withColumn("label", F.col("label").cast("double")))
    return score_model(model, e, "vec_id")


@register("image_augment")
def q_image_augment(spark, sf_dir):
    """Two augmented copies of every embedding row viewed as an 8 x 8
    image, after the per-dim min-max scaling (G2) puts it in [0, 1]. Seeded
    per (row, copy), so retries and reruns give the same rows."""
    from tabula.operators.images import augment_copies

    e = emb(spark, sf_dir)
    lo, hi = feat.minmax_fit(e, "embedding")
    images = feat.minmax_scale_array(e, "embedding", lo, hi, out="pixels")
    return augment_copies(images, "vec_id", "label", "pixels", GRID_WIDTH, copies=2)


# ---------------------------------------------------------------- the same operators on other labelled tables

_LI_CLASS_SQL = "\nUNION ALL\n".join(
    f"SELECT l_returnflag AS label, '{c}' AS column, COUNT({c}) AS n, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max, "
    f"CAST(sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zeros FROM lineitem GROUP BY l_returnflag"
    for c in LINEITEM_NUMERIC)


@register("lineitem_class_stats", _LI_CLASS_SQL)
def q_lineitem_class_stats(spark, sf_dir):
    """D5 per class on a wide relational table: lineitem's numeric columns
    by return flag (label = l_returnflag)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_returnflag", *LINEITEM_NUMERIC])
    long_df = feat.dim_names(feat.wide_to_long(li.withColumnRenamed("l_returnflag", "label"), LINEITEM_NUMERIC,
                                               "l_orderkey", "label"), LINEITEM_NUMERIC)
    return _stats_out(stats.column_stats(long_df, by=("label", "column")), ["label", "column", "n"])


@register("event_class_stats", """
SELECT event_type AS label, COUNT(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(max(value), 6) AS max,
       CAST(sum(CASE WHEN value = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zeros
FROM events GROUP BY event_type""")
def q_event_class_stats(spark, sf_dir):
    """D5 on the events table with event_type as the class (one aggregation)."""
    ev_ = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value"]).withColumnRenamed("event_type", "label")
    long_df = feat.wide_to_long(ev_, ["value"], "event_id", "label")
    return _stats_out(stats.column_stats(long_df, by=("label",)), ["label", "n"])


# ---------------------------------------------------------------- image segmentation on rendered strips

def render_code_images(spark, sf_dir) -> DataFrame:
    """Every group of five consecutive embedding rows drawn as one 260 x 920
    white strip with five glyphs (each row's 8 x 8 grid, a cell inked when
    x > 0.05, 14 px per cell, glyph i at x = 55 + 175 i), in the decoded
    image-row shape the segmentation consumes (BGR bytes). Derived by Spark
    from the table, so the work grows with it."""
    from tabula.operators.images import draw_strips

    groups = (emb(spark, sf_dir)
              .select(F.floor(F.col("vec_id") / 5).cast("bigint").alias("group_id"),
                      (F.pmod(F.col("vec_id"), F.lit(5))).cast("int").alias("pos"), "embedding")
              # five rows per group: a bounded list
              .groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("pos", "embedding"))).alias("g")))

    # the groups are a few bytes each, so AQE would coalesce them into one
    # task, but every row costs tens of milliseconds of pixel work downstream:
    # spread them over the cluster explicitly (a fixed-count repartition is
    # not coalesced)
    n = max(8, 2 * spark.sparkContext.defaultParallelism)
    return groups.repartition(n).mapInPandas(draw_strips, "path string, height int, width int, n_channels int, "
                                                   "data binary, reject_reason string")


@register("image_segments")
def q_image_segments(spark, sf_dir):
    """I1-I8 + E1-E4 as one distributed job over rendered strips: one row per
    image with its reject reason (NULL = five digits found) and segment count."""
    from tabula.operators.images import segment_images

    segs, status = segment_images(render_code_images(spark, sf_dir))
    n = segs.groupBy("path").agg(F.count(F.lit(1)).alias("n_segments"))
    return status.join(n, "path", "left").select("path", "reject_reason",
                                                 F.coalesce("n_segments", F.lit(0)).alias("n_segments"))


@register("hash_split_native")
def q_hash_split_native(spark, sf_dir):
    """F5 in the reference's native form: pmod(xxhash64(label, features), 5),
    bucket 0 = validation, so identical (label, vector) rows share a side.
    DuckDB has no xxhash64: rows-only; tests check disjointness and that
    equal content always lands together."""
    from tabula.operators.split import with_split

    e = emb(spark, sf_dir)
    content = F.struct(F.col("label"), F.col("embedding"))
    return with_split(e, content, 5, 0, method="xxhash").select("vec_id", "label", "split")


@register("statistics_reuse", f"""
SELECT label, dim, round(avg(x), 6) AS mean FROM {EMB_LONG} GROUP BY label, dim""")
def q_statistics_reuse(spark, sf_dir):
    """SURVEY 3.1 / A11-A14 / A23: the four statistics tables written under a
    path keyed by the input's identity (files + schema), reused on later runs
    while they exist, and read back from storage - here the class means."""
    from tabula.plans.prepare import input_identity
    from tabula.plans.statistics import compute_statistics
    from tabula.session import scratch_path

    e = emb(spark, sf_dir)
    root = scratch_path(spark, "statistics", input_identity(spark, e))
    tables = compute_statistics(spark, feat.vector_to_long(e), e.select("label"), root)
    return tables["class_means"].select("label", "dim", r6("mean").alias("mean"))


# ---------------------------------------------------------------- report tables on the feature grid

@register("class_mean_image", f"""
SELECT label, dim, CAST(dim // {GRID_WIDTH} AS INTEGER) AS row, CAST(dim % {GRID_WIDTH} AS INTEGER) AS col,
       round(avg(x), 6) AS mean
FROM {EMB_LONG} GROUP BY label, dim""")
def q_class_mean_image(spark, sf_dir):
    """K3: the mean image of every class as (label, row, col, mean)."""
    m = stats.class_means(emb_long(spark, sf_dir)).withColumn("mean", r6("mean"))
    return stats.on_grid(m, GRID_WIDTH).select("label", "dim", "row", "col", "mean")


@register("pair_difference_image", f"""
WITH cm AS (SELECT label, dim, avg(x) AS m FROM {EMB_LONG} GROUP BY label, dim),
     p AS (SELECT * FROM (VALUES (1, 7), (3, 8), (4, 9)) t(label_a, label_b))
SELECT p.label_a, p.label_b, CAST(a.dim // {GRID_WIDTH} AS INTEGER) AS row,
       CAST(a.dim % {GRID_WIDTH} AS INTEGER) AS col, round(abs(a.m - b.m), 6) AS abs_diff
FROM p JOIN cm a ON a.label = p.label_a JOIN cm b ON b.label = p.label_b AND b.dim = a.dim""")
def q_pair_difference_image(spark, sf_dir):
    """K6: |mean_a - mean_b| images for the default class pairs on the grid."""
    d = stats.class_pair_difference(spark, stats.class_means(emb_long(spark, sf_dir)))
    return stats.on_grid(d, GRID_WIDTH).select("label_a", "label_b", "row", "col",
                                               r6("abs_diff").alias("abs_diff"))


# ---------------------------------------------------------------- the SQL analysis on the digit stand-in
# centre cell of the 8 x 8 grid: row 4, col 4 -> dim 36

CENTER_DIM = 4 * GRID_WIDTH + 4


@register("center_ink_sql", f"""
SELECT label, COUNT(*) AS n, ROUND(AVG(embedding[{CENTER_DIM + 1}]::DOUBLE), 2) AS avg_center_ink
FROM embeddings GROUP BY label ORDER BY label""")
def q_center_ink_sql(spark, sf_dir):
    """D3/G1/B6 on the stand-in: rows and rounded mean of the centre feature per
    label, through Spark SQL over a temp view."""
    emb(spark, sf_dir).createOrReplaceTempView("tabula_digits")
    return spark.sql(f"SELECT label, COUNT(*) AS n, ROUND(AVG(CAST(embedding[{CENTER_DIM}] AS DOUBLE)), 2) "
                     "AS avg_center_ink FROM tabula_digits GROUP BY label ORDER BY label")


@register("center_ink_count_agree", f"""
SELECT 'sql' AS method, COUNT(*) AS n FROM embeddings WHERE embedding[{CENTER_DIM + 1}] > 0
UNION ALL
SELECT 'dataframe' AS method, COUNT(*) AS n FROM embeddings WHERE embedding[{CENTER_DIM + 1}] > 0""")
def q_center_ink_count_agree(spark, sf_dir):
    """D4/B5/B6 on the stand-in: rows whose centre feature is inked, counted in
    SQL form and in DataFrame form."""
    e = emb(spark, sf_dir)
    e.createOrReplaceTempView("tabula_digits")
    by_sql = spark.sql(f"SELECT 'sql' AS method, COUNT(*) AS n FROM tabula_digits WHERE embedding[{CENTER_DIM}] > 0")
    by_df = (e.filter(F.col("embedding")[CENTER_DIM] > 0).agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit("dataframe").alias("method"), "n"))
    return by_sql.unionByName(by_df)


# ---------------------------------------------------------------- sources, sinks and small operators

def _run_path(spark, name: str) -> str:
    import uuid

    from tabula.session import scratch_path

    return scratch_path(spark, name, uuid.uuid4().hex[:12])


@register("train_test_read", f"""
WITH cells AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
     every AS (SELECT vec_id % 5 = 0 AS test, round(sum(dim * x), 4) AS weighted_sum FROM cells GROUP BY vec_id % 5 = 0)
SELECT CASE WHEN test THEN 'test' ELSE 'train' END AS side, COUNT(*) AS n_rows, {N_DIMS} AS n_features,
       round(sum(embedding[1]::DOUBLE), 4) AS first_sum, round(sum(embedding[{N_DIMS}]::DOUBLE), 4) AS last_sum,
       any_value(weighted_sum) AS weighted_sum
FROM embeddings JOIN every ON (vec_id % 5 = 0) = test GROUP BY test""")
def q_train_test_read(spark, sf_dir):
    """A5: a labelled train file and an unlabelled test file of the whole table,
    written as CSV (columns out of order) and read back typed."""
    from tabula.sources.tables import read_train_test

    path = _run_path(spark, "train-test")
    pixels = [F.col("embedding")[i].cast("double").alias(f"pixel{i}") for i in reversed(range(N_DIMS))]
    test = F.col("vec_id") % 5 == 0
    e = emb(spark, sf_dir)
    e.filter(~test).select(*pixels, "label").write.option("header", "true").csv(f"{path}/train.csv")
    e.filter(test).select(*pixels).write.option("header", "true").csv(f"{path}/test.csv")

    def summary(side, df):
        cells = [c for c in df.columns if c != "label"]
        return df.agg(F.count("*").alias("n_rows"), F.round(F.sum(cells[0]), 4).alias("first_sum"),
                      F.round(F.sum(cells[-1]), 4).alias("last_sum"),
                      # every column by its place, so that none can stand for another
                      F.round(sum(F.sum(F.col(c)) * k for k, c in enumerate(cells, 1)), 4).alias("weighted_sum")).select(
            F.lit(side).alias("side"), "n_rows", F.lit(len(cells)).alias("n_features"), "first_sum", "last_sum", "weighted_sum")

    train, unlabelled = read_train_test(spark, path)
    return summary("train", train).unionAll(summary("test", unlabelled))


def _stored(spark, table: DataFrame, kind: str) -> DataFrame:
    """A statistics table, published and read back by the typed reader."""
    from tabula.sources.tables import materialize, read_stat_table

    path = f"{_run_path(spark, 'statistics')}/{kind}"
    materialize(spark, table, path)
    return read_stat_table(spark, path, kind)


@register("stored_frequencies", "SELECT label, COUNT(*) AS count FROM embeddings GROUP BY label")
def q_stored_frequencies(spark, sf_dir):
    """The frequency table, written and read back by the typed reader."""
    return _stored(spark, stats.label_counts(emb(spark, sf_dir).select("label")), "frequencies")


@register("stored_column_stats", f"""
SELECT dim, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min,
       round(max(x), 6) AS max, CAST(sum(CASE WHEN x = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zeros
FROM {EMB_LONG} GROUP BY dim""")
def q_stored_column_stats(spark, sf_dir):
    """The column statistics, written and read back."""
    return _stats_out(_stored(spark, stats.column_stats(emb_long(spark, sf_dir)), "column_stats"), ["dim"])


@register("stored_std_map", f"SELECT dim, round(stddev_samp(x), 6) AS std FROM {EMB_LONG} GROUP BY dim")
def q_stored_std_map(spark, sf_dir):
    """The std map, written and read back."""
    return _stored(spark, stats.std_map(emb_long(spark, sf_dir)), "std_map").select("dim", r6("std").alias("std"))


@register("shape_check", f"""
SELECT vec_id, len(embedding) = {N_DIMS} AND list_min(list_transform(embedding, lambda v: v::DOUBLE)) >= -0.25
       AND list_max(list_transform(embedding, lambda v: v::DOUBLE)) <= 0.25 AS valid FROM embeddings""")
def q_shape_check(spark, sf_dir):
    """Exactly 64 features, all inside a range that some rows leave."""
    from tabula.functions.scoring import as_double_array, valid_shape

    return emb(spark, sf_dir).select("vec_id", valid_shape(as_double_array(F.col("embedding")), N_DIMS, -0.25, 0.25).alias("valid"))


@register("feature_dimension", f"""
SELECT COUNT(*) AS n_rows, CAST(max(len(embedding)) AS INTEGER) AS n_features FROM embeddings""")
def q_feature_dimension(spark, sf_dir):
    """The table's row count and feature dimension."""
    from tabula.sources.tables import feature_dimension

    e = emb(spark, sf_dir)
    n = F.lit(feature_dimension(e, "embedding") if e.head(1) else None).cast("int")
    return e.agg(F.count("*").alias("n_rows")).select("n_rows", n.alias("n_features"))


@register("assembled_features", """
SELECT l_orderkey, l_linenumber, round(l_quantity::DOUBLE + l_extendedprice::DOUBLE + l_discount::DOUBLE + l_tax::DOUBLE, 4) AS total,
       4 AS n_features FROM lineitem""")
def q_assembled_features(spark, sf_dir):
    """Four columns assembled into one feature array."""
    li = feat.assemble_array(read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", *LINEITEM_NUMERIC]), LINEITEM_NUMERIC)
    total = F.aggregate("features", F.lit(0.0), lambda a, v: a + v)
    return li.select("l_orderkey", "l_linenumber", F.round(total, 4).alias("total"), F.size("features").alias("n_features"))


@register("pixel_scale", """
SELECT p_partkey, round(p_size::DOUBLE / 255, 6) AS size, round(p_retailprice::DOUBLE / 255, 6) AS price FROM part""")
def q_pixel_scale(spark, sf_dir):
    """Values of 0..255 scaled to 0..1."""
    from tabula.functions.scoring import scale_pixels

    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_size", "p_retailprice"])
    scaled = part.select("p_partkey", scale_pixels(F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double"))).alias("v"))
    return scaled.select("p_partkey", r6(F.col("v")[0]).alias("size"), r6(F.col("v")[1]).alias("price"))


@register("comparison_report", _BLOCK_SQL + """
SELECT 'block_' || CAST(block AS VARCHAR) AS model, printf('%.4f', round(accuracy, 6)) AS accuracy, printf('%.4f', round(f1, 6)) AS f1,
       'ok' AS status FROM res""")
def q_comparison_report(spark, sf_dir):
    """The comparison table as display strings."""
    from tabula.operators import evaluate as ev

    results = block_results(spark, sf_dir).select(
        "model", r6("accuracy").alias("accuracy"), r6("f1").alias("f1"), F.lit(0.0).alias("weighted_precision"),
        F.lit(0.0).alias("weighted_recall"), F.lit(0.0).alias("train_s"), F.lit(0.0).alias("eval_s"), "status")
    return ev.comparison_report(results).select("model", "accuracy", "f1", "status")


@register("split_disjoint", """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT (label, embedding)) AS n_contents, 0 AS n_on_both_sides FROM embeddings""")
def q_split_disjoint(spark, sf_dir):
    """F5/G5 in the native hash form: all rows and contents are there, and no
    content is on both sides."""
    rows = q_hash_split_native(spark, sf_dir).join(emb(spark, sf_dir).select("vec_id", F.xxhash64("label", "embedding").alias("content")), "vec_id")
    each = rows.groupBy("content").agg(F.count("*").alias("n"), F.countDistinct("split").alias("sides"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_contents"),
                    F.count(F.when(F.col("sides") > 1, 1)).alias("n_on_both_sides"))
