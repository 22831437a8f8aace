"""Chat formatting with cumulative-snapshot collapse.

Chat logs often hold a conversation again and again, each time a few turns
longer. Turns are numbered per conversation, and every turn gets a rolling
hash of its prefix: the running XOR of two 64-bit hashes of (number, role,
text), 128 bits together. A conversation whose last prefix is an inner prefix
of some other is a snapshot of it and goes; of equal conversations the one with
the least id stays. What is left is rendered, one row per turn, so that a
conversation of any length never meets in one value (``whole_text`` joins the
rows of those that fit).

Only DataFrame functions are used. Turns are ordered inside slices of ``SLICE``
turn numbers and the slices' counts and hashes are added up beforehand, so a
conversation holding a third of all rows is spread over many tasks.

Cases: a null role counts as "unknown", a null text as empty; null turns come
first; equal turn numbers are ordered by role and text, repeated rows are
turns of their own; rows of null conv_id are one conversation; extra columns
are ignored; an empty table gives no rows. Marks inside texts are spaced out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SLICE = 1024


def _joined(rows: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Inner join on keys that may be null, each kept once."""
    named = other.withColumnsRenamed({k: f"{k}_of" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{k}_of"))
    return rows.join(named, cond).drop(*[f"{k}_of" for k in keys])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, slice, pos (from 1), n_turns, role, text for every turn."""
    turns = conversations.select(
        "conv_id", F.floor(F.col("turn") / SLICE).alias("slice"), "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    in_slice = F.row_number().over(Window.partitionBy("conv_id", "slice").orderBy("turn", "role", "text"))
    turns = turns.select("*", in_slice.alias("rn"))
    sizes = turns.groupBy("conv_id", "slice").agg(F.count("*").alias("n"))
    conv = Window.partitionBy("conv_id")
    before = F.sum("n").over(conv.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("conv_id", "slice", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(conv).alias("n_turns"))
    return (_joined(turns, sizes, "conv_id", "slice")
            .select("conv_id", "slice", (F.col("before") + F.col("rn")).alias("pos"), "n_turns", "role", "text"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, pos, n_turns, p1, p2: the hash of the turns up to each turn."""
    hashed = turns.select("conv_id", "slice", "pos", "n_turns", F.xxhash64("pos", "role", "text").alias("h1"),
                          F.xxhash64(F.lit("second"), "text", "role", "pos").alias("h2"))
    slices = hashed.groupBy("conv_id", "slice").agg(F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("conv_id", "slice", F.coalesce(F.bit_xor("s1").over(earlier), F.lit(0)).alias("e1"),
                           F.coalesce(F.bit_xor("s2").over(earlier), F.lit(0)).alias("e2"))
    running = Window.partitionBy("conv_id", "slice").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    hashed = hashed.select("conv_id", "slice", "pos", "n_turns", F.bit_xor("h1").over(running).alias("r1"),
                           F.bit_xor("h2").over(running).alias("r2"))
    return (_joined(hashed, slices, "conv_id", "slice")
            .select("conv_id", "pos", "n_turns", F.col("e1").bitwiseXOR(F.col("r1")).alias("p1"),
                    F.col("e2").bitwiseXOR(F.col("r2")).alias("p2")))


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv_id and copies of the conversations that are no prefix of another."""
    whole = prefixes.filter("pos = n_turns").groupBy("pos", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = prefixes.filter("pos < n_turns").select("pos", "p1", "p2").distinct()
    return whole.join(inner, ["pos", "p1", "p2"], "left_anti").select("conv_id", "copies")


def rendered_turn() -> Column:
    safe = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|"), safe("role"), F.lit("|>\n"), safe("text"), F.lit("\n<|end|>\n"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, turn_no, role, rendered, copies for each turn of the maximal conversations."""
    turns = written(conversations.sparkSession, numbered_turns(conversations), "chat-turns")
    kept = maximal(prefix_hashes(turns))
    return (_joined(turns, kept, "conv_id")
            .select("conv_id", F.col("pos").alias("turn_no"), "role", rendered_turn().alias("rendered"), "copies"))


def whole_text(rendered: DataFrame) -> DataFrame:
    """One text per conversation, for conversations that fit in a value."""
    rows = F.array_sort(F.collect_list(F.struct("turn_no", "rendered")))
    return rendered.groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda r: r["rendered"]), "").alias("text"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


OP3_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
n AS (
  SELECT conv_id, role, text, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
p AS (
  SELECT conv_id, pos, n_turns,
         md5(string_agg(md5(role || chr(31) || text), ',') OVER (PARTITION BY conv_id ORDER BY pos)) AS h FROM n),
w AS (SELECT pos, h, min(conv_id) AS conv_id, count(*) AS copies FROM p WHERE pos = n_turns GROUP BY pos, h),
k AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos = w.pos AND p.h = w.h AND p.pos < p.n_turns))
SELECT n.conv_id, n.pos AS turn_no, n.role,
       '<|' || replace(n.role, '<|', '< |') || '|>' || chr(10) || replace(n.text, '<|', '< |') || chr(10) || '<|end|>' || chr(10)
         AS rendered, k.copies
FROM n JOIN k ON n.conv_id IS NOT DISTINCT FROM k.conv_id
"""
