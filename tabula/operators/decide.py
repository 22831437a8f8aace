"""Grouped accept-or-review analysis (H13 with D15-D17, G10, G11, B10).

Input: one scored row per (group key, position) with a predicted class and
its confidence. Output: one row per group with the code (classes joined in
position order), the weakest confidence, the weakest position, the decision
and the review sentence, plus a ``valid`` flag replacing the reference's
exceptions (exactly N rows with positions 1..N, and N classes and N
confidences, none of them null, in range). An invalid group gets no code, no
decision and no sentence.

Every aggregate has a constant-size buffer (min, max, count, bit_or, and N
positional ``max(when(...))``), so a key that holds a third of all rows is
aggregated map-side like any other and never collected into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.functions import decision as dec


def _sql_int(column: str) -> str:
    return f"CAST(`{column}` AS INT)"


def check_limits(n: int, threshold: float) -> None:
    if not 0.0 <= threshold <= 1.0:
        raise ValueError("threshold must be between 0 and 1")
    if not 1 <= n <= 62:
        raise ValueError("n must be between 1 and 62")


def group_analysis(scored: DataFrame, key: str, position: str = "position", digit: str = "digit",
                   confidence: str = "confidence", n: int = 5,
                   threshold: float = dec.DEFAULT_THRESHOLD, n_classes: int = 10) -> DataFrame:
    check_limits(n, threshold)
    pos, dig, conf = F.col(position).cast("int"), F.col(digit).cast("int"), F.col(confidence).cast("double")
    per_pos = [F.max(F.when(pos == k, dig)).alias(f"_d{k}") for k in range(1, n + 1)]
    bit = F.when(pos.between(1, n), F.expr(f"shiftleft(1L, {_sql_int(position)} - 1)"))
    g = scored.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.count(dig).alias("_digits"), F.count(conf).alias("_confs"), F.bit_or(bit).alias("_mask"),
        F.min(pos).alias("_pmin"), F.max(pos).alias("_pmax"),
        F.min(dig).alias("_dmin"), F.max(dig).alias("_dmax"),
        F.min(conf).alias("global_confidence"), F.max(conf).alias("_cmax"),
        # First (lowest) position among the lowest confidence
        F.min(F.when(conf.isNotNull(), F.struct(conf.alias("c"), pos.alias("p")))).alias("_weakest"),
        *per_pos)
    return judged(g, [key], n, threshold, n_classes)


def judged(g: DataFrame, keep: Sequence[str], n: int, threshold: float, n_classes: int = 10) -> DataFrame:
    """The decision of each row of group aggregates (named as in ``group_analysis``),
    with the ``keep`` columns."""
    valid = F.coalesce(
        (F.col("n_predictions") == n) & (F.col("_digits") == n) & (F.col("_confs") == n) &
        (F.col("_mask") == F.lit((1 << n) - 1)) & (F.col("_pmin") >= 1) & (F.col("_pmax") <= n) &
        (F.col("_dmin") >= 0) & (F.col("_dmax") <= n_classes - 1) &
        (F.col("global_confidence") >= 0.0) & (F.col("_cmax") <= 1.0), F.lit(False))
    code = F.concat(*[F.col(f"_d{k}").cast("string") for k in range(1, n + 1)])
    gc = F.col("global_confidence")
    only_valid = lambda c: F.when(valid, c)
    weakest_pos = F.col("_weakest")["p"]
    return g.select(
        *keep,
        F.col("n_predictions"),
        valid.alias("valid"),
        F.when(valid, code).alias("postal_code"),
        gc.alias("global_confidence"),
        only_valid(dec.decision(gc, threshold)).alias("decision"),
        only_valid(dec.decision_label(gc, threshold)).alias("decision_label"),
        weakest_pos.alias("weakest_position"),
        only_valid(dec.review_reason(gc, weakest_pos, threshold)).alias("review_reason"))
