"""J1 + H13: accept-or-review decisions inside the stream.

Scored digits arrive in any order and any number of files. A keyed state holds
one fixed-size summary per group (counts, position mask, extremes, the weakest
digit and one digit per position), never the rows. Before the shuffle each
Arrow batch is summed up per group, so a group that holds a third of all rows
sends a row a batch.

A group with all its ``n`` rows is decided at once. Further rows change the
answer as they would in a batch job, so the group is emitted again with the
next ``version``; ``latest`` keeps the last word. A group that stays incomplete
for ``timeout_ms`` of event time is emitted for review and forgotten, and so is
a decided one, without a word. ``leftover`` reads the groups still waiting from
the state store when a finite source has ended.

The answer of a group is ``group_analysis`` of all its rows (both use
``judged``), except that a group which isn't valid is for review here: somebody
has to look at it. Sink and checkpoint lie in the shared checkpoint folder, so a
restarted query goes on where it stopped, with its state.

Cases: a null group key is a group of its own; rows without an event time count
as the oldest one known; rows older than ``lateness`` behind the watermark are
late and not counted; an empty source gives no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tabula.functions.decision import DEFAULT_THRESHOLD, REVIEW_LABEL
from tabula.operators.decide import check_limits, judged
from tabula.session import scratch_path, ship_package
from tabula.sources.tables import path_exists
from tabula.streaming.score_stream import scoring_stream

#: What is known of a group, in the order of the state tuple.
SUMMARY = ("n_predictions long, _digits long, _confs long, _mask long, _pmin int, _pmax int, _dmin int, _dmax int, "
           "global_confidence double, _cmax double, _weakest_c double, _weakest_p int, digits array<int>, at_ms long")
STATE = SUMMARY + ", opened_ms long, version int"
#: A state function's call costs some hundred microseconds a column in and out, so a
#: summary passes through it as one JSON text.
TOLD = STATE + ", timed_out boolean"
TOLD_NAMES = [c.split()[0] for c in TOLD.split(", ")]
NAMES = [c.split()[0] for c in SUMMARY.split(", ")]
RESULTS = ("n_predictions", "valid", "postal_code", "global_confidence", "decision", "decision_label", "weakest_position",
           "review_reason")


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _most(a, b):
    return b if a is None else a if b is None else max(a, b)


def merge(a: tuple | None, b: tuple) -> tuple:
    """The summary of the rows of two summaries."""
    if a is None:
        return b
    weak = _least(None if a[10] is None else (a[10], a[11] is not None, a[11]), None if b[10] is None else (b[10], b[11] is not None, b[11]))
    return (a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] | b[3], _least(a[4], b[4]), _most(a[5], b[5]), _least(a[6], b[6]),
            _most(a[7], b[7]), _least(a[8], b[8]), _most(a[9], b[9]), weak and weak[0], weak and weak[2],
            [_most(x, y) for x, y in zip(a[12], b[12])], _most(a[13], b[13]))


def summary(position: int | None, digit: int | None, confidence: float | None, at_ms: int | None, n: int) -> tuple:
    """The summary of one row."""
    inside = position is not None and 1 <= position <= n
    return (1, int(digit is not None), int(confidence is not None), 1 << position - 1 if inside else 0, position, position,
            digit, digit, confidence, confidence, confidence, None if confidence is None else position,
            [digit if inside and k == position else None for k in range(1, n + 1)], at_ms)


def packed(values: tuple) -> str:
    """A summary as JSON; a confidence that is no number is null."""
    return json.dumps([None if x != x else x for x in values])


def unpacked(text: str) -> tuple:
    return tuple(json.loads(text))


def _summed(n: int):
    """Rows (grp, position, digit, confidence, at_ms) as one summary per group and batch."""
    def run(batches):
        import pyarrow as pa

        from tabula.streaming.decide_stream import merge, packed, summary

        for batch in batches:
            found: dict = {}
            columns = [batch.column(c).to_pylist() for c in ("grp", "position", "digit", "confidence", "at_ms")]
            for key, *row in zip(*columns):
                found[key] = merge(found.get(key), summary(*row, n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), batch.schema.field("grp").type), pa.array(map(packed, found.values()), pa.string()),
                 pa.array([s[13] for s in found.values()], pa.int64())], ["grp", "part", "at_ms"])

    return run


def _decider(n: int, timeout_ms: int):
    def run(key: tuple, parts: Iterator, state: GroupState):
        import json

        import pandas as pd

        from tabula.streaming.decide_stream import TOLD_NAMES, merge, unpacked

        def told(known: tuple, opened: int, version: int, timed_out: bool):
            row = dict(zip(TOLD_NAMES, (*known, opened, version, timed_out)))
            return pd.DataFrame({"grp": [key[0]], "told": [json.dumps(row)]}, dtype=object)

        old = state.getOption
        known, opened, version = (None, None, 0) if old is None else ((*old[:12], list(old[12]), old[13]), old[14], old[15])
        if state.hasTimedOut:
            state.remove()
            if version == 0:
                yield told(known, opened, 1, True)
            return
        for pdf in parts:
            for part in pdf["part"]:
                known = merge(known, unpacked(part))
        opened = known[13] if opened is None else opened
        if known[0] >= n:
            version += 1
        state.update((*known, opened, version))
        state.setTimeoutTimestamp(max(known[13] + timeout_ms, state.getCurrentWatermarkMs() + 1))
        if known[0] >= n:
            yield told(known, opened, version, False)

    return run


def decided(scored: DataFrame, key: str, at: str, position: str = "position", digit: str = "digit",
            confidence: str = "confidence", n: int = 5, threshold: float = DEFAULT_THRESHOLD, n_classes: int = 10,
            lateness: str = "1 hour", timeout_ms: int = 3_600_000) -> DataFrame:
    """The stream of decisions for a stream of scored digits with event times ``at``."""
    check_limits(n, threshold)
    kind = scored.schema[key].dataType.simpleString()
    ms = F.coalesce(F.unix_millis(F.col(at).cast("timestamp")), F.lit(0)).alias("at_ms")
    rows = scored.select(F.col(key).alias("grp"), F.col(position).cast("int").alias("position"), F.col(digit).cast("int").alias("digit"),
                         F.col(confidence).cast("double").alias("confidence"), ms)
    parts = rows.mapInArrow(_summed(n), f"grp {kind}, part string, at_ms long")
    parts = parts.select("grp", "part", F.timestamp_millis("at_ms").alias("_at")).withWatermark("_at", lateness)
    out = parts.groupBy("grp").applyInPandasWithState(
        _decider(n, timeout_ms), f"grp {kind}, told string", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    out = out.select("grp", F.from_json("told", TOLD).alias("told")).select("grp", "told.*")
    return _judged(out, key, n, threshold, n_classes)


def _judged(summaries: DataFrame, key: str, n: int, threshold: float, n_classes: int) -> DataFrame:
    spread = [F.get("digits", F.lit(k - 1)).alias(f"_d{k}") for k in range(1, n + 1)]
    weak = F.when(F.col("_weakest_c").isNotNull(), F.struct(F.col("_weakest_c").alias("c"), F.col("_weakest_p").alias("p")))
    g = summaries.select("*", *spread, weak.alias("_weakest")).withColumnRenamed("grp", key)
    out = judged(g, [key, "opened_ms", "version", "timed_out"], n, threshold, n_classes)
    return out.withColumn("decision", F.coalesce("decision", F.lit("review"))).withColumn(
        "decision_label", F.coalesce("decision_label", F.lit(REVIEW_LABEL)))


def latest(decisions: DataFrame, key: str) -> DataFrame:
    """Each group's last decision: one struct a group, so a partial aggregate."""
    rest = [c for c in decisions.columns if c not in (key, "opened_ms", "version")]
    last = decisions.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("opened_ms", "version")).alias("last"))
    return last.select(key, "last.*")


def leftover(spark: SparkSession, checkpoint: str, key: str, n: int = 5, threshold: float = DEFAULT_THRESHOLD,
             n_classes: int = 10) -> DataFrame:
    """The groups that wait in the state of a stopped stream, as they would time out."""
    held = spark.read.format("statestore").load(checkpoint)
    names = [c.split()[0] for c in STATE.split(", ")]
    waiting = held.filter("value.groupState.version = 0").select(
        F.col("key.grp").alias("grp"), *[F.col(f"value.groupState.{c}").alias(c) for c in names], F.lit(True).alias("timed_out"))
    return _judged(waiting, key, n, threshold, n_classes)


def run_decision_stream(spark: SparkSession, source_dir: str, table: str, group_col: str, position_col: str, at_col: str,
                        id_col: str, out_dir: str | None = None, checkpoint: str | None = None, model=None,
                        logits_col: str = "embedding", n: int = 5, threshold: float = DEFAULT_THRESHOLD, n_classes: int = 10,
                        lateness: str = "1 hour", timeout_ms: int = 3_600_000, drain: bool = True,
                        max_files_per_trigger: int = 64, carry: Sequence[str] = ()) -> DataFrame:
    """Score and decide what ``source_dir`` holds (availableNow), then each group's
    last decision; with ``drain`` also those that still wait for rows."""
    ship_package(spark)
    run = uuid.uuid4().hex[:12]
    out_dir = out_dir or scratch_path(spark, "decisions", run, "out")
    checkpoint = checkpoint or scratch_path(spark, "decisions", run, "checkpoint")
    scored = scoring_stream(spark, source_dir, table, logits_col, id_col, n_classes, max_files_per_trigger, model,
                            (group_col, position_col, at_col, *carry))
    stream = decided(scored, group_col, at_col, position_col, n=n, threshold=threshold, n_classes=n_classes, lateness=lateness,
                     timeout_ms=timeout_ms)
    query = (stream.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    told = spark.read.schema(stream.schema).parquet(out_dir)
    if drain and path_exists(spark, f"{checkpoint}/state/0"):
        told = told.unionByName(leftover(spark, checkpoint, group_col, n, threshold, n_classes))
    return latest(told, group_col)
