"""Scoring as a Structured Streaming query.

File source over a directory (a single-file path is not a valid streaming
source), the same array-expression scorer as the batch path, Parquet sink
with a checkpoint, ``availableNow`` trigger so a run processes what is
there and stops. Sink and checkpoint live under the shared checkpoint
folder the cluster names (``spark.checkpoint.dir``), so a restarted query
resumes exactly-once from its checkpoint after a driver or executor loss.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tabula.plans.score import score_logits, score_model
from tabula.session import scratch_path
from tabula.sources.tables import is_directory


def scoring_stream(spark: SparkSession, source_dir: str, table: str, logits_col: str = "embedding",
                   id_col: str = "vec_id", n_classes: int = 10, max_files_per_trigger: int = 64, model=None,
                   carry: Sequence[str] = ()) -> DataFrame:
    """The streaming DataFrame: file source -> scorer (no state, no shuffle).
    The scorer is a published ``model`` (preparation and classifier), which keeps
    the ``carry`` columns, or without one the logits column."""
    path = f"{source_dir.rstrip('/')}/{table}.parquet"
    reader = (spark.readStream.schema(spark.read.parquet(path).schema)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    # a table of many files is a directory and streams as it is; a single file
    # is no streaming source, so its directory is filtered for it
    if is_directory(spark, path):
        src = reader.parquet(path)
    else:
        src = reader.option("pathGlobFilter", f"{table}.parquet").parquet(source_dir)
    if model is not None:
        return score_model(model, src, id_col, n_classes, carry)
    return score_logits(src, logits_col, id_col, 0, n_classes, carry).drop("probability")


def run_scoring_stream(spark: SparkSession, source_dir: str, table: str = "embeddings",
                       out_dir: str | None = None, checkpoint: str | None = None, **kw) -> DataFrame:
    """Run the stream to completion (availableNow) and return the sink as a
    batch DataFrame."""
    run = uuid.uuid4().hex[:12]
    out_dir = out_dir or scratch_path(spark, "stream", run, "out")
    checkpoint = checkpoint or scratch_path(spark, "stream", run, "checkpoint")
    stream = scoring_stream(spark, source_dir, table, **kw)
    q = (stream
         .writeStream.format("parquet")
         .option("path", out_dir)
         .option("checkpointLocation", checkpoint)
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    # known schema: an empty source leaves a sink without data files
    return spark.read.schema(stream.schema).parquet(out_dir)
