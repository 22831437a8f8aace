"""End-to-end runs composed from the operators (the reference's entry
points, SURVEY 2.14 / 3.1-3.3). Each is a handful of Spark jobs; the driver
only sequences them and receives report-sized results.

* ``statistics_run``    - four statistics tables, compute-or-reuse (3.1).
* ``preprocessing_run`` - the named preparations on labelled (+ unlabelled)
  data, each fitted on its train side, plus the summary table (H2, A19).
* ``training_run``      - sample, prepare, compare LR/DT/RF/MLP, write the
  confusion matrices / class metrics / comparison, publish the best model
  behind a quality gate (3.2, H8, H9, A16-A18, A21).
* ``scoring_run``       - load the published model and score keyed rows,
  then group them into accept-or-review decisions when positions are given
  (3.3, A22, H10, H13).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.operators import features as feat
from tabula.operators.decide import group_analysis
from tabula.plans import models as mdl
from tabula.plans.prepare import DEFAULT_CONFIGS, PrepConfig, input_identity, run_configuration, summary_frame
from tabula.plans.score import score_model
from tabula.plans.statistics import compute_statistics


def statistics_run(spark: SparkSession, df: DataFrame, root: str, *, label_col: str = "label",
                   vector_col: str | None = None, wide_cols: Sequence[str] | None = None,
                   id_col: str | None = None, force: bool = False) -> dict[str, DataFrame]:
    """Frequencies, per-column statistics, class means and the std map, under a
    folder of ``root`` named by the input, so that another input never gets them."""
    root = f"{root.rstrip('/')}/{input_identity(spark, df)}"
    if id_col is None:
        id_col = "_row"
        df = df.withColumn(id_col, F.monotonically_increasing_id())  # only groups a row's features
    long_df = (feat.vector_to_long(df, vector_col, id_col, label_col) if vector_col is not None
               else feat.wide_to_long(df, list(wide_cols), id_col, label_col))
    if label_col != "label":
        long_df = long_df.withColumnRenamed(label_col, "label")
    return compute_statistics(spark, long_df, df.select(F.col(label_col).alias("label")), root, force)


def preprocessing_run(spark: SparkSession, train_df: DataFrame, root: str, *, test_df: DataFrame | None = None,
                      configs: Sequence[PrepConfig] = DEFAULT_CONFIGS, key_col: str | None = None,
                      vector_col: str | None = None, wide_cols: Sequence[str] | None = None,
                      parallelism: int = 1) -> tuple[DataFrame, dict]:
    """Every configuration; returns the summary (A19, also written) and the
    per-configuration results. ``parallelism`` submits the independent
    configurations from that many driver threads."""
    from concurrent.futures import ThreadPoolExecutor

    def one(c):
        return c.name, run_configuration(spark, train_df, c, key_col=key_col, vector_col=vector_col,
                                         wide_cols=wide_cols, out_root=f"{root}/prepared", test_df=test_df)

    if parallelism > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            results = dict(pool.map(one, configs))
    else:
        results = dict(one(c) for c in configs)
    summary = summary_frame(spark, [r["summary"] for r in results.values()])
    summary.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{root}/preprocessing_summary")
    return summary, results


def training_run(spark: SparkSession, df: DataFrame, root: str, *, sample_fraction: float = 0.2,
                 config: PrepConfig = DEFAULT_CONFIGS[3], key_col: str | None = None,
                 vector_col: str | None = None, wide_cols: Sequence[str] | None = None,
                 classes: Sequence[int] = tuple(range(10)), min_accuracy: float = 0.0,
                 include_mlp: bool = True, parallelism: int = 1) -> DataFrame:
    """Split by content, sample the train side only (content hash, partition
    independent), prepare on it, compare the classifiers on the whole
    validation side, write the reports and publish the best model. Returns the
    comparison table."""
    prep = run_configuration(spark, df, config, key_col=key_col, vector_col=vector_col, wide_cols=wide_cols,
                             out_root=f"{root}/prepared", train_fraction=sample_fraction)
    data = prep["prepared"]
    comp = mdl.compare_models(spark, data.filter("split = 'train'"), data.filter("split = 'validation'"),
                              mdl.build_classifiers(prep["summary"]["feature_dimension"], len(classes),
                                                    include_mlp=include_mlp),
                              parallelism=parallelism)
    mdl.write_reports(spark, comp, f"{root}/metrics", classes)
    best = mdl.publish_best(spark, comp, prep["model"], f"{root}/models", min_accuracy=min_accuracy)
    # One JSON document for the published model (summary + per-class metrics)
    from tabula.operators.evaluate import class_metrics
    from tabula.sources.tables import write_metrics_json

    summary = {k: best[k] for k in ("model", "accuracy", "f1", "weighted_precision", "weighted_recall")}
    summary["train_rows"] = prep["summary"]["train_rows"]
    summary["validation_rows"] = prep["summary"]["validation_rows"]
    write_metrics_json(spark, f"{root}/metrics/best_model_metrics", summary,
                       class_metrics=class_metrics(comp.counts[best["model"]], classes, spark))
    return comp.results


def scoring_run(spark: SparkSession, root: str, df: DataFrame, id_col: str, *,
                group_col: str | None = None, position_col: str | None = None, n: int = 5,
                threshold: float = 0.8, n_classes: int = 10) -> DataFrame:
    """Score keyed rows with the published model; with a group and position
    column, return one accept-or-review decision per group instead."""
    _, model = mdl.load_best(spark, f"{root}/models")
    keep = [c for c in (group_col, position_col) if c]
    scored = score_model(model, df, id_col, n_classes, carry=keep)
    if not keep:
        return scored
    return group_analysis(scored, group_col, position=position_col, n=n, threshold=threshold,
                          n_classes=n_classes)


RESULT_COLUMNS = ("n_predictions bigint, valid boolean, postal_code string, global_confidence double, decision string, "
                  "decision_label string, weakest_position int, review_reason string")


def photo_run(spark: SparkSession, image_path: str, root: str, *, glob: str | None = None,
              thicken: bool = False, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """SURVEY 3.3 for a directory of photos: ingest checks, segmentation into
    five 28 x 28 digits, scoring with the published model and one decision
    per photo. Returns (decisions, image_status).

    Results are kept in a memo store under ``root``, keyed by the photo's
    content, the model, the threshold and the option (I9): a photo whose content
    has a result, or shares its content with another of this run, is not worked
    on again."""
    from tabula.operators import images
    from tabula.plans.result_store import ResultStore
    from tabula.plans.score import memo_key

    _, model_path = mdl.resolve_model(spark, f"{root}/models")
    store = ResultStore(spark, f"{root.rstrip('/')}/photo_results", f"memo_key string, reject_reason string, {RESULT_COLUMNS}",
                        prefix_chars=1)
    names = [c.split()[0] for c in RESULT_COLUMNS.split(", ")]
    # one small row per file, read by the pixel stage and the status: written
    # once so the files' contents are hashed once
    tag = memo_key(F.col("content_key"), f"{model_path}@{threshold}", thicken)
    meta = images.written_metadata(spark, images.ingest(spark, image_path, glob).withColumn("memo_key", tag))
    todo = store.pending(meta).groupBy("memo_key").agg(F.min("path").alias("path"))
    todo = images.written_metadata(spark, todo.select("path", F.lit(True).alias("todo")))
    marked = meta.join(todo, "path", "left").withColumn(
        "reject_reason", F.when(F.col("todo").isNull(), "known").otherwise(F.col("reject_reason"))).drop("todo")
    marked = images.written_metadata(spark, marked)
    segs, status = images.segment_images(images.decoded(spark, image_path, glob), marked, thicken=thicken)
    decisions = scoring_run(spark, root, images.segments_as_rows(segs), "segment_id", group_col="path",
                            position_col="position", n=images.EXPECTED_DIGITS, threshold=threshold)
    fresh = (status.filter("reject_reason is null or reject_reason <> 'known'").join(decisions, "path", "left")
             .join(meta.select("path", "memo_key"), "path"))
    store.append(fresh.select("memo_key", "reject_reason", *names))
    asked = meta.select("path", "memo_key")
    known = asked.join(store.results(store.touched(asked)), "memo_key")
    return known.filter("n_predictions is not null").select("path", *names), known.select("path", "reject_reason")
