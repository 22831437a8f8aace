"""The end-to-end runs on the smallest tables (wide and vector inputs)."""

from pyspark.sql import functions as F

from tabula.plans import workflows as wf
from tabula.plans.prepare import PrepConfig

from paths import SF_SMALL


def test_runs_end_to_end(spark, tmp_path):
    root = str(tmp_path / "run")
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    # a wide, id-less labelled table like a digit CSV: label + pixel0..pixel63
    wide = e.select("label", *[F.col("embedding")[i].cast("double").alias(f"pixel{i}") for i in range(64)])
    cols = [f"pixel{i}" for i in range(64)]
    st = wf.statistics_run(spark, wide, f"{root}/stats", wide_cols=cols)
    assert st["class_means"].count() == 640 and st["frequencies"].count() == 10
    half = wf.statistics_run(spark, wide.filter("label < 5"), f"{root}/stats", wide_cols=cols)
    assert half["class_means"].count() == 320  # another input never gets the stored tables
    summary, _ = wf.preprocessing_run(spark, wide, root, wide_cols=cols, test_df=wide.drop("label"),
                                      configs=[PrepConfig("normalized"), PrepConfig("pca8", pca_components=8)])
    rows = {r["configuration"]: r for r in summary.collect()}
    assert rows["pca8"]["feature_dimension"] == 8 and rows["normalized"]["test_rows"] == 500
    res = wf.training_run(spark, wide, root, sample_fraction=1.0, wide_cols=cols,
                          config=PrepConfig("pca8", pca_components=8), include_mlp=False)
    assert {r["status"] for r in res.collect()} == {"ok"}
    import json
    doc = json.loads(spark.read.text(f"{root}/metrics/best_model_metrics").first()[0])
    assert len(doc["class_metrics"]) == 10 and doc["train_rows"] + doc["validation_rows"] == 500
    keyed = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"pixel{i}") for i in range(64)],
                     F.floor(F.col("vec_id") / 5).alias("g"), (F.col("vec_id") % 5 + 1).cast("int").alias("pos"))
    decisions = wf.scoring_run(spark, root, keyed, "vec_id", group_col="g", position_col="pos")
    assert decisions.count() == 100 and decisions.filter("valid").count() == 100
    from tabula.plans.models import load_best
    from tabula.streaming.decide_stream import run_decision_stream

    keyed.withColumn("at", F.timestamp_seconds("vec_id")).repartition(3).write.parquet(f"{root}/in/digits.parquet")
    streamed = run_decision_stream(spark, f"{root}/in", "digits", "g", "pos", "at", "vec_id", max_files_per_trigger=1,
                                   model=load_best(spark, f"{root}/models")[1])
    assert streamed.count() == 100 and streamed.select(decisions.columns).exceptAll(decisions).count() == 0


def test_photo_to_decision(spark, tmp_path):
    """Generated photos -> segments -> a classifier trained on segments of
    other generated photos (label = drawn shape) -> one decision per photo."""
    import os

    import numpy as np

    from tabula.operators import images
    from pngfix import png_bytes, white

    def photo(shapes):
        img = white(260, 920)
        for i, kind in enumerate(shapes):
            # no two drawn alike: equal segments would share a side of the split
            x, top, bottom, pen = 55 + 175 * i, 60 + int(rng.integers(0, 20)), 200 - int(rng.integers(0, 20)), int(rng.integers(8, 15))
            if kind == 0:  # ring
                img[top:bottom, x:x + 70] = 30
                img[top + pen:bottom - pen, x + pen:x + 70 - pen] = 255
            else:  # bar
                img[top:bottom, x + 28:x + 28 + pen] = 30
        return png_bytes(img)

    train_dir, new_dir = tmp_path / "train", tmp_path / "new"
    train_dir.mkdir(), new_dir.mkdir()
    rng = np.random.default_rng(1)
    truth = {}
    for i in range(12):
        shapes = [int(v) for v in rng.integers(0, 2, 5)]
        (train_dir / f"t{i}.png").write_bytes(photo(shapes))
        truth[f"t{i}.png"] = shapes
    (new_dir / "n0.png").write_bytes(photo([0, 1, 0, 1, 1]))
    (new_dir / "blank.png").write_bytes(png_bytes(white(200, 500)))

    segs, _ = images.segment_images(images.decoded(spark, str(train_dir)))
    rows = images.segments_as_rows(segs)
    lab = spark.createDataFrame([(f, p + 1, s) for f, sh in truth.items() for p, s in enumerate(sh)],
                                "file string, position int, label int")
    labelled = rows.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(lab, ["file", "position"])
    root = str(tmp_path / "run")
    cols = [f"pixel{i}" for i in range(784)]
    wf.training_run(spark, labelled.drop("file", "path", "position"), root, sample_fraction=1.0,
                    wide_cols=cols, key_col="segment_id", config=PrepConfig("n", pca_components=None),
                    classes=(0, 1), include_mlp=False)
    decisions, status = wf.photo_run(spark, str(new_dir), root)
    st = {r["path"].rsplit("/", 1)[-1]: r["reject_reason"] for r in status.collect()}
    assert st["n0.png"] is None and st["blank.png"] is not None
    (new_dir / "again.png").write_bytes((new_dir / "n0.png").read_bytes())
    (new_dir / "n1.png").write_bytes(photo([1, 1, 0, 0, 0]))
    before = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/photo_results/data").count()
    second, status = wf.photo_run(spark, str(new_dir), root)
    codes = {r["path"].rsplit("/", 1)[-1]: r["postal_code"] for r in second.collect()}
    assert codes == {"n0.png": "01011", "again.png": "01011", "n1.png": "11000"}
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/photo_results/data").count() == before + 1  # the new content only
    assert {r["path"].rsplit("/", 1)[-1]: r["reject_reason"] for r in status.collect()}["blank.png"] is not None
    d = decisions.collect()
    assert len(d) == 1 and d[0]["valid"] and d[0]["postal_code"] == "01011"
