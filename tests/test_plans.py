"""Plan-shape guards: the physical plans keep the properties the design
relies on (built from explain output; nothing heavy is executed)."""

import os
import sys

import pytest

from tabula import registry

from paths import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from plan_audit import summarise  # noqa: E402

# queries whose construction runs jobs (fits, streams, checkpoints, writes)
BUILD_HEAVY = {"prepare_configs", "model_comparison", "batch_score", "stream_score_equals_batch",
               "csv_round_trip", "csv_typed_read", "image_segments", "statistics_reuse", "image_augment", "model_comparison_checks",
               "batch_score_keys", "train_test_read", "stored_frequencies", "stored_column_stats", "stored_std_map", "feature_dimension",
               "minmax_scale", "neural_epochs", "pca_variance"}


def plan_of(spark, name):
    return summarise(registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - BUILD_HEAVY))
def test_no_cartesian_and_no_python_in_relational_queries(spark, name):
    p = plan_of(spark, name)
    assert p["nested_loop"] == 0, name
    assert p["python"] == 0, name


@pytest.mark.parametrize("name", ["neural_epochs", "pca_variance"])
def test_no_nested_loop_after_a_fit(spark, name):
    assert plan_of(spark, name)["nested_loop"] == 0


@pytest.mark.parametrize("name,shuffles", [
    ("class_mean", 1), ("column_stats_long", 1), ("std_map", 1), ("group_decision", 1),
    ("lineitem_class_stats", 1), ("log_loss", 1),
    ("dilate_runs", 0), ("detect_runs", 0), ("merge_runs", 0), ("split_runs", 0),
    ("content_hash", 0), ("hash_split", 0), ("hash_sample", 0), ("softmax_argmax", 0),
])
def test_shuffle_counts(spark, name, shuffles):
    assert plan_of(spark, name)["shuffles"] == shuffles


def test_scans_read_only_used_columns(spark):
    assert plan_of(spark, "class_mean")["scans"] == ["struct<embedding:array<float>,label:int>"]
    assert plan_of(spark, "event_class_stats")["scans"] == ["struct<event_type:string,value:double>"]
    assert plan_of(spark, "null_fill")["scans"] == ["struct<doc_id:bigint,quality:int,toxic:int>",
                                                    "struct<doc_id:bigint>"]
