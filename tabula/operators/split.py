"""Sampling and splitting.

The default forms are *content-hash* based: a row's side or inclusion is a
pure function of its key, so results do not depend on partitioning, task
retries or executor loss, and identical rows always land together. Spark's
``sample`` / ``randomSplit`` (the reference's forms) are kept for parity but
depend on the partition layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.functions.hashing import md5_bucket, md5_prefix_int, md5_unit, xxhash_bucket


def hash_sample(df: DataFrame, key: Column, fraction: float, salt: str = "") -> DataFrame:
    """F3 (portable): keep a row when md5(key || salt) maps below ``fraction``."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    k = key.cast("string") if not salt else F.concat(key.cast("string"), F.lit(salt))
    return df.filter(md5_unit(k) < F.lit(fraction))


def native_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """F3 (reference form): Bernoulli sample without replacement."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def with_split(df: DataFrame, key: Column, n_buckets: int = 5, validation_bucket: int = 0,
               method: str = "md5", split_col: str = "split") -> DataFrame:
    """Add ``split`` = 'validation' for one hash bucket, else 'train'.

    ``method='xxhash'`` is the fast native hash (``key`` may then be a struct
    or array of the row's content); ``'md5'`` is reproducible in any SQL engine.
    """
    bucket = xxhash_bucket(n_buckets, key) if method == "xxhash" else md5_bucket(key, n_buckets)
    return df.withColumn(split_col, F.when(bucket == validation_bucket, F.lit("validation"))
                                     .otherwise(F.lit("train")))


def hash_split(df: DataFrame, key: Column, n_buckets: int = 5, validation_bucket: int = 0,
               method: str = "md5") -> tuple[DataFrame, DataFrame]:
    """(train, validation) pair; disjoint and complete by construction."""
    marked = with_split(df, key, n_buckets, validation_bucket, method, "_split")
    train = marked.filter(F.col("_split") == "train").drop("_split")
    val = marked.filter(F.col("_split") == "validation").drop("_split")
    return train, val


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """F4 (reference form): ``randomSplit``; reproducible only for a fixed partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def sample_rows(df: DataFrame, key: Column, n: int = 10) -> DataFrame:
    """F2/K7: ``n`` rows chosen by the smallest md5 of their key (ties by key).

    The limit is the feature here (a fixed-size sample); Spark plans it as a
    per-partition top-n followed by a single small merge.
    """
    return df.orderBy(md5_prefix_int(key), key).limit(n)


def write_split(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One dataset partitioned by side, so readers prune to one side."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
