from pyspark.sql import functions as F

from tabula.operators import split


def test_split_disjoint_complete_and_partition_independent(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 97).cast("string").alias("content"))
    a = split.with_split(df.repartition(2), F.col("content")).select("id", "split")
    b = split.with_split(df.repartition(11), F.col("content")).select("id", "split")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    train, val = split.hash_split(df, F.col("content"))
    assert train.count() + val.count() == 5000
    assert train.select("id").intersect(val.select("id")).count() == 0
    # identical content always on the same side
    sides = a.join(df, "id").groupBy("content").agg(F.countDistinct("split").alias("n"))
    assert sides.filter("n > 1").count() == 0


def test_hash_sample_fraction_and_determinism(spark):
    df = spark.range(20000)
    s1 = split.hash_sample(df, F.col("id"), 0.2)
    s2 = split.hash_sample(df.repartition(7), F.col("id"), 0.2)
    n = s1.count()
    assert 3600 < n < 4400
    assert s1.exceptAll(s2).count() == 0


def test_xxhash_variant(spark):
    df = spark.range(1000).select("id", F.array(F.col("id"), F.lit(1)).alias("v"))
    m = split.with_split(df, F.col("v"), method="xxhash")
    assert set(r["split"] for r in m.select("split").distinct().collect()) == {"train", "validation"}


def test_sample_rows_limit_is_exact(spark):
    df = spark.range(1000)
    assert split.sample_rows(df, F.col("id"), 10).count() == 10
    assert sorted(r.id for r in split.sample_rows(df.repartition(5), F.col("id"), 10).collect()) == \
        sorted(r.id for r in split.sample_rows(df, F.col("id"), 10).collect())


def test_native_split_groups_identical_content(spark):
    import __spark_entry__ as entry

    out = entry.queries()["hash_split_native"](spark, "/root/testdata/sf0.001")
    assert out.count() == 500
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    dup = e.unionByName(e.withColumn("vec_id", F.col("vec_id") + 10_000))  # exact copies of every row
    m = split.with_split(dup, F.struct("label", "embedding"), method="xxhash")
    per = m.groupBy("label", "embedding").agg(F.countDistinct("split").alias("n"))
    assert per.filter("n > 1").count() == 0
