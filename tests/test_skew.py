"""Joins on a key that a third of the rows share are split, and stay whole."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import details, rename, reshape as S, sinks as K

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
    return spark.range(0, n, 1, 8).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))


def final_plan(df):
    count = df.count()
    df = df.groupBy().agg(F.count("*"), F.max("payload"))
    df.collect()
    return count, df._jdf.queryExecution().executedPlan().toString()


def test_dictionary_join_splits_the_hot_key(small_partitions):
    spark = small_partitions
    mapping = {"hot": "HOT", **{f"k{i}": f"K{i}" for i in range(0, 5000, 7)}}
    df = rename.rename_exact(hot_rows(spark), "k", mapping)
    assert df.where("k = 'HOT'").count() == 20_000
    count, plan = final_plan(df)
    assert count == 60_000 and "skew=true" in plan


def test_detail_join_splits_the_hot_link(small_partitions):
    spark = small_partitions
    rows = hot_rows(spark).withColumn("link", F.concat(F.lit("https://h.example/"), "k"))
    pages = spark.range(5000).select(F.concat(F.lit("https://h.example/k"), F.col("id").cast("string")).alias("url"), F.col("id").alias("fact"))
    pages = pages.unionByName(spark.createDataFrame([("https://h.example/hot", -1)], "url string, fact long"))
    joined = details.join_details(rows, pages)
    assert joined.where("fact = -1").count() == 20_000
    count, plan = final_plan(joined)
    assert count == 60_000 and "skew=true" in plan


def test_ordered_dedupe_splits_the_hot_key(small_partitions):
    spark = small_partitions
    df = hot_rows(spark)
    kept = S.dedupe_ordered(df, ["k"], "id", F.col("id") % 59_999 == 59_998)
    # The only blocking rows come last, so everything before them stays.
    want = [r.id for r in df.where("id % 59999 = 59998").collect()]
    assert want == [59_998]
    count, plan = final_plan(kept)
    key = df.where("id = 59998").first().k
    assert count == 60_000 - df.where((F.col("k") == key) & (F.col("id") > 59_998)).count() and "skew=true" in plan


def test_newest_shuffles_one_row_per_task_and_key(small_partitions):
    spark = small_partitions
    df = hot_rows(spark)
    found = K.newest(df, ["k"], F.col("id"))
    assert found.where("k = 'hot'").first().id == 59_997
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
