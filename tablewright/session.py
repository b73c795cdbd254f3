"""Session settings and the shared folders a job may write to."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs a further shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Bytes of a shuffle are compressed, and rows of pages that are alike take some seventy times as much
    # in memory, once for each window over them: what a task gets stays that small however large the input.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # A file says little of what its rows take: pages are rendered from a few coded columns. Joins of files are
    # broadcast only where a shuffle has measured a side; local relations have a known size and still are.
    "spark.sql.sources.fileCompressionFactor": "1000",
    # Parsing is CPU work: 64 MB of stored pages is well under a minute for one task.
    "spark.sql.files.maxPartitionBytes": "64m",
    # Addresses seen by a stream are kept outside the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # One page is one row and may be large: keep the batches handed to Python small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}

# Fixed when a session starts. Expressions are long here: noting the line each part was written in takes
# longer than planning them.
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# Shuffles of walks over pages begin with this many partitions at least, and small ones are merged.
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_LEAST_PARTITIONS = 1000


def build_session(app: str = "tablewright", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **AT_START, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def _many_partitions(spark: SparkSession) -> Iterator[None]:
    """Shuffles planned in the block begin with many partitions. Not for joins with tables in buckets, which would be dealt anew."""
    before = spark.conf.get(_PARTITIONS, None)
    spark.conf.set(_PARTITIONS, str(max(_LEAST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PARTITIONS)
        else:
            spark.conf.set(_PARTITIONS, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a folder beside the
    session's own tables is used: Spark keeps those in storage that all executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_shared")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is on shared storage and survives lost executors."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str, walk: bool = False) -> DataFrame:
    """Write an intermediate table to the shared folder once and read it back.

    For rows that several results are made of: the costly parse runs once, later reads take
    only the columns they need, and a lost executor loses none of it. ``walk``: the rows come out of
    windows over pages, whose tasks are kept small by many partitions.
    """
    path = scratch(df.sparkSession, label)
    with _many_partitions(df.sparkSession) if walk else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Buckets:
    """Tables dealt into the same buckets on shared storage, so that joins on their keys find them where they are.

    A table is shuffled once, when it is written, or not at all where its rows already lie by the
    key. Tables leave the catalog at the end of the block; ``files`` reads one without it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self.count = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.paths: dict[str, tuple[str, StructType]] = {}

    def __enter__(self) -> Buckets:
        return self

    def __exit__(self, *_) -> None:
        for name in self.paths:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def write(self, df: DataFrame, key: str, dealt: bool = False) -> DataFrame:
        """The rows as a table in buckets by ``key``. ``dealt``: they come out of a shuffle by it, which is taken as it is."""
        name, path = f"tw_{self.label}_{uuid.uuid4().hex}", scratch(self.spark, self.label)
        rows = df if dealt else df.repartition(self.count, key)
        rows.write.bucketBy(self.count, key).sortBy(key).option("path", path).saveAsTable(name)
        self.paths[name] = (path, df.schema)
        table = self.spark.table(name)
        table._bucket_name = name
        return table

    def files(self, table: DataFrame) -> DataFrame:
        path, schema = self.paths[table._bucket_name]
        return self.spark.read.schema(schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, key: str, label: str) -> Iterator[DataFrame]:
    """The rows as a bucketed table on shared storage, for joins on ``key`` in every round of a loop.

    They are shuffled once, when written; joins on the key then read them where they are. The
    table leaves the catalog at the end of the block, so results must not depend on it by then.
    """
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tw_{label}_{uuid.uuid4().hex}"
    df.repartition(count, key).write.bucketBy(count, key).sortBy(key).option("path", scratch(spark, label)).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
