"""What several corpus operators share: scans, label splits, staging."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import scratch

#: ASCII white space, as the contracts of the corpus operators name it.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Texts can be long, so few rows travel to Python at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


Batches = Iterator[pa.RecordBatch]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, such that its worker, which waits for later tasks, keeps no memory it does not need."""

    def leaving(batches: Batches) -> Batches:
        # The system's allocator can give back what the pooling one would keep.
        pa.set_memory_pool(pa.system_memory_pool())
        yield from run(batches)
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return leaving


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, or with further underscores, so that no column of the frames has it."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read back.

    Several results can then be made of them without computing them again, and a lost executor
    loses none of them.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
