"""Scans: stored pages, JSON documents, CSV snapshots and the shape of existing tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tablewright.session import stage

PAGE_COLUMNS = ("page_id", "url", "html")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few, large file splits as many partitions as there are cores.

    For a scan of many files this does nothing, so no shuffle is added at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scan_pages(spark: SparkSession, path: str, only: Column | None = None) -> DataFrame:
    """Pages of a corpus; ``only`` is a predicate on the URL, applied before any parsing."""
    pages = spark.read.parquet(path).select(*PAGE_COLUMNS)
    return pages if only is None else pages.where(only)


def json_fields(documents: DataFrame, text: str, schema: T.StructType | str, keep: list[str]) -> DataFrame:
    """Parse a JSON text column with a known schema; the struct lands in ``doc``."""
    return documents.select(*keep, F.from_json(F.col(text), schema).alias("doc"))


def json_path(text: Column, path: str, as_type: str = "string") -> Column:
    """One value out of a JSON text of open shape; unreadable texts give null."""
    return F.try_variant_get(F.try_parse_json(text), path, as_type)


def json_values(documents: DataFrame, text: str, record: list[str]) -> DataFrame:
    """Every value of JSON texts of any shape, in long form: ``(*record, path, value, seq)``.

    ``path`` names the value, as in ``$.a[0].b``, ``value`` is its text (missing for null) and ``seq``
    counts the values of a text in the order of its keys. Texts are taken apart level by level, with as many rounds as the
    deepest has levels; an unreadable or missing text, an empty object and an empty list have no values.
    """
    spark = documents.sparkSession
    kind = F.schema_of_variant("v")
    container = F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))
    level = documents.select(F.struct(*record).alias("record"), F.lit("$").alias("path"), F.array().cast("array<bigint>").alias("place"), F.try_parse_json(F.col(text)).alias("v")).where("v IS NOT NULL")
    leaves = []
    while True:
        level = stage(level.withColumn("inner", container).withColumn("v", F.to_json("v")), "json")
        leaves.append(level.where("NOT inner").select("record", "path", "place", F.col("v").alias("json")))
        inner = level.where("inner").withColumn("v", F.parse_json("v"))
        if inner.isEmpty():
            break
        found = inner.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("pos"), F.col("key"), F.col("value")))
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("key")))
        level = found.select("record", F.concat("path", step).alias("path"), F.concat("place", F.array(F.col("pos").cast("bigint"))).alias("place"), F.col("value").alias("v"))
    every = reduce(lambda a, b: a.unionByName(b), leaves)
    order = Window.partitionBy("record").orderBy("place")
    shown = F.try_variant_get(F.parse_json("json"), "$", "string")
    return every.select("record.*", "path", shown.alias("value"), (F.row_number().over(order) - 1).cast("bigint").alias("seq"))


def script_json(html: Column, script_id: str, path: str) -> Column:
    """One key of the JSON document inside the script element with the given id."""
    body = F.regexp_extract(
        html, rf"(?is)<script[^>]*\bid=[\"']{script_id}[\"'][^>]*>(.*?)</script", 1
    )
    return F.get_json_object(body, path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV whose first, unnamed column is a row number: the number is read and dropped.

    Columns are bound by the names in the header, whatever their order; a column that the file
    lacks is missing, one that the schema lacks is left out. Files of one folder share a header.
    """
    # Only the header is read here; what the files hold is read as text and cast by name.
    header = spark.read.option("header", True).csv(path)
    raw = spark.read.schema(header.schema).option("header", True).option("enforceSchema", False).csv(path)
    column = lambda f: F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in raw.columns[1:] else F.lit(None).cast(f.dataType)
    return raw.select(*[column(f).alias(f.name) for f in schema.fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def table_shape(df: DataFrame) -> list[tuple[str, str]]:
    """Columns and types of an existing table, in order."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def catalog_shapes(spark: SparkSession) -> dict[str, list[tuple[str, str]]]:
    """Columns and types of every table the catalog holds."""
    return {
        t.name: [(c.name, c.dataType) for c in spark.catalog.listColumns(t.name)]
        for t in spark.catalog.listTables()
    }
