"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source's rate is how often each of its documents is to be seen on average. A document's count
is the inverse of the Poisson distribution of that rate at a number in [0, 1) hashed from the
seed and its doc_id: no state, the same on every run and after any retry. Counts are exploded
and the copies dealt over the whole cluster by a hashed key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import unused, written


def hashed(*parts: Column | str) -> Column:
    """60 bits of the MD5 of the parts joined by a bar, as a whole number."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def rates(docs: DataFrame, targets: dict[str, float] | None = None, power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """Every source's size and mean repetition rate: source, n_bytes, weight, rate.

    ``targets`` names the weights of sources; those it leaves out get none. Without it a source
    weighs its bytes to the ``power``. Weights are shares of ``epochs`` times the corpus. A source
    without any bytes cannot reach a share and has rate 1. A missing source is a
    source of its own.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).cast("long").alias("n_bytes"))
    if targets is None:
        share = F.pow(F.col("n_bytes").cast("double"), F.lit(float(power)))
    else:
        share = F.coalesce(*[F.when(F.col("source") == s, F.lit(float(w))) for s, w in targets.items()], F.lit(0.0))
    sizes = written(sizes.withColumn("share", F.when(F.col("n_bytes") > 0, share).otherwise(0.0)), "sources")
    total = sizes.agg(F.sum("share").alias("share"), F.sum("n_bytes").alias("n_bytes")).first()
    weight = F.col("share") / F.lit(total.share or 1.0)
    rate = weight * F.lit(float(epochs)) * F.lit(float(total.n_bytes or 0)) / F.col("n_bytes")
    return sizes.select("source", "n_bytes", weight.alias("weight"), F.when(F.col("n_bytes") > 0, rate).otherwise(F.lit(1.0)).alias("rate"))


def distribution(rated: DataFrame) -> DataFrame:
    """Each source's cumulative Poisson distribution as an array, to beyond any chance that matters."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 24).cast("int")
    steps = rated.select("source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    # Logarithms, as exp(-rate) alone is zero for large rates.
    chance = F.exp(F.sum(F.when(F.col("k") == 0, -F.col("rate")).otherwise(F.log("rate") - F.log("k"))).over(upto))
    cumulative = steps.where("rate > 0").withColumn("chance", chance).withColumn("upto", F.sum("chance").over(upto))
    return cumulative.groupBy("source").agg(F.sort_array(F.collect_list("upto")).alias("cumulative"))


def mix_sources(docs: DataFrame, targets: dict[str, float] | None = None, power: float = 0.5, epochs: float = 1.0, seed: str = "mix-1") -> DataFrame:
    """The mixed corpus: all columns of ``docs`` with n_copies, copy (from 1) and shuffle_key.

    Rows come out in the order of ``shuffle_key``, which deals the copies of all sources over all
    partitions. A document of a source that is to be seen less than once is often left out, one
    that is to be seen more often comes several times. Documents with the same doc_id and source
    share their count; a missing doc_id counts as an empty one. Texts may be missing, empty or
    long: whole rows are dealt. Columns of these three names in the input are replaced; an empty
    table stays empty.
    """
    docs = docs.drop("n_copies", "copy", "shuffle_key")
    # Written, so that Spark knows the size of this table before it plans the join.
    table = written(distribution(rates(docs, targets, power, epochs)), "poisson")
    named, steps = unused("mix_source", docs), unused("mix_cumulative", docs)
    table = table.select(F.col("source").alias(named), F.col("cumulative").alias(steps))
    chance = hashed(seed, "count", F.col("doc_id")) / F.lit(float(2**60))
    counted = (
        docs.join(table, F.col("source").eqNullSafe(F.col(named)))
        .withColumn("n_copies", F.size(F.filter(steps, lambda c: c <= chance)).cast("long"))
        .drop(named, steps)
    )
    copies = counted.where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    keyed = copies.withColumn("shuffle_key", hashed(seed, "order", F.col("doc_id"), F.col("copy")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartitionByRange(parts, "shuffle_key").sortWithinPartitions("shuffle_key")
