"""Exact removal of repeated texts that no hot text can slow down.

Copies are merged in three stages, each comparing whole texts among rows of one digest:

1. within a batch of the scan, before anything is shuffled;
2. among the survivors that share a digest and a salt;
3. among the winners of all salts of a digest.

A text that a third of all rows hold reaches stage 2 once per batch, spread over all salts, and
stage 3 once per salt. Each row that a stage drops becomes a note of its stand-in, without its
text. Notes are followed back stage by stage, so no join meets all copies of a text at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import BLANKS, lean, written

SALTS = 64
#: Stands for a missing doc_id: it comes after all others.
NO_ID = 2**63 - 1
#: ``level``: the stage that dropped the row, 0 while it stands; ``winner``: its stand-in in that stage; ``rows``: equal rows of its batch.
FIELDS = [("level", pa.int32()), ("row", pa.int64()), ("winner", pa.int64()), ("rows", pa.int64()), ("digest", pa.string()), ("text", pa.string())]
SCHEMA = "level int, row long, winner long, rows long, digest string, text string"
Merge = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; a missing text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def batch_of(*columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, FIELDS, strict=True)], [name for name, _ in FIELDS])


def merge_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stage 1: of each batch's equal texts the smallest row stands; columns row, digest, text."""
    for batch in batches:
        rows, digests, texts = (batch.column(i).to_pylist() for i in range(3))
        first: dict[tuple[str, str], int] = {}
        level, winner, count = [0] * len(rows), list(rows), [1] * len(rows)
        for i in sorted(range(len(rows)), key=rows.__getitem__):
            j = first.setdefault((digests[i], texts[i]), i)
            if i != j:
                level[i], winner[i], texts[i] = 1, rows[j], None
                count[j] += 1
        yield batch_of(level, rows, winner, count, digests, texts)


def merge_sorted(stage: int) -> Merge:
    """Stages 2 and 3: standing rows come sorted by digest, salt and row; notes pass by."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, first = None, {}
        for batch in batches:
            level, rows, winner, count, digests, texts, salts = (batch.column(i).to_pylist() for i in range(7))
            for i in range(len(rows)):
                if level[i]:
                    continue
                if group != (digests[i], salts[i]):
                    group, first = (digests[i], salts[i]), {}
                # Holds one text, unless different texts share a SHA-256.
                j = first.setdefault(texts[i], (rows[i], i, batch))
                if j[1] != i or j[2] is not batch:
                    level[i], winner[i], texts[i] = stage, j[0], None
            yield batch_of(level, rows, winner, count, digests, texts)

    return merge


def exact_notes(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The three stages: every row's level and stand-in, written without texts."""
    text = normalised(F.col("text"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("row"), F.sha2(text, 256).alias("digest"), text.alias("text"))
    found = rows.mapInArrow(merge_batch, SCHEMA)
    for stage, standing in ((2, F.pmod(F.xxhash64("row"), F.lit(salts))), (3, F.lit(0).cast("long"))):
        # Notes are dealt by their own row: those of a hot text spread over all tasks.
        salted = found.withColumn("salt", F.when(F.col("level") == 0, standing).otherwise(F.xxhash64("row", "level")))
        found = salted.repartition("digest", "salt").sortWithinPartitions("digest", "salt", "row").mapInArrow(merge_sorted(stage), SCHEMA)
    return written(found.drop("text"), "copies")


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """Every row's group of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after runs of ASCII white space became one space; a missing text
    counts as empty, so missing and empty texts form a group. Of a group the row with the smallest
    doc_id stays, and ``keep_id`` is that doc_id. Exactly one row of a group is ``kept``, also
    where whole rows repeat. A missing doc_id comes after all others; ``keep_id`` is missing only
    where no row of the group has one. Empty tables give no rows; other columns are not read.
    """
    found = exact_notes(docs, salts)

    def dropped(stage: int) -> DataFrame:
        return found.where(F.col("level") == stage).select("digest", "row", "rows", "winner")

    def followed(stage: int, above: DataFrame) -> DataFrame:
        """The rows a stage dropped, with what their stand-ins have by now."""
        have = above.withColumnRenamed("row", "winner").drop("rows", "stands")
        return dropped(stage).join(have, ["digest", "winner"]).drop("winner").withColumn("stands", F.lit(False))

    final = found.where("level = 0").select("digest", "row", "rows", F.col("row").alias("keep"), F.lit(True).alias("stands"))
    third = dropped(3).withColumnRenamed("winner", "keep").withColumn("stands", F.lit(False))
    top = final.unionByName(third)
    both = top.unionByName(followed(2, top))
    sizes = both.groupBy("digest", "keep").agg(F.sum("rows").alias("group_size"))
    top = top.join(sizes, ["digest", "keep"])
    upper = top.unionByName(followed(2, top))
    # Rows that share a doc_id and a text can be in several batches; what they stand for is the same.
    every = upper.unionByName(followed(1, upper.dropDuplicates(["digest", "row"])))

    def named(row: str) -> Column:
        return F.when(F.col(row) != NO_ID, F.col(row))

    return every.select(named("row").alias("doc_id"), named("keep").alias("keep_id"), "group_size", F.col("stands").alias("kept"), F.col("digest").alias("text_sha256"))


def standing(within: bool) -> Merge:
    """Rows of which none with the same text came before: in their batch, or, sorted by digest and salt, at all.

    Batches hold ``doc`` (the whole row), row, tie, digest, salt. Texts are compared where digests agree.
    """

    def text(batch: pa.RecordBatch, i: int) -> str:
        found = batch.column(0).field("text")[i].as_py()
        return re.sub(BLANKS, " ", found or "")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, firsts = None, {}
        for batch in batches:
            rows, ties, digests, salts = (batch.column(i).to_pylist() for i in range(1, 5))
            order = sorted(range(len(rows)), key=lambda i: (rows[i], ties[i])) if within else range(len(rows))
            stays = [True] * len(rows)
            if within:
                firsts = {}
            for i in order:
                if not within and group != (digests[i], salts[i]):
                    group, firsts = (digests[i], salts[i]), {}
                # Holds one row, unless different texts share a SHA-256.
                before = firsts.setdefault(digests[i], [])
                stays[i] = not before or all(text(*b) != text(batch, i) for b in before)
                if stays[i]:
                    # A row of its own: a whole batch is not held for it.
                    before.append((batch.slice(i, 1).take(pa.array([0])), 0))
            yield batch.filter(pa.array(stays, pa.bool_()))

    return keep


def deduplicated(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal texts the smallest doc_id.

    Whole rows go through the three stages, so texts are shuffled twice and never joined. Of rows that
    share a doc_id and a text, the one whose JSON has the smallest hash stays, however rows are dealt;
    a missing doc_id comes after all others. Missing and empty texts are one text. Texts are compared
    whole; an empty table stays empty; columns of any name are carried along.
    """
    row = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("doc"), row.alias("row"), F.md5(F.to_json(whole).cast("binary")).alias("tie"), F.sha2(normalised(F.col("text")), 256).alias("digest"), F.lit(0).cast("long").alias("salt"))
    # Missing doc_ids come last even where a doc_id has the largest number.
    rows = rows.withColumn("tie", F.concat(F.when(F.col("doc.doc_id").isNull(), "1").otherwise("0"), F.col("tie")))
    found = rows.mapInArrow(lean(standing(within=True)), rows.schema)
    for salt in (F.pmod(F.xxhash64("row", "tie"), F.lit(salts)), F.lit(0).cast("long")):
        salted = found.withColumn("salt", salt)
        found = salted.repartition("digest", "salt").sortWithinPartitions("digest", "salt", "row", "tie").mapInArrow(lean(standing(within=False)), rows.schema)
    return found.select("doc.*")
