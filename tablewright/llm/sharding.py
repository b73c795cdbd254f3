"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring of 64-bit hashes; a row belongs to the first point at or
after its own hash. A shard takes a bounded number of rows. Rows that find their shard full go on
clockwise to the next point whose shard has room.

The walk around the ring only needs the number of rows between neighbouring points, so it is done
on ``shards * points`` numbers, whatever the number of rows. Its outcome is a list of runs of
consecutive ranks on the ring, each going to one shard; a row finds its run by its rank.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import written

#: Rows are ranked in cells of the ring: so many bits of the hash name a cell.
CELL_BITS = 16
#: Equal rows are counted as one run, which is written out again in blocks of so many rows.
RUN_BLOCK = 65_536


def ring(shards: int, points: int) -> tuple[np.ndarray, np.ndarray]:
    """The points of the ring in order, as signed 64-bit hashes, and the shard of each."""
    made = sorted((xxhash.xxh64_intdigest(f"{s}/{p}") - 2**63, s) for s in range(shards) for p in range(points))
    return np.array([h for h, _ in made], dtype=np.int64), np.array([s for _, s in made], dtype=np.int32)


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows each shard may take. Without slack they sum up to ``rows`` and differ by one at most."""
    if slack:
        return [int(np.ceil(rows / shards * (1 + slack)))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int]]:
    """Deal the rows between points to shards: (first rank, rows, shard, first slot) in rank order.

    At each point the rows that hash there come first, then those carried on from points before
    it. What its shard has no room for is carried on. Laps go on until nothing is carried.
    """
    room, taken = list(room), [0] * len(room)
    if sum(room) < sum(counts):
        raise ValueError("the shards have no room for all rows")
    carried: deque[tuple[int, int]] = deque()
    placed: list[tuple[int, int, int, int]] = []

    def give(shard: int, first: int, rows: int) -> int:
        """Place as many of a run as fit and say how many did."""
        fits = min(rows, room[shard])
        if fits:
            placed.append((first, fits, shard, taken[shard]))
            room[shard] -= fits
            taken[shard] += fits
        return fits

    start, lap = 0, 0
    while lap == 0 or carried:
        for point, owner in enumerate(owners):
            waiting: list[tuple[int, int]] = []
            if lap == 0:
                fits = give(owner, start, counts[point])
                if fits < counts[point]:
                    waiting.append((start + fits, counts[point] - fits))
                start += counts[point]
            while carried and room[owner]:
                first, rows = carried.popleft()
                fits = give(owner, first, rows)
                if fits < rows:
                    carried.appendleft((first + fits, rows - fits))
            carried.extend(waiting)
        lap += 1
    return sorted(placed)


def shard_rows(docs: DataFrame, shards: int = 40, points: int = 64, slack: float = 0.0) -> DataFrame:
    """Every row's shard and slot: doc_id, size, text_crc32, home_shard, shard, slot.

    ``size`` is the UTF-8 length of the text plus 16, ``home_shard`` the owner of the row's place
    on the ring, ``shard`` where bounded loads put it, ``slot`` its place there, from 0 without
    gaps. Without ``slack`` the shards' row counts differ by one at most; with it a shard takes up
    to ``1 + slack`` times the mean and fewer rows leave home.

    A missing text counts as empty, a very long one is read once, for its size and checksum. A row's
    place comes from its doc_id, or from its text where the doc_id is missing. Rows equal in doc_id,
    size and checksum are one run of neighbouring ranks, counted on the map side, so however many
    there are they never meet in one task. Empty tables give no rows. Other columns are not read.
    """
    hashes, owners = ring(shards, points)

    @F.pandas_udf("int")
    def point_of(place: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(hashes, place.to_numpy(np.int64)) % len(hashes)).astype(np.int32))

    text = F.coalesce(F.col("text"), F.lit(""))
    runs_of_rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("place", F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32", "size")).otherwise(F.xxhash64("doc_id")))
    )
    # Hashes beyond the last point belong to point 0: ``turn`` orders them before its other rows.
    runs_of_rows = runs_of_rows.withColumn("point", point_of("place")).withColumn("turn", (F.col("place") <= F.lit(int(hashes[-1]))).cast("int"))
    runs_of_rows = written(runs_of_rows.withColumn("cell", F.shiftright("place", 64 - CELL_BITS)), "ring")

    cells = runs_of_rows.groupBy("point", "turn", "cell").agg(F.sum("rows").alias("rows"))
    before = Window.partitionBy("point").orderBy("turn", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = written(cells.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))), "cells")
    # One number for each point of the ring, a parameter of this operator.
    found = {r.point: r.rows for r in cells.groupBy("point").agg(F.sum("rows").alias("rows")).collect()}
    counts = [found.get(p, 0) for p in range(len(owners))]
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    runs = walk(counts, owners.tolist(), capacities(sum(counts), shards, slack))
    at, run_shard, run_slot = (np.array([r[i] for r in runs] or [0], dtype=np.int64) for i in (0, 2, 3))

    @F.pandas_udf("home_shard int, shard int, slot long")
    def placed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for point, rank in batches:
            here = point.to_numpy(np.int64)
            ranks = firsts[here] + rank.to_numpy(np.int64)
            run = np.searchsorted(at, ranks, side="right") - 1
            yield pd.DataFrame({"home_shard": owners[here], "shard": run_shard[run].astype(np.int32), "slot": run_slot[run] + ranks - at[run]})

    in_cell = Window.partitionBy("point", "turn", "cell").orderBy("place", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        runs_of_rows.withColumn("in_cell", F.coalesce(F.sum("rows").over(in_cell), F.lit(0)))
        .join(cells.select("point", "turn", "cell", "before"), ["point", "turn", "cell"])
        .select("doc_id", "size", "text_crc32", "point", "rows", (F.col("before") + F.col("in_cell")).alias("first"),
                F.explode(F.sequence(F.lit(0), F.col("rows") - 1, F.lit(RUN_BLOCK))).alias("block"))
        .repartition("doc_id", "text_crc32", "size", "block")
    )
    ends = F.least(F.col("rows"), F.col("block") + RUN_BLOCK) - 1
    ranked = blocks.withColumn("nth", F.explode(F.sequence("block", ends))).withColumn("at", placed("point", F.col("first") + F.col("nth")))
    return ranked.select("doc_id", "size", "text_crc32", "at.home_shard", "at.shard", "at.slot")
