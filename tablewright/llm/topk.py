"""Exact search for the best inner products: tiled matrix products and a tree of merges.

Queries are cut into blocks and candidates into shards. Each block meets each shard in one task,
which holds the block and streams the shard tile by tile; a tile's product is cut to every query's
best few at once. The lists of a query are merged by groups of shards, level by level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries in one block, queries and candidates in one matrix product: a product is 8 MB.
BLOCK, TILE = 8192, 1024
#: Candidates in one shard, and lists that one merge takes in.
SHARD, FAN_IN = 16384, 16
#: Doubles hold integers exactly below this.
EXACT = float(2**53)


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and ``floor(scale * x)`` of every component, for vectors that can take part.

    Vectors that are missing, hold a missing or non-finite component or have no vec_id do not.
    """
    x = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double")).alias("v")
    )


def best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Where each row's k best are: highest score first, ties to the smaller id."""
    order = np.lexsort((ids, -scores, rows))
    sorted_rows = rows[order]
    first = np.r_[True, sorted_rows[1:] != sorted_rows[:-1]] if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


def product(queries: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; beyond the exact range of doubles in 64-bit integers."""
    width = max(1, queries.shape[1])
    if np.abs(queries).max(initial=0) * np.abs(tile).max(initial=0) * width < EXACT:
        return (queries @ tile.T).astype(np.int64)
    return queries.astype(np.int64) @ tile.astype(np.int64).T


def search_tile(state: dict, ids: np.ndarray, tile: np.ndarray, k: int) -> None:
    """Merge one tile of candidates into the block's lists, TILE queries at a time."""
    for at in range(0, len(state["ids"]), TILE):
        queries, own = state["vectors"][at : at + TILE], state["ids"][at : at + TILE]
        scores = product(queries, tile)
        low = np.iinfo(np.int64).min
        same = own[:, None] == ids[None, :]
        masked = np.where(same, low, scores)
        least = np.partition(masked, -k, axis=1)[:, -k] if masked.shape[1] > k else np.full(len(own), low)
        r, c = np.nonzero((masked >= least[:, None]) & ~same)
        rows, found, values = r + at, ids[c], scores[r, c]
        old = state["lists"].get(at)
        if old:
            rows, found, values = (np.concatenate(x) for x in zip(old, (rows, found, values), strict=True))
        keep = best(rows, found, values, k)
        state["lists"][at] = (rows[keep], found[keep], values[keep])


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """Each query's ``k`` highest integer inner products: query_id, rank, vec_id, score.

    ``is_query`` picks the queries among the rows; candidates are all rows but those with the
    query's own vec_id. Ties go to the smaller vec_id. With fewer candidates the list is shorter.
    Vectors of another length than the query's do not meet it. Of query rows that share a vec_id
    the smallest vector searches; repeated candidate rows are found as often as they occur.
    Empty tables give no rows; other columns are not read. Scores are 64-bit: a finite component
    beyond 2^63 / ``scale`` counts as the 64-bit limit, and inner products must themselves fit.
    """
    usable = quantised(vectors, scale)
    queries = usable.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    # Two counts decide how finely the work is cut; they change no result.
    blocks = max(1, -(-queries.count() // BLOCK))
    shards = max(1, -(-usable.count() // SHARD))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    left = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), part.alias("block"), F.lit(0).alias("side"), "vec_id", "v")
    right = usable.select(
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(1).alias("side"), "vec_id", "v",
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell (shard, block, length), queries first."""
        state: dict = {}

        def results() -> Iterator[pa.RecordBatch]:
            for rows, found, scores in state.get("lists", {}).values():
                yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(len(rows), state["cell"][0], np.int32)), "query_id": state["ids"][rows], "vec_id": found, "score": scores})

        for batch in batches:
            cells = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3)], axis=1)
            cuts = np.r_[0, np.nonzero(np.any(cells[1:] != cells[:-1], axis=1))[0] + 1, len(cells)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                cell, side = tuple(int(x) for x in cells[lo, :3]), cells[lo, 3]
                if state.get("cell") != cell:
                    yield from results()
                    state = {"cell": cell, "ids": np.zeros(0, np.int64), "vectors": np.zeros((0, cell[2])), "lists": {}}
                ids = batch.column(4).slice(lo, hi - lo).to_numpy()
                values = batch.column(5).slice(lo, hi - lo).flatten().to_numpy().reshape(hi - lo, cell[2])
                if side == 0:
                    state["ids"], state["vectors"] = np.concatenate([state["ids"], ids]), np.concatenate([state["vectors"], values])
                elif len(state["ids"]):
                    for at in range(0, len(ids), TILE):
                        search_tile(state, ids[at : at + TILE], values[at : at + TILE], k)
        yield from results()

    met = (
        left.unionByName(right)
        .select("shard", "block", F.size("v").alias("width"), "side", "vec_id", "v")
        .repartition("shard", "block", "width")
        .sortWithinPartitions("shard", "block", "width", "side", "vec_id")
        .mapInArrow(meet, "shard int, query_id long, vec_id long, score long")
    )
    order = (F.col("score").desc(), F.col("vec_id"))
    while shards > FAN_IN:
        group = Window.partitionBy("query_id", "shard").orderBy(*order)
        met = met.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int")).withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= k).drop("rank")
        shards = -(-shards // FAN_IN)
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
