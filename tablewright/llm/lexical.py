"""Ranked lexical search: the best documents of every item, found by the terms they hold.

The items are the stated query set; their distinct terms are a small vocabulary. One pass over the
documents keeps, for each, how often it holds each term of the vocabulary. A second pass over these
postings takes blocks of documents. In a block every term has a bitmap of the documents that hold
it. For an item the bitmaps of its terms are turned into one mask for each document, and documents
of one mask are a group. A mask's highest possible score is the sum of the highest scores its terms
reach in the block. Masks are evaluated from the highest such sum down, until the sum of the next is
below the last of the best scores found so far: nothing that is left can enter the list. A task
carries its lists from block to block, so later blocks mostly end at once. The lists of all tasks
are merged in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import lean, written

#: Items, and distinct terms of items, that one pass over the documents serves.
ITEMS, TERMS = 1024, 32768
#: Documents in a block: the bitmap of a term takes an eighth of this in bytes.
BLOCK = 4096
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20
#: First merges of lists, by task.
SALTS = 256

#: Bytes of terms, with A-Z as a-z; all others are blanks.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def term_counts(text: bytes | None) -> Counter[bytes]:
    """How often a text holds each of its terms."""
    data, counts, at = (text or b"").translate(_TERM_BYTES), Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and its distinct terms, sorted. Rows that share an item_id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                found = term_counts(text)
                ids += [item] * len(found)
                terms += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string())], ["item_id", "term"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(lean(run), "item_id long, term string")
    return rows.distinct().groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[str]]]]:
    """The items, as many at a time as one pass serves."""
    block, seen = [], set()
    for row in item_terms(items).orderBy("item_id").toLocalIterator():
        if block and (len(block) == ITEMS or len(seen.union(row.terms)) > TERMS):
            yield block
            block, seen = [], set()
        block.append((row.item_id, row.terms))
        seen.update(row.terms)
    if block:
        yield block


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, all its terms with repeats, and how often it holds each of the vocabulary's, by number."""
    shared = docs.sparkSession.sparkContext.broadcast({term.encode(): i for i, term in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            total, bounds, terms, counts = [], [0], [], []
            texts = batch.column(1).cast(pa.large_binary())
            for i in range(len(texts)):
                found = term_counts(texts[i].as_py())
                total.append(found.total())
                own = sorted((k, n) for k, n in ((number(t), n) for t, n in found.items()) if k is not None)
                terms += [k for k, _ in own]
                counts += [n for _, n in own]
                bounds.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), *lists], ["doc_id", "n_terms", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lean(run), "doc_id long, n_terms long, terms array<int>, counts array<long>")


class Block:
    """Postings of some documents: by document as they come, and a bitmap for every term."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, n_terms: np.ndarray, bounds: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int, total: int):
        self.ids, self.missing, self.bounds, self.terms = ids, missing, bounds, terms
        # Beyond 64 bits in between, Python's whole numbers.
        wide = int(n_terms.max(initial=0)) * n * 90 >= 2**63
        length = (10 + (90 * n_terms.astype(object) * n) // total).astype(np.int64) if wide else 10 + (90 * n_terms * n) // total
        owner = np.repeat(np.arange(len(ids)), np.diff(bounds))
        self.gain = (1_000_000_000 * counts) // (1000 * counts + 8 * length[owner])
        # By term: which of them occur here, their highest gains and their bitmaps.
        order = np.argsort(terms, kind="stable")
        first = np.nonzero(np.diff(terms[order], prepend=-1))[0]
        self.present = terms[order][first]
        self.most = np.maximum.reduceat(self.gain[order], first) if len(first) else np.zeros(0, np.int64)
        self.bitmaps = np.zeros((len(first), -(-len(ids) // 8)), np.uint8)
        edges = np.r_[first, len(order)]
        row = np.zeros(len(ids), bool)
        for i in range(len(first)):
            here = owner[order[edges[i] : edges[i + 1]]]
            row[here] = True
            self.bitmaps[i] = np.packbits(row)
            row[here] = False

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Scores of some documents, with the weight of each term of the vocabulary."""
        sizes = self.bounds[docs + 1] - self.bounds[docs]
        ends = np.cumsum(sizes)
        at = np.repeat(self.bounds[docs] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        sums = np.r_[0, np.cumsum(weight[self.terms[at]] * self.gain[at])]
        return sums[ends] - sums[ends - sizes]

    def groups(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents in the order of their masks, where each mask's begin, and the terms of each mask.

        Documents that hold no term have no mask.
        """
        held = np.unpackbits(self.bitmaps[rows], axis=1, count=len(self.ids))
        masks = np.ascontiguousarray(np.packbits(held, axis=0).T)
        masks = np.pad(masks, ((0, 0), (0, -masks.shape[1] % 8))).view(np.uint64)
        docs = np.nonzero(masks.any(1))[0]
        masks = masks[docs]
        order = np.lexsort(masks.T)
        first = np.nonzero(np.r_[True, (masks[order][1:] != masks[order][:-1]).any(1)])[0] if len(order) else np.zeros(0, np.int64)
        docs = docs[order]
        return docs, first, held[:, docs[first]]


class Best:
    """The k best documents of one item: highest score first, ties to the smaller doc_id, missing ones last."""

    def __init__(self, k: int):
        self.k, self.rows = k, (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))

    def least(self) -> int:
        """What a document must score at least to enter."""
        return int(self.rows[0][-1]) if len(self.rows[0]) == self.k else 1

    def add(self, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        enough = scores >= self.least()
        both = [np.concatenate([old, new[enough]]) for old, new in zip(self.rows, (scores, missing, ids), strict=True)]
        order = np.lexsort((both[2], both[1], -both[0]))[: self.k]
        self.rows = tuple(x[order] for x in both)


def search_block(block: Block, terms: np.ndarray, weights: np.ndarray, best: Best, size: int) -> None:
    """Evaluate the masks of one item, highest possible score first, until none that is left can enter."""
    there = np.isin(terms, block.present)
    if not there.any():
        return
    rows = np.searchsorted(block.present, terms[there])
    # Sums of whole numbers far below 2^53: exact in doubles.
    highest = (weights[there] * block.most[rows]).astype(float)
    if highest.sum() < best.least():
        return
    docs, first, held = block.groups(rows)
    bound = highest @ held
    ends = np.r_[first[1:], len(docs)]
    order = np.argsort(-bound, kind="stable")
    weight = np.zeros(size, np.int64)
    weight[terms] = weights
    at, step = 0, 64
    while at < len(order):
        # Some masks at a time, as long as they can enter; equal scores can by their doc_id.
        able = int(np.searchsorted(-bound[order], -best.least(), side="right"))
        taken = order[at : min(at + step, able)]
        if not len(taken):
            return
        some = np.concatenate([docs[first[g] : ends[g]] for g in taken])
        best.add(block.scores(some, weight), block.missing[some], block.ids[some])
        at, step = at + step, step * 2


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Each item's ``k`` highest-scoring documents with a score above 0: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z as a-z.
    A term weighs floor(1000 ln((2N+2) / (2df+1))); a document that holds it tf times among its n
    adds that weight times (10^9 tf) div (1000 tf + 8m), m = 10 + (90 n N) div L, where N documents
    with a term have L terms. Equal scores go to the smaller doc_id.

    Missing and empty texts have no terms and are never found. Every row of ``docs`` is a document
    of its own: repeated rows and rows that share a doc_id are counted and listed one by one, and a
    missing doc_id comes after all others of its score. Rows of ``items`` that share an item_id, a
    missing one included, are one item with the terms of all. Items without terms or matches have no
    rows, and neither have empty tables. Whole texts count, however long; other columns are not read.
    """
    spark = docs.sparkSession
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items):
        found = found.unionByName(rank_block(docs, block, k))
    return found


def rank_block(docs: DataFrame, items: list[tuple[int | None, list[str]]], k: int) -> DataFrame:
    """``rank`` for as many items as one pass serves."""
    spark = docs.sparkSession
    vocabulary = sorted({t for _, terms in items for t in terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    rows = written(postings(docs, vocabulary), "postings")
    n, total = rows.where("n_terms > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    # One number for each term of the vocabulary.
    holding = dict(rows.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator())
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * holding.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)
    wanted = [np.array([number[t] for t in terms], np.int32) for _, terms in items]
    shared = spark.sparkContext.broadcast((wanted, weight))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weight = shared.value
        lists = [Best(k) for _ in wanted]

        def take(waiting: list[pa.RecordBatch]) -> None:
            every = pa.Table.from_batches(waiting).combine_chunks()
            ids, n_terms, terms, counts = (every.column(i).combine_chunks() for i in range(4))
            sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
            block = Block(
                ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), n_terms.to_numpy(),
                np.r_[0, np.cumsum(sizes)].astype(np.int64), terms.flatten().to_numpy(), counts.flatten().to_numpy(), n, total,
            )
            for own, best in zip(wanted, lists, strict=True):
                search_block(block, own, weight[own], best, len(weight))

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = BLOCK - sum(b.num_rows for b in waiting)
                waiting.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in waiting) == BLOCK:
                    take(waiting)
                    waiting = []
        if waiting:
            take(waiting)
        for i, best in enumerate(lists):
            scores, missing, ids = best.rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i, np.int32)), pa.array(ids, mask=missing), pa.array(scores)], ["item", "doc_id", "score"])

    met = rows.where("n_terms > 0").mapInArrow(lean(search), "item int, doc_id long, score long")
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    salted = met.withColumn("salt", F.spark_partition_id() % SALTS)
    some = Window.partitionBy("item", "salt").orderBy(*order)
    salted = salted.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    # Items go by their number, so that a missing item_id is one too.
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
