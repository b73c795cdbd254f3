"""Near-duplicates by b-bit MinHash, every link confirmed on the full sets.

Each document becomes the set of its distinct word shingles. Its signature keeps the smallest value
of 128 hash functions over the set, of which the low four bits are packed; runs of whole minima
are hashed to band keys. Documents with equal sets are one class from the start.

Classes that share a band key are candidates. Of a bucket every class is first paired with its
smallest one only. The packed bits of a pair give its similarity, corrected for minima that agree
by chance; pairs far below the threshold or of too different sizes go, all others are confirmed on
the sets themselves, and links join classes into components.

Where a bucket still holds several components, the signatures of its members are compared in
blocks, the members of its largest component only with those of others. A member first asks for
the one class of another component that it resembles most, then for a few; in a group of copies
nearly all meet in one component by that. What is left of crowds, members that still resemble more
classes than they may ask for, is compared set by set where their sets meet, and only links come
out. So every pair of a bucket ends in one component, or ruled out by its signatures, or confirmed
or refuted on its sets, and pairs that are no links are never made in numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import lean, unused, written
from tablewright.session import bucketed

#: Hash functions, minima in a band, low bits kept of a minimum.
HASHES, ROWS, BITS = 128, 4, 4
#: Pairs whose estimate is this far below the threshold are not confirmed: four standard deviations.
MARGIN = 0.15
#: How many classes a member of a bucket asks for, round by round.
ASKED = (1, 4, 16)
#: Members of a bucket that are held at a time, and that meet them at a time.
BLOCK, TILE = 2048, 256
#: Members of a crowd whose sets are held at a time.
HELD = 256
#: Bytes of text hashed at a time.
PIECE = 1 << 20

_random = np.random.default_rng(20)
_BYTE = _random.integers(0, 2**64, 256, np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_PLACE = _random.integers(0, 2**63, 1 << 16, np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _random.integers(0, 2**31, HASHES, np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _random.integers(0, 2**32, HASHES, np.uint64).astype(np.uint32)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def scrambled(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number as one that looks random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of texts that lie one after the other, and where each word starts.

    Words are runs of bytes other than ASCII white space; A-Z count as a-z. ``edges`` are the
    places where texts begin.
    """
    full = ~_BLANK[data]
    opens, closes = full & ~np.r_[False, full[:-1]], full & ~np.r_[full[1:], False]
    inner = edges[(edges > 0) & (edges < len(data))]
    opens[inner] = full[inner]
    closes[inner - 1] = full[inner - 1]
    starts, ends = np.nonzero(opens)[0], np.nonzero(closes)[0] + 1
    out = np.zeros(len(starts), np.uint64)
    # Some words at a time: eight bytes of work for each byte of text.
    cuts = np.searchsorted(starts, np.arange(0, len(data) + PIECE, PIECE))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if lo < hi:
            a, b = starts[lo], ends[hi - 1]
            sizes = ends[lo:hi] - starts[lo:hi]
            inside = full[a:b]
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            value = _BYTE[data[a:b][inside]] * (_PLACE[place & 0xFFFF] + (place >> 16).astype(np.uint64))
            out[lo:hi] = np.add.reduceat(value, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64)
    return scrambled(out), starts


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Of each text the distinct hashes of its runs of ``words`` words, sorted.

    A text with fewer words has one shingle, the whole sequence; one without words has none.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    hashes, starts = word_hashes(data, bounds[:-1])
    first = np.searchsorted(starts, bounds)
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        count = min(words, hi - lo)
        if not count:
            yield np.zeros(0, np.uint64)
            continue
        runs = np.full(hi - lo - count + 1, count, np.uint64)
        for i in range(count):
            runs = scrambled(runs + hashes[lo + i : hi - count + 1 + i])
        yield np.unique(runs)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of every hash function over a set."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 2048):
        low = np.minimum(low, (x[at : at + 2048, None] * _FACTOR + _SHIFT).min(0))
    return low


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of all minima, sixteen to a 64-bit number."""
    # Scrambled first: the low bits of a linear function are not random enough.
    bits = scrambled(low.astype(np.uint64)) & np.uint64(2**BITS - 1)
    each = 64 // BITS
    return np.bitwise_or.reduce(bits.reshape(-1, each) << (np.arange(each, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def bands(low: np.ndarray) -> np.ndarray:
    """One key for each run of ROWS whole minima."""
    key = np.arange(HASHES // ROWS, dtype=np.uint64)
    for column in low.reshape(-1, ROWS).T:
        key = scrambled(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return key


FEATURES = "doc_id long, n_shingles long, key_a long, key_b long, packed array<long>, bands array<long>"


def features(docs: DataFrame, words: int) -> DataFrame:
    """Every document's set size, two hashes that name its set, packed signature and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, key_a, key_b, bits, keys = [], [], [], [], []
            for s in shingle_sets(batch.column(1), words):
                count.append(len(s))
                key_a.append(int(scrambled(s).sum(dtype=np.uint64).view(np.int64)))
                key_b.append(int(scrambled(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))
                low = minima(s)
                bits.append(packed(low).view(np.int64))
                keys.append(bands(low).view(np.int64))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (bits, keys)]
            longs = [pa.array(x, pa.int64()) for x in (count, key_a, key_b)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *longs, *lists], ["doc_id", "n_shingles", "key_a", "key_b", "packed", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), FEATURES)


def full_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """The shingle sets of some documents, computed again from their texts: id, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    return wanted.mapInArrow(lean(run), "id long, shingles array<long>")


def agreeing(left: str, right: str) -> Column:
    """How many of the packed minima of two signatures agree, by bit counts."""
    ones = int("1" * (64 // BITS), 16)
    differ = None
    for i in range(HASHES * BITS // 64):
        x = F.col(left)[i].bitwiseXOR(F.col(right)[i])
        for by in (1, 2):  # a group of four bits folds to its lowest
            x = x.bitwiseOR(F.shiftrightunsigned(x, by))
        count = F.bit_count(x.bitwiseAND(F.lit(ones)))
        differ = count if differ is None else differ + count
    return F.lit(HASHES) - differ


def estimate(left: str, right: str) -> Column:
    """Similarity from packed bits, corrected for minima that agree by chance."""
    chance = 2.0**-BITS
    return (agreeing(left, right) / HASHES - chance) / (1 - chance)


def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links: first by sizes and packed bits, then by their full sets."""
    left, right = (classes.select(F.col("id").alias(x), F.col("packed").alias(f"bits_{x}"), F.col("n_shingles").alias(f"n_{x}")) for x in "ab")
    alike = (estimate("bits_a", "bits_b") >= percent / 100 - MARGIN) & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    near = written(pairs.join(left, "a").join(right, "b").where(alike).select("a", "b"), "near")
    # The sets lie in buckets by id: only the pairs move to them.
    met = near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
    both = met.select("a", "b", (F.size("set_a") + F.size("set_b")).alias("n"), F.size(F.array_intersect("set_a", "set_b")).alias("same"))
    return written(both.where(F.col("same") * 100 >= (F.col("n") - F.col("same")) * percent).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """The smallest id that each linked id can reach: id, root. Ids that are smallest may be left out.

    Each round hangs every id below its smallest neighbour, shortens the paths to one step and
    keeps the links between different roots. Every step is written, so lineage stays short.
    """
    spark = links.sparkSession
    found = spark.createDataFrame([], "id long, root long")
    while True:
        ordered = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        below = written(ordered.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root")), "below")
        if below.isEmpty():
            return found
        while True:
            up = below.select(F.col("id").alias("root"), F.col("root").alias("above"))
            below = written(below.join(up, "root", "left").select("id", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "below")
            if below.where("moved").isEmpty():
                below = below.drop("moved")
                break
            below = below.drop("moved")
        links = written(relabelled(relabelled(links, "a", below), "b", below).where("a <> b").distinct(), "links")
        moved = relabelled(found, "root", below)
        found = written(moved.unionByName(below.join(found, "id", "left_anti")), "roots")


def relabelled(df: DataFrame, column: str, below: DataFrame) -> DataFrame:
    """``column`` with every id replaced by its root, where it has one."""
    named = below.select(F.col("id").alias(column), F.col("root").alias("_root"))
    return df.join(named, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Every document's component: doc_id, n_shingles, component_id, kept.

    Documents are linked when their sets of ``words``-word shingles have a Jaccard similarity of
    ``percent`` hundredths or more. ``component_id`` is the smallest doc_id that links reach, the
    document's own included; ``kept`` marks that document. A text with fewer words is one shingle;
    a missing, empty or blank text has none and is linked with nothing. Rows that share a doc_id
    count as linked. A row without doc_id takes no part: it has no component and is kept. Empty
    tables give no rows; other columns are not read. Links are missed by chance only: one of a pair
    just at 80 hundredths with a probability below 1e-4, at 85 hundredths below 1e-7.
    """
    docs = docs.select("doc_id", "text")
    table = written(features(docs, words), "minhash")
    usable = table.where("doc_id IS NOT NULL AND n_shingles > 0")
    # Equal sets are one class, named by the smallest doc_id.
    names = usable.groupBy("key_a", "key_b", "n_shingles").agg(F.min("doc_id").alias("id"))
    classes = written(names.join(usable.withColumnRenamed("doc_id", "id"), ["id", "key_a", "key_b", "n_shingles"]).dropDuplicates(["id", "key_a", "key_b"]), "classes")
    members = classes.select("id", F.explode("bands").alias("band")).distinct()
    shared = members.groupBy("band").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last")
    members = written(members.join(shared, "band").select("band", "id", "pivot"), "buckets")

    # The sets of all classes that share a bucket, computed once for every round.
    shared_ids = written(members.select("id").distinct(), "ids")
    with bucketed(full_sets(docs, shared_ids, words), "id", "sets") as sets:
        # First the smallest class of each bucket with all others; then what is left between components.
        tested = written(members.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
        roots = components(confirmed(tested, classes, sets, percent))
        for asked, last in [*((n, False) for n in ASKED), (ASKED[-1], True)]:
            found = written(pairs_between(members, roots, classes, percent, asked, last), "asked")
            pairs = written(found.where("NOT crowd").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
            if found.isEmpty():
                break
            more = confirmed(pairs, classes, sets, percent)
            if last:
                crowd = found.where("crowd").select(F.col("a").alias("band"), F.col("b").alias("id"))
                more = written(more.unionByName(crowd_links(crowd, members, roots, sets, percent)), "links")
            tested = tested.unionByName(pairs)
            joined = components(relabelled(relabelled(more, "a", roots), "b", roots))
            roots = written(relabelled(roots, "root", joined).unionByName(joined.join(roots, "id", "left_anti")), "roots")

    # Classes that a doc_id with different texts belongs to are linked by it.
    named = usable.join(names.withColumnRenamed("id", "class"), ["key_a", "key_b", "n_shingles"]).select("doc_id", "class").distinct()
    own = written(named.groupBy("doc_id").agg(F.min("class").alias("class"), F.max("class").alias("last")), "owners")
    several = own.where("class < last").select("doc_id", F.col("class").alias("a"))
    if not several.isEmpty():
        links = named.withColumnRenamed("class", "b").join(several, "doc_id").where("a <> b").select("a", "b").distinct()
        joined = components(relabelled(relabelled(links, "a", roots), "b", roots))
        roots = written(relabelled(roots, "root", joined).unionByName(joined.join(roots, "id", "left_anti")), "roots")
    own = own.drop("last")
    rooted = relabelled(own, "class", roots).withColumnRenamed("class", "component")
    return table.select("doc_id", "n_shingles").join(rooted, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )


def without_near(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay of their group of near-duplicates, with all their columns.

    Rows of the doc_id that stays stay together. Missing, empty and blank texts and rows without
    doc_id have no near-duplicates and stay; texts are compared whole; an empty table stays empty.
    """
    name = unused("_kept_id", docs)
    kept = near_groups(docs, words, percent).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_semi")


def in_components(members: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their roots, and the largest component (``top``) of buckets that hold several."""
    named = relabelled(members.select("band", "id").withColumn("root", F.col("id")), "root", roots)
    sizes = named.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    return named, sizes.groupBy("band").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all")).where(F.col("all") > F.col("top.n"))


def pairs_between(members: DataFrame, roots: DataFrame, classes: DataFrame, percent: int, asked: int, last: bool = False) -> DataFrame:
    """Pairs (a, b) of one bucket, in different components, that may be links by size and estimate.

    All members of a bucket but those of its largest component ask. They are dealt into blocks;
    every block meets the whole bucket, which streams by in tiles. Each gets the ``asked`` classes
    it resembles most, smaller ids first. In the ``last`` round a member that resembles more than
    that gets none, but a row with ``crowd``: its bucket and itself.
    """
    named, largest = in_components(members, roots)
    blocks = largest.select("band", F.col("top.root").alias("main"), F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("blocks"))
    alive = named.join(blocks, "band").join(classes.select("id", "n_shingles", "packed"), "id")
    asking = alive.where("root <> main").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("side", F.lit(0))
    there = alive.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(1))
    columns = ["band", "block", "side", "id", "root", "n_shingles", "packed"]
    chance = 2.0**-BITS
    enough = int(np.ceil(HASHES * (max(percent / 100 - MARGIN, 0) * (1 - chance) + chance) - 1e-9))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket and block, those that ask first, then by id."""
        cell, held, best = None, [], None

        def found() -> Iterator[pa.RecordBatch]:
            if best is not None:
                alike = best[0] >= enough
                crowd = alike.all(1) & (alike.shape[1] > asked) if last else np.zeros(len(alike), bool)
                q, t = np.nonzero(alike & ~crowd[:, None])
                yield pair_batch(held[0][0][q], best[1][q, t])
                who = held[0][0][crowd]
                yield pair_batch(np.full(len(who), cell[0]), who, crowd=True)

        for batch in batches:
            band, block, side, who, root, size = (batch.column(i).to_numpy() for i in range(6))
            packs = batch.column(6).flatten().to_numpy().view(np.uint64).reshape(len(who), -1)
            rows = (who, root, size, packs)
            cuts = np.nonzero(np.r_[True, (band[1:] != band[:-1]) | (block[1:] != block[:-1]) | (side[1:] != side[:-1]), True])[0]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if cell != (band[lo], block[lo]):
                    yield from found()
                    cell, held, best = (band[lo], block[lo]), [], None
                if side[lo] == 0:
                    held.append(tuple(x[lo:hi].copy() for x in rows))
                    continue
                if len(held) > 1:
                    held = [tuple(np.concatenate(x) for x in zip(*held, strict=True))]
                mine = held[0]
                for at in range(lo, hi, TILE):
                    tile = tuple(x[at : min(at + TILE, hi)] for x in rows)
                    score = resembling(mine, tile, percent)
                    ids = np.broadcast_to(tile[0], score.shape)
                    if best is not None:
                        score, ids = np.concatenate([best[0], score], axis=1), np.concatenate([best[1], ids], axis=1)
                    # Highest first; among equals the earlier, which is the smaller id.
                    order = np.argsort(-score, axis=1, kind="stable")[:, : asked + last]
                    best = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)
        yield from found()

    met = asking.select(columns).unionByName(there.select(columns)).repartition("band", "block").sortWithinPartitions("band", "block", "side", "id")
    return met.mapInArrow(lean(meet), "crowd boolean, a long, b long")


def pair_batch(x: np.ndarray, y: np.ndarray, crowd: bool = False) -> pa.RecordBatch:
    a, b = (x, y) if crowd else (np.minimum(x, y), np.maximum(x, y))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), crowd)), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["crowd", "a", "b"])


def crowd_links(crowd: DataFrame, members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of crowded members (band, id) to the other members of their buckets.

    Buckets with one largest component are taken together, as mostly the same members share them.
    Some of the crowd hold their sets in a task; the sets of all others stream by and are counted
    against them element by element. Only what is a link leaves the task.
    """
    named, largest = in_components(members, roots)
    mains = written(crowd.select("band").distinct().join(largest.select("band", F.col("top.root").alias("main")), "band"), "mains")
    asking = crowd.join(mains, "band").select("main", "id").distinct().join(named.select("id", "root").distinct(), "id")
    asking = written(asking, "crowd")
    blocks = asking.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / HELD).cast("int").alias("blocks"))
    there = named.join(mains, "band").select("main", "id", "root").distinct().join(blocks, "main")
    asks = asking.join(blocks, "main").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("side", F.lit(0))
    meets = there.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(1))
    columns = ["main", "block", "side", "id", "root"]
    rows = asks.select(columns).unionByName(meets.select(columns)).join(sets, "id").select(*columns, "shingles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by main component and block, the crowd first."""
        cell, held, index = None, [], None
        for batch in batches:
            main, block, side, who, root = (batch.column(i).to_numpy() for i in range(5))
            x, y = [], []
            for i in range(len(who)):
                if cell != (main[i], block[i]):
                    cell, held, index = (main[i], block[i]), [], None
                elements = batch.column(5)[i].values.to_numpy()
                if side[i] == 0:
                    held.append((who[i], root[i], elements))
                    continue
                if index is None:
                    ids, owners = (np.array([h[k] for h in held]) for k in (0, 1))
                    sizes = np.array([len(h[2]) for h in held])
                    every = np.concatenate([h[2] for h in held])
                    order = np.argsort(every, kind="stable")
                    index = every[order], np.repeat(np.arange(len(held)), sizes)[order]
                # Where each element of this set lies among those that are held.
                lo, hi = (np.searchsorted(index[0], elements, side=s) for s in ("left", "right"))
                count = hi - lo
                at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
                same = np.bincount(index[1][at], minlength=len(ids))
                linked = (owners != root[i]) & (same * 100 >= (sizes + len(elements) - same) * percent)
                x += ids[linked].tolist()
                y += [who[i]] * int(linked.sum())
            yield pair_batch(np.array(x, np.int64), np.array(y, np.int64))

    met = rows.repartition("main", "block").sortWithinPartitions("main", "block", "side", "id").mapInArrow(lean(compare), "crowd boolean, a long, b long")
    return met.select("a", "b").distinct()


def resembling(mine: tuple, tile: tuple, percent: int) -> np.ndarray:
    """Agreeing minima of (id, root, size, bits) rows; -1 within a component and for sizes too different."""
    ones = np.uint64(int("1" * (64 // BITS), 16))
    score = np.full((len(mine[0]), len(tile[0])), HASHES, np.int16)
    for word in range(mine[3].shape[1]):
        x = mine[3][:, word, None] ^ tile[3][None, :, word]
        for by in (1, 2):
            x |= x >> np.uint64(by)
        score -= np.bitwise_count(x & ones)
    n, m = mine[2][:, None], tile[2][None, :]
    return np.where((mine[1][:, None] != tile[1][None, :]) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent), score, -1)
