"""What the two compression classifiers share: sampling labels, windows, compressed sizes, calibration."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import held_out, lean

#: For small windows: a match needs four bytes and the parse is the same for every dictionary, so
#: two sizes of one window differ only by what their dictionaries hold.
FINE = {"window_log": 17, "chain_log": 14, "hash_log": 14, "search_log": 6, "min_match": 4, "target_length": 32, "strategy": zstandard.STRATEGY_LAZY2}


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> list[tuple[str, int]]:
    """A bounded sample of labelled texts to learn from: up to ``per_class`` of each label.

    Taken in the order of a hash of the doc_id, from documents that are not held out. Texts are
    taken whole; only their number is bounded. A document labelled both ways is left out.
    """
    clear = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min(label).alias("low"), F.max(label).alias("high")).where("low = high")
    )
    drawn = [clear.where(F.col("low") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    # At most twice per_class ids.
    ids = F.broadcast(drawn[0].unionByName(drawn[1]).select("doc_id", F.col("low").cast("int").alias("label")))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id")
    rows = texts.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * per_class).collect()
    return [(r.text, r.label) for r in rows]


def windows(text: bytes, width: int) -> list[bytes]:
    """The whole text in pieces of at least ``width`` bytes; the next one begins with a space, if one is near."""
    out, at = [], 0
    while at < len(text):
        end = text.find(b" ", at + width, at + 4 * width)
        end = end if end > 0 else min(len(text), at + 4 * width)
        out.append(text[at:end])
        at = end
    return out


def evenly(pieces: list[bytes], size: int) -> bytes:
    """About ``size`` bytes of all pieces, taken at even steps."""
    return b"".join(pieces[:: max(1, -(-sum(map(len, pieces)) // size))])


def compressor(dictionary: bytes, fine: bool = False) -> zstandard.ZstdCompressor:
    """For windows, without what a frame says besides.

    ``fine`` takes the dictionary as mere text and parses closely; else a trained dictionary's
    statistics of symbols count too.
    """
    plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False, "format": zstandard.FORMAT_ZSTD1_MAGICLESS}
    parameters = zstandard.ZstdCompressionParameters(**FINE, **plain) if fine else zstandard.ZstdCompressionParameters.from_level(3, **plain)
    kind = zstandard.DICT_TYPE_RAWCONTENT if fine else zstandard.DICT_TYPE_AUTO
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=kind), compression_params=parameters)


def sizes(text: bytes, width: int, first: zstandard.ZstdCompressor, second: zstandard.ZstdCompressor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window: its compressed size under either dictionary, and its own."""
    pieces = windows(text, width) or [b""]
    one = np.fromiter((len(first.compress(p)) for p in pieces), np.float64, len(pieces))
    two = np.fromiter((len(second.compress(p)) for p in pieces), np.float64, len(pieces))
    return one, two, np.fromiter((len(p) + 1 for p in pieces), np.float64, len(pieces))


def likelihood_ratio(k: float, n: int, other: float, m: int) -> float:
    """How surely a feature seen in k of n and in ``other`` of m texts tells the two kinds apart."""

    def log_of(hits: float, trials: int, p: float) -> float:
        p = min(max(p, 1e-12), 1 - 1e-12)
        return hits * math.log(p) + (trials - hits) * math.log1p(-p)

    both = (k + other) / (n + m)
    return 2 * (log_of(k, n, k / n) + log_of(other, m, other / m) - log_of(k, n, both) - log_of(other, m, both))


def telling_segments(these: list[bytes], those: list[bytes], least: float = 30.0, short: int = 4, long: int = 9, most: int = 4096) -> list[bytes]:
    """Pieces of words that tell ``these`` texts from ``those``, surest first, ``most`` bytes in all.

    A piece at the start of a word has a space before it. The words that hold a chosen piece are explained by it; the next piece must be sure on the
    words that are left. A longer piece is taken for a shorter one that is hardly surer.
    """
    if not these or not those:
        return []

    def pieces(word: bytes) -> set[bytes]:
        word = b" " + word
        return {word[i : i + n] for n in range(short, min(long, len(word)) + 1) for i in range(len(word) - n + 1)}

    def counted(texts: list[bytes], only: set[bytes] | None = None) -> Counter[bytes]:
        found: Counter[bytes] = Counter()
        for text in texts:
            grams = set().union(*map(pieces, set(text.split())))
            found.update(grams if only is None else grams & only)
        return found

    seen = {g: n for g, n in counted(these).items() if n >= 4}
    other = counted(those, set(seen))
    sure = {g: likelihood_ratio(n, len(these), other[g], len(those)) for g, n in seen.items() if n / len(these) > 3 * other[g] / len(those)}
    sure = {g: r for g, r in sure.items() if r >= least}
    # Words that hold any candidate, and the texts that hold them.
    holds: dict[bytes, set[bytes]] = {g: set() for g in sure}
    texts_of: dict[bytes, set[int]] = {}
    for at, text in enumerate(these):
        for word in set(text.split()):
            if word not in texts_of:
                for g in pieces(word) & sure.keys():
                    holds[g].add(word)
            texts_of.setdefault(word, set()).add(at)

    def now(gram: bytes) -> float:
        left = len(set().union(*(texts_of[w] for w in holds[gram])))
        return likelihood_ratio(left, len(these), other[gram], len(those)) if left / len(these) > 3 * other[gram] / len(those) else 0.0

    queue = sorted(((-r, g) for g, r in sure.items()))
    heapq.heapify(queue)
    picked: list[bytes] = []
    while queue and sum(map(len, picked)) + len(picked) < most - long:
        _, gram = heapq.heappop(queue)
        ratio = now(gram)
        if ratio < least:
            continue
        if queue and ratio < -queue[0][0]:
            heapq.heappush(queue, (-ratio, gram))
            continue
        longer = [h for h in sure if gram in h and now(h) >= 0.9 * ratio]
        gram = max(longer, key=lambda h: (len(h), h), default=gram)
        picked.append(gram)
        explained = set(holds[gram])
        for words in holds.values():
            words -= explained
    return picked


@dataclass(frozen=True)
class Logistic:
    """A logistic curve over standardised features; beyond what it was fitted on a feature counts as its extreme."""

    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> Logistic:
        middle, spread = x.mean(0), x.std(0) + 1e-9
        z = np.c_[(x - middle) / spread, np.ones(len(x))]
        w = np.zeros(z.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (p - y) + ridge * w
            curve = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
            w = w - np.linalg.solve(curve, slope)
        return Logistic(middle, spread, w, x.min(0), x.max(0))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[(np.clip(x, self.low, self.high) - self.middle) / self.spread, np.ones(len(x))]
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))


def scored(docs: DataFrame, score: Callable[[], Callable[[list[bytes]], np.ndarray]], name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of its text, which takes the place of a column of that name.

    ``score()`` makes a scorer where the tasks run.
    """
    docs = docs.drop(name)
    place = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = score()
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column(place).to_pylist()]
            values = of(texts) if texts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(lean(run), schema)


def judged(docs: DataFrame, score: Callable[[], Callable[[list[bytes]], np.ndarray]], threshold: float) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    doc_id: Column = F.col("doc_id").cast("long")
    found = scored(docs.select(doc_id.alias("doc_id"), "text"), score)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
