"""Quality by compression: dictionaries of good and of bad text, and which one compresses a text better.

Each dictionary is trained on windows of texts of one label. A text is compressed window by window
under both; the difference of its two compressed sizes, divided by the larger, becomes a score by a
logistic curve fitted on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from tablewright.llm.compression import Logistic, compressor, evenly, judged, sample, sizes, windows

WIDTH, DICTIONARY = 1000, 8192
#: What is learned from: whole texts, so many of each label.
PER_CLASS = 2000


@dataclass(frozen=True)
class Quality:
    """A trained model; a constant where there are not two labels to learn from."""

    good: bytes
    bad: bytes
    curve: Logistic | None
    constant: float

    def scorer(self):
        if self.curve is None:
            return lambda texts: np.full(len(texts), self.constant)
        good, bad = compressor(self.good), compressor(self.bad)
        return lambda texts: self.curve(np.array([differences(t, good, bad) for t in texts]))


def differences(text: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> list[float]:
    """The normalised difference of the whole text, how it spreads over windows, and how well the text compresses."""
    one, two, own = sizes(text, WIDTH, good, bad)
    each = (two - one) / np.maximum(one, two)
    whole, under_good, under_bad = (two.sum() - one.sum()) / max(one.sum(), two.sum()), one.sum() / own.sum(), two.sum() / own.sum()
    low, middle, high = np.quantile(each, [0.1, 0.5, 0.9])
    main = [whole, under_good, under_bad, middle]
    return [*main, under_bad - under_good, each.max(), each.min(), low, high, *(x * x for x in main), whole * under_good, whole * under_bad, under_good * under_bad]


def dictionary(texts: list[bytes]) -> bytes:
    pieces = [w for t in texts for w in windows(t, WIDTH)]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text to train on: the text itself
        return evenly(pieces, DICTIONARY)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Quality:
    """Learn from a bounded sample of the labelled documents that are not held out."""
    rows = sample(docs, labels, "quality", per_class)
    kinds = [[t.encode() for t, y in rows if y == k] for k in (0, 1)]
    if min(map(len, kinds)) < 3:
        return Quality(b"", b"", None, float(len(kinds[1]) >= len(kinds[0])))
    bad, good = (dictionary([t for i, t in enumerate(texts) if i % 3]) for texts in kinds)
    tune = [[t for i, t in enumerate(texts) if i % 3 == 0] for texts in kinds]
    one, two = compressor(good), compressor(bad)
    x = np.array([differences(t, one, two) for texts in tune for t in texts])
    y = np.repeat([0.0, 1.0], [len(t) for t in tune])
    return Quality(good, bad, Logistic.fit(x, y), 0.0)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = PER_CLASS) -> DataFrame:
    """Every document's score: doc_id, held_out, score (0 to 1, higher is better), predicted.

    The whole text is scored; nothing else of a row is looked at. A missing text counts as empty;
    an empty text has no difference and gets the curve's value there. Repeated rows and texts get
    equal scores; a missing doc_id is not held out. With fewer than three texts of either label
    every score is 0 where only bad texts are known, else 1. Empty tables give no rows; other
    columns are not read.
    """
    model = train(docs, labels, per_class)
    return judged(docs, model.scorer, threshold)
