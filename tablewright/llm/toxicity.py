"""Toxicity by compression distance.

Two zstandard dictionaries share one body, trained on windows of ordinary text. Behind it one
holds what tells toxic texts from ordinary ones, the other what tells ordinary texts from toxic
ones, in areas of the same length: matches in the shared body cost the same under either, and a
window's two sizes differ by its toxic or ordinary marks alone. A text's windows give a few
distances, which a logistic curve fitted on other labelled texts turns into a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import unused
from tablewright.llm.compression import Logistic, compressor, evenly, judged, sample, scored, sizes, telling_segments, windows

WIDTH, BODY = 48, 8192
#: What is learned from: whole texts, so many of each label.
PER_CLASS = 900


@dataclass(frozen=True)
class Toxicity:
    """A trained model: small, and sent with the tasks. Without two labels to learn from it is a constant."""

    toxic: bytes
    ordinary: bytes
    curve: Logistic | None
    constant: float

    def scorer(self):
        """A function from texts to scores; compressors are made where it runs."""
        if self.curve is None:
            return lambda texts: np.full(len(texts), self.constant)
        toxic, ordinary = compressor(self.toxic, fine=True), compressor(self.ordinary, fine=True)

        def score(texts: list[bytes]) -> np.ndarray:
            x = np.array([distances(t, toxic, ordinary) for t in texts])
            # An empty text has no length to speak of: the usual one.
            return self.curve(np.where(np.isnan(x), self.curve.middle, x))

        return score


def flat(text: bytes) -> bytes:
    """Every word small and after one space, so that a mark looks the same wherever it stands."""
    return b" " + b" ".join(text.lower().split())


def distances(text: bytes, toxic: zstandard.ZstdCompressor, ordinary: zstandard.ZstdCompressor) -> list[float]:
    """How much shorter a text's windows are under the toxic dictionary."""
    text = flat(text)
    if not text.strip():
        return [0.0] * 6 + [np.nan]
    one, two, own = sizes(text, WIDTH, toxic, ordinary)
    gain = two - one
    strong = np.maximum(gain - 2, 0)
    return [gain.sum() / own.sum(), gain.max(), np.sort(gain)[-3:].mean(), np.log1p(strong.sum()), strong.sum() / own.sum(), (gain > 2).mean(), np.log(len(gain))]


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    toxic, ordinary = [flat(t) for t in toxic], [flat(t) for t in ordinary]
    pieces = [w for t in ordinary for w in windows(t, WIDTH)]
    try:
        body = zstandard.train_dictionary(BODY, pieces, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text to train on: the text itself
        body = evenly(pieces, BODY)
    # The surest marks come last, where matches are cheapest.
    marks = [b" ".join(reversed(telling_segments(a, b))) + b" " for a, b in ((toxic, ordinary), (ordinary, toxic))]
    room = max(map(len, marks))
    return body + marks[0].rjust(room, b"\0"), body + marks[1].rjust(room, b"\0")


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Toxicity:
    """Learn from a bounded sample of the labelled documents that are not held out.

    Dictionaries come from three quarters of it, the curve from texts they have not seen.
    """
    rows = sample(docs, labels, "toxic", per_class)
    kinds = [[t.encode() for t, y in rows if y == k] for k in (0, 1)]
    if min(map(len, kinds)) < 3:
        return Toxicity(b"", b"", None, float(len(kinds[1]) > len(kinds[0])))
    learn = [[t for i, t in enumerate(texts) if i % 4] for texts in kinds]
    tune = [[t for i, t in enumerate(texts) if i % 4 == 0] for texts in kinds]
    toxic, ordinary = dictionaries(learn[1], learn[0])
    one, two = compressor(toxic, fine=True), compressor(ordinary, fine=True)
    tune = [[t for t in texts if t.strip()] for texts in tune]
    if not all(tune):
        return Toxicity(b"", b"", None, float(len(kinds[1]) > len(kinds[0])))
    x = np.array([distances(t, one, two) for texts in tune for t in texts])
    y = np.repeat([0.0, 1.0], [len(t) for t in tune])
    return Toxicity(toxic, ordinary, Logistic.fit(x, y), 0.0)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """Every document's score: doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on).

    The whole text is scored; nothing else of a row is looked at. A missing text counts as empty,
    and an empty one gets the score of a text without marks. Rows are scored one by one, so repeated
    rows and texts get equal scores; a missing doc_id is not held out. With fewer than three texts of
    either label there is nothing to learn: every score is 1 where only toxic texts are known, else 0.
    Empty tables give no rows; other columns are not read.
    """
    model = train(docs, labels, per_class)
    return judged(docs, model.scorer, threshold)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns.

    Rows are judged one by one as in ``score_toxicity``: missing and empty texts score as texts without
    marks, repeated rows and rows without doc_id stay or go alike, an empty table stays empty.
    """
    model = train(docs, labels, per_class)
    name = unused("_toxicity", docs)
    return scored(docs, model.scorer, name).where(F.col(name) < threshold).drop(name)
