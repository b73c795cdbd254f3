"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords, byte sequences of two to four that may
begin or end at a word's edge, each hashed to a row of one table. A linear layer and a softmax turn
the average into a distribution over the languages. Both are trained together by stochastic
gradient descent on pieces of labelled texts. Since average and layer are linear, a trained model
folds them into one table of scores per subword, which whole texts are then summed up from.

Confidence is calibrated on texts that were not trained on: a temperature makes the probabilities
honest, and predictions below a learned confidence are marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import held_out, lean

#: Rows of the table, length of an embedding, lengths of subwords in bytes.
ROWS, WIDTH, LENGTHS = 1 << 16, 16, (2, 3, 4)
#: What is learned from: whole texts, so many of each language, and bytes of a piece.
PER_LANG, PIECE = 400, 240
#: Weights stay within this, also where equal pieces are labelled in several ways.
MOST = 8.0
#: Bytes hashed at a time when texts are scored.
BLOCK = 1 << 20
UNKNOWN = "und"


def small_letters() -> np.ndarray:
    """Bytes as subwords see them: ASCII letters small, other ASCII a space, the rest as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for a in range(ord("a"), ord("z") + 1):
        table[a] = table[a - 32] = a
    return table


SMALL = small_letters()


def subwords(data: np.ndarray) -> list[np.ndarray]:
    """For each length, the table row of the subword that starts at every byte."""
    folded = SMALL[data]
    # Latin capitals of two bytes, as in accented words written large.
    latin = np.r_[False, data[:-1] == 0xC3] & (data >= 0x80) & (data <= 0x9E) & (data != 0x97) if len(data) else np.zeros(0, bool)
    folded = np.where(latin, data + 0x20, folded).astype(np.uint64)
    out = []
    for n in LENGTHS:
        value = np.full(max(0, len(folded) - n + 1), n, np.uint64)
        for i in range(n):
            value = value * np.uint64(257) + folded[i : len(folded) - n + 1 + i]
        out.append(((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int32))
    return out


@dataclass(frozen=True)
class Model:
    """Scores of every language for every subword, and what makes confidences honest."""

    languages: list[str]
    scores: np.ndarray
    temperature: float
    least: float

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """Average scores of whole texts, taken together some bytes at a time."""
        out = np.zeros((len(texts), len(self.languages)))
        grams = np.zeros(len(texts))
        waiting: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> None:
            nonlocal waiting, size
            if not waiting:
                return
            # Two spaces between texts: a subword may begin at a text's edge and no text reaches into another.
            joined = np.frombuffer(b" " + b"   ".join(p for _, p in waiting) + b"    ", np.uint8)
            starts = np.cumsum([0] + [len(p) + 3 for _, p in waiting[:-1]])
            ids = np.array([i for i, _ in waiting])
            lengths = np.array([len(p) for _, p in waiting])
            for n, rows in zip(LENGTHS, subwords(joined), strict=True):
                # Where subwords of a piece end: with the space after it.
                cuts = np.stack([starts, starts + np.maximum(lengths + 3 - n, 0)], axis=1).ravel()
                sums = np.add.reduceat(self.scores[rows], np.minimum(cuts, len(rows) - 1), axis=0)[::2]
                count = cuts[1::2] - cuts[::2]
                np.add.at(out, ids, np.where(count[:, None] > 0, sums, 0))
                np.add.at(grams, ids, count)
            waiting, size = [], 0

        for i, text in enumerate(texts):
            for at in range(0, max(len(text), 1), BLOCK):
                piece = text[at : at + BLOCK]
                waiting.append((i, piece))
                size += len(piece)
                if size >= BLOCK:
                    flush()
        flush()
        return out / np.maximum(grams, 1)[:, None]

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest language of every text and its probability."""
        p = softmax(self.totals(texts) / self.temperature)
        return p.argmax(1), p.max(1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(pieces: list[bytes], y: np.ndarray, classes: int, epochs: int = 4, batch: int = 32, rate: float = 2.0, seed: int = 7) -> np.ndarray:
    """Train table and layer together; returns their product, scores per subword and language."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1 / WIDTH, (ROWS, WIDTH)).astype(np.float32)
    layer = rng.normal(0, 0.1, (WIDTH, classes)).astype(np.float32)
    bags = [np.concatenate(subwords(np.frombuffer(b" " + p + b" ", np.uint8))) for p in pieces]
    steps, total = 0, max(1, epochs * -(-len(bags) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(bags), batch):
            chosen = order[lo : lo + batch]
            ids = np.concatenate([bags[i] for i in chosen])
            sizes = np.array([len(bags[i]) for i in chosen])
            cuts = np.r_[0, np.cumsum(sizes)[:-1]]
            mean = np.add.reduceat(table[ids], cuts, axis=0) / sizes[:, None]
            slope = softmax(mean @ layer)
            slope[np.arange(len(chosen)), y[chosen]] -= 1
            step = rate * (1 - steps / total)
            back = (slope @ layer.T).astype(np.float32) / sizes[:, None]
            layer = np.clip(layer - step * (mean.T @ slope).astype(np.float32) / len(chosen), -MOST, MOST)
            # Each subword of a text gets that text's slope; repeated rows add up.
            rows, at = np.unique(ids, return_inverse=True)
            change = np.zeros((len(rows), WIDTH), np.float32)
            np.add.at(change, at, np.repeat(back, sizes, axis=0))
            table[rows] = np.clip(table[rows] - step * 20 * change, -MOST, MOST)
            steps += 1
    return table @ layer


def calibrate(totals: np.ndarray, y: np.ndarray, error: float) -> tuple[float, float]:
    """The temperature of least log loss, and the confidence from which at most ``error`` are wrong."""
    grid = np.geomspace(0.02, 20, 60)
    losses = [-np.log(np.maximum(softmax(totals / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    p = softmax(totals / temperature)
    order = np.argsort(-p.max(1), kind="stable")
    wrong = np.cumsum(p.argmax(1)[order] != y[order]) / np.arange(1, len(y) + 1)
    fine = np.nonzero(wrong <= error)[0]
    return temperature, float(p.max(1)[order][fine[-1]]) if len(fine) else 1.0


def train(docs: DataFrame, per_lang: int = PER_LANG, error: float = 0.01) -> Model | None:
    """Learn from a bounded sample: up to ``per_lang`` whole texts a language.

    Only documents that are not held out and have a language and a letter are learned from. One
    text in five of a language calibrates. Without any there is no model.
    """
    return learned(sample(docs, per_lang), error)


def sample(docs: DataFrame, per_lang: int) -> list[tuple[str, bytes]]:
    """Up to ``per_lang`` texts of each language, the first by a hash of the doc_id: language and text."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # Of a large language only about twice as many as are wanted are ranked, those with small hashes.
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # One row for each language; the model has a table for each.
    near = known.select("doc_id", "lang").join(F.broadcast(sizes), "lang").where(place * F.col("size") <= F.lit((1 << 30) * (2.0 * per_lang + 100)))
    by_hash = Window.partitionBy("lang").orderBy(place, "doc_id")
    ids = near.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= per_lang)
    texts = known.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    # per_lang texts of each language: a fixed number for a set of languages.
    rows = texts.join(F.broadcast(ids.drop("n")), ["doc_id", "lang"]).orderBy("lang", F.xxhash64("doc_id"), "text").collect()
    return [(r.lang, r.text.encode()) for r in rows if has_letter(r.text)]


def learned(rows: list[tuple[str, bytes]], error: float) -> Model | None:
    """A model of texts that come language by language."""
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    place = {lang: i for i, lang in enumerate(languages)}
    first = {lang: i for i, (lang, _) in reversed(list(enumerate(rows)))}
    # Of each language one in five, never its first.
    kept = [(i - first[lang]) % 5 == 4 for i, (lang, _) in enumerate(rows)]
    learn = [(place[lang], t[at : at + PIECE]) for (lang, t), k in zip(rows, kept, strict=True) if not k for at in range(0, len(t), PIECE) if at == 0 or len(t) - at > PIECE // 2]
    # A piece without letters tells nothing.
    learn = [(y, piece) for y, piece in learn if (SMALL[np.frombuffer(piece, np.uint8)] != 32).any()] or learn
    tune = [(place[lang], t) for (lang, t), k in zip(rows, kept, strict=True) if k or not any(kept)]
    scores = fit([t for _, t in learn], np.array([y for y, _ in learn]), len(languages)).astype(np.float32)
    draft = Model(languages, scores, 1.0, 0.0)
    temperature, least = calibrate(draft.totals([t for _, t in tune]), np.array([y for y, _ in tune]), error)
    return Model(languages, scores, temperature, least)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """Every document's language: doc_id, held_out, lang_pred, score (0 to 1), accepted.

    The whole text is read and nothing else of a row. ``lang_pred`` is always a learned language;
    ``accepted`` is false where the confidence is below the calibrated one. A text that is missing
    or has no letter is ``und`` with score 0 and not accepted, and so is every text when there is
    no labelled text to learn from. Rows are judged one by one, so repeated rows get equal results;
    a missing doc_id is not held out and never learned from. Empty tables give no rows; other
    columns are not read.
    """
    model = train(docs, per_lang)
    # The table of scores is one fixed size per language; it goes to each executor once.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            lang, score, accepted = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            able = [i for i, t in enumerate(texts) if known is not None and has_letter(t)]
            if able:
                best, p = known.predict([texts[i].encode() for i in able])
                score[able], accepted[able] = p, p >= known.least
                for i, b in zip(able, best, strict=True):
                    lang[i] = known.languages[b]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(accepted)], ["doc_id", "held_out", "lang_pred", "score", "accepted"]
            )

    doc_id = F.col("doc_id").cast("long")
    out = "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"
    return docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "text").mapInArrow(lean(run), out)
