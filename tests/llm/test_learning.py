"""The three learned operators against plain versions on the same sample, and what they learn from."""

import struct
import zlib

import comparing
import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from tablewright.llm import compression, dedup_exact, language, minhash, mixing, quality, toxicity
from tablewright.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def hashed(doc_id):
    """Spark's 64-bit hash of a whole number, signed."""
    value = xxhash.xxh64(struct.pack("<q", doc_id), seed=42).intdigest()
    return value - 2**64 if value >= 2**63 else value


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def con():
    return comparing.duck(SF)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


def labelled(con, docs, label, per_class):
    """Texts of label 0 and of label 1, in the order they are learned from."""
    truth = {d: y for d, y in con.execute(f"SELECT doc_id, {label} FROM labels").fetchall() if y in (0, 1) and not held_out(d)}
    texts = {d: t.encode() for d, t, _ in docs}
    order = sorted(truth, key=lambda d: (hashed(d), d))
    return [[texts[d] for d in order if truth[d] == k][:per_class] for k in (0, 1)]


def cut(text, width):
    """A text in windows that end before a space, looked for one byte at a time."""
    out, at = [], 0
    while at < len(text):
        end = next((i for i in range(at + width, min(at + 4 * width, len(text))) if text[i : i + 1] == b" "), min(len(text), at + 4 * width))
        out.append(text[at:end])
        at = end
    return out


def logistic(x, y):
    """Newton steps for a curve over standardised features, and its scores."""
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = np.zeros(x.shape[1] + 1)

    def shaped(v):
        return np.c_[(np.clip(v, x.min(axis=0), x.max(axis=0)) - middle) / spread, np.ones(len(v))]

    z = shaped(x)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= np.linalg.solve(z.T @ np.diag(p * (1 - p)) @ z + 0.05 * np.eye(len(w)), z.T @ (p - y) + 0.05 * w)
    return middle, lambda v: 1 / (1 + np.exp(-np.clip(shaped(v) @ w, -30, 30)))


def test_toxicity_scores(spark, con, docs):
    kinds = labelled(con, docs, "toxic", toxicity.PER_CLASS)
    toxic, ordinary = toxicity.dictionaries(*[[t for i, t in enumerate(kinds[k]) if i % 4] for k in (1, 0)])
    one, two = (compression.compressor(d, fine=True) for d in (toxic, ordinary))

    def features(text):
        words = text.lower().split()
        if not words:
            return [0.0] * 6 + [np.nan]
        pieces = cut(b"".join(b" " + w for w in words), 48)
        gain = [len(two.compress(p)) - len(one.compress(p)) for p in pieces]
        size, strong = sum(len(p) + 1 for p in pieces), [max(g - 2, 0) for g in gain]
        top = sorted(gain)[-3:]
        return [sum(gain) / size, max(gain), sum(top) / len(top), np.log1p(sum(strong)), sum(strong) / size, sum(g > 2 for g in gain) / len(gain), np.log(len(gain))]

    tune = [(t, k) for k in (0, 1) for i, t in enumerate(kinds[k]) if i % 4 == 0 and t.strip()]
    middle, score = logistic(np.array([features(t) for t, _ in tune]), np.array([float(k) for _, k in tune]))
    x = np.array([features(t.encode()) for _, t, _ in docs])
    want = score(np.where(np.isnan(x), middle, x))
    got = {r.doc_id: r.score for r in QUERIES["op5_toxicity"](spark, SF).collect()}
    assert np.allclose([got[d] for d, _, _ in docs], want, atol=1e-6)


def test_quality_scores(spark, con, docs):
    kinds = labelled(con, docs, "quality", quality.PER_CLASS)
    dictionaries = [zstandard.train_dictionary(quality.DICTIONARY, [p for i, t in enumerate(texts) if i % 3 for p in cut(t, 1000)], level=3).as_bytes() for texts in kinds]
    under_bad, under_good = (compression.compressor(d) for d in dictionaries)

    def features(text):
        pieces = cut(text, 1000) or [b""]
        good, bad = [len(under_good.compress(p)) for p in pieces], [len(under_bad.compress(p)) for p in pieces]
        size, each = sum(len(p) + 1 for p in pieces), [(b - g) / max(b, g) for g, b in zip(good, bad)]
        a, b, c = (sum(bad) - sum(good)) / max(sum(good), sum(bad)), sum(good) / size, sum(bad) / size
        low, middle, high = np.quantile(each, [0.1, 0.5, 0.9])
        return [a, b, c, middle, c - b, max(each), min(each), low, high, a * a, b * b, c * c, middle * middle, a * b, a * c, b * c]

    tune = [(t, k) for k in (0, 1) for i, t in enumerate(kinds[k]) if i % 3 == 0]
    _, score = logistic(np.array([features(t) for t, _ in tune]), np.array([float(k) for _, k in tune]))
    want = score(np.array([features(t.encode()) for _, t, _ in docs]))
    got = {r.doc_id: r.score for r in QUERIES["op10_quality"](spark, SF).collect()}
    assert np.allclose([got[d] for d, _, _ in docs], want, atol=1e-5)


def test_language_scores(spark, docs):
    known = [(d, t, lang) for d, t, lang in docs if lang is not None and not held_out(d)]
    sample = []
    for lang in sorted({lang for _, _, lang in known}):
        own = sorted((r for r in known if r[2] == lang), key=lambda r: (hashed(r[0]) % (1 << 30), r[0]))[: language.PER_LANG]
        sample += [(lang, t.encode()) for d, t, _ in sorted(own, key=lambda r: hashed(r[0])) if any(c.isalpha() for c in t)]
    model = language.learned(sample, 0.01)
    got = {r.doc_id: r for r in QUERIES["op2_language"](spark, SF).collect()}

    def small(data):
        """ASCII letters small, other ASCII a space, capitals of two bytes small."""
        out = bytearray()
        for i, b in enumerate(data):
            if b < 128:
                out.append(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32)
            else:
                out.append(b + 32 if i and data[i - 1] == 0xC3 and 0x80 <= b <= 0x9E and b != 0x97 else b)
        return bytes(out)

    for d, t, _ in docs[:150]:
        data, total, count = small(b" " + t.encode() + b"   "), np.zeros(len(model.languages)), 0
        for n in (2, 3, 4):
            # A subword begins at the space before the text at the earliest and ends with the one after it.
            for i in range(1, 1 + max(len(t.encode()) + 3 - n, 0)):
                value = n
                for b in data[i : i + n]:
                    value = (value * 257 + b) % 2**64
                total += model.scores[(value * 0x9E3779B97F4A7C15 % 2**64) >> 48]
                count += 1
        z = total / count / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert got[d].lang_pred == model.languages[int(p.argmax())] and abs(got[d].score - p.max()) < 1e-4, d


def test_marks_at_the_end_are_learned(spark):
    """The only mark of a text stands in its last hundredth."""
    filler = [f"plain{i * 31 % 97}" for i in range(400)]

    def text(i, mark):
        return " ".join(filler[(i * 7 + k) % 400] for k in range(1500)) + (" " + mark if mark else "")

    rows = [(i, text(i, "vile scoundrel" if i % 2 else "")) for i in range(100)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(100)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(table, labels).collect()}
    assert sum(got[i].predicted == i % 2 for i in range(100)) >= 97
    got = {r.doc_id: r for r in quality.score_quality(table, labels).collect()}
    assert np.mean([got[i].score for i in range(0, 100, 2)]) > np.mean([got[i].score for i in range(1, 100, 2)])
    # Languages show in the second half of long texts only.
    spoken = [(i, text(i, "")[:6000] + (" der die das und nicht" if i % 2 else " the and that not with") * 250, "de" if i % 2 else "en") for i in range(60)]
    found = language.identify(spark.createDataFrame(spoken, "doc_id long, text string, lang string")).collect()
    assert sum(r.lang_pred == spoken[r.doc_id][2] for r in found) >= 58


def test_every_language_is_learned():
    """A language with one text learns from it, whatever its place."""
    for first in range(7):
        rows = [("aa", b"aba abb baa " * 20)] * first + [("bb", b"xyx yyx xxy " * 20)] + [("cc", b"mnm nnm mmn " * 20)] * 6
        model = language.learned(rows, 0.01)
        best, _ = model.predict([b"xyx yyx xxy"])
        assert model.languages[best[0]] == "bb"


def test_evenly():
    pieces = [bytes([65 + i]) * 10 for i in range(20)]
    assert compression.evenly(pieces, 50) == b"A" * 10 + b"E" * 10 + b"I" * 10 + b"M" * 10 + b"Q" * 10
    assert compression.evenly(pieces, 1000) == b"".join(pieces) and compression.evenly([], 10) == b""


def test_language_sample_is_not_dealt_by_language(spark):
    """Rows are dealt by language only when they are few."""
    rows = spark.createDataFrame([(i, "some text", "en") for i in range(50)], "doc_id long, text string, lang string")
    shuffled = []
    plain = language.F.broadcast
    language.F.broadcast = lambda df: shuffled.append(df.columns) or plain(df)
    try:
        language.sample(rows, 5)
    finally:
        language.F.broadcast = plain
    assert ["lang", "size"] in shuffled


CLASHES = "doc_id long, text string, source string, _kept_id long, _kept_digest string, _digest string, _again int, _toxicity double, mix_source string, mix_cumulative string, doc string, tie string, digest string, salt long, `row` string"


def clashing(spark):
    rows = [(1, "one text here", "a"), (2, "one  text here", "b"), (3, None, None), (None, "", "a"), (None, "one text here", "c"), (4, "quite another text", "b")]
    return spark.createDataFrame([(*r, 9, "x", "y", 7, 0.1, "z", "w", "d", "t", "g", 5, "r") for r in rows], CLASHES)


def test_columns_of_any_name_are_carried(spark):
    docs = clashing(spark)
    left = dedup_exact.deduplicated(docs)
    assert left.schema == docs.schema
    want = {(1, "a"), (3, None), (4, "b")}
    assert {(r.doc_id, r.source) for r in left.collect()} == want and {tuple(r)[3:] for r in left.collect()} == {tuple(r)[3:] for r in docs.collect()}
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert sorted(map(str, toxicity.without_toxic(docs, labels).collect())) == sorted(map(str, docs.collect()))
    assert minhash.without_near(docs).columns == docs.columns
    mixed = mixing.mix_sources(docs, power=1.0, epochs=2.0)
    assert mixed.columns == [*docs.columns, "n_copies", "copy", "shuffle_key"] and {r.mix_source for r in mixed.collect()} <= {"z"}


def test_survivor_does_not_depend_on_dealing(spark):
    """Rows of one doc_id and text, and rows without doc_id, differ in another column: always the same one stays."""
    rows = [(d, "same  text" if i % 2 else "same text", f"s{i}") for i in range(40) for d in (7, None)]
    rows += [(None, "lone text", f"s{i}") for i in range(20)] + [(2**63 - 1, "lone text", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {tuple(sorted(map(str, dedup_exact.deduplicated(docs.repartition(n, *by), salts=3).collect()))) for n, by in ((1, []), (7, []), (5, ["source"]))}
    assert len(found) == 1 and len(next(iter(found))) == 2
    assert any("9223372036854775807" in r for r in next(iter(found)))


def test_hash_is_not_trusted(spark):
    """Rows whose digests agree and texts differ all stay."""
    import pyarrow as pa

    docs = pa.array([{"doc_id": i, "text": t} for i, t in enumerate(["a b", "a  b", "c", "a b", None, ""])])
    batch = pa.RecordBatch.from_arrays([docs, pa.array([0, 1, 2, 3, 4, 5]), pa.array(["0"] * 6), pa.array(["same"] * 6), pa.array([0] * 6)], ["doc", "row", "tie", "digest", "salt"])
    for within in (True, False):
        (left,) = dedup_exact.standing(within)(iter([batch]))
        assert left.column(1).to_pylist() == [0, 2, 4]
    left = list(dedup_exact.standing(False)(iter([batch.slice(0, 3), batch.slice(3)])))
    assert [b.column(1).to_pylist() for b in left] == [[0, 2], [4]]
