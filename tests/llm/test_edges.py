"""Missing values, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import brute
from tablewright.llm import dedup_exact, dedup_substrings, language, minhash, mixing, quality, sentencepieces, sharding, topk, toxicity
from tablewright.llm.queries import PIECES

LONG = " ".join(f"word{i * 7919 % 5003}" for i in range(60_000))
CLASH = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, component_id string, copy string, ids string, shard string, row string, text_sha256 string, winner string, class string, band string, doc string, place string, shuffle_key string"
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "the QUICK brown fox jumps over the lazy dog and runs far away from here"),
    (5, "the QUICK brown fox jumps over the lazy dog and runs far away from here"),
    (6, LONG),
    (7, "x" * 3000),
    (8, "The quick  brown\tfox jumps over the lazy dog and runs far away from here"),
    (9, LONG + " end"),
    (10, "é" * 200 + " é"),
    (11, "one"),
    (12, "One"),
    (13, "12 345 !!"),
]


def frame(spark, rows=TEXTS, missing_id=True):
    full = [(d, t, "en" if d % 2 else None, None if d % 3 == 0 else f"s{d % 3}") for d, t in rows]
    if missing_id:
        full.append((None, "a text without an id that nobody else has", None, None))
    return spark.createDataFrame([(*r, None, 0.5, *["x"] * 13) for r in full], CLASH)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASH)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_near(docs, empty):
    rows = minhash.near_groups(docs, words=2).collect()
    assert len(rows) == len(TEXTS) + 1
    want = brute.near_groups(TEXTS, 2)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None} == want
    assert want[5][1] == 1 and want[9][1] == 6 and want[12][1] == 11 and want[3][1] == 3
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    assert minhash.near_groups(empty).count() == 0
    left = minhash.without_near(docs, words=2)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == sorted({0} | {v[1] for v in want.values()})


def test_near_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    rows = [(2, a), (7, a), (7, b), (9, b), (9, c), (11, c + " more"), (12, "alone"), (7, None)]
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(2, 2, True), (7, 2, False), (9, 2, False), (11, 2, False), (12, 12, True)}


def test_near_needs_chains_and_rounds(spark):
    """A large group of copies of one text, each with its own changes, and chains whose ends are far apart."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        words = list(base)
        words[i % 60] = f"n{i}"
        if i % 3 == 0:
            words[(i * 7) % 60] = f"m{i}"
        rows.append((i, " ".join(words)))
    chain = [f"c{i}" for i in range(100)]
    rows += [(1000 - i, " ".join(chain[3 * i : 3 * i + 60])) for i in range(14)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()}
    assert got == brute.near_groups(rows, 2)


def test_pairs_between_components(spark, monkeypatch):
    """All pairs of a bucket that look alike and lie in different components, whatever the blocks."""
    import numpy as np

    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "TILE", 2)
    rng = np.random.default_rng(5)
    base, classes = rng.integers(0, 2**63, 400, np.uint64), []
    for i in range(20):
        own = np.r_[base[:340], rng.integers(0, 2**63, 60, np.uint64)] if i % 4 else rng.integers(0, 2**63, 400, np.uint64)
        classes.append((i, 400 if i != 7 else 100, minhash.packed(minhash.minima(own)).view(np.int64).tolist()))
    members = [(1, i) for i in range(14)] + [(2, i) for i in range(10, 20)]
    root = {i: 0 if i < 6 else 12 if i in (12, 13) else i for i in range(20)}
    tables = (spark.createDataFrame(members, "band long, id long"), spark.createDataFrame([x for x in root.items() if x[0] != x[1]], "id long, root long"))
    signatures = spark.createDataFrame(classes, "id long, n_shingles long, packed array<long>")
    both = signatures.selectExpr("id AS a", "packed AS x").crossJoin(signatures.selectExpr("id AS b", "packed AS y")).where("a < b")
    alike = {(r.a, r.b): r.e for r in both.select("a", "b", minhash.estimate("x", "y").alias("e")).collect()}
    asks = {1: [i for i in range(14) if root[i] != 0], 2: [i for i in range(10, 20) if root[i] != 12]}
    for percent, asked, last in ((80, 99, False), (60, 99, True), (80, 1, False), (80, 3, False), (80, 3, True)):
        want, crowds = set(), set()
        for band, own in asks.items():
            for a in own:
                there = [b for k, b in members if k == band and root[a] != root[b] and 7 not in (a, b) and alike[min(a, b), max(a, b)] >= percent / 100 - minhash.MARGIN]
                there.sort(key=lambda b: (-alike[min(a, b), max(a, b)], b))
                if last and len(there) > asked:
                    crowds.add((band, a))
                else:
                    want |= {(min(a, b), max(a, b)) for b in there[:asked]}
        rows = minhash.pairs_between(*tables, signatures, percent, asked, last).collect()
        assert {(r.a, r.b) for r in rows if not r.crowd} == want
        assert {(r.a, r.b) for r in rows if r.crowd} == crowds and bool(crowds) == (last and asked == 3)


def test_crowd_links(spark, monkeypatch):
    """Only links between components come out of a crowd, whatever the blocks."""
    import random

    monkeypatch.setattr(minhash, "HELD", 2)
    rng = random.Random(3)
    sets = {i: sorted(rng.sample(range(40), rng.randint(28, 36))) for i in range(16)}
    members = [(1, i) for i in range(10)] + [(2, i) for i in range(6, 16)] + [(3, i) for i in range(4)]
    root = {i: 0 if i < 4 else i for i in range(16)}
    crowd = [(1, i) for i in range(4, 10)] + [(2, i) for i in range(7, 16)]
    links = minhash.crowd_links(
        spark.createDataFrame(crowd, "band long, id long"), spark.createDataFrame(members, "band long, id long"), spark.createDataFrame([(i, 0) for i in range(1, 4)], "id long, root long"),
        spark.createDataFrame(list(sets.items()), "id long, shingles array<long>"), 70,
    )
    got = {(r.a, r.b) for r in links.collect()}

    def linked(a, b):
        same = len(set(sets[a]) & set(sets[b]))
        return root[a] != root[b] and 100 * same >= 70 * (len(sets[a]) + len(sets[b]) - same)

    asked = {(min(a, b), max(a, b)) for band, a in crowd for k, b in members if k == band and a != b}
    assert {p for p in asked if linked(*p)} <= got and all(linked(*p) for p in got) and got


def test_components(spark):
    links = [(i, i + 1) for i in range(50, 90)] + [(3, 90), (1, 2), (100, 200), (150, 200), (7, 8), (8, 7)]
    got = {r.id: r.root for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 3 for i in range(50, 91)} | {2: 1, 200: 100, 150: 100, 8: 7}
    assert {i: got.get(i, i) for i in want} == want and all(got[i] == want.get(i, i) for i in got)


def test_estimate(spark):
    """The corrected estimate is right on average, and within the margin."""
    import numpy as np

    rng, rows = np.random.default_rng(1), []
    for same in (0, 50, 80, 100):
        for _ in range(30):
            a = rng.integers(0, 2**63, 400, np.uint64)
            b = np.r_[a[: 4 * same], rng.integers(0, 2**63, 400 - 4 * same, np.uint64)]
            true = 4 * same / (800 - 4 * same)
            rows.append((float(true), *(minhash.packed(minhash.minima(x)).view(np.int64).tolist() for x in (a, b))))
    got = spark.createDataFrame(rows, "j double, a array<long>, b array<long>").select("j", minhash.estimate("a", "b").alias("e")).collect()
    assert all(abs(r.j - r.e) < minhash.MARGIN for r in got)
    assert abs(sum(r.j - r.e for r in got) / len(got)) < 0.02


def test_exact(docs, empty):
    rows = dedup_exact.exact_groups(docs, salts=2).collect()
    groups = {}
    for d, t in TEXTS:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    want = sorted((d, min(g), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows if r.doc_id is not None) == want
    assert sum(r.kept for r in rows) == len(groups) + 1
    assert [(r.keep_id, r.group_size, r.kept) for r in rows if r.doc_id is None] == [(None, 1, True)]
    left = dedup_exact.deduplicated(docs)
    assert left.columns == docs.columns and left.count() == len(groups) + 1
    assert dedup_exact.exact_groups(empty).count() == 0 and dedup_exact.deduplicated(empty).count() == 0


def test_exact_hot_text(spark):
    """A third of all rows hold one text; every stage has something to merge."""
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 500}") for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in dedup_exact.exact_groups(table, salts=4).collect()}
    groups = {}
    for d, t in rows:
        groups.setdefault(t, []).append(d)
    assert got == {d: (min(g), len(g), d == min(g)) for g in groups.values() for d in g}
    assert {r.level for r in dedup_exact.exact_notes(table, salts=4).collect()} == {0, 1, 2, 3}


def test_exact_shared_ids_in_many_batches(spark):
    rows = [(d, "one text") for d in (5, None, 7)] * 8 + [(None, None), (None, "")] * 6 + [(5, "another")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "place int, doc_id long, text string")
    # Every batch holds some of each several times.
    docs = docs.repartitionByRange(4, "place").select("doc_id", "text")
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in dedup_exact.exact_groups(docs).collect()]
    want = [(5, 5, 24, True), (None, None, 12, True), (5, 5, 1, True)]
    want += [(5, 5, 24, False)] * 7 + [(7, 5, 24, False)] * 8 + [(None, 5, 24, False)] * 8 + [(None, None, 12, False)] * 11
    assert sorted(got, key=str) == sorted(want, key=str)
    assert dedup_exact.deduplicated(docs).count() == 3


def test_passages(spark, docs, empty):
    rows = dedup_substrings.without_repeats(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    # Whole rows that repeat are one document.
    want = brute.passages(list(dict.fromkeys(TEXTS)))
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) == want[r.doc_id], r.doc_id
    assert want[7][1] > 0 and want[9][1] > 0
    assert dedup_substrings.without_repeats(empty).count() == 0


def test_passages_random(spark):
    import random

    rng, rows = random.Random(4), []
    words = ["".join(rng.choice("abcdeé\0") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    for i in range(150):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))
        if rows and rng.random() < 0.6:
            old = rng.choice(rows)[1]
            at = rng.randint(0, len(old))
            text = text[: rng.randint(0, 60)] + old[at : at + rng.randint(80, 400)] + text[-30:]
        if rng.random() < 0.1:
            text += "z" * rng.randint(90, 260)
        rows.append((i, text))
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in dedup_substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == brute.passages(rows)


def test_passages_texts_of_one_id(spark):
    a, b = "ab cd " * 40, "".join(f"{i} " for i in range(200))
    rows = dedup_substrings.without_repeats(spark.createDataFrame([(1, a + b), (1, b), (2, b), (2, b)], "doc_id long, text string")).collect()
    assert len(rows) == 4
    # One of the first two is first and keeps the passage, the others lose it.
    assert sum(r.n_bytes - r.n_removed >= len(b) for r in rows) == 1


def test_passages_whole_rows_that_repeat(spark):
    made = random.Random(3)
    letters = lambda n: "".join(made.choices("abcdefghij", k=n))
    phrase = letters(80)
    rows = [(d, letters(300) + phrase + letters(300)) for d in (1, 2, 3, None)]
    docs = spark.createDataFrame(rows + rows[2:], "doc_id long, text string").repartition(3)
    got = dedup_substrings.without_repeats(docs).collect()
    assert [(r.doc_id, r.n_removed) for r in sorted(got, key=lambda r: str(r.doc_id))] == [(d, 0) for d in (1, 2, 3, 3, None, None)]
    # What an earlier document holds still goes, from each of them.
    docs = docs.union(spark.createDataFrame([(0, rows[2][1][:200])], docs.schema))
    got = dedup_substrings.without_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got if r.n_removed) == [(3, 200), (3, 200)]


def test_language(spark, docs, empty):
    rows = language.identify(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    got = {r.doc_id: r for r in rows}
    assert all(got[d].lang_pred == "und" and got[d].score == 0 and not got[d].accepted for d in (2, 3, 4, 13))
    assert all(got[d].lang_pred == "en" for d in (1, 6, 7, 10, None))
    assert language.identify(empty).count() == 0
    unknown = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}


def test_language_rejects(spark):
    rows = [(i, ("der die das und nicht " if i % 2 else "the and that not with ") * 5, "de" if i % 2 else "en") for i in range(60)]
    docs = spark.createDataFrame([*rows, (900, "zq xj", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert all(got[d].lang_pred == lang for d, _, lang in rows) and sum(got[d].accepted for d, _, _ in rows) > 50
    assert got[900].score < min(got[d].score for d, _, _ in rows)


@pytest.mark.parametrize(("score", "lone"), [(toxicity.score_toxicity, 1.0), (quality.score_quality, 0.0)])
def test_scores(spark, docs, empty, no_labels, score, lone):
    assert len(score(docs, no_labels).collect()) == len(TEXTS) + 1
    assert score(empty, no_labels).count() == 0
    one_sided = spark.createDataFrame([(1, 0, 1), (8, 0, 1), (9, 0, 1), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    assert {r.score for r in score(docs, one_sided).collect()} == {lone}


def test_scores_learn_and_cover_whole_texts(spark):
    filler = [f"plain{i * 31 % 97} " for i in range(400)]
    rows = [(i, "".join(filler[i % 200 : i % 200 + 60]) + ("vile scoundrel " if i % 2 else "")) for i in range(200)]
    late = "".join(filler) * 20 + "vile scoundrel " * 30
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (1002, late), (1003, "".join(filler) * 20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert sum(got[i].predicted == i % 2 for i in range(200)) >= 195
    assert got[1000].predicted == got[1001].predicted == 0 and got[1002].score > got[1003].score
    clean = toxicity.without_toxic(docs, labels)
    assert clean.columns == ["doc_id", "text"] and clean.where("doc_id IN (1000, 1001)").count() == 2


def test_mix(spark, docs, empty):
    rows = mixing.mix_sources(docs, power=1.0, epochs=3.0)
    assert rows.columns[-3:] == ["n_copies", "copy", "shuffle_key"]
    got = rows.collect()
    # Each row's copies are numbered without gaps; a missing source and a missing text are drawn, too.
    copies = {}
    for r in got:
        copies.setdefault((r.doc_id, r.text), []).append(r.copy)
    twice = {5: 2}
    assert all(sorted(c) == sorted(list(range(1, len(set(c)) + 1)) * twice.get(d, 1)) for (d, _), c in copies.items())
    assert None in {r.source for r in got}
    assert mixing.mix_sources(empty).count() == 0


def test_mix_reaches_targets(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('a', 50) AS text", "CASE WHEN id < 4000 THEN 'big' WHEN id < 5900 THEN 'mid' ELSE 'tiny' END AS source")
    mixed = mixing.mix_sources(docs, targets={"big": 1.0, "mid": 1.0, "tiny": 2.0}, epochs=2.0)
    n = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["big"] - 3000) < 250 and abs(n["mid"] - 3000) < 250 and abs(n["tiny"] - 6000) < 400
    keys = [r.shuffle_key for r in mixed.select("shuffle_key").collect()]
    assert keys == sorted(keys)
    assert mixing.mix_sources(docs, targets={"big": 1.0}).where("source <> 'big'").count() == 0


def test_mix_runs_no_python(spark, docs):
    plan = mixing.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_shards(docs, empty):
    rows = sharding.shard_rows(docs, shards=4, points=8).collect()
    assert len(rows) == len(TEXTS) + 1
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sorted(map(len, slots.values())) == [3, 4, 4, 4]
    assert {r["size"] for r in rows if r.doc_id in (2, 3)} == {16}
    assert sharding.shard_rows(empty, shards=4).count() == 0


def test_shards_of_equal_rows(spark, monkeypatch):
    """Missing ids with one text and a row that repeats: long runs, written out in blocks."""
    monkeypatch.setattr(sharding, "RUN_BLOCK", 7)
    rows = [(None, "the same text")] * 100 + [(5, "again")] * 15 + [(d, f"text {d}") for d in range(10, 31)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shard_rows(table, shards=4, points=8).collect()
    assert sorted((r.doc_id or -1, r["size"]) for r in got) == sorted((d or -1, len(t) + 16) for d, t in rows)
    slots = [sorted(r.slot for r in got if r.shard == s) for s in range(4)]
    assert slots == [list(range(34))] * 4
    again = sharding.shard_rows(table.repartition(2), shards=4, points=8).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_pieces(spark, docs, empty):
    odd = spark.createDataFrame([(1, "a▁b"), (2, "  two  blanks "), (3, "\n\nlines\n"), (4, "日本 😀 ﬁ"), (5, "\0"), (6, "<s> <0x0A>")], "doc_id long, text string")
    library = sentencepieces_library()
    for table in (odd, docs):
        rows = sentencepieces.encode_texts(table, PIECES).collect()
        for r in rows:
            assert list(r.ids) == library.encode(r.text or ""), r.text[:50]
            assert r.round_trip == ("▁" not in (r.text or ""))
    assert len(rows) == len(TEXTS) + 1
    assert sentencepieces.encode_texts(empty, PIECES).count() == 0


def sentencepieces_library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_decode(spark, empty):
    line = sentencepieces_library().encode("two\nlines")
    ids = spark.createDataFrame([(1, None, "x"), (2, [], "y"), (3, line, "z"), (3, line, "z")], "doc_id long, ids array<int>, text string")
    got = sentencepieces.decode_ids(ids, PIECES)
    assert got.columns == ["doc_id", "ids", "text"]
    assert sorted((r.doc_id, r.text) for r in got.collect() if r.text is not None) == [(2, ""), (3, "two\nlines"), (3, "two\nlines")]
    assert [r.doc_id for r in got.where("text IS NULL").collect()] == [1]
    assert sentencepieces.decode_ids(ids.limit(0), PIECES).count() == 0


def test_unigram_model_on_a_table(spark, docs, tmp_path):
    """Best sums of scores over whole texts: the library's ids, or a better sum where its float sums have lost digits."""
    import math

    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    # Scores like logarithms of frequencies, in steps that floats add without loss up to 2^18.
    for i, piece in enumerate(model.pieces):
        piece.score = -round(64 * math.log(i + 2)) / 64
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for texts in (given, docs.select("doc_id", "text")):
        for r in sentencepieces.encode_texts(texts, str(path)).collect():
            ids, want = list(r.ids), library.encode(r.text or "")
            if len(r.text or "") < 50_000:
                assert ids == want, (r.text or "")[:50]
            else:
                assert r.round_trip and sum(model.pieces[i].score for i in ids) >= sum(model.pieces[i].score for i in want)


def test_unigram_pieces():
    """The best sum of scores, against every segmentation of short words."""
    import random

    rng = random.Random(2)
    pieces = ["<unk>", "▁", *"abc", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab"]
    vocabulary = sentencepieces.Vocabulary(pieces, [0.0, *(-rng.uniform(1, 4) for _ in pieces[1:])], ["unknown"] + ["normal"] * (len(pieces) - 1), merges=False)
    encoder = sentencepieces.Encoder(vocabulary)
    score = dict(zip(pieces[1:], vocabulary.scores[1:], strict=True))

    def best(word):
        if not word:
            return 0.0
        return max(score[p] + best(word[len(p) :]) for p in score if word.startswith(p))

    words = sorted({"▁" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(200)})
    for word, ids in zip(words, encoder.encode_sorted(words), strict=True):
        assert "".join(pieces[i] for i in ids) == word
        assert abs(sum(vocabulary.scores[i] for i in ids) - best(word)) < 1e-9


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (None, [9.0, 9.0]), (7, [1.0, 1.0, 1.0]), (8, []), (9, [1e6, 1e6]), (10, [0.0004, 0.0]), (11, [2e12, 1.0]),
    ]
    vectors = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id long, embedding array<float>, score string, rank string").repartition(3)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(vectors, F.col("vec_id") % 10 == 0, k=3).collect()]
    import math
    import struct

    def floors(v):
        return [math.floor(1024 * struct.unpack("f", struct.pack("f", x))[0]) for x in v]

    usable = {d: floors(v) for d, v in rows if d is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (0, 10):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), d) for d, v in usable.items() if d != q and len(v) == 2)
        want += [(q, i + 1, d, -s) for i, (s, d) in enumerate(scores[:3])]
    assert sorted(got) == sorted(want)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_top_k_many_shards_and_blocks(spark, monkeypatch):
    """Cut finely, so that lists are merged over several levels."""
    import numpy as np

    for name, value in (("SHARD", 16), ("FAN_IN", 3), ("BLOCK", 7), ("TILE", 5)):
        monkeypatch.setattr(topk, name, value)
    v = np.random.default_rng(3).integers(-3, 4, (300, 4)) / 1024
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(vectors, F.col("vec_id") % 15 == 0, k=10).collect())
    whole = np.rint(v * 1024).astype(int)
    want = []
    for q in range(0, 300, 15):
        scores = sorted((-int(whole[q] @ whole[c]), c) for c in range(300) if c != q)
        want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores[:10])]
    assert got == want
