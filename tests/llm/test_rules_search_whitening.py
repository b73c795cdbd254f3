"""Quality rules, ranked search and whitening: plain versions, hard cases, edges."""

import math
import random

import comparing
import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from test_edges import CLASH, TEXTS, frame
from tablewright.llm import lexical, outliers, whitening
from tablewright.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASH)


def repeated(rng, n):
    """Texts whose windows repeat once, overlap, or nearly repeat."""
    words = [f"w{i}" for i in range(40)]
    out = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text[at:at] = text[rng.randint(0, len(text)) :][: rng.randint(0, 20)]
        out.append("".join(w + rng.choice([" ", "  ", "\t", "\n", "\r\n", "\n\n"]) for w in text))
    eight = "one two three four five six seven eight"
    return [*out, "same " * 30, "a\na\n a\n\n \nb\na", eight, f"{eight} {eight}", "é# 日本$ %%"]


def test_counts(spark, docs):
    rows = [(i, t, "en", "s") for i, t in enumerate(repeated(random.Random(8), 120))]
    got = outliers.text_statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)).collect()
    for r in got:
        assert tuple(r)[3:] == brute.counts(rows[r.doc_id][1]), rows[r.doc_id]
    for r in outliers.text_statistics(docs.select("doc_id", "text", "lang", "source")).collect():
        if r.doc_id is not None:
            assert tuple(r)[3:] == brute.counts(dict(TEXTS)[r.doc_id])


def test_rules_edges(spark, docs, empty):
    rows = outliers.quality_rules(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    failed = {r.doc_id: r.base_failed for r in rows}
    assert failed[2] and failed[3] and failed[4] and failed[11] and failed[7]
    assert not any(r.kept for r in rows if r.base_failed)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows)
    assert outliers.quality_rules(empty).count() == 0
    none = spark.createDataFrame([(1, None, None, None)], "doc_id long, text string, lang string, source string")
    assert [(r.n_words, r.base_failed, r.kept) for r in outliers.quality_rules(none).collect()] == [(0, True, False)]


def test_rules_run_no_python(spark, docs):
    stats = outliers.text_statistics(docs.select("doc_id", "text", "lang", "source"))
    vectors = outliers.with_all(stats.withColumn("g", F.lit("g")), [(f"x{i}", sql) for i, sql in zip(outliers.PLACES, outliers.STATISTICS)])
    for df in (stats, outliers.concentrated(vectors, outliers.starts(vectors)), outliers.quality_rules(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def lower_median(v):
    return np.sort(v, axis=0)[(len(v) + 1) // 2 - 1]


def distances(x, centre, covariance):
    return ((x - centre) @ np.linalg.inv(covariance) * (x - centre)).sum(1)


def plain_estimate(x):
    """The estimate of one group in numpy, by the same steps on the whole group."""
    floors = np.array(outliers.FLOORS, float) ** 2
    middle = lower_median(x)
    spread = np.sqrt((1.4826 * lower_median(np.abs(x - middle))) ** 2 + floors)
    bent = np.floor(1024 * np.tanh((x - middle) / spread) + 0.5)
    p = bent.T @ bent
    scale = np.sqrt(np.outer(np.diag(p), np.diag(p)))
    like = np.divide(p, scale, out=np.zeros_like(p), where=scale > 0) * np.outer(spread, spread)
    np.fill_diagonal(like, spread**2 + floors)
    found = []
    for covariance in (np.diag(spread**2), like):
        centre = middle
        for _ in range(outliers.STEPS):
            d = distances(x, centre, covariance)
            place = np.where(d > 1e-9, np.floor(64 * np.log(np.maximum(d, 1e-300))), -9999)
            edge = np.sort(place)[len(x) - len(x) // 4 - 1]
            close = x[place <= edge]
            centre, covariance = close.mean(0), outliers.consistency(0.75) * np.cov(close.T, bias=True) + np.diag(floors)
        found.append((np.linalg.det(covariance), centre, covariance))
    _, centre, covariance = min(found, key=lambda f: f[0])
    inner = x[distances(x, centre, covariance) <= outliers.chi_quantile(outliers.WEIGHING)]
    return inner.mean(0), outliers.consistency(outliers.WEIGHING) * np.cov(inner.T, bias=True) + np.diag(floors)


def test_estimate(spark):
    """A hot group and a small one, a tenth of each far away and correlated: as numpy finds it, and robust."""
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(4, 4))
    groups = {}
    for name, n in (("hot", 4000), ("small", 60)):
        x = rng.normal(size=(n, 4)) @ mix * 600 + 3000
        x[: n // 10] += [4000, -3000, 5000, 4000]
        groups[name] = np.rint(x)
    rows = [(g, *map(int, v)) for g, x in groups.items() for v in x]
    table = spark.createDataFrame(rows, "g string, x1 long, x2 long, x3 long, x4 long").repartition(5)
    got = {r.g: r for r in outliers.estimates_of(table).collect()}
    for g, x in groups.items():
        centre, covariance = plain_estimate(x)
        assert np.allclose([got[g][f"m{i}"] for i in outliers.PLACES], centre)
        w = np.array([[got[g][f"w{i}{j}"] if j <= i else 0.0 for j in outliers.PLACES] for i in outliers.PLACES])
        assert np.allclose(np.linalg.inv(w.T @ w), covariance)
    x, n = groups["hot"], 400
    d = distances(x, *plain_estimate(x))
    assert (d[:n] > outliers.chi_quantile(0.999)).all() and (d[n:] <= outliers.chi_quantile(0.999)).mean() > 0.99


def test_chi_squared():
    """Tabled values."""
    assert abs(outliers.chi_quantile(0.95) - 9.487729) < 1e-5 and abs(outliers.chi_quantile(0.999) - 18.466827) < 1e-5
    assert abs(outliers.chi_quantile(0.95, half=3) - 12.591587) < 1e-5


def test_rules_on_labels(spark):
    """Good documents stay, bad ones go, on the labels of the larger table."""
    sf = "/root/testdata/sf0.01"
    kept = {r.doc_id: r.kept for r in QUERIES["op11_quality_rules"](spark, sf).collect()}
    truth = comparing.duck(sf).execute("SELECT doc_id, quality FROM labels").fetchall()
    assert np.mean([kept[d] for d, q in truth if q == 1]) > 0.93
    assert np.mean([not kept[d] for d, q in truth if q == 0]) > 0.9


def test_search_edges(spark, docs, empty):
    items = [(1, "quick brown FOX"), (2, None), (3, ""), (4, "éé word1 word2"), (4, "lazy"), (None, "dog x " + "x" * 3000), (5, "one ONE"), (6, "nothing known"), (7, "12 345 end")]
    table = spark.createDataFrame([(*i, "y", 1) for i in items], "item_id long, text string, rank string, score long")
    got = [tuple(r) for r in lexical.rank(docs, table, k=4).collect()]
    rows = [*TEXTS, (None, "a text without an id that nobody else has")]
    assert sorted(got, key=str) == sorted(brute.ranked(rows, items, k=4), key=str)
    assert {i for i, *_ in got} == {1, 4, None, 5, 7}
    assert lexical.rank(empty, table).count() == 0 and lexical.rank(docs, table.limit(0)).count() == 0
    assert lexical.rank(docs, table).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_many_blocks(spark, monkeypatch):
    """Small blocks, many passes over the documents, items of over 64 terms, many equal scores."""
    for name, value in (("BLOCK", 16), ("ITEMS", 5), ("TERMS", 200), ("PIECE", 50), ("SALTS", 2)):
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(6)
    words = [f"t{i}" for i in range(300)]

    def text(n):
        return " ".join(words[min(int(rng.expovariate(0.02)), 299)] for _ in range(n))

    rows = [(i, text(rng.randint(0, 40))) for i in range(200)]
    rows += [(300 + i, rows[7][1]) for i in range(30)]
    items = [(i, text(rng.choice([3, 20, 150]))) for i in range(12)]
    frames = (spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"))
    got = [tuple(r) for r in lexical.rank(*frames, k=6).collect()]
    assert sorted(got) == sorted(brute.ranked(rows, items, k=6))


def test_search_leaves_masks_out():
    """Masks that cannot enter are not evaluated: all hold a common term, the last also a rare one."""
    n = 400
    terms = np.r_[np.repeat(np.int32(0), n), 1].astype(np.int32)
    block = lexical.Block(np.arange(n), np.zeros(n, bool), np.full(n, 5), np.r_[np.arange(n), n + 1], terms, np.ones(n + 1, np.int64), n, 5 * n)
    docs, first, held = block.groups(np.array([0, 1]))
    assert len(first) == 2 and held.shape == (2, 2) and len(docs) == n
    looked, scores = [], block.scores
    block.scores = lambda docs, weight: looked.append(len(docs)) or scores(docs, weight)
    best = lexical.Best(1)
    best.add(np.array([6_000_000]), np.array([False]), np.array([-1]))
    lexical.search_block(block, np.array([0, 1], np.int32), np.array([10, 5000]), best, 2)
    assert looked == [1] and best.rows[2].tolist() == [n - 1]
    lexical.search_block(block, np.array([0], np.int32), np.array([10]), best, 2)
    assert looked == [1]


def by_component(rows):
    by = {}
    for r in rows:
        by.setdefault(r.component, {})[r.vec_id] = r
    return by


def test_whitening(spark):
    table = comparing.duck().execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in table], object)
    n, total = len(x), x.sum(0)
    far = n * x - total
    covariance = (far.T @ far).astype(float) / float(n) ** 3
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    by = by_component(QUERIES["op13_whitening"](spark, comparing.SF).collect())
    assert sorted(by) == list(range(1, 33))
    for k, found in by.items():
        assert len(found) == n and {r.n for r in found.values()} == {n}
        assert [found[d].deviation for d, _ in table] == [int((f * f).sum()) for f in far]
        got = np.array([found[d].whitened for d, _ in table])
        want = (far.astype(float) / n) @ vectors[:, k - 1] / math.sqrt(values[k - 1])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
        assert abs(found[0].explained / (values[k - 1] / np.trace(covariance)) - 1) < 1e-9
        assert {r.identity_error for r in found.values()} == {by[1][0].identity_error} and by[1][0].identity_error < 1e-9


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, 1.0, 2.0]), (1, [1.5, 1.0, -2.0]), (1, [1.5, 1.0, -2.0]), (None, [3.0, 1.0, 7.0]), (2, None), (3, [None, 1.0, 1.0]),
        (4, [nan, 1.0, 1.0]), (5, [1.0, -inf, 1.0]), (6, []), (7, [1.0]), (8, [3e38, 0.0, 0.0]),
    ]
    vectors = spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id long, embedding array<float>, n string, component long").repartition(3)
    found = whitening.whiten(vectors).collect()
    by = by_component(found)
    assert len(found) == 12 and sorted(by) == [1, 2, 3] and all(set(own) == {0, 1, None} for own in by.values())
    # The second entry never changes: the third component has no variance.
    assert {r.whitened for r in by[3].values()} == {None} and by[3][0].explained < 1e-15
    assert by[1][0].identity_error < 1e-9 and all(r.whitened is not None for r in by[2].values())
    assert whitening.whiten(vectors.limit(0)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 2


def test_whitening_large_numbers(spark):
    """Sums and deviations are exact where doubles are not; what needs over 64 bits is missing."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.integers(-(2**40), 2**40, 3) / 64]) for i in range(50)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], object)
    far = 50 * x - x.sum(0)
    by = by_component(whitening.whiten(table).collect())
    squares = [int((f * f).sum()) for f in far]
    assert [by[1][i].deviation for i in range(50)] == [s if s < 2**63 else None for s in squares] and by[1][0].identity_error < 1e-9
    centre = [500_000, 1_000_000, 2_000_000]
    sums = whitening.exact_sums(whitening.whole(table), centre, products=True)
    y = x - np.array(centre, object)
    assert sums[0] == y.sum(0).tolist() and sums[1:] == (y.T @ y).tolist()


SPECTRA = [
    np.linspace(1, 50, 40), [10.0 ** (6 - i / 4) for i in range(40)], [1 + 1e-9 * i for i in range(40)], [1.0] * 20,
    [1e5] * 6 + [1e5 * (1 + 1e-10)] * 5 + [3.0] * 9 + [1.0] * 9, [1e8] + [1 + 1e-7 * i for i in range(30)], [5.0, 3.0, 0, 0, 0], [7.0],
]


@pytest.mark.parametrize("values", SPECTRA)
def test_spectrum(values):
    """Eigenvectors to the last digits, also of clustered and equal eigenvalues."""
    size = len(values)
    q = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))[0].astype(np.longdouble)
    q = whitening.upright(whitening.upright(q))
    a = (q * np.array(values, np.longdouble)) @ q.T
    found, x = whitening.spectrum((a + a.T) / 2)
    want = np.sort(np.array(values, float))[::-1]
    assert np.abs(found - want).max() < 1e-15 * want[0] and (np.diff(found) <= 1e-15 * want[0]).all()
    assert np.abs(a @ x - x * found).max() < 1e-15 * want[0] and np.abs(x.T @ x - np.eye(size)).max() < 1e-15
