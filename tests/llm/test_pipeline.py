"""The pipeline against its stages done one row at a time on what the stage before kept."""

import comparing
import pytest

import brute
import corpus_pipeline
from tablewright.llm import mixing
from tablewright.llm.common import table, written

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        kept = written(stage(spark, docs, SF), "test")
        out.append((name, docs, kept))
        docs = kept
    return out


def test_stages_keep_columns(stages):
    for _, docs, kept in stages[:-1]:
        assert kept.columns == docs.columns
    assert [name for name, _, _ in stages] == ["toxicity", "exact dedup", "near dedup", "mix sources", "encode"]


def test_toxic_documents_go(stages):
    _, docs, kept = stages[0]
    toxic = comparing.duck(SF).execute("SELECT doc_id, toxic FROM labels").fetchall()
    left = {r.doc_id for r in kept.select("doc_id").collect()}
    assert sum(d in left for d, y in toxic if y) < 0.5 * sum(y for _, y in toxic)
    assert sum(d in left for d, y in toxic if not y) > 0.9 * sum(1 - y for _, y in toxic)


def test_copies_go(stages):
    import re

    _, docs, kept = stages[1]
    first = {}
    for r in docs.collect():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
        first[key] = min(r.doc_id, first.get(key, r.doc_id))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())


def test_near_copies_go(stages):
    _, docs, kept = stages[2]
    want = brute.near_groups([(r.doc_id, r.text) for r in docs.collect()], 5)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, v in want.items() if v[2])


def test_mix_is_the_operator(stages):
    _, docs, kept = stages[3]
    want = mixing.mix_sources(docs, power=0.5, epochs=1.0).groupBy("doc_id").count().collect()
    assert sorted(map(tuple, want)) == sorted(map(tuple, kept.groupBy("doc_id").count().collect()))


def test_encode(spark, stages):
    import sentencepiece

    from tablewright.llm.queries import PIECES

    _, docs, kept = stages[4]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = sorted((r.doc_id, library.encode(r.text)) for r in docs.collect())
    assert sorted((r.doc_id, list(r.ids)) for r in kept.collect()) == want
    assert kept.where("NOT round_trip").isEmpty()


def test_run(spark, stages):
    last = stages[-1][2]
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == last.columns
    assert sorted(map(tuple, rows.select("doc_id", "n_tokens").collect())) == sorted(map(tuple, last.select("doc_id", "n_tokens").collect()))


ODD = "doc_id long, text string, lang string, source string, mix_source string, _kept_id string, _digest string, ids string"


def odd_rows(spark, tmp_path_factory, rows):
    """A folder of tables with these documents and the given labels."""
    folder = tmp_path_factory.mktemp("odd")
    spark.createDataFrame(rows, ODD).write.parquet(str(folder / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").where("doc_id < 0").write.parquet(str(folder / "labels.parquet"))
    return str(folder)


def test_odd_documents(spark, tmp_path_factory):
    """Missing values, empty and long texts, rows that repeat and clashing columns pass all stages."""
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(20_000))
    texts = [(1, None), (2, ""), (3, " \n "), (4, long), (4, long), (5, long + " end"), (None, "nobody knows this one"), (6, "same"), (7, "same"), (8, "a▁b")]
    rows = [(d, t, None, None if d is None else "s", "m", "k", "g", "i") for d, t in texts]
    folder = odd_rows(spark, tmp_path_factory, rows)
    docs, left = table(spark, folder, "documents"), []
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = written(stage(spark, docs, folder), "odd")
        assert kept.columns == docs.columns
        left.append(sorted((r.doc_id or 0) for r in kept.collect()))
        docs = kept
    # No labels: nothing is known to be toxic. A missing text equals an empty one, white space is one space.
    assert left[0] == [0, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    assert left[1] == [0, 1, 3, 4, 5, 6, 8]
    assert left[2] == [0, 1, 3, 4, 6, 8]
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id or 0 for r in out} <= set(left[2])
    assert all(r.n_tokens == len(r.ids) and r.round_trip == (r.doc_id != 8) for r in out)


def test_no_documents(spark, tmp_path_factory):
    assert corpus_pipeline.run(spark, odd_rows(spark, tmp_path_factory, [])).collect() == []
