"""Each corpus operator applied to its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import dedup_exact, dedup_substrings, language, lexical, minhash, mixing, outliers, quality, sentencepieces, sharding, topk, toxicity, whitening
from tablewright.llm.common import table

#: A public tokenizer's vocabulary; a parameter of the operator.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NORMAL_SQL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def hash_sql(*parts: str) -> str:
    joined = " || '|' || ".join(parts)
    return f"CAST('0x' || substr(md5({joined}), 1, 15) AS BIGINT)"


MIX_SQL = f"""
  WITH sized AS (SELECT source, CAST(sum(strlen(coalesce(text, ''))) AS DOUBLE) AS b FROM documents GROUP BY source),
  rated AS (SELECT source, CASE WHEN b > 0 THEN sqrt(b) / sum(sqrt(b)) OVER () * sum(b) OVER () / b ELSE 1.0 END AS rate FROM sized),
  steps AS (SELECT source, rate, unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 24) AS BIGINT))) AS k FROM rated),
  chances AS (SELECT source, k, exp(sum(CASE WHEN k = 0 THEN -rate ELSE ln(rate) - ln(k) END) OVER (PARTITION BY source ORDER BY k)) AS p FROM steps),
  upto AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM chances),
  drawn AS (SELECT *, {hash_sql("'mix-1'", "'count'", "doc_id")} / CAST(1152921504606846976 AS DOUBLE) AS u FROM documents),
  counted AS (SELECT d.doc_id, d.source, d.text, (SELECT count(*) FROM upto u WHERE u.source IS NOT DISTINCT FROM d.source AND u.c <= d.u) AS n_copies FROM drawn d),
  copies AS (SELECT *, unnest(generate_series(1, n_copies)) AS copy FROM counted WHERE n_copies > 0)
  SELECT doc_id, source, text, n_copies, copy, {hash_sql("'mix-1'", "'order'", "doc_id", "copy")} AS shuffle_key FROM copies"""


@query("op3_mix_sources", MIX_SQL)
def mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs, power=0.5, epochs=1.0)


@query("op7_shard_rows")
def shard(spark, sf_dir):
    found = sharding.shard_rows(table(spark, sf_dir, "documents"), shards=40)
    grown = F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", grown, "home_shard")


@query(
    "op8_exact_dedup",
    f"""SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
      row_number() OVER (PARTITION BY n ORDER BY doc_id) = 1 AS kept, sha256(n) AS text_sha256
      FROM (SELECT doc_id, {NORMAL_SQL} AS n FROM documents) WINDOW g AS (PARTITION BY n)""",
)
def exact(spark, sf_dir):
    return dedup_exact.exact_groups(table(spark, sf_dir, "documents"))


@query(
    "op9_top_k",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
    SELECT query_id, rank, vec_id, score FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) WHERE rank <= 10""",
)
def search(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op5_toxicity")
def toxic(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_quality")
def good(spark, sf_dir):
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_language")
def lang(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query("op6_sentencepiece")
def pieces(spark, sf_dir):
    return sentencepieces.token_rows(table(spark, sf_dir, "documents"), PIECES)


@query("op1_near_groups")
def near(spark, sf_dir):
    return minhash.near_groups(table(spark, sf_dir, "documents"), words=2, percent=80)


@query("op4_substring_dedup")
def passages(spark, sf_dir):
    found = dedup_substrings.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_quality_rules", outliers.oracle_sql())
def rules(spark, sf_dir):
    return outliers.quality_rules(table(spark, sf_dir, "documents"))


TERMS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op12_ranked_search",
    f"""WITH d AS MATERIALIZED (SELECT doc_id, {TERMS_SQL} AS ts FROM documents),
    c AS (SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS terms FROM d WHERE len(ts) > 0),
    q AS (SELECT DISTINCT item_id, unnest({TERMS_SQL}) AS term FROM benchmark),
    f AS MATERIALIZED (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
    s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
      FROM f JOIN q USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 10""",
)
def ranked(spark, sf_dir):
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_whitening")
def white(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
