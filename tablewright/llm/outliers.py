"""Quality rules by robust multivariate outliers, in DataFrame operations only.

Every text is counted as a whole: words, characters, symbols, repeated lines and words in repeated
windows. Plain rules come first. For the rest, four rates, transformed to logarithms and kept as
whole numbers of 1/1024, are held against the documents of the same language and source: the
minimum-covariance-determinant estimate takes the three quarters of a group that lie closest
together, and a document whose Mahalanobis distance from their centre is beyond a quantile of the
chi-squared distribution is rejected.

The estimate starts from two robust guesses, medians with their spreads and the correlations of
hyperbolic tangents. A concentration step measures all distances with the last estimate, takes the
closest documents of each group and estimates anew from these; the start with the smaller
determinant stays. Distances are counted in logarithmic bins, so a step is one aggregation that
combines on the map side, whatever the size of a group, and no group is ever ranked or collected.
Sums are of whole numbers: the same rows give the same result however they are dealt.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
BLANK_CHARS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
#: Words in a window.
WINDOW = 8
#: Rules: fewest words, and words in repeated windows in hundredths of all.
FEWEST, MOST_REPEATED = 20, 30
#: Documents that a group needs for an estimate of its own.
LEAST = 50
#: Concentration steps.
STEPS = 8
#: Share of the documents that weigh in the second estimate, and of clean documents that stay.
WEIGHING, STAYING = 0.975, 0.999
#: Least spread of each statistic, in 1/1024: no group is held to be more alike than this.
FLOORS = (51, 307, 512, 614)
DIM = len(FLOORS)
PLACES = range(1, DIM + 1)
PAIRS = [(j, i) for i, j in combinations_with_replacement(PLACES, 2)]

#: The statistics. Rates are smoothed by a hundred words of five letters, as short texts vary more.
STATISTICS = [
    "CAST(floor(1024e0 * ln((word_chars + 5e2) / (n_words + 1e2)) + 5e-1) AS BIGINT)",
    "CAST(floor(1024e0 * ln(1e0 + 1e2 * n_symbols / (n_words + 1e2)) + 5e-1) AS BIGINT)",
    "CAST(floor(1024e0 * ln(1e0 + 1e2 * n_dup_lines / (n_words + 1e2)) + 5e-1) AS BIGINT)",
    "CAST(floor(1024e0 * ln(1e0 + 1e2 * n_repeat_words / (n_words + 1e2)) + 5e-1) AS BIGINT)",
]
#: Distance of a document from an estimate: centre ``m`` and inverse factor ``w`` of the covariance.
DISTANCE = " + ".join("({0}) * ({0})".format(" + ".join(f"w{i}{j} * (x{j} - m{j})" for j in range(1, i + 1))) for i in PLACES)
#: Logarithmic bin of a distance: 64 to a factor of e.
BIN = "CASE WHEN d2 > 1e-9 THEN CAST(floor(64e0 * ln(d2)) AS BIGINT) ELSE -9999 END"


def chi_squared(x: float, half: int) -> float:
    """Distribution function for 2 * ``half`` degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(half))


def chi_quantile(p: float, half: int = DIM // 2) -> float:
    low, high = 0.0, 1000.0
    while high - low > 1e-12 * high:
        low, high = (mid, high) if chi_squared(mid := (low + high) / 2, half) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the covariance of the closest ``share`` of a normal distribution is too small by."""
    return share / chi_squared(chi_quantile(share), DIM // 2 + 1)


def estimate_sql(factor: float) -> list[tuple[str, str]]:
    """Estimate from a number ``n`` of documents, their sums ``s`` and sums of products ``p``: centre, covariance and its factors."""
    centre = [(f"m{i}", f"s{i} / (n * 1e0)") for i in PLACES]
    covariance = [(f"c{i}{j}", f"{factor!r} * (p{i}{j} / (n * 1e0) - m{i} * m{j})" + (f" + {FLOORS[i - 1] ** 2}e0" if i == j else "")) for i, j in PAIRS]
    return centre + covariance + factors_sql()


def factors_sql() -> list[tuple[str, str]]:
    """Lower factor ``l`` of the covariance ``c``, its inverse ``w`` and the root of the determinant."""
    out = []
    for j in PLACES:
        less = "".join(f" - l{j}{k} * l{j}{k}" for k in range(1, j))
        out.append((f"l{j}{j}", f"sqrt(c{j}{j}{less})"))
        for i in range(j + 1, DIM + 1):
            less = "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))
            out.append((f"l{i}{j}", f"(c{i}{j}{less}) / l{j}{j}"))
    for i in PLACES:
        for j in range(1, i):
            out.append((f"w{i}{j}", "-(" + " + ".join(f"l{i}{k} * w{k}{j}" for k in range(j, i)) + f") / l{i}{i}"))
        out.append((f"w{i}{i}", f"1e0 / l{i}{i}"))
    return [*out, ("det", " * ".join(f"l{i}{i}" for i in PLACES))]


ESTIMATE = [f"m{i}" for i in PLACES] + [f"w{i}{j}" for i, j in PAIRS] + ["det"]


def with_all(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """``df`` with columns that may build on each other, in one selection."""
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns])


def same_as_neighbour(found: Column, *keys: str) -> Column:
    """Elements of a sorted array of structs that agree with the one before or after them."""

    def agrees(item: Column, place: Column) -> Column:
        other = F.get(found, place)
        equal = F.lit(True)
        for key in keys:
            equal = equal & (item[key] == other[key])
        return F.coalesce(equal, F.lit(False))

    return F.filter(found, lambda x, i: agrees(x, i - 1) | agrees(x, i + 1))


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang, source) with the counts in place of the text."""
    text = F.col("text")
    counted = docs.withColumn("text", F.coalesce(text, F.lit(""))).withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # A window is first known by its hash; only windows whose hash comes again are compared word by word.
    starts = F.sequence(F.lit(0), F.size("words") - WINDOW)
    hashes = F.when(F.size("words") > WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("words", i + 1, WINDOW)))).otherwise(F.array().cast("array<long>"))
    counted = counted.select(
        "doc_id", "lang", "source", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, BLANK_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"), hashes.alias("hashes"),
    )
    counted = counted.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    placed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    counted = counted.withColumn("placed", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed).otherwise(none))
    counted = counted.withColumn("again", same_as_neighbour(F.col("placed"), "h"))
    spelled = F.sort_array(F.transform("again", lambda x: F.struct(x["h"].alias("h"), F.slice("words", x["i"] + 1, WINDOW).alias("w"), x["i"].alias("i"))))
    counted = counted.withColumn("spelled", F.when(F.size("again") > 0, spelled).otherwise(F.array().cast("array<struct<h:bigint,w:array<string>,i:int>>")))
    counted = counted.withColumn("at", F.sort_array(F.transform(same_as_neighbour(F.col("spelled"), "h", "w"), lambda x: x["i"])))
    # Every repeated window adds its words up to the start of the next.
    steps = F.transform("at", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - x, F.lit(WINDOW))).cast("long"))
    return counted.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))


def grouped(stats: DataFrame, least: int) -> DataFrame:
    """``stats`` with the group ``g`` of each row: its language and source, or what small ones are joined to.

    Sources with fewer than ``least`` documents of a language are taken together by language, and
    languages that still have fewer are taken together. A missing language or source is one too.
    """
    def size(*by: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*by))

    pairs = stats.groupBy("lang", "source").agg(F.sum(F.when(F.col("base_failed"), 0).otherwise(1)).alias("n"))
    pairs = pairs.withColumn("own", F.col("n") >= least).withColumn("by_lang", size("lang", "own") >= least)
    key = F.when(F.col("own"), F.to_json(F.struct(F.lit(0).alias("of"), "lang", "source"))).when(F.col("by_lang"), F.to_json(F.struct(F.lit(1).alias("of"), "lang"))).otherwise(F.lit("rest"))
    names = written(pairs.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), key.alias("g")), "groups")
    return stats.join(names, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))).drop("_lang", "_source")


def medians(counts: DataFrame) -> DataFrame:
    """The lower median of every statistic of a group, from how often each value occurs: g, dim, median."""
    upto = Window.partitionBy("g", "dim").orderBy("v")
    half = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy("g", "dim")))
    return half.where("2 * upto >= all").groupBy("g", "dim").agg(F.min("v").alias("median"))


def starts(rows: DataFrame) -> DataFrame:
    """Two first estimates for every group: g, start and the columns of an estimate."""
    counts = written(rows.select("g", F.posexplode(F.array(*[f"x{i}" for i in PLACES])).alias("dim", "v")).groupBy("g", "dim", "v").agg(F.count(F.lit(1)).alias("n")), "values")
    middle = written(medians(counts), "medians")
    away = counts.join(middle, ["g", "dim"]).groupBy("g", "dim", F.abs(F.col("v") - F.col("median")).alias("v")).agg(F.sum("n").alias("n"))
    spread = middle.join(medians(away).withColumnRenamed("median", "away"), ["g", "dim"])
    wide = spread.groupBy("g").agg(
        *[F.max(F.when(F.col("dim") == i - 1, F.col("median") * F.lit(1.0))).alias(f"m{i}") for i in PLACES],
        *[F.max(F.when(F.col("dim") == i - 1, F.sqrt(F.pow(F.col("away") * F.lit(1.4826), F.lit(2.0)) + FLOORS[i - 1] ** 2))).alias(f"r{i}") for i in PLACES],
    )
    wide = written(wide, "spreads")
    plain = with_all(wide.withColumn("start", F.lit(0)), [(f"c{i}{j}", f"r{i} * r{i}" if i == j else "0e0") for i, j in PAIRS] + factors_sql())
    bent = rows.join(wide, "g").select("g", *[F.expr(f"CAST(floor(1024e0 * tanh((x{i} - m{i}) / r{i}) + 5e-1) AS BIGINT)").alias(f"y{i}") for i in PLACES])
    sums = wide.join(bent.groupBy("g").agg(*[F.sum(F.col(f"y{i}") * F.col(f"y{j}")).alias(f"p{i}{j}") for i, j in PAIRS]), "g").withColumn("start", F.lit(1))
    like = [
        (f"c{i}{j}", f"r{i} * r{i} + {FLOORS[i - 1] ** 2}e0" if i == j else f"CASE WHEN p{i}{i} > 0 AND p{j}{j} > 0 THEN r{i} * r{j} * (p{i}{j} / (sqrt(p{i}{i} * 1e0) * sqrt(p{j}{j} * 1e0))) ELSE 0e0 END")
        for i, j in PAIRS
    ]
    columns = ["g", "start", *ESTIMATE]
    return written(plain.select(columns).unionByName(with_all(sums, like + factors_sql()).select(columns)), "starts")


def summed() -> list[Column]:
    return [F.sum(f"x{i}").alias(f"s{i}") for i in PLACES] + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in PAIRS]


def concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: every group's estimate from the three quarters of its documents that are closest by the last one."""
    binned = rows.join(estimates.drop("det"), "g").withColumn("d2", F.expr(DISTANCE)).withColumn("bin", F.expr(BIN))
    bins = binned.groupBy("g", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *summed())
    group = Window.partitionBy("g", "start")
    bins = bins.withColumn("before", F.sum("n").over(group.orderBy("bin")) - F.col("n")).withColumn("all", F.sum("n").over(group))
    # The bin that the quarter's edge falls into counts as a whole.
    close = bins.where(F.expr("before < all - all div 4")).groupBy("g", "start").agg(*[F.sum(c).alias(c) for c in ["n"] + [f"s{i}" for i in PLACES] + [f"p{i}{j}" for i, j in PAIRS]])
    return written(with_all(close, estimate_sql(consistency(0.75))).select("g", "start", *ESTIMATE), "estimates")


def estimates_of(rows: DataFrame) -> DataFrame:
    """The final estimate of every group, from the documents that lie within the first one: g and its columns."""
    found = starts(rows)
    for _ in range(STEPS):
        found = concentrated(rows, found)
    best = found.groupBy("g").agg(F.min_by(F.struct(*found.columns[1:]), F.struct("det", "start")).alias("e")).select("g", "e.*").drop("start")
    inner = rows.join(best.drop("det"), "g").where(F.expr(DISTANCE) <= chi_quantile(WEIGHING))
    sums = inner.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *summed())
    return written(with_all(sums, estimate_sql(consistency(WEIGHING))).select("g", *ESTIMATE), "final")


def quality_rules(docs: DataFrame, least: int = LEAST, staying: float = STAYING) -> DataFrame:
    """Every document's counts and verdict: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Words are runs of characters other than ASCII white space, ``word_chars`` their characters,
    ``n_symbols`` characters of ``#*$%&|<>``, ``n_dup_lines`` lines with a word that equal an earlier
    one, ``n_repeat_words`` words that stand in a window of eight words found twice or more in the
    text. ``base_failed``: fewer than 20 words, or over 30 in a hundred of them in repeated windows.
    ``kept``: not that, and at a distance from its language and source that ``staying`` of normal
    documents have. Groups below ``least`` documents are joined (see ``grouped``).

    A missing text has no words and fails; so does an empty one. Texts are counted whole, in memory in
    proportion to their length. Missing languages and sources are groups of their own. Rows are judged
    one by one, repeated ones and those without doc_id alike. Empty tables give no rows; other columns
    are not read.
    """
    counts = text_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source"))
    failed = (F.col("n_words") < FEWEST) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    stats = written(counts.withColumn("base_failed", failed), "statistics")
    stats = written(with_all(grouped(stats, least), [(f"x{i}", sql) for i, sql in zip(PLACES, STATISTICS, strict=True)]), "vectors")
    found = estimates_of(stats.where("NOT base_failed").select("g", *[f"x{i}" for i in PLACES]))
    near = F.coalesce(F.expr(DISTANCE) <= chi_quantile(staying), F.lit(False))
    judged = stats.join(found.drop("det"), "g", "left").withColumn("kept", ~F.col("base_failed") & near)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sums_sql() -> str:
    return ", ".join([f"CAST(sum(x{i}) AS BIGINT) AS s{i}" for i in PLACES] + [f"CAST(sum(x{i} * x{j}) AS BIGINT) AS p{i}{j}" for i, j in PAIRS])


def _levels_sql(name: str, source: str, keys: str, columns: list[tuple[str, str]], condition: str = "") -> str:
    """One common table expression with columns that build on each other."""
    listed = ", ".join(f"{sql} AS {column}" for column, sql in columns)
    return f"{name} AS MATERIALIZED (SELECT {keys}, {', '.join(ESTIMATE)} FROM (SELECT *, {listed} FROM {source}) {condition})"


def oracle_sql(least: int = LEAST, staying: float = STAYING) -> str:
    """``quality_rules`` of the whole table as DuckDB SQL."""
    xs, quarter = ", ".join(f"x{i}" for i in PLACES), consistency(0.75)
    median = "SELECT g, dim, min(v) AS median FROM (SELECT *, sum(n) OVER (PARTITION BY g, dim ORDER BY v) AS upto, sum(n) OVER (PARTITION BY g, dim) AS every FROM {0}) WHERE 2 * upto >= every GROUP BY g, dim"
    bent = ", ".join(f"CAST(floor(1024e0 * tanh((x{i} - m{i}) / r{i}) + 5e-1) AS BIGINT) AS y{i}" for i in PLACES)
    plain = [(f"c{i}{j}", f"r{i} * r{i}" if i == j else "0e0") for i, j in PAIRS]
    like = [
        (f"c{i}{j}", f"r{i} * r{i} + {FLOORS[i - 1] ** 2}e0" if i == j else f"CASE WHEN p{i}{i} > 0 AND p{j}{j} > 0 THEN r{i} * r{j} * (p{i}{j} / (sqrt(p{i}{i} * 1e0) * sqrt(p{j}{j} * 1e0))) ELSE 0e0 END")
        for i, j in PAIRS
    ]
    parts = [
        f"""words AS MATERIALIZED (SELECT doc_id, lang, source, t, regexp_extract_all(t, '{WORD}') AS w,
          list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
          FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
        f"windows AS (SELECT doc_id, i, w[i:i + {WINDOW - 1}] AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words WHERE len(w) >= {WINDOW}))",
        "again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS k FROM windows) WHERE k > 1)",
        f"covered AS (SELECT doc_id, count(DISTINCT place) AS k FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS place FROM again) GROUP BY doc_id)",
        """counts AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
          CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
          CAST(coalesce(k, 0) AS BIGINT) AS n_repeat_words FROM words LEFT JOIN covered USING (doc_id))""",
        f"judged AS MATERIALIZED (SELECT *, n_words < {FEWEST} OR n_repeat_words * 100 > n_words * {MOST_REPEATED} AS base_failed FROM counts)",
        f"""pairs AS (SELECT *, own OR sum(n) OVER (PARTITION BY lang, own) >= {least} AS by_lang FROM
          (SELECT lang, source, sum(CASE WHEN base_failed THEN 0 ELSE 1 END) AS n, sum(CASE WHEN base_failed THEN 0 ELSE 1 END) >= {least} AS own FROM judged GROUP BY lang, source))""",
        f"""stats AS MATERIALIZED (SELECT j.*, CASE WHEN own THEN to_json({{'l': j.lang, 's': j.source}})::VARCHAR WHEN by_lang THEN to_json({{'l': j.lang}})::VARCHAR ELSE 'rest' END AS g,
          {", ".join(f"{sql} AS x{i}" for i, sql in zip(PLACES, STATISTICS, strict=True))}
          FROM judged j JOIN pairs p ON j.lang IS NOT DISTINCT FROM p.lang AND j.source IS NOT DISTINCT FROM p.source)""",
        f"rows AS MATERIALIZED (SELECT g, {xs} FROM stats WHERE NOT base_failed)",
        "vals AS MATERIALIZED (SELECT g, dim, v, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT g, {i} AS dim, x{i} AS v FROM rows" for i in PLACES) + ") GROUP BY ALL)",
        f"mids AS MATERIALIZED ({median.format('vals')})",
        "off AS (SELECT g, dim, abs(v - median) AS v, sum(n) AS n FROM vals JOIN mids USING (g, dim) GROUP BY ALL)",
        f"away AS ({median.format('off')})",
        "spreads AS MATERIALIZED (SELECT g, " + ", ".join(f"max(CASE WHEN dim = {i} THEN m.median * 1e0 END) AS m{i}, max(CASE WHEN dim = {i} THEN sqrt(pow(a.median * 1.4826e0, 2e0) + {FLOORS[i - 1] ** 2}) END) AS r{i}" for i in PLACES)
        + " FROM mids m JOIN away a USING (g, dim) GROUP BY g)",
        f"bent AS (SELECT g, {bent} FROM rows JOIN spreads USING (g))",
        "turned AS (SELECT * FROM spreads JOIN (SELECT g, " + ", ".join(f"CAST(sum(y{i} * y{j}) AS BIGINT) AS p{i}{j}" for i, j in PAIRS) + " FROM bent GROUP BY g) USING (g))",
        _levels_sql("first0", "spreads", "g, 0 AS start", plain + factors_sql()),
        _levels_sql("first1", "turned", "g, 1 AS start", like + factors_sql()),
        "step0 AS MATERIALIZED (SELECT * FROM first0 UNION ALL SELECT * FROM first1)",
    ]
    for k in range(STEPS):
        parts += [
            f"bins{k} AS (SELECT g, start, bin, count(*) AS n, {_sums_sql()} FROM (SELECT *, {BIN} AS bin FROM (SELECT g, start, {xs}, {DISTANCE} AS d2 FROM rows JOIN step{k} USING (g))) GROUP BY g, start, bin)",
            f"close{k} AS (SELECT g, start, CAST(sum(n) AS BIGINT) AS n, " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in [f"s{i}" for i in PLACES] + [f"p{i}{j}" for i, j in PAIRS])
            + f" FROM (SELECT *, sum(n) OVER (PARTITION BY g, start ORDER BY bin) - n AS before, sum(n) OVER (PARTITION BY g, start) AS every FROM bins{k}) WHERE before < every - every // 4 GROUP BY g, start)",
            _levels_sql(f"step{k + 1}", f"close{k}", "g, start", estimate_sql(quarter)),
        ]
    parts += [
        f"best AS MATERIALIZED (SELECT * FROM step{STEPS} QUALIFY row_number() OVER (PARTITION BY g ORDER BY det, start) = 1)",
        f"inner_rows AS (SELECT g, count(*) AS n, {_sums_sql()} FROM rows JOIN best USING (g) WHERE {DISTANCE} <= {chi_quantile(WEIGHING)!r} GROUP BY g)",
        _levels_sql("final", "inner_rows", "g", estimate_sql(consistency(WEIGHING))),
    ]
    return (
        "WITH " + ",\n".join(parts) + f"""
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({DISTANCE} <= {chi_quantile(staying)!r}, false) AS kept
      FROM stats LEFT JOIN final USING (g)"""
    )
