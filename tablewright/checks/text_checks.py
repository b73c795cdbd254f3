"""Scalar expressions over rendered and given texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.checks.registry import check, no_gaps, table
from tablewright.checks.render import cents
from tablewright.functions import numbers as N, records as R, text as X
from tablewright.operators import rename


@check("str_contains", """
  SELECT doc_id, contains(text, 'the') OR contains(text, 'que') AS any_of, contains(text, 'the') AND contains(text, 'in') AS all_of
  FROM documents""")
def str_contains(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.contains_any(text, ["the", "que"]).alias("any_of"), X.contains_all(text, ["the", "in"]).alias("all_of")
    )


@check("str_multi_replace", "SELECT doc_id, replace(replace(coalesce(text, ''), 'th', 'in'), 'in', '') AS text FROM documents")
def str_multi_replace(spark, sf_dir):
    once = X.replace_each(F.col("text"), ["th"], "in")
    return table(spark, sf_dir, "documents").select("doc_id", X.replace_each(once, ["in"]).alias("text"))


@check("str_multi_replace_ordered", """
  SELECT o_orderkey, replace(replace(coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, ''), 'IG', 'H'), 'HH', '') AS p FROM orders""")
def str_multi_replace_ordered(spark, sf_dir):
    some = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.replace_each(X.replace_each(some, ["IG"], "H"), ["HH"]).alias("p"))


@check("arr_clean", r"""
  SELECT doc_id, array_to_string(list_transform(list_filter(string_split_regex(text || chr(10) || ' ', '\. '), lambda x: trim(x, ' ') <> chr(10)),
         lambda x: trim(x, chr(10))), '|') AS lines FROM documents""")
def arr_clean(spark, sf_dir):
    lines = F.split(F.concat("text", F.lit("\n ")), r"\. ")
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(X.clean_lines(lines), "|").alias("lines"))


@check("str_trim_set", """
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS qty, count(*) AS n FROM lineitem GROUP BY ALL""")
def str_trim_set(spark, sf_dir):
    shown = F.concat(F.lit(" +"), F.col("l_quantity").cast("bigint").cast("string"), F.lit("%\n "))
    items = table(spark, sf_dir, "lineitem").withColumn("shown", shown)
    qty = X.trim_set(F.col("shown"), " +%\n").cast("bigint").alias("qty")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", qty).groupBy("l_orderkey", "l_linenumber", "l_partkey", "qty").agg(
        F.count("*").alias("n")
    )


@check("ascii_clean", r"""
  SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS plain, NOT regexp_matches(text, '[^\x00-\x7F]') AS is_ascii FROM documents""")
def ascii_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.ascii_only(F.col("text")).alias("plain"), X.is_ascii(F.col("text")).alias("is_ascii")
    )


@check("capwords", """
  SELECT p_partkey, list_aggregate(list_transform(string_split(p_name || ' ' || lower(p_type), ' '), lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', ' ') AS words,
         upper(p_name[1]) || lower(p_name[2:]) || ' ' || lower(p_type) AS capital, upper(p_name[1]) || p_name[2:] || ' ' || p_type AS first_up FROM part""")
def capwords(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    messy = F.concat(F.lit("  "), F.regexp_replace("p_name", " ", " \t "), F.lit("  "), "p_type", F.lit(" "))
    both = F.concat_ws(" ", "p_name", "p_type")
    return parts.select("p_partkey", X.capwords(messy).alias("words"), X.capitalize(both).alias("capital"), X.upper_first(both).alias("first_up"))


@check("split_part", "SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '?', 1) AS first, split_part(url, '/', -1) AS last FROM pages")
def split_part(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", X.before(F.split_part(url, F.lit("//"), F.lit(2)), "/").alias("host"), X.before(url, "?").alias("first"), X.after_last(url, "/").alias("last")
    )


@check("level_band", """
  SELECT p_partkey,
    CASE WHEN p_partkey % 8 = 7 THEN -1 ELSE CAST(p_size AS BIGINT) END AS lo,
    CAST(CASE p_partkey % 8 WHEN 0 THEN p_size + 9 WHEN 1 THEN p_size + 12 WHEN 2 THEN 300 WHEN 3 THEN 300 WHEN 4 THEN p_size
      WHEN 5 THEN 300 WHEN 6 THEN 300 ELSE -1 END AS BIGINT) AS hi_closed,
    CAST(CASE p_partkey % 8 WHEN 0 THEN p_size + 9 WHEN 1 THEN p_size + 12 WHEN 7 THEN -1 ELSE 300 END AS BIGINT) AS hi_open FROM part""")
def level_band(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    size, form = F.col("p_size").cast("string"), F.col("p_partkey") % 8
    shown = (
        F.when(form == 0, F.concat(size, F.lit("-"), (F.col("p_size") + 9).cast("string")))
        .when(form == 1, F.concat(size, F.lit(" ~ "), (F.col("p_size") + 12).cast("string")))
        .when(form == 2, F.concat(size, F.lit(" and above")))
        .when(form == 3, F.concat(size, F.lit("+")))
        .when(form == 4, size)
        .when(form == 5, F.concat(F.lit("at least level "), size, F.lit(".")))
        .when(form == 6, F.concat(F.lit("Level requirement: "), size))
        .otherwise("any")
    )
    closed, opened = N.level_band(shown), N.level_band(shown, lone="open")
    bands = parts.select(
        "p_partkey",
        closed["MinLvl"].cast("bigint").alias("lo"),
        closed["MaxLvl"].cast("bigint").alias("hi_closed"),
        opened["MaxLvl"].cast("bigint").alias("hi_open"),
    )
    return no_gaps(bands, "lo", "hi_closed", "hi_open")


@check("num_parse", """
  SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(o_custkey AS BIGINT) AS stars,
         CASE WHEN o_orderstatus = 'F' THEN -1 ELSE CAST(o_custkey AS BIGINT) END AS missing,
         CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(o_custkey AS BIGINT) END AS zero FROM orders""")
def num_parse(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    price = F.concat(F.lit(" +"), F.format_number("o_totalprice", 2), F.lit("%"))
    stars = F.concat(F.col("o_custkey").cast("string"), F.lit("★"))
    some = F.when(F.col("o_orderstatus") != "F", F.concat(F.col("o_custkey").cast("string"), F.lit("%")))
    numbers = orders.select(
        "o_orderkey",
        F.round(N.parse_number(price) * 100).cast("bigint").alias("cents"),
        N.parse_number(stars).cast("bigint").alias("stars"),
        N.parse_number(some).cast("bigint").alias("missing"),
        N.parse_number(some, absent=0).cast("bigint").alias("zero"),
    )
    return no_gaps(numbers, "missing")


@check("num_or_null", r"""
  SELECT doc_id, w AS word, CASE WHEN regexp_full_match(w, '[0-9]+') THEN TRY_CAST(w AS BIGINT) ELSE -1 END AS num, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS w FROM documents) GROUP BY ALL""")
def num_or_null(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", r"\s+")).alias("word"))
    return no_gaps(words.withColumn("num", N.number_or_null(F.col("word"))), "num").groupBy("doc_id", "word", "num").agg(F.count("*").alias("n"))


@check("pair_max", """
  SELECT p_partkey, unnest(CASE WHEN p_size % 2 = 0 THEN [CAST(p_size AS BIGINT) + 1] ELSE [CAST(p_size AS BIGINT) + 1, CAST(p_size AS BIGINT) + 2] END) AS id FROM part""")
def pair_max(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    star = lambda n: F.concat((F.col("p_size") + n).cast("string"), F.lit("★"))
    one = F.concat(star(0), F.lit(" → "), star(1))
    two = F.concat(one, F.lit(", "), star(2), F.lit(" → "), star(1))
    ids = N.pair_maxima(F.when(F.col("p_size") % 2 == 0, one).otherwise(two))
    return parts.select("p_partkey", F.explode(ids.cast("array<bigint>")).alias("id"))


@check("effect_parse", """
  SELECT p_partkey,
    CASE WHEN f IN (0, 1, 4) THEN s ELSE -1 END AS chance, CASE WHEN f IN (2, 5) THEN s WHEN f = 4 THEN s + 1 ELSE -1 END AS duration,
    CASE WHEN f = 3 THEN s ELSE -1 END AS tick, CASE WHEN f IN (0, 5, 6) THEN 'Perc' ELSE 'Flat' END AS kind
  FROM (SELECT p_partkey, p_partkey % 8 AS f, CAST(p_size AS BIGINT) AS s FROM part)""")
def effect_parse(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    n, form = F.col("p_size").cast("string"), F.col("p_partkey") % 8
    more = (F.col("p_size") + 1).cast("string")
    shown = (
        F.when(form == 0, F.concat(n, F.lit("% chance to ignore 0% of damage dealt")))
        .when(form == 1, F.concat(n, F.lit("% chance to recover HP when hit by 30%")))
        .when(form == 2, F.concat(F.lit("Skill Cooldown -"), n, F.lit(" seconds")))
        .when(form == 3, F.concat(F.lit("Recovers HP every "), n, F.lit(" seconds")))
        .when(form == 4, F.concat(n, F.lit("% chance to become invincible for "), more, F.lit(" seconds when attacked")))
        .when(form == 5, F.concat(F.lit("Damage +3% for "), n, F.lit(" second")))
        .when(form == 6, F.concat(F.lit("Damage to Boss Monsters +"), n, F.lit("%")))
        .otherwise(F.concat(F.lit("Max HP +"), n))
    )

    facts = N.effect_facts(shown)
    found = parts.select(
        "p_partkey",
        facts["Chance"].cast("bigint").alias("chance"),
        facts["Duration"].cast("bigint").alias("duration"),
        facts["Tick"].cast("bigint").alias("tick"),
        facts["StatT"].alias("kind"),
    )
    return no_gaps(found, "chance", "duration", "tick")


@check("flat_perc", """
  SELECT doc_id, CASE WHEN contains(text, '%') THEN 'Perc' ELSE 'Flat' END AS by_sign,
         CASE WHEN contains(text, 'flat') THEN 'Flat' ELSE 'Perc' END AS by_word FROM documents""")
def flat_perc(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", N.flat_or_percent(F.col("text")).alias("by_sign"), N.flat_by_word(F.col("text")).alias("by_word")
    )


@check("grade_split", "SELECT p_partkey, p_type AS grade, p_brand AS prime FROM part")
def grade_split(spark, sf_dir):
    parts = R.grade_parts(F.concat("p_type", F.lit(" ("), "p_brand", F.lit(")")))
    return table(spark, sf_dir, "part").select("p_partkey", parts["Grade"].alias("grade"), parts["Prime"].alias("prime"))


@check("special_bucket", """
  SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'SPECIAL' ELSE c_mktsegment END AS segment, c_mktsegment AS grp FROM customer""")
def special_bucket(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    shown = F.when(F.col("c_nationkey") % 3 == 0, F.concat("c_mktsegment", F.lit(" + OTHER"))).otherwise(F.col("c_mktsegment"))
    noted = F.concat("c_mktsegment", F.lit(" (new)"))
    return customers.select("c_custkey", X.bucket_special(shown, "+").alias("segment"), X.without_parens(noted).alias("grp"))


@check("tier_columns", """
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS b, CAST(o_custkey + 1 AS VARCHAR) AS a, o_orderstatus AS s,
         CAST(o_custkey + 3 AS VARCHAR) AS ss, CAST(o_custkey + 4 AS VARCHAR) AS sss FROM orders""")
def tier_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    n = lambda i: (F.col("o_custkey") + i).cast("string")
    form = F.col("o_orderkey") % 4
    tail = F.when(form == 0, "").when(form == 1, "%").when(form == 2, "% [max]").otherwise(" - was 7")
    shown = F.concat_ws("/", n(0), n(1), "o_orderstatus", n(3), F.concat(n(4), tail))
    tiers = N.tier_values(shown)
    return orders.select("o_orderkey", *[tiers[c].alias(c.lower()) for c in ("B", "A", "S", "SS", "SSS")])


@check("stat_name", """
  SELECT p_partkey, CASE WHEN f = 0 THEN 'Mixed Stats' WHEN f = 1 THEN 'Main Stats' ELSE p_type || ' rate' END AS stat,
         CASE WHEN f = 2 THEN p_brand ELSE 'Common' END AS grp FROM (SELECT *, p_partkey % 4 AS f FROM part)""")
def stat_name(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    form = F.col("p_partkey") % 4
    shown = (
        F.when(form == 0, F.concat("p_type", F.lit(" and rate increase")))
        .when(form == 1, F.concat(F.lit("STR increase "), "p_name"))
        .when(form == 2, F.concat("p_type", F.lit(" rate% increase ("), "p_brand", F.lit(")")))
        .otherwise(F.concat("p_type", F.lit("é increase rate ")))
    )
    named = R.stat_and_group(shown)
    return parts.select("p_partkey", named["Stat"].alias("stat"), named["EquipGrp"].alias("grp"))


@check("list_split", "SELECT p_partkey, unnest([0, 1, 2]) AS pos, unnest([p_name, p_type, 'Sand ' || p_brand]) AS slot FROM part")
def list_split(spark, sf_dir):
    shown = F.concat("p_name", F.lit(", "), "p_type", F.lit(" and Sand "), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(X.split_list(shown)).alias("pos", "slot"))


@check("field_names", """
  SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'WATK' WHEN 1 THEN 'PercMaxHP' WHEN 2 THEN 'MaxMP' WHEN 3 THEN 'ClassType' ELSE 'Key' || replace(p_name, ' ', '') END AS key,
         CAST(p_size AS VARCHAR) AS value FROM part""")
def field_names(spark, sf_dir):
    from tablewright.rules import FIELD_NAMES

    form = F.col("p_partkey") % 5
    parts = table(spark, sf_dir, "part")
    kv = parts.select(
        "p_partkey",
        F.when(form == 0, "Weapon Attack\n").when(form == 1, "Max HP").when(form == 2, "Max MP").when(form == 3, "REQ Job")
        .otherwise(F.concat(F.lit("Key "), "p_name")).alias("key"),
        F.concat(F.lit("+"), F.col("p_size").cast("string"), F.when(form == 1, "%").otherwise("")).alias("value"),
    )
    return rename.name_fields(kv, FIELD_NAMES).select("p_partkey", "key", "value")


@check("field_procs", """
  SELECT p_partkey, p_type AS "EquipSlot", p_name AS "EquipName", CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS BIGINT) WHEN p_partkey % 3 = 1 THEN 0 ELSE -1 END AS "EquipLevel",
         p_brand || ';x' AS "Category" FROM part""")
def field_procs(spark, sf_dir):
    form = F.col("p_partkey") % 3
    raw = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("\n"), "p_type", F.lit("/Other\t")).alias("EquipSlot"),
        F.concat(F.lit("<"), "p_name", F.lit(",>\n")).alias("EquipName"),
        F.when(form == 0, F.concat(F.lit("Level "), F.col("p_size").cast("string"))).when(form == 1, "None").otherwise("?").alias("EquipLevel"),
        F.concat("p_brand", F.lit(",x\n")).alias("Category"),
    )
    return no_gaps(R.apply_processors(raw), "EquipLevel")


@check("inline_pct", """
  SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS BIGINT) ELSE -1 END AS pct FROM part""")
def inline_pct(spark, sf_dir):
    n, form = F.col("p_size").cast("string"), F.col("p_partkey") % 3
    shown = (
        F.when(form == 0, F.concat(F.lit("Ignore "), n, F.lit("% of 9 defenses, 7% more")))
        .when(form == 1, F.concat(F.lit("Increase "), n, F.lit("%")))
        .otherwise(F.concat(F.lit("Gain "), n))
    )
    return no_gaps(table(spark, sf_dir, "part").select("p_partkey", N.inline_percent(shown).cast("bigint").alias("pct")), "pct")


@check("heading_key", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN replace(p_name, ' ', '') ELSE p_type END AS key FROM part")
def heading_key(spark, sf_dir):
    shown = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.translate("p_name", " ", "_"), F.lit("_of_x"))).otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", R.section_key(shown).alias("key"))


@check("kv_parse", """
  SELECT p_partkey, unnest(['Perc Max HP', 'Defense', 'Jump Rate', 'All Skills']) AS key,
         unnest([CAST(p_size AS VARCHAR), CAST(p_partkey * 1000 AS VARCHAR), CAST(p_size + 1 AS VARCHAR), p_type]) AS value FROM part""")
def kv_parse(spark, sf_dir):
    size = F.col("p_size").cast("string")
    lines = F.array(
        F.concat(F.lit("Max HP: +"), size, F.lit("%\n")),
        F.concat(F.lit("Defense: +"), F.format_number(F.col("p_partkey") * 1000, 0), F.lit(" (base)")),
        F.concat(F.lit("Jump Rate "), (F.col("p_size") + 1).cast("string"), F.lit("%")),
        F.concat(F.lit("All Skills: "), "p_type"),
    )
    line = F.explode(lines).alias("line")
    rows = table(spark, sf_dir, "part").select("p_partkey", line)
    return rows.select("p_partkey", R.key_value(F.col("line")).alias("e")).select("p_partkey", "e.*")


@check("plus_parse", """
  SELECT p_partkey, unnest(['DEF', 'Knight MP', 'Sets HP']) AS key,
         unnest([CAST(p_size AS BIGINT), CAST(round(p_retailprice) AS BIGINT), CAST(p_size + 2 AS BIGINT)]) AS value FROM part""")
def plus_parse(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    lines = F.array(
        F.lit("DEF +1"),
        F.concat(F.lit("Knight's MP +"), F.round("p_retailprice").cast("bigint").cast("string"), F.lit(" %\n")),
        F.concat(F.lit("Sets' HP +"), (F.col("p_size") + 2).cast("string")),
        F.concat(F.lit("DEF +"), F.col("p_size").cast("string")),
        F.lit("no sign"),
    )
    stats = R.to_map(N.plus_entries(lines))
    return parts.select("p_partkey", F.explode(stats).alias("key", "value")).withColumn("value", F.col("value").cast("bigint"))
