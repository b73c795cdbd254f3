"""End-to-end jobs over pages and documents rendered from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.checks.registry import check, no_gaps, table
from tablewright.checks.render import chunked, el, heads, row_html, single
from tablewright.operators import rename, reshape
from tablewright.operators.links import extract
from tablewright.operators.sinks import compact
from tablewright.plans import classes, equipment, flames, hyper, potential, sets, stars
from tablewright.rules import RulePack
from tablewright.session import scratch, stage
from tablewright.specs import EQUIP, WEAPON
from tablewright.streaming import pages as stream

def key():
    return F.col("p_partkey")


def size():
    return F.col("p_size")


def n(c, plus: int = 0):
    return (F.col(c) + plus).cast("string") if isinstance(c, str) else (c + plus).cast("string")


def head(tag: str, ident: str, text="x"):
    return el(tag, f"<span class='mw-headline' id='{ident}'>", text, "</span>")


def star_pages(spark, sf_dir):
    """Per page: one limit, one rate and one boost table under either title."""
    parts = table(spark, sf_dir, "part")
    odd = F.floor(key() / 50) % 2 == 1
    title = F.when(odd, head("h3", "Superior_Items")).otherwise(head("h3", "Normal_Equip"))
    star = lambda i: F.concat(n("p_partkey", i), F.lit("★"))
    limit = F.concat(F.when(key() % 3 == 0, F.concat(n("p_size"), F.lit(" and above"))).otherwise(F.concat(n("p_size"), F.lit("~"), n("p_size", 9))))
    body_limit = row_html(limit, n("p_partkey", 1))
    body_rate = el("tr", el("td", star(0), " → ", star(1)), el("td", n("p_size"), "%"), el("td", F.when(key() % 2 == 0, "").otherwise("0.5%")), F.when(key() % 5 == 0, "").otherwise(el("td", n(100 - size()), "%")))
    ul = lambda *lines: el("ul", *[el("li", *x) for x in lines])
    bands = F.concat(
        F.lit("<table>"), el("tr", "<th>Level</th><th>Stats</th>"),
        el("tr", el("td", n("p_size"), "~", n("p_size", 9)), el("td", ul(("Visible DEF +", n("p_size"))))),
        el("tr", el("td", n("p_size", 10), "+"), el("td", ul(("Visible ATT +", n("p_size", 3)), ("Job Stat +", n("p_size", 4))))),
        F.lit("</table>"),
    )
    common = ul(("Visible DEF +1",), ("Job Stat +", n("p_size", 2)))
    boosted = F.when(odd, F.concat(bands, common)).otherwise(common)
    twice = F.when(key() % 4 == 0, F.concat(F.lit(", "), star(1), F.lit(" → "), star(2))).otherwise("")
    body_boost = el("tr", el("td", star(0), " → ", star(1), twice), el("td", boosted))
    parts = parts.select("p_partkey", body_limit.alias("l"), body_rate.alias("r"), body_boost.alias("b"), title.alias("t"))
    joined = lambda c: F.array_join(F.transform("rows", lambda x: x[c]), "")
    pages = parts.groupBy(F.floor(key() / 50).cast("bigint").alias("page_id")).agg(
        F.sort_array(F.collect_list(F.struct("p_partkey", "l", "r", "b"))).alias("rows"), F.first("t").alias("t")
    )
    html = F.concat(
        F.lit("<html><body><div><h2>Stars</h2><table><tr><td>early</td></tr></table>"), "t",
        head("h4", "Star_Limit"), F.lit("<p>Text</p><table>"), heads("Equip Level", "Max Stars"), joined("l"), F.lit("</table>"),
        head("h4", "Meso_Cost"), F.lit("<table>"), heads("Equip Level", "Max Stars"), F.lit("<tr><td>1~2</td><td>3</td></tr></table>"),
        head("h4", "Success_Rates_of"), F.lit("<table>"), heads("Attempt", "Chance (Success)", "Chance (Maintain)", "Chance (Destroy)"), joined("r"), F.lit("</table>"),
        head("h4", "Stats_Boost"), F.lit("<table>"), heads("Attempt", "Stats"), joined("b"), F.lit("</table>"),
        head("h5", "Total_Stats_x"), F.lit("<table>"), heads("Attempt", "Stats"), F.lit("<tr><td>1★ → 2★</td><td><ul><li>Job Stat +9</li></ul></td></tr></table></div></body></html>"),
    )
    return pages.select("page_id", F.lit("https://h.example/stars").alias("url"), html.alias("html"))


TITLE = "CASE WHEN (p_partkey // 50) % 2 = 1 THEN 'Superior_Items' ELSE 'Normal_Equips' END"


@check("star_limits", f"""
  SELECT {TITLE} AS "Title", CAST(p_size AS BIGINT) AS lo, CASE WHEN p_partkey % 3 = 0 THEN 300 ELSE CAST(p_size + 9 AS BIGINT) END AS hi, p_partkey + 1 AS stars FROM part""")
def star_limits(spark, sf_dir):
    found = stars.star_tables(star_pages(spark, sf_dir))["StarLimit"]
    return found.select("Title", F.col("MinLvl").cast("bigint").alias("lo"), F.col("MaxLvl").cast("bigint").alias("hi"), F.col("Max Stars").cast("bigint").alias("stars"))


@check("success_rates", f"""
  SELECT {TITLE} AS "Title", p_partkey AS "Attempt", CAST(p_size AS BIGINT) AS "Success", CAST(CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 5 END AS BIGINT) AS maintain_tenths,
         CAST(0 AS BIGINT) AS "Decrease", CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 100 - p_size END AS BIGINT) AS "Destroy" FROM part""")
def success_rates(spark, sf_dir):
    found = stars.star_tables(star_pages(spark, sf_dir))["SFSuccessRates"]
    whole = lambda c: F.col(c).cast("bigint").alias(c)
    return found.select("Title", whole("Attempt"), whole("Success"), F.round(F.col("Maintain") * 10).cast("bigint").alias("maintain_tenths"), whole("Decrease"), whole("Destroy"))


@check("stat_boosts", """
  WITH p AS (SELECT *, CAST(p_size AS BIGINT) AS s, unnest(CASE WHEN p_partkey % 4 = 0 THEN [p_partkey + 1, p_partkey + 2] ELSE [p_partkey + 1] END) AS id FROM part),
  r AS (SELECT 'Normal' AS kind, id, 0 AS lo, 300 AS hi, s + 2 AS job, CAST(-1 AS BIGINT) AS def, CAST(-1 AS BIGINT) AS att FROM p WHERE (p_partkey // 50) % 2 = 0
    UNION ALL SELECT 'Superior', id, s, s + 9, -1, s, 0 FROM p WHERE (p_partkey // 50) % 2 = 1
    UNION ALL SELECT 'Superior', id, s + 10, 300, -1, 1, s + 3 FROM p WHERE (p_partkey // 50) % 2 = 1)
  SELECT kind, id, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi, job, def, att FROM r""")
def stat_boosts(spark, sf_dir):
    found = stars.star_tables(star_pages(spark, sf_dir))
    big = lambda c, a: (F.col(c) if c else F.lit(None)).cast("bigint").alias(a)
    pick = lambda df, kind, job, de, att: df.select(F.lit(kind).alias("kind"), big("SFID", "id"), big("MinLvl", "lo"), big("MaxLvl", "hi"), big(job, "job"), big(de, "def"), big(att, "att"))
    both = pick(found["NormalEquipSF"], "Normal", "Job Stat", None, None).unionByName(
        pick(found["SuperiorItemsSF"], "Superior", None, "Visible DEF", "Visible ATT")
    )
    return no_gaps(both, "job", "def", "att")


@check("flame_tiers", """
  WITH p AS (SELECT p_partkey // 50 AS page_id, p_partkey, p_type, p_brand, CAST(p_size AS BIGINT) AS s, p_partkey % 5 AS f FROM part)
  SELECT p_brand || ' ' || CASE f WHEN 0 THEN p_type WHEN 1 THEN 'Weapons' WHEN 2 THEN 'Weapons' WHEN 3 THEN 'Common' ELSE p_type END AS grp,
    CASE f WHEN 1 THEN 'Normal' WHEN 2 THEN 'Special' ELSE 'Common' END AS kind,
    CASE f WHEN 0 THEN 'HP' WHEN 1 THEN 'Attack Power' WHEN 2 THEN 'Attack Power' WHEN 3 THEN 'Mixed Stats' ELSE 'Speed' END AS stat,
    CASE f WHEN 0 THEN s WHEN 4 THEN 0 ELSE s + 1 END AS lo, CASE f WHEN 0 THEN s + 9 ELSE 300 END AS hi, s AS t1, CASE WHEN f = 3 THEN -1 ELSE s * 1000 END AS t2 FROM p""")
def flame_tiers(spark, sf_dir):
    """One page per part, named by its brand, so that ordered dedupe has repeats to drop."""
    parts = table(spark, sf_dir, "part")
    form = key() % 5
    stat = (
        F.when(form == 0, F.concat(F.lit("HP increase ("), "p_type", F.lit(")")))
        .when(form.isin(1, 2), "Attack Power increase% (Weapons)")
        .when(form == 3, "STR and DEX increase")
        .otherwise("Special Bonus Stats")
    )
    note = F.when(form == 4, "<p>Not affected by level.</p>").when(form == 0, "<p>By level.</p>").otherwise(F.concat(F.lit("<p>For items of at least level "), n("p_size", 1), F.lit(".</p>")))
    listed = F.when(form == 0, el("td", n("p_size"), "-", n("p_size", 9))).otherwise("")
    header = F.when(form == 0, heads("Equip level", "Tier 1", "Tier 2")).otherwise(heads("Tier 1", "Tier 2"))
    second = F.when(form == 3, "").otherwise(el("td", F.format_number(size() * 1000, 0)))
    grid = F.concat(F.lit("<table>"), header, el("tr", listed, el("td", n("p_size"), "%"), second), F.lit("</table>"))
    repeat = "<p>Again</p><table><tr><th>Tier 1</th></tr><tr><td>99</td></tr></table>"
    dl = F.when(form == 1, "<dl><dt>Normal weapons</dt></dl>").when(form == 2, "<dl><dt>Other</dt></dl>").otherwise("")
    html = F.concat(
        F.lit("<div><h3><span class='mw-headline'>Early</span></h3><table><tr><th>Tier 1</th></tr><tr><td>1</td></tr></table>"), head("h2", "Stats"),
        el("h3", "<span class='mw-headline'>", stat, "</span>"),
        F.when(form == 4, el("h4", "<span class='mw-headline'>Speed increase (", F.col("p_type"), ")</span>")).otherwise(""),
        dl, note, grid, F.when(form.isin(0, 2), repeat).otherwise(""), F.lit("</div>"),
    )
    brand = parts.select("p_partkey", F.col("p_brand").alias("brand"))
    pages = single(parts, "p_partkey", html)
    found = flames.flame_tables(pages)
    big = lambda c, a: F.col(c).cast("bigint").alias(a)
    tiers = found.join(brand, found["page_id"] == brand["p_partkey"]).select(
        F.concat_ws(" ", "brand", "EquipGrp").alias("grp"), F.col("EquipType").alias("kind"), F.col("Stat").alias("stat"),
        big("MinLvl", "lo"), big("MaxLvl", "hi"), big("Tier 1", "t1"), big("Tier 2", "t2"),
    )
    return no_gaps(tiers, "t2")


def hyper_pages(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    comma = lambda c: F.format_number(c, 0)
    points = F.concat(F.lit("<table>"), heads("Total Points Awarded", "Level (1-300)", "Points Awarded"), row_html(comma(key() * 1000), "p_partkey", "p_size"), F.lit("</table>"))
    effect = lambda ident, *name: F.concat(
        el("h3", "<span class='mw-headline'>", *name, "</span>"), F.lit("<p>x</p><table>"),
        heads("Hyper Stat Level", "Overall Stat", "Effect Increase from previous level"),
        el("tr", el("td", n("p_partkey")), el("td", "STR +", n("p_size"), "%"), el("td", "+", n("p_size", 2))), F.lit("</table>"),
    )
    costs = F.concat(F.lit("<table>"), heads("Hyper Stat Next Level", "Level up Cost (points)", "Total Cost of all"), row_html("p_partkey", "p_size", comma(key() * 1000)), F.lit("</table>"))
    html = F.concat(
        F.lit("<div>"), head("h2", "Hyper_Stats_Points_Distribution"), el("div", points, points), F.lit("<div><table><tr><td>no</td></tr></table></div>"),
        head("h2", "Hyper_Stats"), costs, effect("a", F.col("p_type"), F.lit("% Increase")), effect("b", F.lit("Weapon and Magic "), F.col("p_name"), F.lit(" Increasé")), F.lit("</div>"),
    )
    return single(parts, "p_partkey", html)


@check("hyper_points", "SELECT p_partkey AS level, CAST(p_size AS BIGINT) AS points, p_partkey * 1000 AS total FROM part, range(2)")
def hyper_points(spark, sf_dir):
    found = hyper.hyper_tables(hyper_pages(spark, sf_dir))["HyperStatDistribution"]
    return found.select(F.col("Level").cast("bigint").alias("level"), F.col("Points Awarded").cast("bigint").alias("points"), F.col("Total Points Awarded").cast("bigint").alias("total"))


@check("hyper_effects", """
  SELECT unnest([p_type, p_name || ' Increas']) AS stat, p_partkey AS level, CAST(p_size AS BIGINT) AS overall, CAST(p_size + 2 AS BIGINT) AS step FROM part""")
def hyper_effects(spark, sf_dir):
    found = hyper.hyper_tables(hyper_pages(spark, sf_dir))["HyperStat"]
    big = lambda c, a: F.col(c).cast("bigint").alias(a)
    return found.select(F.col("StatIncrease").alias("stat"), big("Hyper Stat Level", "level"), big("Overall Effect", "overall"), big("Effect Increase from previous level", "step"))


@check("hyper_costs", "SELECT p_partkey AS level, CAST(p_size AS BIGINT) AS cost, p_partkey * 1000 AS total FROM part")
def hyper_costs(spark, sf_dir):
    found = hyper.hyper_tables(hyper_pages(spark, sf_dir))["HyperStatCost"]
    big = lambda c, a: F.col(c).cast("bigint").alias(a)
    return found.select(big("Hyper Stat Next Level", "level"), big("Level up Cost", "cost"), big("Total Cost", "total"))


def potential_pages(spark, sf_dir):
    """Per page one box of a grade with a block per shape."""
    parts = table(spark, sf_dir, "part")
    chances = F.concat(F.lit("<dl><dt>Chance</dt></dl><table>"), heads("Cube", "Chance"), el("tr", el("td", F.col("p_name")), el("td", n("p_size"), "%")), F.lit("</table>"))
    h5 = lambda *text: el("h5", "<span class='mw-headline'>", *text, "</span>")
    grid = lambda *rows: F.concat(F.lit("<table>"), heads("Level", "STR (flat)"), *rows, F.lit("</table>"))
    banded = grid(el("tr", el("td", n("p_size"), "-", n("p_size", 9)), el("td", "+", n("p_size", 1))), el("tr", el("td", n("p_size", 10), "+"), el("td", "+", n("p_size", 2), "%")))
    level = lambda: el("p", "Level requirement: ", n("p_size"), " or more")
    box = lambda cube, c: el("div", el("p", F.lit(cube)), el("p", "Chance: ", c, "%"), grid(el("tr", el("td", n("p_size"), "+"), el("td", "+", n("p_size", 5), " seconds"))))
    html = F.concat(
        F.lit("<div class='mw-parser-output'>"), F.when(key() % 2 == 0, "<h2>Potentials List</h2>").otherwise("<h2>Bonus Potentials</h2>"),
        el("h3", F.col("p_type"), F.lit(" and "), F.col("p_brand")), el("h4", "Epic (Prime)"), F.lit("<div class='wrap'><div class='mw-collapsible-content collapsible-content'>"),
        h5("A: Max HP"), banded, chances,
        h5("B: Ignore ", n("p_size"), "% of DEF"), level(), chances,
        h5("C: 5% chance to hide for 7 seconds"), level(), F.lit("<div>"), box("Red, Black cubes", n("p_size", 3)), box("Bonus cubes", n("p_size", 4)), F.lit("</div>"), chances,
        h5("D: hides for 7 seconds"), F.lit("<div>"), box("Any cubes", n("p_size")), F.lit("</div>"), chances,
        F.lit("</div></div></div>"),
    )
    return single(parts, "p_partkey", html)


@check("potential_values", """
  WITH p AS (SELECT p_partkey AS k, CAST(p_size AS BIGINT) AS s, unnest([p_type, p_brand]) AS slot, CASE WHEN p_partkey % 2 = 0 THEN 'Main' ELSE 'Bonus' END AS kind FROM part),
  r AS (
    SELECT kind, slot, 'D: hides for 7 seconds' AS stat, s AS lo, 300 AS hi, s AS chance, 'Flat' AS how, CAST(s + 5 AS VARCHAR) AS value, 'Any cubes' AS cube FROM p
    UNION ALL SELECT kind, slot, 'A: Max HP' AS stat, s AS lo, s + 9 AS hi, 0 AS chance, 'Flat' AS how, CAST(s + 1 AS VARCHAR) AS value, '0' AS cube FROM p
    UNION ALL SELECT kind, slot, 'A: Max HP', s + 10, 300, 0, 'Perc', CAST(s + 2 AS VARCHAR), '0' FROM p
    UNION ALL SELECT kind, slot, 'B: Ignore ' || s || '% of DEF', s, 300, 0, 'Perc', CAST(s AS VARCHAR), '0' FROM p
    UNION ALL SELECT kind, slot, 'C: 5% chance to hide for 7 seconds', s, 300, s + 3, 'Flat', '5', 'Red; Black cubes' FROM p
    UNION ALL SELECT kind, slot, 'C: 5% chance to hide for 7 seconds', s, 300, s + 4, 'Flat', '5', 'Bonus cubes' FROM p)
  SELECT DISTINCT kind, slot, stat, lo, CAST(hi AS BIGINT) AS hi, CAST(chance AS BIGINT) AS chance, how, value, cube FROM r""")
def potential_values(spark, sf_dir):
    found = potential.potential_tables(potential_pages(spark, sf_dir))
    both = found["PotentialData"].withColumn("kind", F.lit("Main")).unionByName(found["BonusData"].withColumn("kind", F.lit("Bonus")))
    big = lambda c, a: F.col(c).cast("bigint").alias(a)
    return both.select("kind", F.col("Slot").alias("slot"), F.col("DisplayStat").alias("stat"), big("MinLvl", "lo"), big("MaxLvl", "hi"), big("Chance", "chance"), F.col("StatT").alias("how"), F.col("Stat value").alias("value"), F.col("CubeType").alias("cube"))


@check("potential_rates", """
  WITH p AS (SELECT CAST(p_size AS BIGINT) AS s, p_name, unnest([p_type, p_brand]) AS slot, CASE WHEN p_partkey % 2 = 0 THEN 'Main' ELSE 'Bonus' END AS kind FROM part)
  SELECT DISTINCT * FROM (SELECT kind, slot, unnest(['A: Max HP', 'B: Ignore ' || s || '% of DEF', 'C: 5% chance to hide for 7 seconds', 'D: hides for 7 seconds']) AS stat, s AS chance, 'Cube' AS field, p_name AS value FROM p)""")
def potential_rates(spark, sf_dir):
    found = potential.potential_tables(potential_pages(spark, sf_dir))
    both = found["PotentialCubeRatesData"].withColumn("kind", F.lit("Main")).unionByName(found["BonusCubeRatesData"].withColumn("kind", F.lit("Bonus")))
    return both.select("kind", F.col("Slot").alias("slot"), F.col("DisplayStat").alias("stat"), F.col("Chance").cast("bigint").alias("chance"), F.col("Field").alias("field"), F.col("Value").alias("value"))


def class_documents(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    c = F.col("c_custkey")
    legion = F.when(c % 2 == 0, F.concat(F.lit("Grants flat "), "c_mktsegment")).otherwise(F.concat(F.lit("Increases "), "c_mktsegment", F.lit("%, more (max 5)")))
    content = F.struct(
        legion.alias("legion"),
        F.concat(n("c_nationkey"), F.lit("/20/30/40/"), n("c_nationkey", 5), F.when(c % 2 == 0, " [max]").otherwise("%")).alias("legionValue"),
        F.concat("c_mktsegment", F.lit(" (group)")).alias("classGroup"),
        F.when(c % 3 == 0, "Warrior + Pirate").otherwise("Thief").alias("jobGroup"),
        F.when(c % 5 == 0, "STR, DEX").otherwise("LUK").alias("mainStat"),
        F.when(c % 7 == 0, "DEX + STR").otherwise("INT").alias("secondaryStat"),
        F.array(
            F.struct(F.array(F.lit("oneHAxe"), F.lit("staff")).alias("weapon"), F.lit(None).cast("array<string>").alias("secondary")),
            F.struct(F.lit(None).cast("array<string>").alias("weapon"), F.array(F.when(c % 2 == 0, "magicbooki").otherwise("orb")).alias("secondary")),
        ).alias("equipment"),
    )
    post = F.struct(F.concat("c_name", F.lit(", ")).alias("class"), content.alias("content"))
    return customers.select("c_custkey", F.to_json(F.struct(F.struct(post.alias("post")).alias("pageProps"), F.lit(1).alias("other"))).alias("text"))


EFFECT = "CASE WHEN c_custkey % 2 = 0 THEN 'Grants flat ' || c_mktsegment ELSE 'Increases ' || c_mktsegment || ' more ' END"


@check("class_facts", f"""
  SELECT c_name AS "ClassName", c_mktsegment AS "Faction", CASE WHEN c_custkey % 3 = 0 THEN 'SPECIAL' ELSE 'Thief' END AS "ClassType",
         CASE WHEN c_custkey % 5 = 0 THEN 'SPECIAL' ELSE 'LUK' END AS "MainStat", CASE WHEN c_custkey % 7 = 0 THEN 'SPECIAL' ELSE 'INT' END AS "SecStat",
         {EFFECT} AS "UnionEffect", CASE WHEN c_custkey % 2 = 0 THEN 'Flat' ELSE 'Perc' END AS "UnionStatType" FROM customer""")
def class_facts(spark, sf_dir):
    return classes.class_tables(class_documents(spark, sf_dir))["CharacterData"]


@check("union_effects", f"""
  SELECT DISTINCT {EFFECT} AS "Effect", CASE WHEN c_custkey % 2 = 0 THEN 'Flat' ELSE 'Perc' END AS "EffectType", CAST(c_nationkey AS VARCHAR) AS "B",
         '20' AS "A", '30' AS "S", '40' AS "SS", CAST(c_nationkey + 5 AS VARCHAR) AS "SSS" FROM customer""")
def union_effects(spark, sf_dir):
    return classes.class_tables(class_documents(spark, sf_dir))["UnionEffect"]


@check("class_weapons", """
  SELECT c_name AS "ClassName", unnest(['One Handed Axe', 'Staff', CASE WHEN c_custkey % 2 = 0 THEN 'Magic Book' ELSE 'Orb' END]) AS name, unnest(['main', 'main', 'second']) AS hand FROM customer""")
def class_weapons(spark, sf_dir):
    found = classes.class_tables(class_documents(spark, sf_dir))
    main = found["ClassMainWeapon"].select("ClassName", F.col("Weapon").alias("name"), F.lit("main").alias("hand"))
    return main.unionByName(found["ClassSecWeapon"].select("ClassName", F.col("Secondary").alias("name"), F.lit("second").alias("hand")))


DATA = "https://shop.example/_data/"


def class_corpus(spark, sf_dir):
    """List pages of classes, every third of an excluded name, each page of a build of its own; documents but for multiples of 4."""
    customers = table(spark, sf_dir, "customer")
    word = RulePack().excluded_class_phrases[0].split(" ")[0]
    slug = F.concat(F.when(F.col("c_custkey") % 3 == 0, word + "-").otherwise("Class-"), n("c_custkey"))
    anchor = F.concat(F.lit("<div class='lazyload-wrapper'><a class='hvr-float' href='/classes/"), slug, F.lit("'>x</a><a href='/classes/Odd-"), n("c_custkey"), F.lit("'>y</a></div>"))
    build = F.concat(F.lit("""<html><body><script id="__NEXT_DATA__" type="application/json">{"props": 1, "buildId": "b"""), n("page_id"), F.lit("""\"}</script>"""))
    listing = chunked(customers, "c_custkey", anchor, build, "</body></html>")
    held = class_documents(spark, sf_dir).where("c_custkey % 4 <> 0")
    at = F.concat(F.lit(DATA + "b"), n(F.floor(F.col("c_custkey") / 50)), F.lit("/classes/Class-"), n("c_custkey"), F.lit(".json"))
    return listing.unionByName(held.select((F.col("c_custkey") + 1_000_000_000_000).cast("bigint").alias("page_id"), at.alias("url"), F.col("text").alias("html")))


@check("class_job", f"""
  SELECT c_name AS "ClassName", c_mktsegment AS "Faction", {EFFECT} AS "UnionEffect", CAST(NULL AS VARCHAR) AS missing FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 4 <> 0
  UNION ALL SELECT NULL, NULL, NULL, '{DATA}b' || c_custkey // 50 || '/classes/Class-' || c_custkey || '.json' FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 4 = 0""")
def class_job(spark, sf_dir):
    found = classes.class_jobs(class_corpus(spark, sf_dir), DATA, only=("CharacterData", "Missing"))
    facts = found["CharacterData"].select("ClassName", "Faction", "UnionEffect")
    return facts.unionByName(found["Missing"].select(F.col("url").alias("missing")), allowMissingColumns=True)


def equipment_corpus(spark, sf_dir):
    """List pages of rings with a tab box, and one detail page per part that is not a multiple of 4."""
    parts = table(spark, sf_dir, "part")
    name = F.concat("p_name", F.lit(" "), n("p_partkey"))
    picture = F.concat(F.lit("<a class='image' href='/pic'><img></a>\n"), name)
    linked = F.concat(F.lit("<a href='/item/"), n("p_partkey"), F.lit("'>"), name, F.lit("</a>"))
    row = el("tr", el("td", F.when(key() % 4 == 0, picture).otherwise(linked), "<br>\n"), el("td", "Level ", n("p_size"), "<br>STR: +", n("p_size", 1), "<br>Max HP: +5%"))
    listing = chunked(
        parts, "p_partkey", row,
        F.concat(F.lit("<div class='mw-parser-output'><div class='tabber wds-tabber'><ul class='wds-tabs'><li>Unobtainable</li><li>Shop, Boss</li></ul>"
                       "<div class='wds-tab__content'><table class='wikitable'><tr><th>Gone</th></tr><tr><td>Old thing<br>Level 200</td></tr></table></div>"
                       "<div class='wds-tab__content'><table class='wikitable'>"), heads("Item", "Stats")),
        "</table></div></div></div>",
    )
    fact = lambda name, *value: el("tr", el("th", name), el("td", *value))
    detail = F.concat(
        F.lit("<div class='mw-parser-output'><table><tr><th>"), F.col("p_name"), F.lit("</th></tr><tr><td>picture</td></tr>"),
        fact("REQ Level", n("p_size")), fact("REQ Job", "Warrior"), fact("Weapon Attack", "+", n("p_size", 2)), fact("Equipment Set", F.lit("Arcane Umbra Knight Set (x)")),
        fact("Max HP", "+", n("p_size", 3), "%"), fact("Notes", "none"), F.lit("</table></div>"),
    )
    details = single(parts.where("p_partkey % 4 <> 0"), "p_partkey", detail)
    details = details.withColumn("page_id", F.col("page_id") + 1_000_000_000)
    return equipment.slot_pages(listing, F.lit("Ring")), listing.unionByName(details)


KNOWN = ["EquipSet", "ClassType", "STR", "MaxHP", "PercMaxHP", "WATK"]


@check("equipment_records", """
  SELECT 'Ring' AS "EquipSlot", p_name || ' ' || p_partkey AS "EquipName", CAST(p_size AS BIGINT) AS "EquipLevel", 'Shop; Boss' AS "Category", 'EquipAccessory' AS "Destination",
    CASE WHEN p_partkey % 4 = 0 THEN 'None' ELSE 'Arcaneshade X' END AS "EquipSet", CASE WHEN p_partkey % 4 = 0 THEN 'Any' ELSE 'Warrior' END AS "ClassType",
    CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size + 1 AS VARCHAR) END AS "STR", CAST(NULL AS VARCHAR) AS "MaxHP",
    CASE WHEN p_partkey % 4 = 0 THEN '5' ELSE CAST(p_size + 3 AS VARCHAR) END AS "PercMaxHP", CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size + 2 AS VARCHAR) END AS "WATK"
  FROM part WHERE p_size >= 30""")
def equipment_records(spark, sf_dir):
    lists, pages = equipment_corpus(spark, sf_dir)
    return equipment.equipment_records(lists, pages, KNOWN).drop("Other")


@check("equipment_counts", """
  SELECT 'EquipAccessory' AS "Destination", CAST(count(*) AS BIGINT) AS candidates, CAST(count(*) FILTER (WHERE p_size < 30) AS BIGINT) AS skipped,
         CAST(count(*) FILTER (WHERE p_size >= 30) AS BIGINT) AS recorded FROM part""")
def equipment_counts(spark, sf_dir):
    """Counted from the rows that the records are made of."""
    return equipment.records_and_counts(*equipment_corpus(spark, sf_dir), KNOWN)[1]


@check("slot_index", """
  SELECT CASE p_partkey % 3 WHEN 0 THEN 'Pocket' WHEN 1 THEN p_type ELSE 'Heart' END AS "EquipSlot", 'https://shop.example/wiki/' || p_partkey AS link
  FROM part WHERE p_partkey % 5 <> 0""")
def slot_index(spark, sf_dir):
    title = F.when(key() % 5 == 0, "Totem").when(key() % 3 == 0, "Pocket Item").when(key() % 3 == 1, F.col("p_type")).otherwise("Android Heart")
    html = F.concat(F.lit("<table><tr><td><a title='"), title, F.lit("' href='/wiki/"), n("p_partkey"), F.lit("'>x</a><a href='/no'>untitled</a></td></tr></table>"))
    return equipment.slot_index(extract(single(table(spark, sf_dir, "part"), "p_partkey", html)))


@check("type_index", """
  SELECT CASE WHEN f = 0 THEN 'Gun' WHEN f = 1 THEN 'Whistle' ELSE p_name || p_partkey END AS "WeaponType", hand, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT *, p_partkey % 5 AS f, unnest(['first', 'second']) AS hand FROM part)
  WHERE NOT (f = 0 AND hand = 'first') AND NOT (f = 1 AND hand = 'second') GROUP BY 1, 2""")
def type_index(spark, sf_dir):
    name = F.when(key() % 5 == 0, "Gun").when(key() % 5 == 1, "Whistle_(old)").otherwise(F.concat(F.translate("p_name", " ", "_"), n("p_partkey")))
    html = F.concat(F.lit("<a href='/wiki/"), name, F.lit("'>x</a><a href='plain'>y</a>"))
    found = extract(single(table(spark, sf_dir, "part"), "p_partkey", html))
    first, second = equipment.type_index(found), equipment.type_index(found, second=True)
    both = first.withColumn("hand", F.lit("first")).unionByName(second.withColumn("hand", F.lit("second")))
    return both.groupBy("WeaponType", "hand").agg(F.count("*").alias("n"))


@check("slot_corpus", """
  SELECT 'https://shop.example/order/' || o_orderkey AS url, o_orderpriority AS slot FROM orders
  UNION ALL SELECT 'https://shop.example/customer/' || c_custkey, min(o_orderpriority) FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def slot_corpus(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    linked = F.concat(F.lit("<a title='"), F.col("o_orderpriority"), F.lit("/more' href='/customer/"), n("o_custkey"), F.lit("#list'>x</a><a title='Other/x' href='/order/0'>y</a>"))
    pages = single(orders, "o_orderkey", linked, "order").unionByName(single(customers, "c_custkey", F.lit("<p>end</p>"), "customer"))
    index = orders.select(F.col("o_orderpriority").alias("EquipSlot"), F.concat(F.lit("https://shop.example/order/"), n("o_orderkey")).alias("link"))
    return equipment.slot_corpus(index, pages).select("url", "slot")


@check("weapon_links", """
  SELECT p_partkey AS page_id, CASE WHEN p_partkey % 3 = 0 THEN 'Fafnir ' || p_name ELSE 'Genesis ' || p_type END AS "EquipName",
         CASE WHEN p_partkey % 3 = 0 THEN 'Fafnir' ELSE 'Genesis' END AS "EquipSet" FROM part WHERE p_partkey % 3 < 2""")
def weapon_links(spark, sf_dir):
    slug = F.when(key() % 3 == 0, F.concat(F.lit("Fafnir_"), F.translate("p_name", " ", "-"))).when(key() % 3 == 1, F.concat(F.lit("Genesis_"), "p_type")).otherwise("Sealed_Genesis_x")
    html = F.concat(F.lit("<b><a href='/wiki/"), slug, F.lit("'>x</a></b><a href='/wiki/Plain_"), "p_brand", F.lit("'>y</a>"))
    return equipment.weapon_links(extract(single(table(spark, sf_dir, "part"), "p_partkey", html))).select("page_id", "EquipName", "EquipSet")


@check("secondary_rows", """
  SELECT p_partkey AS page_id, 'Orb' AS "WeaponType", unnest([p_type, p_brand]) AS "ClassName", unnest([p_name, 'Other']) AS "EquipName", 'Effects' AS header,
         unnest(['STR: +' || p_size || '|DEX: +1', 'INT: +2']) AS lines FROM part""")
def secondary_rows(spark, sf_dir):
    grid = lambda name, lines: F.concat(F.lit("<table class='wikitable'>"), heads("Picture", "Effects"), el("tr", el("td", name), el("td", lines)), F.lit("</table>"))
    html = F.concat(
        F.lit("<div class='mw-parser-output'><p>An orb is exclusive to <a href='/a'>"), F.col("p_type"), F.lit("</a>, <a href='/b'>"), F.col("p_brand"), F.lit("</a>.</p>"),
        grid(F.concat("p_name", F.lit(",")), F.concat(F.lit("STR: +"), n("p_size"), F.lit("<br>DEX: +1"))), grid(F.lit("Other"), F.lit("INT: +2")), F.lit("</div>"),
    )
    found = equipment.secondary_rows(single(table(spark, sf_dir, "part"), "p_partkey", html), F.lit("Orb"))
    return found.withColumn("lines", F.array_join("lines", "|"))


@check("set_effects", """
  WITH p AS (SELECT p_partkey, CAST(p_size AS VARCHAR) AS s, p_name, p_type FROM part), r AS (
    SELECT p_name || p_partkey AS "EquipSet", p_type AS "ClassType", '2' AS "SetAt", 'EquipSetEffectAt' AS "Destination", s AS "STR", '7' AS "PercMaxHP", NULL AS "WATK" FROM p
    UNION ALL SELECT p_name || p_partkey, p_type, '2', 'EquipSetEffectCul', '1' || s, NULL, NULL FROM p
    UNION ALL SELECT p_name || p_partkey, p_type, '3', 'EquipSetEffectAt', NULL, NULL, '1' || s FROM p
    UNION ALL SELECT p_name || p_partkey, p_type, '3', 'EquipSetEffectCul', NULL, NULL, NULL FROM p)
  SELECT * FROM r""")
def set_effects(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    html = F.concat(
        F.lit("<div class='mw-parser-output'><table class='wikitable'>"), heads("Set Effects", "Cumulative Effects"),
        el("tr", el("td", "<b>2 Set Items</b><br>STR: +", n("p_size"), "<br>Max HP: +7%"), el("td", "<b>2 Items</b><br>STR: +1", n("p_size"))),
        el("tr", el("td", "<b>3 Set Items</b><br>Weapon Attack: 1", n("p_size"), " (all)"), el("td", "<b>3 Set Items</b>")),
        F.lit("<tr><td>no threshold</td><td>STR: +9</td></tr></table><table class='wikitable'><tr><th>Set</th></tr><tr><td><b>9 x</b>STR: +9</td></tr></table></div>"),
    )
    pages = single(parts, "p_partkey", html).join(
        parts.select(F.col("p_partkey").alias("page_id"), F.concat("p_name", F.col("p_partkey").cast("string")).alias("EquipSet"), F.col("p_type").alias("ClassType")), "page_id"
    )
    return sets.set_effects(pages, ["STR", "PercMaxHP", "WATK"]).drop("Other")


@check("tracked_sets", """
  SELECT p_partkey AS page_id, CASE p_partkey % 4 WHEN 0 THEN 'Root Abyss' ELSE 'Eternal ' || p_type END AS "EquipSet" FROM part WHERE p_partkey % 4 < 2""")
def tracked_sets(spark, sf_dir):
    slug = F.when(key() % 4 == 0, F.concat(F.lit("Root_Abyss_Set_"), "p_brand", F.lit("_(old)"))).when(key() % 4 == 1, F.concat(F.lit("Eternal_"), "p_type", F.lit("_Set"))).when(
        key() % 4 == 2, "Eternal_Hero_Set").otherwise(F.concat(F.lit("Plain_"), "p_type"))
    parts = table(spark, sf_dir, "part")
    pages = single(parts, "p_partkey", F.concat(F.lit("<table class='wikitable'><tr><td><a href='/wiki/"), F.regexp_replace(slug, "#", "~"), F.lit("'>x</a></td></tr></table>")))
    links = extract(pages).join(parts.select(F.col("p_partkey").alias("page_id"), F.translate("p_brand", "#", "~").alias("ClassType")), "page_id")
    return sets.tracked_sets(links).select("page_id", "EquipSet")


@check("set_index", """
  SELECT p_partkey AS page_id, unnest(['Any', p_type]) AS "ClassType", unnest(['Root Abyss', 'Eternal']) AS "EquipSet",
         unnest(['https://shop.example/wiki/Root_Abyss_Set', 'https://shop.example/wiki/Eternal_Set_' || p_type || '_(x)']) AS link FROM part""")
def set_index(spark, sf_dir):
    grid = lambda *links: el("div", el("table", *[el("tr", el("td", x)) for x in links], attrs="class='wikitable'"), attrs="class='wds-tab__content'")
    a = lambda href, inner="x": F.concat(F.lit("<a href='/wiki/"), href, F.lit(f"'>{inner}</a>"))
    tabs = F.concat(F.lit("<ul><li class='wds-tabs__tab'>Common</li><li class='wds-tabs__tab'>"), F.col("p_type"), F.lit("</li></ul>"))
    html = F.concat(
        F.lit("<div><div class='tabber wds-tabber'><ul><li class='wds-tabs__tab'>Early</li></ul>"), grid(a(F.lit("Mystic_Set"))), F.lit("</div>"),
        head("h2", "Equipment_Set"), F.lit("<div class='tabber wds-tabber'>"), tabs,
        grid(a(F.lit("Root_Abyss_Set"), "<img src='i'>"), a(F.lit("Root_Abyss_Set")), a(F.lit("Plain_Set"))),
        grid(a(F.concat(F.lit("Eternal_Set_"), F.col("p_type"), F.lit("_(x)"))), a(F.lit("Eternal_Hero_Set"))),
        F.lit("</div><div class='tabber wds-tabber'>"), grid(a(F.lit("Mystic_Set"))), F.lit("</div></div>"),
    )
    return sets.set_index(single(table(spark, sf_dir, "part"), "p_partkey", html))


@check("potential_pairs", """
  SELECT p_partkey AS slot, 'value' AS kind, CAST(unnest([p_size, p_size + 10]) AS BIGINT) AS lo, CAST(unnest([p_size + 1, p_size + 2]) AS VARCHAR) AS value FROM part
  UNION ALL SELECT p_partkey, 'chance', CAST(unnest([p_size, p_size + 1]) AS BIGINT), unnest([p_name, p_type]) FROM part""")
def potential_pairs(spark, sf_dir):
    """A heading with value, chance, value, chance: either value table counts."""
    values = lambda low, plus: F.concat(F.lit("<table>"), heads("Level", "Value"), row_html(F.concat(n("p_size", low), F.lit("-"), n("p_size", low + 9)), F.concat(F.lit("+"), n("p_size", plus))), F.lit("</table>"))
    chances = lambda name, plus: F.concat(F.lit("<dl><dt>Chance</dt></dl><table>"), heads("Cube", "Chance"), row_html(name, F.concat(n("p_size", plus), F.lit("%"))), F.lit("</table>"))
    html = F.concat(
        head("h2", "Potential", "Main"), head("h3", "s", n("p_partkey")), head("h4", "g", "Rare"), F.lit("<div class='collapsible-content'>"),
        head("h5", "x", "Max HP"), values(0, 1), chances(F.col("p_name"), 0), values(10, 2), chances(F.col("p_type"), 1), F.lit("</div>"),
    )
    found = potential.potential_tables(single(table(spark, sf_dir, "part"), "p_partkey", html))
    slot = F.col("Slot").cast("bigint").alias("slot")
    got = found["PotentialData"].select(slot, F.lit("value").alias("kind"), F.col("MinLvl").cast("bigint").alias("lo"), F.col("Stat value").alias("value"))
    return got.unionByName(found["PotentialCubeRatesData"].select(slot, F.lit("chance").alias("kind"), F.col("Chance").cast("bigint").alias("lo"), F.col("Value").alias("value")))


def weapon_corpus(spark, sf_dir):
    """One index page per part that links to the detail page of its weapon."""
    parts = table(spark, sf_dir, "part")
    fact = lambda name, *value: el("tr", el("th", name), el("td", *value))
    index = single(parts, "p_partkey", F.concat(F.lit("<a href='/weapon/"), n("p_partkey"), F.lit("/Fafnir_"), n("p_partkey"), F.lit("'>x</a><a href='/weapon/Plain_x'>y</a>")), "index")
    detail = F.concat(
        F.lit("<div class='mw-parser-output'><table><tr><th>"), F.col("p_name"), F.lit("</th></tr><tr><td>picture</td></tr>"),
        fact("Weapon Attack", "+", n("p_size", 2)), fact("Attack Speed", "Fast (", n("p_size"), ")"), fact("Odd ", F.col("p_size").cast("string")),
        fact("Equipment Set", F.concat(F.lit("Root "), "p_brand")), F.lit("</table></div>"),
    )
    details = parts.select(
        (key() + 1_000_000_000).alias("page_id"), F.concat(F.lit("https://shop.example/weapon/"), n("p_partkey"), F.lit("/Fafnir_"), n("p_partkey")).alias("url"), detail.alias("html")
    )
    return index, details


@check("weapon_records", """
  SELECT 'Weapon' AS "EquipSlot", 'Fafnir ' || p_partkey AS "EquipName", 'Fafnir' AS "EquipSet", 'Sword' AS "WeaponType", 'EquipWeapon' AS "Destination",
         CAST(p_size + 2 AS VARCHAR) AS "WATK", unnest(['Odd', 'EquipSet', 'AtkSpd']) AS other_key,
         unnest([CAST(p_size AS VARCHAR), 'Root ' || p_brand, 'Fast (' || p_size || ')']) AS other_value FROM part""")
def weapon_records(spark, sf_dir):
    index, details = weapon_corpus(spark, sf_dir)
    found = equipment.weapon_records(extract(index).withColumn("WeaponType", F.lit("Sword")), details, ["WATK", "AttackSpeed", "ATKSpeed"], other="more")
    return found.select("EquipSlot", "EquipName", "EquipSet", "WeaponType", "Destination", "WATK", F.explode("more").alias("other_key", "other_value"))


def secondary_pages(spark, sf_dir):
    grid = lambda name, *rows: F.concat(F.lit("<table class='wikitable'>"), heads("Picture", "Requirements", "Effects", "Note"), el("tr", *[el("td", x) for x in (name, *rows)]),
                                        F.lit("<tr><td>Other equipment</td><td>-</td><td>STR: +99</td><td>-</td></tr><tr><td>After</td><td>-</td><td>STR: +98</td><td>-</td></tr></table>"))
    html = F.concat(
        F.lit("<div class='mw-parser-output'><p>An orb is exclusive to <a href='/a'>"), F.col("p_type"), F.lit("</a>.</p>"),
        grid(F.concat("p_name", F.lit(",")), F.concat(F.lit("Level: "), n("p_size")), F.concat(F.lit("STR: +"), n("p_size", 1), F.lit("<br>Max HP: +"), n("p_size", 2), F.lit("%")), F.col("p_brand")), F.lit("</div>"),
    )
    return single(table(spark, sf_dir, "part"), "p_partkey", html)


@check("secondary_records", """
  SELECT 'Secondary' AS "EquipSlot", p_type AS "ClassName", p_name AS "EquipName", 'Orb' AS "WeaponType", 'EquipSecondary' AS "Destination",
         CAST(p_size + 1 AS VARCHAR) AS "STR", CAST(p_size + 2 AS VARCHAR) AS "PercMaxHP", p_brand AS note FROM part""")
def secondary_records(spark, sf_dir):
    found = equipment.secondary_records(secondary_pages(spark, sf_dir), F.lit("Orb"), ["STR", "PercMaxHP", "Note"])
    return found.select("EquipSlot", "ClassName", "EquipName", "WeaponType", "Destination", "STR", "PercMaxHP", F.col("Note").alias("note"))


STORE_SQL = """
  SELECT 'EquipAccessory' AS place, p_name || ' ' || p_partkey AS name, CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size + 1 AS BIGINT) ELSE -1 END AS str,
         CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size + 2 AS BIGINT) ELSE -1 END AS watk FROM part WHERE p_size >= 30
  UNION ALL SELECT 'EquipWeapon', 'Fafnir ' || p_partkey, -1, CAST(p_size + 2 AS BIGINT) FROM part"""


@check("equipment_store", STORE_SQL)
def equipment_store(spark, sf_dir):
    """List and weapon records, typed and upserted into the table of their destination; a second run changes nothing."""
    lists, pages = equipment_corpus(spark, sf_dir)
    index, details = weapon_corpus(spark, sf_dir)
    stats = ["STR", "PercMaxHP", "WATK"]
    records = reshape.union_by_name([
        equipment.equipment_records(lists, pages, stats, order="at").withColumn("at", F.to_json("at")),
        equipment.weapon_records(extract(index).withColumn("WeaponType", F.lit("Sword")), details, stats, order="at").withColumn("at", F.to_json("at")),
    ])
    root, tables = scratch(spark, "store"), {"EquipAccessory": EQUIP, "EquipWeapon": WEAPON}
    records = stage(records, "found")
    equipment.store_records(records, root, tables, "at", stats)
    held = equipment.store_records(records, root, tables, "at", stats)
    shown = [df.select(F.lit(name).alias("place"), F.col("EquipName").alias("name"), F.col("STR").cast("bigint").alias("str"), F.col("WATK").alias("watk")) for name, df in held.items()]
    return no_gaps(reshape.union_by_name(shown), "str", "watk")


@check("stream_store", STORE_SQL)
def stream_store(spark, sf_dir):
    """List pages as they arrive into the same tables, weapons as a batch; a batch runs twice, and the tables are compacted."""
    lists, pages = equipment_corpus(spark, sf_dir)
    index, details = weapon_corpus(spark, sf_dir)
    folder, root, out = (scratch(spark, label) for label in ("list-pages", "stream-store", "stream-out"))
    lists.select("page_id", "url", "html").repartition(2, "page_id").write.parquet(folder)
    pages, stats, tables = stage(pages, "detail-pages"), ["STR", "PercMaxHP", "WATK"], {"EquipAccessory": EQUIP, "EquipWeapon": WEAPON}

    def store(rows, batch):
        found = equipment.equipment_records(equipment.slot_pages(rows, F.lit("Ring")), pages, stats, order="at").withColumn("at", F.to_json("at"))
        equipment.store_records(found, root, {"EquipAccessory": EQUIP}, "at", stats, batch=batch)

    stream.stream_store(stream.read_pages(spark, folder, glob="*.parquet", files_per_batch=1), store, out)
    # The first batch again, as after a lost driver: it is in the table already.
    store(spark.read.schema(stream.PAGES).parquet(folder).limit(1), ("pages", 0))
    weapons = equipment.weapon_records(extract(index).withColumn("WeaponType", F.lit("Sword")), details, stats, order="at").withColumn("at", F.to_json("at"))
    equipment.store_records(weapons, root, {"EquipWeapon": WEAPON}, "at", stats)
    held = {name: compact(spark, spec.named(name), root) for name, spec in tables.items()}
    shown = [df.select(F.lit(name).alias("place"), F.col("EquipName").alias("name"), F.col("STR").cast("bigint").alias("str"), F.col("WATK").cast("bigint").alias("watk")) for name, df in held.items()]
    return no_gaps(reshape.union_by_name(shown), "str", "watk")


@check("stream_equipment", """
  SELECT p_name || ' ' || p_partkey AS name, CAST(p_size AS BIGINT) AS level, CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size + 1 AS VARCHAR) ELSE '' END AS str FROM part WHERE p_size >= 30""")
def stream_equipment(spark, sf_dir):
    """List pages as they arrive, each batch through the same job as in batch, newest record per key."""
    lists, pages = equipment_corpus(spark, sf_dir)
    folder = scratch(spark, "list-pages")
    lists.select("page_id", "url", "html").repartition(2, "page_id").write.parquet(folder)
    details = stage(pages, "detail-pages")
    keys = ["EquipSlot", "EquipName", "EquipSet", "ClassType"]
    step = lambda df: equipment.equipment_records(equipment.slot_pages(df, F.lit("Ring")), details, ["EquipSet", "ClassType", "STR", "WATK"], order="at")
    found = stream.stream_records(stream.read_pages(spark, folder, glob="*.parquet", files_per_batch=1), step, keys, scratch(spark, "stream-equipment"), "at")
    return found.select(F.col("EquipName").alias("name"), F.col("EquipLevel").alias("level"), F.coalesce("STR", F.lit("")).alias("str"))


@check("rule_pack", """
  SELECT 'Round ' || p_brand AS slot, CASE WHEN p_partkey % 2 = 0 THEN 'My Set' ELSE p_name END AS name, CASE WHEN p_partkey % 2 = 0 THEN 'EquipArmor' ELSE 'EquipRound ' || p_brand END AS place FROM part""")
def rule_pack(spark, sf_dir):
    """Another pack of rules: its names, sets and slots count, not those that come with the library."""
    rules = RulePack(set_names={"My Set": ["@mine"]}, slot_names={}, armor_slots=["Even"], accessory_slots=[], class_types={}, category_names={})
    slot = F.concat(F.lit("Round "), "p_brand")
    rows = table(spark, sf_dir, "part").select(
        slot.alias("slot"), F.when(key() % 2 == 0, "@mine").otherwise(F.col("p_name")).alias("EquipName"),
        rename.slot_category(F.when(key() % 2 == 0, "Even").otherwise(slot), rules.armor_slots, rules.accessory_slots).alias("Destination"),
    )
    return rename.rename_record(rows, rules).select("slot", F.col("EquipName").alias("name"), F.col("Destination").alias("place"))
