"""Filters, renames, look-ups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright import rules as R
from tablewright.checks.registry import check, table
from tablewright.checks.render import el, single
from tablewright.operators import details, links as L, predicates as P, rename, reshape
from tablewright.operators import layout as Y
from tablewright.sources.markup import nodes

# Rules for the given tables, in the shape a rule pack has.
PART_MIN = {"SMALL": 5, "MEDIUM": 10, "LARGE": 20, "PROMO": 30, "ECONOMY": 0}
PART_WORDS = {"Copper Band": ["ring", "rod"], "Steel": ["gear", "bolt"], "Crimson": ["red", "ed"], "Old": ["cold", "old"]}


@check("row_keep", """
  SELECT p_partkey, p_name FROM part
  WHERE p_size >= CASE p_type WHEN 'SMALL' THEN 5 WHEN 'MEDIUM' THEN 10 WHEN 'LARGE' THEN 20 WHEN 'PROMO' THEN 30 ELSE 0 END
    AND p_partkey % 7 <> 0 AND NOT contains(p_name, 'anvil') AND NOT contains(p_name, 'hot')""")
def row_keep(spark, sf_dir):
    named = F.when(F.col("p_partkey") % 7 == 0, F.concat("p_name", F.lit("é"))).otherwise(F.col("p_name"))
    parts = P.with_minimum(table(spark, sf_dir, "part").withColumn("p_name", named), "p_type", PART_MIN)
    return parts.where(P.row_kept(F.col("p_name"), F.col("p_size"), F.col("MinimumLevel"), ["anvil", "hot"])).select("p_partkey", "p_name")


@check("key_skip", """
  SELECT o_orderkey, f IN (0, 1, 3) AS by_phrase, f IN (0, 1, 2, 3) AS by_word FROM (SELECT o_orderkey, o_orderkey % 6 AS f FROM orders)""")
def key_skip(spark, sf_dir):
    form = F.col("o_orderkey") % 6
    key = (
        F.when(form == 0, "Level").when(form == 1, "REQ STR").when(form == 2, "All Stats").when(form == 3, "Extra Stats")
        .when(form == 4, "REQ Job").otherwise(F.concat(F.lit("Key-"), "o_orderpriority"))
    )
    phrases = ["extra stats", "sold for"]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", P.key_skipped(key, phrases).alias("by_phrase"), P.key_skipped(key, phrases, by_word=True).alias("by_word")
    )


@check("name_allow", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'red|gear|plate') AND NOT regexp_matches(p_name, 'old|ring')")
def name_allow(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.where(P.name_allowed(F.col("p_name"), ["red", "gear", "plate"], ["old", "ring"])).select("p_partkey", "p_name")


@check("cond_update", """
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN o_totalprice > 250000 THEN 'big' END AS size FROM orders""")
def cond_update(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    marked = P.update_where(orders, F.col("o_orderstatus") == "F", "o_orderpriority", "done")
    return P.update_where(marked, F.col("o_totalprice") > 250000, "size", "big").select("o_orderkey", "o_orderpriority", "size")


@check("exclude_list", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'signup')")
def exclude_list(spark, sf_dir):
    return P.exclude(table(spark, sf_dir, "events"), F.col("event_type"), ["error", "signup"]).select("event_id", "event_type")


@check("list_detail_join", """
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_custkey % 5 = 0 THEN NULL ELSE c_name END AS "Name",
         CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS "Segment"
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey
  WHERE o_orderstatus = 'O' OR o_custkey % 5 = 0 OR (c_custkey IS NOT NULL AND c_nationkey <> 3)""")
def list_detail_join(spark, sf_dir):
    """Orders as list rows, customers as detail pages; customers of nation 3 have no page."""
    orders = table(spark, sf_dir, "orders")
    link = F.when(F.col("o_orderstatus") != "O", F.concat(F.lit("https://shop.example/item/"), F.col("o_custkey").cast("string"), F.lit("#x")))
    rows = orders.select("o_orderkey", "o_custkey", link.alias("link"))
    html = F.concat(
        F.lit("<table><tr><th>t</th></tr><tr><td>picture</td></tr>"),
        el("tr", "<th>Name</th>", el("td", F.col("c_name"))), el("tr", "<th>Segment</th>", el("td", F.col("c_mktsegment"))), F.lit("</table>"),
    )
    pages = single(table(spark, sf_dir, "customer").where("c_nationkey <> 3"), "c_custkey", html)
    wanted = details.linked_pages(pages, rows)
    facts = Y.infobox(Y.by_page(nodes(wanted, ("table", "th", "td"))))
    wide = reshape.pivot_wide(facts, ["page_id"], ["Name", "Segment"])
    with_url = wide.withColumn("url", F.concat(F.lit("https://shop.example/item/"), F.col("page_id").cast("string"))).drop("page_id")
    return details.join_details(rows, with_url, list_only=F.col("o_custkey") % 5 == 0).select("o_orderkey", "Name", "Segment")


@check("rename_exact", """
  SELECT event_id, CASE event_type WHEN 'click' THEN 'Tap' WHEN 'purchase' THEN 'Sale' WHEN 'view' THEN 'Look' ELSE event_type END AS event_type FROM events""")
def rename_exact(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return rename.rename_exact(events, "event_type", {"click": "Tap", "purchase": "Sale", "view": "Look"})


@check("rename_weapons", """
  WITH w AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Onehaxe' WHEN 1 THEN 'Ritualfan' WHEN 2 THEN 'Staff' ELSE 'Psylimiter' END AS weapon FROM part)
  SELECT p_partkey, CASE weapon WHEN 'Onehaxe' THEN 'One Handed Axe' WHEN 'Ritualfan' THEN 'Buchae' WHEN 'Psylimiter' THEN 'Psy Limiter' ELSE weapon END AS weapon FROM w""")
def rename_weapons(spark, sf_dir):
    form = F.col("p_partkey") % 4
    weapon = F.when(form == 0, "Onehaxe").when(form == 1, "Ritualfan").when(form == 2, "Staff").otherwise("Psylimiter")
    return rename.rename_exact(table(spark, sf_dir, "part").select("p_partkey", weapon.alias("weapon")), "weapon", R.MAIN_WEAPON_NAMES)


SUBSTRING_SQL = """
  SELECT p_partkey, CASE
    WHEN contains(p_name, 'ring') OR contains(p_name, 'rod') THEN replace(replace(p_name, 'ring', 'Copper Band'), 'rod', 'Copper Band')
    WHEN contains(p_name, 'gear') OR contains(p_name, 'bolt') THEN replace(replace(p_name, 'gear', 'Steel'), 'bolt', 'Steel')
    WHEN contains(p_name, 'ed') THEN replace(replace(p_name, 'red', 'Crimson'), 'ed', 'Crimson')
    WHEN contains(p_name, 'old') THEN replace(replace(p_name, 'cold', 'Old'), 'old', 'Old')
    ELSE upper(p_name[1]) || p_name[2:] END AS name FROM part"""


@check("rename_substring", SUBSTRING_SQL)
def rename_substring(spark, sf_dir):
    named = F.concat(F.upper(F.left("p_name", F.lit(1))), F.substr("p_name", F.lit(2)))
    return table(spark, sf_dir, "part").select("p_partkey", rename.rename_substring(named, PART_WORDS).alias("name"))


@check("rename_substring_joined", SUBSTRING_SQL)
def rename_substring_joined(spark, sf_dir):
    """The same renames by equality on substrings, as used for dictionaries too large to compile."""
    named = F.concat(F.upper(F.left("p_name", F.lit(1))), F.substr("p_name", F.lit(2)))
    parts = table(spark, sf_dir, "part").select("p_partkey", named.alias("name"))
    return rename.rename_by_substrings(parts, "name", PART_WORDS)


LONG_WORDS = {"Insult": ["worthless", "pathetic"], "Secret": ["token", "key ="], "Common": ["thble", "quele", "keit"], "Never": ["\u0000"]}


@check("rename_long_texts", """
  WITH t AS (SELECT doc_id, lower(text) AS l, text FROM documents)
  SELECT doc_id, md5(CASE WHEN contains(l, 'worthless') OR contains(l, 'pathetic') THEN replace(replace(l, 'worthless', 'Insult'), 'pathetic', 'Insult')
    WHEN contains(l, 'token') OR contains(l, 'key =') THEN replace(replace(l, 'token', 'Secret'), 'key =', 'Secret')
    WHEN contains(l, 'thble') OR contains(l, 'quele') OR contains(l, 'keit') THEN replace(replace(replace(l, 'thble', 'Common'), 'quele', 'Common'), 'keit', 'Common') ELSE text END) AS digest FROM t""")
def rename_long_texts(spark, sf_dir):
    """Whole documents as values: each distinct one is read once, whatever the dictionary holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rename.rename_by_substrings(docs, "text", LONG_WORDS).select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@check("rename_record", """
  SELECT p_partkey,
    CASE p_partkey % 3 WHEN 0 THEN 'Arcaneshade ' || n WHEN 1 THEN n ELSE 'Black ' || n END AS "EquipSet",
    CASE WHEN p_partkey % 3 = 0 THEN 'Breath Shooter ' || n WHEN p_partkey % 3 = 1 THEN p_name || ' ANVIL' ELSE 'Black ' || n END AS "EquipName"
  FROM (SELECT *, upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS n FROM part)""")
def rename_record(spark, sf_dir):
    form = F.col("p_partkey") % 3
    raw = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.when(form == 0, "Arcane Umbra Knight ").when(form == 1, "Set (").otherwise("Frozen Warrior "), "p_name", F.when(form == 1, ")").otherwise(" Set")).alias("EquipSet"),
        F.when(form == 0, F.concat(F.lit("Whispershot "), "p_name")).when(form == 1, F.concat("p_name", F.lit(" ANVIL"))).otherwise(F.concat(F.lit("Frozen "), "p_name")).alias("EquipName"),
        F.lit("Warrior").alias("ClassType"),
        F.lit("EquipWeapon").alias("Destination"),
    )
    return rename.rename_record(raw).select("p_partkey", "EquipSet", "EquipName")


@check("lookup_norm", """
  SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Tools' WHEN 'AUTOMOBILE' THEN 'Cars' WHEN 'FURNITURE' THEN 'Home' WHEN 'HOUSEHOLD' THEN 'Home' ELSE 'B UILDING' END AS segment
  FROM customer""")
def lookup_norm(spark, sf_dir):
    spaced = F.concat(F.left("c_mktsegment", F.lit(1)), F.lit(" "), F.substr("c_mktsegment", F.lit(2)))
    words = {"Tools": ["machinery"], "Cars": ["automobile"], "Home": ["furniture", "household"]}
    return rename.lookup_variant(table(spark, sf_dir, "customer").select("c_custkey", spaced.alias("segment")), "segment", words, normalise=True)


@check("route_category", """
  SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'EquipArmor' WHEN p_type = 'PROMO' THEN 'EquipAccessory'
    WHEN p_type = 'MEDIUM' THEN 'EquipSecondary' ELSE 'Equip' || p_type END AS "Destination" FROM part""")
def route_category(spark, sf_dir):
    slot = F.when(F.col("p_type") == "MEDIUM", "Shield").otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", rename.slot_category(slot, ["SMALL", "LARGE"], ["PROMO"]).alias("Destination"))
