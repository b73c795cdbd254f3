"""Whole jobs on small pages written by hand."""

import json

import pytest
from pyspark.sql import functions as F

from tablewright.plans import classes, equipment, flames, hyper, potential, sets, stars
from tablewright.operators.sinks import save
from tablewright.session import scratch
from tablewright.sources.page_store import write_store
from tablewright.specs import EQUIP


def page(spark, html, url="https://h.example/p", page_id=1):
    return spark.createDataFrame([(page_id, url, html)], "page_id long, url string, html string")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


VALUE = "<table><tr><th>Level</th><th>Stat</th></tr><tr><td>10-19</td><td>+1%</td></tr></table>"
RATE = "<table><tr><th>Cube</th><th>Chance</th></tr><tr><td>Red</td><td>4%</td></tr></table>"
LEVEL = "<p>Level requirement: 30 or more</p>"
BOXES = "<div><div><p>Red, Black cubes</p><p>Chance: 9%</p>" + VALUE + "</div></div>"
PARTS = {"table": VALUE, "p": LEVEL, "dl": "<dl><dd>x</dd></dl>", "div": BOXES}


@pytest.mark.parametrize(
    "shape, want",
    [
        ("table dl table", [(10, 19, 5, "1", "0")]),
        ("p dl table", [(30, 300, 5, "5", "0")]),
        ("p table dl table", [(10, 19, 5, "5", "0")]),
        ("p p dl table", [(30, 300, 5, "5", "0")]),
        ("p p p dl table", [(30, 300, 5, "5", "0")]),
        ("p p table dl table", [(10, 19, 5, "5", "0")]),
        ("p div div dl table", [(10, 19, 9, "5", "Red; Black cubes")]),
        ("p dl p dl p table dl table", [(10, 19, 5, "5", "0")]),
    ],
)
def test_block_shapes(spark, shape, want):
    """The sequences of elements that follow a stat heading."""
    tags = shape.split()
    body = "".join(PARTS[t] for t in tags[:-1]) + RATE
    html = (
        "<div><h2><span class='mw-headline'>Potentials</span></h2><h3>Hat and Top</h3><h4>Rare (Prime)</h4>"
        f"<div><div class='collapsible-content'><h5><span class='mw-headline'>5% chance to hide</span></h5>{body}</div></div></div>"
    )
    found = potential.potential_tables(page(spark, html))
    values = found["PotentialData"]
    assert rows(values.where("Slot = 'Hat'"), "MinLvl", "MaxLvl", "Chance", "Stat value", "CubeType") == want
    assert {r.Slot for r in values.collect()} == {"Hat", "Top"}
    assert {tuple(r) for r in values.select("Grade", "Prime", "DisplayStat").collect()} == {("Rare", "Prime", "5% chance to hide")}
    rates = found["PotentialCubeRatesData"]
    assert rows(rates, "Slot", "Chance", "Field", "Value") == [("Hat", 4.0, "Cube", "Red"), ("Top", 4.0, "Cube", "Red")]
    assert found["BonusData"].isEmpty() and found["BonusCubeRatesData"].isEmpty()


def test_star_tables(spark):
    head = lambda t, i: f"<{t}><span class='mw-headline' id='{i}'>x</span></{t}>"
    html = (
        "<div>" + head("h3", "Normal_Equip") + head("h4", "Star_Limit") +
        "<table><tr><th>Level Range</th><th>Max Stars</th></tr><tr><td>95~107\n</td><td>8\n</td></tr><tr><td>138 and above</td><td>25</td></tr></table>" +
        head("h4", "Success_Rates") +
        "<table><tr><th>Attempt</th><th>Chance (Success)</th><th>Chance (Maintain)</th><th>Chance (Decrease)</th><th>Chance (Destroy)</th></tr>"
        "<tr><td>12★ → 13★</td><td>40%</td><td></td><td>59.4%</td><td>0.6%</td></tr></table>" +
        head("h4", "Stats_Boost") +
        "<table><tbody><tr><th>Attempt</th><th>Stats</th></tr><tr><td>0★ → 1★, 1★ → 2★</td><td><ul><li>Job Stat +2</li><li>Weapon's Max MP +5</li></ul></td></tr>"
        "<tr><td>15★ → 16★</td><td><table><tr><td>128~137</td><td><ul><li>Visible Stat +7</li></ul></td></tr><tr><td>200+</td><td><ul><li>Visible Stat +15</li></ul></td></tr></table>"
        "<ul><li>Shoes' Speed +1</li></ul></td></tr></tbody></table>" +
        head("h4", "Total_Stats") + "<table><tr><th>Attempt</th><th>Stats</th></tr><tr><td>9★ → 10★</td><td><ul><li>Job Stat +9</li></ul></td></tr></table>" +
        head("h3", "Superior_Items") + head("h4", "Star_Limit") + "<table><tr><th>Level</th><th>Max Stars</th></tr><tr><td>0~94</td><td>3</td></tr></table>" +
        head("h5", "Total_Stats_2") + head("h4", "Star_Limit_2") + "<table><tr><th>Level</th><th>Max Stars</th></tr><tr><td>1~2</td><td>4</td></tr></table></div>"
    )
    found = stars.star_tables(page(spark, html))
    assert rows(found["StarLimit"], "Title", "MinLvl", "MaxLvl", "Max Stars") == [
        ("Normal_Equips", 95, 107, 8), ("Normal_Equips", 138, 300, 25), ("Superior_Items", 0, 94, 3)]
    rates = found["SFSuccessRates"].collect()
    assert [tuple(r) for r in rates] == [("Normal_Equips", 12, 40, 0.0, 59.4, 0.6)]
    assert all(abs(r.Success + r.Maintain + r.Decrease + r.Destroy - 100) < 1e-6 for r in rates)
    boosts = found["NormalEquipSF"]
    assert rows(boosts, "SFID", "MinLvl", "MaxLvl", "Job Stat", "Weapon Max MP", "Shoes Speed", "Visible Stat") == [
        (1, 0, 300, 2, 5, 0, 0), (2, 0, 300, 2, 5, 0, 0), (16, 128, 137, 0, 0, 1, 7), (16, 200, 300, 0, 0, 1, 15)]
    assert found["SuperiorItemsSF"].isEmpty()


def test_flames_drop_repeats_in_order(spark):
    grid = lambda n: f"<table><tr><th>Equip level</th><th>Tier 1</th><th>Tier 3</th></tr><tr><td>0-19</td><td>{n}</td><td>1,{n}00</td></tr></table>"
    bare = lambda n: f"<table><tr><th>Tier 1</th></tr><tr><td>{n}%</td></tr></table>"
    h = lambda t, s: f"<{t}><span class='mw-headline'>{s}</span></{t}>"
    html = (
        "<div><h2><span class='mw-headline' id='Stats'>Stats</span></h2>" + h("h3", "STR increase") + "<p>By level.</p>" + grid(1) + grid(2)
        + h("h3", "Attack Power increase (Weapons)") + "<dl><dd>Normal weapons</dd></dl><p>Not affected by level</p>" + bare(3)
        + "<dl><dd>Other weapons</dd></dl><p>Needs at least level 70.</p>" + bare(4) + bare(5)
        + h("h3", "Special Bonus Stats") + h("h4", "Speed increase") + "<p>Not affected by level</p>" + bare(6) + "</div>"
    )
    found = flames.flame_tables(page(spark, html))
    assert rows(found, "Stat", "EquipGrp", "EquipType", "MinLvl", "MaxLvl", "Tier 1", F.coalesce("Tier 3", F.lit(-1.0))) == [
        ("Attack Power", "Weapons", "Normal", 0, 300, 3.0, -1.0),
        ("Attack Power", "Weapons", "Special", 70, 300, 4.0, -1.0),
        ("Main Stats", "Common", "Common", 0, 19, 1.0, 1100.0),
        ("Speed", "Common", "Common", 0, 300, 6.0, -1.0),
    ]


def test_hyper_running_totals(spark):
    point = "<tr><th>Level (from 140)</th><th>Points Awarded</th><th>Total Points Awarded</th></tr>"
    html = (
        "<div><h2><span class='mw-headline' id='Hyper_Stats_Points_Distribution'>x</span></h2><div>"
        f"<table>{point}<tr><td>140</td><td>3</td><td>3</td></tr>{point}<tr><td>141</td><td>3</td><td>6</td></tr></table><table>{point}<tr><td>142</td><td>1,000</td><td>1,006</td></tr></table></div>"
        "<h2><span class='mw-headline' id='Hyper_Stats'>y</span></h2>"
        "<table><tr><th>Hyper Stat Next Level</th><th>Level up Cost</th><th>Total Cost (sum)</th></tr><tr><td>1</td><td>1</td><td>1</td></tr></table>"
        "<h3><span class='mw-headline'>Critical Rate% Increase</span></h3>"
        "<table><tr><th>Hyper Stat Level</th><th>Overall Stat</th><th>Effect Increase from previous level</th></tr><tr><td>1</td><td>Rate +1%</td><td>1%</td></tr></table></div>"
    )
    found = hyper.hyper_tables(page(spark, html))
    points = rows(found["HyperStatDistribution"], "Level", "Points Awarded", "Total Points Awarded")
    assert points == [(140, 3, 3), (141, 3, 6), (142, 1000, 1006)]
    total = 0
    for _, awarded, running in points:
        total += awarded
        assert running == total
    assert rows(found["HyperStat"], "StatIncrease", "Hyper Stat Level", "Overall Effect") == [("Critical Rate", 1, 1.0)]
    assert rows(found["HyperStatCost"], *found["HyperStatCost"].columns) == [(1, 1, 1)]


def test_class_documents(spark):
    doc = {
        "pageProps": {"post": {"class": "Hero,", "content": {
            "legion": "Grants flat STR", "legionValue": "10/20/40/80/100", "classGroup": "Explorers (old)", "jobGroup": "Warrior", "mainStat": "STR, DEX",
            "secondaryStat": "DEX", "equipment": [{"weapon": ["twohsword", "staff"]}, {"secondary": ["bladebinder"]}], "more": 1}}}
    }
    docs = spark.createDataFrame([(json.dumps(doc),), (json.dumps(doc),), ("not json",), ("{}",)], "text string")
    found = classes.class_tables(docs)
    assert found["CharacterData"].count() == 2
    assert tuple(found["CharacterData"].first()) == ("Hero", "Explorers", "Warrior", "SPECIAL", "DEX", "Grants flat STR", "Flat")
    assert rows(found["UnionEffect"], *found["UnionEffect"].columns) == [("Grants flat STR", "Flat", "10", "20", "40", "80", "100")]
    assert rows(found["ClassMainWeapon"].distinct(), "ClassName", "Weapon") == [("Hero", "Staff"), ("Hero", "Two Handed Sword")]
    assert rows(found["ClassSecWeapon"].distinct(), "ClassName", "Secondary") == [("Hero", "Bracelet")]


def test_excluded_class_links(spark):
    links = spark.createDataFrame([("/explorers/hero",), ("/others/beast-tamer",), ("/others/jett",)], "href string")
    assert rows(classes.class_links(links), "href") == [("/explorers/hero",)]


def test_equipment_is_kept_joined_and_stored_by_key(spark):
    listing = (
        "<div class='mw-parser-output'><table class='wikitable'><tr><th>Item</th><th>Info</th></tr>"
        "<tr><td><a href='/wiki/Ring_A' title='Ring A'>Dreamy Ring</a></td><td>Level 30</td></tr>"
        "<tr><td>Plain, Ring</td><td>Level 40<br>STR: +3<br>Max HP: +5%</td></tr>"
        "<tr><td><a href='/wiki/Gone'>Lost Ring</a></td><td>Level 50</td></tr>"
        "<tr><td><a href='/wiki/X?redlink=1'>Red Ring</a></td><td>Level 50</td></tr>"
        "<tr><td>Low Ring</td><td>Level 29</td></tr><tr><td>Walker Ring</td><td>Level 90</td></tr><tr><td>Free Ring</td><td>None</td></tr></table></div>"
    )
    detail = (
        "<table><tr><th>Ring A</th></tr><tr><td><img></td></tr><tr><th>REQ Level</th><td>30</td></tr><tr><th>REQ Job\n</th><td>Any</td></tr>"
        "<tr><th>Weapon Attack</th><td>+4</td></tr><tr><th>Max HP</th><td>+7%</td></tr><tr><th>Extra Stats</th><td>none</td></tr><tr><th>All Stats</th><td>+2</td></tr></table>"
    )
    lists = page(spark, listing, "https://h.example/wiki/Ring").withColumn("slot", F.lit("Ring"))
    pages = lists.drop("slot").unionByName(page(spark, detail, "https://h.example/wiki/Ring_A", 2))
    found = equipment.equipment_records(lists, pages, ["EquipSet", "ClassType", "STR", "PercMaxHP", "WATK", "AllStats"])
    got = rows(found, "EquipName", "EquipLevel", "EquipSet", "ClassType", *[F.coalesce(c, F.lit("")) for c in ("STR", "PercMaxHP", "WATK", "AllStats")])
    assert got == [
        ("Fantasy Ring", 30, "None", "Any", "", "7", "4", "2"),
        ("Plain Ring", 40, "None", "Any", "3", "5", "", ""),
        ("Red Ring", 50, "None", "Any", "", "", "", ""),
    ]
    assert rows(equipment.record_counts(lists), "Destination", "candidates", "skipped", "recorded") == [("EquipAccessory", 7, 3, 4)]
    root = scratch(spark, "equip")
    held = save(found.drop("Destination"), EQUIP, root, "write")
    assert save(found.drop("Destination"), EQUIP, root, "write").count() == held.count() == 3


def test_set_pages(spark):
    html = (
        "<div><table class='wikitable'><tr><th>Set Effects</th><th>Cumulative Effects</th></tr>"
        "<tr><td><b>3 Set Items</b><br>STR: +10<br>Damage Against Normal Monsters: +5%</td><td><b>3 Items</b><br>STR: +10</td></tr><tr><td>none</td><td></td></tr></table></div>"
    )
    pages = page(spark, html).withColumns({"EquipSet": F.lit("Root Abyss"), "ClassType": F.lit("Warrior")})
    found = sets.set_effects(pages, ["STR", "DamageAgainstNormalMonsters"])
    assert rows(found, "Destination", "EquipSet", "SetAt", "STR") == [("EquipSetEffectAt", "Root Abyss", "3", "10"), ("EquipSetEffectCul", "Root Abyss", "3", "10")]
    assert found.where("Destination = 'EquipSetEffectAt'").first()["DamageAgainstNormalMonsters"] == "5"


@pytest.mark.parametrize("stored", [False, True])
def test_class_pages_of_odd_kinds(spark, stored):
    anchor = lambda slug, name="hvr-float": f"<a class='{name}' href='/classes/{slug}'>x</a>"
    build = '<script id="__NEXT_DATA__">{"buildId": "b1"}</script>'
    document = lambda name: '{"pageProps": {"post": {"class": "%s", "content": {}}}}' % name
    at = "https://s.example/data/b1/classes/"
    rows = [
        (1, "https://s.example/c", build + anchor("A") + anchor("A#more") + anchor("B") + anchor("C") + anchor("jett") + anchor("D", "other")),
        (2, "https://s.example/d", anchor("E")),
        (3, "https://s.example/e", build.replace("buildId", "id") + anchor("F")),
        (4, "https://s.example/f", None),
        (10, at + "A.json", document("first")),
        (11, at + "A.json", document("second")),
        (12, at + "B.json", "no JSON"),
        (13, at + "D.json", document("not linked")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = write_store(pages, F.col("url")) if stored else pages
    found = classes.class_jobs(pages, "https://s.example/data/", only=("CharacterData", "Missing"))
    assert [r.ClassName for r in found["CharacterData"].collect()] == ["first"]
    assert [r.url for r in found["Missing"].collect()] == [at + "C.json"]
    assert classes.class_addresses(pages.limit(0), "p").count() == 0
