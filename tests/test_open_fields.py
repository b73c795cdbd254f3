"""Fields that no column takes are in the results of the jobs by name."""

from pyspark.sql import functions as F

from test_plans import page
from tablewright.checks.job_checks import equipment_corpus
from tablewright.operators.sinks import destination, read_current
from tablewright.plans import equipment, flames, hyper, sets, stars
from tablewright.session import scratch
from tablewright.specs import EQUIP

SF = "/root/testdata/sf0.001"


def grid(names, *values):
    return "<table><tr>" + "".join(f"<th>{n}</th>" for n in names) + "</tr>" + "".join("<tr>" + "".join(f"<td>{v}</td>" for v in row) + "</tr>" for row in values) + "</table>"


def head(tag, ident):
    return f"<{tag}><span class='mw-headline' id='{ident}'>{ident}</span></{tag}>"


def test_flames(spark):
    html = "<div>" + head("h2", "Stats") + head("h3", "STR increase") + "<p>By level.</p>" + grid(["Equip level", "Tier 1", "Tier 8", "Note"], ["0-19", 1, "88", "new"], ["20-29", 2, "", ""]) + "</div>"
    found = flames.flame_tables(page(spark, html))
    assert [(r["Tier 1"], r["Other"]) for r in found.orderBy("MinLvl").collect()] == [(1.0, {"Tier 8": "88", "Note": "new"}), (2.0, {"Tier 8": "", "Note": ""})]


def test_stars(spark):
    html = (
        "<div>" + head("h3", "Normal_Equip") + head("h4", "Star_Limit") + grid(["Level", "Max Stars", "Since"], ["0~94", 5, "v2"])
        + head("h4", "Success_Rates") + grid(["Attempt", "Chance (Success)", "Chance (Boom)"], ["1★ → 2★", "40%", "9%"])
        + head("h4", "Stats_Boost") + grid(["Attempt", "Stats"], ["0★ → 1★", "<ul><li>Job Stat +2</li><li>Luck +7</li></ul>"]) + "</div>"
    )
    found = stars.star_tables(page(spark, html))
    assert [(r["Job Stat"], {k: int(v) for k, v in r["Other"].items()}) for r in found["NormalEquipSF"].collect()] == [(2, {"Luck": 7})]
    rest = {(r.Table, r.Title, r.Of): r.Other for r in found["StarOther"].collect()}
    assert rest == {("StarLimit", "Normal_Equips", "0~94"): {"Since": "v2"}, ("SFSuccessRates", "Normal_Equips", "1★ → 2★"): {"Boom": "9%"}}


def test_hyper(spark):
    html = (
        "<div>" + head("h2", "Hyper_Stats_Points_Distribution") + "<div>" + grid(["Level", "Points Awarded", "Bonus"], [140, 3, "b"]) + "</div>"
        + head("h2", "Hyper_Stats") + grid(["Hyper Stat Next Level", "Level up Cost", "Mesos"], [1, 1, "m"])
        + head("h3", "STR Increase") + grid(["Hyper Stat Level", "Overall Stat", "Cap"], [1, "+1%", "c"]) + "</div>"
    )
    rest = hyper.hyper_tables(page(spark, html))["HyperStatOther"].collect()
    assert {(r.Table, r.StatIncrease, r.Of): r.Other for r in rest} == {
        ("HyperStatDistribution", None, "140"): {"Bonus": "b"}, ("HyperStatCost", None, "1"): {"Mesos": "m"}, ("HyperStat", "STR", "1"): {"Cap": "c"}}


def test_sets(spark):
    html = "<div><table class='wikitable'><tr><th>Set Effects</th></tr><tr><td><b>3 Items</b><br>STR: +10<br>Luck: +4</td></tr><tr><td><b>4 Items</b></td></tr></table></div>"
    pages = page(spark, html).withColumns({"EquipSet": F.lit("Root Abyss"), "ClassType": F.lit("Warrior")})
    found = sets.set_effects(pages, ["STR"])
    assert {r.SetAt: (r.STR, r.Other) for r in found.collect()} == {"3": ("10", {"Luck": "4"}), "4": (None, {})}


def test_equipment_and_store(spark):
    """The corpus of the named query: maximum HP and further facts are not among these known fields."""
    lists, pages = equipment_corpus(spark, SF)
    records = equipment.equipment_records(lists, pages, ["EquipSet", "ClassType", "STR"], order="at").withColumn("at", F.to_json("at"))
    held = equipment.store_records(records, scratch(spark, "open-store"), {"EquipAccessory": EQUIP}, "at", ["STR"])["EquipAccessory"]
    for df in (destination(records, "EquipAccessory"), held):
        rows = df.collect()
        assert rows and all("PercMaxHP" in r.Other and "STR" not in r.Other for r in rows)
        assert any("WATK" in r.Other for r in rows)


def test_store_rejects_unlisted_destinations(spark):
    rows = [("Ring", f"r{i}", "None", "Any", place, str(i), i) for i, place in enumerate(["EquipAccessory", "EquipPet", None, "EquipPet"])]
    records = spark.createDataFrame(rows, "EquipSlot string, EquipName string, EquipSet string, ClassType string, Destination string, STR string, at int")
    root = scratch(spark, "unlisted")
    held = equipment.store_records(records, root, {"EquipAccessory": EQUIP}, "at", ["STR"])
    assert [r.EquipName for r in held["EquipAccessory"].collect()] == ["r0"]
    gone = read_current(spark, f"{root}/Destination_rejects").collect()
    assert sorted((r.EquipName, r.Destination or "") for r in gone) == [("r1", "EquipPet"), ("r2", ""), ("r3", "EquipPet")]
