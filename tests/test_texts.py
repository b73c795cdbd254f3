"""Expressions on the text forms that occur."""

import pytest
from pyspark.sql import functions as F

from tablewright.functions import numbers as N, records as R, text as X
from tablewright.operators import predicates as P


def values(spark, texts, expr):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", expr(F.col("t")).alias("v")).orderBy("i")
    return [r.v.asDict() if hasattr(r.v, "asDict") else r.v for r in df.collect()]


@pytest.mark.parametrize("lone, top", [("closed", 120), ("open", 300)])
def test_level_band(spark, lone, top):
    texts = ["10-19", "95~107", "138 and above", "250+", "120", "at least level 70.", "Level requirement: 30", "", None]
    got = [(v["MinLvl"], v["MaxLvl"]) if v else None for v in values(spark, texts, lambda c: N.level_band(c, lone))]
    assert got == [(10, 19), (95, 107), (138, 300), (250, 300), (120, top), (70, 300), (30, 300), (None, None), (None, None)]


def test_numbers(spark):
    texts = ["95%", "3★", "+12", "1,500", None, "63.7%", " 0★ → 1★", "-2", "none"]
    assert values(spark, texts, N.parse_number) == [95, 3, 12, 1500, None, 63.7, 0, -2, None]
    assert values(spark, [None, "5"], lambda c: N.parse_number(c, absent=0)) == [0, 5]
    assert values(spark, ["12", "1.2", "x", ""], N.number_or_null) == [12, None, None, None]
    assert values(spark, ["0★ → 1★", "1★ → 2★, 2★ → 3★", ""], N.pair_maxima) == [[1], [2, 3], []]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Skill Cooldown -2 seconds", (None, 2, None, "Flat")),
        ("5% chance to ignore 20% of monster damage dealt", (5, None, None, "Perc")),
        ("15% chance to recover HP when attacking.", (15, None, None, "Flat")),
        ("Invincibility Time +1 second", (None, 1, None, "Flat")),
        ("Damage to Boss Monsters +30%", (None, None, None, "Perc")),
        ("Recovers 24 HP every 4 seconds", (None, None, 4, "Flat")),
        ("10% chance to become invincible for 7 seconds when attacked", (10, 7, None, "Flat")),
    ],
)
def test_effects(spark, text, want):
    [v] = values(spark, [text], N.effect_facts)
    assert (v["Chance"], v["Duration"], v["Tick"], v["StatT"]) == want


def test_tiers(spark):
    texts = ["10/20/40/80/100", "2%/4%/6%/8%/10%", "1/2/3/4/5 [max]", "1/2/3/4/5%-6%", "1/2"]
    got = [tuple(v.values()) for v in values(spark, texts, N.tier_values)]
    assert got == [
        ("10", "20", "40", "80", "100"), ("2%", "4%", "6%", "8%", "10"), ("1", "2", "3", "4", "5"), ("1", "2", "3", "4", "5"), ("1", "2", None, None, None),
    ]


def test_names(spark):
    assert values(spark, ["  the  big\tfox ", "psy-limiter", "o'neil"], X.capwords) == ["The Big Fox", "Psy-limiter", "O'neil"]
    assert values(spark, ["oneHAxe", ""], X.capitalize) == ["Onehaxe", ""]
    assert values(spark, ["aBC"], X.upper_first) == ["ABC"]
    assert values(spark, ["Cape, Belt, and Shoulderpad", "Hand and Sandals", "Hat"], X.split_list) == [
        ["Cape", "Belt", "Shoulderpad"], ["Hand", "Sandals"], ["Hat"]]
    assert values(spark, ["Star_Limit_of_x", "Hat"], R.section_key) == ["StarLimit", "Hat"]
    stats = [tuple(v.values()) for v in values(spark, ["STR increase", "STR and DEX increase", "Attack Power increase (Weapons)", "Max HP% increase"], R.stat_and_group)]
    assert stats == [("Main Stats", "Common"), ("Mixed Stats", "Common"), ("Attack Power", "Weapons"), ("Max HP", "Common")]


def test_key_value_lines(spark):
    texts = ["STR: +3", "Max HP: +10%", "Defense: +1,500 (base)", "Jump +5", "Ignored Enemy Defense: +10%"]
    got = [tuple(v.values()) for v in values(spark, texts, R.key_value)]
    assert got == [("STR", "3"), ("Perc Max HP", "10"), ("Defense", "1500"), ("Jump", "+5"), ("Ignored Enemy Defense", "10")]


def test_maps_keep_the_last_entry(spark):
    lines = F.array(F.lit("DEF +1"), F.lit("MP +2"), F.lit("DEF +3"))
    assert values(spark, ["x"], lambda c: R.to_map(N.plus_entries(lines))) == [{"MP": 2, "DEF": 3}]
    base, row = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(9))
    assert values(spark, ["x"], lambda c: R.overlay(base, row)) == [{"a": 1, "b": 9}]


def test_skipped_keys(spark):
    keys = ["All Stats", "Extra Stats", "Notes", "Experience", "Exp", "REQ Job", "REQ STR", "Level", "When first equipped:"]
    phrases = ["extra stats", "notes", "exp", "when first equipped"]
    assert values(spark, keys, lambda c: P.key_skipped(c, phrases)) == [False, True, True, False, True, False, True, True, True]
    assert values(spark, keys[:2], lambda c: P.key_skipped(c, phrases, by_word=True)) == [True, True]


def test_rows_kept(spark):
    rows = [("Hat A", 120, 100), ("Hat é", 120, 100), ("Hat A", 90, 100), ("Walker Hat", 120, 100), ("Hat A", None, 100), ("Hat A", 1, None)]
    df = spark.createDataFrame(rows, "n string, l int, m int")
    got = df.select(P.row_kept(F.col("n"), F.col("l"), F.col("m"), ["Walker"]).alias("k")).collect()
    assert [r.k for r in got] == [True, False, False, False, False, True]
