"""Rule packs: the dictionaries that steer renames, defaults, routing and column order.

A pack is plain data. Swap it to clean another corpus.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

Variants = Mapping[str, list[str]]

# ---------------------------------------------------------------------------------------
# Word lists and lookup tables that decide results.
# ---------------------------------------------------------------------------------------
ACCESSORY_NAMES = {
    "Fantasy": ["dreamy", "fantasy"],
    "Penombre": ["twilight"],
    "Loose Control Machine Mark": ["berserked"],
}
WEAPON_NAMES = {
    "Tuner": ["bladecaster"],
    "Breath Shooter": ["whispershot"],
    "Buchae": ["ritualfan"],
    "Energy Sword": ["whipblade"],
    "Magic Gauntlet": ["lucentgauntlet"],
}
SECONDARY_NAMES = {
    "Arrow Head": ["arrowhead"],
    "Bracelet": ["bladebinder"],
}
SET_NAMES = {
    "Arcaneshade": ["arcaneumbra", "arcane umbra"],
    "Absolab": ["absolab"],
    "Black": ["frozen"],
}
SLOT_NAMES = {
    "Heart": ["androidheart"],
    "Pocket": ["pocketitem"],
}
CLASS_TYPES = {
    "Warrior": ["warrior", "knight"],
    "Bowman": ["archer", "bowman"],
    "Magician": ["mage", "magician"],
    "Thief": ["thief"],
    "Pirate": ["pirate"],
    "Any": [],
}
EXCLUDED_CLASSES = {
    "jett": ["gun", "fist"],
    "beasttamer": ["scepter", "whistle"],
}
EXCLUDED_CLASS_PHRASES = ["beast tamer", "jett"]
COLUMN_ORDER = [
    "EquipSlot", "EquipSet", "EquipName", "WeaponType", "Category", "EquipLevel", "ClassType", "ClassName", "SetAt",
    "STR", "DEX", "INT", "LUK", "AllStats", "DEF", "MaxHP", "MaxMP", "PercMaxHP", "PercMaxMP", "MaxDF",
    "WATK", "MATK", "BD", "IED", "CritDMG", "DMG", "AllSkills", "NDMG", "AtkSpd",
    "StatusResist", "Jump", "Speed", "Knockback",
    "NoUpgrades", "Rank",
]
FIELD_NAMES = {
    "defense": "DEF",
    "weaponattack": "WATK",
    "magicattack": "MATK",
    "ignoredenemydefense": "IED",
    "damage": "DMG",
    "bossdamage": "BD",
    "criticaldamage": "CritDMG",
    "damageagainstnormalmonster": "NDMG",
    "movementspeed": "Speed",
    "numberofupgrades": "NoUpgrades",
    "attackspeed": "AtkSpd",
    "equipmentset": "EquipSet",
    "job": "ClassType",
    "abnormalstatusresistance": "StatusResist",
    "knockbackchance": "Knockback",
    "level": "EquipLevel",
}
DEFAULT_VALUES = {
    "EquipSet": "None",
    "ClassName": "Any",
    "ClassType": "Any",
    "Category": "Obtainable",
}
ARMOR_SLOTS = ["Hat", "Top", "Overall", "Bottom", "Gloves", "Cape", "Shoes"]
ACCESSORY_SLOTS = [
    "Emblem", "Ring", "Pendant", "Face Accessory", "Badge", "Eye Accessory", "Earrings", "Shoulder", "Pocket",
    "Belt", "Heart",
]
SLOT_MIN_LEVEL = {
    "Hat": 120, "Top": 150, "Overall": 120, "Bottom": 150, "Shoes": 120, "Cape": 120, "Gloves": 120,
    "Shoulder": 120, "Face Accessory": 100, "Eye Accessory": 100, "Ring": 30, "Pendant": 75, "Earrings": 75,
    "Belt": 140, "Pocket": 0, "Android": 0, "Heart": 30, "Emblem": 100, "Badge": 100, "Medal": 0, "Shield": 110,
}
WEAPON_SETS = ["Utgard", "Lapis", "Lazuli", "Fafnir", "AbsoLab", "Arcane", "Genesis"]
IGNORED_SET_WORDS = [
    "Immortal", "Walker", "Anniversary", "Sweetwater", "Commerci", "Gollux", "Alien", "Blackgate", "Glona",
    "Abyss", "Fearless", "Eclectic", "Reverse", "Timeless",
]
SKIPPED_KEYS = [
    "extra stats", "notes", "sold for", "tradability", "bought from", "dropped by", "rewarded from", "used in",
    "used to", "durability", "when first equipped", "crafted via", "exp",
]
TRACKED_SETS = [
    "Sengoku", "Boss Accessory", "Dawn Boss", "Pitched Boss", "Seven Days", "Ifia's Treasure", "Mystic",
    "Ardentmill", "Blazing Sun", "8th", "Root Abyss", "AbsoLab", "Arcane", "Eternal", "Lionheart", "Dragon Tail",
    "Falcon Wing", "Raven Horn", "Shark Tooth", "Gold Parts", "Pure Gold Parts",
]
IGNORED_SETS = [
    "Immortal", "Walker", "Anniversary", "Eternal Hero", "Sweetwater", "Commerci", "Gollux", "Alien", "Blackgate",
    "Glona",
]
MAIN_WEAPON_NAMES = {
    "Ancientbow": "Ancient Bow",
    "Armcannon": "Arm Cannon",
    "Bladecaster": "Tuner",
    "Dualbowguns": "Dual Bowguns",
    "Fankanna": "Fan",
    "Handcannon": "Hand Cannon",
    "Longsword": "Long Sword",
    "Lucentgauntlet": "Magic Gauntlet",
    "Onehaxe": "One Handed Axe",
    "Onehblunt": "One Handed Blunt Weapon",
    "Onehsword": "One Handed Sword",
    "Psylimiter": "Psy Limiter",
    "Ritualfan": "Buchae",
    "Shiningrod": "Shining Rod",
    "Soulshooter": "Soul Shooter",
    "Twohaxe": "Two Handed Axe",
    "Twohblunt": "Two Handed Blunt Weapon",
    "Twohsword": "Two Handed Sword",
    "Whipblade": "Whip Blade",
}
SECOND_WEAPON_NAMES = {
    "Abyssalpath": "Abyssal Path",
    "Arrowfletching": "Arrow Fletching",
    "Arrowhead": "Arrow Head",
    "Bladebinder": "Bracelet",
    "Bowthimble": "Bow Thimnble",
    "Chesspiece": "Chess Piece",
    "Corecontroller": "Core Controller",
    "Demonaegis": "Demon Aegis",
    "Dragonessence": "Dragon Essence",
    "Fankanna": "Fan",
    "Fantassel": "Fan Tassel",
    "Farsight": "Far Sight",
    "Foxmarble": "Fox Marble",
    "Heavysword": "Heavy Sword",
    "Ironchain": "Iron Chain",
    "Lucentwings": "Magic Wing",
    "Mageshield": "Shield",
    "Magicarrow": "Magic Arrow",
    "Magicbookb": "Magic Book",
    "Magicbooki": "Magic Book",
    "Magicmarble": "Magic Marble",
    "Powderkeg": "Powder Keg",
    "Scabbard": "Dagger Scabbard",
    "Soulring": "Soul Ring",
    "Soulshield": "Soul Shield",
    "Thiefshield": "Shield",
    "Warpforge": "Warp  Forge",
    "Warshield": "Shield",
    "Weaponbelt": "Weapon Belt",
    "Wristband": "Wrist Band",
}
# ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RulePack:
    """Everything a corpus needs to be cleaned, as data."""

    set_names: Variants = field(default_factory=lambda: SET_NAMES)
    category_names: Mapping[str, Variants] = field(
        default_factory=lambda: {
            "Accessory": ACCESSORY_NAMES,
            "Weapon": WEAPON_NAMES,
            "Secondary": SECONDARY_NAMES,
            "Set": SET_NAMES,
            "Slot": SLOT_NAMES,
        }
    )
    slot_names: Variants = field(default_factory=lambda: SLOT_NAMES)
    class_types: Variants = field(default_factory=lambda: CLASS_TYPES)
    excluded_classes: Variants = field(default_factory=lambda: EXCLUDED_CLASSES)
    field_names: Mapping[str, str] = field(default_factory=lambda: FIELD_NAMES)
    defaults: Mapping[str, str] = field(default_factory=lambda: DEFAULT_VALUES)
    column_order: list[str] = field(default_factory=lambda: COLUMN_ORDER)
    slot_min_level: Mapping[str, int] = field(default_factory=lambda: SLOT_MIN_LEVEL)
    ignored_words: list[str] = field(default_factory=lambda: IGNORED_SET_WORDS)
    skipped_keys: list[str] = field(default_factory=lambda: SKIPPED_KEYS)
    armor_slots: list[str] = field(default_factory=lambda: ARMOR_SLOTS)
    accessory_slots: list[str] = field(default_factory=lambda: ACCESSORY_SLOTS)
    weapon_sets: list[str] = field(default_factory=lambda: WEAPON_SETS)
    tracked_sets: list[str] = field(default_factory=lambda: TRACKED_SETS)
    ignored_sets: list[str] = field(default_factory=lambda: IGNORED_SETS)
    main_weapon_names: Mapping[str, str] = field(default_factory=lambda: MAIN_WEAPON_NAMES)
    second_weapon_names: Mapping[str, str] = field(default_factory=lambda: SECOND_WEAPON_NAMES)
    excluded_class_phrases: list[str] = field(default_factory=lambda: EXCLUDED_CLASS_PHRASES)

    @staticmethod
    def from_json(spark: SparkSession, path: str) -> "RulePack":
        """Read a pack from a JSON file on any file system Spark can read."""
        text = spark.read.text(path, wholetext=True).first()["value"]
        return RulePack(**json.loads(text))


def lookup(spark: SparkSession, pairs: Mapping[str, object], key: str = "key", value: str = "value") -> DataFrame:
    """A dictionary as a two-column DataFrame.

    It is built as a local relation, so Spark knows its size and picks a broadcast join only
    while it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return spark.createDataFrame(pa.table({key: list(pairs.keys()), value: list(pairs.values())}))


def variants(spark: SparkSession, dictionary: Variants) -> DataFrame:
    """``canonical -> [variants]`` as rows ``(rank, canonical, variant, step)``, in written order."""
    rows = [
        (rank, canonical, variant, step)
        for rank, (canonical, names) in enumerate(dictionary.items())
        for step, variant in enumerate(names)
    ]
    return local_rows(spark, rows, [("rank", pa.int32()), ("canonical", pa.string()), ("variant", pa.string()), ("step", pa.int32())])


def local_rows(spark: SparkSession, rows: Iterable[tuple], fields: list[tuple[str, pa.DataType]]) -> DataFrame:
    columns = list(zip(*rows)) or [[] for _ in fields]
    arrays = [pa.array(list(c), t) for c, (_, t) in zip(columns, fields)]
    return spark.createDataFrame(pa.table(arrays, names=[n for n, _ in fields]))
