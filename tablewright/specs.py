"""Declared tables: keys, declared columns, and whether further columns may appear."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...]
    declared: T.StructType = field(default_factory=T.StructType)
    open: bool = True
    #: Parts a stored table is rewritten in, fixed when it is first written: about its bytes over 1 GB.
    buckets: int = 16

    def with_keys(self, *extra: str) -> "TableSpec":
        return replace(self, keys=self.keys + extra)

    def named(self, name: str) -> "TableSpec":
        return replace(self, name=name)

    def misfit(self, df: DataFrame) -> Column:
        """The first declared column whose value is not of its type, as ``<name> is no <type>``, or null."""
        wrong = [
            F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
            for f in self.declared if f.name in df.columns
        ]
        return F.coalesce(*wrong, F.lit(None).cast("string"))

    def shaped(self, df: DataFrame) -> DataFrame:
        """Rows as the table takes them: declared columns in their types, present or missing.

        An open table takes further columns as they come; a closed one leaves them out.
        """
        typed = {f.name: (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)) for f in self.declared}
        wide = df.withColumns(typed) if typed else df
        names = {*self.keys, *self.declared.fieldNames()}
        return wide if self.open else wide.select(*[c for c in wide.columns if c in names])


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Primary keys of the record classes.
EQUIP = TableSpec(
    "Equip",
    ("EquipSlot", "EquipName", "EquipSet", "ClassType"),
    _text("EquipSlot", "EquipName", "EquipSet", "ClassType", "Category").add("EquipLevel", T.LongType()),
)
WEAPON = EQUIP.with_keys("WeaponType")
SET_EFFECT = TableSpec("EquipSetEffect", ("EquipSet", "ClassType", "SetAt"), _text("EquipSet", "ClassType", "SetAt"))
