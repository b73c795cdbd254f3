"""Dedupe, upserts, modes, types, streams: against plain Python models and on hot keys."""

import glob
import random

import pytest
from pyspark.sql import functions as F, types as T

from tablewright import rules as R
from tablewright.operators import rename, reshape as S, sinks as K, steps
from tablewright.session import scratch
from tablewright.sources.corpus import catalog_shapes, read_snapshot
from tablewright.specs import EQUIP, SET_EFFECT, WEAPON, TableSpec
from tablewright.streaming import pages as stream


@pytest.mark.parametrize("seed", range(3))
def test_dedupe_ordered_against_a_loop(spark, seed):
    rng = random.Random(seed)
    # A third of the rows share one key.
    rows = [(i, rng.choice(["hot", f"k{rng.randrange(40)}", f"k{rng.randrange(40)}"]), rng.choice(["Normal", "Normal", "Special", "Common"])) for i in range(600)]
    seen, want = set(), []
    for i, key, kind in rows:
        if key in seen:
            continue
        want.append(i)
        if kind != "Normal":
            seen.add(key)
    df = spark.createDataFrame(rows, "i int, k string, kind string").repartition(7)
    got = S.dedupe_ordered(df, ["k"], "i", F.col("kind") != "Normal").collect()
    assert sorted(r.i for r in got) == want


def test_dedupe_with_other_checked_key(spark):
    rows = [(1, "A", "A", "Special"), (2, "B", "A", "Common"), (3, "T", "B", "Common"), (4, "T", "T", "Common"), (5, "T", "T", "Common")]
    df = spark.createDataFrame(rows, "i int, top string, own string, kind string")
    got = S.dedupe_ordered(df, ["own"], "i", F.col("kind") != "Normal", checked=["top"]).collect()
    seen, want = set(), []
    for i, top, own, kind in rows:
        if top not in seen:
            want.append(i)
            if kind != "Normal":
                seen.add(own)
    assert sorted(r.i for r in got) == want == [1, 2, 3, 4]


def test_large_dictionary_gives_one_result_written_or_joined(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randrange(2, 5)))
    dictionary = {f"Name{i}": [word() for _ in range(rng.randrange(1, 4))] for i in range(150)}
    texts = ["hot"] * 200 + ["".join(rng.choice("abcdeX ") for _ in range(rng.randrange(0, 12))) for _ in range(300)] + [None]

    def model(value):
        if value is None:
            return None
        for canonical, names in dictionary.items():
            if any(n in value.lower() for n in names):
                out = value.lower()
                for n in names:
                    out = out.replace(n, canonical)
                return out
        return value

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = {i: model(t) for i, t in enumerate(texts)}
    assert {r.i: r.t for r in rename.rename_by_substrings(df, "t", dictionary).collect()} == want
    assert {r.i: r.t for r in df.withColumn("t", rename.rename_substring(F.col("t"), dictionary)).collect()} == want


def test_record_renames(spark):
    rows = [
        ("Arcane Umbra Knight Hat", "arcane umbra knight set", "Warrior", "EquipArmor"),
        ("Genesis Ritual Fan", "Genesis", "Any", "EquipWeapon"),
        ("Ritualfan of Dusk", "Boss Accessory Set", "Any", "EquipWeapon"),
        ("Dreamy Belt", "None", "Any", "EquipAccessory"),
        ("Twilight Mark", "Setting (Sun)", "Thief", "EquipWeapon"),
    ]
    df = spark.createDataFrame(rows, "EquipName string, EquipSet string, ClassType string, Destination string")
    got = {r.EquipName: r.EquipSet for r in rename.rename_record(df).collect()}
    assert got == {
        "Arcaneshade Knight Hat": "Arcaneshade",
        "Genesis Ritual Fan": "Genesis",
        "Buchae Of Dusk": "Boss Accessory",
        "Fantasy Belt": "None",
        "Twilight Mark": "Setting Sun",
    }


def test_class_type_lookup(spark):
    df = spark.createDataFrame([("knight",), ("mage",), ("Hero",)], "c string")
    assert [r.c for r in rename.lookup_variant(df, "c", R.CLASS_TYPES).orderBy("c").collect()] == ["Hero", "Magician", "Warrior"]
    slots = spark.createDataFrame([("Pocket Item",), ("Android Heart ",), ("Ring",)], "s string")
    assert sorted(r.s for r in rename.lookup_variant(slots, "s", R.SLOT_NAMES, normalise=True).collect()) == ["Heart", "Pocket", "Ring"]


def test_upsert_against_a_dictionary(spark):
    rng = random.Random(1)
    make = lambda n, low: [("hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}", low + i, f"v{rng.randrange(99)}") for i in range(n)]
    held, new = make(200, 0), make(200, 0)
    want = {}
    for side in (held, new):
        newest = {}
        for k, seq, v in side:
            if k not in newest or seq > newest[k][0]:
                newest[k] = (seq, v)
        want.update(newest)
    schema = "k string, seq int, v string"
    got = K.upsert(spark.createDataFrame(held, schema), spark.createDataFrame(new, schema), ["k"], seq="seq")
    assert {r.k: (r.seq, r.v) for r in got.collect()} == want


def test_save_modes_widen_and_keep_old_versions_readable(spark):
    root, spec = scratch(spark, "save"), TableSpec("t", ("k",))
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    second = spark.createDataFrame([("b", "new"), ("c", None)], "k string, y string")
    held = K.save(first, spec, root, "write")
    both = K.save(second, spec, root, "write", defaults={"y": "none"}, columns=["y"])
    assert both.columns == ["y", "k", "x"]
    assert sorted((r.k, r.x, r.y) for r in both.collect()) == [("a", 1, None), ("b", None, "new"), ("c", None, "none")]
    assert held.count() == 2
    assert K.save(first, spec, root, "read").count() == 3
    assert K.save(first, spec, root, "remake").count() == 2
    with pytest.raises(ValueError):
        K.save(first, spec, root, "append")


def test_an_unfinished_version_does_not_count(spark):
    root, spec = scratch(spark, "crash"), TableSpec("t", ("k",))
    rows = spark.createDataFrame([("a", 1)], "k string, x int")
    K.save(rows, spec, root, "write")
    broken = f"{root}/t/v=2"
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(broken)
    assert not glob.glob(f"{broken}/_SUCCESS")
    assert K.read_current(spark, f"{root}/t").count() == 1
    assert K.save(rows, spec, root, "write").count() == 1


def test_types_come_from_all_values(spark):
    kv = [("n", "1"), ("n", "22"), ("m", "1"), ("m", "x"), ("r", "1"), ("r", "1.5"), ("e", None)]
    got = K.inferred_types(spark.createDataFrame(kv, "key string, value string")).collect()
    assert {r.key: r.type for r in got} == {"n": "INTEGER", "m": "TEXT", "r": "REAL"}
    wide = spark.createDataFrame([("1", "1.5", "x", None), (None, "2", "3", None)], "a string, b string, c string, d string")
    assert K.cast_inferred(wide, ["a", "b", "c", "d"]).dtypes == [("a", "bigint"), ("b", "double"), ("c", "string"), ("d", "string")]


def test_snapshots_of_two_ages_meet_by_name(spark):
    old, new = scratch(spark, "old"), scratch(spark, "new")
    spark.createDataFrame([("0,Hat,1,2",)], "v string").unionByName(spark.createDataFrame([("1,Cape,3,4",)], "v string")).coalesce(1).write.text(old)
    spark.createDataFrame([(",EquipName,DEX,STR",), ("0,Ring,5,6",)], "v string").coalesce(1).write.text(new)
    shape = lambda *names: T.StructType([T.StructField("EquipName", T.StringType())] + [T.StructField(n, T.LongType()) for n in names])
    a = read_snapshot(spark, new, shape("DEX", "STR"))
    b = spark.read.schema("i int, EquipName string, STR long, LUK long").csv(old).drop("i")
    both = S.order_columns(S.union_by_name([a, b]), R.COLUMN_ORDER)
    assert both.columns == ["EquipName", "STR", "DEX", "LUK"]
    assert sorted(map(tuple, both.collect())) == [("Cape", 3, None, 4), ("Hat", 1, None, 2), ("Ring", 6, 5, None)]


def test_steps_run_in_order_of_their_numbers(spark):
    df = spark.range(1).select(F.lit("x").alias("v"))
    add = lambda s: lambda d: d.select(F.concat("v", F.lit(s)).alias("v"))
    assert steps.run_steps(df, {1000: add("c"), 300: add("a"), 800: add("b")}).first().v == "xabc"


def test_specs_do_not_share_keys():
    assert WEAPON.keys == EQUIP.keys + ("WeaponType",) and len(EQUIP.keys) == 4 and SET_EFFECT.keys[-1] == "SetAt"


def test_catalog_shapes(spark):
    spark.range(1).createOrReplaceTempView("shape_probe")
    assert catalog_shapes(spark)["shape_probe"] == [("id", "bigint")]
    spark.catalog.dropTempView("shape_probe")


def test_rule_pack_from_json(spark):
    path = scratch(spark, "rules")
    spark.createDataFrame([('{"slot_names": {"Heart": ["androidheart"]},',), (' "defaults": {"EquipSet": "-"}}',)], "v string").coalesce(1).write.text(path)
    [part] = glob.glob(f"{path}/part-*")
    pack = R.RulePack.from_json(spark, part)
    assert pack.defaults == {"EquipSet": "-"} and pack.slot_names == {"Heart": ["androidheart"]} and pack.class_types == R.CLASS_TYPES


def write_batches(spark, folder):
    page = lambda i, *links: (i, f"https://h.example/p{i}", "".join(f"<a href='{x}'>t</a>" for x in links))
    batches = [[page(1, "/p2", "/hot"), page(2, "/p1", "/hot")], [page(3, "/p4", "/hot")], [page(4, "/hot", "/p9"), page(3, "/p4")]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, stream.PAGES).coalesce(1).write.mode("append").parquet(folder)
    return [r for rows in batches for r in rows]


def test_stream_in_many_batches_equals_batch(spark):
    from tablewright.operators.links import frontier

    folder = scratch(spark, "arrivals")
    write_batches(spark, folder)
    read = lambda: stream.read_pages(spark, folder, glob="*.parquet", files_per_batch=1)
    out = scratch(spark, "frontier")
    got = stream.stream_frontier(read(), out)
    assert len(glob.glob(f"{out}/facts/batch=*")) == 3
    want = frontier(spark.read.schema(stream.PAGES).parquet(folder))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) == [("https://h.example/hot",), ("https://h.example/p9",)]
    # A second run finds nothing new and changes nothing.
    assert stream.stream_frontier(read(), out).count() == 2
    urls = stream.stream_urls(read(), scratch(spark, "urls")).collect()
    assert sorted(r.url for r in urls) == [f"https://h.example/p{i}" for i in range(1, 5)]


def test_stream_upsert_later_batch_wins(spark):
    folder = scratch(spark, "arrivals")
    for rows in ([(1, "a", "old"), (2, "b", "kept")], [(1, "a", "new")]):
        spark.createDataFrame(rows, stream.PAGES).coalesce(1).write.mode("append").parquet(folder)
    # Files of a folder arrive in the order of their time stamps.
    source = stream.read_pages(spark, folder, glob="*.parquet", files_per_batch=1)
    got = stream.stream_records(source, lambda df: df, ["url"], scratch(spark, "rows"), "page_id")
    assert sorted((r.url, r.html) for r in got.collect()) == [("a", "new"), ("b", "kept")]


def test_repeated_keys_need_an_order(spark):
    held = spark.createDataFrame([("k", "a", 0)], "k string, v string, n int")
    new = spark.createDataFrame([("k", "z", 1), ("k", "a", 2), (None, "x", 3)], "k string, v string, n int")
    with pytest.raises(ValueError, match="seq"):
        K.upsert(held, new, ["k"])
    assert [tuple(r) for r in K.upsert(held, new, ["k"], seq="n").collect()] == [("k", "a", 2)]
    assert K.upsert(held, new.where("n <> 1"), ["k"]).count() == 1


def test_two_writers_cannot_take_one_version(spark, tmp_path, monkeypatch):
    spec = TableSpec("t", ("k",))
    rows = spark.createDataFrame([("a", 1)], "k string, n int")
    K.save(rows, spec, str(tmp_path))
    # The other writer has listed the versions, but has not begun its own.
    monkeypatch.setattr(K, "_versions", lambda spark, path, complete=True: [])
    with pytest.raises(RuntimeError, match="another writer"):
        K.save(rows, spec, str(tmp_path))
    monkeypatch.undo()
    for n in range(3):
        held = K.save(rows.withColumn("n", F.lit(n)), spec, str(tmp_path), keep=2)
    assert held.first().n == 2 and len(list(tmp_path.glob("t/v=*"))) == 2


@pytest.mark.parametrize("late", ["save", "compact"])
def test_a_version_made_in_between_is_not_lost(spark, tmp_path, monkeypatch, late):
    root, spec = str(tmp_path), TableSpec("t", ("k",), buckets=2)
    rows = lambda k: spark.createDataFrame([(k, 1)], "k string, n int")
    K.save(rows("a"), spec, root)
    write = K._write_buckets

    def interrupted(df, path, number):
        # Another writer begins and ends while this one, which has read the first version, still writes.
        monkeypatch.setattr(K, "_write_buckets", write)
        K.save(rows("b"), spec, root)
        write(df, path, number)

    monkeypatch.setattr(K, "_write_buckets", interrupted)
    with pytest.raises(RuntimeError, match="another writer"):
        K.save(rows("c"), spec, root) if late == "save" else K.compact(spark, spec, root)
    assert sorted(r.k for r in K.read_current(spark, f"{root}/t").collect()) == ["a", "b"]
    # Trying again builds on what is there by now.
    again = K.save(rows("c"), spec, root) if late == "save" else K.compact(spark, spec, root)
    assert sorted(r.k for r in again.collect()) == (["a", "b", "c"] if late == "save" else ["a", "b"])


def test_closed_tables_take_declared_columns(spark):
    rows = spark.createDataFrame([("a", "7", "x")], "k string, n string, more string")
    declared = spark.createDataFrame([], "n bigint, absent string").schema
    closed = TableSpec("t", ("k",), declared, open=False).shaped(rows)
    assert closed.dtypes == [("k", "string"), ("n", "bigint"), ("absent", "string")] and closed.first().n == 7
    assert "more" in TableSpec("t", ("k",), declared).shaped(rows).columns


def test_streams_without_any_batch(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    read = lambda: stream.read_pages(spark, str(tmp_path / "pages"), glob="*.parquet")
    assert stream.stream_frontier(read(), str(tmp_path / "a")).count() == 0
    assert stream.stream_records(read(), lambda df: df.select("url", "page_id"), ["url"], str(tmp_path / "b"), "page_id").count() == 0


def buckets_of(root, name="t"):
    return {(p.split("/")[-2], p.split("/")[-1]) for p in glob.glob(f"{root}/{name}/v=*/_bucket=*")}


def test_a_write_rewrites_the_buckets_of_its_keys(spark, tmp_path):
    root, spec = str(tmp_path), TableSpec("t", ("k",), buckets=8)
    K.save(spark.range(400).select(F.col("id").alias("k"), F.lit("old").alias("v")), spec, root)
    assert len(buckets_of(root)) == 8
    held = K.save(spark.createDataFrame([(7, "new"), (1000, "more")], "k long, v string"), spec, root)
    second = {b for v, b in buckets_of(root) if v == "v=2"}
    assert 1 <= len(second) <= 2 and len(buckets_of(root)) == 8 + len(second)
    assert held.count() == 401 and {r.k: r.v for r in held.where("v <> 'old'").collect()} == {7: "new", 1000: "more"}
    # Retiring leaves what the newest version still holds, and nothing else.
    K.save(spark.createDataFrame([(7, "newer")], "k long, v string"), spec, root, keep=1)
    assert len(buckets_of(root)) == 8 and K._versions(spark, f"{root}/t") == [3]
    assert K.read_current(spark, f"{root}/t").where("k = 7").first().v == "newer"
    compacted = K.compact(spark, spec, root)
    assert {v for v, _ in buckets_of(root)} == {"v=4"} and len(list(tmp_path.glob("t/v=*"))) == 1 and compacted.count() == 401
    assert K.save(spark.range(3).select(F.col("id").alias("k")), spec, root, "remake").count() == 3


def test_types_meet_over_versions(spark, tmp_path):
    root, spec = str(tmp_path), TableSpec("t", ("k",), buckets=4)
    K.save(spark.createDataFrame([(i, i, i, 1.5, i) for i in range(20)], "k int, a int, b long, c double, d long"), spec, root)
    K.save(spark.createDataFrame([(3, "x", 2.5, 2, 2**40)], "k int, a string, b double, c int, d long"), spec, root)
    K.save(spark.createDataFrame([(4, "7", "y", [1, 2], None)], "k int, a string, b string, c array<int>, d double"), spec, root)
    held = K.read_current(spark, f"{root}/t")
    assert dict(held.dtypes) == {"k": "bigint", "a": "string", "b": "string", "c": "string", "d": "double"} or dict(held.dtypes) == {"k": "int", "a": "string", "b": "string", "c": "string", "d": "double"}
    rows = {r.k: tuple(r)[1:] for r in held.collect()}
    assert rows[3] == ("x", "2.5", "2", float(2**40)) and rows[4] == ("7", "y", "[1,2]", None) and rows[19] == ("19", "19", "1.5", 19.0) and len(rows) == 20


def test_a_key_may_widen(spark, tmp_path):
    root, spec = str(tmp_path), TableSpec("t", ("k",), buckets=4)
    K.save(spark.createDataFrame([(i, "old") for i in range(10)], "k int, v string"), spec, root)
    held = K.save(spark.createDataFrame([("3", "new"), ("x", "new")], "k string, v string"), spec, root)
    assert {r.k: r.v for r in held.collect()} == {**{str(i): "old" for i in range(10)}, "3": "new", "x": "new"}
    again = K.save(spark.createDataFrame([(5, "last")], "k int, v string"), spec, root)
    assert again.count() == 11 and again.where("k = '5'").first().v == "last"


@pytest.mark.parametrize("a, b, exact, want", [
    ("int", "int", True, "int"), ("int", "bigint", True, "bigint"), ("bigint", "double", True, "double"), ("bigint", "double", False, "string"),
    ("double", "string", True, "string"), ("void", "int", True, "int"), ("int", "void", True, "int"), ("boolean", "int", True, "string"), ("date", "timestamp", True, "string"),
])
def test_least_types(a, b, exact, want):
    kind = T._parse_datatype_string
    one, two = (T.NullType() if x == "void" else T.StructType.fromDDL(f"x {x}")["x"].dataType for x in (a, b))
    assert K.joined_type(one, two, exact).simpleString() == want


def test_values_of_another_type_than_declared_are_set_aside(spark, tmp_path):
    spec = TableSpec("t", ("k",), spark.createDataFrame([], "k string, n bigint").schema)
    held = K.save(spark.createDataFrame([("a", "5", "x"), ("b", "many", "y"), ("c", None, "z")], "k string, n string, w string"), spec, str(tmp_path))
    assert sorted((r.k, r.n) for r in held.collect()) == [("a", 5), ("c", None)]
    assert [(r.k, r.n, r.w, r.reason) for r in spark.read.parquet(str(tmp_path / "t_misfits")).collect()] == [("b", "many", "y", "n is no bigint")]


def test_a_batch_counts_once(spark, tmp_path):
    root, spec = str(tmp_path), TableSpec("t", ("k",), buckets=2)
    rows = lambda v: spark.createDataFrame([("a", v)], "k string, v int")
    K.save(rows(1), spec, root, batch=("s", 0))
    K.save(rows(2), spec, root, batch=("s", 1))
    assert K.save(rows(9), spec, root, batch=("s", 0)).first().v == 2
    K.save(rows(3), spec, root, batch=("other", 0))
    K.compact(spark, spec, root)
    assert K.save(rows(9), spec, root, batch=("s", 1)).first().v == 3 and K.save(rows(4), spec, root, batch=("s", 2)).first().v == 4


def test_stream_into_a_store_with_replay(spark, tmp_path):
    folder, root, spec = str(tmp_path / "in"), str(tmp_path / "root"), TableSpec("t", ("url",), buckets=2)
    for rows in ([(1, "a", "old"), (2, "b", "kept")], [(1, "a", "new")]):
        spark.createDataFrame(rows, stream.PAGES).coalesce(1).write.mode("append").parquet(folder)
    seen = []

    def store(rows, batch):
        seen.append(batch)
        K.save(rows, spec, root, seq="page_id", batch=batch)
        if len(seen) == 2:
            raise RuntimeError("lost after the commit")

    read = lambda: stream.read_pages(spark, folder, glob="*.parquet", files_per_batch=1)
    with pytest.raises(Exception, match="lost after the commit"):
        stream.stream_store(read(), store, str(tmp_path / "out"))
    stream.stream_store(read(), store, str(tmp_path / "out"))
    assert seen == [("pages", 0), ("pages", 1), ("pages", 1)] and len(K._versions(spark, f"{root}/t")) == 2
    assert sorted((r.url, r.html) for r in K.read_current(spark, f"{root}/t").collect()) == [("a", "new"), ("b", "kept")]


def test_bands_of_any_width(spark):
    from tablewright.plans.lookups import bins, rules_at

    rng = random.Random(4)
    spans = [(rng.randint(-40, 40), rng.randint(-40, 40)) for _ in range(60)] + [(0, 2_000_000_000), (-(2**40), 2**50), (5, 5), (None, 3), (7, None), (None, None)]
    bands = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "band int, MinLvl long, MaxLvl long")
    levels = [*range(-45, 46), 1_999_999_999, 2_000_000_001, 2**50, -(2**40) - 1, None]
    got = sorted((r.level, r.band) for r in rules_at(spark.createDataFrame([(x,) for x in levels], "level long"), bands).collect())
    assert got == sorted((x, i) for x in levels if x is not None for i, (a, b) in enumerate(spans) if (a is None or a <= x) and (b is None or x <= b))
    cut = bands.where("MinLvl <= MaxLvl").select("MinLvl", "MaxLvl", bins(F.col("MinLvl"), F.col("MaxLvl")).alias("b")).collect()
    for r in cut:
        held = sorted((x["place"] << x["size"], (x["place"] + 1) << x["size"]) for x in r.b)
        assert held[0][0] == r.MinLvl and held[-1][1] == r.MaxLvl + 1 and all(a[1] == b[0] for a, b in zip(held, held[1:])) and len(held) <= 124


def test_numbers_that_do_not_fit_are_set_aside(spark):
    from test_open_fields import grid, head
    from test_plans import page
    from tablewright.plans import hyper, stars

    html = "<div>" + head("h3", "Normal_Equip") + head("h4", "Star_Limit") + grid(["Level", "Max Stars"], ["0~94", "99,999,999,999"], ["95~107", "7.5"], ["108~117", "9"], ["118~119", ""]) + "</div>"
    found = stars.star_tables(page(spark, html))
    assert [(r.MinLvl, r["Max Stars"]) for r in found["StarLimit"].orderBy("MinLvl").collect()] == [(0, None), (95, None), (108, 9), (118, None)]
    assert sorted((r.Table, r.Of, r.Field, r.Value) for r in found["StarRejects"].collect()) == [("StarLimit", "0~94", "Max Stars", "99,999,999,999"), ("StarLimit", "95~107", "Max Stars", "7.5")]
    html = "<div>" + head("h2", "Hyper_Stats") + grid(["Hyper Stat Next Level", "Level up Cost"], [1, "1.5"], [2, "99,999,999,999"], [3, 4]) + "</div>"
    found = hyper.hyper_tables(page(spark, html))
    assert [r["Level up Cost"] for r in found["HyperStatCost"].orderBy("Hyper Stat Next Level").collect()] == [None, None, 4]
    assert sorted((r.Of, r.Field, r.Value) for r in found["HyperStatRejects"].collect()) == [("1", "Level up Cost", "1.5"), ("2", "Level up Cost", "99,999,999,999")]


def test_facts_without_a_name_are_kept(spark):
    rows = spark.createDataFrame([("r", "A", "1", 1), ("r", None, "lost?", 2), ("r", "Z", "9", 3)], "record string, key string, value string, seq int")
    assert [(r.A, r.Other) for r in S.pivot_wide(rows, ["record"], ["A"], other="Other").collect()] == [("1", {"": "lost?", "Z": "9"})]


def test_large_rows_become_maps_in_one_pass(spark):
    import time

    from tablewright.functions.records import to_map

    began = time.perf_counter()
    entries = F.transform(F.sequence(F.lit(0), F.lit(200_000)), lambda i: F.struct((i % 150_000).cast("string").alias("key"), i.alias("value")))
    found = spark.range(1).select(to_map(entries).alias("m")).select(F.size("m").alias("n"), F.col("m")["7"].alias("v")).first()
    assert (found.n, found.v) == (150_000, 150_007) and time.perf_counter() - began < 20


def test_json_values_of_odd_texts(spark):
    from tablewright.sources.corpus import json_values

    texts = ["5", '"x"', "null", "[]", "{}", "[[1,[2]],{\"b\":{},\"a\":[{\"c\":1.5}]}]", "oops", None]
    got = json_values(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t", ["i"]).collect()
    assert sorted((r.i, r.seq, r.path, r.value) for r in got) == [
        (0, 0, "$", "5"), (1, 0, "$", "x"), (2, 0, "$", None), (5, 0, "$[0][0]", "1"), (5, 1, "$[0][1][0]", "2"), (5, 2, "$[1].a[0].c", "1.5"),
    ]
