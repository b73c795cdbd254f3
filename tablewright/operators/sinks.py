"""Writes: files, routed tables, keyed upsert, write modes, type inference and rejects."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablewright.operators.reshape import fill_defaults, order_columns
from tablewright.session import stage
from tablewright.specs import TableSpec

#: The file that makes a version of a table count.
_MANIFEST = "_manifest.json"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder of CSV parts per table. No row number: it is no stable key at scale."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_routed(df: DataFrame, path: str, by: str = "Destination", mode: str = "overwrite") -> None:
    """All destinations in one job, one folder each.

    Rebalancing brings a destination's rows together, so that not every task writes a file per
    destination, and splits a destination that is larger than a partition should be.
    """
    df.hint("rebalance", F.col(by)).write.mode(mode).partitionBy(by).parquet(path)


def destination(df: DataFrame, name: str, by: str = "Destination") -> DataFrame:
    return df.where(F.col(by) == name).drop(by)


def keyed(df: DataFrame, keys: Sequence[str]) -> Column:
    """True for rows that have every key: the others cannot be told apart and are rejects."""
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """Keyed replace: the newest row of each key, over both sides, with a widened schema.

    ``max_by`` combines on the map side, so a key with a third of all versions reaches its
    reducer as one row per task. ``seq`` orders rows within a side; without it a key may come in
    once only, as nothing else says which row is later. Rows without a key are not taken in.
    """
    incoming = incoming.where(keyed(incoming, keys))
    if seq is None and not incoming.groupBy(*[F.col(f"`{k}`") for k in keys]).count().where("count > 1").isEmpty():
        raise ValueError("incoming rows repeat a key: name the column that orders them as seq")
    order = F.col(seq) if seq else F.lit(0)
    both = existing.withColumn("_batch", F.lit(0)).unionByName(incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    return newest(both, keys, F.struct("_batch", order.alias("_seq")), drop=("_batch",))


def newest(rows: DataFrame, keys: Sequence[str], order: Column, drop: Sequence[str] = ()) -> DataFrame:
    """The row with the highest order of each key. Ties are settled by the row itself.

    One struct per row, order first, so each row crosses the shuffle once. Rows with a map
    column cannot be compared and go by their order alone.
    """
    rest = [c for c in rows.columns if c not in keys and c not in drop]
    values = [F.col(f"`{c}`") for c in rest]
    if any("map<" in rows.schema[c].dataType.simpleString() for c in rest):
        picked = F.max_by(F.struct(*values), order)
    else:
        picked = F.max(F.struct(order.alias("_order"), *values))
    found = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(picked.alias("_row"))
    return found.select(*[F.col(f"`{k}`") for k in keys], *[F.col("_row").getField(c).alias(c) for c in rest])


def _folder(spark: SparkSession, path: str):
    """Hadoop's view of a folder: file system and path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def _versions(spark: SparkSession, path: str, complete: bool = True) -> list[int]:
    """Versions of a table folder, oldest first (listing only, no data); those begun, too, if not ``complete``."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    if not complete:
        return sorted({int(n.split("=")[1]) for n in names if n.startswith(("v=", "_begun="))})
    done = lambda n: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/{_MANIFEST}"))
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and done(n))


def _claim(spark: SparkSession, path: str, number: int) -> None:
    """Begin a version. Of two writers that want a number one fails.

    Making the mark is atomic where the file system's exclusive create is, as on HDFS and local
    disks. Object stores look first and write then: there, writers of one table must take turns.
    """
    fs, mark = _folder(spark, f"{path}/_begun={number}")
    if not fs.createNewFile(mark):
        raise RuntimeError(f"another writer has begun version {number} of {path}")


def _newest(spark: SparkSession, path: str) -> int | None:
    return max(_versions(spark, path), default=None)


def _commit(spark: SparkSession, path: str, number: int, manifest: dict, base: int | None) -> None:
    """Make a version count: its manifest appears at once, under its name.

    Fails where another writer has made one count since ``base`` was read, as its rows are not in this one.
    """
    if _newest(spark, path) != base:
        raise RuntimeError(f"another writer has changed {path} since version {base} was read")
    fs, draft = _folder(spark, f"{path}/v={number}/{_MANIFEST}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if not fs.rename(draft, _folder(spark, f"{path}/v={number}/{_MANIFEST}")[1]):
        raise RuntimeError(f"version {number} of {path} could not be committed")


def read_manifest(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """What a version holds (the newest, unless ``number`` names one): columns, and of each bucket the version it was last written in."""
    held = _versions(spark, path) if number is None else [number]
    if not held:
        return None
    fs, file = _folder(spark, f"{path}/v={held[-1]}/{_MANIFEST}")
    stream = fs.open(file)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def _retire(spark: SparkSession, path: str, keep: int) -> None:
    """Drop complete versions but the newest ``keep``, and of their folders those whose buckets these do not hold."""
    keeping = _versions(spark, path)[-keep:]
    used = {(int(v), b) for n in keeping for b, v in read_manifest(spark, path, n)["held"].items()}
    at = lambda tail: _folder(spark, f"{path}/{tail}")[1]
    fs, folder = _folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    for number in sorted({int(n[2:]) for n in names if n.startswith("v=")} - set(keeping)):
        manifest, retired = at(f"v={number}/{_MANIFEST}"), at(f"v={number}/_retired")
        if fs.exists(manifest):
            fs.rename(manifest, retired)
        elif not fs.exists(retired):
            continue  # another writer is at it
        if not any(v == number for v, _ in used):
            fs.delete(at(f"v={number}"), True)
            fs.delete(at(f"_begun={number}"), True)
            continue
        for part in fs.listStatus(at(f"v={number}")):
            name = part.getPath().getName()
            if name.startswith("_bucket=") and (number, name[8:]) not in used:
                fs.delete(part.getPath(), True)


def _read(spark: SparkSession, path: str, manifest: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows of a version, of some buckets only if named: what each write left, in the types the table has by now."""
    schema = T.StructType.fromJson(manifest["schema"])
    wanted = {b: v for b, v in manifest["held"].items() if buckets is None or b == "" or int(b) in set(buckets)}
    found = spark.createDataFrame([], schema)
    for version in sorted(set(wanted.values())):
        folders = [f"{path}/v={version}" + (f"/_bucket={b}" if b else "") for b, v in wanted.items() if v == version]
        own = T.StructType.fromJson(manifest["schemas"][str(version)])
        found = found.unionByName(in_types(spark.read.schema(own).parquet(*folders), schema), allowMissingColumns=True)
    return found.select(*[F.col(f"`{c}`") for c in schema.fieldNames()])


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    manifest = read_manifest(spark, path)
    return None if manifest is None else _read(spark, path, manifest)


#: Types in which every number of a smaller one keeps its value.
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def joined_type(a: T.DataType, b: T.DataType, exact: bool = True) -> T.DataType:
    """The least type that values of both have: whole numbers, numbers, else text.

    ``exact``: every whole number of the column is one as a double, too; if not, they meet as text.
    """
    one, two = a.simpleString(), b.simpleString()
    if one == two or two == "void":
        return a
    if one == "void":
        return b
    if one in _WHOLE and two in _WHOLE:
        return T.LongType()
    numbers = (*_WHOLE, "float", "double")
    if one in numbers and two in numbers:
        return T.DoubleType() if exact else T.StringType()
    return T.StringType()


def as_text(c: Column, kind: T.DataType) -> Column:
    """A value as text that keeps it: whole numbers without a fraction, nested values as JSON."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when((c == F.floor(c)) & (F.abs(c) < 1e15), c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def in_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns that ``schema`` has, too, in its types, which are as wide as theirs or wider."""
    to = {f.name: f.dataType for f in schema}
    changed = {f.name: to[f.name] for f in df.schema if f.name in to and to[f.name].simpleString() != f.dataType.simpleString()}
    return df.withColumns({n: as_text(F.col(f"`{n}`"), df.schema[n].dataType) if isinstance(t, T.StringType) else F.col(f"`{n}`").cast(t) for n, t in changed.items()})


def joined_schema(held: DataFrame, rows: DataFrame) -> T.StructType:
    """The columns of both, each in the least type that all its values have.

    Reads data only where whole numbers meet others: then the largest of each such column.
    """
    mine, theirs = ({f.name: f.dataType for f in df.schema} for df in (held, rows))
    mixed = [n for n in mine if n in theirs and joined_type(mine[n], theirs[n], True) != joined_type(mine[n], theirs[n], False)]
    exact = dict.fromkeys(mixed, True)
    for df in (held, rows):
        whole = [n for n in mixed if df.schema[n].dataType.simpleString() in _WHOLE]
        if whole:
            fits = df.agg(*[F.coalesce(F.max(F.col(f"`{n}`").cast("bigint").between(-(2**53), 2**53) == F.lit(False)), F.lit(False)).alias(n) for n in whole]).first()
            exact.update({n: exact[n] and not fits[n] for n in whole})
    names = [*mine, *[n for n in theirs if n not in mine]]
    return T.StructType([T.StructField(n, joined_type(mine.get(n, theirs.get(n)), theirs.get(n, mine.get(n)), exact.get(n, True))) for n in names])


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, path: str, number: int) -> None:
    """Rows by bucket, a bucket's together and split only where it is large."""
    df.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{path}/v={number}")


def save(
    df: DataFrame,
    spec: TableSpec,
    root: str,
    mode: str = "write",
    seq: str | None = None,
    defaults: Mapping[str, str] | None = None,
    columns: Sequence[str] = (),
    keep: int | None = None,
    batch: tuple[str, int] | None = None,
) -> DataFrame | None:
    """Write a table in one of three modes and return what it then holds.

    ``remake`` keeps the new rows only, ``write`` merges them into the held ones (columns that
    are new to the table widen it, unless the table is closed), ``read`` writes nothing. Rows lie in
    ``buckets`` of the spec by their key, and a write reads and rewrites those it has keys of; a
    manifest says where each bucket was written last. Where a column's values are of several types
    over the versions it gets the least that all have (see ``joined_type``), and no write fails on it.

    A version counts once its manifest is there, so readers of the old one are not disturbed; a
    writer that meets another one, or finds that one has committed in between, fails and may try again. ``keep`` drops versions older than so
    many. ``batch``, a stream's name and the number of its batch, is committed with the version: a
    batch that the table has already is not written again. Rows without a key go to
    ``<name>_rejects``, rows with a value that is not of its declared type to ``<name>_misfits``.
    """
    spark = df.sparkSession
    path = f"{root}/{spec.name}"
    base_version = _newest(spark, path)
    manifest = None if base_version is None else read_manifest(spark, path, base_version)
    if mode == "read":
        return None if manifest is None else _read(spark, path, manifest)
    if mode not in ("write", "remake"):
        raise ValueError(f"unknown mode: {mode}")
    batches = dict(manifest["batches"]) if manifest else {}
    if batch is not None and batches.get(batch[0], -1) >= batch[1]:
        return _read(spark, path, manifest)
    marked = stage(df.withColumn("_misfit", spec.misfit(df)), "incoming")
    rows = fill_defaults(spec.shaped(marked.where("_misfit IS NULL").drop("_misfit")), defaults or {})
    number = max([0, *_versions(spark, path, complete=False)]) + 1
    _claim(spark, path, number)
    misfits = marked.where("_misfit IS NOT NULL")
    if not misfits.isEmpty():
        misfits.withColumnRenamed("_misfit", "reason").write.parquet(f"{root}/{spec.name}_misfits/v={number}")
    keyless = rows.where(~keyed(rows, spec.keys))
    if not keyless.isEmpty():
        keyless.write.parquet(f"{root}/{spec.name}_rejects/v={number}")
    rows = rows.where(keyed(rows, spec.keys))
    old = manifest if mode == "write" else None
    held = _read(spark, path, old) if old else rows.limit(0)
    schema = joined_schema(held, rows)
    buckets = old["buckets"] if old else spec.buckets
    rows = in_types(rows, schema)
    # Buckets go by the text of a key: where its type changes, all are dealt anew.
    dealt_anew = old is not None and any(held.schema[k].dataType.simpleString() != schema[k].dataType.simpleString() for k in spec.keys if k in held.columns)
    # As many numbers as there are buckets at most.
    touched = sorted(r[0] for r in rows.select(_bucket(spec.keys, buckets)).distinct().collect())
    base = _read(spark, path, old, None if dealt_anew else touched) if old else rows.limit(0)
    merged = order_columns(upsert(in_types(base, schema), rows, spec.keys, seq), columns)
    _write_buckets(merged.withColumn("_bucket", _bucket(spec.keys, buckets)), path, number)
    written = _written(spark, path, number)
    kept = old["held"] if old and not dealt_anew else {}
    if batch is not None:
        batches[batch[0]] = batch[1]
    where = {**kept, **{str(b): number for b in written}}
    order = [*merged.columns, *[c for c in schema.fieldNames() if c not in merged.columns]]
    shape = T.StructType([schema[c] for c in order])
    schemas = {**(old["schemas"] if old else {}), str(number): merged.schema.jsonValue()}
    _commit(spark, path, number, {
        "buckets": buckets, "held": where, "schema": shape.jsonValue(), "schemas": {str(v): schemas[str(v)] for v in {*where.values(), number}}, "batches": batches,
    }, base_version)
    if keep:
        _retire(spark, path, keep)
    return read_current(spark, path)


def _written(spark: SparkSession, path: str, number: int) -> list[int]:
    """Buckets that a version has folders of."""
    fs, folder = _folder(spark, f"{path}/v={number}")
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("_bucket="))


def compact(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame | None:
    """Write all buckets of a table into one version and drop the others; rows, types and batches stay."""
    path = f"{root}/{spec.name}"
    base = _newest(spark, path)
    if base is None:
        return None
    manifest = read_manifest(spark, path, base)
    rows = _read(spark, path, manifest)
    number = max([0, *_versions(spark, path, complete=False)]) + 1
    _claim(spark, path, number)
    _write_buckets(rows.withColumn("_bucket", _bucket(spec.keys, manifest["buckets"])), path, number)
    held = {str(b): number for b in _written(spark, path, number)}
    _commit(spark, path, number, {**manifest, "held": held, "schemas": {str(number): manifest["schema"]}}, base)
    _retire(spark, path, 1)
    return read_current(spark, path)


def save_rejects(df: DataFrame, path: str) -> None:
    """Rows that no table takes, if there are any, as a version of their own."""
    if not df.isEmpty():
        spark = df.sparkSession
        number = max([0, *_versions(spark, path, complete=False)]) + 1
        _claim(spark, path, number)
        df.write.parquet(f"{path}/v={number}")
        _commit(spark, path, number, {"buckets": 0, "held": {"": number}, "schema": df.schema.jsonValue(), "schemas": {str(number): df.schema.jsonValue()}, "batches": {}}, _newest(spark, path))


def inferred_types(kv: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Type of each key over *all* its values: whole numbers, numbers, else text."""
    given = kv.where(F.col(value).isNotNull())
    return given.groupBy(key).agg(
        F.when(F.every(F.col(value).try_cast("bigint").isNotNull()), F.lit("INTEGER"))
        .when(F.every(F.col(value).try_cast("double").isNotNull()), F.lit("REAL"))
        .otherwise(F.lit("TEXT"))
        .alias("type")
    )


def cast_inferred(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast text columns to the type all of their values have. Reads one row of flags."""
    tests = []
    for c in columns:
        col = F.col(f"`{c}`")
        for kind in ("bigint", "double"):
            tests.append(F.every(col.isNull() | col.try_cast(kind).isNotNull()).alias(f"{kind}:{c}"))
        tests.append(F.every(col.isNull()).alias(f"empty:{c}"))
    flags = df.agg(*tests).first().asDict() if tests else {}
    chosen = {
        c: next((k for k in ("bigint", "double") if flags[f"{k}:{c}"] and not flags[f"empty:{c}"]), None) for c in columns
    }
    return df.withColumns({c: F.col(f"`{c}`").try_cast(k) for c, k in chosen.items() if k})


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the others with the first rule they break. The input is evaluated once and written."""
    broken = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in rules.items()])
    marked = stage(df.withColumn("reason", broken), "judged")
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())
