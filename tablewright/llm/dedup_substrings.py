"""Removal of repeated passages of at least 100 bytes, by suffix order.

Every string of 100 bytes is put down to one of its 69 grams of 32 bytes, the one whose hash is
smallest: equal strings choose equal grams at equal places. Neighbouring strings mostly share their
gram, and together they span a region of text. Only regions whose gram occurs again can repeat
anything; of equal regions the first stands for all, in every batch before the shuffle and then
among all batches, and the others are repeats as they are.

The regions that are left are cut once more by grams of 64 bytes, chosen in the same way, and dealt
by those, so equal strings meet in one shard: what many texts share but for its surroundings has one
short gram, but as many long ones as surroundings. A shard's regions, in the order of their documents, are one text whose suffixes are put in order by
``induced.py``. Strings that share 100 bytes lie side by side there; all but the first are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import IO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import induced
from tablewright.llm.common import written

LENGTH, GRAM, LONG_GRAM = induced.DEPTH, 32, 64
#: Bytes of text, and regions, looked at at a time.
PIECE, CUT = 1 << 20, 4096
#: Stands for a missing doc_id: it comes after all others.
NO_ID = 2**63 - 1

_random = np.random.default_rng(4)
_BYTE = _random.integers(0, 2**64, 256, np.uint64)
_DOUBLE = _random.integers(0, 2**63, 6, np.uint64) * np.uint64(2) + np.uint64(1)

#: kind 0: a region that stands for its equals; 1: repeated strings; 2: a region to be compared.
#: ``place`` packs where a region starts, how far in its gram is and how many strings it has.
FOUND = "kind int, gram long, content long, doc long, twin long, place long"
NAMES = ["kind", "gram", "content", "doc", "twin", "place"]


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(start: np.ndarray, inside: np.ndarray, strings: np.ndarray) -> np.ndarray:
    return (start << 14) | (inside << 7) | strings


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where regions start and how many strings they have."""
    return place >> 14, place & 127


def regions(data: np.ndarray, bounds: np.ndarray, length: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of texts that lie one after the other: text, start, gram's place inside, strings, gram, content."""
    n, choices = len(data), LENGTH - length + 1
    if n < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    gram, size = _BYTE[data], 1
    for factor in _DOUBLE[: length.bit_length() - 1]:
        gram = gram[:-size] * factor + gram[size:]
        size *= 2
    gram = scrambled(gram)
    # Hash above, place below: the smallest is the leftmost of the smallest hashes.
    least = (gram >> np.uint64(24) << np.uint64(24)) | np.arange(len(gram), dtype=np.uint64)
    width = 1
    while 2 * width <= choices:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = choices - width
    chosen = (np.minimum(least[:-rest], least[rest:]) & np.uint64(0xFFFFFF)).astype(np.int64)
    # Strings that lie within one text.
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = np.nonzero(text[: len(chosen)] == text[LENGTH - 1 : LENGTH - 1 + len(chosen)])[0]
    if not len(inside):
        return regions(data[:0], bounds[:1], length)
    chosen, owner = chosen[inside], text[inside]
    cut = np.r_[True, (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])]
    first = np.nonzero(cut)[0]
    strings = np.diff(np.r_[first, len(inside)])
    start, anchor = inside[first], chosen[first]
    content = scrambled((anchor - start).astype(np.uint64) * np.uint64(128) + strings.astype(np.uint64))
    last = start + strings - 1 + LENGTH - length
    for step in range(0, LENGTH + choices - length, length):
        content = scrambled(content + gram[np.minimum(start + step, last)])
    content = scrambled(content + gram[last])
    return owner[first], start - bounds[owner[first]], anchor - start, strings, gram[anchor], content


def pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in pieces of bounded size: bytes, bounds, which text, and where in it; long texts overlap by what a string needs."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + PIECE, side="right")) - 1)
        j = min(j, len(texts))
        if j > i + 1 or bounds[j] - bounds[i] <= PIECE:
            yield data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], np.arange(i, j), np.zeros(j - i, np.int64)
        else:
            for lo in range(int(bounds[i]), int(bounds[j]), PIECE):
                hi = min(lo + PIECE + LENGTH - 1, int(bounds[j]))
                yield data[lo:hi], np.array([0, hi - lo]), np.array([i]), np.array([lo - bounds[i]])
        i = j


def batch_of(*columns: np.ndarray) -> pa.RecordBatch:
    kinds = (pa.int32(), *[pa.int64()] * 5)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def find_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All regions of some documents (doc, twin, text); of equal ones in a batch only the first stands."""
    for batch in batches:
        docs, twins = (batch.column(i).to_numpy() for i in (0, 1))
        found = []
        for data, bounds, rows, offset in pieces(batch.column(2)):
            owner, start, inside, strings, gram, content = regions(data, bounds)
            found.append((docs[rows][owner], twins[rows][owner], pack(start + offset[owner], inside, strings), gram.view(np.int64), content.view(np.int64)))
        if not found:
            continue
        doc, twin, place, gram, content = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((place, twin, doc, content, gram))
        doc, twin, place, gram, content = (x[order] for x in (doc, twin, place, gram, content))
        same = np.r_[False, (gram[1:] == gram[:-1]) & (content[1:] == content[:-1])] if len(gram) else np.zeros(0, bool)
        yield without_twins(batch_of(same.astype(np.int32), gram, content, doc, twin, place))


def without_twins(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Sorted rows without those of a whole row that repeats: they are one document, not two."""
    gram, content, doc, twin, place = (batch.column(i).to_numpy() for i in range(1, 6))
    again = np.zeros(len(doc), bool)
    again[1:] = (gram[1:] == gram[:-1]) & (content[1:] == content[:-1]) & (doc[1:] == doc[:-1]) & (twin[1:] == twin[:-1]) & (place[1:] == place[:-1])
    return batch.filter(pa.array(~again))


def merge_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by gram, content and document. Of equal regions the first stands; it is to be
    compared (kind 2) if its gram has other regions, the rest are repeats (kind 1)."""
    # The last row of the batch before, and the first region of its gram while it is the only one.
    before, alone = None, None
    for batch in batches:
        kind, gram, content, doc, twin, place = (batch.column(i).to_numpy() for i in range(6))
        done = kind == 1
        if done.any():
            yield batch.filter(pa.array(done))
            kind, gram, content, doc, twin, place = (x[~done] for x in (kind, gram, content, doc, twin, place))
        if not len(gram):
            continue
        if before is None:
            before = (None,) * 5
        rows = np.stack([gram, content, doc, twin, place])
        earlier = np.concatenate([np.array([[x if x is not None else 0] for x in before], np.int64), rows[:, :-1]], axis=1)
        equal = rows == earlier
        equal[:, 0] &= before[0] is not None
        same_gram, same_content = equal[0], equal[0] & equal[1]
        twins = equal.all(0)
        repeated = same_content & ~twins
        heads = np.nonzero(~same_content)[0]
        # A head is compared if another head of its gram comes before or after it.
        joined = same_gram[heads]
        several = joined | np.r_[joined[1:], False]
        if alone is not None and len(heads) and joined[0]:
            yield batch_of(*[np.array([x]) for x in (2, *alone)])
        if len(heads):
            tail = heads[-1]
            alone = None if several[-1] else tuple(rows[:, tail])
        compared = heads[several]
        out = np.r_[np.nonzero(repeated)[0], compared]
        kinds = np.r_[np.ones(int(repeated.sum()), np.int32), np.full(len(compared), 2, np.int32)]
        yield batch_of(kinds, *rows[:, out])
        before = tuple(int(x) for x in rows[:, -1])


def cut_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions of documents (doc, twin, places, text), cut by long grams, with their bytes."""

    def made(held: list[tuple]) -> pa.RecordBatch:
        *longs, parts = zip(*held, strict=True)
        arrays = [pa.array(np.concatenate(x), pa.int64()) for x in longs]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([d for p in parts for d in p], pa.binary())], ["gram", "doc", "twin", "place", "data"])

    held: list[tuple] = []
    waiting = 0
    for batch in batches:
        for doc, twin, place, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            whole = text.encode()
            starts, counts = unpack(np.array(place, np.int64))
            for lo in range(0, len(starts), CUT):
                start, strings = starts[lo : lo + CUT], counts[lo : lo + CUT]
                data = b"".join(whole[a : a + n + LENGTH - 1] for a, n in zip(start.tolist(), strings.tolist(), strict=True))
                bounds = np.r_[0, np.cumsum(strings + LENGTH - 1)]
                owner, at, inside, some, gram, _ = regions(np.frombuffer(data, np.uint8), bounds, LONG_GRAM)
                first = bounds[owner] + at
                parts = [data[a:b] for a, b in zip(first.tolist(), (first + some + LENGTH - 1).tolist(), strict=True)]
                held.append((gram.view(np.int64), np.full(len(gram), doc), np.full(len(gram), twin), pack(start[owner] + at, inside, some), parts))
                waiting += len(parts)
                if waiting >= CUT:
                    yield made(held)
                    held, waiting = [], 0
    if held:
        yield made(held)


def written_to(file: IO[bytes], kind: type) -> np.ndarray:
    """What a file holds, in memory or beyond a limit in the file."""
    file.flush()
    size = file.tell()
    file.seek(0)
    return np.memmap(file, kind, "r") if size > induced.MEMORY else np.frombuffer(file.read(), kind)


def compare_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's regions (doc, twin, place, data), in document order: its repeated strings as runs.

    The shard's text and the numbers of its regions go to unnamed files of this task as they
    arrive. The files are gone when the task ends, however it ends.
    """
    import tempfile

    with tempfile.TemporaryFile() as file, tempfile.TemporaryFile() as numbers:
        count = 0
        for batch in batches:
            doc, twin, place = (batch.column(i).to_numpy() for i in range(3))
            for data in batch.column(3).to_pylist():
                # Bytes plus one, as zero ends a region; UTF-8 has no byte of 255.
                file.write((np.frombuffer(data, np.uint8) + np.uint8(1)).tobytes() + b"\0")
            numbers.write(np.stack([doc, twin, place], axis=1).astype(np.int64).tobytes())
            count += batch.num_rows
        if not count:
            return
        of_regions = written_to(numbers, np.int64).reshape(count, 3)
        size = file.tell()
        file.write(bytes(LENGTH + induced.WORD))
        whole = written_to(file, np.uint8)
        at, ends = induced.room(count, np.int64), 0
        owned = induced.room(size, bool)
        for lo in range(0, count, 1 << 16):
            strings = unpack(of_regions[lo : lo + (1 << 16), 2])[1]
            first = ends + np.cumsum(strings + LENGTH) - (strings + LENGTH)
            at[lo : lo + (1 << 16)] = first
            ends = int(first[-1] + strings[-1] + LENGTH)
            owned[np.repeat(first - (np.cumsum(strings) - strings), strings) + np.arange(strings.sum())] = True
        again = induced.repeats(whole, size, owned)
        # Runs of neighbouring repeated strings; a region's last place is never one.
        for lo in range(0, size, induced.MEMORY):
            flags = again[lo : lo + induced.MEMORY]
            step = np.diff(np.r_[0, flags.astype(np.int8), 0])
            opens, closes = np.nonzero(step == 1)[0] + lo, np.nonzero(step == -1)[0] + lo
            of = np.searchsorted(at, opens, side="right") - 1
            doc, twin, place = of_regions[of].T
            columns = (doc, twin, unpack(place)[0] + opens - at[of], closes - opens)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "twin", "start", "strings"])


def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (doc_id, text, starts, counts of repeated strings) without the bytes those cover."""
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for doc_id, text, starts, strings in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = (text or "").encode()
            kept, spans = [], []
            reached = 0
            for a, n in sorted(zip(starts or [], strings or [], strict=True)):
                b = a + n + LENGTH - 1
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(b, spans[-1][1])
                else:
                    spans.append([a, b])
            for a, b in spans:
                kept.append(data[reached:a])
                reached = b
            kept.append(data[reached:])
            rest = b"".join(kept)
            for column, value in zip(out, (doc_id, len(data), len(data) - len(rest), spans, rest), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc, twin and text: what orders a document, of every row and of every document once.

    ``twin`` tells texts of one doc_id apart, if there are any.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    alone = docs.groupBy(doc.alias("doc")).count().where("count > 1").isEmpty()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(doc.alias("doc"), (F.lit(0).cast("long") if alone else F.xxhash64(text)).alias("twin"), text.alias("text"))
    return rows, rows if alone else rows.dropDuplicates(["doc", "twin"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """Every document without its repeated bytes: doc_id, n_bytes, n_removed, spans, kept.

    A byte goes if a string of 100 bytes that covers it also starts earlier: in a document with a
    smaller doc_id, or before it in its own, also where the two overlap. Strings are looked for in
    the texts as given, not in what is left of them, and never reach from one text into another.
    ``spans`` are the longest runs of removed bytes, each as start and end; ``kept`` the other bytes.

    Texts are compared as UTF-8; a missing text is empty. A missing doc_id comes after all others;
    texts that share a doc_id are ordered by a hash, and whole rows that repeat are one document
    with one result each. Texts shorter than 100 bytes stay whole. Empty tables give no rows; other
    columns are not read.
    """
    texts, once = named(docs)
    found = texts.mapInArrow(find_regions, FOUND)
    # Regions meet by gram; repeats that are known already only pass by.
    dealt = found.withColumn("deal", F.when(F.col("kind") == 0, F.col("gram")).otherwise(F.xxhash64("doc", "place")))
    merged = dealt.repartition("deal").drop("deal").sortWithinPartitions("gram", "content", "doc", "twin", "place").mapInArrow(merge_regions, FOUND)
    merged = written(merged.drop("content"), "regions")

    # A document has as many regions as its length allows.
    per_doc = merged.where("kind = 2").groupBy("doc", "twin").agg(F.collect_list("place").alias("places"))
    shards = (
        per_doc.join(once, ["doc", "twin"]).select("doc", "twin", "places", "text")
        .mapInArrow(cut_regions, "gram long, doc long, twin long, place long, data binary")
        .repartition("gram")
        .sortWithinPartitions("doc", "twin", "place")
    )
    compared = shards.select("doc", "twin", "place", "data").mapInArrow(compare_regions, "doc long, twin long, start long, strings long")
    whole = merged.where("kind = 1").select("doc", "twin", F.shiftright("place", 14).alias("start"), F.col("place").bitwiseAND(F.lit(127)).alias("strings"))
    runs = written(whole.unionByName(compared), "repeats")

    spans = runs.groupBy("doc", "twin").agg(F.collect_list("start").alias("starts"), F.collect_list("strings").alias("strings"))
    every = texts.join(spans, ["doc", "twin"], "left").select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "text", "starts", "strings")
    return every.mapInArrow(cleaned, "doc_id long, n_bytes long, n_removed long, spans array<array<long>>, kept binary")
