"""Encoding and decoding with the pieces of a given SentencePiece model, by a Viterbi pass shared between words.

Texts are cut into words that carry their leading spaces as marks; no piece reaches across such a
cut. The distinct words of many texts are sorted, which lays them out as a depth-first walk of
their trie, and the forward pass of a word starts where it leaves the prefix of the word before:
what was found for a prefix holds for every word that begins with it.

What the forward pass keeps per prefix depends on the model. For a unigram model it is the best
sum of scores and the piece it ends with. For a merge model (BPE) sums of scores are not what the
model means: there a segmentation counts only if no merge across one of its cuts would have come
first, which can be told from each two neighbouring pieces alone, and one segmentation of every
prefix survives. This gives the ids of the SentencePiece library. So do best sums, which are made
here in doubles word by word, as long as the library's single-precision sums over a whole text lose
no digits; beyond that the sums here are the better ones.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import lean

MARK = "▁"
#: Bytes of text encoded at a time, which take some 60 times as much; words, neighbouring pieces and steps from prefix
#: to prefix that a worker remembers, some 80 MB.
CHUNK, REMEMBERED, PAIRS, STEPS = 2 << 20, 100_000, 250_000, 250_000
#: Characters of a word whose prefixes have their ids at hand; numbers of pieces and other characters stay below the other.
LONG, SPAN = 64, 1 << 21


@dataclass(frozen=True)
class Vocabulary:
    """The pieces of a model, in the order of their ids. Sent with the tasks; the file stays where it is."""

    pieces: list[str]
    scores: list[float]
    #: Of each id: "normal", "byte", "unknown" or "control".
    kinds: list[str]
    merges: bool

    @staticmethod
    def read(path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only models that leave texts as they are and add a leading mark are supported")
        if model.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and merge models are supported")
        names = {1: "normal", 2: "unknown", 3: "control", 6: "byte"}
        if any(p.type not in names for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        found = Vocabulary([p.piece for p in model.pieces], [p.score for p in model.pieces], [names[p.type] for p in model.pieces], model.trainer_spec.model_type == 2)
        if any(MARK in p.lstrip(MARK) for p, kind in zip(found.pieces, found.kinds, strict=True) if kind == "normal"):
            raise ValueError("a piece reaches from one word into the next")
        return found


class Encoder:
    """Pieces of sorted words; lives in a worker and remembers what it has found."""

    def __init__(self, vocabulary: Vocabulary):
        rows = list(zip(vocabulary.pieces, vocabulary.scores, vocabulary.kinds, strict=True))
        self.id_of = {p: i for i, (p, _, kind) in enumerate(rows) if kind == "normal"}
        self.score_of = {p: s for p, s, kind in rows if kind == "normal"}
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(rows) if kind == "byte"}
        self.unknown = next((i for i, (_, _, kind) in enumerate(rows) if kind == "unknown"), 0)
        self.merges = vocabulary.merges
        self.least = min(self.score_of.values(), default=0.0) - 10
        # Lengths of pieces by their last two characters, longest first.
        lengths: dict[str, set[int]] = {}
        for p in self.id_of:
            lengths.setdefault(p[-2:], set()).add(len(p))
        self.lengths = {end: sorted(found, reverse=True) for end, found in lengths.items() if len(end) == 2}
        # A line end is a word of its own if no piece holds one.
        self.lines_apart = not any("\n" in p for p in self.id_of)
        # Pieces by number, from 1, then characters that are none; their texts, ids (four bytes each) and lengths.
        self.number = {p: k for k, p in enumerate(self.id_of, 1)}
        self.texts = ["", *self.id_of]
        self.coded = [b"", *(array("i", [i]).tobytes() for i in self.id_of.values())]
        self.sizes = [*map(len, self.texts)]
        # Whether merging leaves the cut between two pieces, by both numbers; 0 and a piece: whether it makes the piece.
        self.fitting: dict[int, bool] = {}
        # Where a prefix of a word stands: at the longest of its ends that a piece begins with. Made when first reached.
        self.begun: dict[str, dict | None] = dict.fromkeys(p[:n] for p in ["", *self.id_of] for n in range(len(p) + 1)) if self.merges else {}
        self.steps = 0
        # Ids of a word, four bytes each.
        self.known: dict[str, bytes] = {}
        self.surface = [(p.replace(MARK, " ").encode() if kind == "normal" else bytes([int(p[3:5], 16)]) if kind == "byte" else b"" if kind == "control" else " ⁇ ".encode()) for p, _, kind in rows]

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge neighbours, best score first and leftmost among equals, until no pair is a piece."""
        symbols = list(symbols)
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.score_of.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def fits(self, before: int, piece: int) -> bool:
        """Whether merging would leave the cut between two pieces, or make the second where there is none before."""
        if len(self.fitting) > PAIRS:
            self.fitting.clear()
        cut = [t for t in (self.texts[before], self.texts[piece]) if t]
        found = self.fitting[before * SPAN + piece] = self.merged(list("".join(cut))) == cut
        return found

    def place(self, name: str) -> dict:
        """Steps from the place of this name, by character; under "" its name and the pieces of two and more characters that it ends with, longest first."""
        found = self.begun[name]
        if found is None:
            ends = [(len(name) - i, self.number[name[i:]]) for i in range(len(name) - 1) if name[i:] in self.number]
            found = self.begun[name] = {"": (name, ends)}
        return found

    def step(self, place: dict, character: str) -> tuple[dict, list[tuple[int, int]], int]:
        """The place that a character leads to, the pieces that end there, and the number of the character."""
        if self.steps > STEPS:
            self.begun, self.steps = dict.fromkeys(self.begun), 0
        self.steps += 1
        name = place[""][0] + character
        while name not in self.begun:
            name = name[1:]
        to = self.place(name)
        number = self.number.get(character)
        if number is None:
            number = self.number[character] = len(self.texts)
            self.texts.append(character)
            self.coded.append(array("i", self.ids(character)).tobytes())
            self.sizes.append(1)
        found = place[character] = (to, to[""][1], number)
        return found

    def last_best(self, word: str, end: int, best: list[float]) -> tuple[float, str]:
        """The best sum of this prefix and the piece that it ends with; the longer piece of equals."""
        value, piece = best[end - 1] + self.score_of.get(word[end - 1], self.least), word[end - 1]
        for n in reversed(self.lengths.get(word[max(0, end - 2) : end], ())):
            if 1 < n <= end:
                score = self.score_of.get(word[end - n : end])
                if score is not None and best[end - n] + score >= value:
                    value, piece = best[end - n] + score, word[end - n : end]
        return value, piece

    def merge_sorted(self, words: list[str]) -> list[bytes]:
        """``coded_sorted`` for a merge model.

        The surviving segmentation of a prefix ends with the longest piece whose cut from the piece before it
        merging would leave (or that merging makes, where it begins the word), else with its last character.
        """
        coded, fitting, sizes = self.coded, self.fitting, self.sizes
        out: list[bytes] = []
        before = ""
        # Of each prefix: its place, the number of its last piece and, up to LONG characters, its ids.
        places, last, done = [self.place("")], [0], [b""]
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del places[shared + 1 :], last[shared + 1 :], done[shared + 1 :]
            place = places[shared]
            for end in range(shared + 1, len(word) + 1):
                character = word[end - 1]
                found = place.get(character)
                place, ends, piece = self.step(place, character) if found is None else found
                n = 1
                for size, longer in ends:
                    left = last[end - size]
                    fit = fitting.get(left * SPAN + longer)
                    if self.fits(left, longer) if fit is None else fit:
                        n, piece = size, longer
                        break
                places.append(place)
                last.append(piece)
                if end <= LONG:
                    done.append(done[end - n] + coded[piece])
            end, rest = len(word), []
            while end > LONG:
                rest.append(coded[last[end]])
                end -= sizes[last[end]]
            out.append(done[end] + b"".join(reversed(rest)) if rest else done[end])
            before = word
        return out

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Ids of sorted words."""
        return [array("i", ids).tolist() for ids in self.coded_sorted(words)]

    def coded_sorted(self, words: list[str]) -> list[bytes]:
        """Ids of sorted words, four bytes each: a depth-first walk of their trie, each prefix looked at once."""
        if self.merges:
            return self.merge_sorted(words)
        out: list[bytes] = []
        before = ""
        last: list = [None]
        best = [0.0]
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                value, piece = self.last_best(word, end, best)
                best.append(value)
                last.append(piece)
            pieces, end = [], len(word)
            while end:
                pieces.append(last[end])
                end -= len(last[end])
            out.append(array("i", [i for p in reversed(pieces) for i in self.ids(p)]).tobytes())
            before = word
        return out

    def ids(self, piece: str) -> list[int]:
        found = self.id_of.get(piece)
        if found is not None:
            return [found]
        return [self.byte_id[b] for b in piece.encode()] if self.byte_id else [self.unknown]

    def encode_distinct(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, four bytes each, new ones through the trie."""
        new = sorted(w for w in words if w not in self.known)
        fresh = dict(zip(new, self.coded_sorted(new), strict=True))
        out = [fresh[w] if w in fresh else self.known[w] for w in words]
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
        if len(fresh) <= REMEMBERED:
            self.known.update(fresh)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts in one array, and where each text's ids begin and end in it."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")
        # The leading mark; an empty text stays empty.
        marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise("", texts, " ")).cast(pa.large_binary())
        bounds = np.frombuffer(marked.buffers()[1], np.int64, len(marked) + 1, marked.offset * 8)
        data = np.frombuffer(marked.buffers()[2] or b"", np.uint8)[: bounds[-1]]
        if bounds[-1] == bounds[0]:
            return np.zeros(0, np.int32), np.zeros(len(marked) + 1, np.int64)
        space = data == 32
        begins = space & ~np.r_[False, space[:-1]]
        if self.lines_apart:
            line = data == 10
            begins |= line | np.r_[False, line[:-1]]
        begins[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts = np.nonzero(begins)[0]
        starts = starts[starts >= bounds[0]]
        offsets = pa.array(np.r_[starts, bounds[-1]].astype(np.int64))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, offsets.buffers()[1], marked.buffers()[2]]).dictionary_encode()
        index = words.indices.to_numpy()
        found = self.encode_distinct(pc.replace_substring(words.dictionary.cast(pa.large_string()), " ", MARK).to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.int32)
        first = np.r_[0, np.cumsum(sizes)[:-1]]
        per_word = sizes[index]
        ends = np.r_[0, np.cumsum(per_word)]
        ids = flat[np.repeat(first[index] - ends[:-1], per_word) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(starts, bounds)]

    def round_trips(self, ids: np.ndarray, bounds: np.ndarray, texts: pa.Array) -> pa.Array:
        """Whether each text comes back from its ids, which ``bounds`` part."""
        marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise("", texts, " ")).cast(pa.large_binary())
        decoded = pa.array(self.surface, pa.large_binary()).take(pa.array(ids))
        places = np.frombuffer(decoded.buffers()[1], np.int64, len(decoded) + 1, decoded.offset * 8)[bounds]
        back = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(places), decoded.buffers()[2]])
        return pc.equal(back, marked)

    def decode(self, ids: list[int]) -> str:
        """The text of some ids, without the leading mark."""
        data = b"".join([self.surface[i] for i in ids])
        return data.removeprefix(b" ").decode("utf-8", "replace")


def in_pieces(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``CHUNK`` bytes in column ``place``, however many bytes come at once; a row stays whole."""
    waiting, held = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
        begun = 0
        for end, size in enumerate(sizes.tolist(), 1):
            held += size
            if held >= CHUNK:
                waiting.append(batch.slice(begun, end - begun))
                yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting, held, begun = [], 0, end
        if begun < batch.num_rows:
            waiting.append(batch.slice(begun))
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


_encoders: dict[int, Encoder] = {}


def encoder_of(vocabulary: Vocabulary, key: int) -> Encoder:
    """One encoder a worker process, kept from task to task with what it remembers."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def encode_texts(docs: DataFrame, model_path: str, column: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids and round_trip in place of columns of these names.

    Whole texts are encoded as the SentencePiece library would with this model, then decoded again;
    ``round_trip`` says that the same text came back. It is false only for texts that hold the mark
    itself (U+2581), which reads as a space. A missing text counts as empty: no ids, a round trip.
    Ties of scores go to the longer last piece. Repeated rows get equal ids; empty tables give no
    rows. Very long texts are cut at words, so they cost what as many short ones would. Only the
    text travels to Python along with the columns that come back with it.
    """
    vocabulary = Vocabulary.read(model_path)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    key = hash((model_path, len(vocabulary.pieces)))
    docs = docs.drop("n_tokens", "ids", "round_trip")
    place = docs.columns.index(column)
    more = T.StructType().add("n_tokens", T.IntegerType()).add("ids", T.ArrayType(T.IntegerType())).add("round_trip", T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *more.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value, key)
        for batch in in_pieces(batches, place):
            texts = batch.column(place)
            ids, bounds = encoder.encode(texts)
            same = encoder.round_trips(ids, bounds, pc.fill_null(texts, ""))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            columns = [*batch.columns, pa.array(np.diff(bounds), pa.int32()), lists, same]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "n_tokens", "ids", "round_trip"])

    return docs.mapInArrow(lean(run), schema)


def decode_ids(encoded: DataFrame, model_path: str, column: str = "ids") -> DataFrame:
    """``encoded`` with the text of its ids as ``text``.

    Missing ids give a missing text, no ids an empty one; repeated rows get equal texts, an empty
    table stays empty. An input column ``text`` is replaced.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(model_path))
    key = hash((model_path, len(shared.value.pieces)))
    encoded = encoded.drop("text")
    place = encoded.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value, key)
        for batch in batches:
            texts = [None if ids is None else encoder.decode(ids) for ids in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return encoded.mapInArrow(lean(run), T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())]))


def token_rows(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip of every document."""
    return encode_texts(docs.select("doc_id", "text"), model_path).drop("text").select("doc_id", F.col("n_tokens"), "ids", "round_trip")
