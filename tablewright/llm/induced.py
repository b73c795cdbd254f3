"""Suffix order and common prefixes of one shard of text, by induced sorting on disk-backed queues.

Strings are told apart to ``DEPTH`` bytes only. A text is bytes plus one, with zeros between its
parts. Suffixes that are smaller than the one after them are S, the others L; an S suffix after an L
suffix is a seed. Seeds are ordered first; then one pass over the smallest characters up puts every
L suffix behind the suffix that follows it, and one pass down puts every S suffix before it.

What waits to be looked at sits in a queue ordered by first character and then by arrival, which is
the order of its suffixes: position and common prefix with the entry before, in memory up to a
limit and in an unnamed file beyond it. A pass takes entries in blocks. The common prefix of two
suffixes of which one induces the other's place is one more than the least common prefix between
the suffixes that follow them, so both passes carry it along and never compare texts again.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np

#: Longest common prefix that is told apart; characters of a seed looked at at a time.
DEPTH, WORD = 100, 8
#: Entries in a block, and bytes of a text or a queue that stay in memory.
BLOCK, MEMORY = 1 << 18, 64 << 20
#: Bytes that ordering a seed in memory takes, and seeds that splitters are drawn from.
SEED_BYTES, SAMPLE = 128, 8192
ENTRY = np.dtype([("at", np.int64), ("common", np.uint8)])
SYMBOLS = 257


class Queue:
    """Entries by first character, each character's in order of arrival."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.held = memory, 0
        self.parts: list[list] = [[] for _ in range(SYMBOLS)]
        self.file = None

    def push(self, symbol: int, entries: np.ndarray) -> None:
        if len(entries):
            self.parts[symbol].append(entries)
            self.held += entries.nbytes
            if self.held > self.memory:
                self._spill()

    def _spill(self) -> None:
        """Everything in memory goes to the end of the file; places of pieces stay."""
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for pieces in self.parts:
            for i, piece in enumerate(pieces):
                if isinstance(piece, np.ndarray):
                    pieces[i] = (self.file.tell(), len(piece))
                    self.file.write(piece.tobytes())
        self.held = 0

    def _piece(self, piece) -> np.ndarray:
        if isinstance(piece, np.ndarray):
            return piece
        self.file.seek(piece[0])
        return np.frombuffer(self.file.read(piece[1] * ENTRY.itemsize), ENTRY)

    def count(self, symbol: int) -> int:
        return sum(len(p) if isinstance(p, np.ndarray) else p[1] for p in self.parts[symbol])

    def sample(self, symbol: int, wanted: int) -> np.ndarray:
        """About so many of a character's entries, from all over them; they stay."""
        step = max(1, self.count(symbol) // wanted)
        found = np.concatenate([self._piece(p)[::step] for p in self.parts[symbol]])
        return found[:: max(1, len(found) // wanted)]

    def deal(self, symbols: np.ndarray, entries: np.ndarray) -> None:
        """Push entries of several characters."""
        order = np.argsort(symbols, kind="stable")
        symbols, entries = symbols[order], entries[order]
        cuts = np.nonzero(np.r_[True, symbols[1:] != symbols[:-1]])[0]
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(entries)], strict=True):
            # A copy, so that what is spilled does not stay as part of the whole.
            self.push(int(symbols[lo]), entries[lo:hi].copy())

    def take(self, symbol: int) -> Iterator[np.ndarray]:
        """Blocks of a character's entries in order, also of those that arrive meanwhile; they leave the queue."""
        while self.parts[symbol]:
            waiting, self.parts[symbol] = self.parts[symbol], []
            self.held -= sum(p.nbytes for p in waiting if isinstance(p, np.ndarray))
            small: list[np.ndarray] = []
            for piece in waiting:
                small.append(self._piece(piece))
                if sum(map(len, small)) >= BLOCK:
                    yield from blocks(np.concatenate(small))
                    small = []
            if small:
                yield from blocks(np.concatenate(small))

    def backwards(self, symbol: int) -> Iterator[np.ndarray]:
        """A character's entries, last first, each block reversed; they leave the queue."""
        waiting, self.parts[symbol] = self.parts[symbol], []
        for piece in reversed(waiting):
            yield from blocks(self._piece(piece)[::-1])

    def close(self) -> None:
        if self.file:
            self.file.close()


def blocks(entries: np.ndarray) -> Iterator[np.ndarray]:
    for lo in range(0, len(entries), BLOCK):
        yield entries[lo : lo + BLOCK]


class Inducer:
    """Puts what entries of a pass induce into a queue, with common prefixes."""

    def __init__(self, text: np.ndarray, queue: Queue):
        self.text, self.queue = text, queue
        #: For each character: the least common prefix since its last arrival, and whether there was one.
        self.least = np.zeros(SYMBOLS, np.int64)
        self.known = np.zeros(SYMBOLS, bool)

    def scan(self, entries: np.ndarray, wanted: Callable[[np.ndarray], np.ndarray]) -> None:
        """One block, in the order of the pass; ``wanted`` says which characters before an entry are induced."""
        at, common = entries["at"], entries["common"].astype(np.int64)
        sources = np.nonzero(at > 0)[0]
        symbols = self.text[at[sources] - 1]
        chosen = wanted(symbols)
        sources, symbols = sources[chosen], symbols[chosen]
        through = np.minimum.accumulate(common)
        if len(sources):
            order = np.argsort(symbols, kind="stable")
            sources, symbols = sources[order], symbols[order].astype(np.int64)
            first = np.r_[True, symbols[1:] != symbols[:-1]]
            value = np.minimum(self.least[symbols], through[sources])
            again = np.nonzero(~first)[0]
            if len(again):
                value[again] = least_between(entries["common"], sources[again - 1] + 1, sources[again])
            value = np.minimum(value + 1, DEPTH)
            value[first & ~self.known[symbols]] = 0
            made = np.empty(len(sources), ENTRY)
            made["at"], made["common"] = at[sources] - 1, value
            cuts = np.nonzero(first)[0]
            for lo, hi in zip(cuts, np.r_[cuts[1:], len(made)], strict=True):
                self.queue.push(int(symbols[lo]), made[lo:hi])
        # What lies between now and the last arrival of every character.
        self.least = np.minimum(self.least, through[-1])
        if len(sources):
            after = np.r_[np.minimum.accumulate(common[::-1])[::-1][1:], DEPTH]
            last = np.r_[cuts[1:], len(made)] - 1
            self.least[symbols[last]] = after[sources[last]]
            self.known[symbols[last]] = True


def least_between(common: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of ``common[lo..hi]`` for many ranges, by a table of ranges of powers of two."""
    span = hi - lo + 1
    level = np.frexp(span)[1] - 1
    out = np.empty(len(lo), np.int64)
    table = common
    for k in range(int(level.max()) + 1):
        here = np.nonzero(level == k)[0]
        out[here] = np.minimum(table[lo[here]], table[hi[here] - (1 << k) + 1])
        if len(table) > 1 << k:
            table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :])
    return out


def kinds(text: np.ndarray, after: bool, follows: int) -> np.ndarray:
    """True where the suffix is S; ``follows`` and ``after`` are the next character and whether its suffix is S."""
    step = np.sign(np.diff(text.astype(np.int16), append=np.int16(follows))).astype(np.int8)
    # Equal neighbours are of the kind of the next that differs.
    moves = np.where(step != 0, np.arange(len(step)), len(step))
    moves = np.minimum.accumulate(moves[::-1])[::-1]
    return np.r_[step > 0, after][moves]


def words(padded: np.ndarray) -> np.ndarray:
    """At every place the next WORD characters as one number that sorts like them."""
    return np.ndarray(len(padded) - WORD + 1, ">u8", padded, strides=(1,))


def ordered_seeds(padded: np.ndarray, queue: Queue, symbol: int, last: int, memory: int) -> Iterator[np.ndarray]:
    """A character's seeds in order, in blocks, with common prefixes; ``last`` is the suffix before them or -1."""
    for part in seed_parts(padded, queue, symbol, memory):
        part["common"][0] = shared_prefix(padded, last, int(part["at"][0])) if last >= 0 else 0
        last = int(part["at"][-1])
        yield from blocks(part)


def seed_parts(padded: np.ndarray, queue: Queue, symbol: int, memory: int) -> Iterator[np.ndarray]:
    """Seeds in order, in parts that are ordered in bounded memory; the first of a part has no common prefix yet.

    What does not fit is split by some of its own strings, in a queue that spills: seeds between two
    of these are a part, split again if need be, and seeds equal to one need no order.
    """
    count = queue.count(symbol)
    if count <= max(memory // SEED_BYTES, 2):
        if count:
            yield sorted_seeds(padded, np.concatenate(list(queue.take(symbol)))["at"])
        return
    windows = np.lib.stride_tricks.sliding_window_view(padded, DEPTH)
    strings = lambda entries: windows[entries["at"]].view(f"S{DEPTH}")[:, 0]
    some = np.sort(strings(queue.sample(symbol, SAMPLE)))
    splitters = np.unique(some[np.linspace(0, len(some) - 1, SYMBOLS // 2).astype(np.int64)])
    split = Queue(memory // 2)
    try:
        for part in queue.take(symbol):
            found = strings(part)
            # Even between splitters, odd at one.
            split.deal(np.searchsorted(splitters, found, "left") + np.searchsorted(splitters, found, "right"), part)
        for place in range(2 * len(splitters) + 1):
            if place % 2 == 0:
                yield from seed_parts(padded, split, place, memory // 2)
                continue
            for part in split.take(place):
                equal = part.copy()
                equal["common"] = DEPTH
                yield equal
    finally:
        split.close()


def sorted_seeds(padded: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Seeds of one first character in order, with common prefixes; ties are looked at word by word."""
    at = seeds.astype(np.int64)
    common = np.zeros(len(at), np.int64)
    look = words(padded)
    # Runs of seeds that are equal so far: each run is split by the next word.
    run = np.zeros(len(at), np.int64)
    tied = np.arange(len(at))
    for depth in range(0, DEPTH, WORD):
        if not len(tied):
            break
        word = look[at[tied] + depth].astype(np.uint64)
        order = np.lexsort((word, run[tied]))
        word, at[tied] = word[order], at[tied][order]
        same_run = np.r_[False, run[tied][1:] == run[tied][:-1]]
        equal = same_run & np.r_[False, word[1:] == word[:-1]]
        differ = word[1:] ^ word[:-1]
        shared = np.r_[0, leading_bytes(differ)]
        common[tied] = np.where(same_run, depth + shared, common[tied])
        run[tied] = np.cumsum(~equal)
        keep = equal | np.r_[equal[1:], False]
        tied = tied[keep]
    made = np.empty(len(at), ENTRY)
    made["at"], made["common"] = at, np.minimum(common, DEPTH)
    return made


def leading_bytes(differ: np.ndarray) -> np.ndarray:
    """How many bytes two words share from their start."""
    out = np.full(len(differ), WORD, np.int64)
    for k in range(WORD):
        out = np.where((out == WORD) & (differ >> np.uint64(56 - 8 * k) != 0), k, out)
    return out


def shared_prefix(padded: np.ndarray, a: int, b: int) -> int:
    x, y = padded[a : a + DEPTH], padded[b : b + DEPTH]
    unequal = np.nonzero(x != y)[0]
    return int(unequal[0]) if len(unequal) else DEPTH


def suffix_order(padded: np.ndarray, size: int, seeds_of: Callable[[int], tuple[Queue, int]], memory: int = MEMORY) -> Iterator[np.ndarray]:
    """All suffixes of ``padded[:size]``, largest first, in blocks of entries.

    An entry's common prefix is that with the entry before it, whatever block that was in. The text
    must end with a zero and be followed by at least DEPTH + WORD more. ``seeds_of(c)`` gives the
    queue of the seeds that begin with c, and where in it they are.
    """
    text = padded[:size]
    smaller, larger, kept = Queue(memory), Queue(memory), Queue(memory)
    up = Inducer(text, smaller)
    # The end of the text is the smallest suffix; it induces the last character's.
    up.scan(np.array([(size, 0)], ENTRY), lambda s: np.ones(len(s), bool))
    for c in range(SYMBOLS - 1):
        last = -1
        for part in smaller.take(c):
            kept.push(c, part)
            last = int(part["at"][-1])
            up.scan(part, lambda s, c=c: s >= c)
        for part in ordered_seeds(padded, *seeds_of(c), last, memory):
            up.scan(part, lambda s, c=c: s > c)
    down = Inducer(text, larger)
    for c in range(SYMBOLS - 2, -1, -1):
        last = -1
        for part in larger.take(c):
            yield part
            last = int(part["at"][-1])
            down.scan(part, lambda s, c=c: s <= c)
        ahead = None
        for part in kept.backwards(c):
            # Downwards an entry's common prefix is the one its upper neighbour had with it.
            part = part.copy()
            own = part["common"].copy()
            part["common"][1:] = own[:-1]
            if ahead is not None:
                part["common"][0] = ahead
            else:
                part["common"][0] = shared_prefix(padded, last, int(part["at"][0])) if last >= 0 else 0
            ahead = own[-1]
            yield part
            down.scan(part, lambda s, c=c: s < c)
    for queue in (smaller, larger, kept):
        queue.close()


def seed_places(text: np.ndarray, memory: int = MEMORY) -> tuple[Callable[[int], tuple[Queue, int]], Queue]:
    """A look-up of seeds by first character; they wait in a queue of their own.

    The text is read in pieces from its end, beyond which lies a character smaller than all.
    """
    queue = Queue(memory)
    after, follows = False, -1
    for hi in range(len(text), 0, -BLOCK):
        lo = max(0, hi - BLOCK)
        kind = kinds(text[lo:hi], after, follows)
        after, follows = bool(kind[0]), int(text[lo])
        # A suffix is S after an L if the character before is larger than its own.
        before = np.r_[text[lo - 1] if lo else 0, text[lo : hi - 1]]
        places = np.nonzero(kind & (before > text[lo:hi]))[0] + lo
        if not len(places):
            continue
        made = np.empty(len(places), ENTRY)
        made["at"], made["common"] = places, 0
        queue.deal(text[places], made)
    return lambda c: (queue, c), queue


def room(size: int, kind: type, memory: int = MEMORY) -> np.ndarray:
    """Zeros, in memory or beyond a limit in an unnamed file."""
    if size * np.dtype(kind).itemsize <= memory:
        return np.zeros(size, kind)
    with tempfile.TemporaryFile() as file:
        file.truncate(size * np.dtype(kind).itemsize)
        return np.memmap(file, kind, "r+", shape=(size,))


def repeats(padded: np.ndarray, size: int, owned: np.ndarray, memory: int = MEMORY) -> np.ndarray:
    """Which of the ``owned`` places begin DEPTH characters that also begin at an earlier owned place."""
    repeated = room(size, bool, memory)
    seeds, waiting = seed_places(padded[:size], memory)
    # The run of equal strings that reaches to the end of the block, by its smallest place so far.
    open_first = -1
    for part in suffix_order(padded, size, seeds, memory):
        begins = part["common"] < DEPTH
        mine = owned[part["at"]]
        at = part["at"][mine]
        group = np.cumsum(begins)[mine]
        if begins[0]:
            open_first = -1
        if len(at):
            starts = np.nonzero(np.r_[True, group[1:] != group[:-1]])[0]
            least = np.minimum.reduceat(at, starts)
            joins = group[0] == (1 if begins[0] else 0) and not begins[0]
            if joins and open_first >= 0:
                if least[0] < open_first:
                    repeated[open_first] = True
                else:
                    least[0] = open_first
            repeated[at] |= at != np.repeat(least, np.diff(np.r_[starts, len(at)]))
            if group[-1] == begins.sum():
                open_first = int(least[-1])
            else:
                open_first = -1
        elif begins.any():
            open_first = -1
    waiting.close()
    return repeated
