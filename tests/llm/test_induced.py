"""Suffix order by induction against sorting, with small blocks and queues that spill."""

import random
import tracemalloc

import numpy as np
import pytest

from tablewright.llm import induced


def shard(parts):
    text, owned = bytearray(), []
    for part in parts:
        text += bytes(b + 1 for b in part) + b"\0"
        owned += [i + induced.DEPTH <= len(part) for i in range(len(part))] + [False]
    return np.frombuffer(bytes(text) + bytes(induced.DEPTH + induced.WORD), np.uint8), len(text), np.array(owned, bool)


def made(rng, letters):
    parts = []
    for _ in range(rng.randint(1, 12)):
        part = bytes(rng.randrange(letters) for _ in range(rng.randint(0, 150)))
        if parts and rng.random() < 0.6:
            old = rng.choice(parts)
            at = rng.randint(0, len(old))
            part = part[:20] + old[at : at + rng.randint(0, 140)] + part[20:40]
        parts.append(part)
    return parts


@pytest.mark.parametrize("seed", range(60))
def test_repeats(monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(induced, "DEPTH", rng.choice([3, 5, 12, 20, 100]))
    monkeypatch.setattr(induced, "BLOCK", rng.choice([3, 17, 1000]))
    padded, size, owned = shard(made(rng, rng.choice([1, 2, 3, 20, 200])))
    seen, want = set(), []
    for i in range(size):
        piece = bytes(padded[i : i + induced.DEPTH])
        want.append(bool(owned[i]) and piece in seen)
        if owned[i]:
            seen.add(piece)
    assert induced.repeats(padded, size, owned, rng.choice([50, 1000, 1 << 20])).tolist() == want


@pytest.mark.parametrize("seed", range(20))
def test_order_and_prefixes(monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(induced, "DEPTH", 40)
    monkeypatch.setattr(induced, "BLOCK", 50)
    padded, size, _ = shard(made(rng, rng.choice([2, 5, 50])))
    seeds, _ = induced.seed_places(padded[:size], 400)
    found = np.concatenate(list(induced.suffix_order(padded, size, seeds, 400)))
    assert sorted(found["at"].tolist()) == list(range(size))
    heads = [bytes(padded[i : i + 40]) for i in found["at"]]
    assert heads == sorted(heads, reverse=True)
    for a, b, common in zip(heads, heads[1:], found["common"][1:].tolist(), strict=False):
        assert common == next((k for k in range(40) if a[k] != b[k]), 40)


@pytest.mark.parametrize("words", [[b"ab", b"cd", b"ef", b"gh"], [b"one and the same line, far over sixty-four bytes long, in a third of all texts"]])
def test_seeds_of_one_character_are_ordered_in_bounded_memory(monkeypatch, words):
    monkeypatch.setattr(induced, "BLOCK", 1 << 12)
    rng, memory = random.Random(6), 1 << 20
    text = b" ".join(rng.choice(words) if rng.random() < 0.5 else bytes(rng.choices(b"mnopqr", k=2)) for _ in range(200_000))[: 600_000]
    padded, size, _ = shard([text])
    seeds, waiting = induced.seed_places(padded[:size], memory)
    found, filled = np.empty(size, np.int64), 0
    tracemalloc.start()
    for part in induced.suffix_order(padded, size, seeds, memory):
        found[filled : filled + len(part)] = part["at"]
        filled += len(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    heads = [bytes(padded[i : i + induced.DEPTH]) for i in found]
    assert sorted(found.tolist()) == list(range(size)) and heads == sorted(heads, reverse=True)
    assert peak < 8 * memory
