"""Plain versions of the corpus operators, one row at a time, to hold results against."""

import hashlib
import math
import re
from collections import Counter, defaultdict

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(SMALL))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def near_groups(rows, words, percent=80):
    """doc_id -> (set size, component, kept) by every link there is."""
    sets = {d: shingles(t, words) for d, t in rows}
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for d in sorted(sets):
        shared = Counter(e for s in sets[d] for e in where[s])
        for e, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = top(d), top(e)
                up[max(a, b)] = min(a, b)
        for s in sets[d]:
            where[s].append(d)
    return {d: (len(sets[d]), top(d), top(d) == d) for d in sets}


def passages(rows, length=100):
    """doc_id -> (bytes, removed, spans, hash of the rest); rows in the order of their documents."""
    seen, out = set(), {}
    for doc_id, text in rows:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if piece in seen:
                covered[i : i + length] = b"\1" * length
            else:
                seen.add(piece)
        kept = bytes(c for c, gone in zip(data, covered) if not gone)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out[doc_id] = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def dealt(homes, room):
    """Shard of every row, in the order of the ring: (row, home point) pairs, owners of points, room of shards.

    Row by row: first the rows of a point, then those carried on from before it.
    """
    points, owners = homes
    room, out, carried, lap = list(room), {}, [], 0
    while lap == 0 or carried:
        for point, owner in enumerate(owners):
            own, old = (list(points.get(point, [])) if lap == 0 else []), carried
            carried, left = [], []
            for row in own:
                if room[owner]:
                    room[owner] -= 1
                    out[row] = owner
                else:
                    left.append(row)
            for row in old:
                if room[owner]:
                    room[owner] -= 1
                    out[row] = owner
                else:
                    carried.append(row)
            carried += left
        lap += 1
    return out


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def ranked(docs, items, k=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total = len(held), sum(size for _, _, size in held)
    df = Counter(t for _, c, _ in held for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = []
    for item, own in wanted.items():
        found = []
        for d, c, size in held:
            m = 10 + (90 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if missing else d, -s) for i, (s, missing, d) in enumerate(sorted(found)[:k])]
    return out
