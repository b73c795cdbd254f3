"""What the walk over sorted words costs, and that its bounds on memory change no ids."""

import random
import sys

import pyarrow as pa
import sentencepiece

from tablewright.llm import sentencepieces
from tablewright.llm.queries import PIECES


def texts(n, seed):
    rng = random.Random(seed)
    parts = ["the", "ing", "un", "re", "straße", "日本", "語", "é", "🙂", "\n", "\t", "x", "zz", "0", "1984", "'s", "--", "▁"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.choice([1, 2, 3, 5, 40, 90])))
    return ["", " ", None, *[" ".join(word() for _ in range(rng.randrange(1, 9))) for _ in range(n)]]


def encoded(encoder, rows):
    ids, bounds = encoder.encode(pa.array(rows, pa.string()))
    trips = encoder.round_trips(ids, bounds, pa.array([t or "" for t in rows], pa.string())).to_pylist()
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])], trips


def test_a_known_prefix_costs_no_call():
    encoder = sentencepieces.Encoder(sentencepieces.Vocabulary.read(PIECES))
    words = sorted({w.replace(" ", sentencepieces.MARK) for t in texts(300, 1) if t for w in t.split("\n")})
    first = encoder.encode_sorted(words)
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(frame.f_code.co_name) if event == "call" else None)
    try:
        again = encoder.encode_sorted(words)
    finally:
        sys.setprofile(None)
    assert again == first
    # Neighbours and steps are remembered: no call for each prefix or piece.
    assert len(calls) < 10


def test_bounds_and_long_words_change_no_ids(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = texts(200, 2)
    for limit in (10**9, 7):
        for name in ("PAIRS", "STEPS", "REMEMBERED"):
            monkeypatch.setattr(sentencepieces, name, limit)
        encoder = sentencepieces.Encoder(sentencepieces.Vocabulary.read(PIECES))
        ids, trips = encoded(encoder, rows)
        assert ids == [library.encode((t or "").replace(sentencepieces.MARK, " ")) for t in rows]
        # Only the mark itself comes back as another character.
        assert trips == [sentencepieces.MARK not in (t or "") for t in rows]
        assert trips == [encoder.decode(i) == (t or "") for i, t in zip(ids, rows)]
