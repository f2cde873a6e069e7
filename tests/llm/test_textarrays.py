"""Long texts: the primitives agree with plain Python and need memory by the word, not by the byte."""

import random
import re
import tracemalloc

import numpy as np
import pytest

from plumbline.llm import textarrays as ta
from plumbline.llm.quality_rules import measure


def spans(found, data):
    return [(d, data[a:b].tobytes()) for a, b, d in zip(*found)]


def test_segments_do_not_split_words_or_lines(monkeypatch):
    monkeypatch.setattr(ta, "SEGMENT", 7)
    monkeypatch.setattr(ta, "LONG", 9)
    monkeypatch.setattr(ta, "_TABLES", {})
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab \n") for _ in range(rng.randint(0, 40))) for _ in range(60)] + [b"x" * 50]
    data, offs = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    words = ta.words(data, offs)
    assert spans(words, data) == [(i, w) for i, t in enumerate(texts) for w in t.split()]
    assert spans(ta.lines(data, offs), data) == [(i, x) for i, t in enumerate(texts) for x in t.split(b"\n") if x]
    assert ta.per_doc(data == 97, offs).tolist() == [t.count(b"a") for t in texts]
    seen = {}
    for (_, w), h in zip(spans(words, data), ta.span_hash(data, *words[:2]).tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("text", [b"some words of a text " * 1_000_000, b"w" * 20_000_000])
def test_memory_of_a_long_text(text):
    data, offs = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    measure(data[:1000], np.array([0, 1000]))
    tracemalloc.start()
    got = measure(data, offs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["n_words"][0] == len(re.findall(rb"\S+", text))
    assert peak < 32 * len(text) if b" " in text else peak < 8 * len(text)
