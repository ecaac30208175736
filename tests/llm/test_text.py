"""Slices of texts: working memory, hashes that do not depend on them."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from ratelake.llm import text
from ratelake.llm.text import Words, map_texts, shingles


def test_working_memory_follows_the_slice(monkeypatch):
    rng = random.Random(2)
    doc = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(3000))
    batch = pa.record_batch([pa.array([doc] * 500)], names=["text"])
    monkeypatch.setattr(text, "_powers", {})

    def run(part):
        words = Words(part.column(0))
        shingles(words.hashes(), words.off, 5)

    tracemalloc.start()
    assert list(map_texts(run, limit=text.SMALL)([batch])) == []
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20


def test_hashes_do_not_depend_on_segments(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.choice([1, 4, 9, 700]))) for _ in range(400)]
    whole = Words(pa.array([" ".join(words)])).hashes()
    monkeypatch.setattr(text, "_SEGMENT", 50)
    assert np.array_equal(whole, Words(pa.array([" ".join(words)])).hashes())
