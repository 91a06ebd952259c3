"""Hashes of words and shingles do not depend on how texts are cut into chunks."""

import random

import numpy as np
import pyarrow as pa

from tablepull.llm import hashing


def plain(text, size):
    """A text's shingle hashes, word by word."""
    words = (text or "").lower().split()
    data = [np.frombuffer(w.encode(), np.uint8) for w in words]
    hashes = [hashing.span_hash(hashing.prefixes(d), np.array([0]), np.array([len(d)]))[0] for d in data]
    n = min(size, len(hashes))
    return sorted({int(hashing.combine(np.array(hashes[i : i + n], np.uint64), n)[0]) for i in range(len(hashes) - n + 1)}) if hashes else []


def test_shingle_sets_in_small_chunks(monkeypatch):
    draw = random.Random(3)
    texts = [None, "", " \n", "One", "a b c d", "A b C d e  f\ta b c d e", *("".join(draw.choices("ab \nXé", k=draw.randrange(80))) for _ in range(60))]
    for limit in (1, 50, hashing.WORD_BYTES):
        monkeypatch.setattr(hashing, "WORD_BYTES", limit)
        found = [s.tolist() for s in hashing.shingle_sets(pa.array(texts, pa.string()), 5)]
        assert found == [plain("".join(c.lower() if c < "\x80" else c for c in t) if t else t, 5) for t in texts]


def test_distinct():
    draw = np.random.default_rng(0)
    for n in (0, 1, 2, 7, 1000):
        values = draw.integers(0, 2**63, n, dtype=np.uint64) % np.uint64(50)
        assert np.array_equal(hashing.distinct(values), np.unique(values)) and hashing.distinct(values).dtype == np.uint64
