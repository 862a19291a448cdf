from collections import Counter

import numpy as np

from tidemark.llm import quality


def plain(w):
    """Bucket counts of the n-grams of one word, byte by byte."""
    raw, out = b"<" + w + b">", Counter()
    for n in quality.NGRAMS:
        for i in range(len(raw) - n + 1):
            x = n
            for b in raw[i : i + n]:
                x = (x * 257 + b) % 2**64
            out[int(quality.mix64(np.array([x], np.uint64))[0]) >> 64 - quality.BITS] += 1
    return out


def test_ngrams_of_whole_words(monkeypatch):
    rng = np.random.default_rng(5)
    ws = [b"a", bytes(rng.integers(97, 123, 300, np.uint8)), "漢字仮名".encode() * 40, b"ab", bytes(rng.integers(97, 123, 64, np.uint8)) + b"tail"]
    for piece in (1 << 18, 7, 1):
        monkeypatch.setattr(quality, "PIECE", piece)
        buckets, owners = quality.subwords(ws)
        for i, w in enumerate(ws):
            assert Counter(buckets[owners == i][1:].tolist()) == plain(w)


def test_score_reads_past_64_bytes(monkeypatch):
    value = np.random.default_rng(6).normal(size=(1 << quality.BITS) + 2).astype(np.float32)
    texts = ["x" * 64 + "good" * 50, "x" * 64 + "evil" * 50, None, "", "short words too " * 3]
    want = [1 / (1 + np.exp(-(0.1 + (value[u] * share).sum()))) for u, share in map(quality.bag, texts)]
    for piece in (1 << 18, 5):
        monkeypatch.setattr(quality, "PIECE", piece)
        assert np.allclose(quality.score_lists(texts, value, 0.1), want)
    grams = [plain(t.encode()) for t in texts[:2]]
    got = [Counter(quality.subwords([t.encode()])[0][1:].tolist()) for t in texts[:2]]
    assert got == grams and grams[0] != grams[1]
