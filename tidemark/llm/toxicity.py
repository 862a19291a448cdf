"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every coordinate has its own learning rate, and an L1 penalty keeps most weights at exactly zero: the few
that remain are broadcast and looked up in batches. Features are present or absent in a document, so one
passage counts alike in a short and in a very long text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SAMPLE_BYTES, collect_sample, fold, labelled_sample, per_batch, slices

BITS = 20
#: ASCII letters in lower case; all other ASCII but digits and the apostrophe parts words.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 or c == 39 else 32 for c in range(256))


#: Bytes of a word that make its stems: inflected forms share weights. Chosen, like the passes, by folds within the rows that may be
#: learned from: 305 of 352 toxic texts found with 6 wrong alarms among 2,803, without stems 247 and 0.
STEMS = (4, 5, 6, 7, 8)


def tokens(text: str | None) -> np.ndarray:
    """A row for each word of the lower-cased text: crc32 of the word, then of each stem (0: not longer)."""
    ws = text.lower().encode("utf-8", "replace").translate(TABLE).split() if text else []
    out = np.zeros((len(ws), 1 + len(STEMS)), np.uint64)
    out[:, 0] = np.fromiter(map(zlib.crc32, ws), np.uint64, len(ws))
    crc = zlib.crc32
    for k, n in enumerate(STEMS):
        out[:, k + 1] = np.fromiter([crc(w[:n], n) if len(w) > n else 0 for w in ws], np.uint64, len(ws))
    return out


def features(rows: np.ndarray, doc: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, stems, bigrams, trigrams and one-word skip-grams, and the document of each."""
    h = np.ascontiguousarray(rows[:, 0])
    out, of = [h * np.uint64(0x9E3779B97F4A7C15)], [doc]
    for k in range(1, rows.shape[1]):
        some = rows[:, k] > 0
        out.append(rows[some, k] * np.uint64(0x9E3779B97F4A7C15 + 64 * k))
        of.append(doc[some])
    for lead, gaps in ((3, (1,)), (5, (1, 2)), (7, (2,))):
        n = len(h) - gaps[-1]
        if n <= 0:
            continue
        x = h[:n] * np.uint64(0x9E3779B97F4A7C15 + 2 * lead)
        for k, g in enumerate(gaps):
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[g : g + n] * np.uint64(0x94D049BB133111EB + 2 * k)
        inside = doc[:n] == doc[gaps[-1] :]
        out.append(x[inside])
        of.append(doc[:n][inside])
    x = np.concatenate(out)
    return ((x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(of)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Ftrl:
    """Follow the regularised leader, proximal form; coordinate 2**bits is the bias, which L1 spares."""

    def __init__(self, bits: int = BITS, alpha: float = 2.0, beta: float = 1.0, l1: float = 4.0, l2: float = 1.0):
        self.bits, self.alpha, self.beta, self.l1, self.l2 = bits, alpha, beta, l1, l2
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)

    def weight(self, i: np.ndarray) -> np.ndarray:
        z = self.z[i]
        l1 = np.where(i == 1 << self.bits, 0.0, self.l1)
        rate = (self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / rate)

    def learn(self, i: np.ndarray, y: int) -> None:
        i = np.append(i, 1 << self.bits)
        w = self.weight(i)
        g = sigmoid(w.sum()) - y
        s = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / self.alpha
        self.z[i] += g - s * w
        self.n[i] += g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Coordinates and values of the weights that aren't zero, and the bias."""
        w = self.weight(np.arange((1 << self.bits) + 1))
        at = np.flatnonzero(w[:-1])
        return at.astype(np.int32), w[at].astype(np.float32), float(w[-1])


def fit(texts: list[str], labels: np.ndarray, epochs: int | None = None, bits: int = BITS, seed: int = 5):
    """Sparse weights; without both labels, none and a bias that says what share is 1."""
    if len(set(labels.tolist())) < 2:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), float(np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5)))
    epochs = epochs or int(np.clip(60_000 / len(texts), 6, 20))
    found = []
    for t in texts:
        h = tokens(t)
        found.append(np.unique(features(h, np.zeros(len(h), np.int8), bits)[0]).astype(np.int32))
    model, order = Ftrl(bits), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(found)):
            model.learn(found[i], int(labels[i]))
    return model.sparse()


def score_lists(texts: list, at: np.ndarray, w: np.ndarray, bias: float, bits: int = BITS) -> np.ndarray:
    """The probability of label 1 for each text; null and empty texts get that of the bias alone."""
    hs = [tokens(t) for t in texts]
    doc = np.repeat(np.arange(len(hs), dtype=np.int32), [len(h) for h in hs])
    total = np.full(len(hs), bias)
    if len(doc) and len(at):
        x, of = features(np.concatenate(hs), doc, bits)
        dense = np.zeros(1 << bits, np.float32)
        dense[at] = w
        hit = np.flatnonzero(dense[x])
        pair = np.unique((of[hit].astype(np.int64) << bits) | x[hit])
        total += np.bincount(pair >> bits, dense[pair & ((1 << bits) - 1)], len(hs))
    return sigmoid(total)


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, max_bytes: int = SAMPLE_BYTES, folds: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs (doc_id, text, anything else).

    Learns labels.toxic from at most max_rows labelled rows whose fold isn't held, of at most max_bytes of
    whole texts together (the documented bounds; every row is scored whole). Null labels and ids teach
    nothing; null and empty texts get the bias's score; a null doc_id is in no fold and is scored.
    """
    sample = labelled_sample(docs, labels, "toxic", max_rows, max_bytes, fold("doc_id", folds) != held)
    texts, y = collect_sample(sample)
    model = docs.sparkSession.sparkContext.broadcast(fit(texts, y))
    rows = per_batch(docs, ["doc_id", "text"], "doc_id long, score double", lambda ids, texts: {"doc_id": ids, "score": score_lists(texts, *model.value)})
    return rows.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = 6000, max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """The rows of docs, all columns, that score below threshold; learned from all labelled rows of the sample."""
    texts, y = collect_sample(labelled_sample(docs, labels, "toxic", max_rows, max_bytes))
    model = docs.sparkSession.sparkContext.broadcast(fit(texts, y))
    return filter_rows(docs, lambda texts: score_lists(texts, *model.value) < threshold)


def filter_rows(docs: DataFrame, keep) -> DataFrame:
    """Rows whose text keep() accepts, all columns as they were; only texts go to Python, and only verdicts come back."""

    @F.arrow_udf("boolean")
    def kept(texts: pa.Array) -> pa.Array:
        parts = [keep(part.column(0).to_pylist()) for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]))]
        return pa.array(np.concatenate([np.zeros(0, bool), *parts]))

    return docs.where(kept("text"))
