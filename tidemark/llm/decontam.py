"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching.

Seeds: runs of five words that a document shares with a test item. An item is looked at where a document has one of
its rarest seeds: as many consecutive ones as can't all be missing, so an opening that thousands of items share calls for none
of them. Documents whose seeds can't cover enough of an item are done with. For each remaining pair the longest common runs of unmarked
words are marked again and again, longest first and never overlapping, until no run of five words is left.
The tiles may lie in any order, so passages that were cut up and rearranged are caught too; a document is
contaminated by an item when its tiles cover at least the threshold of the item's words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Spans, slices, typed
from .toxicity import filter_rows

#: Shortest run of words that counts as a tile, and so the shortest item that is searched.
LEAST = 5
#: Bytes of the benchmark that are indexed and broadcast at once (a word has one at least, and a break); a larger benchmark takes several passes.
ITEM_BYTES = 16_000_000
#: ASCII letters in lower case; all other ASCII but digits parts words.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def normal(text: str | None) -> np.ndarray:
    """XXH64 of each word: lower case, ASCII punctuation parts words."""
    ws = text.lower().encode("utf-8", "replace").translate(TABLE).split() if text else []
    return np.fromiter(map(xxhash.xxh64_intdigest, ws), np.uint64, len(ws))


def tiles(a: np.ndarray, b: np.ndarray, least: int = LEAST, start: int = 20) -> list[tuple[int, int, int]]:
    """Greedy tiling of word sequences a and b: (place in a, place in b, words) of non-overlapping common runs."""
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    ha, hb = Spans(a), Spans(b)
    out: list[tuple[int, int, int]] = []
    size = max(least, min(start, len(a), len(b)))
    while True:
        found = matches(a, b, free_a, free_b, ha, hb, size)
        longest = max((n for _, _, n in found), default=0)
        if longest > 2 * size:
            size = longest
            continue
        for i, j, n in sorted(found, key=lambda m: (-m[2], m[0], m[1])):
            # what earlier tiles have taken goes; a rest that is still long enough is a tile
            ok = free_a[i : i + n] & free_b[j : j + n]
            if not ok.all():
                n = int(np.argmin(ok))
            if n >= size:
                free_a[i : i + n] = free_b[j : j + n] = False
                out.append((i, j, n))
        if size > least:
            size = max(least, size // 2)
        elif not any(n >= least for _, _, n in matches(a, b, free_a, free_b, ha, hb, least)):
            return out


def matches(a, b, free_a, free_b, ha: Spans, hb: Spans, size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of at least size free words, looked up by the rolling hash of their first words."""
    at_a, at_b = open_runs(free_a, size), open_runs(free_b, size)
    if not len(at_a) or not len(at_b):
        return []
    ka, kb = ha.of(at_a, size), hb.of(at_b, size)
    order = np.argsort(ka, kind="stable")
    ka, at_a = ka[order], at_a[order]
    lo, hi = np.searchsorted(ka, kb, "left"), np.searchsorted(ka, kb, "right")
    out = []
    for q in np.flatnonzero(hi > lo):
        j = int(at_b[q])
        for i in at_a[lo[q] : hi[q]].tolist():
            if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                continue  # part of a run that began earlier
            n = size
            while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                n += 1
            out.append((i, j, n))
    return out


def open_runs(free: np.ndarray, size: int) -> np.ndarray:
    """Places from which size words are free."""
    if len(free) < size:
        return np.zeros(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[size:] == taken[:-size])


class Index:
    """Seeds of a block of test items; the rarest of each call for a look at the item."""

    def __init__(self, items: list[tuple[int, str | None]], threshold: float, least: int = LEAST):
        self.least, self.threshold = least, threshold
        self.items = [(i, h) for i, t in items if len(h := normal(t)) >= least]
        self.seeds = [Spans(h).of(np.arange(len(h) - least + 1), least) for _, h in self.items]
        u, n = np.unique(np.concatenate([*self.seeds, np.zeros(0, np.uint64)]), return_counts=True)
        calls = [rarest(n[np.searchsorted(u, k)], len(h), threshold, least) for k, (_, h) in zip(self.seeds, self.items, strict=True)]
        keys = np.concatenate([*(k[c] for k, c in zip(self.seeds, calls, strict=True)), np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(self.items)), [c.stop - c.start for c in calls])
        order = np.argsort(keys, kind="stable")
        self.keys, self.item = keys[order], item[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.keys >> np.uint64(42)).astype(np.int64)] = True

    def search(self, hs: list[np.ndarray]) -> list[list[tuple[int, int, int, int]]]:
        """For each document: (item, tiles, words covered, words of the item) of the items covered enough."""
        out: list[list] = [[] for _ in hs]
        lengths = np.array([len(h) for h in hs], np.int64)
        if not len(self.keys) or not lengths.sum():
            return out
        doc = np.repeat(np.arange(len(hs)), lengths)
        begin = np.cumsum(lengths) - lengths
        at = np.flatnonzero(np.arange(len(doc)) - begin[doc] + self.least <= lengths[doc])
        seed = Spans(np.concatenate(hs)).of(at, self.least)
        some = np.flatnonzero(self.seen[(seed >> np.uint64(42)).astype(np.int64)])
        lo, hi = np.searchsorted(self.keys, seed[some], "left"), np.searchsorted(self.keys, seed[some], "right")
        hit = hi > lo
        some, lo, n = some[hit], lo[hit], (hi - lo)[hit]
        called = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pairs = np.unique(np.repeat(doc[at[some]], n) * len(self.items) + self.item[called])
        ends = np.searchsorted(doc[at], np.arange(len(hs) + 1))
        now, mine, order = -1, seed[:0], None
        for d, k in zip((pairs // len(self.items)).tolist(), (pairs % len(self.items)).tolist()):
            if d != now:
                now, mine = d, seed[ends[d] : ends[d + 1]]
                order = np.sort(mine)
            (name, a), seeds = self.items[k], self.seeds[k]
            held = order[np.minimum(np.searchsorted(order, seeds), len(order) - 1)] == seeds
            if covered(np.flatnonzero(held), len(a), self.least).sum() < self.threshold * len(a):
                continue  # not even all seeds together cover enough
            got = tiles(a, self.parted(hs[d], np.flatnonzero(np.isin(mine, seeds[held]))), self.least)
            words = sum(x[2] for x in got)
            if words >= self.threshold * len(a):
                out[d].append((name, len(got), words, len(a)))
        return out

    def parted(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The words of h that seeds cover, with a word that occurs nowhere between the runs."""
        mask = covered(at, len(h), self.least)
        gap = np.flatnonzero(np.diff(mask.astype(np.int8)) == -1) + 1
        keep = np.flatnonzero(mask)
        return np.insert(h[keep], np.searchsorted(keep, gap), (np.arange(len(gap)) * 2 + 1).astype(np.uint64))


def covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return np.cumsum(edge)[:-1] > 0


def rarest(counts: np.ndarray, words: int, threshold: float, least: int = LEAST) -> slice:
    """Consecutive seeds of an item, the rarest together, of which a document that covers enough of it has one at least.

    Where all of m consecutive seeds are missing, m - least + 1 words stay uncovered.
    """
    m = int(math.floor((1 - threshold) * words + 1e-9)) + least
    if m >= len(counts):
        return slice(0, len(counts))
    sums = np.concatenate([[0], np.cumsum(counts)])
    first = int(np.argmin(sums[m:] - sums[:-m]))
    return slice(first, first + m)


def blocks(benchmark: DataFrame, threshold: float, most: int = ITEM_BYTES):
    """The benchmark as broadcast indexes of about `most` bytes of text each; one if it is small. An item is held whole."""
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / most))
    for k in range(parts):
        part = items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k)
        yield benchmark.sparkSession.sparkContext.broadcast(Index(sorted((r[0], r[1]) for r in part.collect()), threshold))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, most: int = ITEM_BYTES) -> DataFrame:
    """(doc_id, item_id, n_tiles, matched_words, item_words, coverage) of each document and item it leaks.

    Whole texts are searched. Items of fewer than five words, null items and null or empty texts match
    nothing. Repeated rows give repeated pairs; a row without doc_id gives pairs without it. An empty
    benchmark or table gives an empty result. Pairs are as many as there are leaks, not pairs of documents.
    """
    schema = "doc_id long, item_id long, n_tiles int, matched_words int, item_words int"
    out = None
    for index in blocks(benchmark, threshold, most):

        def run(batches, index=index):
            for batch in batches:
                for part in slices(batch):
                    ids, texts = (part.column(k).to_pylist() for k in (0, 1))
                    rows = [(i, *x) for i, found in zip(ids, index.value.search([normal(t) for t in texts]), strict=True) for x in found]
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int64()] * 2 + [pa.int32()] * 3)], ["doc_id", "item_id", "n_tiles", "matched_words", "item_words"])

        found = docs.select("doc_id", "text").mapInArrow(typed(run, schema), schema)
        out = found if out is None else out.unionAll(found)
    return out.withColumn("coverage", F.round(F.col("matched_words") / F.col("item_words"), 6))


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, most: int = ITEM_BYTES) -> DataFrame:
    """The rows of docs, all columns, that leak no item."""
    for index in blocks(benchmark, threshold, most):
        docs = filter_rows(docs, lambda texts, index=index: [not x for x in index.value.search([normal(t) for t in texts])])
    return docs
