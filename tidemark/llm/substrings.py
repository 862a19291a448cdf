"""Removal of repeated passages over prefix-partitioned suffix trees.

Every word position with a whole window after it is a suffix. A sieve first drops the suffixes whose window
occurs once only, as they are leaves right below no deep node: batches of documents exchange the sorted, shortened
hashes of their windows by range, and learn which of them another batch has too. Equal hashes of different
windows only let a suffix through that the tree then finds alone.

A suffix that is left travels with the words of its window. It is filed under the suffix at its anchor, the run
of ANCHOR words with the least hash within the window: equal windows have equal anchors, and neighbours mostly share one, so
they travel as one stretch of text and not as a window each. The group of an anchor's suffix is its prefix, of variable
length: words are added until their information, by a census of frequent words, singles out a memory-sized group
(or the anchor is used up). Each group is a subtree, cut at window depth and held as a suffix array of word
ranks with the longest common prefixes of neighbours: prefixes below the window's width part the nodes of that depth,
whose leaves are the places of a repeat. Consecutive leaves of a document are a maximal repeat.

A mapper folds its own subtree first: of equal windows in a batch only those of the least document travel, the
others are known to be repeats. So a passage that fills a third of the corpus sends a few rows a batch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Spans, mix64, slices, typed
from .sieve import MESSAGE, binaries, key_bits, message, ranges_for, sieve, told

#: Words of a batch of documents, on average: 2 MB of text.
BATCH = 300_000
#: Suffixes in a subtree, on average and at most if all pass the sieve.
SUBTREE = 1_000_000
#: A word is frequent from this share of all words on, so the census has 4,096 rows at most.
FREQUENT = 1 / 4096
#: Words of an anchor.
ANCHOR = 3

Rows = list[tuple[int | None, str | None]]
#: Bytes that part words, as a space.
SPACES = bytes(32 if c in b" \t\n\x0b\x0c\r" else c for c in range(256))
POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def canon(text: str | None) -> bytes:
    """The words of a text, joined by one space."""
    raw = text.encode("utf-8", "replace").translate(SPACES) if text else b""
    return b" ".join(raw.split()) if b"  " in raw or raw[:1] == b" " or raw[-1:] == b" " else raw


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo 2**64."""
    if len(POWERS["up"]) < n:
        for name, base in (("up", Spans.BASE), ("down", Spans.INVERSE)):
            POWERS[name] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, base)]))
    return POWERS["up"][:n], POWERS["down"][:n]


class Words:
    """The words of texts in canonical form, one after the other: begin, end, text and hash of each; equal words have equal hashes."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join([*texts, b""])
        raw = np.frombuffer(self.raw, np.uint8)
        breaks = raw == 10
        end = np.flatnonzero(breaks | (raw == 32))
        begin = np.concatenate([np.zeros(1, np.int64), end[:-1] + 1])[: len(end)]
        some = end > begin  # a text without words ends where it begins
        self.doc = (np.cumsum(breaks[end]) - breaks[end])[some]
        self.begin, self.end = begin[some], end[some]
        up, down = powers(len(raw))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw + np.uint64(1)) * down)])
        self.hash = mix64((sums[self.end] - sums[self.begin]) * up[self.begin])


def census(docs: DataFrame) -> tuple[int, list[tuple[int, float]]]:
    """The number of words, and (hash, bits of information) of each frequent word.

    Each batch reports the words that reach half the share within it, which any word that reaches the share
    overall does in some batches; only those few rows are summed. What a miss changes is the size of a
    group, not a result.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                h = Words([canon(t) for t in part.column(0).to_pylist()]).hash
                if not len(h):
                    continue
                u, n = np.unique(h, return_counts=True)
                often = n >= max(2, len(h) * FREQUENT / 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(u[often].view(np.int64), 0)), pa.array(np.append(n[often], 0)), pa.array(np.append(np.zeros(often.sum(), np.int64), len(h)))], ["h", "n", "total"])

    counts = docs.select("text").mapInArrow(typed(run, "h long, n long, total long"), "h long, n long, total long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = counts.where("total > 0 or n > 0").orderBy(F.desc("total"), F.desc("n"), "h").limit(int(1 / FREQUENT) + 1).collect()
    total = sum(r["total"] for r in rows)
    return total, [(r["h"] & (2**64 - 1), math.log2(total / r["n"])) for r in rows if r["n"] >= total * FREQUENT]


def ordered(table: pa.Table) -> Rows:
    """(doc_id, text) of a batch, the least document first; equal rows are alike."""
    rows = zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True)
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


class Windows:
    """The windows of a batch's documents that have an id: hash, document (place in the batch) and position of each."""

    def __init__(self, rows: Rows, width: int, bits: int):
        self.words = w = Words([canon(t) if i is not None else b"" for i, t in rows])
        lengths = np.bincount(w.doc, minlength=len(rows))
        begin = np.cumsum(lengths) - lengths
        self.at = np.flatnonzero(np.arange(len(w.doc)) - begin[w.doc] + width <= lengths[w.doc])
        self.doc, self.pos = w.doc[self.at], self.at - begin[w.doc[self.at]]
        self.spans, self.width = Spans(w.hash), width
        self.key = self.spans.of(self.at, width) >> np.uint64(64 - bits)

    def anchors(self, which: np.ndarray) -> np.ndarray:
        """The word at which the least run of ANCHOR words begins in each of some windows; the first of equals."""
        size = min(ANCHOR, self.width)
        value = self.spans.of(np.arange(max(0, len(self.words.hash) - size + 1)), size)
        at = self.at[which]
        best, out = value[at], at.copy()
        for k in range(1, self.width - size + 1):
            less = value[at + k] < best
            best, out = np.where(less, value[at + k], best), np.where(less, at + k, out)
        return out


class Tree:
    """The suffixes of stretches of text as word ranks, in the order of a suffix array with longest common prefixes."""

    def __init__(self, stretches: list[bytes], width: int):
        index: dict[bytes, int] = {}
        number = index.setdefault
        flat, lengths = [], []
        for s in stretches:
            ws = s.split(b" ")
            lengths.append(len(ws))
            flat += [number(w, len(index)) for w in ws]
        rank = np.zeros(len(index), np.int32)
        rank[[index[w] for w in sorted(index)]] = np.arange(len(index))
        windows = np.array(lengths, np.int64) - width + 1
        #: stretch of each suffix, and its place there
        self.of = np.repeat(np.arange(len(windows)), windows)
        self.place = np.arange(len(self.of)) - np.repeat(np.cumsum(windows) - windows, windows)
        begin = np.cumsum(lengths) - lengths
        self.rank = rank[np.array(flat, np.int64)][(begin[self.of] + self.place)[:, None] + np.arange(width)] if len(self.of) else np.zeros((0, width), np.int32)
        self.width = width

    def nodes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array (the least document first among equals), and for each place the number of its node of window depth."""
        order = np.lexsort((ids, *self.rank.T[::-1]))
        rank = self.rank[order]
        common = np.logical_and.accumulate(rank[1:] == rank[:-1], axis=1).sum(axis=1)  # longest common prefix with the one before
        return order, np.concatenate([[0], np.cumsum(common < self.width)])[: len(order)]


def runs(doc: np.ndarray, pos: np.ndarray) -> bytes:
    """Consecutive positions of a document as (document, first, length), packed."""
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order]
    new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(pos, prepend=-2) != 1))
    return np.stack([doc[new], pos[new], np.diff(new, append=len(pos))]).astype(np.int64).tobytes()


def folded(w: Windows, ids: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """For each of the windows `hit`, whether a lesser document of the batch has the same words; the least document comes first."""
    held: dict[bytes, int] = {}
    first, raw = held.setdefault, w.words.raw
    begin, end, doc = w.words.begin[w.at[hit]].tolist(), w.words.end[w.at[hit] + w.width - 1].tolist(), w.doc[hit].tolist()
    least = np.array([first(raw[a:b], d) for a, b, d in zip(begin, end, doc, strict=True)], np.int64)
    return ids[least] < ids[w.doc[hit]] if len(hit) else np.zeros(0, bool)


def repeats(texts: DataFrame, total: int, often: list[tuple[int, float]], width: int, bits: int | None) -> DataFrame:
    """(batch, spans): packed runs of positions that start a window also in a smaller doc_id, by a document's place in its batch.

    texts: batch, doc_id, text. A key of fewer bits lets more suffixes through the sieve and changes no result.
    """
    ranges, groups = ranges_for(total), max(1, math.ceil(total / SUBTREE))
    bits = bits or key_bits(total)
    often = sorted(often)
    frequent = texts.sparkSession.sparkContext.broadcast((np.array([x[0] for x in often], np.uint64), np.array([int(x[1] * 1024) for x in often], np.int64)))
    plain, need = int(-math.log2(FREQUENT) * 1024), int(1024 * (math.log2(groups) + 2)) if groups > 1 else 0

    def send(table: pa.Table) -> pa.Table:
        return message(table["batch"][0].as_py(), np.unique(Windows(ordered(table), width, bits).key), ranges, bits)

    replies = sieve(texts.groupBy("batch").applyInArrow(send, MESSAGE))

    def prefix_groups(w: Windows, at: np.ndarray) -> np.ndarray:
        """The group of the suffixes at some words: of whole 1024ths of a bit, so equal suffixes get equal prefixes."""
        keys, value = frequent.value
        info = np.full(len(w.words.hash), plain)
        if len(keys):
            slot = np.minimum(np.searchsorted(keys, w.words.hash), len(keys) - 1)
            info = np.where(keys[slot] == w.words.hash, value[slot], info)
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(info)])
        prefix = np.clip(np.searchsorted(sums, sums[at] + need) - at, 1, min(ANCHOR, width))
        return ((w.spans.of(at, prefix) >> np.uint64(11)) % np.uint64(groups)).astype(np.int64)

    def leaves(table: pa.Table, flags: pa.Table) -> pa.Table:
        out: dict[str, list] = {"grp": [], "batch": [], "done": [], "leaves": []}

        def row(*values):
            for c, v in zip(out.values(), values, strict=True):
                c.append(v)

        if table.num_rows:
            rows, batch = ordered(table), table["batch"][0].as_py()
            w, ids = Windows(rows, width, bits), np.array([i or 0 for i, _ in rows], np.int64)
            keys, at, n = np.unique(w.key, return_inverse=True, return_counts=True)
            met = (n > 1) | told(keys, flags, ranges, bits)
            hit = np.flatnonzero(met[at])
            known = folded(w, ids, hit)
            if known.any():
                row(-1 - batch, batch, True, runs(w.doc[hit[known]], w.pos[hit[known]]))
            sent = hit[~known]
            anchor = w.anchors(sent)
            new = np.flatnonzero((np.diff(w.at[sent], prepend=-2) != 1) | (np.diff(anchor, prepend=-1) != 0))
            first, last = sent[new], sent[np.append(new[1:], len(sent)) - 1] if len(sent) else sent
            grp = prefix_groups(w, anchor[new])
            a, b = w.words.begin[w.at[first]].tolist(), w.words.end[w.at[last] + width - 1].tolist()
            order = np.argsort(grp, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(grp[order])) + 1):
                if len(part):
                    fixed = np.stack([ids[w.doc[first[part]]], w.doc[first[part]], w.pos[first[part]]]).astype(np.int64).tobytes()
                    row(int(grp[part[0]]), batch, False, len(part).to_bytes(8, "little") + fixed + b"\n".join([w.words.raw[a[k] : b[k]] for k in part.tolist()]))
        return pa.table({"grp": pa.array(out["grp"], pa.int64()), "batch": pa.array(out["batch"], pa.int64()), "done": pa.array(out["done"], pa.bool_()), "leaves": pa.array(out["leaves"], pa.binary())})

    def subtree(table: pa.Table) -> pa.Table:
        if table["done"][0].as_py():
            return table.select(["batch", "leaves"]).rename_columns(["batch", "spans"])
        batch, fixed, stretches = [], [], []
        for b, raw in zip(table["batch"].to_pylist(), table["leaves"], strict=True):
            raw = raw.as_py()
            n = int.from_bytes(raw[:8], "little")
            batch.append(np.full(n, b))
            fixed.append(np.frombuffer(raw[8 : 8 + 24 * n], np.int64).reshape(3, n))
            stretches += raw[8 + 24 * n :].split(b"\n")
        tree = Tree(stretches, width)
        batch, (ids, doc, pos) = np.concatenate(batch)[tree.of], np.concatenate(fixed, axis=1)[:, tree.of]
        order, node = tree.nodes(ids)
        least = ids[order][np.flatnonzero(np.diff(node, prepend=-1))]
        hit = order[ids[order] > least[node]]
        hit = hit[np.argsort(batch[hit], kind="stable")]
        parts = [p for p in np.split(hit, np.flatnonzero(np.diff(batch[hit])) + 1) if len(p)]
        return pa.table({"batch": pa.array([int(batch[p[0]]) for p in parts], pa.int64()), "spans": pa.array([runs(doc[p], (pos + tree.place)[p]) for p in parts], pa.binary())})

    sent = texts.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(leaves, "grp long, batch long, done boolean, leaves binary")
    return sent.groupBy("grp").applyInArrow(subtree, "batch long, spans binary")


def without_repeats(docs: DataFrame, width: int = 13, bits: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for every row of docs (doc_id, text, anything else).

    A word goes if some window of width words that covers it also starts in a document with a smaller
    doc_id; windows are judged on the input, and by their words. kept_text joins the kept words by one space. Null
    texts have no words. Rows without doc_id are left as they are and make no other row repeat. Rows of equal
    doc_id don't make each other repeat. Texts are dealt into batches by one exchange, which all steps read.
    """
    total, often = census(docs)
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, math.ceil(total / BATCH))).cast("long"))
    texts = docs.select(batch.alias("batch"), "doc_id", "text")
    spans = repeats(texts, total, often, width, bits)
    schema = "doc_id long, n_words long, n_removed long, kept_text string"

    def strip(table: pa.Table, spans: pa.Table) -> pa.Table:
        rows = ordered(table)
        found = [np.frombuffer(x, np.int64).reshape(3, -1) for x in binaries(spans["spans"])]
        doc, first, length = np.concatenate([*found, np.zeros((3, 0), np.int64)], axis=1)
        order = np.argsort(doc, kind="stable")
        begin = np.searchsorted(doc[order], np.arange(len(rows) + 1))
        out = {"doc_id": [i for i, _ in rows], "n_words": [], "n_removed": [], "kept_text": []}
        for k, (_, t) in enumerate(rows):
            text = canon(t)
            n, removed = text.count(b" ") + 1 if text else 0, 0
            mine = order[begin[k] : begin[k + 1]]
            if len(mine):
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, first[mine], 1)
                np.add.at(edge, first[mine] + length[mine] + width - 1, -1)
                kept = [x for x, y in zip(text.split(b" "), (np.cumsum(edge)[:-1] == 0).tolist(), strict=True) if y]
                removed, text = n - len(kept), b" ".join(kept)
            out["n_words"].append(n)
            out["n_removed"].append(removed)
            out["kept_text"].append(text.decode())
        return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "n_words": pa.array(out["n_words"], pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()), "kept_text": pa.array(out["kept_text"], pa.string())})

    return texts.groupBy("batch").cogroup(spans.groupBy("batch")).applyInArrow(strip, schema)


def removal_digest(docs: DataFrame, width: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept text."""
    return without_repeats(docs, width).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))
