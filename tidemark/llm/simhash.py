"""SimHash near-duplicates, compared in bit-sliced blocks.

A text's fingerprint is the bitwise majority of the XXH64 of its word shingles. Two fingerprints within
two differing bits agree on at least two of four 16-bit quarters, so they meet under one of six keys.
Under a key, fingerprints lie as bit planes: one long integer for each bit, a lane for each fingerprint.
One shift of all planes sets lane i against lane i + d; a carry-save counter of two planes then adds up
the differing bits of thousands of pairs at once, and a block is left as soon as every lane exceeds
the radius.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, per_batch, spare, typed
from .components import star_components

#: Words hashed at a time, so that a very long text takes bounded memory.
PIECE = 1 << 16
#: Fingerprints in a block of bit planes, and links of a block that are held before they are thinned out.
BLOCK, HELD = 4096, 1 << 20
#: Links of a row that are kept where only the nearest are.
NEAREST = 4
QUARTERS = list(itertools.combinations(range(4), 2))
BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """Bit b is set if it is set in over half of the shingles' XXH64 (seed 42), repeats included.

    Lower-cases A-Z only. Fewer words than a shingle: the whole sequence is hashed. No words: zero.
    """
    ws = text.encode("utf-8", "replace").lower().split() if text else []
    if not ws:
        return 0
    if len(ws) < width:
        return xxhash.xxh64_intdigest(b" ".join(ws), seed=42)
    counts, n, digest = np.zeros((8, 256), np.int64), len(ws) - width + 1, xxhash.xxh64_digest
    for at in range(0, n, PIECE):
        part = ws[at : at + PIECE + width - 1]
        joined, ends = b" ".join(part), np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        starts = np.concatenate([[0], ends[:-1]]).tolist()
        raw = b"".join([digest(joined[s:e], 42) for s, e in zip(starts, (ends[width - 1 :] - 1).tolist())])
        got = np.frombuffer(raw, np.uint8).reshape(-1, 8).astype(np.int64) + np.arange(0, 2048, 256)
        counts += np.bincount(got.ravel(), minlength=2048).reshape(8, 256)
    ones = counts @ BITS  # row: byte from the most significant, column: bit from the least
    majority = np.packbits(2 * ones > n, axis=1, bitorder="little")
    return int.from_bytes(majority.tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long."""
    return per_batch(docs, ["doc_id", "text"], "doc_id long, fp long", lambda ids, texts: {"doc_id": ids, "fp": [signed(fingerprint(t)) for t in texts]})


def planes_of(fps: np.ndarray) -> list[int]:
    """Long integers; bit i of plane b is bit b of fingerprint i. A row of fps holds one fingerprint, in words of 64 bits."""
    bits = np.unpackbits(np.ascontiguousarray(fps).reshape(len(fps), -1).view(np.uint8), axis=1, bitorder="little")
    return [int.from_bytes(row.tobytes(), "little") for row in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def lanes(mask: np.ndarray) -> int:
    return int.from_bytes(np.packbits(mask, bitorder="little").tobytes(), "little")


def linked_lanes(planes: list[int], shift: int, valid: int, radius: int, every: int = 4) -> int:
    """The valid lanes i whose fingerprint differs from lane i + shift in at most radius bits.

    After every few planes the lanes beyond the radius are dropped; with the last of them the block is abandoned.
    """
    counter, over = [0] * (radius + 1).bit_length(), 0
    for b, plane in enumerate(planes):
        carry = (plane ^ (plane >> shift)) & valid
        for k in range(len(counter)):  # carry-save: plane k holds the k-th binary digit of every lane's count
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        if b % every == every - 1:
            valid &= ~(over | exceeding(counter, radius, valid))
            if not valid:
                return 0
    return valid


def exceeding(counter: list[int], radius: int, valid: int) -> int:
    """Lanes whose counter is above radius: compared from the highest digit down."""
    above, equal = 0, valid
    for k in range(len(counter) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counter[k]
        else:
            above |= equal & counter[k]
            equal &= ~counter[k]
    return above


def block_links(keys: np.ndarray, fps: np.ndarray, radius: int, root: np.ndarray | None = None, sides: np.ndarray | None = None, allowed=None, thin: str = "forest") -> np.ndarray:
    """Rows (i, j, distance) of equal key and different root within the radius; rows come sorted by key.

    thin: "forest" gives, of all links, those of a least spanning forest over the roots, so a large group gives one for
    each row at most, not each pair; "nearest" those to the NEAREST rows of each row; "" all. sides: only rows of different sides are compared, where they aren't 0.
    allowed(i, j) drops further pairs.
    """
    n = len(fps)
    planes, root, every = planes_of(fps), np.arange(n) if root is None else np.unique(root, return_inverse=True)[1], 4 if fps.ndim == 1 else 16
    raw = np.ascontiguousarray(fps).reshape(n, -1).view(np.uint64)
    held, size = [np.zeros((0, 3), np.int32)], 0
    for shift in range(1, n):
        same = keys[:-shift] == keys[shift:]
        if not same.any():
            break
        mask = same & (root[:-shift] != root[shift:])
        if sides is not None:
            mask &= (sides[:-shift] == 0) | (sides[:-shift] != sides[shift:])
        got = linked_lanes(planes, shift, lanes(mask), radius, every) if mask.any() else 0
        if not got:
            continue
        at = np.flatnonzero(np.unpackbits(np.frombuffer(got.to_bytes((n + 7) // 8, "little"), np.uint8), bitorder="little")[:n])
        if allowed is not None:
            at = at[allowed(at, at + shift)]
        held.append(np.stack([at, at + shift, np.bitwise_count(raw[at] ^ raw[at + shift]).sum(axis=1)], axis=1).astype(np.int32))
        size += len(at)
        if thin and size > HELD:
            held = [THIN[thin](np.concatenate(held), root)]
            size = len(held[0])
    return THIN[thin](np.concatenate(held), root) if thin else np.concatenate(held)


def nearest(links: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The links (i, j, distance) that are among the NEAREST of either end; ties by place."""
    keep, ends = np.zeros(len(links), bool), np.concatenate([links[:, 0], links[:, 1]])
    order = np.lexsort((np.concatenate([links[:, 1], links[:, 0]]), np.tile(links[:, 2], 2), ends))
    begin = np.flatnonzero(np.diff(ends[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(begin, append=len(order)))
    keep[order[rank < NEAREST] % max(1, len(links))] = True
    return links[keep]


def forest(links: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The links (i, j, distance) of a least spanning forest over root; root[i] is a row's label, below len(root)."""
    links = links[np.argsort(links[:, 2], kind="stable")]
    top, out = np.arange(len(root)), []

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for part in np.split(links, np.flatnonzero(np.diff(links[:, 2])) + 1):  # of one distance
        while not np.array_equal(flat := top[top], top):
            top = flat
        part = part[top[root[part[:, 0]]] != top[root[part[:, 1]]]]
        for k, (p, q) in enumerate(zip(root[part[:, 0]].tolist(), root[part[:, 1]].tolist())):
            p, q = find(p), find(q)
            if p != q:
                top[max(p, q)] = min(p, q)
                out.append(part[k])
    return np.array(out, np.int32).reshape(-1, 3)


THIN = {"forest": forest, "nearest": nearest}


def by_group(batches, block: int, work):
    """Calls work with arrays of about a block of rows at a time; the rows come sorted by the first column, whose values are never parted."""
    held, n = [], 0

    def ready(columns):
        for lo, hi in whole_keys(columns[0], block):
            yield work(*(c[lo:hi] for c in columns))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([c.to_numpy() for c in batch.columns])
        n += batch.num_rows
        if n >= 4 * block:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            at = int(np.searchsorted(columns[0] == columns[0][-1], True))  # the last key may go on
            if at:
                yield from ready([c[:at] for c in columns])
            held, n = [[c[at:] for c in columns]], len(columns[0]) - at
    if n:
        yield from ready([np.concatenate(c) for c in zip(*held, strict=True)])


def near_pairs(fps: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """(a, b) edges that span all links between distinct fingerprints (column fp) at most radius apart.

    radius is 2 at most. Keys whose rows exceed a block are dealt into pairs of sub-blocks, each pair a group
    of its own: no task holds an unbounded key, and no candidate is dropped.
    """
    if not 0 <= radius <= 2:
        raise ValueError("four quarters serve a radius of 0 to 2")
    quarter = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    key = [F.shiftleft(F.lit(c).cast("long"), 32).bitwiseOR(F.shiftleft(quarter[i], 16)).bitwiseOR(quarter[j]) for c, (i, j) in enumerate(QUARTERS)]
    keyed = fps.select("fp", F.explode(F.array(*key)).alias("key"))
    counts = keyed.groupBy("key").count().where("count > 1").select("key", F.ceil(F.col("count") / block).cast("int").alias("parts"))
    rows = keyed.join(counts, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    group = F.when(F.col("parts") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    rows = rows.select(group.alias("grp"), "fp")
    rows = rows.repartition("grp").sortWithinPartitions("grp", "fp")

    def work(keys, found):
        got = block_links(keys, found.view(np.uint64), radius)
        return pa.RecordBatch.from_arrays([pa.array(found[got[:, k]], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.mapInArrow(typed(lambda batches: by_group(batches, block, work), "a long, b long"), "a long, b long")


def whole_keys(keys: np.ndarray, block: int):
    """Ranges of about a block of rows that never part a key."""
    ends = np.concatenate([np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
    lo = 0
    while lo < len(keys):
        hi = int(ends[np.searchsorted(ends, min(len(keys), lo + block))])
        if hi - lo > block and (before := ends[(ends > lo) & (ends < hi)]).size:
            hi = int(before[-1])
        yield lo, hi
        lo = hi


def simhash_components(docs: DataFrame, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs (doc_id, text, anything else).

    component_id is the least doc_id reachable over links of at most radius differing bits; rows of equal
    fingerprint are linked. Null and empty texts have fingerprint zero and link like any other. Rows
    without doc_id keep their row and take part in links, but give no component its id (null if none has
    one). Repeated rows stay repeated. An empty table gives an empty result.
    """
    marks = cut(fingerprints(docs))
    classes = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = cut(classes)
    roots = star_components(near_pairs(classes.select("fp"), radius))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = cut(rooted)
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = rooted.join(heads, "root").select("fp", "component_id")
    return marks.join(linked, "fp").select("doc_id", "fp", "component_id")


def hex_of(column) -> F.Column:
    """16 lower-case hexadecimal digits of a long taken as unsigned."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def keep_one(docs: DataFrame, radius: int = 2) -> DataFrame:
    """The rows of docs, all columns, with one row of each component: that of its least doc_id."""
    return keep_heads(docs, simhash_components(docs, radius))


#: Ids that may be broadcast: 8 MB of longs; more are joined by shuffle.
FEW = 1 << 20


def among(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """The rows of docs whose doc_id is (left_semi) or isn't (left_anti) in ids; texts move only if ids are many."""
    name = spare(docs, "_id")[0]
    ids = ids.select(F.col("doc_id").alias(name))
    return docs.join(F.broadcast(ids) if ids.count() <= FEW else ids, F.col("doc_id") == F.col(name), how)


def keep_heads(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose doc_id is its component's in found (doc_id, component_id).

    Of several rows with that doc_id, the one with the least row digest stays. Rows without doc_id can't be
    told apart and stay. Only rows of a repeated doc_id are ordered; the others pass where they are read.
    """
    ids = cut(found.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("head"), F.count("*").alias("n")))
    digest, rank = spare(docs, "_digest", "_rank")
    kept = among(docs, ids.where("not head"), "left_anti")
    many = ids.where("head and n > 1")
    if not many.take(1):
        return kept
    rows = among(kept, many, "left_semi").withColumn(digest, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    first = rows.withColumn(rank, F.row_number().over(W.partitionBy("doc_id").orderBy(digest))).where(F.col(rank) == 1)
    return among(kept, many, "left_anti").unionByName(first.select(*[F.col(f"`{c}`") for c in docs.columns]))
