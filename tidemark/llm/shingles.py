"""SimHash near-duplicates at a Jaccard similarity of five-word shingles, in bit-sliced blocks.

A text's fingerprint is the majority of 256 bits over its distinct shingles. Two sets of a similarity of
PERCENT differ in about 39 of them (48 at worst, for sets of four and five) with a deviation of 6, unrelated sets
in 128 with a deviation of 8; RADIUS lies 6.5 deviations above the first, a chance of 1e-10 at the very limit to
miss a pair, and 5 below the second. Blocks that are compared hold the texts of one shingle: shingles are put in one
order over all texts, those frequent in a sample last, and two sets of that similarity share one among the first
n - ceil(n * PERCENT / 100) + 1 of each, so no pair is lost; the sample changes the order and the cost, never
the result. Pairs within the radius are checked on whole sets.

A first round only takes the links of least spanning forests, and a second those to the nearest texts, so a large group
of near copies gives a few links a text; a third takes all pairs that still lie apart. Of the pairs between two
components the nearest are checked first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, mix64, per_batch, typed, word_hashes
from .components import star_components
from .sieve import MESSAGE, key_bits, message, ranges_for, sieve, told
from .simhash import BITS, BLOCK, block_links, by_group, keep_heads

WIDTH, PERCENT = 5, 80
#: Bits that may differ.
RADIUS = 88
#: How the shares grow that are checked of the pairs between two components, and into how many orders these are dealt.
GROWTH, SALT = 8, 4
#: Rows that the order of grams is learned from, and the most grams that it puts last.
SAMPLE, FREQUENT = 1 << 14, 1 << 18
#: Slots of the bit set that tells which texts are worked out again for the check.
SLOTS = 1 << 22
#: Grams in a batch that the sieve works on, on average.
BATCH = 250_000
WORDS = ["f0", "f1", "f2", "f3"]


def grams(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    Lower-cases A-Z only. Fewer words than a shingle: the whole sequence is one. No words: none.
    """
    ws = text.encode("utf-8", "replace").lower().split() if text else []
    if not ws:
        return np.zeros(0, np.uint64)
    h, k = word_hashes(ws), min(width, len(ws))
    n = len(ws) - k + 1
    x = np.full(n, k, np.uint64)
    for i in range(k):
        x = mix64(x * np.uint64(31) + h[i : i + n])
    return np.unique(x)


def node_of(g: np.ndarray) -> int:
    """A signed 64-bit name of a set of grams."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(g.tobytes())).astype(np.int64))


def prefix(g: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first grams in the common order (count in the sample, hash), as many as lose no similar set."""
    keep = len(g) + PERCENT * len(g) // -100 + 1
    if len(frequent) and len(g):
        at = np.minimum(np.searchsorted(frequent, g), len(frequent) - 1)
        g = g[np.argsort(np.where(frequent[at] == g, counts[at], 0), kind="stable")]
    return g[:keep]


def wide(g: np.ndarray) -> np.ndarray:
    """Four 64-bit words: bit b is set if it is set in over half of the hashes of g. No grams: zero."""
    out = np.zeros(len(WORDS), np.int64)
    for k in range(len(WORDS) if len(g) else 0):
        h = mix64(g + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64))
        at = h.view(np.uint8).reshape(-1, 8).astype(np.int64) + np.arange(0, 2048, 256)
        ones = np.bincount(at.ravel(), minlength=2048).reshape(8, 256) @ BITS
        out[k] = np.packbits(2 * ones > len(g), axis=1, bitorder="little").reshape(8).view(np.int64)[0]
    return out


def lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def common_grams(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Grams that at least three rows of a sample hold, sorted, and how many do."""
    every = max(1, -(-docs.count() // SAMPLE))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    found = per_batch(sample, ["text"], "gram long", lambda texts: {"gram": np.concatenate([*map(grams, texts), np.zeros(0, np.uint64)]).view(np.int64)})
    t = found.groupBy("gram").count().where("count > 2").orderBy(F.desc("count"), "gram").limit(FREQUENT).toArrow()
    g, c = t["gram"].to_numpy().view(np.uint64), t["count"].to_numpy()
    order = np.argsort(g)
    return g[order], c[order]


def marks_of(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n, tokens, fingerprint) for every row: its set's name, size, first grams and 256 bits."""
    order = docs.sparkSession.sparkContext.broadcast(common_grams(docs))

    def work(ids, texts):
        sets = [grams(t) for t in texts]
        fps = np.array([wide(g) for g in sets], np.int64).reshape(-1, len(WORDS))
        named = {"doc_id": ids, "node": [node_of(g) for g in sets], "n": [len(g) for g in sets], "tokens": lists([prefix(g, *order.value) for g in sets])}
        return named | {f: fps[:, k] for k, f in enumerate(WORDS)}

    return per_batch(docs, ["doc_id", "text"], "doc_id long, node long, n int, tokens array<long>, " + ", ".join(f"{f} long" for f in WORDS), work)


def sets_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, grams) of the nodes that pairs name; a bit set keeps most other texts from travelling."""
    wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    slots = wanted.select(F.pmod("node", F.lit(SLOTS)).cast("int").alias("slot")).distinct().toArrow()["slot"].to_numpy()
    bits = np.zeros(SLOTS, bool)
    bits[slots] = True
    held = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def work(texts):
        nodes, sets = [], []
        for t in texts:
            g = grams(t)
            node = node_of(g)
            slot = node % SLOTS
            if held.value[slot >> 3] >> (7 - (slot & 7)) & 1:
                nodes.append(node)
                sets.append(g)
        return {"node": np.array(nodes, np.int64), "grams": lists(sets)}

    found = per_batch(docs, ["text"], "node long, grams array<long>", work)
    return found.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("grams").alias("grams"))


def similar(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets have a similarity of at least PERCENT."""
    sets = cut(sets_of(docs, pairs))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("_x")), "a").join(sets.select(F.col("node").alias("b"), F.col("grams").alias("_y")), "b")
    both = both.select("a", "b", F.size("_x").alias("x"), F.size("_y").alias("y"), F.size(F.array_intersect("_x", "_y")).alias("same"))
    return both.where(F.col("same") * 100 >= (F.col("x") + F.col("y") - F.col("same")) * PERCENT).select("a", "b")


def in_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """rows (token, root, node, ...) with grp, side: the groups that together compare all rows of a token and of different root.

    A token of up to a block of rows is one group. A larger one is dealt into units of about a block: roots that
    exceed a block into units of their own, all others together. Each two units are a group, unless they
    are of one root; a giant root is so read once for each unit that is not of it, not once for each of its own.
    """
    # grp is no mere name of token: a join by token before may not stand for the exchange by grp, as skewed joins are split
    hot = cut(rows.groupBy("token").count().where(F.col("count") > block).select("token"))
    if not hot.take(1):
        return rows.withColumn("grp", F.xxhash64("token")).withColumn("side", F.lit(0))
    large = rows.join(hot, "token", "left_semi")
    own = large.groupBy("token", "root").agg(F.count("*").alias("own"))
    units = own.withColumn("giant", F.when(F.col("own") > block, F.col("root"))).groupBy("token", "giant").agg(F.sum("own").alias("held"))
    units = cut(units.select("token", "giant", F.ceil(F.col("held") / block).cast("int").alias("parts")))
    each = units.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("unit", F.xxhash64("giant", "part"))
    pairs = each.join(each.select("token", F.col("giant").alias("_g"), F.col("unit").alias("_u")), "token").where("giant is null or _g is null or giant <> _g")
    side = F.when(F.col("unit") == F.col("_u"), 0).when(F.col("unit") < F.col("_u"), 1).otherwise(2)
    pairs = pairs.select("token", "unit", F.xxhash64("token", F.least("unit", "_u"), F.greatest("unit", "_u")).alias("grp"), side.alias("side"))
    filed = large.join(own, ["token", "root"]).withColumn("giant", F.when(F.col("own") > block, F.col("root"))).drop("own")
    filed = filed.join(units.select("token", F.col("giant").alias("_g"), "parts"), "token").where(F.col("giant").eqNullSafe(F.col("_g")))
    filed = filed.withColumn("unit", F.xxhash64("giant", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))).drop("giant", "_g", "parts")
    small = rows.join(hot, "token", "left_anti").withColumn("grp", F.xxhash64("token")).withColumn("side", F.lit(0))
    return small.unionByName(filed.join(pairs, ["token", "unit"]).select(*small.columns))


def candidates(rows: DataFrame, prints: DataFrame, thin: str = "", block: int = BLOCK) -> DataFrame:
    """(a, b, d) nodes of different root, d bits apart, under a token of both, of sizes and places that allow the similarity.

    rows: token, root, node, n, pos; prints: node and its fingerprint. Every such pair within the radius is
    there, unless they are thinned out within each block (see block_links): under the first token that two similar sets share, no more than that one and the smaller rest can be
    shared.
    """
    columns = ["grp", "side", "root", "node", "n", "pos", *WORDS]
    dealt = in_blocks(rows, block).join(prints, "node").select(*columns).repartition("grp").sortWithinPartitions("grp", "node")

    def work(keys, side, root, node, n, pos, *words):
        n, pos = n.astype(np.int64), pos.astype(np.int64)

        def allowed(i, j):
            sized = np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * PERCENT
            return sized & (np.minimum(n[i] - pos[i], n[j] - pos[j]) * (100 + PERCENT) >= (n[i] + n[j]) * PERCENT)

        got = block_links(keys, np.stack(words, axis=1), RADIUS, root, side, allowed, thin)
        x, y = node[got[:, 0]], node[got[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(got[:, 2], pa.int32())], ["a", "b", "d"])

    schema = "a long, b long, d int"
    return dealt.mapInArrow(typed(lambda batches: by_group(batches, block, work), schema), schema).distinct()


def rooted(rows: DataFrame, roots: DataFrame, node: str = "node", root: str = "root") -> DataFrame:
    """rows with the root of a column of nodes, anew; a node without links is its own."""
    found = roots.select(F.col("node").alias(node), F.col("root").alias("_found"))
    return rows.drop(root).join(found, node, "left").withColumn(root, F.coalesce("_found", node)).drop("_found")


def joined(docs: DataFrame, links: DataFrame, pairs: DataFrame) -> DataFrame:
    """links and the pairs (a, b, d) that are similar, except such as would join what others join already.

    Of all pairs between two components the nearest are checked first, in shares that grow by GROWTH; pairs whose components
    have met meanwhile need no check. In the end every pair is checked or inside one component.
    """
    share = 1
    while True:
        roots = star_components(links)
        pairs = rooted(rooted(pairs, roots, "a", "ra"), roots, "b", "rb").where("ra <> rb")
        order = W.partitionBy(F.least("ra", "rb"), F.greatest("ra", "rb"), F.pmod(F.xxhash64("a", "b"), F.lit(SALT))).orderBy("d", "a", "b")
        pairs = cut(pairs.withColumn("rank", F.row_number().over(order)))
        if not pairs.take(1):
            return links
        links = cut(links.unionAll(similar(docs, pairs.where(F.col("rank") <= share).select("a", "b"))))
        pairs = pairs.where(F.col("rank") > share).drop("rank")
        share *= GROWTH


def shared_grams(marks: DataFrame) -> DataFrame:
    """(token, node, n, pos) of the first grams that several sets have, and of few others.

    Sets are made distinct before they are dealt into batches; a gram passes if its batch has it twice or another one has it.
    """
    total = marks.agg(F.sum(F.size("tokens"))).first()[0] or 0
    ranges, bits = ranges_for(total), key_bits(total)
    sets = marks.groupBy("node").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    sets = sets.withColumn("batch", F.pmod(F.xxhash64("node"), F.lit(max(1, -(-total // BATCH))).cast("long")))

    def keys_of(table):
        tokens = table["tokens"].combine_chunks()
        flat = tokens.flatten().to_numpy()
        return flat, flat.view(np.uint64) >> np.uint64(64 - bits)

    def send(table):
        return message(table["batch"][0].as_py(), np.unique(keys_of(table)[1]), ranges, bits)

    def keep(table, flags):
        if not table.num_rows:
            return pa.table({"token": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "n": pa.array([], pa.int32()), "pos": pa.array([], pa.int32())})
        tokens, keys = keys_of(table)
        u, at, count = np.unique(keys, return_inverse=True, return_counts=True)
        hit = np.flatnonzero(((count > 1) | told(u, flags, ranges, bits))[at])
        lengths = np.array(table["tokens"].combine_chunks().value_lengths().to_numpy())
        of, begin = np.repeat(np.arange(len(lengths)), lengths), np.cumsum(lengths) - lengths
        row = of[hit]
        return pa.table({"token": pa.array(tokens[hit]), "node": pa.array(table["node"].to_numpy()[row]), "n": pa.array(table["n"].to_numpy()[row], pa.int32()), "pos": pa.array(hit - begin[row], pa.int32())})

    replies = sieve(sets.groupBy("batch").applyInArrow(send, MESSAGE))
    return sets.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(keep, "token long, node long, n int, pos int")


def shingle_components(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, component_id) for every row of docs (doc_id, text, anything else).

    component_id is the least doc_id reachable over pairs of similarity PERCENT / 100 or more. Null and empty
    texts have equal sets and are linked. Rows without doc_id take part in links, but give no component its
    id. Repeated rows stay repeated. An empty table gives an empty result.
    """
    marks = cut(marks_of(docs))
    classes = marks.groupBy("node").agg(F.min("doc_id").alias("least"))
    prints = marks.groupBy("node").agg(*[F.first(c).alias(c) for c in WORDS])  # travels with rows of shared grams alone
    shared = cut(shared_grams(marks))
    links = cut(similar(docs, candidates(shared.withColumn("root", F.col("node")), prints, "forest", block).select("a", "b")))
    for thin in ("nearest", ""):
        shared = rooted(shared, star_components(links))
        mixed = shared.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
        shared = cut(shared.join(mixed, "token", "left_semi"))
        links = joined(docs, links, cut(candidates(shared, prints, thin, block)))
    heads = cut(rooted(classes.select("node", "least"), star_components(links)))
    named = heads.join(heads.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    return marks.select("doc_id", "node").join(named, "node").select("doc_id", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, with one row of each component: that of its least doc_id (see simhash.keep_heads)."""
    return keep_heads(docs, shingle_components(docs))
