"""Sharding by longest-processing-time scheduling.

Groups of equal texts stay together. Groups, heaviest first, go to the least-loaded shard through a heap, every
one of them. Groups of equal size are alike to the heap, so it is driven by how many groups there are of each size:
the sizes of a corpus add up to its bytes at least, so there are no more than the square root of twice the bytes.
Of c equal groups the heap gives some to shards in turn, again and again, until their loads reach that of
a fuller shard; each such piece is one row, and a group finds its shard by its number among those of its size.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

#: Rows numbered in one task, on average.
RUN = 50_000
#: A group with this share of all bytes is joined by broadcast: there are no more than SHARES of them.
SHARES = 4096
#: Rows of a table by size that may be broadcast; more are joined by shuffle.
FEW = 100_000
#: Passes over repeated rows that are numbered one after the other; later ones share their runs.
PASSES = 64


def lpt(sizes: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """item -> shard: the heaviest item first (ties by item), each to the least-loaded shard (ties: the lowest)."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def pieces(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, list[int]]]:
    """(size, first, turn) for classes (size, groups): from number `first` on, groups of that size go to the shards of turn, in turn.

    The shards that lpt() would take, without a step for each group: a shard that the heap gives a group comes up
    again only after all others of no greater load, so the order repeats until loads reach the next shard's.
    """
    heap, out = [(0, s) for s in range(shards)], []
    for size, n in sorted(classes, reverse=True):
        done = 0
        while done < n:
            # shards that come up before the first of them does again; the next one waits at `wall`
            turn = [heapq.heappop(heap)]
            while heap and heap[0] < (turn[0][0] + size, turn[0][1]):
                turn.append(heapq.heappop(heap))
            rounds = (n - done) // len(turn)
            if heap:  # whole rounds while the last of turn comes up before the wall
                (load, shard), (wall, other) = turn[-1], heap[0]
                rounds = min(rounds, (wall - load) // size + (1 if (load + (wall - load) // size * size, shard) < (wall, other) else 0))
            if not rounds:
                rounds, rest = 1, turn[n - done :]
                turn = turn[: n - done]
                for x in rest:
                    heapq.heappush(heap, x)
            out.append((size, done, [s for _, s in turn]))
            done += rounds * len(turn)
            for load, s in turn:
                heapq.heappush(heap, (load + rounds * size, s))
    return out


def sized(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 8; null texts have no bytes), crc, group (digest of the text) and key of every row."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    digest = F.unhex(F.sha2(text, 256))
    key = F.xxhash64("doc_id", digest).bitwiseAND(F.lit((1 << 60) - 1)) if key is None else key
    return docs.select("doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("crc"), digest.alias("group"), key.alias("key"))


def numbered(groups: DataFrame) -> DataFrame:
    """groups (group, size, of: groups of that size) with number: from 0 by digest among those of a size, in runs that fit a task."""
    head = F.conv(F.substring(F.hex("group"), 1, 7), 16, 10).cast("long")
    runs = F.greatest(F.ceil(F.col("of") / RUN), F.lit(1))
    rows = groups.withColumn("run", F.floor(head * runs / (1 << 28)).cast("long"))
    counts = rows.where(runs > 1).groupBy("size", "run").count()
    before = counts.select(F.col("size").alias("_s"), F.col("run").alias("_r"), (F.sum("count").over(W.partitionBy("size").orderBy("run")) - F.col("count")).alias("before"))
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("size", "run").orderBy("group")))
    rows = rows.join(before, (F.col("size") == F.col("_s")) & (F.col("run") == F.col("_r")), "left")
    return rows.withColumn("number", F.coalesce("before", F.lit(0)) + F.col("rank") - 1).drop("_s", "_r", "run", "rank", "before")


def few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= FEW else df


def shard_lpt(docs: DataFrame, shards: int = 24, key: Column | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of docs (doc_id, text, anything else).

    Rows of equal text share a shard; null counts as the empty text. Groups are placed as lpt() places them, ties
    by digest: loads in bytes differ by no more than the last groups placed, unless one outweighs a whole
    shard. Slots run gapless from 0 in each shard, in the order of slots(). Repeated rows and rows without doc_id
    each get a slot of their own. The driver holds a row for each distinct group size. An empty table gives an
    empty result.
    """
    rows = cut(sized(docs, key))
    groups = cut(rows.groupBy("group").agg(F.sum("size").alias("size")))
    classes = groups.groupBy("size").agg(F.count("*").alias("of"))
    found = pieces([(r["size"], r["of"]) for r in classes.collect()], shards)
    spark = docs.sparkSession
    plan = cut(spark.createDataFrame(found or [(0, 0, [0])], "size long, first long, turn array<int>").groupBy("size").agg(F.sort_array(F.collect_list(F.struct("first", "turn"))).alias("plan")))
    placed = numbered(groups.join(few(cut(classes)), "size")).join(few(plan), "size")
    mine = F.element_at(F.filter("plan", lambda p: p["first"] <= F.col("number")), -1)
    placed = cut(placed.select("group", "size", F.element_at(mine["turn"], (F.pmod(F.col("number") - mine["first"], F.size(mine["turn"])) + 1).cast("int")).alias("shard")))
    least = -(-(classes.agg(F.sum(F.col("size") * F.col("of"))).first()[0] or 0) // SHARES)
    heavy = placed.where(F.col("size") >= least).select(F.col("group").alias("_g"), F.col("shard").alias("_own"))
    rows = rows.join(F.broadcast(heavy), F.col("group") == F.col("_g"), "left").drop("_g")
    own, rest = rows.where("_own is not null").withColumnRenamed("_own", "shard"), rows.where("_own is null").drop("_own").join(placed.select("group", "shard"), "group")
    return slots(own.unionByName(rest), shards)


def slots(rows: DataFrame, shards: int) -> DataFrame:
    """Numbers the rows of each shard from 0 without a gap, in runs that fit a task; only the runs' counts meet.

    Order: how often an equal row came before, then key (60 bits), doc_id, digest. Equal rows are counted first.
    """
    alike = cut(rows.groupBy("shard", "key", "doc_id", "group", "size", "crc").agg(F.count("*").alias("n")))
    runs = max(1, -(-(alike.agg(F.sum("n")).first()[0] or 0) // (shards * RUN)))
    each = alike.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    run = F.when(F.col("copy") < PASSES, F.floor(F.shiftright("key", 30) * runs / (1 << 30))).otherwise(F.pmod("copy", F.lit(runs)))
    each = each.withColumn("turn", F.least("copy", F.lit(PASSES))).withColumn("run", run.cast("long"))
    counts = each.groupBy("shard", "turn", "run").count()
    before = counts.select("shard", "turn", "run", (F.sum("count").over(W.partitionBy("shard").orderBy("turn", "run")) - F.col("count")).alias("before"))
    each = each.withColumn("rank", F.row_number().over(W.partitionBy("shard", "turn", "run").orderBy("copy", "key", "doc_id", "group")))
    return each.join(before, ["shard", "turn", "run"]).select("doc_id", "size", F.col("crc").alias("text_crc32"), "shard", (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 24, key: Column | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row, under the law of equal bytes; slots follow key."""
    return shard_lpt(docs, shards, key).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
