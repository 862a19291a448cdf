"""Connected components: edges contracted within each task, the rest by alternating large-star and small-star joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, typed

#: Edges that one task contracts: some 100 MB of arrays.
TASK = 1 << 20


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the nodes of edges (a, b) that aren't the least of their component; root is that least node."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    top = np.arange(len(names))
    x, y = at[: len(a)], at[len(a) :]
    while True:  # names are sorted, so the least label is the least node
        x, y = top[x], top[y]
        live = x != y
        if not live.any():
            break
        x, y = np.maximum(x[live], y[live]), np.minimum(x[live], y[live])
        np.minimum.at(top, x, y)
        while not np.array_equal(flat := top[top], top):
            top = flat
    moved = top != np.arange(len(names))
    return names[moved], names[top[moved]]


def contracted(edges: DataFrame, tasks: int) -> DataFrame:
    """Edges (a, b) that join the same nodes, b the least that a task knows; each task holds its share of them."""

    def run(batches):
        held = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
        if held:
            a, b = forest(*(np.concatenate(c) for c in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return edges.select("a", "b").coalesce(tasks).mapInArrow(typed(run, "a long, b long"), "a long, b long")


def star_components(edges: DataFrame, rounds: int = 40, task: int = TASK) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node it reaches.

    Each task first contracts its edges; where one task holds all of them that is the result. Else each round
    points neighbours at the least neighbour, once for the larger and once for the smaller ones, and cuts lineage.
    Only two numbers a round come to the driver: how many edges there are and their digest, which tell when
    nothing moves any more.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"))
    tasks = max(1, -(-now.count() // task))
    now, last = cut(contracted(now, tasks)), None
    for _ in range(rounds if tasks > 1 else 0):
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == last or state["n"] == 0:
            break
        last = state
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(small.select("a", F.col("m").alias("b")))
        now = cut(small.where("a <> b").distinct())
    else:
        if tasks > 1:
            raise RuntimeError("components did not settle")
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
