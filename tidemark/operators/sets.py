"""Set operations and set-valued aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sorted_set(c: str | Column) -> Column:
    """Distinct values, nulls dropped, in order."""
    return F.array_sort(F.collect_set(c))


def sorted_set_where(c: str, test: Column) -> Column:
    return F.array_sort(F.collect_set(F.when(test, F.col(c))))


def exploded_set(df: DataFrame, by: list[str], values: Column | str, name: str) -> DataFrame:
    """Distinct elements of a list column for each key; elements are made distinct before they are gathered."""
    return df.select(*by, F.explode(values).alias("_e")).distinct().groupBy(*by).agg(sorted_set("_e").alias(name))


def merged_sets(old: DataFrame, new: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Union of prior set state and a batch's sets, key by key."""
    both = old.select(*by, *columns).unionByName(new.select(*by, *columns))
    return both.groupBy(*by).agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in columns])


def set_digest(c: str) -> Column:
    """SHA-256 of the sorted distinct values joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ","), 256)


def ordered_digest(df: DataFrame, by: list[str], order: str, value: str, chunk: int = 100_000) -> DataFrame:
    """(by, n_ids, digest) of a group's values in order: SHA-256 of the joined digests of its chunks, each of `chunk` values.

    The same for groups of every size: one of a single chunk is the digest of that chunk's digest. Numbering runs over
    a group in order, spilling if need be; strings are joined chunk by chunk, and only the chunk digests of a group meet.
    """
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy(*by).orderBy(order)) - 1
    rows = df.select(*by, F.col(order).alias("_o"), F.col(value).cast("string").alias("_v"), n.alias("_n")).withColumn("_chunk", F.floor(F.col("_n") / chunk))
    sha = lambda c: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["v"]), ","), 256)
    parts = rows.groupBy(*by, "_chunk").agg(F.count("*").alias("_k"), sha(F.struct(F.col("_n").alias("n"), F.col("_v").alias("v"))).alias("_d"))
    whole = parts.groupBy(*by).agg(F.sum("_k").alias("n_ids"), sha(F.struct(F.col("_chunk").alias("n"), F.col("_d").alias("v"))).alias("digest"))
    return whole.select(*by, "n_ids", "digest")


def owners(df: DataFrame, key: str | Column, owner: str, name: str = "n_owners", more_than: int = 1) -> DataFrame:
    """Keys that belong to more than one owner."""
    k = F.col(key) if isinstance(key, str) else key
    return df.where(k.isNotNull()).groupBy(k.alias("key")).agg(F.count_distinct(owner).alias(name)).where(F.col(name) > more_than)


def churned(df: DataFrame, ticker: str, fields: list[str]) -> DataFrame:
    """Tickers with more than one value in any field over their history."""
    groups = df.groupBy(ticker).agg(*[F.count_distinct(f).alias(f"n_{f}") for f in fields])
    test = F.lit(False)
    for f in fields:
        test = test | (F.col(f"n_{f}") > 1)
    return groups.where(test)


def same_set(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """One row: members on the left only, on the right only, and whether the sets are equal."""
    both = left.select(*on).distinct().withColumn("_l", F.lit(1)).join(right.select(*on).distinct().withColumn("_r", F.lit(1)), on, "full")
    out = both.agg(F.count_if(F.col("_r").isNull()).alias("left_only"), F.count_if(F.col("_l").isNull()).alias("right_only"))
    return out.withColumn("equal", (F.col("left_only") == 0) & (F.col("right_only") == 0))
