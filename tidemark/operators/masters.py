"""Histories and masters: one row for each ticker, asset or issuer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sets import sorted_set


def history(df: DataFrame, ticker: str, day: str, active: str, attributes: list[str], end_session) -> DataFrame:
    """First and last seen and active day, ever inactive, active at the end, and the last known value of attributes."""
    on = F.coalesce(F.col(active), F.lit(False))
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(day))).alias(c)
    return df.groupBy(ticker).agg(
        F.min(day).alias("first_seen_date"), F.max(day).alias("last_seen_date"), F.min(F.when(on, F.col(day))).alias("first_active_date"), F.max(F.when(on, F.col(day))).alias("last_active_date"),
        F.bool_or(~on).alias("ever_inactive"), F.coalesce(F.bool_or(on & (F.col(day) == end_session)), F.lit(False)).alias("active_on_end_date"), *[known(c) for c in attributes],
    )


def master(df: DataFrame, key: str, day: str, variants: list[str], direct=None) -> DataFrame:
    """First and last session, rows, direct rows, the sorted variants of each field, and unknown / unique / ambiguous."""
    direct = F.lit(True) if direct is None else direct
    out = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(day).alias("first_session"), F.max(day).alias("last_session"), F.count("*").alias("n_rows"), F.count_if(F.coalesce(direct, F.lit(False))).alias("n_direct"),
        *[sorted_set(v).alias(f"{v}_variants") for v in variants],
    )
    for v in variants:
        n = F.size(f"{v}_variants")
        out = out.withColumn(f"{v}_status", F.when(n == 0, "unknown").when(n == 1, "unique").otherwise("ambiguous"))
    return out


def tail_after_resolved(df: DataFrame, key: str, day: str, resolved) -> DataFrame:
    """Of each key: the last resolved day, and the first and last day and number of rows after it."""
    last = df.groupBy(key).agg(F.max(F.when(resolved, F.col(day))).alias("last_resolved"))
    rows = df.join(last, key).where(F.col("last_resolved").isNull() | (F.col(day) > F.col("last_resolved")))
    tail = rows.groupBy(key).agg(F.min(day).alias("tail_first"), F.max(day).alias("tail_last"), F.count("*").alias("tail_rows"))
    return last.join(tail, key, "left").withColumn("tail_rows", F.coalesce("tail_rows", F.lit(0)))


def inventory(df: DataFrame, identifier: str, share: str, active: str, day: str, attributes: list[str]) -> DataFrame:
    """Of each identifier: share classes and whether they conflict, active and inactive rows, sessions, distinct attributes."""
    on = F.coalesce(F.col(active), F.lit(False))
    return df.where(F.col(identifier).isNotNull()).groupBy(identifier).agg(
        sorted_set(share).alias("share_classes"), F.count_if(on).alias("active_rows"), F.count_if(~on).alias("inactive_rows"), F.count_distinct(day).alias("n_sessions"),
        *[F.count_distinct(a).alias(f"n_{a}") for a in attributes],
    ).withColumn("share_class_conflict", F.size("share_classes") > 1)
