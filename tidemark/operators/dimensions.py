"""Reference dictionaries and request logs turned into checked tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import date_quality, is_weekend, strict_date
from .dedupe import conflicting_keys, keep_first
from .quality import quarantine


def dimension(rows: DataFrame, keys: list[str], values: list[str], position: list[str], issues: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(dimension, quarantine): rows with an issue, and all rows of a key with conflicting values, are quarantined; of
    equal rows the first by position stays. Both tables read the same classified rows."""
    bad_keys = conflicting_keys(rows, keys, values).select(*keys).withColumn("_conflict", F.lit(True))
    marked = rows.join(bad_keys, keys, "left")
    good, bad = quarantine(marked, {**issues, "conflicting_key": F.col("_conflict").isNotNull()})
    return keep_first(good, keys, position).drop("_conflict"), bad.drop("_conflict")


def bridge(rows: DataFrame, keys: list[str], values: str, name: str, ordinal: str) -> DataFrame:
    """One row for each element of a list column, with its place from 0."""
    return rows.select(*keys, F.posexplode(values).alias(ordinal, name))


def flattened_flags(rows: DataFrame, keys: list[str], column: str, groups: list[str], flags: list[str]) -> DataFrame:
    """A two-level map of flags as one boolean column for each group and flag."""
    return rows.select(*keys, *[F.col(f"{column}.{g}.{f}").alias(f"{g}_{f}") for g in groups for f in flags])


def change_events(events: DataFrame, identifier: str, ticker: str, raw_date: str) -> tuple[DataFrame, DataFrame]:
    """(events, quarantine): parsed date and its quality, weekend flag, and whether the identifier has several tickers that day."""
    good, bad = quarantine(events.withColumn("event_date", strict_date(raw_date)), {"blank_target": F.trim(F.coalesce(ticker, F.lit(""))) == "", "invalid_date": F.col("event_date").isNull()})
    many = good.groupBy(identifier, "event_date").agg((F.count_distinct(ticker) > 1).alias("same_day_multiple_tickers"))
    out = good.withColumns({"event_date_quality": date_quality("event_date"), "event_date_is_weekend": is_weekend("event_date")})
    return out.join(many, [identifier, "event_date"], "left"), bad


def request_status(requests: DataFrame, events: DataFrame, request: str) -> DataFrame:
    """requests with the number of events that each returned and a status: returned or empty."""
    counts = events.groupBy(request).agg(F.count("*").alias("event_count"))
    out = requests.join(counts, request, "left").withColumn("event_count", F.coalesce("event_count", F.lit(0)))
    return out.withColumn("status", F.when(F.col("event_count") > 0, "returned").otherwise("empty"))
