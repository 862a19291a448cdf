"""Request plans: which ranges to ask for, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import stable_digest


def quarters(start: Column, end: Column) -> Column:
    """Array of (first, last) of each calendar quarter between two dates, cut to them."""
    begins = F.sequence(F.trunc(start, "quarter"), F.trunc(end, "quarter"), F.expr("interval 3 month"))
    return F.transform(begins, lambda q: F.struct(F.greatest(q, start).alias("first"), F.least(F.date_sub(F.add_months(q, 3), 1), end).alias("last")))


def years(start: Column, end: Column) -> Column:
    begins = F.sequence(F.trunc(start, "year"), F.trunc(end, "year"), F.expr("interval 12 month"))
    return F.transform(begins, lambda y: F.struct(F.greatest(y, start).alias("first"), F.least(F.date_sub(F.add_months(y, 12), 1), end).alias("last")))


def plan(datasets: DataFrame, calendar: DataFrame) -> DataFrame:
    """One request a row: dataset, first, last, request_id.

    datasets: dataset, fan_out (per_session, quarterly, annual or single), start, end. Only per_session requests meet the
    calendar.
    """
    a, b = F.col("start"), F.col("end")
    ranged = datasets.where("fan_out <> 'per_session'")
    span = F.when(F.col("fan_out") == "quarterly", quarters(a, b)).when(F.col("fan_out") == "annual", years(a, b)).otherwise(F.array(F.struct(a.alias("first"), b.alias("last"))))
    ranges = ranged.select("dataset", F.explode(span).alias("r")).select("dataset", "r.first", "r.last")
    days = F.broadcast(calendar.select("session_date"))
    daily = datasets.where("fan_out = 'per_session'").join(days, (F.col("session_date") >= a) & (F.col("session_date") <= b)).select("dataset", F.col("session_date").alias("first"), F.col("session_date").alias("last"))
    rows = ranges.unionByName(daily)
    return rows.withColumn("request_id", stable_digest(dataset="dataset", first=F.col("first").cast("string"), last=F.col("last").cast("string")))
