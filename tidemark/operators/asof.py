"""What was known when: calendar as-of, effective heads of version chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_after(df: DataFrame, at: str, calendar: DataFrame, mark: str, name: str) -> DataFrame:
    """Adds the first calendar mark strictly after a row's instant, or null.

    Marks are gathered by month, each month with the first mark after it: rows meet only their own month, by an
    equi-join with a table of as many rows as the calendar has months, and need no order of their own.
    """
    month = lambda c: F.date_trunc("month", F.col(c))
    marks = calendar.select(F.col(mark).alias("_m")).where("_m is not null").distinct()
    months = marks.groupBy(month("_m").alias("_b")).agg(F.array_sort(F.collect_set("_m")).alias("_marks"))
    ends = marks.agg(F.date_trunc("month", F.min("_m")).alias("a"), F.date_trunc("month", F.max("_m")).alias("b"))
    spine = ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("_b"))
    months = spine.join(months, "_b", "left").withColumn("_next", F.min(F.col("_marks")[0]).over(W.orderBy("_b").rowsBetween(1, W.unboundedFollowing)))
    first = calendar.agg(F.min(mark).alias("_first"))
    rows = df.withColumn("_at_month", month(at)).join(months, F.col("_at_month") == F.col("_b"), "left")
    found = F.coalesce(F.get(F.filter("_marks", lambda m: m > F.col(at)), F.lit(0)), F.col("_next"))
    start = first.first()["_first"]
    before = F.when(F.col("_b").isNull() & (F.col(at) < F.lit(start)), F.lit(start)) if start is not None else F.lit(None)
    return rows.withColumn(name, F.coalesce(found, before)).drop("_b", "_at_month", "_marks", "_next")


def effective_head(df: DataFrame, series: list[str], version: str, available: str, cutoff: Column | object) -> DataFrame:
    """The last version of each series that is available at the cutoff."""
    known = df.where(F.col(available) <= cutoff)
    return known.withColumn("_rn", F.row_number().over(W.partitionBy(*series).orderBy(F.desc(version)))).where("_rn = 1").drop("_rn")


def chain_faults(df: DataFrame, series: list[str], version: str, row_id: str, supersedes: str, available: str) -> DataFrame:
    """Rows that break a version chain, with what: not contiguous from 1, wrong predecessor, availability going back."""
    order = W.partitionBy(*series).orderBy(version, row_id)
    rows = df.withColumns({"_v": F.row_number().over(order), "_prev": F.lag(row_id).over(order), "_av": F.lag(available).over(order)})
    faults = F.array_compact(F.array(
        F.when(F.col("_v") != F.col(version), "version_not_contiguous"), F.when(~F.col(supersedes).eqNullSafe(F.col("_prev")), "predecessor_mismatch"), F.when(F.col(available) < F.col("_av"), "availability_decreases"),
    ))
    return rows.withColumn("faults", faults).where("size(faults) > 0").drop("_v", "_prev", "_av")


def stable_parent(df: DataFrame, ticker: list[str], index: str, eligible: str, row_id: str, same: list[str]) -> DataFrame:
    """The row that a ticker's next session continues: its last row if eligible, else the eligible one before it, when
    that one agrees in every field of `same`; null otherwise."""
    order = W.partitionBy(*ticker).orderBy(index)
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    ok = F.coalesce(F.col(eligible), F.lit(False))
    state = F.struct(F.col(row_id).alias("id"), F.struct(*same).alias("same"))
    rows = df.withColumn("_before", F.last(F.when(ok, state), ignorenulls=True).over(earlier)).withColumn("_rn", F.row_number().over(W.partitionBy(*ticker).orderBy(F.desc(index)))).where("_rn = 1")
    parent = F.when(ok, F.col(row_id)).when(F.col("_before.same").eqNullSafe(F.struct(*same)), F.col("_before.id"))
    return rows.select(*ticker, F.col(index).alias("last_index"), parent.alias("parent_id"))
