"""Session calendar as data: dates, indexes, and open and close in UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import NEW_YORK, session_bounds_ns


def sessions(spark: SparkSession, first: str, last: str, holidays: list[str] = (), half_days: list[str] = ()) -> DataFrame:
    """session_date, session_index, start_ns and end_ns (New York midnights), open_utc and close_utc, of weekdays but holidays."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("session_date")).where(F.weekday("session_date") < 5)
    for h in holidays:
        days = days.where(F.col("session_date") != F.to_date(F.lit(h)))
    half = F.col("session_date").cast("string").isin(list(half_days)) if half_days else F.lit(False)
    at = lambda hour: F.to_utc_timestamp(F.to_timestamp_ntz(F.concat(F.col("session_date").cast("string"), hour)).cast("timestamp"), NEW_YORK)
    start, end = session_bounds_ns("session_date")
    out = days.withColumns({"start_ns": start, "end_ns": end, "open_utc": at(F.lit(" 09:30:00")), "close_utc": at(F.when(half, " 13:00:00").otherwise(" 16:00:00"))})
    return indexed(out)


def indexed(days: DataFrame) -> DataFrame:
    """Adds session_index; a calendar has some 250 rows a year, so its one window is small."""
    return days.withColumn("session_index", F.row_number().over(W.orderBy("session_date")).cast("long"))


def spine_of(df: DataFrame, day: str) -> DataFrame:
    """The distinct days of a table as a calendar."""
    return indexed(df.select(F.col(day).alias("session_date")).where("session_date is not null").distinct())
