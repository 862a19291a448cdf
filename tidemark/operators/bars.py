"""Open, high, low, close from finer bars; session windows; flat-file checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import bad_prices, broken_envelope, count_true, in_window, sure
from ..functions.scalar import is_trimmed_text, on_grid, order_key


def ohlc(df: DataFrame, keys: list[str], time: str, tie: str, price: str, high: str | None = None, low: str | None = None, close: str | None = None, volume: str | None = None) -> DataFrame:
    """First open, highest high, lowest low, last close by (time, tie), and counts; one shuffle, hashed together before it.

    time: a timestamp or a long; tie: a long. A null price is no open and no close, its row counts.
    """
    key = order_key(time, tie, dict(df.dtypes)[time])
    order = lambda c: F.when(F.col(c).isNotNull(), key)
    out = [
        F.min_by(price, order(price)).alias("open"), F.max(high or price).alias("high"), F.min(low or price).alias("low"),
        F.max_by(close or price, order(close or price)).alias("close"), F.count("*").alias("n_bars"),
    ]
    if volume:
        out.append(F.coalesce(F.sum(volume), F.lit(0)).alias("volume"))
    return df.groupBy(*keys).agg(*out)


def with_session(df: DataFrame, calendar: DataFrame, day: str, time: str, regular: bool = False) -> DataFrame:
    """Rows inside their session's half-open window; calendar: session_date, start, end, open, close."""
    c = calendar.select(F.col("session_date").alias("_day"), F.col("open" if regular else "start").alias("_a"), F.col("close" if regular else "end").alias("_b"))
    return df.join(c, F.col(day) == F.col("_day")).where(in_window(time, "_a", "_b")).drop("_day", "_a", "_b")


def bar_issues(ticker: str, o: str, h: str, low: str, c: str, volume: str, time: str, start: str | Column, end: str | Column, step: int | None = None, midnight: bool = False) -> dict[str, Column]:
    """The named faults of a bar: what quarantine() and issue_counts() take."""
    out = {
        "invalid_ticker": ~is_trimmed_text(ticker), "invalid_price": bad_prices(o, h, low, c), "invalid_envelope": broken_envelope(o, h, low, c),
        "invalid_volume": ~sure(F.col(volume) >= 0), "outside_session": ~in_window(time, start, end),
    }
    if step:
        out["unaligned_time"] = ~sure(on_grid(time, step))
    if midnight:
        out["not_midnight"] = ~sure(F.col(time) == (F.col(start) if isinstance(start, str) else start))
    return out


def conversion_report(df: DataFrame, keys: list[str], required: list[str]) -> DataFrame:
    """One row about a delivered file: rows, tickers, duplicate excess, nulls in required columns, sessions seen."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[count_true(F.col(c).isNull()).alias(f"_null_{c}") for c in required if c not in keys])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    nulls = [total(F.when(F.col(c).isNull(), F.col("_n")) if c in keys else F.col(f"_null_{c}")).alias(f"{c}_nulls") for c in required]
    return groups.agg(total("_n").alias("n_rows"), F.count("*").alias("n_keys"), total(F.col("_n") - 1).alias("duplicate_excess"), *nulls)
