"""Factor plug-ins, and the cross-sectional and rolling pieces they are made of."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import plain_ratio

#: What a factor returns, in order.
OUTPUT = (("signal_date", "date"), ("asset_id", "string"), ("raw_value", "double"))


class FactorError(ValueError):
    """A factor's frame isn't what its contract says."""


@dataclass(frozen=True)
class FactorSpec:
    name: str
    compute: Callable[[DataFrame], DataFrame]
    lookback_sessions: int = 0
    required_columns: tuple[str, ...] = ()

    def run(self, frame: DataFrame) -> DataFrame:
        """compute(frame), exactly signal_date, asset_id, raw_value, cast; nothing is executed."""
        out = self.compute(frame)
        if [c for c, _ in OUTPUT] != out.columns:
            raise FactorError(f"{self.name}: {out.columns}")
        return out.select(*[F.col(c).cast(k).alias(c) for c, k in OUTPUT])


def link_returns(df: DataFrame, asset: str, day: str, price: str, dividend: str | None = None, split: str | None = None, plain: bool = False) -> DataFrame:
    """Adds link_return of each session on the last one: (price * split + dividend) / previous price - 1.

    Null unless the previous price is positive; with plain, the ratio as doubles have it: infinite or not a number on 0.
    """
    prev = F.lag(price).over(W.partitionBy(asset).orderBy(day))
    value = F.col(price) * (F.coalesce(split, F.lit(1.0)) if split else F.lit(1.0)) + (F.coalesce(dividend, F.lit(0.0)) if dividend else F.lit(0.0))
    return df.withColumn("link_return", plain_ratio(value, prev) - 1 if plain else F.when(prev > 0, value / prev - 1))


def split_factor(df: DataFrame, asset: str, day: str, split_from: str, split_to: str) -> DataFrame:
    """Adds cumulative_factor: the running product of split_to / split_from."""
    order = W.partitionBy(asset).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("cumulative_factor", F.exp(F.sum(F.log(F.col(split_to) / F.col(split_from))).over(order)))


def momentum(df: DataFrame, asset: str, day: str, price: str, sessions: int = 20) -> DataFrame:
    """Return over `sessions` rows, a plain ratio: on a price of 0 infinite or not a number, null only without a price."""
    order = W.partitionBy(asset).orderBy(day)
    past = F.lag(price, sessions).over(order)
    return df.select(F.col(day).alias("signal_date"), F.col(asset).cast("string").alias("asset_id"), (plain_ratio(price, past) - 1).alias("raw_value"))


def reversal(df: DataFrame, asset: str, day: str, price: str, sessions: int = 5) -> DataFrame:
    return momentum(df, asset, day, price, sessions).withColumn("raw_value", -F.col("raw_value"))


def rolling(df: DataFrame, asset: str, day: str, value: str, sessions: int) -> DataFrame:
    """Adds mean, standard deviation and downside deviation of the `sessions` values before each row."""
    w = W.partitionBy(asset).orderBy(day).rowsBetween(-sessions, -1)
    low = F.least(F.col(value), F.lit(0.0))
    return df.withColumns({"rolling_mean": F.avg(value).over(w), "rolling_std": F.stddev_samp(value).over(w), "downside": F.sqrt(F.avg(low * low).over(w)), "rolling_n": F.count(value).over(w)})


def market_model(df: DataFrame, asset: str, day: str, value: str, market: str, sessions: int) -> DataFrame:
    """Adds beta and residual_std of value on market over the `sessions` rows before each row."""
    w = W.partitionBy(asset).orderBy(day).rowsBetween(-sessions, -1)
    both = F.when(F.col(value).isNotNull() & F.col(market).isNotNull(), 1)
    mean = lambda c: F.avg(F.when(both.isNotNull(), c)).over(w)
    x, y = F.col(market), F.col(value)
    var = mean(x * x) - mean(x) * mean(x)
    cov = mean(x * y) - mean(x) * mean(y)
    rows = df.withColumn("beta", F.when(var > 0, cov / var))
    return rows.withColumn("residual_std", F.sqrt(F.greatest(F.lit(0.0), mean(y * y) - mean(y) * mean(y) - F.col("beta") * cov)))


def illiquidity(df: DataFrame, asset: str, day: str, ret: str, turnover: str, sessions: int) -> DataFrame:
    w = W.partitionBy(asset).orderBy(day).rowsBetween(-sessions, -1)
    return df.withColumn("illiquidity", F.avg(F.try_divide(F.abs(ret), F.col(turnover))).over(w))


def seasonality(df: DataFrame, asset: str, day: str, ret: str) -> DataFrame:
    """Adds the mean return of the same calendar month in earlier years."""
    w = W.partitionBy(asset, F.month(day)).orderBy(F.year(day)).rangeBetween(W.unboundedPreceding, -1)
    return df.withColumn("seasonality", F.avg(ret).over(w))


def proxy_vwap(df: DataFrame, keys: list[str], minute: Column, price: str, volume: str, first: int = 570, last: int = 600) -> DataFrame:
    """Volume-weighted close of the bars from 09:30 to 10:00 by default, labelled a proxy; none without volume."""
    rows = df.where((minute >= first) & (minute < last)).groupBy(*keys).agg(F.sum(F.col(price) * F.col(volume)).alias("_pv"), F.sum(volume).alias("_v"))
    return rows.select(*keys, F.try_divide("_pv", "_v").alias("proxy_price"), F.lit("opening_half_hour_proxy").alias("label"))


def cross_section(df: DataFrame, day: str, value: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Adds winsorised, zscore and pct_rank within each day.

    Bounds, mean and deviation come from two aggregations joined back by day: only the rank needs a day in one
    place, and a day has as many rows as there are assets.
    """
    bounds = df.groupBy(day).agg(F.percentile(value, F.array(F.lit(low), F.lit(high))).alias("_q"))
    rows = df.join(bounds, day).withColumn("winsorised", F.greatest(F.least(F.col(value), F.col("_q")[1]), F.col("_q")[0])).drop("_q")
    moments = rows.groupBy(day).agg(F.avg("winsorised").alias("_m"), F.stddev_samp("winsorised").alias("_s"))
    rows = rows.join(moments, day).withColumn("zscore", F.when(F.col("_s") > 0, (F.col("winsorised") - F.col("_m")) / F.col("_s"))).drop("_m", "_s")
    return rows.withColumn("pct_rank", F.percent_rank().over(W.partitionBy(day).orderBy(value)))


def neutralised(df: DataFrame, day: str, group: str, value: str) -> DataFrame:
    """Adds value less the mean of its group that day."""
    means = df.groupBy(day, group).agg(F.avg(value).alias("_m"))
    return df.join(means, [day, group]).withColumn("neutral", F.col(value) - F.col("_m")).drop("_m")
