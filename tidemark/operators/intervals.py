"""Ordered observations to intervals: islands, bounces, and joins on intervals.

Each is one window pass over (ticker, session index); the sort of the first serves those that follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Longest middle run of a bounce, shortest long-standing run.
BOUNCE_MIDDLE, LONG_RUN = 20, 20


def runs(df: DataFrame, ticker: list[str], index: str, state: list[str], extra: list[Column] | None = None) -> DataFrame:
    """Maximal runs of adjacent indexes with equal state: ticker, state, first_index, last_index, n_rows, run_no.

    A gap in the index or any change of state, null being a value, begins a new run. df has one row for each
    (ticker, index).
    """
    order = W.partitionBy(*ticker).orderBy(index)
    s = F.struct(*state)
    rows = df.withColumn("_new", (F.coalesce(F.lag(index).over(order) + 1 != F.col(index), F.lit(True)) | ~F.lag(s).over(order).eqNullSafe(s)).cast("int"))
    rows = rows.withColumn("run_no", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(*ticker, "run_no").agg(*[F.first(c).alias(c) for c in state], F.min(index).alias("first_index"), F.max(index).alias("last_index"), F.count("*").alias("n_rows"), *(extra or []))


def band(n: str | Column) -> Column:
    n = F.col(n) if isinstance(n, str) else n
    return F.when(n == 1, "1").when(n.between(2, 5), "2-5").when(n.between(6, BOUNCE_MIDDLE), "6-20")


def bounces(run_table: DataFrame, ticker: list[str], state: str, middle: int = BOUNCE_MIDDLE) -> DataFrame:
    """A/B/A in adjacent runs: outer states equal and known, the middle another one and at most `middle` long."""
    order = W.partitionBy(*ticker).orderBy("run_no")
    at = lambda c, k: F.lag(c, k).over(order)
    rows = run_table.withColumns({
        "outer_state": at(state, 2), "middle_state": at(state, 1), "_a_end": at("last_index", 2), "middle_first": at("first_index", 1), "middle_last": at("last_index", 1),
    })
    rows = rows.withColumn("middle_sessions", F.col("middle_last") - F.col("middle_first") + 1)
    ok = (F.col("outer_state") == F.col(state)) & (F.col("middle_state") != F.col(state)) & (F.col("_a_end") + 1 == F.col("middle_first")) & (F.col("middle_last") + 1 == F.col("first_index")) & (F.col("middle_sessions") <= middle)
    out = rows.where(ok).withColumn("band", band("middle_sessions"))
    return out.select(*ticker, "outer_state", "middle_state", "middle_first", "middle_last", "middle_sessions", "band", F.col("first_index").alias("resumed_index"))


def bounce_observations(df: DataFrame, spine: DataFrame, figi: str = "observed_composite_figi") -> DataFrame:
    """Bounces over session observations: breaks on a gap, absence, inactivity, a malformed identifier, an incomplete session.

    df: session_date, ticker, active_on_date, identifier. spine: session_date, source_complete, in order. Indexes
    count all sessions, so an unusable one leaves a gap that no run crosses.
    """
    from ..functions.scalar import figi_reason

    numbered = spine.withColumn("session_index", F.row_number().over(W.orderBy("session_date")).cast("long")).where("source_complete")
    rows = df.join(F.broadcast(numbered.select("session_date", "session_index")), "session_date")
    rows = rows.where(F.coalesce(F.col("active_on_date"), F.lit(False)) & figi_reason(figi).isNull())
    return bounces(runs(rows, ["ticker"], "session_index", [figi]), ["ticker"], figi)


def previous_two(df: DataFrame, ticker: list[str], index: str, state: str) -> DataFrame:
    """Each observation with the two before it, and whether the three make A, B, A on adjacent indexes."""
    order = W.partitionBy(*ticker).orderBy(index)
    rows = df.withColumns({"before_2": F.lag(state, 2).over(order), "before_1": F.lag(state, 1).over(order), "_i2": F.lag(index, 2).over(order)})
    is_aba = (F.col("before_2") == F.col(state)) & (F.col("before_1") != F.col(state)) & (F.col("_i2") + 2 == F.col(index))
    return rows.withColumn("is_bounce", F.coalesce(is_aba, F.lit(False))).drop("_i2")


def alias_intervals(df: DataFrame, calendar: DataFrame, ticker: list[str], key: list[str], eligible: str = "eligible") -> DataFrame:
    """Validity intervals of eligible rows with an equal key: valid_from, valid_through, valid_to_exclusive, is_open.

    df: session_date and the rest; calendar: session_date, session_index. An interval closes on an ineligible or
    absent session, a gap, or a change of key; the exclusive end is the next session of the calendar, null while
    the interval reaches the last one.
    """
    days = calendar.select("session_date", "session_index", F.lead("session_date").over(W.orderBy("session_index")).alias("_next"))
    rows = df.where(F.coalesce(F.col(eligible), F.lit(False))).join(F.broadcast(days), "session_date")
    order = F.struct("session_index")
    out = runs(rows, ticker, "session_index", key, [F.min("session_date").alias("valid_from"), F.max("session_date").alias("valid_through"), F.max_by("_next", order).alias("valid_to_exclusive")])
    return out.withColumn("is_open", F.col("valid_to_exclusive").isNull())


def long_runs(run_table: DataFrame, least: int = LONG_RUN) -> DataFrame:
    return run_table.where(F.col("n_rows") >= least)


def interval_lookup(points: DataFrame, intervals: DataFrame, ticker: list[str], at: str, start: str, end: str, payload: list[str]) -> DataFrame:
    """points with the payload of the one interval of their ticker that holds them, or nulls.

    Intervals of a ticker are disjoint: the one that holds a point is the last to start at or before it. Both
    sides are laid in one order and the last interval seen is carried forward, so the join needs one shuffle
    and no product of a ticker's points with its intervals.
    """
    kind = F.struct(F.col(start).alias("s"), F.col(end).alias("e"), *payload)
    a = intervals.select(*ticker, F.col(start).alias("_at"), F.lit(0).alias("_side"), kind.alias("_interval"), F.lit(None).cast(points.select(F.struct(*points.columns).alias("p")).schema["p"].dataType).alias("_point"))
    b = points.select(*ticker, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(a.schema["_interval"].dataType).alias("_interval"), F.struct(*points.columns).alias("_point"))
    order = W.partitionBy(*ticker).orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, 0)
    rows = a.unionByName(b).withColumn("_last", F.last("_interval", ignorenulls=True).over(order)).where("_side = 1")
    inside = F.col("_last.e").isNull() | (F.col("_at") <= F.col("_last.e"))
    return rows.select("_point.*", *[F.when(inside, F.col(f"_last.{p}")).alias(p) for p in payload])


def overlap_pairs(df: DataFrame, ticker: list[str], row_id: str, start: str, end: str) -> DataFrame:
    """(ticker, left_id, right_id) of intervals of a ticker that overlap; the earlier start, then id, is left.

    Pairs are the result. The range condition is bounded on both sides, so a sort-merge join on ticker checks
    only rows of that ticker.
    """
    left = df.select(*ticker, F.col(row_id).alias("left_id"), F.col(start).alias("_ls"), F.col(end).alias("_le"))
    right = df.select(*ticker, F.col(row_id).alias("right_id"), F.col(start).alias("_rs"), F.col(end).alias("_re"))
    before = (F.col("_ls") < F.col("_rs")) | ((F.col("_ls") == F.col("_rs")) & (F.col("left_id") < F.col("right_id")))
    return left.join(right, ticker).where(before & (F.col("_rs") <= F.col("_le"))).select(*ticker, "left_id", "right_id")


def overlap_flags(df: DataFrame, ticker: list[str], start: str, end: str) -> DataFrame:
    """Rows with overlaps_earlier: some interval of the ticker that started before is still open. Linear, for large tickers."""
    order = W.partitionBy(*ticker).orderBy(start, end).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("overlaps_earlier", F.coalesce(F.max(end).over(order) >= F.col(start), F.lit(False)))


def classify_event(event_at: Column | str, start: Column | str, end: Column | str, matched: Column) -> Column:
    """no_match, before, inside or after."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.when(~matched, "no_match").when(c(event_at) < c(start), "before").when(c(event_at) > c(end), "after").otherwise("inside")
