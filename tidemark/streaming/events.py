"""Structured Streaming: windows with watermarks, open intervals as state, merges that equal a recomputation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def tumbling(events: DataFrame, time: str, width: str, by: list[str], value: str, late: str | None = None) -> DataFrame:
    """Count and sum of each window and group; as a stream, rows later than the watermark are left out."""
    rows = events.withWatermark(time, late) if late and events.isStreaming else events
    out = rows.groupBy(F.window(time, width), *by).agg(F.count("*").alias("n_rows"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("window_start"), *by, "n_rows", "total")


def sessions(events: DataFrame, time: str, gap: str, by: list[str], late: str | None = None) -> DataFrame:
    """Sessions of each group: rows closer than the gap belong together."""
    rows = events.withWatermark(time, late) if late and events.isStreaming else events
    out = rows.groupBy(F.session_window(time, gap), *by).agg(F.count("*").alias("n_rows"))
    return out.select(*by, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n_rows")


def first_seen(events: DataFrame, time: str, keys: list[str], late: str) -> DataFrame:
    """Each key once; as a stream, keys are forgotten behind the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


INTERVAL = "ticker string, state string, first_index long, last_index long, n_rows long"


def closed_intervals(observations: DataFrame) -> DataFrame:
    """Runs that close as observations (ticker, session_index, state) come in: one open run a ticker is kept as state.

    A gap or a change of state closes a run. A session that isn't later than what the ticker has is refused: late
    data must come as a correction. A null state closes the run and opens none.
    """

    def step(key, frames: Iterator[pd.DataFrame], held: GroupState):
        run = list(held.get) if held.exists else None
        out = []
        for frame in frames:
            for index, state in frame.sort_values("session_index")[["session_index", "state"]].itertuples(index=False):
                if run is not None and index <= run[2]:
                    raise ValueError("a session that isn't later than the last one")
                known = state is not None and not pd.isna(state)
                if run is not None and run[0] is not None and known and state == run[0] and index == run[2] + 1:
                    run = [run[0], run[1], int(index), run[3] + 1]
                    continue
                if run is not None and run[0] is not None:
                    out.append((key[0], *run))
                run = [state if known else None, int(index), int(index), 1]
        held.update(tuple(run))
        yield pd.DataFrame(out, columns=["ticker", "state", "first_index", "last_index", "n_rows"])

    return observations.groupBy("ticker").applyInPandasWithState(step, INTERVAL, "state string, first_index long, last_index long, n_rows long", "append", GroupStateTimeout.NoTimeout)


AGGREGATES = {"n_rows": "sum", "first_session": "min", "last_session": "max"}


def batch_state(rows: DataFrame, key: str, day: str, variants: list[str]) -> DataFrame:
    """State of one batch: rows, first and last session, and sets of variants, all of which merge."""
    return rows.groupBy(key).agg(F.count("*").alias("n_rows"), F.min(day).alias("first_session"), F.max(day).alias("last_session"), *[F.array_sort(F.collect_set(v)).alias(v) for v in variants])


def merge_state(old: DataFrame, new: DataFrame, key: str, variants: list[str]) -> DataFrame:
    """The state of both batches together."""
    both = old.unionByName(new)
    out = [getattr(F, f)(c).alias(c) for c, f in AGGREGATES.items()]
    return both.groupBy(key).agg(*out, *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(v)))).alias(v) for v in variants])


class StateSink:
    """A foreachBatch sink that keeps master state in versioned folders: batch n reads n - 1 and writes n.

    A batch that is run again finds its folder complete and does nothing, so a restart changes nothing.
    """

    def __init__(self, root: str, key: str, day: str, variants: list[str]):
        self.root, self.key, self.day, self.variants = root, key, day, variants

    def __call__(self, batch: DataFrame, number: int) -> None:
        from ..sources.sinks import exists, put_text

        spark = batch.sparkSession
        if exists(spark, f"{self.root}/{number}.done"):
            return
        state = batch_state(batch, self.key, self.day, self.variants)
        if number:
            state = merge_state(spark.read.parquet(f"{self.root}/{number - 1}"), state, self.key, self.variants)
        state.write.mode("overwrite").parquet(f"{self.root}/{number}")
        put_text(spark, f"{self.root}/{number}.done", "")

    def read(self, spark: SparkSession, number: int) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{number}")
