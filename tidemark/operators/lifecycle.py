"""Lifecycles of a ticker: its dated rows filed under records by identity agreement.

Rows of one identity in a row are one run. A ticker is plain if no identity field has two values and one field is
known wherever any is: all its rows are one record, which an aggregate gives. Only the runs of other tickers are
filed one after the other, as what a record knows by then decides; the records known so far are a matrix of identifier
codes, and a run is held against all of them at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import clean, stable_digest

#: Identity fields from the strongest, and what else a record carries.
IDENTITY = ("share_class_figi", "composite_figi", "cik")
CARRIED = ("type", "name", "primary_exchange")
FIELDS = (*IDENTITY, *CARRIED)
WEIGHTS = np.arange(len(IDENTITY), 0, -1)


def latest_known(field: str) -> Column:
    """The last value of a field by day, nulls aside."""
    return F.max_by(F.col(field), F.when(F.col(field).isNotNull(), F.col("day"))).alias(field)


def runs(rows: DataFrame) -> DataFrame:
    """(ticker, run, day, until, n, FIELDS): consecutive rows of a ticker with equal identity, what they carry as last known."""
    by = W.partitionBy("ticker").orderBy("day")
    now = F.struct(*IDENTITY)
    new = F.coalesce(~now.eqNullSafe(F.lag(now).over(by)), F.lit(True))
    marked = rows.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(by))
    return marked.groupBy("ticker", "run", *IDENTITY).agg(F.min("day").alias("first"), F.max("day").alias("until"), F.count("*").alias("n"), *[latest_known(f) for f in CARRIED])


def filed(codes: np.ndarray) -> np.ndarray:
    """The record of each run; codes has a row for each run, in order, and a code for each identifier (0: none).

    A run with an identity joins the record of the greatest weight of equal identifiers among those that contradict none,
    or else the record without identity; a run without any, whichever record; the one used last where several would do. Where
    none will do it begins a record, which from then on knows what its runs know.
    """
    known, used, out = np.zeros((0, codes.shape[1]), codes.dtype), np.zeros(0, np.int64), np.zeros(len(codes), np.int64)
    for k, own in enumerate(codes):
        if own.any():
            both = (known > 0) & (own > 0)
            weight = np.where((both & (known != own)).any(axis=1), 0, (both * WEIGHTS).sum(axis=1))
            fit = weight == weight.max(initial=0) if weight.any() else ~known.any(axis=1)
        else:
            fit = np.ones(len(known), bool)
        if fit.any():
            at = int(np.argmax(np.where(fit, used, -1)))
            known[at] = np.where(own > 0, own, known[at])
            used[at] = k
        else:
            at = len(known)
            known, used = np.vstack([known, own]), np.append(used, k)
        out[k] = at
    return out


def walked(batches):
    """(ticker, run, record) of runs that come ordered by ticker and run; a ticker may go on in the next batch."""
    held: list[tuple] = []

    def out(rows):
        begin = [k for k in range(len(rows)) if not k or rows[k][0] != rows[k - 1][0]]
        record = []
        for a, b in zip(begin, [*begin[1:], len(rows)], strict=True):
            names: list[dict] = [{None: 0} for _ in IDENTITY]
            codes = [[names[k].setdefault(v, len(names[k])) for k, v in enumerate(r[2:])] for r in rows[a:b]]
            record += filed(np.array(codes, np.int64)).tolist()
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array(record, pa.int64())], ["ticker", "run", "record"])

    for batch in batches:
        held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        last = next((k for k in range(len(held) - 1, -1, -1) if held[k][0] != held[-1][0]), -1) + 1
        if last:
            yield out(held[:last])
            held = held[last:]
    if held:
        yield out(held)


def lifecycles(df: DataFrame, day: str = "session_date") -> DataFrame:
    """ticker, first_active_date, last_active_date, n_rows, identity and carried fields, and lifecycle_id of each record.

    df: ticker, day, share_class_figi, composite_figi, cik, type, name, primary_exchange; one row for each ticker and
    day. Blank text is null.
    """
    rows = df.select("ticker", F.col(day).cast("date").alias("day"), *[clean(f).alias(f) for f in FIELDS])
    each = runs(rows)
    some = F.coalesce(*IDENTITY).isNotNull()
    single = [F.coalesce(F.min(f) == F.max(f), F.lit(True)) for f in IDENTITY]
    always = [F.min(F.when(some, F.col(f).isNotNull())) for f in IDENTITY]
    plain = F.coalesce(F.greatest(*always), F.lit(True))
    for x in single:
        plain = plain & x
    kinds = each.groupBy("ticker").agg(plain.alias("plain"))
    both = each.join(kinds, "ticker")
    unclear = both.where("not plain").select("ticker", F.col("run").cast("long").alias("run"), *IDENTITY)
    placed = unclear.repartition("ticker").sortWithinPartitions("ticker", "run").mapInArrow(walked, "ticker string, run long, record long")
    records = both.where("plain").drop("plain").withColumn("record", F.lit(0).cast("long")).unionByName(both.where("not plain").drop("plain").join(placed, ["ticker", "run"]))
    records = records.withColumn("day", F.col("until"))
    out = records.groupBy("ticker", "record").agg(F.min("first").alias("first_active_date"), F.max("until").alias("last_active_date"), F.sum("n").alias("n_rows"), *[latest_known(f) for f in FIELDS])
    kind = F.lit("ticker")
    for f in reversed(IDENTITY):
        kind = F.when(F.col(f).isNotNull(), f).otherwise(kind)
    out = out.drop("record").withColumn("identity_type", kind).withColumn("identity_value", F.coalesce(*IDENTITY, "ticker"))
    return out.withColumn("lifecycle_id", stable_digest(first_active_date=F.col("first_active_date").cast("string"), identity_type="identity_type", identity_value="identity_value", ticker="ticker"))


def identity_match(expected: dict[str, str], actual: dict[str, str], kind: str, ticker: str, response_ticker: str) -> tuple[Column, Column]:
    """(matches, basis): all comparable identifiers agree and at least one is comparable; the strongest is the basis.

    A lifecycle known by ticker alone matches on the ticker.
    """
    any_equal, any_conflict, basis = F.lit(False), F.lit(False), F.lit(None).cast("string")
    for f in reversed(IDENTITY):
        both = F.col(expected[f]).isNotNull() & F.col(actual[f]).isNotNull()
        equal = F.coalesce(F.col(expected[f]) == F.col(actual[f]), F.lit(False))
        any_equal, any_conflict = any_equal | equal, any_conflict | (both & ~equal)
        basis = F.when(equal, f).otherwise(basis)
    by_ticker = F.coalesce(F.col(ticker) == F.col(response_ticker), F.lit(False))
    ok = F.when(F.col(kind) == "ticker", by_ticker).otherwise(any_equal & ~any_conflict)
    return ok, F.when(ok, F.when(F.col(kind) == "ticker", "ticker").otherwise(basis))
