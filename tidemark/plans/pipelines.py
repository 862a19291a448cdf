"""Domain pipelines: the operators put together. All sessions go through one plan; nothing loops over days."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalar as S
from ..operators import asof, bars, dedupe, identity, intervals, masters, quality, reconcile, semantics
from ..operators.dimensions import bridge, dimension
from ..operators.sets import same_set

PRICES = ["open", "high", "low", "close"]


# --- flat files, universe, coverage ---------------------------------------------------------------------------


def convert_bars(raw: DataFrame, expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bars, report): window_start in ns gets its UTC instant and New York session; report says whether the sessions
    seen are the expected ones (session_date), and counts rows, tickers, duplicates, nulls."""
    out = raw.withColumn("window_start_utc", S.ns_to_timestamp("window_start")).withColumn("session_date", S.new_york_date("window_start_utc"))
    report = bars.conversion_report(out, ["ticker", "window_start"], ["ticker", "window_start", *PRICES, "volume"])
    return out.sortWithinPartitions("session_date", "ticker", "window_start"), report.join(same_set(out, expected, ["session_date"]))


def daily_universe(active: DataFrame, inactive: DataFrame, day: str = "session_date") -> tuple[DataFrame, DataFrame]:
    """(universe, faults): both listings of every session together; faults: a ticker twice, or a flag against its listing."""
    rows = active.withColumn("requested_active", F.lit(True)).unionByName(inactive.withColumn("requested_active", F.lit(False)))
    twice = rows.groupBy(day, "ticker").agg(F.count("*").alias("n")).where("n > 1").select(day, "ticker", F.lit("ticker_not_unique").alias("fault"))
    wrong = rows.where(~F.col("active").eqNullSafe(F.col("requested_active"))).select(day, "ticker", F.lit("active_flag_mismatch").alias("fault"))
    return rows.drop("requested_active"), twice.unionByName(wrong)


def daily_coverage(universe: DataFrame, minute: DataFrame, day: str = "session_date") -> DataFrame:
    """Each session's tickers with bar statistics and their coverage state."""
    stats = minute.groupBy(day, "ticker").agg(F.count("*").alias("n_bars"), F.min("window_start").alias("first_bar"), F.max("window_start").alias("last_bar"), F.lit(True).alias("_bar"))
    both = universe.select(day, "ticker", "active", F.lit(True).alias("_ref")).join(stats, [day, "ticker"], "full")
    ref, bar = F.col("_ref").isNotNull(), F.col("_bar").isNotNull()
    return both.withColumn("state", reconcile.coverage_state(ref, bar, P.sure(F.col("active")))).withColumn("n_bars", F.coalesce("n_bars", F.lit(0))).drop("_ref", "_bar")


# --- audits ---------------------------------------------------------------------------------------------------


def minute_day_audit(minute: DataFrame, day_bars: DataFrame, calendar: DataFrame, absolute: float = 1e-6, relative: float = 1e-6, bad: Callable[..., Column] = P.bad_prices) -> DataFrame:
    """One row a session: pairs, one-sided tickers, field mismatches, tickers without regular bars, coverage status.

    minute: session_date, ticker, window_start, prices, volume, transactions; day_bars the same by day. Rows whose prices
    are `bad` (by default not positive and finite) are left out of the rebuild, duplicates fall to their first in a total
    order. Prices come from regular hours, volume from the whole day; a null price is no open and no close.
    """
    fields = [*PRICES, "volume", "transactions"]
    good = minute.where(~bad(*PRICES))
    once = dedupe.keep_first(good, ["session_date", "ticker", "window_start"], [*PRICES, "volume", "transactions"])
    hours = calendar.select("session_date", "open_ns", "close_ns")
    rows = once.join(F.broadcast(hours), "session_date")
    regular = P.in_window("window_start", "open_ns", "close_ns")
    order = lambda c: F.when(regular & F.col(c).isNotNull(), F.col("window_start"))
    derived = rows.groupBy("session_date", "ticker").agg(
        F.min_by("open", order("open")).alias("open"), F.max(F.when(regular, F.col("high"))).alias("high"), F.min(F.when(regular, F.col("low"))).alias("low"), F.max_by("close", order("close")).alias("close"),
        F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"), F.coalesce(F.sum("transactions"), F.lit(0)).alias("transactions"), F.count_if(regular).alias("regular_bars"),
    )
    official = dedupe.keep_first(day_bars.where(~bad(*PRICES)), ["session_date", "ticker"], fields)
    both = reconcile.full_compare(derived, official, ["session_date", "ticker"], fields, ("minute", "day")).join(derived.select("session_date", "ticker", "regular_bars"), ["session_date", "ticker"], "left")
    out = both.groupBy("session_date").agg(
        P.count_true(F.col("in_minute") & F.col("in_day")).alias("pairs"), P.count_true(F.col("in_minute") & ~F.col("in_day")).alias("minute_only"), P.count_true(F.col("in_day") & ~F.col("in_minute")).alias("day_only"),
        P.count_true(F.col("in_minute") & F.col("in_day") & (F.col("regular_bars") == 0)).alias("no_regular_bars"),
        *[P.count_true(S.differs(f"minute_{f}", f"day_{f}", absolute, relative)).alias(f"{f}_mismatches") for f in fields],
    )
    out = out.withColumn("_missing", F.col("minute_only") + F.col("day_only")).withColumn("_all", F.col("_missing") + F.col("pairs"))
    return out.withColumn("status", reconcile.coverage_status("_missing", "_all")).drop("_missing", "_all")


def product_audit(flat: DataFrame, rest: DataFrame, envelope: DataFrame, absolute: float = 1e-6, relative: float = 1e-6) -> DataFrame:
    """One row a session: flat day bars against the grouped REST product, and the envelope's row count against the rows.

    rest: session_date, ticker, prices, volume, transactions (may be null), page, ordinal. envelope: session_date,
    results_count. A missing optional field is counted, not compared.
    """
    fields = [*PRICES, "volume", "transactions"]
    one = dedupe.keep_first(flat, ["session_date", "ticker"], fields)
    two = dedupe.keep_first(rest, ["session_date", "ticker"], ["page", "ordinal"])
    both = reconcile.full_compare(one, two, ["session_date", "ticker"], fields, ("flat", "rest"))
    out = reconcile.mismatch_summary(both, fields, ("flat", "rest"), absolute, relative, ["session_date"])
    missing = two.groupBy("session_date").agg(F.count_if(F.col("transactions").isNull()).alias("transactions_missing"))
    rows = rest.groupBy("session_date").agg(F.count("*").alias("_rows"))
    counts = envelope.join(rows, "session_date", "full").select("session_date", F.col("results_count").eqNullSafe(F.coalesce("_rows", F.lit(0))).alias("envelope_ok"))
    return out.join(missing, "session_date", "left").join(counts, "session_date", "left")


def semantic_audit(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """(dataset, n_rows, distinct_keys, excess_rows, conflicting_keys, status) of each dataset's candidate key."""
    out = None
    for name, df in tables.items():
        row = semantics.uniqueness(df, keys[name], [c for c in df.columns if c not in keys[name]]).withColumn("dataset", F.lit(name))
        out = row if out is None else out.unionByName(row)
    status = F.when(F.col("conflicting_keys") > 0, "failed").when(F.col("excess_rows") > 0, "different").otherwise("passed")
    return out.withColumn("status", status)


def filing_coverage(index: DataFrame, detail: DataFrame) -> DataFrame:
    """One row: details whose accession the index lacks, whose filing date no index row has, whose filer no index row has."""
    keys = lambda cs: (detail.select("accession", *cs).distinct(), index.select("accession", *cs).distinct())
    d, i = keys([])
    n = lambda df, c: df.agg(F.count("*").alias(c))
    missing = n(semantics.undefined_uses(d, i, ["accession"]), "missing_accessions")
    d, i = keys(["filing_date"])
    dates = n(semantics.present_but_disagreeing(d, i, ["accession"], ["filing_date"]), "filing_date_mismatches")
    d, i = keys(["filing_date", "cik"])
    filers = n(semantics.present_but_disagreeing(d, i, ["accession", "filing_date"], ["cik"]), "filer_mismatches")
    return missing.join(dates).join(filers)


def source_profile(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, present, nulls, empty, blank, untrimmed, booleans, numbers, distinct) of text fields that hold JSON values."""
    def one(f: str) -> Column:
        kind = S.native_type(f)
        return F.struct(
            F.lit(f).alias("field"), P.count_true(F.col(f).isNotNull()).alias("present"), P.count_true(F.col(f).isNull()).alias("nulls"), P.count_true(F.col(f) == "").alias("empty"),
            P.count_true((F.col(f) != "") & S.clean(f).isNull()).alias("blank"), P.count_true(S.clean(f).isNotNull() & (S.clean(f) != F.col(f))).alias("untrimmed"),
            P.count_true(kind == "boolean").alias("booleans"), P.count_true(kind.isin("integer", "number")).alias("numbers"), F.count_distinct(f).alias("distinct"),
        )

    return df.agg(F.array(*[one(f) for f in fields]).alias("r")).select(F.explode("r").alias("r")).select("r.*")


# --- reference tables and assets ------------------------------------------------------------------------------


def exchange_dim(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dimension, quarantine) of exchanges: capture_date, exchange_id, asset_class, locale, mic, name, url, page, ordinal."""
    issues = {"domain": ~P.valid_dimension("asset_class", "locale", "mic"), "url": F.col("url").isNotNull() & ~P.valid_http_url("url"), "name": ~S.is_trimmed_text("name")}
    return dimension(rows, ["capture_date", "exchange_id"], ["asset_class", "locale", "mic", "name", "url"], ["page", "ordinal"], issues)


def ticker_type_dim(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    issues = {"domain": ~P.valid_dimension("asset_class", "locale"), "code": ~S.is_trimmed_text("type_code")}
    return dimension(rows, ["capture_date", "asset_class", "locale", "type_code"], ["description"], ["page", "ordinal"], issues)


def condition_tables(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dimension, bridge, quarantine): one row a condition, and one for each of its data types with its place."""
    issues = {"name": ~S.is_trimmed_text("name"), "id": F.col("condition_id").isNull()}
    good, bad = dimension(rows, ["capture_date", "condition_type", "condition_id"], ["name", "data_types"], ["page", "ordinal"], issues)
    return good.drop("data_types"), bridge(good, ["capture_date", "condition_type", "condition_id"], "data_types", "data_type", "data_type_ordinal"), bad


ASSET_IDENTITY = ["cik", "composite_figi", "share_class_figi"]


def asset_tables(rows: DataFrame, calendar: DataFrame, fields: list[str]) -> dict[str, DataFrame]:
    """observation, version, universe, quarantine and overlap of session listings.

    rows: session_date, requested_active, ticker, capture_at, last_updated_utc, page, ordinal and fields. An observation
    is every sound row; versions are the competing rows of a (session, listing, ticker) with their verdict; the
    universe has one selected row each, of the active listing where a ticker stands in both, which overlap reports.
    available_session is the first open after capture.
    """
    issues = {"ticker": ~S.is_trimmed_text("ticker"), "active_flag": ~F.col("active").eqNullSafe(F.col("requested_active"))}
    good, bad = quality.quarantine(rows, issues)
    keys = ["session_date", "requested_active", "ticker"]
    record = S.stable_digest(session_date=F.col("session_date").cast("string"), requested_active="requested_active", page="page", ordinal="ordinal")
    good = good.withColumn("source_record_id", record).withColumn("last_updated_ns", S.strict_utc_ns("last_updated_utc"))
    opened = calendar.select(F.col("open_utc").cast("timestamp_ntz").alias("open_utc"))
    good = asof.first_after(good, "capture_at", opened, "open_utc", "available_at").withColumn("available_session", F.to_date("available_at"))
    decided = dedupe.select_version(good, keys, ASSET_IDENTITY, fields, "last_updated_ns", ["page", "ordinal"], "source_record_id")
    selected = decided.where("selected")
    both = selected.where("requested_active").select("session_date", "ticker").intersect(selected.where("not requested_active").select("session_date", "ticker"))
    universe = selected.withColumn("_rn", F.row_number().over(W.partitionBy("session_date", "ticker").orderBy(F.desc("requested_active")))).where("_rn = 1")
    columns = [*keys, "source_record_id", *fields, "available_session"]
    return {
        "observation": good.select(*columns), "version": decided.where("version_status <> 'singleton'").select(*keys, "source_record_id", "version_status", "version_rank", "version_reason", "difference_fields"),
        "universe": universe.select("session_date", "ticker", "active", F.col("source_record_id").alias("selected_source_record_id"), *[f for f in fields if f not in ("active", "ticker")], "available_session"), "quarantine": bad, "overlap": both,
    }


def asset_metrics(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of counts that the asset rules read: every count is taken from its table, none is assumed."""
    o = tables["observation"].agg(F.count("*").alias("observations"), P.count_true(S.figi_reason("composite_figi").isNotNull() & F.col("composite_figi").isNotNull()).alias("malformed_figis"), F.count_if(F.col("available_session").isNull()).alias("unavailable"))
    v = tables["version"].agg(F.count("*").alias("versions"), P.count_true(F.col("version_status").startswith("unresolved")).alias("unresolved"))
    u = tables["universe"].agg(F.count("*").alias("universe_rows"), P.count_true(F.col("active")).alias("active_rows"))
    return o.join(v).join(u).join(tables["quarantine"].agg(F.count("*").alias("quarantined"))).join(tables["overlap"].agg(F.count("*").alias("overlaps")))


def reduced_metrics(sessions: DataFrame, totals: list[str], rows: DataFrame, distinct: list[str]) -> DataFrame:
    """Session counts added up; distinct counts are taken over all rows again, never added."""
    return sessions.agg(*[F.sum(c).alias(c) for c in totals]).join(rows.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in distinct]))


def overview_safe(rows: DataFrame, allowed: list[str]) -> tuple[DataFrame, DataFrame]:
    """(safe, quarantine): allowed fields of matched rows; unresolved ones are set aside. What isn't allowed never leaves."""
    good, bad = quality.quarantine(rows, {"unresolved_identity": ~P.sure(F.col("identity_matches"))})
    return good.select(*allowed), bad.select(*allowed, "issues")


# --- identity tables ------------------------------------------------------------------------------------------


def sequence_scan(rows: DataFrame, classes: DataFrame, calendar: DataFrame, key: list[str]) -> dict[str, DataFrame]:
    """intervals, market_runs, bounces, long_runs and daily reason counts of classified membership rows.

    rows: session_date, ticker, observed_composite_figi, active and key; classes: query, classification. Intervals follow
    the whole key, market runs only the market; a bounce is home, foreign, home or its inverse over adjacent runs.
    """
    days = F.broadcast(calendar.select("session_date", "session_index"))
    c = classes.select(F.col("query").alias("_q"), "classification")
    marked = rows.join(c, F.col("observed_composite_figi") == F.col("_q"), "left").drop("_q").join(days, "session_date")
    reason = F.when(F.col("observed_composite_figi").isNull(), "no_identifier").when(F.col("classification").isNull(), "unclassified").otherwise(F.col("classification"))
    marked = marked.withColumn("reason", reason).withColumn("market", F.when(reason == "us_composite", "US").when(reason == "non_us_composite", "non_US"))
    fine = intervals.runs(marked, ["ticker"], "session_index", [*key, "reason"])
    coarse = intervals.runs(marked.where("market is not null"), ["ticker"], "session_index", ["market"])
    found = intervals.bounces(coarse, ["ticker"], "market", middle=1 << 30).withColumn("inverse", F.col("outer_state") == "non_US")
    return {
        "intervals": fine, "market_runs": coarse, "bounces": found, "long_runs": intervals.long_runs(coarse.where("market = 'non_US'")),
        "daily": marked.groupBy("session_date", "reason").agg(F.count("*").alias("n_rows")),
    }


def four_tables(rows: DataFrame, scopes: DataFrame, calendar: DataFrame) -> dict[str, DataFrame]:
    """universe_daily, ticker_alias, asset_master, issuer_master from membership rows and registry scopes.

    rows: session_date, ticker, source_record_id, observed_composite_figi, share_class_figi, cik. An alias is named by
    the first row of its interval; a member row carries the alias that holds it, or none when it isn't eligible.
    """
    r = identity.registry_projection(rows, scopes, "source_record_id", [], "observed_composite_figi")
    r = r.withColumn("asset_id", F.when(F.col("eligible"), S.asset_id("canonical"))).withColumn("issuer_id", F.when(S.padded_cik("cik").isNotNull(), S.issuer_id("cik")))
    alias = intervals.alias_intervals(r, calendar, ["ticker"], ["asset_id"])
    alias = alias.select(S.alias_segment_id("ticker", "asset_id", "valid_from").alias("ticker_alias_id"), "ticker", "asset_id", "valid_from", "valid_through", "valid_to_exclusive", "is_open", "n_rows")
    member = intervals.interval_lookup(r, alias, ["ticker"], "session_date", "valid_from", "valid_through", ["ticker_alias_id"])
    member = member.withColumn("ticker_alias_id", F.when(F.col("eligible"), F.col("ticker_alias_id")))
    return {
        "universe_daily": member, "ticker_alias": alias, "asset_master": masters.master(r.where("eligible"), "asset_id", "session_date", ["ticker", "share_class_figi", "cik"], F.col("n_matches") == 0),
        "issuer_master": masters.master(r, "issuer_id", "session_date", ["asset_id"]),
    }


def replay_faults(tables: dict[str, DataFrame]) -> DataFrame:
    """Member rows whose alias isn't exactly one, of the same ticker and asset, around their session; none may show."""
    a = tables["ticker_alias"].select(F.col("ticker_alias_id").alias("_a"), F.col("ticker").alias("_t"), F.col("asset_id").alias("_asset"), F.col("valid_from").alias("_from"), F.col("valid_through").alias("_through"))
    rows = tables["universe_daily"].join(a, F.col("ticker_alias_id") == F.col("_a"), "left")
    ok = (F.col("ticker") == F.col("_t")) & (F.col("asset_id") == F.col("_asset")) & F.col("session_date").between(F.col("_from"), F.col("_through"))
    return rows.where(F.col("eligible") & ~P.sure(ok)).select("session_date", "ticker", "source_record_id")


def migrate_universe(old: DataFrame, aliases: DataFrame, assets: DataFrame, issuers: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, faults): old rows with the version ids of their alias, asset and issuer, and how many lack one."""
    out = old
    for table, key, name in ((aliases, "ticker_alias_id", "alias_version_id"), (assets, "asset_id", "asset_version_id"), (issuers, "issuer_id", "issuer_version_id")):
        t = table.select(F.col(key).alias("_k"), name)
        out = out.join(t, F.col(key) == F.col("_k"), "left").drop("_k")
    bad = lambda key, name: P.count_true(F.col("eligible") & F.col(key).isNotNull() & F.col(name).isNull())
    faults = out.agg(bad("ticker_alias_id", "alias_version_id").alias("alias_faults"), bad("asset_id", "asset_version_id").alias("asset_faults"), bad("issuer_id", "issuer_version_id").alias("issuer_faults"))
    return out.select(*keep, "alias_version_id", "asset_version_id", "issuer_version_id"), faults


def read_back_faults(written: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row: rows that only one of two tables has, repeats counted."""
    return written.exceptAll(wanted).agg(F.count("*").alias("only_written")).join(wanted.exceptAll(written).agg(F.count("*").alias("only_wanted")))
