import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import calendar, quality
from tidemark.plans import pipelines as pl


def day(k):
    return dt.date(2024, 1, k)


def ns(hour, minute=0, k=2):
    return int(dt.datetime(2024, 1, k, hour, minute, tzinfo=dt.UTC).timestamp()) * 10**9


BAR = "session_date date, ticker string, window_start long, open double, high double, low double, close double, volume double, transactions long"


def test_minute_day_audit(spark):
    cal = calendar.sessions(spark, "2024-01-02", "2024-01-03")
    cal = cal.withColumns({"open_ns": F.unix_micros("open_utc") * 1000, "close_ns": F.unix_micros("close_utc") * 1000})
    minute = [(day(2), "AAPL", ns(14, 30), 10.0, 11.0, 9.9, 10.5, 100.0, 4), (day(2), "AAPL", ns(14, 31), 10.5, 11.25, 9.75, 11.0, 150.0, 6), (day(2), "AAPL", ns(9, 0), 99.0, 99.0, 99.0, 99.0, 0.0, 0), (day(2), "MSFT", ns(14, 30), 1.0, 1.0, 1.0, 1.0, 1.0, 1), (day(2), "MSFT", ns(14, 30), 1.0, 1.0, 1.0, 1.0, 1.0, 1), (day(2), "PRE", ns(9, 0), 1.0, 1.0, 1.0, 1.0, 1.0, 1), (day(2), "BAD", ns(14, 30), -1.0, 1.0, 1.0, 1.0, 1.0, 1)]
    daily = [(day(2), "AAPL", 0, 10.0, 11.25, 9.75, 11.0, 250.0, 10), (day(2), "MSFT", 0, 1.0, 1.0, 1.0, 1.5, 1.0, 1), (day(2), "PRE", 0, 1.0, 1.0, 1.0, 1.0, 1.0, 1), (day(3), "X", 0, 1.0, 1.0, 1.0, 1.0, 1.0, 1)]
    got = {r["session_date"]: r for r in pl.minute_day_audit(spark.createDataFrame(minute, BAR), spark.createDataFrame(daily, BAR), cal).collect()}
    r = got[day(2)]
    assert (r["pairs"], r["minute_only"], r["day_only"], r["no_regular_bars"], r["close_mismatches"], r["high_mismatches"], r["volume_mismatches"], r["status"]) == (3, 0, 0, 1, 1, 0, 0, "matched")
    assert (got[day(3)]["day_only"], got[day(3)]["status"]) == (1, "different")


def test_product_audit(spark):
    flat = spark.createDataFrame([(day(2), "A", 0, 1.0, 1.0, 1.0, 1.0, 5.0, 2), (day(2), "B", 0, 1.0, 1.0, 1.0, 1.0, 5.0, 2)], BAR)
    rest = spark.createDataFrame([(day(2), "A", 0, 1.0, 1.0, 1.0, 2.0, 5.0, None), (day(2), "A", 0, 9.0, 9.0, 9.0, 9.0, 9.0, 9)], BAR).withColumn("page", F.lit(0)).withColumn("ordinal", F.when(F.col("open") == 1.0, 0).otherwise(1))
    r = pl.product_audit(flat, rest, spark.createDataFrame([(day(2), 3)], "session_date date, results_count long")).first()
    assert (r["pairs"], r["flat_only"], r["close_mismatches"], r["open_mismatches"], r["transactions_missing"], r["envelope_ok"]) == (1, 1, 1, 0, 1, False)


def test_conversion_universe_coverage(spark):
    raw = spark.createDataFrame([("A", 1.0, 1.0, 1.0, 1.0, 1.0, ns(14, 30), 1), ("A", 1.0, 1.0, 1.0, 1.0, 1.0, ns(14, 30), 1), ("M", 1.0, 1.0, 1.0, 1.0, 1.0, ns(20), 1)], "ticker string, volume double, open double, close double, high double, low double, window_start long, transactions long")
    bars, report = pl.convert_bars(raw, spark.createDataFrame([(day(2),), (day(3),)], "session_date date"))
    r = report.first()
    assert (r["n_rows"], r["n_keys"], r["duplicate_excess"], r["left_only"], r["right_only"], r["equal"]) == (3, 2, 1, 0, 1, False)
    active = spark.createDataFrame([(day(2), "A", True), (day(2), "HALT", True), (day(2), "FLAG", False)], "session_date date, ticker string, active boolean")
    inactive = spark.createDataFrame([(day(2), "OLD", False), (day(2), "A", False)], "session_date date, ticker string, active boolean")
    universe, faults = pl.daily_universe(active, inactive)
    assert sorted(tuple(r) for r in faults.select("ticker", "fault").collect()) == [("A", "ticker_not_unique"), ("FLAG", "active_flag_mismatch")]
    cover = pl.daily_coverage(active.where("ticker <> 'FLAG'").unionAll(inactive.where("ticker = 'OLD'")), bars)
    assert {r["ticker"]: r["state"] for r in cover.collect()} == {"A": "matched", "HALT": "reference_only", "OLD": "reference_only", "M": "bar_only"}


def test_filing_and_semantic_audit(spark):
    index = spark.createDataFrame([("a1", "2024-01-01", "1"), ("a1", "2024-01-02", "2"), ("a2", "2024-01-01", "3")], "accession string, filing_date string, cik string")
    detail = spark.createDataFrame([("a1", "2024-01-02", "2"), ("a1", "2024-01-02", "1"), ("a2", "2024-05-05", "3"), ("a9", "2024-01-01", "3")], "accession string, filing_date string, cik string")
    assert tuple(pl.filing_coverage(index, detail).first()) == (1, 1, 1)
    got = {r["dataset"]: r["status"] for r in pl.semantic_audit({"i": index, "d": detail, "x": detail.unionAll(detail)}, {"i": ["accession", "filing_date"], "d": ["accession"], "x": ["accession", "filing_date", "cik"]}).collect()}
    assert got["i"] == "passed" and got["d"] == "failed"


def test_source_profile(spark):
    df = spark.createDataFrame([("true", " a"), ("1", ""), ("1.5", " "), (None, "a")], "x string, y string")
    got = {r["field"]: r.asDict() for r in pl.source_profile(df, ["x", "y"]).collect()}
    assert (got["x"]["present"], got["x"]["nulls"], got["x"]["booleans"], got["x"]["numbers"]) == (3, 1, 1, 2)
    assert (got["y"]["empty"], got["y"]["blank"], got["y"]["untrimmed"]) == (1, 1, 1)


def test_reference_dimensions(spark):
    rows = spark.createDataFrame([(day(2), 1, "stocks", "us", "XNYS", "NYSE", "https://x.org", 0, 0), (day(2), 1, "stocks", "us", "XNYS", "NYSE", "https://x.org", 0, 1), (day(2), 2, "stocks", "us", "XNAS", "A", None, 0, 2), (day(2), 2, "stocks", "us", "XNAS", "B", None, 0, 3), (day(2), 3, "fx", "us", None, "C", None, 0, 4)], "capture_date date, exchange_id long, asset_class string, locale string, mic string, name string, url string, page int, ordinal int")
    good, bad = pl.exchange_dim(rows)
    assert [(r["exchange_id"], r["ordinal"]) for r in good.collect()] == [(1, 0)] and sorted(r["issues"][0] for r in bad.collect()) == ["conflicting_key", "conflicting_key", "domain"]
    c = spark.createDataFrame([(day(2), "sale", 1, "Regular", ["trade", "bbo"], 0, 0), (day(2), "sale", None, "x", ["trade"], 0, 1)], "capture_date date, condition_type string, condition_id long, name string, data_types array<string>, page int, ordinal int")
    dim, br, bad = pl.condition_tables(c)
    assert dim.count() == 1 and bad.count() == 1 and sorted((r["data_type_ordinal"], r["data_type"]) for r in br.collect()) == [(0, "trade"), (1, "bbo")]


def test_asset_tables(spark):
    cal = calendar.sessions(spark, "2024-01-02", "2024-01-12")
    at = dt.datetime(2024, 1, 3, 2)
    data = [("A", True, True, "f1", 0, "2024-01-01T00:00:00Z"), ("DUP", True, True, "f2", 1, "2024-01-01T00:00:00Z"), ("DUP", True, True, "f2", 2, "2024-01-01T00:00:00Z"), ("LAST", True, True, "f3", 3, "2024-01-01T00:00:00.000000001Z"), ("LAST", True, True, "f3", 4, "2024-01-01T00:00:00.000000002Z"), ("OLD", False, False, None, 5, None), ("A", False, False, "f1", 6, None), (" U", True, True, None, 7, None)]
    rows = spark.createDataFrame([(day(2), listed, t, active, at, u, 0, k, "1", f, "s") for t, listed, active, f, k, u in data], "session_date date, requested_active boolean, ticker string, active boolean, capture_at timestamp_ntz, last_updated_utc string, page int, ordinal int, cik string, composite_figi string, share_class_figi string")
    t = pl.asset_tables(rows, cal, ["active", "cik", "composite_figi", "share_class_figi", "last_updated_utc"])
    assert {k: v.count() for k, v in t.items()} == {"observation": 7, "version": 4, "universe": 4, "quarantine": 1, "overlap": 1}
    assert {r["available_session"] for r in t["observation"].collect()} == {day(3)}
    m = pl.asset_metrics(t)
    assert (m.first()["unresolved"], m.first()["overlaps"], m.first()["quarantined"]) == (0, 1, 1)
    rules = [{"name": "no_overlap", "numerator": "overlaps", "op": "<=", "limit": 0}, {"name": "resolved", "numerator": "unresolved", "denominator": "versions", "on": "rate", "op": "<=", "limit": 0.01}]
    assert {r["rule"]: r["status"] for r in quality.qa_results(m, rules).collect()} == {"no_overlap": "failed", "resolved": "passed"}


def figi(c):
    return f"BBG00000000{c}"


def membership(spark):
    days = [2, 3, 4, 5, 8, 9]
    data = [(day(d), "T", f"t{d}", figi(s) if s != "n" else None, "s", "1") for d, s in zip(days, "AABAAn")] + [(day(d), "U", f"u{d}", figi("C"), "s", None) for d in (2, 4, 5)]
    return spark.createDataFrame(data, "session_date date, ticker string, source_record_id string, observed_composite_figi string, share_class_figi string, cik string"), calendar.sessions(spark, "2024-01-02", "2024-01-10")


def test_four_tables_and_replay(spark):
    rows, cal = membership(spark)
    scopes = spark.createDataFrame([("t4", figi("A")), ("u5", figi("C")), ("u5", figi("D"))], "source_record_id string, canonical string")
    t = pl.four_tables(rows, scopes, cal)
    alias = sorted((r["ticker"], r["valid_from"], r["valid_through"]) for r in t["ticker_alias"].collect())
    assert alias == [("T", day(2), day(8)), ("U", day(2), day(2)), ("U", day(4), day(4))]
    assert pl.replay_faults(t).count() == 0
    member = t["universe_daily"].collect()
    assert all((r["ticker_alias_id"] is not None) == r["eligible"] for r in member) and sum(r["eligible"] for r in member) == 7
    assert t["asset_master"].count() == 2 and t["issuer_master"].count() == 1
    again = pl.four_tables(rows.repartition(5).orderBy(F.rand(1)), scopes, cal)
    assert tuple(pl.read_back_faults(again["ticker_alias"], t["ticker_alias"]).first()) == (0, 0)
    version = lambda df, k, n: df.select(k, F.sha2(F.col(k), 256).alias(n))
    done, faults = pl.migrate_universe(t["universe_daily"], version(t["ticker_alias"], "ticker_alias_id", "alias_version_id"), version(t["asset_master"], "asset_id", "asset_version_id").limit(1), version(t["issuer_master"], "issuer_id", "issuer_version_id"), ["session_date", "ticker"])
    assert done.count() == 9 and faults.first()["alias_faults"] == 0 and faults.first()["asset_faults"] > 0


def test_sequence_scan(spark):
    rows, cal = membership(spark)
    classes = spark.createDataFrame([(figi("A"), "us_composite"), (figi("B"), "non_us_composite")], "query string, classification string")
    t = pl.sequence_scan(rows, classes, cal, ["observed_composite_figi"])
    (b,) = t["bounces"].collect()
    assert (b["ticker"], b["outer_state"], b["middle_sessions"], b["inverse"]) == ("T", "US", 1, False)
    assert {r["reason"] for r in t["daily"].collect()} == {"us_composite", "non_us_composite", "unclassified", "no_identifier"}


def test_overview_and_reduced_metrics(spark):
    df = spark.createDataFrame([("T", True, 5.0), ("U", False, 6.0)], "ticker string, identity_matches boolean, market_cap double")
    safe, bad = pl.overview_safe(df, ["ticker"])
    assert safe.columns == ["ticker"] and [r["ticker"] for r in safe.collect()] == ["T"] and "market_cap" not in bad.columns
    per = spark.createDataFrame([(2, 2), (3, 1)], "n long, d long")
    assert tuple(pl.reduced_metrics(per, ["n"], df, ["ticker"]).first()) == (5, 2)
