"""Small hand-made rows: each behaviour that a wrong plan would lose."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import predicates as P
from tidemark.functions import scalar as S
from tidemark.operators import asof, bars, calendar, contracts, dedupe, dimensions, identity, intervals, lifecycle, masters, quality, reconcile, releases, semantics, sets


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def one(spark, column, **values):
    schema = ", ".join(f"{k} {v[0]}" for k, v in values.items())
    return spark.createDataFrame([tuple(v[1] for v in values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.fixture(scope="module")
def spine(spark):
    days = [dt.date(2024, 1, k) for k in (2, 3, 4, 5, 8, 9, 10)]
    return spark.createDataFrame([(d, True) for d in days], "session_date date, source_complete boolean")


def figi(c):
    return f"BBG00000000{c}"


def observations(spark, states, ticker="T"):
    days = [dt.date(2024, 1, k) for k in (2, 3, 4, 5, 8, 9, 10)]
    return spark.createDataFrame([(d, ticker, s not in ("-",), None if s in ("n", "-") else "bad" if s == "m" else figi(s)) for d, s in zip(days, states) if s != "."], "session_date date, ticker string, active_on_date boolean, observed_composite_figi string")


@pytest.mark.parametrize(("states", "n", "band"), [("ABA", 1, "1"), ("ABBA", 1, "2-5"), ("A.BA", 0, None), ("AB-A", 0, None), ("ABnA", 0, None), ("ABmA", 0, None), ("ABC", 0, None), ("ABABA", 3, "1")])
def test_bounces(spark, spine, states, n, band):
    got = intervals.bounce_observations(observations(spark, states), spine).collect()
    assert len(got) == n and (not n or got[0]["band"] == band)


def test_bounce_breaks_on_incomplete_session(spark, spine):
    broken = spine.withColumn("source_complete", F.col("session_date") != dt.date(2024, 1, 3))
    assert intervals.bounce_observations(observations(spark, "ABA"), broken).count() == 0


def test_bounce_middle_limit(spark):
    for n, want in ((20, 1), (21, 0)):
        states = ["A"] + ["B"] * n + ["A"]
        df = spark.createDataFrame([(k, "T", s) for k, s in enumerate(states)], "i long, ticker string, s string")
        assert intervals.bounces(intervals.runs(df, ["ticker"], "i", ["s"]), ["ticker"], "s").count() == want


def test_runs_do_not_depend_on_order_or_partitions(spark):
    df = spark.createDataFrame([(k, f"T{k % 3}", "AB"[k // 7 % 2]) for k in range(200) if k % 11], "i long, ticker string, s string")
    want = rows(intervals.runs(df, ["ticker"], "i", ["s"]), "ticker", "s", "first_index", "last_index", "n_rows")
    again = intervals.runs(df.orderBy(F.rand(3)).repartition(13), ["ticker"], "i", ["s"])
    assert rows(again, "ticker", "s", "first_index", "last_index", "n_rows") == want
    assert sum(r[4] for r in want) == df.count()


def test_alias_round_trip(spark, spine):
    cal = calendar.indexed(spine.select("session_date"))
    df = observations(spark, "AAB-BA").withColumn("eligible", F.col("active_on_date"))
    out = intervals.alias_intervals(df, cal, ["ticker"], ["observed_composite_figi"])
    assert rows(out, "observed_composite_figi", "valid_from", "valid_through", "valid_to_exclusive") == [
        (figi("A"), dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 4)), (figi("A"), dt.date(2024, 1, 9), dt.date(2024, 1, 9), dt.date(2024, 1, 10)),
        (figi("B"), dt.date(2024, 1, 4), dt.date(2024, 1, 4), dt.date(2024, 1, 5)), (figi("B"), dt.date(2024, 1, 8), dt.date(2024, 1, 8), dt.date(2024, 1, 9)),
    ]
    inside = cal.join(out, (F.col("session_date") >= F.col("valid_from")) & (F.col("session_date") <= F.col("valid_through")))
    assert rows(inside, "session_date") == rows(df.where("eligible"), "session_date")


def test_interval_lookup_edges(spark):
    iv = spark.createDataFrame([("T", 5, 9, "a"), ("T", 20, None, "b")], "ticker string, s long, e long, p string")
    pts = spark.createDataFrame([("T", k) for k in (4, 5, 9, 10, 20, 99)] + [("U", 6)], "ticker string, at long")
    got = intervals.interval_lookup(pts, iv, ["ticker"], "at", "s", "e", ["p"])
    assert {(r["ticker"], r["at"]): r["p"] for r in got.collect()} == {("T", 4): None, ("T", 5): "a", ("T", 9): "a", ("T", 10): None, ("T", 20): "b", ("T", 99): "b", ("U", 6): None}


def version_rows(spark, groups):
    data, k = [], 0
    for ticker, members in groups.items():
        for cik, name, updated in members:
            data.append((ticker, cik, name, updated, k, f"r{k}"))
            k += 1
    return spark.createDataFrame(data, "ticker string, cik string, name string, updated long, place int, id string")


def test_version_selection_ladder(spark):
    df = version_rows(spark, {
        "A": [("1", "x", 5)], "a": [("1", "y", 5)], "DUP": [("1", "x", 5), ("1", "x", 5)], "LAST": [("1", "x", 5), ("1", "y", 6)], "TIE": [("1", "x", 6), ("1", "y", 6)],
        "WHO": [("1", "x", 5), ("2", "x", 6)], "WHEN": [("1", "x", None), ("1", "y", 6)],
    })
    out = dedupe.select_version(df, ["ticker"], ["cik"], ["cik", "name", "updated"], "updated", ["place"], "id")
    got = {r["ticker"]: (r["version_status"], r["id"] if r["selected"] else None) for r in out.orderBy("selected").collect()}
    assert got == {
        "A": ("singleton", "r0"), "a": ("singleton", "r1"), "DUP": ("resolved_exact_duplicate", "r2"), "LAST": ("resolved_unique_latest_last_updated", "r5"), "TIE": ("unresolved_timestamp_tie", None),
        "WHO": ("unresolved_identity_conflict", None), "WHEN": ("unresolved_timestamp_missing_or_invalid", None),
    }
    strict = dedupe.select_version(df.where("ticker = 'LAST'"), ["ticker"], ["cik"], ["cik", "name", "updated"], "updated", ["place"], "id", [["updated"]])
    assert {r["version_status"] for r in strict.collect()} == {"unresolved_difference_set"}


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, None), (3, "z"), (None, "q"), (None, "q")], "k int, v string")
    r = dedupe.duplicate_stats(df, ["k"], ["v"]).first()
    assert (r["duplicate_keys"], r["duplicate_excess"], r["exact_keys"], r["conflicting_keys"]) == (3, 3, 2, 1)
    assert rows(dedupe.keep_first(df.where("k = 2"), ["k"], ["v"]), "v") == [("a",)]


def test_coverage_case_sensitive(spark):
    ref = spark.createDataFrame([("BCpC", True), ("HALT", True), ("OLD", False)], "ticker string, active boolean")
    bar = spark.createDataFrame([("BCpC", True), ("OLD", True), ("BCPC", True)], "ticker string, active boolean")
    out = reconcile.full_compare(ref, bar, ["ticker"], ["active"], ("ref", "bar")).select("ticker", reconcile.coverage_state("in_ref", "in_bar", "ref_active").alias("s"))
    assert rows(out, "ticker", "s") == [("BCPC", "bar_only"), ("BCpC", "matched"), ("HALT", "reference_only"), ("OLD", "inactive_with_bar")]


@pytest.mark.parametrize(("a", "b", "want"), [(1.0, 1.0 + 1e-9, False), (100.0, 101.1, True), (100.0, 100.9, False), (float("nan"), 1.0, False), (None, 1.0, False), (float("inf"), 1.0, False)])
def test_tolerance(spark, a, b, want):
    assert one(spark, S.differs("a", "b", 1e-6, 0.01), a=("double", a), b=("double", b)) == want


def test_bar_rules(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0, 0.5, 1.5, 10.0, 60_000_000_000), (" A", 1.0, 2.0, 0.5, 1.5, 10.0, 0), ("B", 3.0, 2.0, 0.5, 1.5, 10.0, 0), ("C", float("nan"), 2.0, 0.5, 1.5, -1.0, 61)], "ticker string, o double, h double, l double, c double, v double, t long")
    counts = {r["issue"]: r["n_rows"] for r in quality.issue_counts(df, bars.bar_issues("ticker", "o", "h", "l", "c", "v", "t", F.lit(0), F.lit(10**12), 60_000_000_000)).collect()}
    assert counts == {"invalid_ticker": 1, "invalid_price": 1, "invalid_envelope": 2, "invalid_volume": 1, "outside_session": 0, "unaligned_time": 1}


def test_daylight_saving(spark):
    start, end = S.session_bounds_ns("d")
    df = spark.createDataFrame([(dt.date(2024, 3, 10),), (dt.date(2024, 11, 3),), (dt.date(2024, 6, 3),)], "d date").select("d", ((end - start) / 3_600_000_000_000).alias("hours"))
    assert [r["hours"] for r in df.orderBy("d").collect()] == [23, 24, 25]


def test_daily_bar_session(spark):
    at = lambda h: int(dt.datetime(2024, 7, 1, h, tzinfo=dt.UTC).timestamp() * 1000)
    assert one(spark, S.daily_bar_session("t"), t=("long", at(20))) == dt.date(2024, 7, 1)
    assert one(spark, S.daily_bar_session("t"), t=("long", at(21))) is None and one(spark, S.daily_bar_session("t"), t=("long", at(20) + 1)) is None


@pytest.mark.parametrize(("text", "want"), [("2024-01-02T03:04:05.123456789Z", 1704164645123456789), ("2024-01-02T03:04:05+01:00", 1704161045000000000), ("2024-01-02T03:04:05", None), ("2024-13-02T03:04:05Z", None), (None, None)])
def test_strict_utc(spark, text, want):
    assert one(spark, S.strict_utc_ns("t"), t=("string", text)) == want


@pytest.mark.parametrize(("url", "want"), [
    ("https://www.sec.gov/a/0001234567-24-000001.txt", "0001234567-24-000001"), ("https://x.org/0001234567-24-000001/0001234567-24-000002", None), ("https://x.org/0001234567-24-000001?q=1", None),
    ("ftp://x.org/0001234567-24-000001", None), ("https://x.org/90001234567-24-000001", None), (" https://x.org/0001234567-24-000001", None), (None, None),
])
def test_accession(spark, url, want):
    assert one(spark, S.accession_of("u"), u=("string", url)) == want


@pytest.mark.parametrize(("text", "want"), [("true", "boolean"), ("1", "integer"), ("1.5", "number"), ('"x"', "string"), ("[1]", "array"), ("{}", "object"), ("null", "null"), (None, "null"), ("{", "invalid")])
def test_native_type(spark, text, want):
    assert one(spark, S.native_type("t"), t=("string", text)) == want


def test_financials(spark):
    metric = "struct<label:string,unit:string,order:long,value:double,source:string,xpath:string,formula:string,derived_from:array<string>>"
    schema = f"start_date string, end_date string, filing_date string, cik string, company_name string, timeframe string, fiscal_period string, fiscal_year string, sic string, tickers array<string>, source_filing_url string, source_filing_file_url string, financials map<string,map<string,{metric}>>"
    good = ["2023-01-01", "2023-03-31", "2023-05-01", "0000000001", "Co", "quarterly", "Q1", "2023", "1311", ["A"], "https://s.org/0001234567-24-000001", "https://s.org/f/0001234567-24-000001.xml", {"income": {"rev": ("Revenue", "USD", 1, 5.0, "direct_report", "x", None, None)}}]
    for k, v in ((None, None), (1, "2022-01-01"), (3, "1"), (6, "FY"), (9, ["A", "A"]), (10, "https://s.org/none"), (12, {"income": {"rev": ("Revenue", "USD", 1, float("nan"), "direct_report", "x", None, None)}})):
        row = list(good)
        if k is not None:
            row[k] = v
        assert spark.createDataFrame([tuple(row)], schema).select(P.valid_financials().alias("x")).first()["x"] == (k is None), k


def test_first_after(spark):
    cal = spark.createDataFrame([(dt.datetime(2024, 1, 30),), (dt.datetime(2024, 4, 2),)], "m timestamp_ntz")
    pts = [(1, dt.datetime(2023, 12, 1)), (2, dt.datetime(2024, 1, 30)), (3, dt.datetime(2024, 2, 9)), (4, dt.datetime(2024, 4, 2)), (5, dt.datetime(2024, 6, 1)), (6, None)]
    out = asof.first_after(spark.createDataFrame(pts, "i int, at timestamp_ntz"), "at", cal, "m", "nxt")
    assert {r["i"]: r["nxt"] and r["nxt"].month for r in out.collect()} == {1: 1, 2: 4, 3: 4, 4: None, 5: None, 6: None}


def test_heads_and_chains(spark):
    df = spark.createDataFrame([("s", 1, "a", None, 1), ("s", 2, "b", "a", 5), ("s", 3, "c", "b", 9), ("u", 1, "d", None, 9), ("v", 2, "e", "x", 1)], "series string, version int, id string, prev string, at int")
    assert rows(asof.effective_head(df, ["series"], "version", "at", F.lit(5)), "id") == [("b",), ("e",)]
    assert rows(asof.chain_faults(df, ["series"], "version", "id", "prev", "at"), "id", "faults") == [("e", ["version_not_contiguous", "predecessor_mismatch"])]


def test_release_faults_and_guards(spark):
    m = spark.createDataFrame([("r1", None, 1, 1), ("r2", "r1", 2, 2), ("r3", "r1", 3, 3), ("r4", "gone", 1, 1), ("r5", "r6", 1, 1), ("r6", "r5", 1, 1), ("r7", "r3", 2, 1)], "release_id string, parent string, source_cutoff int, availability int")
    assert rows(releases.chain_faults(m), "release_id", "fault") == [("r1", "fork"), ("r4", "missing_parent"), ("r4", "unreachable"), ("r5", "unreachable"), ("r6", "unreachable"), ("r7", "availability_decreases"), ("r7", "cutoff_decreases")]
    chain = spark.range(1, 12_001).selectExpr("concat('r', id) release_id", "if(id = 1, null, concat('r', id - 1)) parent", "1 source_cutoff", "1 availability")
    assert releases.chain_faults(chain).count() == 0 and releases.chain_faults(chain.limit(0)).count() == 0
    assert releases.chain_faults(chain.where("release_id <> 'r5000'")).where("fault = 'unreachable'").count() == 7000
    delta = spark.createDataFrame([(5,)], "session_date int")
    assert releases.check_delta(delta, 4).count() == 1
    with pytest.raises(ValueError):
        releases.check_delta(delta, 5)
    current = spark.createDataFrame([("p", "x")], "part string, receipt string")
    with pytest.raises(ValueError):
        releases.check_correction(spark.createDataFrame([("p", "old")], "part string, named string"), current, ["part"], "named", "receipt")


def test_two_views(spark):
    df = spark.createDataFrame([("k", 1, None, False, 1), ("k", 2, 1, False, 7), ("g", 1, None, False, 1), ("g", 2, 1, True, 3)], "key string, version int, prev int, dead boolean, at int")
    assert rows(releases.row_view(df, ["key"], "version", "prev", "dead", "at"), "key", "version") == [("k", 2)]
    assert rows(releases.row_view(df, ["key"], "version", "prev", "dead", "at", F.lit(5)), "key", "version") == [("k", 1)]
    assert rows(releases.row_view(df, ["key"], "version", "prev", "dead", "at", F.lit(2)), "key", "version") == [("g", 1), ("k", 1)]


def test_lifecycles(spark):
    day = lambda k: dt.date(2024, 1, k)
    data = [("T", day(1), "s1", "c1", None), ("T", day(2), None, "c1", "7"), ("T", day(3), None, None, None), ("T", day(4), "s2", "c2", "7"), ("T", day(5), "s1", None, None), ("U", day(1), None, " ", None), ("U", day(2), None, "c9", None)]
    df = spark.createDataFrame([(*r, "CS", None, "X") for r in data], "ticker string, session_date date, share_class_figi string, composite_figi string, cik string, type string, name string, primary_exchange string")
    assert rows(lifecycle.lifecycles(df), "ticker", "identity_value", "first_active_date", "last_active_date", "n_rows") == [("T", "s1", day(1), day(5), 4), ("T", "s2", day(4), day(4), 1), ("U", "c9", day(1), day(2), 2)]


def plain_lifecycles(rows):
    """rows (day, identity triple) of one ticker in order -> sorted (first, last, n, identity) of its records."""
    records = []
    for day, own in rows:
        def weight(r):
            pairs = [(3 - k, x == y) for k, (x, y) in enumerate(zip(r["id"], own)) if x and y]
            return 0 if any(not same for _, same in pairs) else sum(w for w, _ in pairs)

        if any(own):
            best = max((weight(r) for r in records), default=0)
            fit = [r for r in records if (weight(r) == best if best else not any(r["id"]))]
        else:
            fit = records
        if fit:
            r = max(fit, key=lambda r: r["last"])
        else:
            r = {"first": day, "n": 0, "id": (None,) * 3}
            records.append(r)
        r |= {"last": day, "n": r["n"] + 1, "id": tuple(y or x for x, y in zip(r["id"], own))}
    return sorted((r["first"], r["last"], r["n"], *map(str, r["id"])) for r in records)


def test_lifecycles_as_loop(spark):
    """Random histories, most of them unclear, in one partition and in many."""
    import random

    r = random.Random(7)
    data = {f"T{t}": [(dt.date(2024, 1, d), tuple(r.choice([None, None, *values]) for values in (["s1", "s2"][: 1 + t % 2], ["c1", "c2"], ["7", "8"][: 1 + t % 2]))) for d in range(1, r.randint(2, 28))] for t in range(40)}
    data["plain"] = [(dt.date(2024, 1, d), ("s", None, "7" if d == 2 else None) if d % 3 else (None,) * 3) for d in range(1, 9)]
    df = spark.createDataFrame([(t, d, *own, "CS", None, "X") for t, history in data.items() for d, own in history], "ticker string, session_date date, share_class_figi string, composite_figi string, cik string, type string, name string, primary_exchange string")
    for source in (df, df.repartition(9)):
        found = lifecycle.lifecycles(source).collect()
        for t, history in data.items():
            assert sorted((x["first_active_date"], x["last_active_date"], x["n_rows"], *(str(x[f]) for f in lifecycle.IDENTITY)) for x in found if x["ticker"] == t) == plain_lifecycles(history)


def test_history_keeps_last_known(spark):
    df = spark.createDataFrame([("T", 1, True, "a"), ("T", 2, False, None), ("T", 3, True, None)], "t string, d int, on boolean, x string")
    r = masters.history(df, "t", "d", "on", ["x"], F.lit(3)).first()
    assert (r["first_seen_date"], r["last_active_date"], r["ever_inactive"], r["active_on_end_date"], r["x"]) == (1, 3, True, True, "a")


def test_resolution_fails_closed(spark):
    m = spark.createDataFrame([("r1", figi("A"), False), ("r2", figi("B"), False), ("r3", figi("B"), True), ("r4", None, False), ("r5", figi("C"), False)], "source_record_id string, observed_composite_figi string, relationship_conflict boolean")
    cases = spark.createDataFrame([("c1", "r2"), ("c2", "r5")], "case_id string, source_record_id string")
    d = spark.createDataFrame([("c1", 1, "confirmed_provider_contamination", figi("A"), 3), ("c2", 1, "confirmed_provider_contamination", figi("Z"), 9)], "case_id string, version int, disposition string, canonical_composite_figi string, available_session int")
    out = identity.resolve_at_cutoff(m, cases, d, F.lit(5))
    assert {r["source_record_id"]: (r["canonical_composite_figi"], r["disposition"], r["eligible"]) for r in out.collect()} == {
        "r1": (figi("A"), "observed_consistent", True), "r2": (figi("A"), "confirmed_provider_contamination", True), "r3": (figi("B"), "observed_consistent", False),
        "r4": (None, "not_applicable_no_observed_composite", False), "r5": (None, "pending_unresolved", False),
    }
    assert identity.contamination_faults(out).count() == 0
    assert rows(identity.contamination_faults(identity.resolve_at_cutoff(m, cases, d, F.lit(10))), "canonical_composite_figi") == [(figi("Z"),)]


def test_semantics(spark):
    left = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "k string, v int")
    assert rows(semantics.present_but_disagreeing(left, right, ["k"], ["v"]), "k") == [("b",)] and rows(semantics.undefined_uses(left, right, ["k"]), "k") == [("c",)]
    with pytest.raises(ValueError):
        semantics.require_none(left, "rows")


def test_ordered_digest_in_chunks(spark):
    df = spark.createDataFrame([("g", k, f"v{k}") for k in range(25)], "g string, o int, v string")
    a, b = (sets.ordered_digest(df.repartition(n), ["g"], "o", "v", 10).first()["digest"] for n in (1, 9))
    import hashlib

    sha = lambda xs: hashlib.sha256(",".join(xs).encode()).hexdigest()
    for n in (9, 10, 25):  # one chunk or several: one rule
        got = sets.ordered_digest(df.where(F.col("o") < n), ["g"], "o", "v", 10).first()["digest"]
        assert got == sha([sha([f"v{k}" for k in range(c, min(c + 10, n))]) for c in range(0, n, 10)])
    assert a == b != sets.ordered_digest(df.where("o < 24"), ["g"], "o", "v", 10).first()["digest"]


def test_contracts(spark):
    c = contracts.TableContract("x", 1, (("k", "int64", False), ("v", "string", True)), ("k",))
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(contracts.ContractError):
        c.require(df)
    with pytest.raises(contracts.ContractError):
        c.check_schema(df.select("v", "k"))
    assert c.require(df.limit(1)).count() == 1
    nxt = c.overlay(2, add=(("w", "float64", True),), remove=("v",))
    assert nxt.schema.simpleString() == "struct<k:bigint,w:double>" and nxt.digest() != c.digest()
    with pytest.raises(contracts.ContractError):
        contracts.TableContract("x", 1, (("k", "int64", True),), ("k",))


def test_funnel_gates_and_guard(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "x")], "k int, v string")
    r = quality.row_funnel(df, ["k"], ["v"], F.col("v").isNull()).first()
    assert (r["input_rows"], r["accepted_rows"], r["duplicate_rows"], r["quarantined_rows"], r["balanced"]) == (4, 2, 1, 1, True)
    assert quality.cardinality_guard(df, ["k"], 3).count() == 4
    with pytest.raises(ValueError):
        quality.cardinality_guard(df, ["k"], 2)


def test_change_events(spark):
    df = spark.createDataFrame([("F", "A", "2003-09-10"), ("F", "B", "2003-09-10"), ("G", " ", "2024-01-06"), ("G", "C", "2024-01-06"), ("H", "D", "2024-02-30")], "figi string, ticker string, raw string")
    good, bad = dimensions.change_events(df, "figi", "ticker", "raw")
    assert rows(good, "ticker", "event_date_quality", "event_date_is_weekend", "same_day_multiple_tickers") == [("A", "source_boundary_candidate_2003_09_10", False, True), ("B", "source_boundary_candidate_2003_09_10", False, True), ("C", "ordinary_calendar_date", True, False)]
    assert bad.count() == 2
    status = dimensions.request_status(spark.createDataFrame([("F",), ("Q",)], "figi string"), good, "figi")
    assert rows(status, "figi", "event_count", "status") == [("F", 2, "returned"), ("Q", 0, "empty")]


def test_folded(spark):
    """As str.casefold, letter by letter and in words."""
    from tidemark.functions import scalar

    letters = [chr(c) for c in range(0x20, 0x1FFFF) if not 0xD800 <= c < 0xE000 and (chr(c).casefold() != chr(c) or c % 97 == 0)]
    texts = [*letters, "Straße ΣΊΣΥΦΟΣ ﬁn İ", "ABC def", "", None]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", "t", scalar.folded("t").alias("f")).collect()
    wrong = [(r["t"], r["f"]) for r in got if r["f"] != (r["t"].casefold() if r["t"] is not None else None)]
    assert not wrong, wrong[:20]


def test_counts_of_an_empty_table_are_zero(spark):
    from tidemark.operators import bars, semantics

    none = spark.createDataFrame([], "k long, v long")
    assert tuple(bars.conversion_report(none, ["k"], ["k", "v"]).first()) == (0, 0, 0, 0, 0)
    assert tuple(semantics.uniqueness(none, ["k"], ["v"]).first()) == (0, 0, 0, 0)
