"""More queries with the SQL that checks them: audits, reference tables, identity masters, factors, instants.

Faults are planted by rules on whole tables, the same in the query and its SQL; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalar as S
from ..operators import bars, calendar, factors
from . import pipelines
from .catalog import DAILY, RUNS, _members, daily, events, query, t

# --- contracts, instants --------------------------------------------------------------------------------------


@query("""select l_returnflag, count(*) filter (where l_discount <= 0 or l_quantity <= 0) as bad_prices,
  count(*) filter (where high < low or mid > high or mid < low or l_quantity > high or l_quantity < low) as broken_envelopes
  from (select *, l_extendedprice * l_tax as low, l_quantity * 1000 as high, l_extendedprice as mid from lineitem) group by 1""")
def price_faults(spark, d):
    rows = t(spark, d, "lineitem").withColumns({"low": F.col("l_extendedprice") * F.col("l_tax"), "high": F.col("l_quantity") * 1000})
    return rows.groupBy("l_returnflag").agg(P.count_true(P.bad_prices("l_discount", "l_quantity")).alias("bad_prices"), P.count_true(P.broken_envelope("l_extendedprice", "high", "low", "l_quantity")).alias("broken_envelopes"))


@query("""select day, epoch_us(timezone('America/New_York', day::timestamp)) * 1000 as start_ns, epoch_us(timezone('America/New_York', (day + 1)::timestamp)) * 1000 as end_ns
  from (select distinct cast(o_orderdate as date) as day from orders)""")
def session_bounds(spark, d):
    start, end = S.session_bounds_ns("day")
    return t(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct().select("day", start.alias("start_ns"), end.alias("end_ns"))


@query("""select cast(timezone('America/New_York', timezone('UTC', ts)) as date) as session_date, count(*) as n_rows from events group by 1""")
def new_york_sessions(spark, d):
    return events(spark, d).groupBy(S.new_york_date("ts").alias("session_date")).agg(F.count("*").alias("n_rows"))


@query("""select o_orderkey, case o_orderkey % 5 when 0 then epoch_us(o_orderdate) * 1000 + 45296000000000 when 1 then epoch_us(o_orderdate) * 1000 + 45296000000000 + rpad((o_orderkey % 997)::varchar, 9, '0')::bigint
  when 2 then epoch_us(o_orderdate) * 1000 + 45296000000000 - 7200000000000 end::bigint as instant_ns from orders""")
def strict_instants(spark, d):
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(k % 5 == 0, F.concat(day, F.lit("T12:34:56Z"))).when(k % 5 == 1, F.concat(day, F.lit("T12:34:56."), (k % 997).cast("string"), F.lit("Z")))
    text = text.when(k % 5 == 2, F.concat(day, F.lit("T12:34:56+02:00"))).when(k % 5 == 3, F.concat(day, F.lit(" 12:34:56Z"))).otherwise(F.concat(day, F.lit("T12:34:56")))
    return t(spark, d, "orders").select("o_orderkey", S.strict_utc_ns(text).alias("instant_ns"))


# --- listings and audits --------------------------------------------------------------------------------------

LISTED = "(select cast(o_orderdate as date) as session_date, o_custkey as ticker, o_orderkey % 2 = 0 as listed, (o_orderkey % 2 = 0) <> (o_orderkey % 10 = 0) as active from orders)"


@query(f"""select session_date, ticker, 'active_flag_mismatch' as fault from {LISTED} where listed <> active
  union all select session_date, ticker, 'ticker_not_unique' from {LISTED} group by 1, 2 having count(*) > 1""")
def universe_faults(spark, d):
    rows = t(spark, d, "orders").select(F.to_date("o_orderdate").alias("session_date"), F.col("o_custkey").alias("ticker"), (F.col("o_orderkey") % 2 == 0).alias("listed"), ((F.col("o_orderkey") % 2 == 0) != (F.col("o_orderkey") % 10 == 0)).alias("active"))
    return pipelines.daily_universe(rows.where("listed").drop("listed"), rows.where("not listed").drop("listed"))[1]


@query("""with u as (select cast(ts as date) as session_date, user_id as ticker, count(*) filter (where event_type = 'error') = 0 as active from events group by 1, 2 having count(*) filter (where event_type = 'purchase') > 0),
m as (select cast(ts as date) as session_date, user_id as ticker, count(*) as n_bars from events where event_type in ('view', 'error') group by 1, 2)
select session_date, case when u.ticker is null then 'bar_only' when m.ticker is null then 'reference_only' when active then 'matched' else 'inactive_with_bar' end as state, count(*) as n_tickers, coalesce(sum(n_bars), 0)::bigint as n_bars
  from u full join m using (session_date, ticker) group by 1, 2""")
def coverage_states(spark, d):
    e = events(spark, d).select(F.col("day").alias("session_date"), F.col("user_id").alias("ticker"), "event_type", F.col("event_id").alias("window_start"))
    universe = e.groupBy("session_date", "ticker").agg((F.count_if(F.col("event_type") == "error") == 0).alias("active"), F.count_if(F.col("event_type") == "purchase").alias("n")).where("n > 0")
    rows = pipelines.daily_coverage(universe, e.where(F.col("event_type").isin("view", "error")))
    return rows.groupBy("session_date", "state").agg(F.count("*").alias("n_tickers"), F.sum("n_bars").alias("n_bars"))


BARS = "select cast(ts as date) as session_date, user_id as ticker, arg_min(value, (ts, event_id)) as open, max(value) as high, min(value) as low, arg_max(value, (ts, event_id)) as close, count(*) as n from events"


@query(f"""with f as ({BARS} group by 1, 2), r as ({BARS} where event_type <> 'error' group by 1, 2), e as (select cast(ts as date) as session_date, count(distinct user_id) as results_count from events group by 1)
select session_date, count(*) filter (where f.n is not null and r.n is not null) as pairs, count(*) filter (where r.n is null) as flat_only, count(*) filter (where f.n is null) as rest_only,
  count(*) filter (where abs(f.open - r.open) > greatest(1e-6, 1e-6 * greatest(abs(f.open), abs(r.open)))) as open_mismatches, count(*) filter (where abs(f.close - r.close) > greatest(1e-6, 1e-6 * greatest(abs(f.close), abs(r.close)))) as close_mismatches,
  count(*) filter (where f.n <> r.n) as volume_mismatches, count(*) filter (where f.n <> r.n and ticker % 4 <> 0) as transactions_mismatches, count(*) filter (where r.n is not null and ticker % 4 = 0) as transactions_missing,
  any_value(results_count) = count(r.n) as envelope_ok
  from f full join r using (session_date, ticker) join e using (session_date) group by 1""")
def product_audit(spark, d):
    e = events(spark, d).select(F.col("day").alias("session_date"), F.col("user_id").alias("ticker"), "ts", "event_id", "value", "event_type")

    def product(rows):
        return bars.ohlc(rows, ["session_date", "ticker"], "ts", "event_id", "value").withColumn("volume", F.col("n_bars").cast("double")).withColumnRenamed("n_bars", "transactions")

    rest = product(e.where("event_type <> 'error'")).withColumns({"page": F.lit(0), "ordinal": F.col("ticker")}).withColumn("transactions", F.when(F.col("ticker") % 4 != 0, F.col("transactions")))
    found = pipelines.product_audit(product(e), rest, e.groupBy("session_date").agg(F.count_distinct("ticker").alias("results_count")))
    return found.select("session_date", "pairs", "flat_only", "rest_only", "open_mismatches", "close_mismatches", "volume_mismatches", "transactions_mismatches", "transactions_missing", "envelope_ok")


def _audit_sql(name: str, table: str, keys: str, values: str) -> str:
    return f"""select '{name}' as dataset, sum(n)::bigint as n_rows, count(*) as distinct_keys, sum(n - 1)::bigint as excess_rows, count(*) filter (where kinds > 1) as conflicting_keys,
  case when count(*) filter (where kinds > 1) > 0 then 'failed' when sum(n - 1) > 0 then 'different' else 'passed' end as status from (select count(*) as n, count(distinct {values}) as kinds from {table} group by {keys})"""


@query(" union all ".join([
    _audit_sql("orders", "orders", "o_custkey, o_orderpriority", "(o_orderkey, o_orderstatus)"), _audit_sql("nation", "nation", "n_nationkey", "(n_name, n_regionkey)"),
    _audit_sql("status", "orders", "o_custkey, o_orderstatus", "(length(o_orderstatus))"),
]))
def semantic_audit(spark, d):
    o = t(spark, d, "orders")
    tables = {"orders": o.select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderstatus"), "nation": t(spark, d, "nation"), "status": o.select("o_custkey", "o_orderstatus", F.length("o_orderstatus").alias("n"))}
    return pipelines.semantic_audit(tables, {"orders": ["o_custkey", "o_orderpriority"], "nation": ["n_nationkey"], "status": ["o_custkey", "o_orderstatus"]})


FILINGS = "(select distinct o_custkey as a, cast(o_orderdate as date) as f, o_orderstatus as c from orders where o_orderpriority {} '1-URGENT')"


@query(f"""with i as {FILINGS.format("=")}, d as {FILINGS.format("<>")}
select (select count(*) from (select distinct a from d) where a not in (select a from i)) as missing_accessions,
  (select count(*) from (select distinct a, f from d) x where a in (select a from i) and not exists (select 1 from i where i.a = x.a and i.f = x.f)) as filing_date_mismatches,
  (select count(*) from d x where exists (select 1 from i where i.a = x.a and i.f = x.f) and not exists (select 1 from i where i.a = x.a and i.f = x.f and i.c = x.c)) as filer_mismatches""")
def filing_coverage(spark, d):
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("accession"), F.to_date("o_orderdate").alias("filing_date"), F.col("o_orderstatus").alias("cik"), "o_orderpriority")
    return pipelines.filing_coverage(rows.where("o_orderpriority = '1-URGENT'"), rows.where("o_orderpriority <> '1-URGENT'"))


@query("""select c_custkey, c_name, case when c_acctbal > 0 then '' else 'unresolved_identity' end as issues from customer""")
def safe_overview(spark, d):
    rows = t(spark, d, "customer").withColumn("identity_matches", F.col("c_acctbal") > 0)
    safe, bad = pipelines.overview_safe(rows, ["c_custkey", "c_name"])
    return safe.withColumn("issues", F.lit("")).unionByName(bad.withColumn("issues", F.array_join("issues", ",")))


@query("""select count(*) as n_rows, count(*) filter (where o_orderstatus = 'O') as n_open, count(distinct o_custkey) as n_o_custkey, count(distinct o_orderpriority) as n_o_orderpriority from orders""")
def reduced_metrics(spark, d):
    o = t(spark, d, "orders")
    sessions = o.groupBy("o_orderdate").agg(F.count("*").alias("n_rows"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open"))
    return pipelines.reduced_metrics(sessions, ["n_rows", "n_open"], o, ["o_custkey", "o_orderpriority"])


# --- reference tables -----------------------------------------------------------------------------------------


@query("""select page_id as exchange_id, n as ordinal, concat_ws(',', case when page_id % 11 = 0 or page_id % 5 = 1 then 'domain' end, case when page_id % 7 = 0 then 'url' end, case when page_id % 13 = 0 then 'conflicting_key' end) as issues
  from pages, (values (0), (1)) v(n) where n = 0 or page_id % 11 = 0 or page_id % 5 = 1 or page_id % 7 = 0 or page_id % 13 = 0""")
def exchange_dimension(spark, d):
    k = F.col("page_id")
    one = t(spark, d, "pages").select(
        F.lit("2024-01-02").alias("capture_date"), k.alias("exchange_id"), F.when(k % 11 == 0, "crypto").otherwise("stocks").alias("asset_class"), F.lit("us").alias("locale"),
        F.when(k % 5 == 1, "bad").when(k % 5 > 1, "XNAS").alias("mic"), F.lit("Exchange").alias("name"), F.when(k % 7 == 0, F.regexp_replace("url", "^http", "ftp")).otherwise(F.col("url")).alias("url"), F.lit(0).alias("page"), F.lit(0).alias("ordinal"),
    )
    two = one.withColumns({"ordinal": F.lit(1), "name": F.when(F.col("exchange_id") % 13 == 0, "Another").otherwise(F.col("name"))})
    good, bad = pipelines.exchange_dim(one.unionByName(two))
    return good.select("exchange_id", "ordinal", F.lit("").alias("issues")).unionByName(bad.select("exchange_id", "ordinal", F.array_join("issues", ",").alias("issues")))


@query("""select p_brand || ' ' || p_type || ' ' || p_size as type_code, case when min(p_partkey % 50 = 0) then 'odd' else 'usual' end as description, min(p_partkey) as page
  from part group by 1 having count(distinct p_partkey % 50 = 0) = 1""")
def ticker_types(spark, d):
    code = F.concat_ws(" ", "p_brand", "p_type", F.col("p_size").cast("string"))
    rows = t(spark, d, "part").select(
        F.lit("2024-01-02").alias("capture_date"), F.lit("stocks").alias("asset_class"), F.lit("us").alias("locale"), code.alias("type_code"),
        F.when(F.col("p_partkey") % 50 == 0, "odd").otherwise("usual").alias("description"), F.col("p_partkey").alias("page"), F.lit(0).alias("ordinal"),
    )
    return pipelines.ticker_type_dim(rows)[0].select("type_code", "description", "page")


@query("""select p_partkey as condition_id, unnest([p_brand, p_type, p_name]) as data_type, unnest([0, 1, 2])::int as data_type_ordinal from part where p_partkey % 9 <> 0""")
def condition_bridge(spark, d):
    rows = t(spark, d, "part").select(
        F.lit("2024-01-02").alias("capture_date"), F.col("p_type").alias("condition_type"), F.col("p_partkey").alias("condition_id"), F.when(F.col("p_partkey") % 9 != 0, F.col("p_name")).otherwise("").alias("name"),
        F.array("p_brand", "p_type", "p_name").alias("data_types"), F.lit(0).alias("page"), F.lit(0).alias("ordinal"),
    )
    return pipelines.condition_tables(rows)[1].select("condition_id", "data_type", "data_type_ordinal")


# --- identity masters -----------------------------------------------------------------------------------------


def _tables(spark, d):
    none = spark.createDataFrame([], "source_record_id string, canonical string")
    return pipelines.four_tables(_members(spark, d), none, calendar.spine_of(events(spark, d), "day"))


@query(f"""select min(day) as first_session, max(day) as last_session, count(*) as n_rows, count(*) as n_direct, count(distinct user_id)::int as n_tickers, case when count(distinct user_id) = 1 then 'unique' else 'ambiguous' end as ticker_status
  from {DAILY} group by event_type""")
def asset_master(spark, d):
    return _tables(spark, d)["asset_master"].select("first_session", "last_session", "n_rows", "n_direct", F.size("ticker_variants").alias("n_tickers"), "ticker_status")


@query(f"""select min(day) as first_session, max(day) as last_session, count(*) as n_rows, count(distinct event_type)::int as n_assets, case when count(distinct event_type) = 1 then 'unique' else 'ambiguous' end as asset_status
  from {DAILY} group by user_id""")
def issuer_master(spark, d):
    return _tables(spark, d)["issuer_master"].select("first_session", "last_session", "n_rows", F.size("asset_id_variants").alias("n_assets"), F.col("asset_id_status").alias("asset_status"))


@query(f"""select x.user_id::varchar as ticker, day as session_date, x.user_id || '@' || r.first_day as alias_version_id, 'a' || a.n as asset_version_id, 'i' || i.n as issuer_version_id
  from {DAILY} x join {RUNS} r on x.user_id = r.user_id and x.day between r.first_day and r.last_day
  join (select event_type, count(*) as n from {DAILY} group by 1) a on x.event_type = a.event_type join (select user_id, count(*) as n from {DAILY} group by 1) i on x.user_id = i.user_id""")
def migrated_universe(spark, d):
    tables = _tables(spark, d)
    aliases = tables["ticker_alias"].withColumn("alias_version_id", F.concat_ws("@", "ticker", F.col("valid_from").cast("string")))
    assets = tables["asset_master"].withColumn("asset_version_id", F.concat(F.lit("a"), F.col("n_rows").cast("string")))
    issuers = tables["issuer_master"].withColumn("issuer_version_id", F.concat(F.lit("i"), F.col("n_rows").cast("string")))
    return pipelines.migrate_universe(tables["universe_daily"], aliases, assets, issuers, ["ticker", "session_date"])[0]


# --- factors --------------------------------------------------------------------------------------------------

LINKED = f"(select *, case when lag(close) over w > 0 then close / lag(close) over w - 1 end as r from {DAILY} window w as (partition by user_id order by day))"


@query(f"""select user_id, day, round(case when lag(close) over w > 0 then (close * (n % 3 + 1) + n * 0.25) / lag(close) over w - 1 end, 6) as link_return from {DAILY} window w as (partition by user_id order by day)""")
def total_returns(spark, d):
    rows = daily(spark, d).withColumns({"split": (F.col("n") % 3 + 1).cast("double"), "paid": F.col("n") * 0.25})
    return factors.link_returns(rows, "user_id", "day", "close", "paid", "split").select("user_id", "day", F.round("link_return", 6).alias("link_return"))


@query(f"""select user_id, day, round(exp(sum(ln((n % 3 + 1) / 2)) over (partition by user_id order by day)), 6) as cumulative_factor from {DAILY}""")
def split_factors(spark, d):
    rows = daily(spark, d).withColumns({"split_from": F.lit(2), "split_to": F.col("n") % 3 + 1})
    return factors.split_factor(rows, "user_id", "day", "split_from", "split_to").select("user_id", "day", F.round("cumulative_factor", 6).alias("cumulative_factor"))


@query(f"""with x as (select l.*, m from {LINKED} l join (select day, avg(close) as m from {DAILY} group by 1) using (day)),
y as (select user_id, day, avg(m) over w as mx, avg(r) over w as my, avg(m * m) over w as mxx, avg(m * r) over w as mxy, n_seen from (select user_id, day, case when r is not null then m end as m, r, count(r) over (partition by user_id order by day rows between 10 preceding and 1 preceding) as n_seen from x) window w as (partition by user_id order by day rows between 10 preceding and 1 preceding))
select user_id, day, round(case when n_seen > 2 and mxx - mx * mx > 0 then (mxy - mx * my) / (mxx - mx * mx) end, 5) as beta from y""")
def market_beta(spark, d):
    rows = factors.link_returns(daily(spark, d), "user_id", "day", "close")
    market = daily(spark, d).groupBy("day").agg(F.avg("close").alias("m"))
    rows = factors.rolling(factors.market_model(rows.join(market, "day"), "user_id", "day", "link_return", "m", 10), "user_id", "day", "link_return", 10)
    return rows.select("user_id", "day", F.round(F.when(F.col("rolling_n") > 2, F.col("beta")), 5).alias("beta"))


@query(f"""select user_id, day, round(avg(abs(r) / nullif(close * n, 0)) over (partition by user_id order by day rows between 10 preceding and 1 preceding), 6) as illiquidity from {LINKED}""")
def illiquidity_10(spark, d):
    rows = factors.link_returns(daily(spark, d), "user_id", "day", "close").withColumn("turnover", F.col("close") * F.col("n"))
    return factors.illiquidity(rows, "user_id", "day", "link_return", "turnover", 10).select("user_id", "day", F.round("illiquidity", 6).alias("illiquidity"))


@query("""select o_orderkey, round(avg(o_totalprice) over (partition by o_custkey, month(o_orderdate) order by year(o_orderdate) range between unbounded preceding and 1 preceding), 4) as seasonality from orders""")
def month_seasonality(spark, d):
    rows = t(spark, d, "orders")
    return factors.seasonality(rows, "o_custkey", "o_orderdate", "o_totalprice").select("o_orderkey", F.round("seasonality", 4).alias("seasonality"))
