"""Row contracts: boolean Columns that are never null, so that a count never loses a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import ACCESSION, accession_of, col, daily_bar_session, is_finite, is_trimmed_text, strict_date


def sure(p: Column) -> Column:
    """A null verdict counts as false."""
    return F.coalesce(p, F.lit(False))


def count_true(p: Column) -> Column:
    return F.count_if(sure(p)).cast("long")


def bad_prices(*prices: str) -> Column:
    """Any price is null, not finite, or not positive."""
    out = F.lit(False)
    for p in prices:
        out = out | ~is_finite(p) | sure(F.col(p) <= 0)
    return out


def broken_envelope(o: str, h: str, low: str, c: str) -> Column:
    """High below low, or open or close outside of them."""
    o, h, low, c = (col(x) for x in (o, h, low, c))
    return sure((h < low) | (o > h) | (o < low) | (c > h) | (c < low))


def in_window(t: str | Column, start: str | Column, end: str | Column) -> Column:
    """start <= t < end."""
    return sure((col(t) >= col(start)) & (col(t) < col(end)))


def valid_daily_bar(ticker="T", t="t", o="o", h="h", low="l", c="c", v="v", n="n", vw="vw") -> Column:
    """Contract of a grouped daily bar: trimmed ticker, 16:00 New York end, positive prices that nest, volume at least 0."""
    nonneg = lambda x: is_finite(x) & sure(F.col(x) >= 0)
    optional = (F.col(n).isNull() | sure(F.col(n) >= 0)) & (F.col(vw).isNull() | nonneg(vw))
    return is_trimmed_text(ticker) & daily_bar_session(t).isNotNull() & ~bad_prices(o, h, low, c) & nonneg(v) & optional & ~broken_envelope(o, h, low, c)


#: Which fiscal periods go with a timeframe, which fields with a metric's source.
FISCAL = {"annual": ("FY",), "quarterly": ("Q1", "Q2", "Q3", "Q4"), "ttm": ("TTM",)}
METRIC_TEXT = {"direct_report": "xpath", "intra_report_impute": "formula"}


def valid_metric(m: Column) -> Column:
    """One reported metric: label, unit, order and finite value, and the evidence that its source calls for."""
    base = is_trimmed_text(m["label"]) & is_trimmed_text(m["unit"]) & m["order"].isNotNull() & is_finite(m["value"])
    source = m["source"]
    accessions = m["derived_from"]
    derived = (F.size(accessions) > 0) & F.forall(accessions, lambda a: a.rlike(f"^{ACCESSION}$")) & (F.size(F.array_distinct(accessions)) == F.size(accessions))
    evidence = F.when(source == "direct_report", is_trimmed_text(m["xpath"]) & m["formula"].isNull() & accessions.isNull())
    evidence = evidence.when(source == "intra_report_impute", is_trimmed_text(m["formula"]) & m["xpath"].isNull() & accessions.isNull())
    return sure(base & evidence.when(source == "inter_report_derived", derived & m["xpath"].isNull() & m["formula"].isNull()).otherwise(False))


def valid_financials() -> Column:
    """Contract of a legacy financial row with columns start_date, end_date, filing_date, cik, company_name, timeframe,
    fiscal_period, fiscal_year, sic, tickers, source_filing_url, source_filing_file_url, financials."""
    start, end, filed = (strict_date(c) for c in ("start_date", "end_date", "filing_date"))
    period = F.lit(False)
    for timeframe, periods in FISCAL.items():
        period = period | ((F.col("timeframe") == timeframe) & F.col("fiscal_period").isin(*periods))
    tickers = F.col("tickers").isNull() | ((F.size("tickers") > 0) & F.forall("tickers", is_trimmed_text) & (F.size(F.array_distinct("tickers")) == F.size("tickers")))
    accession = accession_of("source_filing_url")
    sections = (F.size("financials") > 0) & F.forall(F.map_values("financials"), lambda s: (F.size(s) > 0) & F.forall(F.map_values(s), valid_metric) & F.forall(F.map_keys(s), is_trimmed_text))
    return (
        sure((start <= end) & (end <= filed)) & sure(F.col("cik").rlike("^[0-9]{10}$")) & is_trimmed_text("company_name") & sure(period) & is_trimmed_text("fiscal_year")
        & sure(F.col("sic") == F.regexp_replace("sic", r"(?U)^\s+|\s+$", "")) & sure(tickers) & sure(accession == accession_of("source_filing_file_url")) & sure(sections)
    )


def valid_http_url(url: str | Column) -> Column:
    return sure(col(url).rlike(r"^https?://[^/\s?#]+"))


def valid_dimension(asset_class: str, locale: str, mic: str | None = None) -> Column:
    """Domain of a reference row: class stocks, locale us, and a market code of four capitals or digits, or none."""
    ok = sure((F.col(asset_class) == "stocks") & (F.col(locale) == "us"))
    return ok if mic is None else ok & (F.col(mic).isNull() | sure(F.col(mic).rlike("^[A-Z0-9]{4}$")))
