"""Scalar functions as Column expressions: time, text, arithmetic, JSON, digests, identifiers."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"
#: Unicode white space at either end, as a text strip takes it away.
EDGE_SPACE = r"(?U)^\s+|\s+$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time -----------------------------------------------------------------------------------------------------


def ns_to_timestamp(ns: str | Column) -> Column:
    """Epoch nanoseconds to a timestamp of microseconds; keep the long where order at ns matters."""
    return F.timestamp_micros(F.floor(col(ns).cast("decimal(20,0)") / 1000).cast("long"))


def new_york_date(ts: str | Column) -> Column:
    """Calendar date in New York of a UTC timestamp."""
    return F.to_date(F.from_utc_timestamp(col(ts).cast("timestamp"), NEW_YORK))


def order_key(time: str | Column, tie: str | Column, kind: str) -> Column:
    """One number that orders by (time, tie): unlike a struct, a hash aggregate can keep it in its buffer, so
    min_by and max_by need no sort before the shuffle. kind: the type of time; tie: any long."""
    if kind == "timestamp_ntz":
        units = F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), col(time))
    elif kind == "timestamp":
        units = F.unix_micros(col(time))
    else:
        units = col(time).cast("long")
    return (units.cast("decimal(19,0)") * F.lit(str(1 << 64)).cast("decimal(20,0)")).cast("decimal(38,0)") + col(tie).cast("decimal(19,0)")


def session_bounds_ns(day: str | Column) -> tuple[Column, Column]:
    """Epoch nanoseconds of New York midnight of a date and of the day after; aware of daylight saving."""
    at = lambda d: F.unix_micros(F.to_utc_timestamp(d.cast("timestamp"), NEW_YORK)) * 1000
    return at(col(day)), at(F.date_add(col(day), 1))


def ms_to_utc_date(ms: str | Column) -> Column:
    """UTC date of non-negative epoch milliseconds, else null."""
    return F.when(col(ms) >= 0, F.to_date(F.timestamp_millis(col(ms))))


def daily_bar_session(ms: str | Column) -> Column:
    """New York date of epoch milliseconds that fall on exactly 16:00 there, else null."""
    local = F.from_utc_timestamp(F.timestamp_millis(col(ms)), NEW_YORK)
    exact = (F.hour(local) == 16) & (F.minute(local) == 0) & (F.second(local) == 0) & (F.pmod(col(ms), F.lit(1000)) == 0)
    return F.when((col(ms) >= 0) & exact, F.to_date(local))


def strict_date(text: str | Column) -> Column:
    """Date of a text that is exactly yyyy-MM-dd and exists in the calendar, else null."""
    return F.when(col(text).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(col(text), "yyyy-MM-dd"))


UTC_TEXT = r"^(\d{4}-\d{2}-\d{2})T(\d{2}:\d{2}:\d{2})(?:\.(\d{1,9}))?(Z|[+-]\d{2}:\d{2})$"


def strict_utc_ns(text: str | Column) -> Column:
    """Epoch nanoseconds of an ISO timestamp that names its offset, with up to nine digits of a second; else null."""
    t = col(text)
    part = lambda k: F.regexp_extract(t, UTC_TEXT, k)
    base = F.try_to_timestamp(F.concat(part(1), F.lit(" "), part(2), F.lit(" "), F.when(part(4) == "Z", "+00:00").otherwise(part(4))), F.lit("yyyy-MM-dd HH:mm:ss XXX"))
    fraction = F.rpad(F.coalesce(part(3), F.lit("")), 9, "0").cast("long")
    return F.when(t.rlike(UTC_TEXT), F.unix_seconds(base) * F.lit(1_000_000_000) + fraction)


def is_weekend(day: str | Column) -> Column:
    return F.weekday(col(day)) >= 5


def date_quality(day: str | Column) -> Column:
    """Names the known sentinel, boundary and cluster dates (fixed values)."""
    d = col(day).cast("string")
    return (
        F.when(d == "1969-12-31", "provider_sentinel_candidate_1969_12_31").when(d == "2003-09-10", "source_boundary_candidate_2003_09_10")
        .when(d == "2023-11-18", "provider_cluster_candidate_2023_11_18").when(d.isNotNull(), "ordinary_calendar_date")
    )


# --- text -----------------------------------------------------------------------------------------------------


def clean(text: str | Column) -> Column:
    """Unicode white space stripped; blank becomes null."""
    return F.nullif(F.regexp_replace(col(text), EDGE_SPACE, ""), F.lit(""))


def is_trimmed_text(text: str | Column) -> Column:
    """Not null, not empty, no white space at either end; never null itself."""
    return F.coalesce((col(text) != "") & (F.regexp_replace(col(text), EDGE_SPACE, "") == col(text)), F.lit(False))


def padded_cik(cik: str | Column) -> Column:
    """Company number of one to ten digits, padded to ten; else null."""
    return F.when(col(cik).rlike(r"^[0-9]{1,10}$"), F.lpad(col(cik), 10, "0"))


ACCESSION = r"(?<![0-9])[0-9]{10}-[0-9]{2}-[0-9]{6}(?![0-9])"


def accession_of(url: str | Column) -> Column:
    """The one filing number in the path of an http(s) URL without query or fragment, else null."""
    u = col(url)
    ok = is_trimmed_text(u) & u.rlike(r"^(?i:https?)://[^/?#]+[^?#]*$")
    found = F.regexp_extract_all(F.regexp_replace(u, r"^[^:]+://[^/?#]+", ""), F.lit(ACCESSION), F.lit(0))
    return F.when(ok & (F.size(found) == 1), F.element_at(found, 1))


def folded(text: str | Column) -> Column:
    """Full case folding, as str.casefold: lower case, and beyond ASCII what folding changes in lower-case letters too."""
    lower = F.lower(col(text))
    one, more = fold_tables()
    other = F.translate(lower, "".join(one), "".join(one.values()))
    for c, to in more.items():
        other = F.replace(other, F.lit(c), F.lit(to))
    return F.when(col(text).rlike(r"^\p{ASCII}*$"), lower).otherwise(other)


@cache
def fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Lower-case letters that folding changes, to one letter and to several, by the rules of Python's Unicode tables."""
    changed = {c: to for c in map(chr, range(128, 0x1FFFF)) if c == c.lower() and (to := c.casefold()) != c}
    return {c: to for c, to in changed.items() if len(to) == 1}, {c: to for c, to in changed.items() if len(to) > 1}


FIGI_RULES = ("null", "empty", "whitespace_only", "surrounding_whitespace", "length_not_12", "non_upper_ascii_alnum", "prefix_not_BBG")


def figi_reason(value: str | Column, field: str = "composite_figi") -> Column:
    """The first reason, in fixed order, why an identifier is malformed; null if it is well formed."""
    v = col(value)
    tests = (v.isNull(), v == "", v.rlike(r"(?U)^\s+$"), v.rlike(r"(?U)^\s|\s$"), F.length(v) != 12, ~v.rlike("^[A-Z0-9]+$"), ~v.startswith("BBG"))
    out = None
    for test, name in zip(tests, FIGI_RULES, strict=True):
        out = F.when(test, f"{field}_{name}") if out is None else out.when(test, f"{field}_{name}")
    return out


# --- arithmetic -----------------------------------------------------------------------------------------------


def is_finite(x: str | Column) -> Column:
    """Not null, not NaN, not infinite; never null itself."""
    x = col(x).cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))


def differs(a: str | Column, b: str | Column, absolute: float, relative: float) -> Column:
    """abs(a - b) > max(absolute, relative * larger magnitude), false unless both are finite."""
    x, y = col(a).cast("double"), col(b).cast("double")
    both = is_finite(x) & is_finite(y)
    return F.when(both, F.abs(x - y) > F.greatest(F.lit(absolute), F.greatest(F.abs(x), F.abs(y)) * relative)).otherwise(False)


def ratio(top: str | Column, bottom: str | Column, empty: float | None = None) -> Column:
    """top / bottom as a double; null, or the given value, where bottom is 0 or null."""
    out = F.try_divide(col(top).cast("double"), col(bottom).cast("double"))
    return out if empty is None else F.coalesce(out, F.lit(empty))


def plain_ratio(top: str | Column, bottom: str | Column) -> Column:
    """top / bottom by the rules of doubles: over 0 (of either sign) infinite, 0 / 0 not a number; null only where one is null."""
    x, y = col(top).cast("double"), col(bottom).cast("double")
    return F.when(y == 0, x * float("inf")).otherwise(F.try_divide(x, y))


def rounded(x: str | Column, places: int) -> Column:
    """The double scaled, rounded half away from 0 and scaled back, as SQL engines round doubles; F.round rounds the
    shortest decimal text instead, which falls to the other side of some halves."""
    x, scale = col(x).cast("double"), F.lit(10.0**places)
    out = F.round(x * scale) / scale
    return F.when(F.abs(out) == float("inf"), x).otherwise(out)


def on_grid(ns: str | Column, step: int = 60_000_000_000) -> Column:
    return F.pmod(col(ns), F.lit(step)) == 0


# --- JSON, digests, identifiers -------------------------------------------------------------------------------


def canonical_json(**fields: str | Column) -> Column:
    """JSON text with sorted keys, no spaces, and nulls written out."""
    return F.to_json(F.struct(*[col(fields[k]).alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def stable_digest(**fields: str | Column) -> Column:
    """SHA-256 of the canonical JSON of named fields: the one rule for row and surrogate identifiers."""
    return F.sha2(canonical_json(**fields), 256)


def json_round_trips(text: str | Column) -> Column:
    """The text is JSON and is already in the compact form that a parser would write again."""
    v = F.try_parse_json(col(text))
    return F.coalesce(F.to_json(v) == col(text), F.lit(False))


def native_type(text: str | Column) -> Column:
    """Type of a JSON value given as text: null, empty, boolean, integer, number, string, array, object or invalid."""
    v = F.try_parse_json(col(text))
    kind = F.schema_of_variant(v)
    return (
        F.when(col(text).isNull(), "null").when(col(text) == "", "empty").when(v.isNull(), "invalid")
        .when(kind == "VOID", "null").when(kind == "BOOLEAN", "boolean").when(kind == "BIGINT", "integer")
        .when(kind.startswith("DECIMAL(") | (kind == "DOUBLE"), "number").when(kind == "STRING", "string")
        .when(kind.startswith("ARRAY"), "array").otherwise("object")
    )


def asset_id(composite: str | Column, namespace: str = "asset", version: str = "1") -> Column:
    return stable_digest(composite_figi=composite, namespace=F.lit(namespace), rule_version=F.lit(version))


def share_class_id(share: str | Column) -> Column:
    return stable_digest(share_class_figi=share, namespace=F.lit("share_class"), rule_version=F.lit("1"))


def issuer_id(cik: str | Column) -> Column:
    return stable_digest(cik=padded_cik(cik), namespace=F.lit("issuer"), rule_version=F.lit("1"))


def alias_segment_id(ticker: str | Column, asset: str | Column, start: str | Column) -> Column:
    return stable_digest(asset_id=asset, namespace=F.lit("alias"), ticker=ticker, valid_from=col(start).cast("string"))
