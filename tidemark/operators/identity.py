"""Decision tables: which identity a row resolves to, and why. Everything that isn't certain stays ineligible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import asset_id, figi_reason


def classify_market(mappings: DataFrame, query: str = "query", figi: str = "figi", composite: str = "composite", share: str = "share", market: str = "market") -> DataFrame:
    """(query, classification, market_code, n_self_rows, share_class_conflict) from identifier-mapping rows.

    A self row has identifier and composite equal to the query. One self row with a market and a share class:
    us_composite for market US, else non_us_composite. Several: unresolved_mixed_market if they name several
    markets, else unresolved_invalid_projection. None: unresolved_no_self_row.
    """
    own = F.coalesce((F.col(figi) == F.col(query)) & (F.col(composite) == F.col(query)), F.lit(False))
    related = F.coalesce(F.col(composite) == F.col(query), F.lit(False))
    facts = mappings.groupBy(query).agg(
        F.count_if(own).alias("n_self_rows"), F.array_sort(F.collect_set(F.when(own & (F.col(market) != ""), F.col(market)))).alias("_markets"),
        F.count_if(own & (F.coalesce(F.col(market), F.lit("")) != "") & (F.coalesce(F.col(share), F.lit("")) != "")).alias("_complete"),
        (F.count_distinct(F.when(related & (F.col(share) != ""), F.col(share))) > 1).alias("share_class_conflict"),
    )
    label = (
        F.when((F.col("n_self_rows") == 1) & (F.col("_complete") == 0), "unresolved_invalid_projection")
        .when(F.col("n_self_rows") == 1, F.when(F.col("_markets")[0] == "US", "us_composite").otherwise("non_us_composite"))
        .when((F.col("n_self_rows") > 1) & (F.size("_markets") > 1), "unresolved_mixed_market").when(F.col("n_self_rows") > 1, "unresolved_invalid_projection").otherwise("unresolved_no_self_row")
    )
    return facts.select(query, label.alias("classification"), F.when(F.size("_markets") == 1, F.col("_markets")[0]).alias("market_code"), "n_self_rows", "share_class_conflict")


def registry_projection(rows: DataFrame, scopes: DataFrame, row_id: str, attributes: list[str], observed: str) -> DataFrame:
    """Adds n_matches, canonical, method, eligible to rows from registry scopes (source_record_id, attributes, canonical).

    A decision applies to the listed record only, and only while the attributes still agree. No match keeps the
    observed identifier if it is well formed; one match overrides it; more than one fails closed.
    """
    on = [F.col(row_id) == F.col("_sid"), *[F.col(a).eqNullSafe(F.col(f"_s_{a}")) for a in attributes]]
    s = scopes.select(F.col("source_record_id").alias("_sid"), *[F.col(a).alias(f"_s_{a}") for a in attributes], F.col("canonical").alias("_canonical"))
    hits = s.groupBy("_sid", *[f"_s_{a}" for a in attributes]).agg(F.count_distinct("_canonical").alias("n_matches"), F.min("_canonical").alias("_canonical"))
    out = rows.join(hits, on, "left").drop("_sid", *[f"_s_{a}" for a in attributes]).withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))
    sound = figi_reason(observed).isNull()
    canonical = F.when(F.col("n_matches") == 1, F.col("_canonical")).when((F.col("n_matches") == 0) & sound, F.col(observed))
    method = F.when(F.col("n_matches") == 1, "registry_exact_scope").when(F.col("n_matches") > 1, "registry_ambiguous").when(sound, "source_composite_figi_exact").otherwise("ticker_only")
    return out.withColumn("canonical", canonical).withColumn("method", method).withColumn("eligible", canonical.isNotNull()).drop("_canonical")


def resolve_at_cutoff(rows: DataFrame, cases: DataFrame, decisions: DataFrame, cutoff) -> DataFrame:
    """Adds canonical_composite_figi, canonical_asset_id, status, method, disposition, eligible to membership rows.

    rows: source_record_id, observed_composite_figi, relationship_conflict. cases: case_id, source_record_id.
    decisions: case_id, version, disposition, canonical_composite_figi, available_session; the last one available
    at the cutoff counts. Rows outside a case resolve directly. A case without a decision stays pending, an
    adjudicated-unresolved one stays unresolved; only approved decisions give an identity. A contamination target
    must be seen directly elsewhere, or the resolution fails.
    """
    from .asof import effective_head

    head = effective_head(decisions, ["case_id"], "version", "available_session", cutoff).select(F.col("case_id").alias("_case"), F.col("disposition").alias("_d"), F.col("canonical_composite_figi").alias("_target"))
    c = cases.select(F.col("source_record_id").alias("_src"), "case_id").join(head, F.col("case_id") == F.col("_case"), "left").drop("_case")
    out = rows.join(c, F.col("source_record_id") == F.col("_src"), "left").drop("_src")
    observed, conflict = F.col("observed_composite_figi"), F.coalesce(F.col("relationship_conflict"), F.lit(False))
    sound, direct, none = figi_reason(observed).isNull(), F.col("case_id").isNull(), F.lit(None).cast("string")
    approved = F.col("_d").isin("confirmed_genuine_transition", "confirmed_provider_contamination")
    canonical = F.when(direct & sound, observed).when(~direct & approved, F.col("_target")).otherwise(none)
    disposition = (
        F.when(direct, F.when(sound, "observed_consistent").otherwise("not_applicable_no_observed_composite")).when(F.col("_d").isNull(), "pending_unresolved").otherwise(F.col("_d"))
    )
    method = (
        F.when(direct & ~sound, "ticker_only").when(direct & conflict, "source_composite_figi_exact_with_relationship_conflict").when(direct, "source_composite_figi_exact")
        .when(F.col("_d").isNull(), "provider_figi_bounce_pending_unresolved").when(F.col("_d") == "confirmed_genuine_transition", "approved_genuine_transition")
        .when(F.col("_d") == "confirmed_provider_contamination", "approved_provider_contamination_override").otherwise("provider_figi_bounce_adjudicated_unresolved")
    )
    status = F.when(canonical.isNull(), "unresolved").when(conflict, "resolved_conflicted").when(F.col("_d") == "confirmed_provider_contamination", "resolved_approved_override").otherwise("resolved_strong")
    out = out.withColumns({"canonical_composite_figi": canonical, "disposition": disposition, "method": method, "status": status})
    out = out.withColumn("eligible", F.col("canonical_composite_figi").isNotNull() & ~conflict).withColumn("canonical_asset_id", F.when(F.col("canonical_composite_figi").isNotNull(), asset_id("canonical_composite_figi")))
    return out.drop("_d", "_target")


def contamination_faults(resolved: DataFrame) -> DataFrame:
    """Override targets that no row outside a case shows by itself; a caller fails closed when there are any."""
    anchors = resolved.where("case_id is null and eligible").select(F.col("observed_composite_figi").alias("canonical_composite_figi")).distinct()
    targets = resolved.where("disposition = 'confirmed_provider_contamination'").select("canonical_composite_figi").distinct()
    return targets.join(anchors, "canonical_composite_figi", "left_anti")


def cross_market(rows: DataFrame, overrides: DataFrame) -> DataFrame:
    """Rows of US locale whose composite is foreign: resolved by an override of exact scope, else ineligible.

    rows: source_record_id, locale, market_class, observed_composite_figi. overrides: source_record_id, canonical.
    """
    o = overrides.groupBy(F.col("source_record_id").alias("_src")).agg(F.count_distinct("canonical").alias("_n"), F.min("canonical").alias("_canonical"))
    out = rows.join(o, F.col("source_record_id") == F.col("_src"), "left")
    foreign = (F.col("locale") == "us") & (F.col("market_class") == "non_us_composite")
    unknown = (F.col("locale") == "us") & F.coalesce(~F.col("market_class").isin("us_composite", "non_us_composite"), F.lit(True))
    one = F.coalesce(F.col("_n") == 1, F.lit(False))
    canonical = F.when(foreign & one, F.col("_canonical")).when(~foreign & ~unknown, F.col("observed_composite_figi"))
    status = F.when(foreign & one, "foreign_overridden").when(foreign, "foreign_unresolved").when(unknown, "reference_unknown").otherwise("consistent")
    return out.withColumn("canonical", canonical).withColumn("cross_market_status", status).withColumn("eligible", canonical.isNotNull()).drop("_src", "_n", "_canonical")


def external_overlay(queries: DataFrame, results: DataFrame, listings: DataFrame) -> DataFrame:
    """(ticker, mic, overlay_status, composite, share_class) for rows without an identifier of their own.

    results: ticker, result_ticker, sector, security_type, composite, share_class; a result counts if it names the same
    ticker, common stock, and two well-formed identifiers. No rows: no_result; none that counts: no_match; several
    pairs: ambiguous; one pair without a matching listing (ticker, mic): listing_mismatch; else resolved.
    """
    good = (F.col("result_ticker") == F.col("ticker")) & (F.col("sector") == "Equity") & (F.col("security_type") == "Common Stock") & figi_reason("composite").isNull() & figi_reason("share_class").isNull()
    facts = results.groupBy("ticker").agg(F.count("*").alias("_rows"), F.collect_set(F.when(F.coalesce(good, F.lit(False)), F.struct("composite", "share_class"))).alias("_pairs"))
    listed = listings.select("ticker", "mic").distinct().withColumn("_listed", F.lit(True))
    out = queries.join(facts, "ticker", "left").join(listed, ["ticker", "mic"], "left")
    n = F.coalesce(F.size("_pairs"), F.lit(0))
    status = (
        F.when(F.col("_rows").isNull(), "no_result").when(n < 1, "no_match").when(n > 1, "ambiguous").when(F.col("_listed").isNull(), "listing_mismatch").otherwise("resolved")
    )
    pair = F.when(status == "resolved", F.col("_pairs")[0])
    return out.select("ticker", "mic", status.alias("overlay_status"), pair["composite"].alias("composite"), pair["share_class"].alias("share_class"))


def effective_identity(rows: DataFrame, overlay: DataFrame, key: list[str], field: str) -> DataFrame:
    """Adds effective_<field>: the overlay's value where there is one; what was observed stays as it was."""
    o = overlay.select(*key, F.col(field).alias("_o"))
    return rows.join(o, key, "left").withColumn(f"effective_{field}", F.coalesce("_o", field)).drop("_o")


def missing_identifier_candidates(active: str, type_: str, identifiers: list[str], mic: str, markets: list[str], cik: str) -> Column:
    """Active common stock without any identifier, on a supported market, with a valid company number."""
    out = F.coalesce(F.col(active), F.lit(False)) & (F.col(type_) == "CS") & F.col(mic).isin(markets) & F.col(cik).rlike("^[0-9]{10}$")
    for c in identifiers:
        out = out & F.col(c).isNull()
    return F.coalesce(out, F.lit(False))


def continuation(target: DataFrame, state: DataFrame, key: list[str], identity: list[str], expired: str) -> DataFrame:
    """A new session's rows against carried state: continued if no override expired or the identity is unchanged, else pending.

    state: key, identity columns, expired (the override behind it has run out). Rows without state are new.
    """
    s = state.select(*key, *[F.col(c).alias(f"_s_{c}") for c in identity], F.col(expired).alias("_expired"), F.lit(True).alias("_known"))
    out = target.join(s, key, "left")
    same = F.lit(True)
    for c in identity:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    label = F.when(F.col("_known").isNull(), "new").when(~F.coalesce(F.col("_expired"), F.lit(False)), F.when(same, "continued").otherwise("changed")).when(same, "continued_after_expiry").otherwise("pending")
    return out.withColumn("continuation", label).drop(*[f"_s_{c}" for c in identity], "_expired", "_known")
