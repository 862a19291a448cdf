"""Duplicates: counts, deterministic removal, and version selection with tie rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import stable_digest


def duplicate_stats(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row: keys with duplicates, rows in excess, and of these keys the exact and the conflicting ones.

    Two aggregations that both combine before the shuffle; values are compared as a struct, nulls included.
    """
    groups = df.groupBy(*keys, F.struct(*values).alias("_v")).agg(F.count("*").alias("_n")).groupBy(*keys).agg(F.sum("_n").alias("_n"), F.count("*").alias("_kinds"))
    many = F.col("_n") > 1
    return groups.agg(
        F.count_if(many).alias("duplicate_keys"), F.coalesce(F.sum(F.when(many, F.col("_n") - 1)), F.lit(0)).alias("duplicate_excess"),
        F.count_if(many & (F.col("_kinds") == 1)).alias("exact_keys"), F.count_if(many & (F.col("_kinds") > 1)).alias("conflicting_keys"),
    )


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in a total order, nulls last; what ties is equal in all that orders."""
    by = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*by))).where("_rn = 1").drop("_rn")


def difference_fields(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys and difference_fields: sorted names of the fields with more than one value in the group, null being one."""
    flags = [F.when((F.count_distinct(f) + F.max(F.col(f).isNull().cast("int"))) > 1, F.lit(f)) for f in sorted(fields)]
    return df.groupBy(*keys).agg(F.array_compact(F.array(*flags)).alias("difference_fields"))


def select_version(df: DataFrame, keys: list[str], identity: list[str], fields: list[str], updated: str, position: list[str], row_id: str, allowed: list[list[str]] | None = None) -> DataFrame:
    """Adds version_status, version_rank, version_reason, selected to every row of competing versions.

    A lone row is a singleton. Equal rows: the least source position wins. Otherwise the group must agree on
    identity, differ in an allowed set of fields only (None: any), have all timestamps, and have one latest;
    then the latest wins and all are ranked by time, then row_id. What fails stays unresolved, unranked.
    Group facts come from one aggregation, joined back by the key that the window then needs anyway.
    """
    value = lambda cs: F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in cs]), {"ignoreNullFields": "false"})
    flags = [F.when((F.count_distinct(f) + F.max(F.col(f).isNull().cast("int"))) > 1, F.lit(f)) for f in sorted(fields)]
    facts = df.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.count_distinct(F.sha2(value(fields), 256)).alias("_kinds"), F.count_distinct(F.sha2(value(identity), 256)).alias("_identities"),
        F.count_if(F.col(updated).isNull()).alias("_untimed"), F.max(updated).alias("_latest"), F.array_compact(F.array(*flags)).alias("difference_fields"),
    )
    named = facts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in facts.columns if c not in keys])
    rows = df.join(named, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]).drop(*[f"_k_{k}" for k in keys])
    group = W.partitionBy(*keys)
    rows = rows.withColumn("_ties", F.count_if(F.col(updated) == F.col("_latest")).over(group))
    permitted = F.lit(True) if allowed is None else F.array_contains(F.array(*[F.array(*[F.lit(x) for x in sorted(a)]) for a in allowed]), F.col("difference_fields"))
    status = (
        F.when(F.col("_n") == 1, "singleton").when(F.col("_kinds") == 1, "resolved_exact_duplicate").when(F.col("_identities") > 1, "unresolved_identity_conflict")
        .when(~permitted, "unresolved_difference_set").when(F.col("_untimed") > 0, "unresolved_timestamp_missing_or_invalid").when(F.col("_ties") > 1, "unresolved_timestamp_tie")
        .otherwise("resolved_unique_latest_last_updated")
    )
    rows = rows.withColumn("version_status", status)
    by_place = F.row_number().over(group.orderBy(*position, row_id))
    by_time = F.row_number().over(group.orderBy(F.col(updated).desc(), F.col(row_id)))
    placed, timed = F.col("version_status").isin("singleton", "resolved_exact_duplicate"), F.col("version_status") == "resolved_unique_latest_last_updated"
    rows = rows.withColumn("version_rank", F.when(placed, by_place).when(timed, by_time))
    first = F.col("version_rank") == 1
    reason = (
        F.when(F.col("version_status") == "singleton", "singleton")
        .when(placed, F.when(first, "selected_min_source_position_exact_duplicate").otherwise("rejected_later_source_position_exact_duplicate"))
        .when(timed, F.when(first, "selected_unique_max_last_updated").otherwise("rejected_older_last_updated")).otherwise(F.col("version_status"))
    )
    return rows.withColumn("version_reason", reason).withColumn("selected", F.coalesce(first, F.lit(False))).drop("_n", "_kinds", "_identities", "_untimed", "_latest", "_ties")


def conflicting_keys(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys that map to more than one value, and how many."""
    return df.select(*keys, F.struct(*values).alias("_v")).distinct().groupBy(*keys).agg(F.count("*").alias("n_values")).where("n_values > 1")


def version_group_id(**key: str) -> Column:
    return stable_digest(**key)
