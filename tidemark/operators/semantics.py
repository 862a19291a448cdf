"""Key and reference audits: anti joins, existence checks, uniqueness reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def undefined_uses(uses: DataFrame, definitions: DataFrame, on: list[str]) -> DataFrame:
    """Uses without a definition."""
    return uses.join(definitions.select(*on), on, "left_anti")


def present_but_disagreeing(left: DataFrame, right: DataFrame, on: list[str], also: list[str]) -> DataFrame:
    """Left rows with a partner on `on`, but with none that agrees in `also` too: any one agreeing partner is enough."""
    near = left.join(right.select(*on), on, "left_semi")
    return near.join(right.select(*on, *also), [*on, *also], "left_anti")


def uniqueness(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row: rows, distinct keys, excess rows, keys with conflicting rows. Counts combine before each shuffle."""
    digest = F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256)
    groups = df.groupBy(*keys, digest.alias("_h")).agg(F.count("*").alias("_n")).groupBy(*keys).agg(F.sum("_n").alias("_n"), F.count("*").alias("_kinds"))
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("distinct_keys"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("excess_rows"), F.count_if(F.col("_kinds") > 1).alias("conflicting_keys"))


def occurrence_counts(pages: DataFrame, keys: list[str]) -> DataFrame:
    """How often each key occurs over all pages: what an upsert counter holds at its end."""
    return pages.groupBy(*keys).agg(F.count("*").alias("occurrences"))


def single_version(df: DataFrame, by: list[str], version: str) -> DataFrame:
    """(by, n_versions, ok): exactly one version of a taxonomy in use."""
    return df.groupBy(*by).agg(F.count_distinct(version).alias("n_versions")).withColumn("ok", F.col("n_versions") == 1)


def foreign_key_faults(df: DataFrame, key: str, parent: DataFrame, parent_key: str, eligible: str) -> DataFrame:
    """One row: eligible rows, and those whose key has no parent; a caller fails closed when there are any."""
    p = parent.select(F.col(parent_key).alias("_p")).distinct()
    rows = df.where(F.col(eligible)).join(p, F.col(key) == F.col("_p"), "left")
    return rows.agg(F.count("*").alias("eligible_rows"), F.count_if(F.col("_p").isNull()).alias("missing_keys"))


def require_none(df: DataFrame, what: str) -> None:
    """Raises when df has a row."""
    if not df.isEmpty():
        raise ValueError(what)
