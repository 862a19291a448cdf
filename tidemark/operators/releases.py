"""Release chains: base, delta and correction receipts folded into a view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..lineage import cut


def partition_view(receipts: DataFrame, key: list[str], release_index: str, available: str | None = None, cutoff: Column | None = None) -> DataFrame:
    """The last receipt of each partition in release order; with a cutoff, of those available by then."""
    rows = receipts if cutoff is None else receipts.where(F.col(available) <= cutoff)
    return rows.withColumn("_rn", F.row_number().over(W.partitionBy(*key).orderBy(F.desc(release_index)))).where("_rn = 1").drop("_rn")


def row_view(versions: DataFrame, key: list[str], version: str, predecessor: str, tombstone: str, available: str, cutoff: Column | None = None) -> DataFrame:
    """Terminal row versions: those that no applicable version replaces, without the dead.

    latest_reviewed_research: no cutoff. historical_as_known: only versions available at the cutoff count, as rows and
    as replacements.
    """
    rows = versions if cutoff is None else versions.where(F.col(available) <= cutoff)
    replaced = rows.where(F.col(predecessor).isNotNull()).select(*key, F.col(predecessor).alias(version)).distinct()
    return rows.join(replaced, [*key, version], "left_anti").where(~F.coalesce(F.col(tombstone), F.lit(False)))


def chain_faults(manifests: DataFrame) -> DataFrame:
    """(release_id, fault): fork, missing parent, cutoff going back, availability before the parent's, unreachable (a cycle).

    manifests: release_id, parent, source_cutoff, availability. Chains of any length: each round doubles how far back every
    release looks, so a sound one of n releases takes log2(n) rounds; one that comes to no first release by then is lost.
    """
    m = manifests.select("release_id", "parent", "source_cutoff", "availability")
    p = m.select(F.col("release_id").alias("_pid"), F.col("source_cutoff").alias("_pc"), F.col("availability").alias("_pa"))
    j = m.join(p, F.col("parent") == F.col("_pid"), "left")
    fault = lambda test, name: j.where(test).select("release_id", F.lit(name).alias("fault"))
    forks = m.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n")).where("n > 1").select(F.col("parent").alias("release_id"), F.lit("fork").alias("fault"))
    back = cut(m.groupBy("release_id").agg(F.max("parent").alias("at"), F.max(F.col("parent").isNull()).alias("first")))
    n = back.count()
    for _ in range(n.bit_length() if n else 0):
        if back.where("not first and at is not null").isEmpty():
            break
        further = back.select(F.col("release_id").alias("at"), F.col("at").alias("_at"), F.col("first").alias("_first"))
        back = cut(back.join(further, "at", "left").select("release_id", F.when(~F.col("first"), F.when(F.coalesce("_first", F.lit(False)), F.col("at")).otherwise(F.col("_at"))).alias("at"), F.coalesce(F.col("first") | F.col("_first"), "first").alias("first")))
    lost = m.join(back.where("first").select("release_id"), "release_id", "left_anti").select("release_id", F.lit("unreachable").alias("fault"))
    return forks.unionAll(fault("parent is not null and _pid is null", "missing_parent")).unionAll(fault("source_cutoff < _pc", "cutoff_decreases")).unionAll(fault("availability < _pa", "availability_decreases")).unionAll(lost)


def check_delta(delta: DataFrame, parent_max: object, session: str = "session_date") -> DataFrame:
    """delta, or an error when a session isn't later than the parent's last: late rows need a correction."""
    late = delta.where(F.col(session) <= F.lit(parent_max)).limit(1).count()
    if late:
        raise ValueError("a delta may only append later sessions; send a correction")
    return delta


def check_correction(corrections: DataFrame, current: DataFrame, key: list[str], named: str, receipt: str) -> DataFrame:
    """corrections, or an error when one names a receipt that isn't the current one of its partition."""
    stale = corrections.join(current.select(*key, F.col(receipt).alias("_now")), key, "left").where(~F.col(named).eqNullSafe(F.col("_now"))).limit(1).count()
    if stale:
        raise ValueError("a correction must name the current receipt")
    return corrections
