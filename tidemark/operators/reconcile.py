"""Two independently delivered products of one fact, compared key by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.predicates import count_true
from ..functions.scalar import differs, ratio


def full_compare(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Full outer join on keys with prefixed fields and the presence flags in_<name>; the key is one column."""
    a, b = names
    one = left.select(*keys, *[F.col(f).alias(f"{a}_{f}") for f in fields], F.lit(True).alias(f"in_{a}"))
    two = right.select(*keys, *[F.col(f).alias(f"{b}_{f}") for f in fields], F.lit(True).alias(f"in_{b}"))
    joined = one.join(two, keys, "full")
    return joined.withColumns({f"in_{n}": F.coalesce(f"in_{n}", F.lit(False)) for n in names})


def coverage_state(in_reference: str | Column, in_bars: str | Column, active: str | Column | None = None) -> Column:
    """matched, reference_only, inactive_with_bar or bar_only."""
    r, b = (F.col(x) if isinstance(x, str) else x for x in (in_reference, in_bars))
    live = F.lit(True) if active is None else (F.col(active) if isinstance(active, str) else active)
    return F.when(r & b & live, "matched").when(r & b, "inactive_with_bar").when(r, "reference_only").otherwise("bar_only")


def mismatch_summary(joined: DataFrame, fields: list[str], names: tuple[str, str] = ("left", "right"), absolute: float = 0.0, relative: float = 0.0, by: list[str] | None = None) -> DataFrame:
    """Counts of pairs, one-sided keys, and of each field's mismatches beyond the tolerance."""
    a, b = names
    both = F.col(f"in_{a}") & F.col(f"in_{b}")
    return joined.groupBy(*(by or [])).agg(
        count_true(both).alias("pairs"), count_true(F.col(f"in_{a}") & ~F.col(f"in_{b}")).alias(f"{a}_only"), count_true(F.col(f"in_{b}") & ~F.col(f"in_{a}")).alias(f"{b}_only"),
        *[count_true(both & differs(f"{a}_{f}", f"{b}_{f}", absolute, relative)).alias(f"{f}_mismatches") for f in fields],
    )


def coverage_status(missing: str, union: str, most: float = 0.10, least: int = 2) -> Column:
    """failed: over a tenth and at least two missing; different: any; else matched."""
    share = ratio(missing, union, 0.0)
    return F.when((F.col(missing) >= least) & (share > most), "failed").when(F.col(missing) > 0, "different").otherwise("matched")


def snapshot_diff(df: DataFrame, capture: str, keys: list[str], attribute: str) -> DataFrame:
    """One row: new, disappeared and changed keys between adjacent captures, each with its own denominator.

    df has one row for each key of a capture. Adjacent captures come from a window over the distinct captures, a
    small calendar; keys meet in one full outer join.
    """
    captures = df.select(capture).distinct()
    follow = captures.withColumn("_next", F.lead(capture).over(W.orderBy(capture))).where("_next is not null")
    prior = df.join(F.broadcast(follow), capture).select(F.col("_next").alias("_at"), *keys, F.struct(F.col(attribute)).alias("_old"))
    current = df.join(F.broadcast(follow.select(F.col("_next").alias(capture))), capture).select(F.col(capture).alias("_at"), *keys, F.struct(F.col(attribute)).alias("_new"))
    both = prior.join(current, ["_at", *keys], "full")
    old, new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    return both.agg(
        F.count_if(new & ~old).alias("new_keys"), F.count_if(new).alias("new_of"), F.count_if(old & ~new).alias("disappeared_keys"), F.count_if(old).alias("disappeared_of"),
        F.count_if(old & new & ~F.col("_old").eqNullSafe(F.col("_new"))).alias("changed_keys"), F.count_if(old & new).alias("changed_of"),
    )


def plan_coverage(expected: DataFrame, observed: DataFrame, key: list[str]) -> DataFrame:
    """(key, state) of requests that are missing or were never planned."""
    e, o = expected.select(*key).distinct(), observed.select(*key).distinct()
    return e.join(o, key, "left_anti").withColumn("state", F.lit("missing")).unionByName(o.join(e, key, "left_anti").withColumn("state", F.lit("extra")))


def projection_check(child: DataFrame, parent: DataFrame, key: str, parent_key: str, fields: list[str]) -> DataFrame:
    """Child rows whose parent is missing or disagrees in a projected field: broken_fields lists which."""
    p = parent.select(F.col(parent_key).alias("_pk"), *[F.col(f).alias(f"_p_{f}") for f in fields])
    rows = child.join(p, F.col(key) == F.col("_pk"), "left")
    bad = F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_p_{f}")), F.lit(f)) for f in fields]))
    return rows.withColumn("broken_fields", F.when(F.col("_pk").isNull(), F.array(F.lit("parent"))).otherwise(bad)).where("size(broken_fields) > 0").drop("_pk", *[f"_p_{f}" for f in fields])
