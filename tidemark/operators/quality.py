"""Profiles, rules, funnels, quarantine and bounded examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.predicates import count_true, sure
from ..functions.scalar import ratio


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n_rows, and for each column its nulls and its distinct values, null being one."""
    return df.agg(
        F.count("*").alias("n_rows"),
        *[count_true(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
        *[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(f"{c}_distinct") for c in columns],
    )


def quarantine(df: DataFrame, issues: dict[str, Column], column: str = "issues") -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) by named issues; a quarantined row lists all of its own. Each reads df once."""
    found = F.filter(F.array(*[F.when(sure(p), F.lit(name)) for name, p in issues.items()]), lambda x: x.isNotNull())
    rows = df.withColumn(column, found)
    return rows.where(F.size(column) == 0).drop(column), rows.where(F.size(column) > 0)


def issue_counts(df: DataFrame, issues: dict[str, Column]) -> DataFrame:
    """(issue, n_rows) of each named issue, in one pass."""
    row = df.agg(*[count_true(p).alias(k) for k, p in issues.items()])
    return row.unpivot([], list(issues), "issue", "n_rows")


def row_funnel(df: DataFrame, keys: list[str], values: list[str], bad: Column) -> DataFrame:
    """Accounts for every row: input = accepted + exact duplicate excess + quarantined; balanced says if it does.

    A bad row is quarantined; of good rows equal in key and values all but one are excess.
    """
    groups = df.groupBy(*keys, *values, sure(bad).alias("_bad")).agg(F.count("*").alias("_n"))
    out = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("input_rows"), F.count_if(~F.col("_bad")).alias("accepted_rows"),
        F.coalesce(F.sum(F.when(~F.col("_bad"), F.col("_n") - 1)), F.lit(0)).alias("duplicate_rows"), F.coalesce(F.sum(F.when(F.col("_bad"), F.col("_n"))), F.lit(0)).alias("quarantined_rows"),
    )
    return out.withColumn("balanced", F.col("input_rows") == F.col("accepted_rows") + F.col("duplicate_rows") + F.col("quarantined_rows"))


OPERATORS = {"<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "==": lambda a, b: a == b, "<": lambda a, b: a < b, ">": lambda a, b: a > b}


def qa_results(metrics: DataFrame, rules: list[dict]) -> DataFrame:
    """(rule, numerator, denominator, rate, status) of rules over a one-row table of counts.

    A rule: name, numerator, denominator (a column or None), on ("numerator" or "rate"), op, limit, on_failure
    ("failed" or "warning"). A rate without a denominator to divide by takes the failure status.
    """
    parts = []
    for r in rules:
        top = F.col(r["numerator"]).cast("long")
        bottom = F.col(r["denominator"]).cast("long") if r.get("denominator") else F.lit(None).cast("long")
        rate = ratio(top, bottom)
        value = rate if r.get("on", "numerator") == "rate" else top.cast("double")
        status = F.when(sure(OPERATORS[r["op"]](value, F.lit(float(r["limit"])))), "passed").otherwise(r.get("on_failure", "failed"))
        parts.append(F.struct(F.lit(r["name"]).alias("rule"), top.alias("numerator"), bottom.alias("denominator"), rate.alias("rate"), status.alias("status")))
    return metrics.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


SEVERITY = {"failed": 4, "different": 3, "matched": 2, "passed": 1, "not_run": 0}


def combined_status(df: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    """The worst status of each group: failed, different, matched, passed, not_run."""
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])[F.col(status)], F.lit(0))
    worst = F.create_map(*[F.lit(x) for k, v in SEVERITY.items() for x in (v, k)])
    return df.groupBy(*by).agg(F.max(rank).alias("_worst")).withColumn("gate", worst[F.col("_worst")]).drop("_worst")


def bounded_examples(df: DataFrame, reason: str, keys: list[str], per_reason: int = 10, overall: int | None = None) -> DataFrame:
    """The first keys of each reason in key order, and of these the first `overall`; both limits are the feature.

    Spark keeps a bounded heap for each reason before it shuffles, so a frequent reason does not fill a task.
    """
    rank = F.row_number().over(W.partitionBy(reason).orderBy(*keys))
    rows = df.select(reason, *keys).withColumn("example", rank).where(F.col("example") <= per_reason)
    return rows if overall is None else rows.orderBy(reason, "example").limit(overall)


def distribution(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Exact least, median and largest of a value."""
    return df.groupBy(*by).agg(F.min(value).alias("least"), F.median(value).alias("median"), F.max(value).alias("most"))


def cross_tab(df: DataFrame, rows: str, column: Column | str, values: list) -> DataFrame:
    """Counts of rows by column value, one column each; 0 where there is none."""
    c = F.col(column) if isinstance(column, str) else column
    return df.groupBy(rows).agg(*[count_true(c == v).alias(f"n_{v}".lower()) for v in values], F.count("*").alias("n_rows"))


def top_k(df: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k most frequent combinations, ties by value; the limit is the feature."""
    return df.groupBy(*by).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), *by).limit(k)


def cardinality_guard(df: DataFrame, key: list[str], most: int) -> DataFrame:
    """df, or an error when it has more than `most` distinct keys: fails closed before anything is built on it."""
    n = df.select(*key).distinct().limit(most + 1).count()
    if n > most:
        raise ValueError(f"more than {most} distinct {key}")
    return df
