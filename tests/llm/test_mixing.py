import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.oracle import connection, spark_rows, sql_rows
from tidemark.llm import mixing, queries

from .conftest import EDGES


def sources(spark, counts):
    return spark.createDataFrame([(k, 1, n) for k, n in counts.items()], "source string, n_rows long, n_words long")


@pytest.mark.parametrize("limit", [1.0, 1.5, 4.0, 1e9])
def test_repetition_limit(spark, limit):
    counts = {"a": 9000, "b": 1000, "c": 10, "none": 0}
    a = mixing.find_exponent(sources(spark, counts), repetition_limit=limit)
    got = {r["source"]: r for r in mixing.weights(sources(spark, counts), a).collect()}
    assert abs(sum(r["weight"] for r in got.values()) - 1) < 1e-9 and got["none"]["weight"] == 0
    epochs = {k: r["epochs"] for k, r in got.items()}
    assert epochs["a"] == 1 and max(epochs.values()) <= limit * 1.06 and (limit > 900 or epochs["c"] >= limit * 0.94)


@pytest.mark.parametrize("share", [0.0, 0.3, 0.9])
def test_target_entropy(spark, share):
    counts = {"a": 9000, "b": 1000, "c": 10}
    p = [n / 10010 for n in counts.values()]
    least = -sum(x * math.log2(x) for x in p)
    target = least + share * (math.log2(3) - least)
    a = mixing.find_exponent(sources(spark, counts), target_entropy=target)
    z = sum(x**a for x in p)
    assert abs(-sum(x**a / z * math.log2(x**a / z) for x in p) - target) < 1e-4


def plain_schedule(rows, plan, seed, block):
    """rows: (key, doc_id, source, words) of one table; plan: source -> (budget, total, blocks). -> Counter of passes."""
    import hashlib

    out = Counter()
    for s, (budget, total, blocks) in plan.items():
        mine = [r for r in rows if r[2] == s]
        turn = sorted({r[0] % blocks for r in mine}, key=lambda b: hashlib.md5(f"{seed}|block|{b}".encode()).hexdigest())
        left = budget % total if total else 0
        whole = budget // total if total else 1
        for b in turn:
            for r in sorted((r for r in mine if r[0] % blocks == b), key=lambda r: (r[0], r[1])):
                out[r[1]] += whole + (1 if left > 0 else 0)
                left -= r[3]
    return {k: v for k, v in out.items() if v}


def test_budgets_as_brute_force(spark, small):
    df, _ = small
    for budget in (None, 40_000.0):
        got = mixing.schedule(df, exponent=0.3, budget=budget, block=4).collect()
        keyed = df.select(mixing.keyed(17, "doc_id", "text").alias("k"), "doc_id", "source", mixing.n_words().alias("w"))
        rows = [tuple(r) for r in keyed.collect()]
        totals = mixing.source_totals(keyed.withColumnRenamed("w", "n_words"))
        plan = {r["source"]: (r["budget_words"], r["n_words"], max(1, math.ceil(r["n_rows"] / 4))) for r in mixing.weights(totals, 0.3, budget).collect()}
        want = plain_schedule(rows, plan, 17, 4)
        assert dict(Counter(r["doc_id"] for r in got)) == want
        words = {r[1]: r[3] for r in rows}
        for s, (b, total, _) in plan.items():
            spent = sum(words[r["doc_id"]] for r in got if r["source"] == s)
            assert b <= spent <= b + max(w for _, i, src, w in rows if src == s)
        if budget is None:
            assert set(want) == {r[1] for r in rows}  # no source is cut short
        assert got[0].asDict().keys() >= set(df.columns)


def test_query_equals_its_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        d = f"/root/testdata/{sf}"
        assert spark_rows(queries.op2_mixing(spark, d)) == sql_rows(connection(d), queries.OP2_SQL)


def test_edges(docs_of):
    df = docs_of([*EDGES, (None, "a b"), (1, ""), (1, "")]).withColumn("source", F.when(F.col("doc_id") % 2 == 0, F.col("source")))
    got = mixing.schedule(df).collect()
    first = Counter((r["doc_id"], r["text"]) for r in got if r["_epoch"] == 0)
    assert first == Counter((r["doc_id"], r["text"]) for r in df.collect())
    assert mixing.schedule(df.limit(0)).count() == 0


def test_clashing_names(docs_of):
    """Columns of docs named like those worked with or added stay as they are."""
    df = docs_of(["a b", "c d e", "f"])
    for c in ("_words", "_key", "_source", "_epoch", "_spent", "c0", "_Block"):
        df = df.withColumn(c, F.lit(f"mine {c}"))
    got = mixing.schedule(df)
    assert got.columns == [*df.columns, "_epoch_", "_block_", "_place", "_weight", "_words_"]
    assert {r["_words"] for r in got.collect()} == {"mine _words"} and {r["_words_"] for r in got.collect()} == {1, 2, 3}
