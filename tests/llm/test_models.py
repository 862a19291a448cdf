import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import common, quality, toxicity

from .conftest import EDGES

SF = "/root/testdata/sf0.1"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_held_out(spark):
    docs, labels = tables(spark)
    got = toxicity.toxicity(docs, labels)
    rows = got.join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    hit = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(hit) >= 0.8 * len(hit) and sum(clean) <= 0.01 * len(clean)
    assert got.count() == docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0


def test_quality_held_out(spark):
    docs, labels = tables(spark)
    got = quality.quality(docs, labels)
    rows = got.join(labels.select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    assert sum((r["predicted"] == r["quality"]) for r in rows) >= 0.97 * len(rows)
    assert got.where("predicted <> cast(score >= 0.7 as int)").count() == 0


def test_edges(spark, docs_of):
    texts = [*EDGES, (None, "idiot"), (2, "idiot you"), *[(100 + i, "you are an idiot today") for i in range(30)], *[(200 + i, "what a lovely day it is") for i in range(30)]]
    df = docs_of(texts)
    labels = spark.createDataFrame([(100 + i, 0, 1, 1) for i in range(30)] + [(200 + i, 1, 0, 1) for i in range(30)] + [(None, 1, 1, 1), (3, None, None, 1)], "doc_id long, quality int, toxic int, count long")
    for found in (toxicity.toxicity(df, labels), quality.quality(df, labels)):
        rows = found.collect()
        assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (0, 1)}) == 1
    none = labels.limit(0)
    assert toxicity.toxicity(df, none).where("score between 0 and 1").count() == len(texts)
    assert quality.quality(df, none).count() == len(texts) and quality.quality(df.limit(0), none).count() == 0
    kept = toxicity.without_toxic(df, labels)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} >= {200 + i for i in range(30)} and not {r["doc_id"] for r in kept.where("doc_id between 100 and 130").collect()}
    assert found.select(F.max("predicted")).first()[0] in (0, 1)


def test_ftrl_step_as_loop():
    """Each coordinate by the scalar formulas, over a few documents with shared features."""
    model, z, n = toxicity.Ftrl(6, alpha=0.5, beta=1.0, l1=0.3, l2=0.2), {}, {}

    def weight(i):
        zi, l1 = z.get(i, 0.0), 0.0 if i == 64 else 0.3
        return 0.0 if abs(zi) <= l1 else (math.copysign(l1, zi) - zi) / ((1.0 + math.sqrt(n.get(i, 0.0))) / 0.5 + 0.2)

    rng = np.random.default_rng(1)
    for _ in range(200):
        features, y = np.unique(rng.integers(0, 64, 9)), int(rng.integers(0, 2))
        coordinates = [*features.tolist(), 64]
        w = {i: weight(i) for i in coordinates}
        g = 1 / (1 + math.exp(-sum(w.values()))) - y
        for i in coordinates:
            rate = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / 0.5
            z[i] = z.get(i, 0.0) + g - rate * w[i]
            n[i] = n.get(i, 0.0) + g * g
        model.learn(features, y)
    at, values, bias = model.sparse()
    assert dict(zip(at.tolist(), values.tolist())) == {i: np.float32(weight(i)) for i in range(64) if weight(i)} and abs(bias - weight(64)) < 1e-12


def test_sgd_step_as_loop():
    """Softmax over the weighted average of vectors; every derivative by its own loop."""
    rng = np.random.default_rng(2)
    vectors, out, bias = (rng.normal(size=s) for s in ((9, 3), (3, 2), 2))
    u, share, label, step = np.array([1, 4, 7]), np.array([0.5, 0.3, 0.02]), 1, 0.4
    hidden = [sum(share[k] * vectors[u[k], d] for k in range(3)) for d in range(3)]
    z = [sum(hidden[d] * out[d, c] for d in range(3)) + bias[c] for c in range(2)]
    e = [math.exp(x) for x in z]
    g = [e[c] / sum(e) - (c == label) for c in range(2)]
    back = [sum(out[d, c] * g[c] for c in range(2)) for d in range(3)]
    want_v = vectors.copy()
    for k in range(3):
        for d in range(3):
            want_v[u[k], d] -= step * min(quality.LIFT * share[k], 1.0) * back[d]
    want_o = np.array([[out[d, c] - step * hidden[d] * g[c] for c in range(2)] for d in range(3)])
    want_b = np.array([bias[c] - 0.1 * step * g[c] for c in range(2)])
    quality.learn(vectors, out, bias, u, share, label, step)
    assert np.allclose(vectors, want_v) and np.allclose(out, want_o) and np.allclose(bias, want_b)


def test_batch_scorers_as_loops(small):
    """Scores of a whole batch equal those of each text alone, summed feature by feature."""
    _, rows = small
    texts = [None, "", " ", "one", "one one two", "x" * 700, *(t for _, t in rows[:60])]
    rng = np.random.default_rng(3)
    at, w = np.sort(rng.choice(1 << 20, 300_000, False)).astype(np.int32), rng.normal(size=300_000).astype(np.float32) / 50
    table = dict(zip(at.tolist(), w.tolist()))
    want = []
    for t in texts:
        h = toxicity.tokens(t)
        found = {int(x) for x in toxicity.features(h, np.zeros(len(h), np.int8))[0]} if len(h) else set()
        want.append(1 / (1 + math.exp(-max(-35, min(35, 0.2 + sum(table.get(x, 0.0) for x in found))))))
    assert np.allclose(toxicity.score_lists(texts, at, w, 0.2), want, atol=1e-6)
    value = rng.normal(size=(1 << quality.BITS) + 2).astype(np.float32)
    want = []
    for t in texts:
        u, share = quality.bag(t)
        z = 0.1 + (sum(float(s) * float(value[x]) for x, s in zip(u.tolist(), share.tolist())) if common.words(t) else 0.0)
        want.append(1 / (1 + math.exp(-max(-35, min(35, z)))))
    assert np.allclose(quality.score_lists(texts, value, 0.1), want, atol=1e-5)


def test_sample_bounds(spark, docs_of):
    """Long and missing rows take no place; of repeated ids one text is chosen whatever the order; bounds hold."""
    texts = [(i, f"text {i} " + "x" * (i % 7)) for i in range(40)] + [(i, f"other {i}") for i in range(10)] + [(50, None), (None, "q")]
    df = docs_of(texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    some = [sorted(map(tuple, common.labelled_sample(x, labels, "toxic", 1000).collect())) for x in (df, df.orderBy(F.desc("text")).repartition(5))]
    assert some[0] == some[1] and [r[0] for r in some[0]] == list(range(40)) and all((i, t) in texts for i, t, _ in some[0]) and some[0][3][2] == 1
    assert common.labelled_sample(df, labels, "toxic", 7).count() == 7
    few = common.labelled_sample(df, labels, "toxic", 1000, 100).collect()
    assert 0 < len(few) < 40 and sum(len(r["text"]) for r in few) <= 100
