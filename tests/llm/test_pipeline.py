import zlib
from collections import Counter

import corpus_pipeline
from tidemark.llm import decontam, toxicity

from .test_shingles import plain_heads

SF = "/root/testdata/sf0.001"


def test_stages_as_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    (_, toxic), (_, near), (_, leaks), (_, mixed), (_, shards) = corpus_pipeline.STAGES
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = toxic(spark, docs, SF)
    texts, y = toxicity.collect_sample(toxicity.labelled_sample(docs, labels, "toxic", 6000))
    model = toxicity.fit(texts, y)
    all_rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = dict(zip(all_rows, toxicity.score_lists(list(all_rows.values()), *model)))
    one = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == columns and one == {i for i, s in scores.items() if s < 0.5}
    distinct = near(spark, kept, SF)
    two = {r["doc_id"] for r in distinct.collect()}
    heads = plain_heads([(i, all_rows[i]) for i in sorted(one)])
    assert distinct.columns == columns and two == set(heads.values())
    clean = leaks(spark, distinct, SF)
    items = [decontam.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i in two for h in [decontam.normal(all_rows[i])] for a in items if len(a) >= 5 and sum(x[2] for x in decontam.tiles(a, h)) >= 0.8 * len(a)}
    three = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == columns and three == two - leaked
    mix = mixed(spark, clean, SF)
    four = Counter(r["doc_id"] for r in mix.collect())
    assert mix.columns == columns and set(four) == three and max(four.values()) <= 2
    out = shards(spark, mix, SF).collect()
    assert Counter(r["doc_id"] for r in out) == four
    assert all(r["text_crc32"] == zlib.crc32(all_rows[r["doc_id"]].encode()) for r in out)


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
