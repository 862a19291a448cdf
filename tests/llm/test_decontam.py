import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import decontam

from .conftest import EDGES, documents


def plain_tiles(a, b, least):
    """Greedy string tiling by comparing every pair of places."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (least - 1, None)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, (i, j))
        if best[1] is None:
            return out
        n, (i, j) = best
        free_a[i : i + n] = free_b[j : j + n] = [False] * n
        out.append((i, j, n))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=3, max_size=24), st.lists(st.integers(0, 3), min_size=3, max_size=30))
def test_tiles(a, b):
    got = decontam.tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3, 6)
    for i, j, n in got:
        assert a[i : i + n] == b[j : j + n] and n >= 3
    assert sum(n for *_, n in got) == len({k for i, _, n in got for k in range(i, i + n)}) == len({k for _, j, n in got for k in range(j, j + n)})
    left_a = [x for k, x in enumerate(a)]
    for i, _, n in got:
        left_a[i : i + n] = [f"a{i}"] * n
    left_b = list(b)
    for _, j, n in got:
        left_b[j : j + n] = [f"b{j}"] * n
    assert not plain_tiles(left_a, left_b, 3)  # nothing that could be marked is left
    want = plain_tiles(a, b, 3)
    assert max((n for *_, n in got), default=0) == max((n for *_, n in want), default=0)


def test_planted_reordered_and_clean(spark):
    r = random.Random(2)
    vocabulary = [f"w{k}" for k in range(400)]
    prose = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(k, prose(30)) for k in range(8)]
    texts = []
    for k, w in items:
        texts.append((10 * k, " ".join(prose(50) + w + prose(20))))  # whole
        texts.append((10 * k + 1, " ".join(prose(9) + w[18:] + prose(5) + w[:18] + prose(400))))  # reordered
        texts.append((10 * k + 2, " ".join(prose(9) + w[:15] + prose(30))))  # half
        texts.append((10 * k + 3, ", ".join(prose(3) + w).upper()))  # other case and punctuation
    df = documents(spark, texts)
    bench = spark.createDataFrame([(k, " ".join(w), 1) for k, w in items] + [(90, None, 1), (91, "", 1), (92, "w1 w2", 1), (None, "w1 w2 w3 w4 w5", 1)], "item_id long, text string, count long")
    for most in (decontam.ITEM_BYTES, 100):
        got = decontam.contaminated(df, bench, 0.8, most).collect()
        assert sorted((x["doc_id"], x["item_id"]) for x in got) == sorted((10 * k + d, k) for k in range(8) for d in (0, 1, 3))
        assert all(x["coverage"] == 1.0 for x in got)
    kept = decontam.without_leaks(df, bench, 0.8, 100)
    assert kept.columns == df.columns and sorted(x["doc_id"] for x in kept.collect()) == [10 * k + 2 for k in range(8)]


def test_edges(spark, docs_of):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    df = docs_of([*EDGES, (None, "a b c d e f")])
    assert sorted((x["doc_id"] or -1) for x in decontam.contaminated(df, bench).collect()) == [-1, 5, 6]
    assert decontam.contaminated(df, bench.limit(0)).count() == 0 and decontam.contaminated(df.limit(0), bench).count() == 0


def test_all_pairs_on_small_tables(spark, small):
    df, rows = small
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r["item_id"], decontam.normal(r["text"])) for r in bench.collect()]
    want = set()
    for d, t in rows:
        h = decontam.normal(t)
        for i, a in items:
            if len(a) >= 5 and len(set(a.tolist()) & set(h.tolist())) and sum(x[2] for x in decontam.tiles(a, h)) >= 0.8 * len(a):
                want.add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(df, bench).collect()}
    assert got == want and want


def test_items_that_share_an_opening():
    """20,000 items with one opening: texts that begin like them call for none, and matches are as by brute force."""
    import time

    r = random.Random(8)
    word = lambda: f"w{r.randint(0, 10**6)}"
    items = [(k, "one two three four five " + " ".join(word() for _ in range(20))) for k in range(20_000)]
    index = decontam.Index(items, 0.8)
    texts = ["one two three four five " + word() for _ in range(20)] + [items[7][1], " ".join(items[9][1].split()[4:]), " ".join(items[11][1].split()[7:])]
    began = time.perf_counter()
    found = index.search([decontam.normal(t) for t in texts])
    assert time.perf_counter() - began < 1
    assert [[x[0] for x in f] for f in found] == [[]] * 20 + [[7], [9], []]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=0, max_size=14), max_size=6), st.lists(st.lists(st.integers(0, 3), max_size=25), max_size=4), st.sampled_from([0.5, 0.8, 1.0]))
def test_search_as_all_pairs(items, texts, threshold):
    items = [(k, " ".join(f"v{x}" for x in w)) for k, w in enumerate(items)]
    hs = [decontam.normal(" ".join(f"v{x}" for x in w)) for w in texts]
    got = decontam.Index(items, threshold).search(hs)
    for h, found in zip(hs, got):
        seeds = {tuple(h[k : k + 5]) for k in range(len(h) - 4)}
        for k, t in items:
            a = decontam.normal(t)
            hit = [x for x in found if x[0] == k]
            possible = {p + q for p in range(len(a) - 4) if tuple(a[p : p + 5]) in seeds for q in range(5)}
            if len(a) < 5 or len(possible) < threshold * len(a):
                assert not hit
            else:
                words = sum(x[2] for x in decontam.tiles(a, h))
                assert not hit or hit[0][2] >= threshold * len(a)
                assert hit or words < threshold * len(a)
