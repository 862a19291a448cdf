import itertools

import pytest

import corpus_pipeline
from tidemark.llm import shingles

from .conftest import EDGES


def plain_set(text):
    ws = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        ws = ws.replace(c, " ")
    ws = [w for w in ws.split(" ") if w]
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def plain_heads(rows):
    """rows of (doc_id, text) -> least id of each component over brute-force Jaccard of 0.8 or more."""
    sets, root = {i: plain_set(t) for i, t in rows}, {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        x, y = sets[i], sets[j]
        if x == y or 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return {i: top(i) for i in root}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_stage_as_brute_force(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    want = plain_heads([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = corpus_pipeline.near_duplicates(spark, docs, f"/root/testdata/{sf}")
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == sorted(set(want.values()))


def test_groups_and_chains(spark, docs_of, monkeypatch):
    """A large group of near copies, a chain whose ends differ, pairs at the very limit, short and empty texts."""
    base = [f"w{i}" for i in range(60)]
    group = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]) for k in (0, 1, 58, 59)] + [" ".join([*base, f"y{k}"]) for k in range(30)]
    chain = [" ".join(f"c{i}" for i in range(k, k + 60)) for k in range(0, 40, 5)]
    limit = [" ".join(f"l{i}" for i in range(k)) for k in (44, 54, 55)]  # 40, 50 and 51 shingles: 0.8 and just below
    rows = list(enumerate([*EDGES, *group, *chain, *limit]))
    want = plain_heads(rows)
    for frequent, block, batch in ((1 << 18, 4096, 250_000), (0, 4096, 50), (1 << 18, 8, 250_000)):  # another order of grams, small batches, keys beyond a block: the same result
        monkeypatch.setattr(shingles, "FREQUENT", frequent)
        monkeypatch.setattr(shingles, "BATCH", batch)
        got = {r["doc_id"]: r["component_id"] for r in shingles.shingle_components(docs_of([t for _, t in rows]), block).collect()}
        assert got == want
    assert len(set(want[i] for i in range(len(EDGES), len(EDGES) + len(group)))) == 1
    assert shingles.keep_one(docs_of([(None, "q"), (None, "q"), (3, "q"), (4, "Q")])).count() == 3


def test_giant_root_is_not_compared_with_itself(spark):
    """A token of 40 rows of one root and 5 others in units of 8: each giant unit meets the others alone, and every pair across is in a group."""
    from itertools import combinations

    rows = [(1, 7 if k < 40 else 100 + k, k) for k in range(45)] + [(2, k, k) for k in range(3)]
    got = shingles.in_blocks(spark.createDataFrame(rows, "token long, root long, node long"), 8).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["grp"], []).append((r["token"], r["root"], r["node"], r["side"]))
    met = {(x[0], *sorted((x[2], y[2]))) for g in groups.values() for x, y in combinations(g, 2) if x[1] != y[1] and (x[3] == 0 or x[3] != y[3])}
    assert met == {(t, *sorted((a, b))) for t, r, a in rows for u, s, b in rows if t == u and r != s}
    assert len(got) <= 40 + 5 * 6 + 3 and max(map(len, groups.values())) <= 32


def test_fingerprints_of_near_sets():
    """Pairs at the limit differ in far fewer bits than the radius, unrelated sets in far more."""
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (4, 40, 400):
        near, far = [], []
        for _ in range(200):
            x = np.unique(rng.integers(0, 2**63, 2 * n).astype(np.uint64))
            a, b = x[:n], np.concatenate([x[n // 5 if n > 4 else 0 : n], x[n : n + 1]])
            near.append(sum(int(u ^ v).bit_count() for u, v in zip(shingles.wide(a).view(np.uint64), shingles.wide(b).view(np.uint64))))
            far.append(sum(int(u ^ v).bit_count() for u, v in zip(shingles.wide(a).view(np.uint64), shingles.wide(x[n:]).view(np.uint64))))
        assert max(near) <= shingles.RADIUS and (n == 4 or min(far) > shingles.RADIUS)
