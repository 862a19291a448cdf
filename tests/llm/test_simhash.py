import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import simhash

from .conftest import EDGES


def plain_fingerprint(text):
    ws = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        ws = ws.replace(c, " ")
    ws = [w for w in ws.split(" ") if w]
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows):
    """rows of (doc_id, fp) -> id -> least reachable id."""
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: least[top(i)] for i, (d, _) in enumerate(rows)}


def test_fingerprint_and_components_as_brute_force(spark, small):
    df, rows = small
    want = [(i, plain_fingerprint(t)) for i, t in rows]
    got = {r["doc_id"]: r for r in simhash.simhash_components(df).collect()}
    assert {i: r["fp"] & (2**64 - 1) for i, r in got.items()} == dict(want)
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(want)


def test_edges(spark, docs_of):
    df = docs_of([*EDGES, (None, "lonely words here")])
    got = simhash.simhash_components(df).collect()
    assert len(got) == len(EDGES) + 1
    by = {r["doc_id"]: r for r in got}
    assert by[0]["component_id"] == by[1]["component_id"] == by[2]["component_id"] == 0
    assert by[6]["component_id"] == 5 and by[None]["component_id"] is None
    for i, t in enumerate(EDGES):
        assert by[i]["fp"] & (2**64 - 1) == plain_fingerprint(t)
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_keep_one(spark, docs_of):
    df = docs_of(["a b c d", "a b c d", (1, "a b c d"), (9, None), (None, "q"), (7, "z y x w")])
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in simhash.keep_one(df).collect())
    assert got == [(False, 0), (False, 7), (False, 9), (True, 0)]
    assert simhash.keep_one(df).columns == df.columns


def test_large_key_in_blocks(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**62)
    fps = {int(base) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (150, 2))} | {int(x) for x in rng.integers(0, 2**62, 50)}
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for block in (8, 4096):
        edges = [(r["a"], r["b"]) for r in simhash.near_pairs(df, 2, block).collect()]
        order = sorted(fps)
        assert all((a ^ b).bit_count() <= 2 for a, b in edges)
        want = plain_components([(x, x) for x in order])
        root = {x: x for x in order}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            p, q = sorted((top(a), top(b)))
            root[q] = p
        assert {x: top(x) for x in order} == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=2, max_size=40), st.integers(0, 2))
def test_lanes(values, radius):
    fps = np.array(values, np.uint64)
    planes = simhash.planes_of(fps)
    for shift in range(1, len(values)):
        valid = (1 << len(values) - shift) - 1
        got = simhash.linked_lanes(planes, shift, valid, radius)
        want = sum(1 << i for i in range(len(values) - shift) if (values[i] ^ values[i + shift]).bit_count() <= radius)
        assert got == want


def test_components_as_union_find(spark):
    """Chains, stars and repeated edges, contracted in one task and by star joins."""
    from tidemark.llm.components import star_components

    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(-300, 300, (260, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5090)] + [(7, 7), (9, 8), (8, 9)]
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = sorted((top(a), top(b)))
        root[q] = p
    want = {x: top(x) for x in root if any(a != b and x in (a, b) for a, b in edges)}
    for task in (1 << 20, 16):
        got = star_components(spark.createDataFrame(edges, "a long, b long").repartition(5), task=task).collect()
        assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)


def test_keep_one_beside_clashing_names(spark, docs_of, monkeypatch):
    df = docs_of(["a b c d", "a b c d", (1, "a b c d"), (0, "a b c d"), (9, None)])
    for c in ("_digest", "_head", "_rank", "_id", "_ID_"):
        df = df.withColumn(c, df["count"])
    for few in (simhash.FEW, 0):
        monkeypatch.setattr(simhash, "FEW", few)
        got = simhash.keep_one(df)
        assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [0, 9]
