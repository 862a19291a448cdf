import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding

from .conftest import EDGES


def check(df, rows, shards=24):
    """What holds for every table; the rows of the result."""
    got = sharding.shard_documents(df, shards).collect()
    assert len(got) == len(rows)
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in got) == want
    at = {}
    for r in got:
        at.setdefault(r["text_crc32"], set()).add(r["shard"])
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(len(x) == 1 for x in at.values())
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    return got


def test_near_equal_bytes(small):
    df, rows = small
    got = check(df, rows)
    load = [sum(r["size"] for r in got if r["shard"] == s) for s in range(24)]
    group = {}
    for r in got:
        group[r["text_crc32"]] = group.get(r["text_crc32"], 0) + r["size"]
    # the scheduling rule's bound: the fullest shard is at most 4/3 of the mean or of the largest group
    assert max(load) <= max(4 / 3 * sum(load) / 24, max(group.values()))


@pytest.mark.parametrize("shards", [1, 2, 5, 24])
def test_pieces_equal_plain_lpt(shards):
    """The schedule by size classes gives each item the shard that plain scheduling gives it, giants and ties included."""
    for seed in range(60):
        r = random.Random(seed)
        sizes = [(r.choice([1, 2, 3, 7, 100, 1000, r.randint(1, 2000)]), i) for i in range(r.choice([0, 1, 5, 60, 400]))]
        sizes += [(50_000, 1000 + i) for i in range(r.randint(0, 4) if seed % 3 == 0 else 0)]
        want, found = sharding.lpt(sizes, shards), sharding.pieces(list(Counter(s for s, _ in sizes).items()), shards)
        for size in {s for s, _ in sizes}:
            for k, i in enumerate(sorted(i for s, i in sizes if s == size)):
                first, turn = max((f, t) for s, f, t in found if s == size and f <= k)
                assert turn[(k - first) % len(turn)] == want[i]


@pytest.mark.parametrize("run, few, shares", [(50_000, 100_000, 4096), (3, 0, 4)])
def test_table_equals_plain_lpt(small, monkeypatch, run, few, shares):
    """Every group of the table, light ones too, is where the plain heap puts it; also with small runs and without broadcasts."""
    for name, value in (("RUN", run), ("FEW", few), ("SHARES", shares)):
        monkeypatch.setattr(sharding, name, value)
    df, rows = small
    size, digest = Counter(), {}
    for i, t in rows:
        digest[i] = hashlib.sha256((t or "").encode()).digest()
        size[digest[i]] += len((t or "").encode()) + 8
    want = sharding.lpt([(n, g) for g, n in size.items()], 24)
    assert {r["doc_id"]: r["shard"] for r in check(df, rows)} == {i: want[digest[i]] for i, _ in rows}


def test_slots_follow_key_and_copies(docs_of):
    """Slots do not depend on the partitioning, follow the key, and second copies of rows come after all first ones."""
    df = docs_of([(i % 40, f"t{i % 40}") for i in range(70)])
    key = F.col("doc_id").cast("long") * (1 << 50)
    got = [sorted(map(tuple, sharding.shard_documents(x, 3, key).collect())) for x in (df, df.repartition(7))]
    assert got[0] == got[1]
    for s in range(3):
        ids = [r[0] for r in sorted((r for r in got[0] if r[4] == s), key=lambda r: r[5])]
        firsts = sorted(set(ids))
        assert ids == firsts + [i for i in firsts if i < 30]


def test_edges(docs_of):
    texts = [*EDGES, (None, "a"), (None, "a"), (3, "one"), (3, "one")]
    df = docs_of(texts)
    check(df, [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)])
    assert sharding.shard_documents(df.limit(0)).count() == 0
