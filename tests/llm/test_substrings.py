import hashlib
import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import sieve, substrings

from .conftest import EDGES, documents


def plain(rows, width=13):
    seqs = [(i, [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t or "").split(" ") if w]) for i, t in rows]
    first = {}
    for i, ws in seqs:
        if i is not None:
            for k in range(len(ws) - width + 1):
                key = tuple(ws[k : k + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, ws in seqs:
        gone = set()
        if i is not None:
            for k in range(len(ws) - width + 1):
                if first[tuple(ws[k : k + width])] < i:
                    gone.update(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((-1 if i is None else i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def run(df, bits=None):
    rows = substrings.without_repeats(df, 13, bits).collect()
    return sorted((-1 if r[0] is None else r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in rows)


def test_as_brute_force(small):
    df, rows = small
    assert run(df) == plain(rows)
    assert sorted(map(tuple, substrings.removal_digest(df).collect())) == plain(rows)


def test_edges_ties_and_repeats(spark, docs_of):
    texts = [*EDGES, (3, "p q r s t u v w x y z a b c d"), (3, "p q r s t u v w x y z a b c d"), (None, EDGES[5]), (2, "zz " + EDGES[5])]
    df = docs_of(texts)
    assert run(df) == plain([t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)])
    assert run(df.limit(0)) == []


def pieces_of_pieces(seed):
    r = random.Random(seed)
    pieces = [[r.choice("abc de fgh ij k".split()) for _ in range(r.randint(5, 60))] for _ in range(12)]
    return [(i, " ".join(w for _ in range(r.randint(0, 4)) for w in r.choice(pieces))) for i in range(120)]


def test_many_batches_ranges_and_groups(spark, monkeypatch):
    for name, value in (("SUBTREE", 50), ("BATCH", 200)):
        monkeypatch.setattr(substrings, name, value)
    monkeypatch.setattr(sieve, "RANGE", 300)
    rows = pieces_of_pieces(4)
    assert run(documents(spark, rows).repartition(7)) == plain(rows)


def test_words_decide_and_not_hashes(spark, small, monkeypatch):
    """With windows hashed to 8 bits nearly all suffixes pass the sieve; the trees give the same result."""
    monkeypatch.setattr(substrings, "BATCH", 2000)
    monkeypatch.setattr(substrings, "SUBTREE", 5000)
    rows = pieces_of_pieces(5)
    assert run(documents(spark, rows), 8) == plain(rows)
    df, rows = small
    assert run(df, 8) == plain(rows)


def test_tree_is_a_suffix_array():
    r = random.Random(6)
    stretches = [" ".join(r.choice(["a", "ab", "b", "a-"]) for _ in range(r.randint(4, 9))).encode() for _ in range(300)]
    tree = substrings.Tree(stretches, 4)
    suffixes = [s.split()[k : k + 4] for s in stretches for k in range(len(s.split()) - 3)]
    ids = np.array([r.randint(0, 9) for _ in suffixes])
    order, node = tree.nodes(ids)
    assert [stretches[o].split()[p : p + 4] for o, p in zip(tree.of, tree.place)] == suffixes
    got = [(suffixes[k], ids[k]) for k in order]
    assert got == sorted(got)
    assert [x[0] == y[0] for x, y in zip(got, got[1:])] == (np.diff(node) == 0).tolist() and node[-1] == len(set(map(tuple, suffixes))) - 1


@given(st.sets(st.integers(0, 2**50), min_size=1, max_size=60), st.integers(1, 9))
def test_messages_give_keys_back(values, ranges):
    keys = np.array(sorted(values), np.uint64)
    of, begin = sieve.ranges_of(keys, ranges, 51)
    back = [sieve.unpacked(memoryview(sieve.packed(keys[a:b]))) for a, b in zip(begin, begin[1:])]
    assert np.concatenate(back).tolist() == keys.tolist() and of.max() < ranges and (np.diff(of) > 0).all()


@given(st.lists(st.one_of(st.none(), st.text("ab é\x1f\t\n\r\x0b\x0c\x85", max_size=30)), max_size=12))
def test_words_as_split(texts):
    w = substrings.Words([substrings.canon(t) for t in texts])
    want = [(k, x) for k, t in enumerate(texts) for x in (t or "").encode().split()]
    assert [(int(d), w.raw[a:b]) for d, a, b in zip(w.doc, w.begin, w.end)] == want
    by = {}
    assert all(by.setdefault(x, h) == h for (_, x), h in zip(want, w.hash.tolist())) and len(set(by.values())) == len(by)
