import random

import numpy as np
import pytest

from basketry.llm import jaccard, linkage
from basketry.llm.rtree import PackedRTree, needed

from .helpers import AWKWARD, CLASHING, frame, texts


def brute(rows, k, percent):
    """doc index -> (set size, least linked index) by comparing all pairs."""
    sets = []
    for t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def corpus(seed):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") * r.randint(1, 3)
    out = []
    for _ in range(12):
        base = [word() + str(r.randint(0, 30)) for _ in range(r.choice([1, 2, 3, 8, 40, 120]))]
        for _ in range(r.randint(1, 7)):
            t = list(base)
            for _ in range(r.randint(0, 3)):
                t[r.randrange(len(t))] = word()
            out.append(" ".join(t))
        passage = " ".join(word() for _ in range(4))
        out += [f"{passage} {word()}{i} {word()}" for i in range(4)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("k, percent, seed", [(3, 90, 1), (5, 80, 2), (2, 60, 3)])
def test_groups_equal_brute_force(spark, k, percent, seed):
    rows = corpus(seed) + [None, "", "  "]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard.similar_groups(texts(spark, rows), k, percent).collect()}
    assert [got[i] for i in range(len(rows))] == brute(rows, k, percent)


def test_chunks_of_a_large_key(spark, monkeypatch):
    monkeypatch.setattr(linkage, "CHUNK", 3)
    monkeypatch.setattr(linkage, "SMALL", 2)
    rows = corpus(5)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(texts(spark, rows), 2, 50).collect()}
    assert [got[i] for i in range(len(rows))] == [c for _, c in brute(rows, 2, 50)]


def test_chain_is_one_group(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [" ".join(words[5 * i:5 * i + 100]) for i in range(12)]
    got = jaccard.similar_groups(texts(spark, rows), 3, 90).collect()
    assert {r["component_id"] for r in got} == {0}


def test_awkward_rows(spark):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"])
           for r in jaccard.similar_groups(frame(spark, AWKWARD), 3, 90).collect()}
    assert {(1, 0, 1), (2, 0, 2), (6, 0, 6), (7, 1, 7), (4, 9, 4), (9, 1, 9)} <= got
    assert any(d is None and c is None for d, _, c in got)


def test_keep_one_keeps_columns_and_one_row(spark):
    docs = frame(spark, AWKWARD, CLASHING)
    kept = jaccard.keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] or 0) for r in kept.collect())
    assert ids == [0, 1, 2, 4, 6, 7, 8, 9]


def test_empty(spark):
    assert jaccard.similar_groups(frame(spark, []), 3, 90).count() == 0
    assert jaccard.keep_one(frame(spark, [])).count() == 0


def test_tree_finds_what_the_bound_allows():
    r = np.random.default_rng(0)
    pts = r.poisson(2, (300, jaccard.GROUPS)).astype(np.int32)
    pts[:100] = pts[0] + (r.random((100, jaccard.GROUPS)) < 0.05)
    tree = PackedRTree(pts)
    for i in range(0, 300, 7):
        bound = np.minimum(pts, pts[i]).sum(axis=1)
        n = pts.sum(axis=1)
        want = np.flatnonzero((bound >= needed(n, n[i], 80)) & (100 * n >= 80 * n[i]) & (100 * n[i] >= 80 * n))
        got = np.sort(tree.search(pts[i], 80))
        assert set(want) <= set(got) and len(got) < 200


def test_sketches_never_refuse_a_link():
    r = np.random.default_rng(5)
    sets = []
    for n in (1, 2, 9, 10, 63, 64, 65, 130, 700, 9000):
        base = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        for drop in (0, 1, n // 12, n // 8, n // 4):
            more = r.integers(0, 2**63, drop).astype(np.uint64)
            sets.append(np.unique(np.concatenate([base[drop:], more])))
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    x = jaccard.Sketches(jaccard.sketches(np.concatenate(sets), first))
    refused = 0
    for i in range(len(sets)):
        j = np.arange(len(sets))
        keep = jaccard.may_link(x, np.full(len(j), i), x, j, 80)
        for k in j.tolist():
            same = len(np.intersect1d(sets[i], sets[k]))
            if 100 * same >= 80 * (len(sets[i]) + len(sets[k]) - same) and len(sets[i]):
                assert keep[k]
            else:
                refused += not keep[k]
    assert refused > 1500
