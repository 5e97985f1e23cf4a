import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import vector_links
from basketry.llm.ann import unit_rows
from basketry.llm.multi_index import fit

KIND = "vec_id long, embedding array<double>, label int"


def brute(rows, limit=0.9):
    """vec_id -> (n_links, component_id) of usable rows with distinct ids."""
    v = np.array([x for _, x, _ in rows], float)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = u @ u.T >= limit
    n = len(rows)
    label = list(range(n))
    for _ in range(n):
        new = [min(label[j] for j in np.flatnonzero(near[i])) for i in range(n)]
        if new == label:
            break
        label = new
    ids = [i for i, _, _ in rows]
    least = {}
    for i in range(n):
        least[label[i]] = min(least.get(label[i], ids[i]), ids[i])
    return {ids[i]: (int(near[i].sum()) - 1, least[label[i]]) for i in range(n)}


def clusters(seed=3, dim=8):
    """Tight and loose groups, chains, exact copies and loners."""
    r = np.random.default_rng(seed)
    out = [r.normal(size=dim) for _ in range(60)]
    for spread, size in ((0.02, 60), (0.12, 50), (0.2, 50), (0.3, 40)):
        centre = r.normal(size=dim)
        out += [centre + spread * np.linalg.norm(centre) * r.normal(size=dim) / math.sqrt(dim) for _ in range(size)]
    a, b = np.eye(dim)[0], np.eye(dim)[1]
    out += [math.cos(t) * a + math.sin(t) * b for t in np.arange(0, 1.5, 0.2)]
    out += [out[70] * 3.0] + [out[5]] * 30
    return [(i, v.tolist(), 0) for i, v in enumerate(out)]


@pytest.mark.parametrize("block", [4_096, 16])
def test_links_and_components_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vector_links, "BLOCK", block)
    rows = clusters()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in vector_links.linked_vectors(spark.createDataFrame(rows, KIND)).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    found, true = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
    assert 0.98 * true <= found <= true
    assert all(got[i][0] <= want[i][0] for i in want)  # never a link below the limit
    assert np.mean([got[i][1] == want[i][1] for i in want]) >= 0.98
    assert all(g[2] == (i == g[1]) for i, g in got.items())


def test_recall_exactly_at_the_limit(spark):
    r = np.random.default_rng(8)
    base = unit_rows(r.normal(size=(1_500, 64)))
    side = r.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    other = 0.9005 * base + math.sqrt(1 - 0.9005 ** 2) * unit_rows(side)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([base, other]))]
    got = vector_links.linked_vectors(spark.createDataFrame(rows, KIND)).agg(F.sum("n_links")).first()[0]
    assert got >= 0.95 * 2 * 1_500


def test_visits_follow_the_recall():
    r = np.random.default_rng(9)
    unit = unit_rows(r.normal(size=(1_000, 32)))
    books = fit(unit, 10)
    few, more = (vector_links.visits_needed(books, unit, math.acos(0.9), p) for p in (0.7, 0.98))
    assert 1 <= few < more <= 100


def test_balls_hold_only_linked_rows():
    v = unit_rows(np.array([x for _, x, _ in clusters()], float))
    reach = math.acos(0.9) / 2 - 1e-6
    own, gap = vector_links.leaders(v, np.zeros(len(v)), reach)
    assert len(set(own.tolist())) < len(v) / 2
    for lead in set(own.tolist()):
        part = v[own == lead]
        assert (part @ part.T).min() >= 0.9 and gap[own == lead].max() <= reach + 1e-6


def test_awkward_rows(spark):
    good = [(10, [1.0, 0.0, 0.0], 0), (3, [2.0, 0.0, 0.0], 0), (3, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.01, 0.0], 0),
            (20, [0.0, 1.0, 0.0], 0), (21, [0.0, -1.0, 0.0], 0)]
    bad = [(30, None, 0), (31, [0.0, 0.0, 0.0], 0), (32, [math.nan, 1.0, 0.0], 0), (33, [math.inf, 1.0, 0.0], 0),
           (34, [None, 1.0, 0.0], 0), (35, [1.0], 0), (36, [], 0), (None, None, 0)]
    df = spark.createDataFrame(good + bad, KIND)
    for name in ("uid", "node", "vec", "unit", "ball", "root", "weight", "size", "n_links"):
        df = df.withColumn(name, F.lit("own"))
    got = sorted((tuple(r) for r in vector_links.linked_vectors(df).collect()), key=str)
    want = [(10, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True), (None, 3, 3, False), (20, 0, 20, True),
            (21, 0, 21, True)] + [(i, 0, i, True) for i, _, _ in bad]
    assert got == sorted(want, key=str)
    assert vector_links.linked_vectors(spark.createDataFrame([], KIND)).count() == 0
