import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import whitening

KIND = "vec_id long, embedding array<double>, label int"
BAD = [(900, None, 0), (901, [1.0, math.nan, 0.0], 0), (902, [math.inf, 0.0, 0.0], 0), (903, [1.0, None, 0.0], 0),
       (904, [1.0], 0), (905, [], 0), (906, [1e30, 0.0, 0.0], 0)]


def frame(spark, rows):
    """Vectors with columns whose names the operator uses for its own."""
    df = spark.createDataFrame(rows, KIND)
    for name in ("x", "z", "v", "copies", "fit", "n", "at", "component", "deviation"):
        df = df.withColumn(name, F.lit("own"))
    return df


def brute(rows):
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v, _ in rows]
    n, dim = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dim)]
    dev = [sum((n * r[d] - sums[d]) ** 2 for d in range(dim)) for r in x]
    cov = [[float(Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x), n ** 3)) for j in range(dim)]
           for i in range(dim)]
    values, axes = np.linalg.eigh(np.array(cov))
    order = np.argsort(-values)
    centred = np.array([[float(Fraction(n * r[d] - sums[d], n)) for d in range(dim)] for r in x])
    return dev, centred @ axes[:, order] / np.sqrt(values[order]), values[order] / values.sum()


@pytest.mark.parametrize("hot", [1_000, 1])
def test_against_exact_sums(spark, monkeypatch, hot):
    monkeypatch.setattr("basketry.llm.multi_index.HOT", hot)
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=3).tolist(), 0) for i in range(60)]
    rows += [(1_000 + i, [0.5, -0.25, 2.0], 1) for i in range(40)]  # a hot group of copies
    rows += [(7, rows[7][1], 0), (7, [0.1, 0.2, 0.3], 0), (None, [0.3, 0.2, 0.1], 0)]
    dev, white, share = brute(rows)
    got = whitening.whiten(frame(spark, rows + BAD), components=8).collect()
    assert len(got) == 3 * len(rows)
    for k in range(3):
        mine = [g for g in got if g["component"] == k + 1]
        key = lambda g: (g[0] if g[0] is not None else -1, round(g[1], 6))
        best = None
        for s in (1, -1):
            want = sorted(((rows[i][0], s * white[i, k], dev[i]) for i in range(len(rows))), key=key)
            have = sorted(((g["vec_id"], g["whitened"], int(g["deviation"])) for g in mine), key=key)
            same = all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-9 and a[2] == b[2] for a, b in zip(want, have))
            best = best or same
        assert best
        assert all(abs(g["explained"] - share[k]) < 1e-12 and g["n"] == len(rows) for g in mine)
    assert all(g["identity_error"] < 1e-9 for g in got)


def test_each_distinct_vector_once(spark):
    r = np.random.default_rng(6)
    distinct = [(i, r.normal(size=2).tolist(), 0) for i in range(20)]
    copies = distinct + [(100 + i, distinct[0][1], 0) for i in range(50)]
    once = {(g["vec_id"], g["component"]): (g["n"], g["deviation"], abs(g["whitened"]))
            for g in whitening.whiten(frame(spark, distinct), weights="counts").collect()}
    got = whitening.whiten(frame(spark, copies), weights="one").collect()
    assert len(got) == 140
    for g in got:
        n, dev, white = once[g["vec_id"] if g["vec_id"] < 100 else 0, g["component"]]
        assert (g["n"], g["deviation"]) == (n, dev) and abs(abs(g["whitened"]) - white) < 1e-9


def test_large_entries_stay_exact(spark):
    rows = [(1, [2.0 ** 30, 0.0], 0), (2, [-2.0 ** 30, 1.0], 0), (3, [2.0 ** 30, 5.0], 0), (4, [0.0, 0.0], 0)]
    dev, _, _ = brute(rows)
    got = {g["vec_id"]: int(g["deviation"]) for g in whitening.whiten(frame(spark, rows)).collect()}
    assert got == {i + 1: d for i, d in enumerate(dev)}


def test_empty_equal_and_unusable(spark):
    assert whitening.whiten(spark.createDataFrame([], KIND)).count() == 0
    assert whitening.whiten(frame(spark, BAD[:4])).count() == 0
    assert whitening.whiten(frame(spark, [(i, [1.0, 2.0], 0) for i in range(5)])).count() == 0
    # one direction of spread only: one component
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i], 0) for i in range(5)])).collect()
    assert {g["component"] for g in line} == {1} and len(line) == 5
    assert line[0]["explained"] == pytest.approx(1.0)
