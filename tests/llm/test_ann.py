import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import ann

SMALL = "/root/testdata/sf0.01"
KIND = "vec_id long, embedding array<float>, label int"


def exact(rows, queries, k):
    out = {}
    for q in queries:
        a = np.asarray(dict(rows)[q], float)
        scores = [(-float((np.asarray(v, float) * a).sum() / np.sqrt((a * a).sum()) /
                          np.sqrt((np.asarray(v, float) ** 2).sum())), i) for i, v in rows if i != q]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_recall_against_brute_force(spark):
    v = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in v.collect()]
    got = {}
    for r in ann.search(v, F.col("vec_id") % 50 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    queries = [i for i, _ in rows if i % 50 == 0]
    want = exact([(i, x) for i, x in rows], queries, 5)
    hits = 0
    for q in queries:
        assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]
        truth = dict(want[q])
        hits += sum(i in truth for _, i, _ in got[q])
        assert all(s == pytest.approx(truth[i], abs=1e-12) for _, i, s in got[q] if i in truth)
    assert hits >= 0.9 * 5 * len(queries)


def test_awkward_vectors_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 7)
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=4)], 0) for i in range(1, 40)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0], 0) for i in range(30)] + [(0, [1.0, 2.0, 3.0, 4.0], 0)]
    bad = [(50, None, 0), (500, [0.0] * 4, 0), (501, [1.0, math.nan, 0.0, 0.0], 0), (502, [math.inf, 0.0, 0.0, 0.0], 0),
           (503, [1.0, None, 0.0, 1.0], 0), (504, [1.0], 0), (505, [], 0), (None, [1.0, 0.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows + bad, KIND).withColumn("part", F.lit("x")).withColumn("vec", F.lit(1))
    got = [tuple(x) for x in ann.search(df, F.col("vec_id") == 0, k=5, parts=1).orderBy("rank").collect()]
    assert [g[2] for g in got] == [100, 101, 102, 103, 104] and len({g[3] for g in got}) == 1
    assert got[0][3] == pytest.approx(1.0)
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [1.0, 1.0], 0)], KIND)
    assert [(x["vec_id"], x["rank"]) for x in ann.search(few, F.col("vec_id") == 0).collect()] == [(1, 1)]
    assert ann.search(spark.createDataFrame([], KIND), F.col("vec_id") == 0).count() == 0


def test_partition_is_balanced_and_local():
    r = np.random.default_rng(1)
    centres = r.normal(size=(8, 16)) * 3
    v = ann.unit_rows(np.concatenate([c + r.normal(size=(60, 16)) * 0.3 for c in centres]))
    graph = ann.neighbour_graph(v)
    own = ann.balanced_partition(graph, v, 8)
    assert np.bincount(own, minlength=8).max() <= 67
    assert np.mean(own[graph] == own[:, None]) > 0.8
