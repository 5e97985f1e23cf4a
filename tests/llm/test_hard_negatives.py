import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import hard_negatives
from basketry.llm.multi_index import fit, multi_sequence

KIND = "vec_id long, embedding array<double>, label int"


def brute(rows, every, k=5, low=80, high=100):
    rows = [(i, [math.floor(256 * c) for c in v], y) for i, v, y in rows]
    out = []
    for p, (a, x, y) in enumerate(rows):
        if a % every:
            continue
        scored = sorted((-sum(s * t for s, t in zip(x, z)), i, w) for q, (i, z, w) in enumerate(rows) if q != p)
        for ps, i, w in [s for s in scored if s[2] == y][:k]:
            near = [s for s in scored if s[2] != y and -low * ps <= -100 * s[0] <= -high * ps][:k]
            out += [(a, i, r + 1, j, -ps, -ns) for r, (ns, j, _) in enumerate(near)]
    return sorted(out)


def mined(df, every, **kw):
    got = hard_negatives.mine(df, F.col("vec_id") % every == 0, **kw)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect())


def rows_of(n=400, dim=6, seed=2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dim))
    return [(i, (centres[i % 5] + 0.4 * r.normal(size=dim)).tolist(), int(r.integers(3))) for i in range(n)]


@pytest.mark.parametrize("first,block,cell", [(8_192, 4_096, 1_024), (20, 8, 10)])
def test_against_all_pairs(spark, monkeypatch, first, block, cell):
    for name, value in (("FIRST", first), ("BLOCK", block), ("CELL", cell)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = rows_of() + [(1_000 + i, [0.5] * 6, i % 3) for i in range(60)]  # many equal scores
    assert mined(spark.createDataFrame(rows, KIND), 20) == brute(rows, 20)


def test_windows_are_inclusive_and_may_be_empty(spark):
    one = 1 / 16  # 16 as an integer
    rows = [(0, [one, 0.0], 1), (1, [one, 0.0], 1), (2, [one, 0.0], 2), (3, [one * 0.8125, 0.0], 2),
            (4, [one * 0.75, 0.0], 2), (5, [-one, 0.0], 2)]
    df = spark.createDataFrame(rows, KIND)
    # 256 is in reach of itself; 13 * 16 = 208 >= 204.8 is, 12 * 16 = 192 isn't
    assert mined(df, 100) == [(0, 1, 1, 2, 256, 256), (0, 1, 2, 3, 256, 208)]
    assert mined(df, 100, high=99) == [(0, 1, 1, 3, 256, 208)]
    lonely = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 2)], KIND)
    assert mined(lonely, 100) == []
    negative = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-1.0, 0.0], 2)]
    assert mined(spark.createDataFrame(negative, KIND), 100) == [] == brute(negative, 100)
    zero = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 1.0], 2)]
    assert mined(spark.createDataFrame(zero, KIND), 100) == [(0, 1, 1, 2, 0, 0)] == brute(zero, 100)


def test_awkward_rows(spark):
    rows = rows_of(60, dim=3)
    bad = [(600, None, 0), (700, [math.nan, 0.0, 0.0], 0), (800, [1.0, None, 0.0], 0), (900, [1.0, 1.0, 1.0], None),
           (1_000, [1.0], 0), (1_100, [], 0), (1_200, [1e9, 0.0, 0.0], 0), (None, [1.0, 1.0, 1.0], 0),
           (1_300, [-math.inf, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows + bad, KIND)
    for name in ("uid", "x", "cell", "block", "slot", "windows", "score"):
        df = df.withColumn(name, F.lit("own"))
    assert mined(df, 20) == brute(rows, 20)
    repeated = rows + [rows[20], rows[3], rows[3]]
    assert mined(spark.createDataFrame(repeated, KIND), 20) == brute(repeated, 20)
    assert mined(spark.createDataFrame([], KIND), 20) == []


def test_bounds_hold_for_every_row_and_fall():
    r = np.random.default_rng(4)
    x = np.floor(256 * r.normal(size=(500, 8))).astype(np.int64)
    books = fit(x[:100].astype(float), 6)
    i, j = books.cells(x.astype(float))
    import pandas as pd
    cells = pd.DataFrame({"cell": i * books.k + j, "left": np.linalg.norm(x[:, :4] - books.left[i], axis=1),
                          "right": np.linalg.norm(x[:, 4:] - books.right[j], axis=1)})
    cells = cells.groupby("cell").agg(n=("left", "size"), left=("left", "max"), right=("right", "max")).reset_index()
    bounds = hard_negatives.Bounds(books, cells)
    for a in x[:20]:
        steps = list(multi_sequence(*bounds.halves(a)))
        assert len(steps) == books.k ** 2 and [c for _, _, c in steps] == sorted(c for _, _, c in steps)
        bound = {(p, q): -c for p, q, c in steps}
        assert all(bound[p, q] >= s for p, q, s in zip(i.tolist(), j.tolist(), (x @ a).tolist()))
        cells_seen, done, nxt = [], 0, math.inf
        while nxt > float("-inf"):  # rounds visit each non-empty cell once
            got, done, nxt = bounds.visit(a, done, float("-inf"), 40)
            cells_seen += got
        assert sorted(cells_seen) == sorted(cells["cell"].tolist())


def test_large_products_are_exact():
    a, b = np.array([[(1 << 23) - 1] * 1_000]), np.array([[(1 << 23) - 1] * 999 + [-3]])
    want = 999 * ((1 << 23) - 1) ** 2 - 3 * ((1 << 23) - 1)
    assert hard_negatives.scores(a, b)[0, 0] == want
