import numpy as np

from basketry.llm import multi_index


def test_multi_sequence_is_the_order_of_the_sums():
    r = np.random.default_rng(1)
    left, right = r.random(7), r.random(9)
    got = list(multi_index.multi_sequence(left, right))
    assert len({(i, j) for i, j, _ in got}) == 63
    costs = [c for _, _, c in got]
    assert costs == sorted(costs) and all(c == left[i] + right[j] for i, j, c in got)


def test_first_cells_are_the_start_of_the_multi_sequence():
    r = np.random.default_rng(2)
    left, right = r.random((20, 6)), r.random((20, 6))
    for top in (1, 2, 5, 17, 36, 50):
        i, j = multi_index.first_cells(left, right, top)
        for row in range(20):
            want = [(a, b) for a, b, _ in multi_index.multi_sequence(left[row], right[row])][:top]
            assert list(zip(i[row].tolist(), j[row].tolist())) == want


def test_codebooks_of_few_rows():
    books = multi_index.fit(np.array([[1.0, 2.0, 3.0]] * 4), 8)
    assert books.k == 1 and books.half == 2
    assert [a.tolist() for a in books.cells(np.array([[1.0, 2.0, 3.0]]))] == [[0], [0]]


def test_spread_join_keeps_hot_and_cold_rows(spark):
    many = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(3_000)], "k long, v long")
    one = spark.createDataFrame([(0, 2_000)] + [(i, 1) for i in range(3, 3_000, 3)], "k long, n long")
    got = multi_index.spread_join(many, one, "k", "n", 3_000).collect()
    want = [(k, v) for k, v in ((0 if i % 3 else i, i) for i in range(3_000)) if k == 0 or k % 3 == 0]
    assert sorted((r["k"], r["v"]) for r in got) == sorted(want)
