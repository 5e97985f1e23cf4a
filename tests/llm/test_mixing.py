import random
from collections import defaultdict
from itertools import product

import pytest

from basketry.llm import mixing

from .helpers import AWKWARD, CLASHING, frame


def test_fit_is_nearest_sum():
    r = random.Random(2)
    for _ in range(60):
        lengths = [(n, r.randint(1, 3)) for n in r.sample(range(1, 40), 4)]
        total = sum(n * c for n, c in lengths)
        budget = r.randint(0, total)
        take = mixing.fit(lengths, budget, total)
        assert all(0 <= take[n] <= c for n, c in lengths)
        # a proportional share is taken first; the rest is the nearest sum
        base = {n: c * budget // total for n, c in lengths}
        sums = [sum(n * (base[n] + x) for (n, _), x in zip(lengths, xs))
                for xs in product(*[range(c - base[n] + 1) for n, c in lengths])]
        got = sum(n * t for n, t in take.items())
        assert abs(got - budget) == min(abs(s - budget) for s in sums)


def water(sizes, cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    rest = float(total)
    while free:
        w = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / w > cap * sizes[s]]
        if not over:
            return target | {s: rest * weight[s] / w for s in free}
        for s in over:
            target[s] = float(cap * sizes[s])
        free -= set(over)
        rest = total - sum(target.values())
    return target


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_takes(spark, seed):
    r = random.Random(seed)
    rows = AWKWARD + [(100 + i, "w " * int(r.paretovariate(0.8) * 5), None,
                       r.choice(["hot"] * 6 + ["b", "é", "tiny", None])) for i in range(300)]
    docs = frame(spark, rows, CLASHING)
    got = mixing.mix(mixing.measured(docs), ["doc_id", "source"]).collect()
    assert len(got) == len(rows)
    sizes, taken, target, most = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for x in got:
        assert 0 <= x["repeats"] <= 3
        sizes[x["source"]] += x["size"]
        taken[x["source"]] += x["size"] * x["repeats"]
        target[x["source"]] = x["target"]
        most[x["source"]] = max(most[x["source"]], x["size"])
    want = water(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        # many documents come within a word; a few large ones within half of the largest
        assert abs(taken[s] - target[s]) <= (1 if s == "hot" else max(1, most[s] / 2 + 1))
    again = mixing.mix(mixing.measured(docs.repartition(5)), ["doc_id", "source"]).collect()
    key = lambda rows_: sorted((str(x["doc_id"]), x["size"], x["repeats"]) for x in rows_)
    assert key(got) == key(again)


def test_mixed_documents_keep_columns(spark):
    docs = frame(spark, AWKWARD, CLASHING)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() > 0


@pytest.mark.parametrize("few", [mixing.FEW, 0])
def test_mixed_documents_are_those_of_the_mix(spark, monkeypatch, few):
    """Repeated rows included, of which some may be taken; no text is shuffled while the plan is small."""
    monkeypatch.setattr(mixing, "FEW", few)
    r = random.Random(5)
    rows = AWKWARD + [(r.randint(0, 40), "w " * r.choice([1, 2, 2, 900]), None, r.choice(["hot"] * 4 + ["b", None]))
                      for _ in range(300)]
    rows += [(7, "one row many times", "en", "c")] * 50 + [(500 + i, f"alone {i}", "en", "d") for i in range(30)]
    docs = frame(spark, rows, CLASHING)
    want = mixing.mix(mixing.measured(docs), ["doc_id", "source"])
    words = lambda x: (str(x["doc_id"]), x["source"] or "", x["size"])
    wanted = sorted(words(x) for x in want.collect() for _ in range(x["repeats"]))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = out.select("doc_id", "source", mixing.word_count("text").alias("size"))
    assert sorted(words(x) for x in got.collect()) == wanted
    if few:
        plain = mixing.mixed_documents(docs.dropDuplicates(["doc_id", "text", "source"]))
        assert "Exchange hashpartitioning(sid" not in plain._jdf.queryExecution().executedPlan().toString()


def test_empty(spark):
    assert mixing.mix(mixing.measured(frame(spark, [])), ["doc_id"]).count() == 0
    only = frame(spark, [(1, None, None, None)])
    assert [r["repeats"] for r in mixing.mix(mixing.measured(only), ["doc_id"]).collect()] == [0]
