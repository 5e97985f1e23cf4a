import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import toxicity

from .helpers import AWKWARD, CLASHING, frame

SMALL = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    r = np.random.default_rng(1)
    sizes = [0, 1, 2, 5, 7, 0, 3]
    first = np.concatenate([[0], np.cumsum(sizes)])
    s = r.normal(0, 2, first[-1])
    move = r.normal(0, 1, (2, 2))
    fwd, bwd = toxicity.forward_backward(s, first, move)
    clean = toxicity.no_toxic_token(s, bwd, first, move)
    for d, n in enumerate(sizes):
        own = s[first[d]:first[d + 1]]
        weights = {}
        for y in product((0, 1), repeat=n):
            score, before = 0.0, 0
            for t, v in enumerate(y):
                score += move[before, v] + (own[t] if v else 0)
                before = v
            weights[y] = np.exp(score)
        total = sum(weights.values())
        assert np.exp(clean[d]) == pytest.approx(weights[(0,) * n] / total)
        for t in range(n):
            p = sum(w for y, w in weights.items() if y[t]) / total
            assert 1 / (1 + np.exp(-(fwd + bwd)[first[d] + t])) == pytest.approx(p)


def test_chain_learns_labelled_tokens():
    r = np.random.default_rng(2)
    windows = []
    for _ in range(200):
        w = r.integers(-1, 3, 20)
        windows.append((w, (w == 1).astype(int)))
    emission, bias, move = toxicity.fit_chain(windows, 3)
    assert emission[1] + bias > 1 and emission[0] + bias < -1 and emission[2] + bias < -1


def test_held_out_rows_are_told_apart(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = toxicity.toxic_scores(docs, labels).join(labels, "doc_id").collect()
    truth = {True: [], False: []}
    for x in got:
        assert 0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.5)
        assert x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0)
        if x["held_out"]:
            truth[x["toxic"] == 1].append(x["score"])
    wins = [a > b for a in truth[True] for b in truth[False]]
    assert np.mean(wins) > 0.65  # a part of the labels has no sign in the text
    assert np.mean([s < 0.5 for s in truth[False]]) > 0.95
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = [(text[x["doc_id"]][s["start"]:s["end"]]) for x in got for s in x["spans"]]
    assert found and all(f and not f[0].isspace() for f in found)


@pytest.mark.parametrize("toxic", [None, 0])
def test_awkward_rows_without_two_kinds_of_labels(spark, toxic):
    docs = frame(spark, AWKWARD, CLASHING)
    labels = spark.createDataFrame([(4, 1, toxic), (None, 1, 1), (9, None, toxic)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.toxic_scores(docs, labels).collect()
    assert len(got) == len(AWKWARD) and all(r["predicted"] == 0 and r["score"] < 0.5 for r in got)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(AWKWARD)


def test_planted_words_are_dropped(spark):
    rows = [(i, f"some words number{i} here " + ("vilehate more" if i % 4 == 0 else "kind more"), "en", "s")
            for i in range(400)]
    docs = frame(spark, rows + AWKWARD[:1])
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, labels).collect()}
    assert kept == {i for i in range(400) if i % 4} | {1}


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxic_scores(frame(spark, []), labels).count() == 0


def test_only_equal_texts_are_one_observation(spark):
    """Texts that differ in digits or behind a common opening stay apart; copies but for case and space don't."""
    opening = "one common opening of seven plain words "
    rows = [(i, f"{opening}number{i}", "en", "s") for i in range(60)]
    rows += [(100 + i, "The  same\ttext" if i % 2 else "the same text ", "en", "s") for i in range(10)]
    docs = frame(spark, rows)
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    used = toxicity.held_out_rows(docs).where("not held_out").select("text").collect()
    want = {" ".join(r["text"].lower().split()) for r in used}
    got = [" ".join(r["text"].lower().split()) for r in toxicity.sample_rows(docs, labels, 10_000).collect()]
    assert len(got) == len(want) and set(got) == want


def test_both_labels_have_their_share_of_the_sample(spark):
    docs = frame(spark, [(i, f"text number {i}", "en", "s") for i in range(4_000)])
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 100 == 1).cast("int").alias("toxic"))
    got = {r["toxic"]: (r["n"], r["w"]) for r in toxicity.sample_rows(docs, labels, 400).groupBy("toxic").agg(
        F.count("*").alias("n"), F.avg("weight").alias("w")).collect()}
    assert got[True][0] >= 25 and got[True][1] == 1.0  # all of the few toxic ones
    assert 130 <= got[False][0] <= 280 and 10 < got[False][1] < 25


def test_the_fit_holds_few_pairs_at_once():
    """The driver fits the chain: beside some numbers a token, it holds the chances of PAIRS neighbours only."""
    import tracemalloc
    r = np.random.default_rng(3)
    windows = [(r.integers(-1, 50, 64).astype(np.int32), (r.random(64) < 0.1).astype(np.int8)) for _ in range(10_000)]
    tracemalloc.start()
    toxicity.fit_chain(windows, 50, steps=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * 64 * len(windows)
