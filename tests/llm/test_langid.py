import zlib

import numpy as np
import pandas as pd
import pytest

from basketry.llm import langid

from .helpers import AWKWARD, CLASHING, frame

SMALL = "/root/testdata/sf0.01"


def model_of(texts_by_lang):
    import pyarrow as pa
    rows = [(x, t) for x, ts in texts_by_lang.items() for t in ts]
    batch = pa.record_batch([pa.array([x for x, _ in rows]), pa.array([t for _, t in rows])], names=["lang", "text"])
    grams = pd.concat([b.to_pandas() for b in langid._count_grams([batch])])
    m = langid.LanguageModels.from_counts(grams.groupby(["lang", "gram"], as_index=False)["n"].sum())
    m.limits = np.full(len(m.langs), np.inf)
    return m


def test_next_characters_sum_to_one():
    texts = {"x": ["abra cadabra abba bar", "cab bad dab"], "y": ["abc bca cab " * 3]}
    m = model_of(texts)
    letters = sorted(set("abcdr"))
    for word in ("ab", "a", "cad", "zzz"):
        # chance of a word = product of its characters and its end; each next step sums to one
        def log_prob(w, ended):
            codes = np.frombuffer(w.encode("utf-32-le"), np.uint32)
            windows, _ = langid.padded(codes, np.array([0]), np.array([len(w)]))
            full = m.word_log_probs(codes, np.array([0]), np.array([len(w)]))[0]
            return full
        ends = np.exp(log_prob(word, True))
        longer = [np.exp(log_prob(word + c, True)) for c in letters]
        assert (ends > 0).all() and all((p > 0).all() and (p < 1).all() for p in longer)
    # order-1 probabilities with the floor for unseen characters
    for k, alpha in enumerate(m.alpha[:1]):
        for x in range(2):
            own = set("".join(texts["xy"[x]]))
            total = alpha[:, x].sum() + m.floor[x] * (len(letters) + 2)
            assert total == pytest.approx(1.0, abs=0.02), own


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert np.mean([r["rejected"] for r in held]) < 0.1


def test_awkward_rows(spark):
    rows = AWKWARD + [(20 + i, t, x, "s") for i, (t, x) in enumerate(
        [("the cat and the dog", "en"), ("der hund und die katze", "de")] * 10)] + [(50, "12 345 !!", "en", "s")]
    got = langid.identify(frame(spark, rows, CLASHING)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for i in (1, 2, 6, 50):
        assert by[i]["lang_pred"] == "und" and by[i]["score"] == 0
    assert by[20]["lang_pred"] == "en" and by[21]["lang_pred"] == "de"


def test_nothing_to_learn(spark):
    got = langid.identify(frame(spark, [(1, "some text", None, "s"), (3, None, "en", "s")])).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und"]
    assert langid.identify(frame(spark, [])).count() == 0
