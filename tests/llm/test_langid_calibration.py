import random

from basketry.llm import langid

from .helpers import frame


def test_no_text_counts_and_calibrates(spark, monkeypatch):
    """A rare language does not make the large one calibrate on counted texts."""
    r = random.Random(3)
    rows = [(None if i % 2 else i, " ".join("".join(r.choice("abcdeghi") for _ in range(6)) for _ in range(8)), x, "s")
            for i in range(300) for x in (["en", "de"] if i < 10 else ["en"])]
    seen = []
    plain = langid.calibration_rows

    def watch(held, model, *rest):
        seen.append({(x["lang"], x["counted"], x["fold"]) for x in held.collect()})
        return plain(held, model, *rest)

    monkeypatch.setattr(langid, "calibration_rows", watch)
    docs = langid.learned_rows(frame(spark, rows))
    model = langid.train(docs, train_docs=40)
    assert ("en", False, -1) in seen[0] and not any(c for _, c, _ in seen[0])
    assert all(lang == "de" and fold == k for k, part in enumerate(seen[1:]) for lang, _, fold in part)
    assert any(seen[1:]) and model.langs == ["de", "en"]
