import hashlib

from pyspark.sql import functions as F

from basketry.llm import lzprint

from .helpers import AWKWARD, CLASHING, frame


def phrases(text):
    known, out, open_ = set(), [], ""
    for c in text:
        open_ += c
        if open_ not in known:
            known.add(open_)
            out.append(open_)
            open_ = ""
    return out


def test_parse_equals_string_dictionary():
    for text in ("", "a", "aaaaaaa", "abracadabra abracadabra", "日本語日本語 😀😀", "the cat the cat the hat " * 9):
        p = lzprint.Parse()
        p.feed(lzprint.code_points(text))
        assert len(p.hashes) - 1 == len(phrases(text)) == len(set(p.hashes[1:]))
        half = lzprint.Parse()
        half.feed(lzprint.code_points(text[:5]))
        half = half.copy()
        half.feed(lzprint.code_points(text[5:]))
        assert half.hashes == p.hashes


def test_likeness_estimates_shared_phrases():
    base = " ".join(f"word{i * i % 97} thing{i % 13}" for i in range(400))
    for cut in (0, 50, 400, 3000):
        other = base[:len(base) - cut] + "zq jx kv " * (cut // 9)
        a, b = set(phrases(base)), set(phrases(other))
        fa, fb = lzprint.measured(base, "")[2], lzprint.measured(other, "")[2]
        assert abs(lzprint.likeness(fa, fb) - len(a & b) / len(a | b)) < 0.15


def test_contract_on_awkward_rows(spark):
    rows = [r for r in AWKWARD if r[0] is not None] + [(20 + i, f"text number {i} " * (i % 9), None, None) for i in range(60)]
    got = lzprint.fingerprints(frame(spark, rows, CLASHING).repartition(3)).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: r[0])
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for k, (i, t, _, _) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        n, sha, fp, edit = lzprint.measured(t, after)
        want = (n, sha, lzprint.shown(fp), lzprint.shown(edit), lzprint.likeness(fp, edit),
                lzprint.likeness(fp, lzprint.measured(after, "")[2]))
        assert sha == hashlib.sha256((t[:len(t) - len(t) // 4] + after[:len(t) // 4]).encode()).hexdigest()
        assert want in [tuple(r)[1:] for r in by[i]]


def test_null_ids_and_single_rows(spark):
    assert len(lzprint.fingerprints(frame(spark, AWKWARD)).collect()) == len(AWKWARD)
    one = lzprint.fingerprints(frame(spark, [(5, "only one row here", None, None)])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert lzprint.fingerprints(frame(spark, [])).count() == 0


def test_null_and_repeated_ids_are_spread(spark):
    """Rows without an id and rows of one id are cut by their hash; the order stays id, then hash."""
    rows = [(None, f"no id {i * i} here", None, None) for i in range(150)]
    rows += [(7, f"same id {i} {i % 11}", None, None) for i in range(150)]
    rows += [(i, f"own id {i} again", None, None) for i in range(-70, 80) if i != 7]
    docs = frame(spark, rows).repartition(5)
    dealt = lzprint.in_order(docs).where("lead = 0").groupBy("part").count().collect()
    assert sum(r["count"] for r in dealt) == len(rows) and max(r["count"] for r in dealt) < 60
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).collect()
    order = sorted(keyed, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["tie"]))
    got = {(r["doc_id"], r["edited_sha256"]) for r in lzprint.fingerprints(docs).collect()}
    want = set()
    for k, r in enumerate(order):
        t, after = r["text"], order[(k + 1) % len(order)]["text"]
        want.add((r["doc_id"], hashlib.sha256((t[:len(t) - len(t) // 4] + after[:len(t) // 4]).encode()).hexdigest()))
    assert got == want
