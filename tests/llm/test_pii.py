import random
import re

from pyspark.sql import functions as F

from basketry.llm import pii

from .helpers import AWKWARD, CLASHING, frame, texts

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, m):
    digits = [int(c) for c in m if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits[::-1]))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), list(PATTERNS).index(k), m.end()) for k, p in PATTERNS.items()
                  for m in re.finditer(p, text or "") if passes(k, m.group(0)))


def base_of(df):
    return {r["doc_id"]: [(s["start"], s["rank"], s["end"]) for s in r["spans"] if s["base"]] for r in df.collect()}


def test_base_spans_equal_brute_force(spark):
    r = random.Random(7)
    bits = ["a@b.c", "@", ".", "_", "+", "+1 (555) 123-4567", "4111 1111 1111 1111", "4111111111111111", " ", "-",
            "1.2.3.4", "999.1.1.1", "0", "12", "é", "😀", "x.y@z-q.com", "\n", "(", "00012.1.1.255", "5500-0000-0000-0004"]
    rows = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(1500)]
    got = base_of(pii.personal_data(texts(spark, rows)))
    assert [got[i] for i in range(len(rows))] == [brute(t) for t in rows]


def test_long_runs_are_scanned_once(spark):
    rows = ["a" * 300_000, "1" * 300_000, "1 " * 100_000, "+" + "1" * 100_000, "a.b-" * 50_000 + "@x.com"]
    got = base_of(pii.personal_data(texts(spark, rows)))
    assert [got[i] for i in range(4)] == [[], [], [], []] and len(got[4]) == 1


def test_many_matches_in_one_text(spark):
    """Spans of more than a block, with and without loose candidates around them, in linear time."""
    ips = [f"{i % 250}.{i // 250}.7.{i % 90}" for i in range(20_000)]
    rows = ["é ".join(ips), " ".join(f"{x} call 555-123-{i % 10_000:04d}" for i, x in enumerate(ips[:5_000])),
            *[" ".join(ips[:n]) for n in (1, 255, 256, 257, 512, 513)]]
    got = pii.personal_data(texts(spark, rows)).collect()
    base = {r["doc_id"]: [(s["start"], s["rank"], s["end"]) for s in r["spans"] if s["base"]] for r in got}
    assert [base[i] for i in range(len(rows))] == [brute(t) for t in rows] and len(base[0]) == 20_000
    for r in got:  # an added span overlaps no base span
        held = [(s["start"], s["end"]) for s in r["spans"]]
        assert all(a[1] <= b[0] for a, b in zip(held, held[1:]))


def test_surroundings_equal_substrings(spark):
    text = "".join(chr(0x1F600 + i % 50) if i % 7 == 0 else chr(97 + i % 26) for i in range(1_500))
    at = [0, 1, 39, 40, 41, 215, 216, 217, 255, 256, 257, 511, 512, 1_400, 1_499, 1_500]
    df = texts(spark, [text]).select(F.explode(F.array(*map(F.lit, at))).alias("at"), "text")
    got = df.select("at", *[pii.part(pii.chunks(F.col("text")), F.col("at"), F.lit(n)).alias(f"n{n}") for n in (1, 40)])
    assert {r["at"]: (r["n1"], r["n40"]) for r in got.collect()} == {a: (text[a:a + 1], text[a:a + 40]) for a in at}


def test_written_out_and_plain_forms_are_added(spark):
    rows = ["mail me: jo.doe (at) mail dot example dot com today", "call 415-555-2671 now",
            "call +1 415 555 2671 or mail jo@example.com", "from host 8.8.8.8 and card 4111111111111111"] * 20
    rows += [f"the price was {i} and nothing else" for i in range(50)]
    got = pii.personal_data(texts(spark, rows)).collect()
    kinds = {r["doc_id"]: [(s["kind"], s["base"]) for s in r["spans"]] for r in got}
    assert ("email", False) in kinds[0] and ("phone", False) in kinds[1]
    assert kinds[2] == [("phone", True), ("email", True)] and all(not kinds[i] for i in range(80, 130))


def test_em_finds_the_better_labeler():
    counts = [("email", f"{a},{b},-1,-1,-1", n) for a, b, n in ((1, 1, 80), (1, 0, 25), (0, 0, 90), (0, 1, 5))]
    post, like = pii.reliabilities(counts)
    assert post["email", "1,1,-1,-1,-1"] > 0.9 > 0.1 > post["email", "0,0,-1,-1,-1"]
    assert all(abs(sum(like[j, y, v] for v in (1, 0, -1)) - 1) < 0.05 for j in range(5) for y in (0, 1))


def test_awkward_rows(spark):
    got = pii.personal_data(frame(spark, AWKWARD, CLASHING)).collect()
    assert len(got) == len(AWKWARD) and all(r["spans"] == [] for r in got)
    assert pii.personal_data(frame(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = pii.personal_data(frame(spark, AWKWARD))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
