"""Personal data by weak supervision, in DataFrame functions only.

Base spans follow fixed patterns and checks.  Looser patterns propose more
candidates (written-out addresses, phones without a plus, card-like numbers
that fail the checksum).  Labelers look at every candidate: pattern, checksum
or structure, gazetteer, context words, boundaries.  Each votes for, against
or abstains.  Expectation-maximisation over the counts of vote patterns (a
bounded table, whatever the input) estimates how reliable each labeler is, and
gives each pattern a probability.  These soft labels train a naive Bayes
classifier on the spans' own shape; candidates it accepts are added to the
base spans, unless they overlap one.

Offsets are code points, ends exclusive.  Defined results: a null text is
empty and has no spans; repeated rows are scanned alike; null ids stay null;
an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut

KINDS = ("email", "ip", "card", "phone")
#: Matches of a text are summed up in blocks of so many.
BLOCK = 256
#: Code points of a part of a text in which a span's surroundings are looked up; at least 40.
CHUNK = 256

# The base patterns.  Possessive repeats and the start conditions
# (the end of the last match, or not inside a run) change no match; they keep a
# long run of characters from being scanned again from each of its characters.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold before its pattern is tried.
SIGN = {"email": "@[A-Za-z0-9-]+\\.", "ip": "[0-9]\\.[0-9]", "card": "(?:[0-9][\\x20-]?){13}[0-9]", "phone": "\\+[0-9]"}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?"
             r"[A-Za-z0-9-]{1,63}(?:\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}){1,8}",
    "phone": r"(?<![0-9+-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
LOOSE_SIGN = {"email": "(?:\\[at\\]|\\(at\\)|\\x20at\\x20).{1,80}(?:\\[dot\\]|\\(dot\\)|\\x20dot\\x20)",
              "phone": "[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}"}

# Gazetteers and context words.
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info")
RESERVED = r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\."
CUES = (r"(?:e-?mail|mail|contact|call|phone|tel|mobile|fax|reach|card|visa|credit|payment|"
        r"address|host|client|user|from|by)\W{0,3}(?:\w{1,10}\W{1,2}){0,2}$")
AGAINST = r"(?:version|v|release|build|order|invoice|isbn|serial|page|section|no|nr|#)\W{0,3}$"

LABELERS = ("pattern", "check", "gazetteer", "context", "boundary")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Is the Luhn sum of a string of digits divisible by ten?"""
    rev = F.reverse(digits)

    def value(i):
        d = F.substring(rev, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        def small(p):
            p = F.regexp_replace(p, "^0+", "")
            value = F.when(p == "", 0).otherwise(F.substring(p, 1, 3).cast("int"))
            return (F.length(p) <= 3) & (value <= 255)
        return F.forall(F.split(m, r"\."), small)
    if kind == "card":
        n = F.length(_digits(m))
        return F.when(n.between(14, 19), luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where lambdas read it again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def blocks(items: Column) -> Column:
    """An array that isn't empty as arrays of BLOCK items, in order."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
                       lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)))


def overlapped(base: Column, s: Column) -> Column:
    """Does a span overlap one of ``base``, given as ``fenced`` blocks?"""
    return F.exists(base, lambda g: (g["lo"] < s["end"]) & (s["start"] < g["hi"]) & F.exists(
        g["items"], lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def fenced(spans: Column) -> Column:
    """Blocks of sorted spans with the least start and the largest end of each; null without spans."""
    return F.when(F.size(spans) > 0, F.transform(blocks(spans), lambda p: F.struct(
        p[0]["start"].alias("lo"), F.array_max(F.transform(p, lambda b: b["end"])).alias("hi"), p.alias("items"))))


def found(text: Column, pattern: str, sign: str) -> Column:
    """array<struct<start, end, m>> of all matches, leftmost and non-overlapping.

    The text between matches comes from ``split``, so starts are running sums
    of the lengths before; texts without the ``sign`` are not scanned.  Sums
    run within blocks of BLOCK matches and over the blocks, as a list that
    grows by ``concat`` costs the square of its length.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    none = F.expr("cast(array() as array<struct<start:int,end:int,m:string>>)")

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(
            F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m")))).alias("out"))

    def spans(pairs):
        sums = F.transform(blocks(pairs), lambda p: F.aggregate(
            p, F.lit(0), lambda n, x: n + x["gap"] + F.length(x["m"])))
        starts = F.aggregate(sums, F.array(F.lit(0)),
                             lambda out, n: F.concat(out, F.array(F.element_at(out, -1) + n)))
        return F.flatten(F.zip_with(blocks(pairs), F.slice(starts, 1, F.size(sums)), lambda p, at: F.aggregate(
            p, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])))

    pairs = let(matches, lambda m: F.zip_with(F.slice(gaps, F.lit(1), F.size(m)), m,
                                              lambda g, x: F.struct(g.alias("gap"), x.alias("m"))))
    return F.when(text.rlike(sign), let(pairs, lambda p: F.when(F.size(p) > 0, spans(p)).otherwise(none))).otherwise(none)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for, 0 against, -1 abstains."""
    return F.when(yes, 1).when(no if no is not None else ~yes, 0).otherwise(-1)


def _gazetteer(kind: str, m: Column) -> Column:
    if kind == "email":
        return _vote(F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1)).isin(*DOMAINS))
    if kind == "ip":
        return _vote(~m.rlike(RESERVED))
    if kind == "card":
        return _vote(_digits(m).rlike("^[3-6]"))
    return _vote(m.rlike(r"^\+[1-9]"), _digits(m).rlike(r"^0{3}|^(.)\1{6}"))


def chunks(text: Column) -> Column:
    """The text in parts of CHUNK code points: ``substring`` of a whole text walks there from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def part(parts: Column, at: Column, n: Column) -> Column:
    """``n`` code points, CHUNK at most, from the 0-based ``at`` on of a text in ``chunks``."""
    k = F.floor(at / CHUNK).cast("int")
    near = F.concat(F.coalesce(F.get(parts, k), F.lit("")), F.coalesce(F.get(parts, k + 1), F.lit("")))
    return F.substring(near, at - k * CHUNK + 1, n)


def judged(parts: Column, spans: Column, kind: str, base: bool) -> Column:
    """Candidates with votes and shape; base candidates that fail their check are kept as candidates."""

    def one(x):
        m = x["m"]
        ahead = part(parts, F.greatest(x["start"] - 40, F.lit(0)), F.least(x["start"], F.lit(40)))
        before, left = F.lower(ahead), F.substring(ahead, -1, 1)
        right = part(parts, x["end"], F.lit(1))
        valid = _valid(kind, m) if base or kind in ("card",) else F.lit(True)
        open_side = lambda c: F.when(c.rlike("[A-Za-z0-9]"), "w").when(c.rlike(r"\S"), "p").otherwise("s")
        votes = F.concat_ws(",", *[v.cast("string") for v in (
            _vote(valid & F.lit(base), F.lit(base) & ~valid), _vote(valid), _gazetteer(kind, m),
            _vote(before.rlike(CUES), before.rlike(AGAINST)),
            _vote(~left.rlike("[A-Za-z0-9]") & ~right.rlike("[A-Za-z0-9]")))])
        shape = F.concat_ws(",", F.least(F.floor(F.log2(F.length(m).cast("double"))), F.lit(6)).cast("string"),
                            F.round(F.length(_digits(m)) * 4 / F.length(m)).cast("int").cast("string"),
                            F.least(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), F.lit(6)).cast("string"),
                            open_side(left), open_side(right), F.lit("strict" if base else "loose"),
                            valid.cast("string"))
        return F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"),
                        F.lit(kind).alias("kind"), (F.lit(base) & valid).alias("base"),
                        votes.alias("votes"), shape.alias("shape"))

    return F.transform(spans, one)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: base spans and other candidates, with votes and shape."""
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    names = [f"{k}_base" for k in KINDS] + [f"{k}_loose" for k in LOOSE]
    raw = d.select("doc_id", "text", *[found(text, BASE[k], SIGN[k]).alias(f"{k}_base") for k in KINDS],
                   *[found(text, LOOSE[k], LOOSE_SIGN[k]).alias(f"{k}_loose") for k in LOOSE])
    def all_judged(parts: Column) -> Column:
        return F.array_sort(F.concat(*[judged(parts, F.col(f"{k}_base"), k, True) for k in KINDS],
                                     *[judged(parts, F.col(f"{k}_loose"), k, False) for k in LOOSE]))

    # texts without any candidate skip the judging
    some = sum((F.size(n) for n in names), F.lit(0)) > 0
    spans = let(chunks(text), all_judged)
    none = F.expr(f"cast(array() as {SPAN})")
    return raw.select("doc_id", F.when(some, spans).otherwise(none).alias("spans"))


SPAN = ("array<struct<start:int,rank:int,end:int,kind:string,base:boolean,votes:string,shape:string>>")


def reliabilities(counts: list[tuple[str, str, int]], rounds: int = 50):
    """EM over (kind, votes, n): posterior per (kind, votes), and P(vote | personal or not).

    Votes of a labeler are independent given the truth; kinds have their own
    share of personal spans and share the labelers' reliabilities.
    """
    like = {(j, y, v): p for j in range(len(LABELERS))
            for y, row in ((1, {1: 0.7, 0: 0.1, -1: 0.2}), (0, {1: 0.2, 0: 0.6, -1: 0.2})) for v, p in row.items()}
    share = defaultdict(lambda: 0.7)
    post: dict[tuple[str, str], float] = {}
    for _ in range(rounds):
        for kind, votes, _n in counts:
            p1, p0 = math.log(share[kind]), math.log(1 - share[kind])
            for j, v in enumerate(map(int, votes.split(","))):
                p1 += math.log(like[j, 1, v])
                p0 += math.log(like[j, 0, v])
            post[kind, votes] = 1 / (1 + math.exp(min(50.0, p0 - p1)))
        total, seen = defaultdict(lambda: 1.0), defaultdict(lambda: 0.5)
        per_kind = defaultdict(lambda: [1.0, 1.0])
        for kind, votes, n in counts:
            for y in (0, 1):
                w = n * (post[kind, votes] if y else 1 - post[kind, votes])
                per_kind[kind][y] += w
                for j, v in enumerate(map(int, votes.split(","))):
                    seen[j, y, v] += w
                    total[j, y] += w
        share = defaultdict(lambda: 0.7, {k: a[1] / sum(a) for k, a in per_kind.items()})
        like = {(j, y, v): (seen[j, y, v]) / (total[j, y] + 0.5) for j, y, v in like}
    return post, like


def span_classifier(counts: list[tuple[str, str, str, int]], post: dict) -> dict[tuple[str, str], float]:
    """Naive Bayes on shapes from soft labels: probability of each (kind, shape) seen.

    ``counts``: kind, votes, shape, n.
    """
    mass = defaultdict(float)
    value = defaultdict(float)
    levels = defaultdict(set)
    for kind, votes, shape, n in counts:
        for y in (0, 1):
            w = n * (post[kind, votes] if y else 1 - post[kind, votes])
            mass[kind, y] += w
            for f, x in enumerate(shape.split(",")):
                value[kind, y, f, x] += w
                levels[kind, f].add(x)
    out = {}
    for kind, shape in {(k, s) for k, _, s, _ in counts}:
        odds = math.log((mass[kind, 1] + 1) / (mass[kind, 0] + 1))
        for f, x in enumerate(shape.split(",")):
            k = len(levels[kind, f])
            odds += math.log((value[kind, 1, f, x] + 0.5) / (mass[kind, 1] + 0.5 * k))
            odds -= math.log((value[kind, 0, f, x] + 0.5) / (mass[kind, 0] + 0.5 * k))
        out[kind, shape] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
    return out


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` (start, rank, end, kind, base): base spans and accepted candidates."""
    table = cut(candidates(docs), "pii-candidates")
    seen = (table.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.shape")
            .agg(F.count(F.lit(1)).alias("n")).collect())  # votes and shapes have few values
    by_votes = defaultdict(int)
    for r in seen:
        by_votes[r["kind"], r["votes"]] += r["n"]
    post, _ = reliabilities(sorted((k, v, n) for (k, v), n in by_votes.items()))
    chance = span_classifier(sorted((r["kind"], r["votes"], r["shape"], r["n"]) for r in seen), post)
    accepted = sorted(f"{k}|{s}" for (k, s), p in chance.items() if p >= 0.5)
    ok = F.array(*[F.lit(a) for a in accepted]).cast("array<string>")
    base = F.filter("spans", lambda s: s["base"])
    likely = F.filter("spans", lambda s: ~s["base"] & F.array_contains(ok, F.concat(s["kind"], F.lit("|"), s["shape"])))
    added = let(fenced(base), lambda g: F.when(g.isNull(), likely).otherwise(
        F.filter(likely, lambda s: ~overlapped(g, s))))
    kept = F.array_sort(F.concat(base, added))
    slim = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
                                                s["kind"].alias("kind"), s["base"].alias("base")))
    return table.select("doc_id", slim.alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
