"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a target number of words.  Whole passes over the source
come first; what is left of the budget is fitted per source on the counts of
its documents by exact length: a proportional share of each length, then a
bounded knapsack (dynamic programming over a bit set of reachable sums) picks
how many documents of each length bring the sum nearest the target.  Which
documents of a length are taken is a seeded order.  Only (source, length)
counts meet per source, never its rows.

Defined results: a null text has size 0; documents of size 0 are never taken;
null is a source of its own, ordered last; sources without words get target
0; repeated rows are separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import cut, grouped_rank, row_key, tie_range

#: Word separators are \x20 and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
#: Budget from which the knapsack runs, in words: bounds the width of its bit set.
WINDOW = 65_536
#: (source, length) pairs whose plan goes to every task, at most.
FEW = 1 << 17


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple = (1, 2, 3), cap: int = 3) -> DataFrame:
    """One row per source: source, sid, source_size, target.

    The cap fixpoint is a water level: the target is ``level * weight`` or the
    cap.  Each step adds up one row and raises the level, until no further
    source reaches its cap.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]),
                          (F.col("sid") % len(cycle) + 1).cast("int"))
    totals = cut(totals.withColumn("sid", F.row_number().over(order) - 1)
                 .withColumn("weight", weight), "sources")
    full = F.col("source_size") * float(cap)
    level = 0.0
    total = totals.agg(F.sum("source_size")).first()[0] or 0
    while True:
        over = full < F.lit(level) * F.col("weight")
        capped, rest = totals.agg(F.sum(F.when(over, full).otherwise(0.0)),
                                  F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        new = (total - (capped or 0.0)) / rest if rest else level
        if new <= level:
            break
        level = new
    target = F.least(full, F.lit(level) * F.col("weight"))
    return totals.select("source", "sid", "source_size", target.alias("target"))


def fit(lengths: list[tuple[int, int]], budget: int, total: int) -> dict[int, int]:
    """How many documents of each length to take so that their words come nearest ``budget``.

    ``lengths``: (length, documents) in seeded order; ``total``: their words.
    """
    take = {n: c * budget // total for n, c in lengths}
    left = budget - sum(n * c for n, c in take.items())
    for n, c in lengths:  # one more of some lengths, until the knapsack's window
        if left <= WINDOW:
            break
        if take[n] < c and n <= left:
            take[n] += 1
            left -= n
    width = 2 * left + 1  # sums above the budget may be nearer than those below
    mask, reach, steps = (1 << width) - 1, 1, []
    for n, c in lengths:
        free, k = min(c - take[n], width // n), 1
        while free > 0 and not reach >> left & 1:
            k = min(k, free)
            steps.append((n, k, reach))
            reach |= reach << (n * k) & mask
            free -= k
            k *= 2
    at = next(s for d in range(left + 1) for s in (left - d, left + d) if reach >> s & 1)
    for n, k, before in reversed(steps):
        if not before >> at & 1:
            take[n] += k
            at -= n * k
    return take


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["order", "size"])
    words = int(pdf["words"].iloc[0])
    target = float(pdf["target"].iloc[0])
    passes = min(math.floor(target / words), int(pdf["cap"].iloc[0]))
    budget = round(target - passes * words)
    rows = [(int(n), int(c)) for n, c in zip(pdf["size"], pdf["docs"])]
    extra = fit(rows, budget, words) if 0 < budget else {}
    return pd.DataFrame({"sid": pdf["sid"], "size": pdf["size"], "passes": passes,
                         "extra": [extra.get(n, 0) for n, _ in rows]})


def planned(sized: DataFrame, targets: DataFrame, cap: int, seed: int) -> DataFrame:
    """sid, size, and how often all documents of that size are taken (passes) and how many once more (extra)."""
    counts = (sized.where("size > 0").groupBy("sid", "size")
              .agg(F.count(F.lit(1)).alias("docs"))
              .join(targets.select("sid", "target", F.col("source_size").alias("words")), "sid")
              .withColumn("order", F.xxhash64(F.lit(seed), "sid", "size"))
              .withColumn("cap", F.lit(cap)))
    return cut(counts.groupBy("sid").applyInPandas(
        _fit_source, "sid int, size long, passes int, extra long"), "mix-plan")


def mix(docs: DataFrame, payload: list[str], cycle: tuple = (1, 2, 3), cap: int = 3,
        seed: int = 7) -> DataFrame:
    """Documents with size, source_size, target and ``repeats`` (0 to ``cap``).

    ``docs`` has ``doc_id``, ``source``, ``size`` (words) and ``tie`` (long,
    from the row's content), plus the ``payload`` columns that are carried.
    """
    targets = source_targets(docs.select("source", "size"), cycle, cap)
    sized = (docs.join(targets, docs["source"].eqNullSafe(targets["source"]))
             .select(*[docs[c] for c in ("size", "tie", *payload)],
                     "sid", "source_size", "target"))
    ranked = grouped_rank(sized.withColumn("tie", F.xxhash64(F.lit(seed), "tie")),
                          ["sid", "size"], "tie", "nth")
    repeats = F.coalesce(F.col("passes") + (F.col("nth") < F.col("extra")).cast("int"), F.lit(0))
    return (ranked.join(planned(sized, targets, cap, seed), ["sid", "size"], "left")
            .select(*payload, "size", "source_size", "target", repeats.alias("repeats")))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and tie of each document: what the mix is decided on."""
    return docs.select("doc_id", "source", word_count("text").alias("size"),
                       row_key(F.col("doc_id"), F.col("text")).alias("tie"))


def mixed_documents(docs: DataFrame, cycle: tuple = (1, 2, 3), cap: int = 3, seed: int = 7) -> DataFrame:
    """The mix itself: every taken document as often as ``mix`` takes it, columns unchanged.

    Ranks are found on rows without texts.  Of a source and length they come
    down to the last tie value that is taken once more, so texts stay where
    they are; only rows that share this value with others, of which not all
    are taken, are numbered.
    """
    tie = F.xxhash64(F.lit(seed), "tie")
    m = cut(measured(docs).select("source", "size", tie.alias("tie")), "mix-sizes")
    targets = cut(source_targets(m, cycle, cap), "mix-targets")
    own = targets.select(F.col("source").alias("of"), "sid")
    sized = m.where("size > 0").join(own, F.col("source").eqNullSafe(F.col("of"))).select("sid", "size", "tie")
    plan = planned(sized, targets, cap, seed)
    ranked = grouped_rank(sized, ["sid", "size"], "tie", "nth").join(plan.where("extra > 0"), ["sid", "size"])
    last = (ranked.groupBy("sid", "size", tie_range("tie").alias("part"), "tie")
            .agg(F.count_if(F.col("nth") < F.col("extra")).alias("need"), F.count(F.lit(1)).alias("same"))
            .where("need > 0").groupBy("sid", "size").agg(F.max(F.struct("part", "tie", "need", "same")).alias("last")))
    plan = cut(plan.drop("extra").join(last, ["sid", "size"], "left"), "mix-last")

    d = docs.select(F.struct("*").alias("row"), F.col("source").alias("from"), word_count("text").alias("size"),
                    row_key(F.col("doc_id"), F.col("text")).alias("tie")).withColumn("tie", tie)
    d = (d.join(own, F.col("from").eqNullSafe(F.col("of")))
         .join(F.broadcast(plan) if plan.count() <= FEW else plan, ["sid", "size"]))
    at, end = F.struct(tie_range("tie"), "tie"), F.struct("last.part", "last.tie")
    some = F.coalesce((at == end) & (F.col("last.need") < F.col("last.same")), F.lit(False))
    taken = d.where(~some).select("row", (F.col("passes") + F.coalesce(at <= end, F.lit(False)).cast("int")).alias("repeats"))
    if plan.where("last.need < last.same").limit(1).count():
        nth = F.row_number().over(W.partitionBy("sid", "size", "tie").orderBy(F.lit(0)))
        taken = taken.union(d.where(some).withColumn("nth", nth).select(
            "row", (F.col("passes") + (F.col("nth") <= F.col("last.need")).cast("int")).alias("repeats")))
    return (taken.where("repeats > 0").select("row", F.explode(F.sequence(F.lit(1), "repeats")).alias("copy"))
            .select("row.*"))
