"""Hard negatives by an inverted multi-index with certified windows.

A row's score is its integer inner product with an anchor.  No row of a cell
(i, j) scores above  <a1, c_i> + |a1| r_i + <a2, d_j> + |a2| r_j , where c_i, d_j
are the half centres and r_i, r_j the largest distances of filed rows to them.
A heap visits the cells of an anchor by falling bound, a growing number of rows
in each round, and an anchor stops as soon as no unvisited cell can change its
answer: first for its positives, then for the windows below each of them.  So
the result is exact whatever the codebooks are.

Rounds only carry anchors, their next cells and the best rows so far; cells of
many rows are searched in blocks, cells of many anchors in chunks.

Defined results: rows with a null id or label, or whose vector is null, empty,
holds null or non-finite entries, is not of the most common length (of equally
common ones the least) or has an entry whose integer is 2**23 or more take no
part; equal scores go to the smaller id; rows that repeat an id are candidates
and anchors each on their own; an anchor without positives, and a window
without rows, give no row.  A positive score below zero has an empty window.
An empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut
from .multi_index import (Codebooks, finite, fit, identified, matrix, multi_sequence, renewed, same_length, sampled)

#: Products of two entries below this, summed over up to 2**10 entries, times 100 fit 64 bits.
ENTRY_LIMIT = float(1 << 23)
#: Rows of a cell, on average; rows and anchors that meet in one task; centres of a codebook at most.
CELL, BLOCK, MAX_CENTRES = 1_024, 4_096, 128
#: Rows an anchor looks at in its first round; each later round takes GROWTH times as many.
FIRST, GROWTH = 8_192, 4

MINED = ("anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, "
         "positive_score long, negative_score long")


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in floating point where all sums stay below 2**53."""
    most = int(np.abs(anchors).max(initial=0)) * int(np.abs(rows).max(initial=0)) * anchors.shape[1]
    if most < 1 << 53:
        return (anchors.astype(float) @ rows.T.astype(float)).astype(np.int64)
    return anchors @ rows.T


def best_rows(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best: higher score, then smaller id."""
    if len(score) > 4 * k:  # all rows at or above the k-th score
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return at[np.lexsort((ids[at], -score[at]))[:k]]
    return np.lexsort((ids, -score))[:k]


class Bounds:
    """Codebooks with the largest distance of any filed row to each half centre, and the rows of each cell."""

    def __init__(self, books: Codebooks, cells: pd.DataFrame):
        k = books.k
        self.books, self.rows = books, np.zeros((k, k), np.int64)
        self.left, self.right = np.zeros(k), np.zeros(k)
        i, j = cells["cell"].to_numpy() // k, cells["cell"].to_numpy() % k
        self.rows[i, j] = cells["n"]
        # rounding of distances and products: a relative allowance far above it
        np.maximum.at(self.left, i, cells["left"].to_numpy() * (1 + 1e-9))
        np.maximum.at(self.right, j, cells["right"].to_numpy() * (1 + 1e-9))

    def halves(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Negated bounds of both halves' scores, for the multi-sequence to take the least first."""
        a, b = anchor[:self.books.half].astype(float), anchor[self.books.half:].astype(float)
        left = self.books.left @ a + np.linalg.norm(a) * self.left
        right = self.books.right @ b + np.linalg.norm(b) * self.right
        slack = 1e-9 * (np.abs(left).max() + np.abs(right).max()) + 1e-6
        return -left - slack, -right

    def visit(self, anchor: np.ndarray, done: int, need: float, budget: int) -> tuple[list[int], int, float]:
        """The next non-empty cells after ``done`` steps: until ``budget`` rows, or the bound falls below ``need``.

        Returns the cells, the steps taken in all and the bound of the next
        cell (minus infinity if there is none).
        """
        cells, rows, step = [], 0, 0
        for i, j, cost in multi_sequence(*self.halves(anchor)):
            if step >= done:
                if rows >= budget or -cost < need:
                    return cells, step, -cost
                if self.rows[i, j]:
                    cells.append(i * self.books.k + j)
                    rows += int(self.rows[i, j])
            step += 1
        return cells, step, float("-inf")


def integer_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """uid, vec_id, x and label of the rows that take part, x the entries as floor(scale * c)."""
    v = identified(vectors, "mine-rows", F.col("vec_id").cast("long").alias("vec_id"),
                   F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("long").alias("label"))
    v = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("vec", ENTRY_LIMIT / scale))
    return same_length(v, "vec").select(
        "uid", "vec_id", F.transform("vec", lambda c: F.floor(c * scale).cast("long")).alias("x"), "label")


def rounds(anchors: DataFrame, stored: DataFrame, bounds: Bounds, found_in, keep: int, need_of, name: str) -> DataFrame:
    """The certified best rows (uid, slot, vec_id, score) of every anchor (uid, x, label, windows).

    ``found_in(anchor label and windows, scores, ids, labels)`` gives the slots,
    ids and scores of a block that count; of each (uid, slot) the ``keep`` best
    stay.  ``need_of(best)`` is (uid, need): the least score that can still
    change the anchor's answer; without a row there every score can.
    """
    spark = anchors.sparkSession
    found_kind = "uid long, slot int, vec_id long, score long"
    shared = spark.sparkContext.broadcast(bounds)
    k = bounds.books.k
    width = F.broadcast(cut(stored.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")),
                            f"{name}-widths"))  # at most MAX_CENTRES squared rows
    blocks = stored.join(width, "cell").withColumn("block", F.pmod(F.xxhash64("uid"), "blocks").cast("int"))

    def plan(budget: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x, done, need = matrix(b.column(1)), b.column(2).to_numpy(), b.column(3).to_numpy()
                out = [shared.value.visit(x[r], int(done[r]), float(need[r]), budget) for r in range(len(x))]
                yield pa.record_batch([b.column(0), pa.array([c for c, _, _ in out], pa.list_(pa.int32())),
                                       pa.array([s for _, s, _ in out], pa.int32()),
                                       pa.array([v for _, _, v in out], pa.float64())],
                                      names=["uid", "cells", "done", "bound"])
        return run

    def meet(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        if len(asked) and len(rows):
            x, ids, labels = np.stack(rows["x"].to_numpy()), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            uids, uid = rows["uid"].to_numpy(), asked["uid"].to_numpy()
            for i in range(0, len(asked), 256):
                part = asked.iloc[i:i + 256]
                score = scores(np.stack(part["x"].to_numpy()), x)
                for r, (label, windows) in enumerate(zip(part["label"], part["windows"])):
                    for slot, at in found_in(label, windows, score[r], ids, labels, uids != uid[i + r]):
                        out += [(int(uid[i + r]), slot, int(ids[p]), int(score[r][p])) for p in at]
        return pd.DataFrame(out, columns=["uid", "slot", "vec_id", "score"])

    state = anchors.select("uid", F.lit(0).alias("done"), F.lit(float("-inf")).alias("need"))
    best = spark.createDataFrame([], found_kind)
    budget, turn = FIRST, 0
    while True:
        todo = anchors.select("uid", "x").join(state, "uid").select("uid", "x", "done", "need")
        steps = cut(todo.mapInArrow(plan(budget), "uid long, cells array<int>, done int, bound double"),
                    f"{name}-steps-{turn}")
        asked = steps.select("uid", F.explode("cells").alias("cell")).join(
            anchors.select("uid", "x", "label", "windows"), "uid")
        crowd = F.broadcast(cut(steps.select(F.explode("cells").alias("cell")).groupBy("cell").agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks")), f"{name}-crowd-{turn}"))
        left = (asked.join(width, "cell").join(crowd, "cell")
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumn("chunk", F.pmod(F.xxhash64("uid"), "chunks").cast("int")))
        right = renewed(blocks.join(crowd, "cell")
                        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
        by = ["cell", "block", "chunk"]
        hits = left.groupBy(by).cogroup(right.groupBy(by)).applyInPandas(meet, found_kind)
        ranked = hits.union(best).groupBy("uid", "slot").agg(F.slice(F.array_sort(F.collect_list(
            F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, keep).alias("l"))
        best = cut(ranked.select("uid", "slot", F.explode("l").alias("hit")).select(
            "uid", "slot", F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score")), f"{name}-best-{turn}")
        # a cell whose bound equals the need can hold an equal score with a smaller id
        state = (steps.join(need_of(best), "uid", "left")
                 .select("uid", "done", F.coalesce("need", F.lit(float("-inf"))).alias("need"), "bound")
                 .where("bound >= need and bound > double('-infinity')").drop("bound"))
        state = cut(state, f"{name}-state-{turn}")
        if not state.limit(1).count():
            return best
        budget, turn = budget * GROWTH, turn + 1


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, scale: int = 256,
         low: int = 80, high: int = 100) -> DataFrame:
    """``MINED`` rows: for each anchor and each of its ``positives`` best rows of its label, the first ``negatives``
    rows of other labels with  low * positive_score <= 100 * negative_score <= high * positive_score."""
    spark = vectors.sparkSession
    rows = cut(integer_rows(vectors, scale), "mine-integers")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], MINED)
    books = fit(sampled(rows, n, "x"), int(np.clip(round(np.sqrt(n / CELL)), 1, MAX_CENTRES)))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(2)).astype(float)
            i, j = books.cells(x)
            left = np.linalg.norm(x[:, :books.half] - books.left[i], axis=1)
            right = np.linalg.norm(x[:, books.half:] - books.right[j], axis=1)
            yield pa.record_batch([*b.columns, pa.array((i * books.k + j).astype(np.int32)), pa.array(left),
                                   pa.array(right)],
                                  names=["uid", "vec_id", "x", "label", "cell", "left", "right"])

    stored = cut(rows.mapInArrow(file, "uid long, vec_id long, x array<long>, label long, cell int, "
                                       "left double, right double"), "mine-filed")
    cells = stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("left").alias("left"),
                                       F.max("right").alias("right")).toPandas()  # at most MAX_CENTRES squared
    bounds = Bounds(books, cells)
    stored = stored.drop("left", "right")
    asked = rows.where(is_anchor)

    def same_label(label, windows, score, ids, labels, other):
        at = np.flatnonzero((labels == label) & other)
        yield 0, at[best_rows(ids[at], score[at], positives)]

    def in_windows(label, windows, score, ids, labels, other):
        least = int(np.min(windows))
        at = np.flatnonzero((labels != label) & (100 * score >= low * least))
        at = at[np.lexsort((ids[at], -score[at]))]
        falling = -100 * score[at]
        for slot, own in enumerate(windows.tolist()):
            first, end = np.searchsorted(falling, -high * own, "left"), np.searchsorted(falling, -low * own, "right")
            yield slot, at[first:max(first, min(end, first + negatives))]

    def need_positive(best: DataFrame) -> DataFrame:
        return best.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(
            F.col("n") >= positives).select("uid", F.col("s").cast("double").alias("need"))

    anchors = cut(asked.select("uid", "vec_id", "x", "label", F.array().cast("array<long>").alias("windows")),
                  "mine-anchors")
    pos = rounds(anchors, stored, bounds, same_label, positives, need_positive, "positives")
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")))
    pos = cut(pos.groupBy("uid").agg(ranked.alias("l")).select(
        "uid", F.transform("l", lambda r: -r["s"]).alias("windows"), F.transform("l", lambda r: r["vec_id"]).alias("ids")),
        "mine-positives")
    asking = cut(anchors.drop("windows").join(pos.select("uid", "windows"), "uid"), "mine-windows")

    def need_negative(best: DataFrame) -> DataFrame:
        full = best.groupBy("uid", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
        windows = asking.select("uid", F.posexplode("windows").alias("slot", "own"))
        ends = F.col("own") * low / F.lit(100.0)
        return (windows.join(full, ["uid", "slot"], "left")
                .select("uid", F.when(F.col("n") >= negatives, F.col("s").cast("double")).otherwise(ends).alias("need"))
                .groupBy("uid").agg((F.min("need") - 1e-6).alias("need")))

    neg = rounds(asking, stored, bounds, in_windows, negatives, need_negative, "negatives")
    listed = neg.groupBy("uid", "slot").agg(ranked.alias("l")).select(
        "uid", "slot", F.posexplode("l").alias("rank", "hit"))
    at = F.col("slot")
    return (listed.join(pos, "uid").join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
            .select("anchor_id", F.get("ids", at).alias("positive_id"), (at + 1).alias("positive_rank"),
                    (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("negative_id"),
                    F.get("windows", at).alias("positive_score"), (-F.col("hit.s")).alias("negative_score")))
