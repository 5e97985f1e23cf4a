"""Near-duplicate vectors over an inverted multi-index.

Equal vectors are one node.  Nodes of a cell that lie within half the link
angle of a common leader form a ball; all members of a ball are linked by the
triangle inequality, so a group of copies costs its size, not its square.
Balls visit the cells nearest to their leader in multi-sequence order, as many
as the target recall needs: the number is measured on a bounded sample, with
partners made exactly at the link angle.  A pair of balls that meets is linked
as a whole, not at all, or its members are compared, each link by its cosine.

The number of centres follows the number of rows, so cells stay small; the
cells of one left centre are stored in bands, and a ball is sent once to each
band that holds some of its cells.  A pair counts for both sides if either
side visits the other, and no pair leaves a task: counts and one edge for each
node do.

Defined results: every row gives one result row.  Vectors that are null,
empty, zero, of another length than the most common one, or that hold null or
non-finite entries have no links and are their own component; equal vectors
are linked; rows that repeat an id are vectors each on their own; a component
is named by its least non-null id (null if it has none).  An empty table gives
an empty result.  Columns beside id and vector are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .ann import cosines, unit_rows
from .common import cut
from .linkage import components
from .multi_index import (Codebooks, finite, first_cells, fit, identified, matrix, same_length, renewed,
                          sampled, spread_join)

#: Share of partners exactly at the link angle that the visits have to reach, by either side.
RECALL = 0.98
#: Rows of a cell and of a band (several cells of a left centre), about; rows of one side of a task.
CELL, BAND, BLOCK = 64, 1_024, 4_096
MAX_CENTRES = 512
#: Ball radii, as shares of the largest one, that the number of visits is measured for.
LEVELS = 4
SLACK = 1e-7  # angles closer than this to a limit are decided by the cosine

BALL = "ball long, vec array<{}>, unit int, radius double, weight long, size long, visits array<int>"


def doubles(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def centres_for(n: int) -> int:
    return int(np.clip(round(np.sqrt(n / CELL)), 1, MAX_CENTRES))


class Grid:
    """Cells and bands of the product grid, and how many cells a ball visits."""

    def __init__(self, books: Codebooks, n: int, top: list[int]):
        self.books, self.top = books, top
        self.bands = int(np.clip(-(-n // (books.k * BAND)), 1, books.k))

    def unit(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return i * self.bands + j * self.bands // self.books.k

    def own(self, unit: np.ndarray) -> np.ndarray:
        return self.unit(*self.books.cells(unit))

    def visits(self, unit: np.ndarray, level: int) -> list[np.ndarray]:
        """The bands that hold the cells each row visits; its own band first of all."""
        found = self.unit(*first_cells(*self.books.distances(unit), self.top[level]))
        return [np.unique(row).astype(np.int32) for row in found]


def visits_needed(books: Codebooks, unit: np.ndarray, angle: float, recall: float, seed: int = 11) -> int:
    """The fewest cells of the multi-sequence by which ``recall`` of the partners at ``angle`` meet."""
    rng = np.random.default_rng(seed)
    side = rng.standard_normal(unit.shape)
    side -= (side * unit).sum(axis=1, keepdims=True) * unit
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
    other = np.cos(angle) * unit + np.sin(angle) * side

    def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left, right = books.distances(a)
        i, j = books.cells(b)
        at = np.arange(len(a))
        cost = left[at, i] + right[at, j]
        # cells before: for each left centre, the right centres below the rest of the cost
        right = np.sort(right, axis=1)
        return np.array([np.searchsorted(right[x], cost[x] - left[x], "left").sum() for x in at])

    meets = np.minimum(rank(unit, other), rank(other, unit))
    return int(np.sort(meets)[min(len(meets) - 1, int(np.ceil(recall * len(meets))))]) + 1


def leaders(unit: np.ndarray, radius: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Leader and largest possible angle to it of each row: a row joins the first leader within ``reach``.

    ``radius``: what a row brings along as a ball of its own; the widest balls lead first.
    """
    n = len(unit)
    own, gap = np.arange(n), radius.copy()
    near = np.zeros(n, bool)  # rows with any other one in reach
    for s in range(0, n, 1024):
        close = unit[s:s + 1024] @ unit.T >= np.cos(reach)
        near[s:s + 1024] = close.sum(axis=1) > 1
    open_ = np.flatnonzero(near)
    open_ = open_[np.argsort(-radius[open_], kind="stable")]
    while len(open_):
        lead, rest = open_[0], open_[1:]
        angle = np.arccos(np.clip(unit[rest] @ unit[lead], -1, 1)) + radius[rest]
        join = angle <= reach
        own[rest[join]] = lead
        gap[rest[join]] = angle[join] + SLACK
        open_ = rest[~join]
    return own, gap


def least_labels(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The least position that each of ``n`` positions reaches over the pairs (x, y)."""
    label = np.arange(n)
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _balls(rows: DataFrame, reach: float, name: str) -> DataFrame:
    """(old, ball, gap, unit): every row (ball, vec, unit, radius) with the ball it is part of.

    A unit's rows are dealt into blocks of bounded size, each of which makes
    its own leaders; as long as that at least halves the leaders of the units
    of several blocks, these go through again together.
    """
    def group(part: pd.DataFrame) -> pd.DataFrame:
        own, gap = leaders(unit_rows(doubles(part["vec"])), part["radius"].to_numpy(float), reach)
        ids = part["ball"].to_numpy()
        return pd.DataFrame({"old": ids, "ball": ids[own], "gap": gap, "unit": part["unit"].to_numpy()})

    size = rows.groupBy("unit").count()
    dealt = (rows.join(size, "unit")
             .withColumn("block", F.pmod(F.xxhash64("ball"), F.ceil(F.col("count") / BLOCK)).cast("int")))
    return cut(dealt.groupBy("unit", "block").applyInPandas(group, "old long, ball long, gap double, unit int"), name)


def make_balls(filed: DataFrame, reach: float) -> DataFrame:
    """node, weight, vec, unit, ball, gap of every node (node, weight, vec, unit)."""
    first = _balls(filed.select(F.col("node").alias("ball"), "vec", "unit", F.lit(0.0).alias("radius")), reach, "balls")
    ball_of = first.select(F.col("old").alias("node"), "ball", "gap")
    wide = filed.groupBy("unit").count().where(F.col("count") > BLOCK).select("unit")
    ball, turn = first, 0
    while True:
        lead = ball.join(wide, "unit", "left_semi").groupBy("ball").agg(F.max("gap").alias("radius"))
        before = lead.count()
        if before <= 1:
            break
        rows = lead.join(filed.select(F.col("node").alias("ball"), "vec", "unit"), "ball")
        ball = _balls(rows, reach, f"balls-{turn}")
        after = ball.select("ball").distinct().count()
        up = ball.select(F.col("old").alias("ball"), F.col("ball").alias("up"), F.col("gap").alias("up_gap"))
        ball_of = cut(ball_of.join(up, "ball", "left").select(
            "node", F.coalesce("up", "ball").alias("ball"), F.coalesce("up_gap", "gap").alias("gap")), f"ball-of-{turn}")
        turn += 1
        if after * 2 > before:
            break
    return cut(filed.join(ball_of, "node"), "ball-members")


def ball_rows(members: DataFrame, grid: Grid, reach: float) -> DataFrame:
    """One ``BALL`` row for each ball, with the bands that it visits."""
    sums = members.groupBy("ball").agg(F.max("gap").alias("radius"), F.sum("weight").alias("weight"),
                                       F.count(F.lit(1)).alias("size"))
    heads = members.where("node = ball").select("ball", "vec", "unit")
    names = [c.split()[0] for c in BALL.split(", ")]
    entry = members.schema["vec"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            unit = unit_rows(matrix(b.column(1)).astype(float))
            level = np.ceil(np.minimum(b.column(3).to_numpy() / reach, 1.0) * (LEVELS - 1) - 1e-9).astype(int)
            found: list = [None] * len(unit)
            for at in np.unique(level):
                where = np.flatnonzero(level == at)
                for x, row in zip(where.tolist(), grid.visits(unit[where], int(at))):
                    found[x] = row
            yield pa.record_batch([*b.columns, pa.array(found, pa.list_(pa.int32()))], names=names)

    return cut(heads.join(sums, "ball").select(*names[:-1]).mapInArrow(run, BALL.format(entry)), "ball-rows")


def compared(asked: pd.DataFrame, stored: pd.DataFrame, limit: float) -> tuple[list, list]:
    """Balls of a band against balls that visit it: (ball, n, root) rows and open pairs (a, b)."""
    angle_limit = np.arccos(limit)
    q, s = doubles(asked["vec"]), doubles(stored["vec"])
    uq, us = unit_rows(q), unit_rows(s)
    qid, sid = asked["ball"].to_numpy(), stored["ball"].to_numpy()
    rq, rs = asked["radius"].to_numpy(), stored["radius"].to_numpy()
    qn, sn = asked["size"].to_numpy(), stored["size"].to_numpy()
    home = asked["home"].to_numpy()
    ids = np.unique(np.concatenate([qid, sid]))
    count = np.zeros(len(ids), np.int64)
    at_q, at_s = np.searchsorted(ids, qid), np.searchsorted(ids, sid)
    visits = stored["visits"].to_numpy()
    wide = int(max(home.max(), max(v.max() for v in visits))) + 1
    visited = np.repeat(np.arange(len(s)), [len(v) for v in visits]) * wide + np.concatenate(visits)
    edges, open_ = [], []
    for i in range(0, len(q), 512):
        cos = uq[i:i + 512] @ us.T
        reach = angle_limit + rq[i:i + 512, None] + rs[None]
        x, y = np.nonzero(cos >= np.cos(np.minimum(reach, np.pi)) - SLACK)
        x += i
        keep = qid[x] != sid[y]
        x, y = x[keep], y[keep]
        if not len(x):
            continue
        angle = np.arccos(np.clip(cos[x - i, y], -1, 1))
        single = (qn[x] == 1) & (sn[y] == 1)
        linked = angle + rq[x] + rs[y] <= angle_limit - SLACK
        # near the limit single vectors are decided by the cosine of the vectors as given
        for k in np.flatnonzero(single & (np.abs(angle - angle_limit) <= 1e-3)):
            linked[k] = cosines(q[x[k]], s[y[k]][None])[0] >= limit
        back = np.isin(y * wide + home[x], visited)  # the stored ball visits the asking one's band as well
        undecided = ~single & ~linked
        once = undecided & (~back | (qid[x] < sid[y]))
        open_ += list(zip(qid[x[once]].tolist(), sid[y[once]].tolist()))
        x, y, back = x[linked], y[linked], back[linked]
        np.add.at(count, at_q[x], stored["weight"].to_numpy()[y])
        np.add.at(count, at_s[y[~back]], asked["weight"].to_numpy()[x[~back]])
        edges.append(np.stack([at_q[x], at_s[y]]))
    pairs = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), int)
    root = ids[least_labels(pairs[0], pairs[1], len(ids))]
    hit = (count > 0) | (root != ids)
    return list(zip(ids[hit].tolist(), count[hit].tolist(), root[hit].tolist())), open_


def meetings(balls: DataFrame, limit: float) -> DataFrame:
    """(kind, a, n, b): kind 0 a ball's count and root of one task, kind 1 a pair of balls to open."""
    schema = "kind int, a long, n long, b long"
    asked = balls.select("ball", "vec", F.col("unit").alias("home"), "radius", "weight", "size",
                         F.explode("visits").alias("unit"))
    # a few numbers per band, of which there are at most MAX_CENTRES squared
    width = (balls.groupBy("unit").agg(F.count(F.lit(1)).alias("stored"))
             .join(balls.select(F.explode("visits").alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("asked")),
                   "unit")
             .select("unit", F.ceil(F.col("stored") / BLOCK).cast("int").alias("blocks"),
                     F.ceil(F.col("asked") / BLOCK).cast("int").alias("chunks")))
    width = F.broadcast(cut(width, "band-widths"))
    dealt = lambda n: F.pmod(F.xxhash64("ball"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = asked.join(width, "unit").withColumn("chunk", dealt("chunks")).withColumn("block", every("blocks"))
    stored = renewed(balls.join(width, "unit").withColumn("block", dealt("blocks"))
                     .withColumn("chunk", every("chunks")))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows, pairs = compared(left, right, limit) if len(left) and len(right) else ([], [])
        return pd.DataFrame([(0, *r) for r in rows] + [(1, a, 0, b) for a, b in pairs], columns=["kind", "a", "n", "b"])

    by = ["unit", "block", "chunk"]
    return cut(asked.groupBy(by).cogroup(stored.groupBy(by)).applyInPandas(meet, schema), "ball-meetings")


def opened(pairs: DataFrame, balls: DataFrame, members: DataFrame, limit: float) -> DataFrame:
    """(kind, node, n, b): kind 2 a node's links in one task, kind 3 an edge between balls.

    Of each pair (a, b) the larger ball is cut into blocks; the members of all
    its partners come to each block, in chunks, so a large ball with many
    partners is read once for each chunk and not once for each partner.
    """
    size = balls.select("ball", "size")
    p = (pairs.join(size.withColumnRenamed("size", "sa").withColumnRenamed("ball", "a"), "a")
         .join(size.withColumnRenamed("size", "sb").withColumnRenamed("ball", "b"), "b"))
    swap = F.col("sa") > F.col("sb")
    p = p.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("small"),
                 F.when(swap, F.col("a")).otherwise(F.col("b")).alias("big"),
                 F.least("sa", "sb").alias("n_small"), F.greatest("sa", "sb").alias("n_big"))
    p = cut(p, "open-pairs")
    width = p.groupBy("big").agg(F.ceil(F.first("n_big") / BLOCK).cast("int").alias("blocks"),
                                 F.ceil(F.sum("n_small") / BLOCK).cast("int").alias("chunks"))
    dealt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    member = members.select("node", "vec", "weight", "ball")
    left = (p.select("small", "big").join(member.withColumnRenamed("ball", "small"), "small").join(width, "big")
            .withColumn("chunk", dealt("chunks")).withColumn("block", every("blocks")))
    right = renewed(member.withColumnRenamed("ball", "big").join(width, "big")
                    .withColumn("block", dealt("blocks")).withColumn("chunk", every("chunks")))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        if len(a) and len(b):
            va, vb = doubles(a["vec"]), doubles(b["vec"])
            ub, wa, wb = unit_rows(vb), a["weight"].to_numpy(), b["weight"].to_numpy()
            ids_a, ids_b, small = a["node"].to_numpy(), b["node"].to_numpy(), a["small"].to_numpy()
            count = np.zeros(len(b), np.int64)
            touched = set()
            for i in range(0, len(va), 512):
                cos = unit_rows(va[i:i + 512]) @ ub.T
                x, y = np.nonzero(np.abs(cos - limit) <= 1e-9)
                hit = cos >= limit
                for r, c in zip(x.tolist(), y.tolist()):
                    hit[r, c] = cosines(va[i + r], vb[c][None])[0] >= limit
                count += (hit * wa[i:i + 512, None]).sum(axis=0)
                n = hit @ wb
                some = np.flatnonzero(n)
                touched.update(small[i + some].tolist())
                out += [(2, int(ids_a[i + r]), int(n[r]), 0) for r in some]
            out += [(2, int(ids_b[c]), int(count[c]), 0) for c in np.flatnonzero(count)]
            out += [(3, int(t), 0, int(b["big"].iat[0])) for t in sorted(touched)]
        return pd.DataFrame(out, columns=["kind", "a", "n", "b"])

    by = ["big", "block", "chunk"]
    return cut(left.groupBy(by).cogroup(right.groupBy(by)).applyInPandas(meet, "kind int, a long, n long, b long"),
               "opened-balls")


def linked_vectors(vectors: DataFrame, limit: float = 0.9, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row; links are pairs with a cosine of ``limit`` or more."""
    # entries travel as they came (float or double) and are compared as doubles
    entry = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = identified(vectors, "link-rows", F.col("vec_id").cast("long").alias("vec_id"),
                      F.col("embedding").cast(f"array<{entry}>").alias("vec"))
    fine = same_length(rows.where(finite("vec")).where(F.exists("vec", lambda x: x != 0)), "vec")
    nodes = cut(fine.groupBy("vec").agg(F.min("uid").alias("node"), F.count(F.lit(1)).alias("weight"),
                                        F.min("vec_id").alias("least")), "link-nodes")
    n = nodes.count()
    lone = ["vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept")]
    if not n:
        return rows.select(*lone)
    reach = float(np.arccos(limit)) / 2 - 2 * SLACK
    sample = unit_rows(sampled(nodes.withColumnRenamed("node", "uid"), n, "vec"))
    books = fit(sample, centres_for(n))
    probe = sample[:2_048]
    grid = Grid(books, n, [visits_needed(books, probe, np.arccos(limit) + reach * lv / (LEVELS - 1), recall)
                           for lv in range(LEVELS)])

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own = grid.own(unit_rows(matrix(b.column(2)).astype(float))).astype(np.int32)
                yield pa.record_batch([*b.columns, pa.array(own)], names=["node", "weight", "vec", "unit"])

    filed = cut(nodes.select("node", "weight", "vec").mapInArrow(
        file, f"node long, weight long, vec array<{entry}>, unit int"), "link-filed")
    members = make_balls(filed, reach)
    balls = ball_rows(members, grid, reach)
    met = meetings(balls, limit)
    pairs = met.where("kind = 1").select("a", "b")
    deep = opened(pairs, balls, members, limit)
    ball_links = met.where("kind = 0").groupBy("a").agg(F.sum("n").alias("ball_links"))
    node_links = deep.where("kind = 2").groupBy("a").agg(F.sum("n").alias("node_links"))
    edges = met.where("kind = 0 and a <> b").select("a", "b").union(deep.where("kind = 3").select("a", "b"))
    roots = components(edges, "link-components")
    # per ball: links beyond it, its component, its size (for hot balls)
    about = (balls.select("ball", F.col("weight").alias("ball_weight"), "size")
             .join(ball_links.withColumnRenamed("a", "ball"), "ball", "left")
             .join(roots.withColumnRenamed("node", "ball"), "ball", "left")
             .select("ball", "size", F.coalesce("root", "ball").alias("root"),
                     (F.col("ball_weight") - 1 + F.coalesce("ball_links", F.lit(0))).alias("ball_links")))
    member = (members.select("node", "ball").join(nodes.select("node", "vec", "weight", "least"), "node")
              .join(node_links.withColumnRenamed("a", "node"), "node", "left"))
    placed = cut(spread_join(member, cut(about, "ball-about"), "ball", "size", n), "link-placed")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
    named = spread_join(placed, cut(least, "link-least"), "root", "nodes", n).select(
        "vec", "weight", (F.col("ball_links") + F.coalesce("node_links", F.lit(0))).alias("n_links"), "component_id")
    total = rows.count()
    done = spread_join(fine, cut(named, "link-named"), "vec", "weight", total).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return done.unionByName(rows.join(fine.select("uid"), "uid", "left_anti").select(*lone))
