"""Approximate nearest neighbours over learned partitions.

The partitions are learned on a bounded sample: its neighbour graph is split
into parts of equal size with few cut edges, and a small classifier learns
which part a vector belongs to.  The classifier then files every vector under
its most probable part and sends every query to its several most probable
parts, where candidates are ranked by exact cosine in double precision.

Parts grow with the table, so a part's vectors are dealt into blocks of
bounded expected size; a query visits all blocks of its parts and the blocks'
best lists are merged, which gives the same result as one large block.

Defined results: vectors that are null, empty, zero, of another length than
the most common one, or that hold null or non-finite components take no part;
a query has all candidates if there are fewer than asked; equal scores go to
the smaller id; rows that repeat an id are candidates each on their own,
except the query's own id; null ids take no part; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut

#: Vectors the graph, its partition and the classifier are fitted on, at most about.
SAMPLE = 4_096
NEIGHBOURS = 10
#: Share of nearest neighbours the visited parts have to hold on the sample.
RECALL = 0.95
#: Rows of a block, on average; queries of a chunk that meet it.
BLOCK = 4_096


FOUND = "query_id long, rank int, vec_id long, score double"


@dataclass
class Router:
    """A linear classifier on unit vectors: ``parts`` scores each."""

    weights: np.ndarray  # [dim + 1, parts]

    def ranked(self, unit: np.ndarray, top: int) -> np.ndarray:
        """The ``top`` most probable parts of each vector, best first."""
        scores = unit @ self.weights[:-1] + self.weights[-1]
        return np.argsort(-scores, axis=1, kind="stable")[:, :top]


def neighbour_graph(unit: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Each row's ``k`` nearest other rows, in blocks of rows."""
    out = []
    for i in range(0, len(unit), 1024):
        sims = unit[i:i + 1024] @ unit.T
        sims[np.arange(len(sims)), i + np.arange(len(sims))] = -np.inf
        out.append(np.argsort(-sims, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_partition(graph: np.ndarray, unit: np.ndarray, parts: int,
                       rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """Parts of near equal size that keep neighbours together.

    Start: spread-out seeds, each row to the nearest seed with room.  Rounds:
    rows move to the part most of their (mutual) neighbours are in, the
    largest gains first, while the part has room.
    """
    n = len(unit)
    room = int(np.ceil(n / parts * slack))
    seeds = [0]
    near = unit @ unit[0]
    for _ in range(parts - 1):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[seeds[-1]])
    centres = unit[seeds]
    own = np.zeros(n, int)
    for _ in range(4):  # balanced assignment to centres
        sims = unit @ centres.T
        own = np.full(n, -1)
        size = np.zeros(parts, int)
        ranked = np.argsort(-sims, axis=1)
        for i in np.argsort(-sims.max(axis=1)):
            for p in ranked[i]:
                if size[p] < room:
                    own[i] = p
                    size[p] += 1
                    break
        for p in range(parts):
            if size[p]:
                c = unit[own == p].sum(axis=0)
                centres[p] = c / max(np.linalg.norm(c), 1e-12)
    left = np.repeat(np.arange(n), graph.shape[1])
    edges = np.concatenate([np.stack([left, graph.ravel()]), np.stack([graph.ravel(), left])], axis=1)
    for _ in range(rounds):
        pull = np.zeros((n, parts))
        np.add.at(pull, (edges[0], own[edges[1]]), 1.0)
        best = pull.argmax(axis=1)
        gain = pull[np.arange(n), best] - pull[np.arange(n), own]
        size = np.bincount(own, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[own[i]] -= 1
                own[i] = best[i]
                size[own[i]] += 1
                moved += 1
        if not moved:
            break
    return own


def fit_router(unit: np.ndarray, share: np.ndarray, steps: int = 150) -> Router:
    """Multinomial logistic regression from vectors to the parts' shares of their neighbours (Adam)."""
    x = np.hstack([unit, np.ones((len(unit), 1))])
    y, parts = share, share.shape[1]
    w = np.zeros((x.shape[1], parts))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = x.T @ (p - y) / len(x) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.5 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return Router(w)


def learn(vectors: np.ndarray, parts: int, recall: float = RECALL) -> tuple[Router, int]:
    """The router and the number of parts a query visits."""
    unit = unit_rows(vectors)
    if parts < 2 or len(unit) <= 2 * NEIGHBOURS:
        return Router(np.zeros((unit.shape[1] + 1, 1))), 1
    graph = neighbour_graph(unit)
    own = balanced_partition(graph, unit, parts)
    share = np.zeros((len(unit), parts))
    np.add.at(share, (np.arange(len(unit)), own), 1.0)
    for column in graph.T:
        np.add.at(share, (np.arange(len(unit)), own[column]), 1.0)
    router = fit_router(unit, share / share.sum(axis=1, keepdims=True))
    return router, probes_for(router, unit, graph, recall)


def probes_for(router: Router, unit: np.ndarray, graph: np.ndarray, recall: float) -> int:
    """The fewest parts that hold ``recall`` of the sample's own nearest neighbours.

    Neighbours in the sample are farther away than in the whole table, so the
    whole table's recall is higher.
    """
    parts = router.weights.shape[1]
    order = router.ranked(unit, parts)
    filed = order[:, 0]
    at = np.empty_like(order)
    np.put_along_axis(at, order, np.broadcast_to(np.arange(parts), order.shape), axis=1)
    nearest = np.take_along_axis(at, filed[graph[:, :5]], axis=1).ravel()
    found = np.cumsum(np.bincount(nearest, minlength=parts)) / len(nearest)
    return int(np.searchsorted(found, recall) + 1)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vec (doubles) of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<double>").alias("vec"))
    top = F.lit(float("inf"))
    fine = (v.where("vec_id is not null and vec is not null and size(vec) > 0")
            .where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < top)))
            .where(F.exists("vec", lambda x: x != 0)))
    sizes = fine.groupBy(F.size("vec").alias("dim")).count().collect()  # one row per length
    if not sizes:
        return fine.where("false")
    dim = min(sizes, key=lambda r: (-r["count"], r["dim"]))["dim"]
    return fine.where(F.size("vec") == dim)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component first, so nothing overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row; the same sums in the same order for every row."""
    dot = (rows * query).sum(axis=1)
    return dot / (np.sqrt((query * query).sum()) * np.sqrt((rows * rows).sum(axis=1)))


def best_of_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> list[tuple]:
    """Each query's ``k`` best rows of one block: (query, id, cosine)."""
    q, r = np.stack(queries["vec"].to_numpy()), np.stack(rows["vec"].to_numpy())
    ids = rows["vec_id"].to_numpy()
    near, out = unit_rows(r), []
    for i in range(0, len(q), 512):
        rough = unit_rows(q[i:i + 512]) @ near.T
        for j, own in enumerate(queries["vec_id"].to_numpy()[i:i + 512]):
            sims = rough[j]
            sims[ids == own] = -np.inf
            keep = min(k, len(sims))
            least = np.partition(sims, len(sims) - keep)[len(sims) - keep]
            at = np.flatnonzero((sims >= least - 1e-9) & (ids != own))
            # near the k-th score: exact cosines decide, then the smaller id
            if len(at) > keep:
                order = np.argsort(ids[at], kind="stable")
                at = at[order]
            exact = cosines(q[i + j], r[at])
            first = np.lexsort((ids[at], -exact))[:k]
            out += [(int(own), int(ids[at[x]]), float(exact[x])) for x in first]
    return out


def search(vectors: DataFrame, is_query, k: int = 5, parts: int | None = None,
           sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each query row."""
    spark = vectors.sparkSession
    result = "query_id long, vec_id long, score double"
    v = cut(usable(vectors), "vectors")
    n = v.count()
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    rows = v.where(draw < min(1.0, sample / max(n, 1))).select("vec").toPandas()["vec"]  # bounded
    if not len(rows):  # a tiny table can miss the draw
        rows = v.limit(1).select("vec").toPandas()["vec"]
    if not len(rows):
        return spark.createDataFrame([], FOUND)
    # finer parts for larger tables, so that a query ranks a falling share of them
    parts = parts or int(np.clip(np.sqrt(n) / 6, 1, 64))
    router, probe = learn(np.stack(rows.to_numpy()), parts)
    parts = router.weights.shape[1]
    shared = spark.sparkContext.broadcast(router)

    def route(top: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                own = shared.value.ranked(unit_rows(_matrix(b.column(1))), top)
                rep = np.repeat(np.arange(b.num_rows), own.shape[1])
                at = pa.array(rep)
                yield pa.record_batch([b.column(0).take(at), b.column(1).take(at),
                                       pa.array(own.ravel().astype(np.int32))],
                                      names=["vec_id", "vec", "part"])
        return run

    kind = "vec_id long, vec array<double>, part int"
    filed = cut(v.mapInArrow(route(1), kind), "filed")
    counts = {r["part"]: r["count"] for r in filed.groupBy("part").count().collect()}  # <= parts
    blocks = {p: max(1, -(-c // BLOCK)) for p, c in counts.items()}
    of_part = F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv])[F.col("part")]
    # repeated ids would share a block: the vector's own hash deals them out too
    block = F.pmod(F.xxhash64("vec_id", "vec", F.monotonically_increasing_id()), of_part).cast("int")
    stored = filed.select("vec_id", "vec", "part", block.alias("block"))
    asked = (v.where(is_query).mapInArrow(route(probe), kind)
             .where(F.col("part").isin(list(blocks)))
             .select("vec_id", "vec", "part",
                     F.explode(F.sequence(F.lit(0), of_part - 1)).alias("block")))

    def meet(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = best_of_block(queries, rows, k) if len(queries) and len(rows) else []
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    # a part's queries are dealt into chunks as well: (block, chunk) pairs meet
    n_chunks = max(1, -(-(n // 20) // (parts * BLOCK)))
    chunk = F.pmod(F.xxhash64("vec_id"), F.lit(n_chunks)).cast("int")
    asked = asked.withColumn("chunk", chunk)
    stored = stored.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    by = ["part", "block", "chunk"]
    found = asked.groupBy(by).cogroup(stored.groupBy(by)).applyInPandas(meet, result)
    return top_k(found, k)


def top_k(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best (score, then smaller id) of the blocks' lists, ranked from 1."""
    best = found.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("l"))
    return best.select("query_id", F.posexplode("l").alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.s")).alias("score"))
