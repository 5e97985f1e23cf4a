"""From shared keys to groups, without all pairs of a key.

Rows (key, node) say which nodes may be linked.  First every node of a key is
paired with the key's least node only; pairs that pass a bound form clusters.
Keys whose nodes still lie in several clusters are searched once more for
pairs of different clusters; from a large key only a spanning forest of the
pairs that pass the bound is kept.  Two nodes that are linked pass the bound,
so they end in one cluster: links are then verified within clusters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, shuffle_width

#: Keys of up to this many nodes give all pairs of different clusters (at most SMALL / 2 a row).
SMALL = 16
#: Rows of one side when a larger group is searched; larger groups become pairs of chunks.
CHUNK = 4_000
#: Bits of the set that spares nodes of no interest a shuffle (any size gives the same result).
SIEVE = 1 << 22
#: Nodes that are broadcast, at most.
FEW = 1 << 20


def stars(keyed: DataFrame, name: str) -> DataFrame:
    """(key, rep, node): for keys of several nodes, each node but the least with the least."""
    schema = pa.schema([("key", pa.int64()), ("rep", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_rep = last_node = None
        for b in batches:
            if not b.num_rows:
                continue
            key, node = b.column(0).to_numpy(), b.column(1).to_numpy()
            fresh = np.ones(len(key), bool)
            fresh[1:] = key[1:] != key[:-1]
            fresh[0] = last_key is None or key[0] != last_key
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), -1))
            rep = np.where(start >= 0, node[start], 0 if last_rep is None else last_rep)
            before = np.empty_like(node)
            before[1:], before[0] = node[:-1], node[0] if last_node is None else last_node
            keep = ~fresh & (node != before) & (node != rep)
            last_key, last_rep, last_node = key[-1], rep[-1], node[-1]
            if keep.any():
                yield pa.record_batch([pa.array(x[keep]) for x in (key, rep, node)], schema=schema)

    dealt = (keyed.select("key", "node").repartition(shuffle_width(keyed.sparkSession), "key")
             .sortWithinPartitions("key", "node"))
    return cut(dealt.mapInArrow(run, "key long, rep long, node long"), name)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); the root is the component's least node.

    Alternating large-star and small-star steps: edges are rewired to ever
    smaller neighbours until only stars are left.  Minima are combined before
    the shuffle, and every step is cut to the shared folder.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    def mark_of(edges):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = cut(e, name)
    mark = mark_of(e)
    while mark[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        e = cut(small.select("x.a", "x.b").where("a <> b").distinct(), name)
        now = mark_of(e)
        if now == mark:
            break
        mark = now
    roots = e.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def sieve(nodes: DataFrame) -> np.ndarray:
    """A bit per residue that some node has: at most ``SIEVE`` numbers reach the driver."""
    bits = nodes.select(F.pmod("node", F.lit(SIEVE)).cast("int").alias("i")).distinct().toPandas()["i"]
    found = np.zeros(SIEVE, bool)
    found[bits.to_numpy()] = True
    return np.packbits(found)


def sifted(bits: np.ndarray, node: np.ndarray) -> np.ndarray:
    at = np.mod(node, SIEVE)
    return (bits[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)


def few(nodes: DataFrame) -> DataFrame:
    """``nodes`` (read from files), marked to go to every task while there are at most ``FEW``."""
    return F.broadcast(nodes) if nodes.count() <= FEW else nodes


def open_keys(multi: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """(key, node, root, size) of all nodes of keys that hold several components; size: nodes of the key.

    A key of two nodes is left out: its only pair has been looked at.
    """
    roots = few(roots)
    rep = roots.select(F.col("node").alias("rep"), F.col("root").alias("rep_root"))
    m = (multi.join(roots, "node", "left").join(rep, "rep", "left")
         .select("key", "rep", "node", F.coalesce("root", "node").alias("root"),
                 F.coalesce("rep_root", "rep").alias("rep_root")))
    # a key has one rep
    mixed = (m.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("rep"),
                                  F.min("rep_root").alias("rep_root"),
                                  F.max((F.col("root") != F.col("rep_root")).cast("int")).alias("mixed"))
             .where("n > 1 and mixed = 1").select("key", "rep", "rep_root", (F.col("n") + 1).alias("size")))
    mixed = cut(mixed, f"{name}-mixed")
    reps = mixed.select("key", F.col("rep").alias("node"), F.col("rep_root").alias("root"), "size")
    return m.select("key", "node", "root").join(mixed.select("key", "size"), "key").union(reps)


def small_pairs(members: DataFrame) -> DataFrame:
    """(a, b) of different roots for keys of at most SMALL nodes (key, node, root, size)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    dealt = (members.where(F.col("size") <= SMALL).select("key", "node", "root")
             .repartition(shuffle_width(members.sparkSession), "key").sortWithinPartitions("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)  # the last rows may belong to the next batch's first key
        for b in batches:
            rows = np.concatenate([held, np.stack([c.to_numpy() for c in b.columns])], axis=1)
            found = []
            for d in range(1, SMALL):
                key, node, root = rows[:, d:]
                near = (key == rows[0, :-d]) & (root != rows[2, :-d]) & (np.arange(len(key)) + d >= held.shape[1])
                if near.any():
                    found.append(np.stack([node[near], rows[1, :-d][near]]))
            held = rows[:, -SMALL:]
            if found:
                x = np.concatenate(found, axis=1)
                x = np.unique(np.stack([x.max(axis=0), x.min(axis=0)]), axis=1)
                yield pa.record_batch([pa.array(x[0]), pa.array(x[1])], schema=schema)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def chunk_pairs(members: DataFrame, group: str, size: str) -> DataFrame:
    """Rows dealt so that any two rows of a group meet in one part (group, i, j) of two chunks at most."""
    m = (members.withColumn("chunks", F.ceil(F.col(size) / CHUNK).cast("int"))
         .withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
         .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
         .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
         .drop("chunks", "other", size))
    return (m.repartition(shuffle_width(members.sparkSession), group, "i", "j")
            .sortWithinPartitions(group, "i", "j"))


def forest(a: np.ndarray, b: np.ndarray, root: dict) -> list[tuple[int, int]]:
    """The pairs (a, b) that join two trees; ``root`` holds the trees and is kept up."""

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        u, v = find(x), find(y)
        if u != v:
            root[max(u, v)] = min(u, v)
            out.append((max(x, y), min(x, y)))
    return out


def search_parts(dealt: DataFrame, group: str, search: Callable[[pd.DataFrame], list], columns: str) -> DataFrame:
    """``search`` each part of ``chunk_pairs``; it returns tuples of ``columns``."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of the open part: two chunks at most
        last = None
        for f in frames:
            if not len(f):
                continue
            k = f[[group, "i", "j"]].to_numpy()
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(f)]
            out = []
            for s, e in zip(cuts, cuts[1:]):
                now = tuple(k[s])
                if held and now != last:
                    out += search(pd.concat(held, ignore_index=True))
                    held = []
                held.append(f.iloc[s:e])
                last = now
            if out:
                yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame(search(pd.concat(held, ignore_index=True)), columns=names)

    return dealt.mapInPandas(run, columns)


def sides(part: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The two chunks of a part (the same one twice where a chunk meets itself)."""
    i, j = part["i"].iat[0], part["j"].iat[0]
    left = part[part["own"] == i]
    return left, (left if i == j else part[part["own"] == j])


def large_forest(members: DataFrame, near: Callable[[pd.DataFrame, pd.DataFrame], tuple]) -> DataFrame:
    """(a, b): a spanning forest, per part of a large key, of the pairs of different roots that pass.

    ``members``: key, node, root, size and the columns ``near`` looks at;
    ``near(left, right)`` returns two arrays of positions.
    """

    def search(part: pd.DataFrame) -> list:
        left, right = sides(part)
        if not len(left) or not len(right):
            return []
        x, y = near(left, right)
        ra, rb = left["root"].to_numpy()[x], right["root"].to_numpy()[y]
        other = ra != rb
        x, y, ra, rb = x[other], y[other], ra[other], rb[other]
        # one pair for each two clusters, then a forest over the clusters
        pairs = np.stack([np.maximum(ra, rb), np.minimum(ra, rb)], axis=1)
        _, first = np.unique(pairs, axis=0, return_index=True)
        trees = {r: r for r in np.unique(pairs).tolist()}
        nodes = {}
        for k in first.tolist():
            nodes[int(pairs[k, 0]), int(pairs[k, 1])] = (int(left["node"].iat[x[k]]), int(right["node"].iat[y[k]]))
        kept = forest(pairs[first, 0], pairs[first, 1], trees)
        return [(max(nodes[p]), min(nodes[p])) for p in kept]

    dealt = chunk_pairs(members.where(F.col("size") > SMALL), "key", "size")
    return search_parts(dealt, "key", search, "a long, b long").distinct()


def clusters(multi: DataFrame, star: DataFrame, bounded: Callable[[DataFrame], DataFrame], nodes: DataFrame,
             near: Callable, name: str) -> DataFrame:
    """(node, root) of the clusters that all linked nodes lie in.

    ``star``: pairs of ``multi`` that pass the bound; ``bounded`` keeps the
    pairs (a, b) that do; ``nodes``: node and the columns for ``near``.
    """
    roots = cut(components(star, f"{name}-stars"), f"{name}-star-roots")
    seen = cut(open_keys(multi, roots, name), f"{name}-open")
    small = cut(bounded(small_pairs(seen)), f"{name}-small")
    large = cut(large_forest(seen.where(F.col("size") > SMALL).join(nodes, "node"), near), f"{name}-large")
    more = small.union(large)
    if not more.limit(1).count():
        return roots
    return cut(components(star.union(more), f"{name}-components"), f"{name}-roots")
