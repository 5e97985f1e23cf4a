"""N-gram Jaccard join: sets of word shingles linked by their Jaccard similarity.

Documents with equal shingle sets are one node.  A set's items are hashed into
groups; the group counts are its point, and the sum of coordinate minima
bounds an overlap from above (``rtree``).  Pairs that pass the bound are
verified on the sets themselves.

A tree over the whole corpus can't prune: with far fewer groups than items,
the counts of unrelated texts of one length differ by less than the distance a
link allows in any few coordinates, so every box would be searched.  Nodes are
therefore first brought together by shared items: a set of n items that is
similar to another shares at least one of the first ``n - ceil(t * n) + 1``
items in any common order (rarest first here: items frequent in some slice of
the input come last, whatever list of them is known).  Candidates come
from these items, sizes and parity sketches; the tree bounds pairs within clusters.

Defined results: null texts and texts without words have an empty set, which
is linked with nothing; fewer words than a shingle make one item; null ids
are linked like others but never name a component (its id is null if it has
no other); repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import flat, linkage
from .common import cut, row_key
from .flat import mix
from .rtree import PackedRTree, needed

GROUPS = 64
#: Bits of a parity sketch: the items' counts modulo two in as many fine groups,
#: about as many as the set has items.  Two sets differ in at least as many
#: items as their sketches do in bits; a longer sketch folds to a shorter one.
LEAST_BITS, MOST_BITS = 64, 4096
#: Items that the common order puts last, at most: an order, so it changes no result.
FREQUENT = 1 << 18
#: Bytes of text whose items are counted together, and texts that make one frequent.
COUNTED, REPEATS = 8 << 20, 3

_ODD = mix(np.arange(101, 133, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, at: np.ndarray, i: int, j: int, k: int):
    """Sorted distinct item hashes of documents ``i..j``, and ``first`` per document."""
    w = flat.words(data, at, i, j)
    h, count = w.hashes(), np.diff(w.first)
    size = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(j - i), size)
    base = np.cumsum(size) - size
    start = np.repeat(w.first[:-1] - base, size) + np.arange(int(size.sum()))
    words = np.minimum(count, k)[doc]
    item = mix(words.astype(np.uint64))
    for x in range(k):
        has = x < words
        nth = h[np.minimum(start + x, max(len(h) - 1, 0))] if len(h) else item
        item = np.where(has, mix(item + nth * _ODD[x % len(_ODD)]), item)
    order = np.lexsort((item, doc))
    item, doc = item[order], doc[order]
    keep = np.ones(len(item), bool)
    keep[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])
    item, doc = item[keep], doc[keep]
    return item, np.searchsorted(doc, np.arange(j - i + 1))


def node_ids(item: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Identity of each set (0 for empty ones): a sum over its items, mixed."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(item + np.uint64(77)), dtype=np.uint64)])
    n = np.diff(first).astype(np.uint64)
    return np.where(n > 0, mix((total[first[1:]] - total[first[:-1]]) + n * _ODD[0]), 0).view(np.int64)


def frequent_items(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Item hashes (sorted) that repeat within a slice of the input, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            item, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= REPEATS
            return pa.record_batch([pa.array(item[often].view(np.int64)), pa.array(n[often])],
                                   names=["item", "n"])

        for b in batches:
            data, at = flat.utf8(b.column(0))
            for i, j in flat.slices(at):
                held.append(shingle_sets(data, at, i, j, k)[0])
                size += int(at[j] - at[i])
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    rows = (docs.select("text").mapInArrow(run, "item long, n long")
            .groupBy("item").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "item").limit(FREQUENT).toPandas())
    item = rows["item"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(item)
    return item[order], rows["n"].to_numpy(np.int64)[order]


def prefixes(item: np.ndarray, first: np.ndarray, frequent: tuple, percent: int):
    """The items of each set that a similar set must share one of, and their set's number."""
    known, often = frequent
    rank = np.zeros(len(item), np.int64)
    if len(known) and len(item):
        at = np.minimum(np.searchsorted(known, item), len(known) - 1)
        rank = np.where(known[at] == item, often[at], 0)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((item, rank, doc))
    take = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
    keep = np.arange(len(item)) - first[:-1][doc] < take[doc]
    return item[order][keep], doc[keep]


def sketch_bits(n: np.ndarray) -> np.ndarray:
    """Bits of the sketches of sets of ``n`` items: a power of two."""
    return np.clip(2 ** np.floor(np.log2(np.maximum(n, 1))), LEAST_BITS, MOST_BITS).astype(np.int64)


def sketches(item: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Per set: its size (8 bytes) and the parity of its fine groups, folded to its number of bits.

    Fold x keeps the lower bits of a group's number, so sketches of different
    lengths compare at the shorter one.
    """
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    bits = sketch_bits(n)
    at = np.concatenate([[0], np.cumsum(bits)])
    cell = at[:-1][doc] + ((item >> np.uint64(17)).astype(np.int64) & (bits[doc] - 1))
    odd = np.packbits((np.bincount(cell, minlength=int(at[-1])) & 1).astype(bool), bitorder="little").tobytes()
    return [int(c).to_bytes(8, "little") + odd[s // 8:e // 8]
            for c, s, e in zip(n.tolist(), at[:-1].tolist(), at[1:].tolist())]


class Sketches:
    """Sizes and parities of some sketches; parities of each length lie in one array."""

    def __init__(self, column):
        raw = list(column)
        self.n = np.asarray([int.from_bytes(r[:8], "little") for r in raw], np.int64)
        self.bits = np.asarray([8 * (len(r) - 8) for r in raw], np.int64)
        self.raw = raw
        self._folded: dict[int, np.ndarray] = {}

    def at(self, bits: int) -> np.ndarray:
        """All parities (of at least ``bits`` bits) folded to ``bits``; shorter ones are zero rows."""
        if bits not in self._folded:
            out = np.zeros((len(self.raw), bits // 64), np.uint64)
            for size in np.unique(self.bits[self.bits >= bits]).tolist():
                rows = np.flatnonzero(self.bits == size)
                whole = np.frombuffer(b"".join(self.raw[r][8:] for r in rows), np.uint64)
                out[rows] = np.bitwise_xor.reduce(whole.reshape(len(rows), size // bits, bits // 64), axis=1)
            self._folded[bits] = out
        return self._folded[bits]


def may_link(x: Sketches, i: np.ndarray, y: Sketches, j: np.ndarray, percent: int) -> np.ndarray:
    """Do the sizes and sketches of the rows ``i`` of x and ``j`` of y allow the similarity?"""
    na, nb = x.n[i], y.n[j]
    most = na + nb - 2 * needed(na, nb, percent)  # items that may differ
    keep = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (np.abs(na - nb) <= most)
    bits = np.minimum(x.bits[i], y.bits[j])
    for size in np.unique(bits[keep]).tolist():
        own = np.flatnonzero(keep & (bits == size))
        differ = np.bitwise_count(x.at(size)[i[own]] ^ y.at(size)[j[own]]).sum(axis=1, dtype=np.int64)
        keep[own] = differ <= most[own]
    return keep


def points(sets: list[np.ndarray]) -> np.ndarray:
    """Group counts of each set."""
    n = np.asarray([len(x) for x in sets], np.int64)
    item = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    cell = np.repeat(np.arange(len(n)), n) * GROUPS + (item >> np.uint64(40)).astype(np.int64) % GROUPS
    return np.bincount(cell, minlength=len(n) * GROUPS).reshape(-1, GROUPS)


def features(docs: DataFrame, k: int, percent: int, frequent: tuple) -> DataFrame:
    """doc_id, rk, n_shingles, node, sketch and keys (only at a node's first row of a task)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            data, at = flat.utf8(b.column(2))
            for i, j in flat.slices(at):
                item, first = shingle_sets(data, at, i, j, k)
                node = node_ids(item, first)
                fresh = np.zeros(j - i, bool)
                for x, v in enumerate(node.tolist()):
                    if v and v not in seen:
                        seen.add(v)
                        fresh[x] = True
                key, doc = prefixes(item, first, shared.value, percent)
                own = fresh[doc]
                sizes = np.bincount(doc[own], minlength=j - i)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                    pa.array(key[own].view(np.int64)))
                raw = [x if f else None for x, f in zip(sketches(item, first), fresh)]
                yield pa.record_batch(
                    [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                     pa.array(np.diff(first).astype(np.int64)), pa.array(node),
                     pa.array(raw, pa.binary()), lists],
                    names=["doc_id", "rk", "n_shingles", "node", "sketch", "keys"])

    return docs.select(F.col("doc_id").cast("long"), "rk", "text").mapInArrow(
        run, "doc_id long, rk long, n_shingles long, node long, sketch binary, keys array<long>")


def bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose bounds allow the similarity."""
    side = [nodes.select(F.col("node").alias(x), F.col("sketch").alias(f"s{x}")) for x in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (Sketches(b.column(c).to_pylist()) for c in ("sa", "sb"))
                rows = np.arange(b.num_rows)
                keep = pa.array(may_link(x, rows, y, rows, percent))
                yield pa.record_batch([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    return (pairs.join(side[0], "a").join(side[1], "b").select("a", "b", "sa", "sb")
            .mapInArrow(run, "a long, b long"))


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def links_within(part: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the true links of a part.

    The tree over the sets' group counts finds the pairs whose summed minima
    allow the similarity, the sketches prune them, the sets decide.
    """
    left, right = linkage.sides(part)
    if not len(left) or not len(right):
        return []
    sa, sb = ([np.frombuffer(i, np.uint64) for i in g["items"]] for g in (left, right))
    mine, tree = points(sa), PackedRTree(points(sb))
    x, y = Sketches(left["sketch"]), Sketches(right["sketch"])
    a, b = left["node"].tolist(), right["node"].tolist()
    root = {n: n for n in a} | {n: n for n in b}
    out: list[tuple[int, int]] = []
    for k, node in enumerate(a):
        hits = tree.search(mine[k], percent)
        hits = hits[may_link(x, np.full(len(hits), k), y, hits, percent)]
        for h in hits.tolist():
            u, v = _find(root, node), _find(root, b[h])
            if u != v:
                same = overlap(sa[k], sb[h])
                if 100 * same >= percent * (len(sa[k]) + len(sb[h]) - same):
                    root[max(u, v)] = min(u, v)
                    out.append((max(node, b[h]), min(node, b[h])))
    return out


def _find(root: dict, x: int) -> int:
    while root[x] != x:
        root[x] = x = root[root[x]]
    return x


def verified(roots: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) within clusters that join the sets' true components.

    The sets are made again from the texts, only for clustered nodes: a
    fixed-size sieve spares the others the shuffle, the joins decide.  A
    cluster is searched in parts of two chunks, so none meets in one task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(linkage.sieve(roots))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            data, at = flat.utf8(b.column(0))
            for i, j in flat.slices(at):
                item, first = shingle_sets(data, at, i, j, k)
                node = node_ids(item, first)
                own = [x for x in np.flatnonzero(linkage.sifted(shared.value, node) & (node != 0)).tolist()
                       if node[x] not in seen and not seen.add(node[x])]
                if own:
                    yield pa.record_batch(
                        [pa.array(node[own]), pa.array([item[first[x]:first[x + 1]].tobytes() for x in own], pa.binary())],
                        names=["node", "items"])

    size = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    made = docs.select("text").mapInArrow(sets, "node long, items binary")
    members = (roots.join(size, "root").join(nodes, "node")
               .join(made.dropDuplicates(["node"]), "node"))
    dealt = linkage.chunk_pairs(members, "root", "size")
    return cut(linkage.search_parts(dealt, "root", lambda part: links_within(part, percent), "a long, b long"), "links")


def similar_groups(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, rk, n_shingles and component_id of every document.

    ``rk`` identifies the row's doc_id and text (``row_key``).  Two documents
    link when 100 * intersection >= percent * union of their sets.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                       row_key(F.col("doc_id"), F.col("text")).alias("rk"))
    feats = cut(features(docs, k, percent, frequent_items(docs, k)), "shingles")
    nodes = feats.where("sketch is not null").select("node", "sketch").dropDuplicates(["node"])
    multi = linkage.stars(feats.select("node", F.explode("keys").alias("key")), "shared-items")

    def near(left: pd.DataFrame, right: pd.DataFrame):
        """Row pairs that the sketches allow: sizes sorted, each row meets the similar ones."""
        x, y = Sketches(left["sketch"]), Sketches(right["sketch"])
        order = np.argsort(y.n, kind="stable")
        sizes, a, b = y.n[order], [], []
        for i, n in enumerate(x.n.tolist()):
            j = order[np.searchsorted(sizes, -(-percent * n // 100)):np.searchsorted(sizes, 100 * n // percent, "right")]
            own = np.full(len(j), i)
            keep = may_link(x, own, y, j, percent)
            a.append(own[keep])
            b.append(j[keep])
        return np.concatenate(a), np.concatenate(b)

    pairs = multi.select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    star = cut(bounded(pairs, nodes, percent), "near-stars")
    grouped = linkage.clusters(multi, star, lambda p: bounded(p, nodes, percent), nodes, near, "sets")
    links = verified(grouped, nodes, docs, k, percent)
    roots = cut(linkage.components(links, "linked"), "linked-roots")

    least = feats.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("d"))
    least = least.join(roots, "node", "left").select("node", "d", F.coalesce("root", "node").alias("root"))
    named = least.groupBy("root").agg(F.min("d").alias("component_id"))
    component = least.join(named, "root").select("node", "component_id", "root")
    own = feats.select("doc_id", "rk", "n_shingles", "node")
    return (own.join(component, "node", "left")
            .select("doc_id", "rk", "n_shingles", "node", "root",
                    F.when(F.col("n_shingles") > 0, F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, columns unchanged: the least id, then the least ``row_key``.

    Texts without words are not grouped and all stay.
    """
    groups = cut(similar_groups(docs, k, percent), "groups")
    some = groups.where("n_shingles > 0")
    # the same text may come with and without an id: ids first
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "rk"))
    best = some.groupBy("root").agg(first["rk"].alias("best"))
    rows = (some.groupBy("root", "rk").agg(F.count(F.lit(1)).alias("__copies")).join(best, "root")
            .select(F.col("rk").alias("__rk"), (F.col("rk") == F.col("best")).alias("__stays"), "__copies")
            .where("not __stays or __copies > 1"))  # all others stay anyway
    keyed = docs.select(F.struct("*").alias("__row"),
                        row_key(F.col("doc_id"), F.col("text").cast("string")).alias("__rk"))
    judged = keyed.join(rows, "__rk", "left")
    copies = judged.where("__stays").dropDuplicates(["__rk"])
    return judged.where("__stays is null").union(copies).select("__row.*")
