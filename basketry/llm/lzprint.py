"""Lempel-Ziv phrase fingerprints: likeness of texts by shared dictionary phrases.

A text is parsed from left to right into phrases: each is the longest one
already in its dictionary plus one character, and enters the dictionary.  The
set of phrases is what a compressor would have learned from the text.  Its
fingerprint is a minimum hash per bin (one hash per phrase picks bin and
value; empty bins borrow from a fixed order of other bins), and the share of
equal bins estimates the Jaccard similarity of two phrase sets.

Each document is also fingerprinted after an edit that replaces its last
quarter by the start of the next document in ascending doc_id.  The parse of
the kept three quarters is shared by both.

Order: doc_id ascending, null ids last, rows of one id by the hash of their
text; after the last row comes the first.  Defined results: a null text is
empty; empty texts have no phrases and are like each other (1) and unlike all
others (0); repeated rows follow one another; a single row is its own next
one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shuffle_width
from .flat import mix

#: Bins of a fingerprint; each is shown as 4 hex digits.
BINS = 128
#: Ranges of doc_id, at most: their bounds are the only list that is made.
MOST_PARTS = 20_000
_EMPTY = "-" * (4 * BINS)
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 61) - 1


class Parse:
    """A growing text's dictionary: phrases as numbered nodes of a tree, and their hashes.

    Node 0 is the empty phrase; ``next_of`` maps (character, node) to the
    longer phrase; ``open`` is the phrase the next character may extend.
    """

    def __init__(self):
        self.next_of: dict[int, int] = {}
        self.hashes: list[int] = [0]
        self.open = 0

    def feed(self, codes: np.ndarray) -> None:
        next_of, hashes, node = self.next_of, self.hashes, self.open
        get = next_of.get
        for c in (codes.astype(np.int64) << 32).tolist():
            longer = get(c + node)
            if longer is None:
                next_of[c + node] = len(hashes)
                hashes.append((hashes[node] + c + _STEP) * _STEP & _MASK)
                node = 0
            else:
                node = longer
        self.open = node

    def copy(self) -> "Parse":
        other = Parse()
        other.next_of, other.hashes, other.open = dict(self.next_of), list(self.hashes), self.open
        return other

    def fingerprint(self) -> np.ndarray | None:
        """The least value of each bin; None without phrases."""
        if len(self.hashes) == 1:
            return None
        return dense(mix(np.asarray(self.hashes[1:], np.uint64)))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _orders() -> np.ndarray:
    """For each bin, a fixed pseudo-random order of bins to borrow from (itself first)."""
    key = mix(np.arange(BINS * BINS, dtype=np.uint64)).reshape(BINS, BINS)
    key[np.arange(BINS), np.arange(BINS)] = 0
    return np.argsort(key, axis=1, kind="stable")


_BORROW = _orders()


def dense(h: np.ndarray) -> np.ndarray:
    """One least 16-bit value per bin; empty bins take another bin's value, marked by the distance."""
    least = np.full(BINS, 1 << 40, np.int64)
    np.minimum.at(least, (h >> np.uint64(57)).astype(np.int64), (h & np.uint64((1 << 40) - 1)).astype(np.int64))
    full = least < 1 << 40
    turn = full[_BORROW].argmax(axis=1)
    value = least[_BORROW[np.arange(BINS), turn]].astype(np.uint64)
    return (mix(value + (turn.astype(np.uint64) << np.uint64(44))) & np.uint64(0xFFFF)).astype(np.uint16)


def shown(print_: np.ndarray | None) -> str:
    return _EMPTY if print_ is None else print_.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    if a is None or b is None:
        return float(a is None and b is None)
    return float((a == b).mean())


def measured(text: str, after: str) -> tuple:
    """Of a text and its next: edited sha-256, both fingerprints."""
    codes = code_points(text)
    n = len(codes)
    cut_at = n - n // 4
    parse = Parse()
    parse.feed(codes[:cut_at])
    edit = parse.copy()
    parse.feed(codes[cut_at:])
    tail = after[:n // 4]
    edit.feed(code_points(tail))
    edited = text[:cut_at] + tail
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return n, sha, parse.fingerprint(), edit.fingerprint()


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text, part, lead: rows dealt into ranges of doc_id, sorted within.

    ``lead`` is 0 for a part's own rows and 1 for the first row of the next
    non-empty part (of the first part after the last), which each part also
    gets: so every row's next one is at hand and only texts of one row per
    part are moved twice.  Null ids, and ids that fill several ranges, are dealt
    on by the hash that orders rows of equal ids.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = min(4 * shuffle_width(spark), MOST_PARTS)
    ids = d.where("doc_id is not null")
    at = [k / parts for k in range(1, parts)]
    values, times = np.unique(np.asarray(ids.approxQuantile("doc_id", at, 0.25 / parts), np.int64),
                              return_counts=True)
    # an id that fills several ranges has one of its own, cut by the tie value; so have null ids, which come last
    often = (times > 1) & (values > np.iinfo(np.int64).min)
    bounds = np.unique(np.concatenate([values, values[often] - 1]))
    last = len(bounds) + 1
    share = np.ones(last + 1, np.int64)
    share[np.searchsorted(bounds, values[often])] = times[often]
    share[last] = parts
    first = np.cumsum(share) - share

    @F.pandas_udf("int")
    def part_of(doc_id: pd.Series, tie: pd.Series) -> pd.Series:
        none = doc_id.isna().to_numpy()
        found = np.where(none, last, np.searchsorted(bounds, doc_id.fillna(0).to_numpy(np.int64)))
        high = (tie.to_numpy(np.int64) >> 32) + (1 << 31)
        return pd.Series((first[found] + (high * share[found] >> 32)).astype(np.int32))

    tie = F.xxhash64("text")
    place = part_of("doc_id", tie)
    d = d.withColumn("part", place).withColumn("tie", tie)
    firsts = d.groupBy("part").agg(F.min(F.struct("doc_id", "tie")).alias("f")).collect()  # a row per part
    firsts.sort(key=lambda r: r["part"])
    to = [(firsts[k - 1]["part"], r["f"]["doc_id"], r["f"]["tie"]) for k, r in enumerate(firsts)]
    lead = spark.createDataFrame(to, "to int, id long, t long")
    again = (d.join(F.broadcast(lead), d["doc_id"].eqNullSafe(lead["id"]) & (d["tie"] == lead["t"]))  # a row per part
             .select("doc_id", "text", F.col("to").alias("part"), "tie", F.lit(1).alias("lead")))
    both = d.withColumn("lead", F.lit(0)).union(again.select("doc_id", "text", "part", "tie", "lead"))
    return (both.repartition(parts, "part")
            .sortWithinPartitions("part", "lead", F.col("doc_id").asc_nulls_last(), "tie")
            .select("doc_id", "text", "part", "lead"))


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
       "edited_fingerprint string, near_edited double, near_next double")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in OUT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held: tuple | None = None  # the row whose next one is awaited: part, id, text
    ready: tuple | None = None  # a measured row that awaits the next one's fingerprint

    def close(fp):
        doc, n, sha, own, edit = ready
        return (doc, n, sha, shown(own), shown(edit), likeness(own, edit), likeness(own, fp))

    def table(rows):
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    rows: list[tuple] = []
    for b in batches:
        for doc, text, part, lead in zip(*(b.column(k).to_pylist() for k in range(4))):
            if held is not None and held[0] == part:
                n, sha, own, edit = measured(held[2], text)
                if ready is not None:
                    rows.append(close(own))
                ready = (held[1], n, sha, own, edit)
                if lead:  # the part ends: its last row needs this one's fingerprint
                    rows.append(close(measured(text, "")[2]))
                    held = ready = None
                    if len(rows) >= 512:
                        yield table(rows)
                        rows = []
                    continue
            held = None if lead else (part, doc, text)
            if len(rows) >= 512:
                yield table(rows)
                rows = []
    if rows:
        yield table(rows)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Contract columns of every document (see the module's notes)."""
    return in_order(docs).mapInArrow(_stream, OUT)
