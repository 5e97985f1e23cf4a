"""Best-fit packing of token pieces into sequences, planned on length counts.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.
The plan needs only how many pieces have each length (at most ``capacity``
numbers), so it is made on the driver whatever the input:

1. linear grouping: the large lengths, sorted, are cut into groups of equal
   cardinality and rounded up to the largest of each;
2. configurations: for the few rounded sizes, column generation finds the
   fractions of each bin filling, rounded down to whole bins;
3. substitution: actual lengths replace the rounded sizes, which frees room;
4. best fit: everything left, small pieces last, goes to the tightest room.

Equal bins stay one run with a multiplicity, so the plan's size does not
follow the number of pieces.  Pieces of a length are ranked and look up their
place by (length, rank).

Defined results: a null or empty text is the single end token; repeated rows
are separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import cut, grouped_rank

CAPACITY = 4096
END_ID = 1
#: Runs of text whose ids a worker remembers; the memory is emptied when full.
REMEMBERED = 600_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# ---- tokens -----------------------------------------------------------------

#: Latin text (below U+0180) that needs no normaliser but lower case.
_PLAIN = re.compile("[\t-\r -\x7f\x80-\x84\x86-įı-ſ]*")
#: The vocabulary's own word pattern, spelled out for lower-case Latin text.
_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼-¾]|[^\\sa-zªµºß-öø-ſ0-9²³¹¼-¾]+")


class WordTokens:
    """Ids of whole texts as little-endian bytes, one lookup per run without white space.

    The vocabulary's words never cross white space, so a text's ids are its
    runs' ids in order.  Texts beyond plain Latin go to the tokenizer whole.
    """

    def __init__(self, vocab: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(vocab)
        self.bare = Tokenizer(self.full.model)  # for runs, which are normalised already
        self.bare.pre_tokenizer = self.full.pre_tokenizer
        vocab_ids = self.full.get_vocab()
        self.closes = np.zeros(max(vocab_ids.values()) + 1, bool)
        self.closes[[i for w, i in vocab_ids.items() if w.endswith("</w>")]] = True
        self.ids: dict[str, bytes] = {"": b""}

    def _encode(self, text: str, bare: bool = False) -> np.ndarray:
        tokenizer = self.bare if bare else self.full
        return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _encode_runs(self, runs: list[str]) -> list[bytes]:
        """Runs are encoded many at a time; each word ends in one closing token."""
        out: list[bytes] = []
        for i in range(0, len(runs), 256):
            part = runs[i:i + 256]
            ids = self._encode(" ".join(part), bare=True)
            word_ends = [0, *(4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()]
            at = np.cumsum([0] + [len(_WORD.findall(r)) for r in part]).tolist()
            if at[-1] != len(word_ends) - 1:
                out.extend(self._encode(r, bare=True).tobytes() for r in part)
                continue
            raw = ids.tobytes()
            out.extend(raw[word_ends[a]:word_ends[b]] for a, b in zip(at, at[1:]))
        return out

    def _ids_of(self, words: list[str]) -> list[bytes]:
        new = [w for w in words if w not in self.ids]
        if new:
            if len(self.ids) + len(new) > REMEMBERED:
                self.ids = {"": b""}
                new = [w for w in words if w]
            self.ids.update(zip(new, self._encode_runs(new)))
        return [self.ids[w] for w in words]

    def __call__(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text; runs are split and numbered by Arrow, ids gathered by run number."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        out: list = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts.to_pylist()):
            if "<|" in t or not _PLAIN.fullmatch(t):
                out[i] = self._encode(t).tobytes()
            else:
                plain.append(i)
        if not plain:
            return out
        lists = pc.utf8_split_whitespace(pc.utf8_lower(texts.take(pa.array(plain))))
        runs = lists.flatten().dictionary_encode()
        each = self._ids_of(runs.dictionary.to_pylist())
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        first = np.cumsum(size) - size
        number = runs.indices.to_numpy()
        n = size[number]
        at = np.concatenate([[0], np.cumsum(n)])  # ids before each run
        ids = np.frombuffer(b"".join(each), "<u4")[
            np.repeat(first[number] - at[:-1], n) + np.arange(at[-1])]
        bounds = at[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])].tolist()
        for i, a, b in zip(plain, bounds, bounds[1:]):
            out[i] = ids[a:b].tobytes()
        return out


def text_slices(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """(first, count) of rows that hold about ``most`` bytes of text, one row at least."""
    size = np.cumsum(pc.binary_length(texts).to_numpy())
    at = 0
    while at < len(size):
        before = int(size[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + most, "right")))
        yield at, end - at
        at = end


_loaded: dict[str, WordTokens] = {}


def tokenise(vocab: str, capacity: int, with_ids: bool):
    """A ``mapInArrow`` function: documents to pieces."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())]
                       + [("ids", pa.binary())] * with_ids)
    end = np.asarray([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _loaded.get(vocab) or _loaded.setdefault(vocab, WordTokens(vocab))
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for at, count in text_slices(texts):
                rows: list[tuple] = []
                docs = batch.column(0).slice(at, count).to_pylist()
                for doc, ids in zip(docs, tokens(texts.slice(at, count))):
                    ids += end
                    for k, b in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[b:b + 4 * capacity]
                        rows.append((doc, k, b // 4, len(own) // 4, zlib.crc32(own))
                                    + (own,) * with_ids)
                columns = zip(*rows) if rows else [[] for _ in schema]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)],
                                      schema=schema)

    return run


def token_pieces(docs: DataFrame, vocab: str, capacity: int = CAPACITY,
                 with_ids: bool = False) -> DataFrame:
    """Pieces of every document; ``ids`` are little-endian unsigned 32-bit values."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        tokenise(vocab, capacity, with_ids), PIECES + ", ids binary" * with_ids)


# ---- plan -------------------------------------------------------------------


def linear_groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths, largest first, in ``groups`` parts of equal cardinality: (length, pieces)."""
    total = sum(counts.values())
    size = max(1, -(-total // max(groups, 1)))
    out: list[list[tuple[int, int]]] = [[]]
    room = size
    for n in sorted(counts, reverse=True):
        c = counts[n]
        while c:
            if not room:
                out.append([])
                room = size
            k = min(c, room)
            out[-1].append((n, k))
            c -= k
            room -= k
    return [g for g in out if g]


def _best_pattern(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The filling of one bin with the highest value (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    low = int(sizes.min())
    for c in range(low, capacity + 1):
        fits = sizes <= c
        got = np.where(fits, value + best[np.where(fits, c - sizes, 0)], -1.0)
        k = int(got.argmax())
        if got[k] > best[c - 1]:
            best[c], last[c] = got[k], k
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(len(sizes), int), capacity
    while c >= low:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= sizes[last[c]]
    return float(best[capacity]), pattern


def configurations(sizes: list[int], demand: list[int], capacity: int,
                   steps: int = 150) -> list[tuple[np.ndarray, int]]:
    """Whole multiplicities of bin fillings that use at most ``demand`` pieces of each size.

    Column generation: prices from the current basis, the knapsack's best
    filling enters while it pays, then multiplicities are rounded down.
    """
    s, d = np.asarray(sizes), np.asarray(demand, float)
    basis = np.diag(capacity // s).astype(float)
    for _ in range(steps):
        inverse = np.linalg.inv(basis)
        prices = np.ones(len(s)) @ inverse
        worth, pattern = _best_pattern(s, prices, capacity)
        if worth <= 1 + 1e-9:
            break
        enter, x = inverse @ pattern, inverse @ d
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(enter > 1e-9, x / enter, np.inf)
        basis[:, int(ratio.argmin())] = pattern
    x = np.linalg.solve(basis, d)
    out, left = [], np.asarray(demand)
    for k in np.argsort(-x):
        pattern = basis[:, k].astype(int)
        used = pattern > 0
        m = int(min(max(0, np.floor(x[k] + 1e-6)), (left[used] // pattern[used]).min()))
        if m:
            out.append((pattern, m))
            left = left - m * pattern
    return out


class _Bins:
    """Runs of equal bins by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []
        self.at: dict[int, list[list]] = defaultdict(list)

    def add(self, bins: int, items: tuple, room: int) -> None:
        if room not in self.at:
            bisect.insort(self.rooms, room)
        self.at[room].append([bins, items])

    def best_fit(self, n: int, count: int) -> None:
        """``count`` pieces of length ``n``, each to the bin with the least room that fits."""
        while count:
            i = bisect.bisect_left(self.rooms, n)
            if i == len(self.rooms):
                each = self.capacity // n
                bins, odd = divmod(count, each)
                if bins:
                    self.add(bins, (n,) * each, self.capacity - each * n)
                if odd:
                    self.add(1, (n,) * odd, self.capacity - odd * n)
                return
            room = self.rooms[i]
            bins, items = self.at[room].pop()
            if not self.at[room]:
                del self.at[room]
                self.rooms.pop(i)
            k = min(bins, count)
            if k < bins:
                self.add(bins - k, items, room)
            self.add(k, (*items, n), room - n)
            count -= k

    def runs(self) -> list[tuple[int, tuple]]:
        return [(b, items) for room in self.rooms for b, items in self.at[room]]


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = 12,
         small: int | None = None) -> list[tuple[int, tuple]]:
    """Runs (bins, lengths in each) that hold exactly ``counts`` pieces of each length."""
    small = small or capacity // 4
    bins = _Bins(capacity)
    if counts.get(capacity):
        bins.add(counts[capacity], (capacity,), 0)
    large = {n: c for n, c in counts.items() if small < n < capacity and c}
    left = {n: c for n, c in counts.items() if n < capacity and c}
    grouped = linear_groups(large, groups) if large else []
    merged: dict[int, list[tuple[int, int]]] = defaultdict(list)  # groups of one rounded size
    for g in grouped:
        merged[g[0][0]].extend(g)
    sizes = list(merged)
    queues = [merged[s][::-1] for s in sizes]  # pop() gives the longest
    if sizes:
        for pattern, m in configurations(sizes, [sum(c for _, c in q) for q in queues], capacity):
            columns = []  # per place in the bin: (length, bins) that sum to m
            for k in np.repeat(np.arange(len(sizes)), pattern):
                column, need = [], m
                while need:
                    n, c = queues[k].pop()
                    if c > need:
                        queues[k].append((n, c - need))
                        c = need
                    column.append((n, c))
                    left[n] -= c
                    need -= c
                columns.append(column)
            while columns[0]:  # bins up to the next change of any place
                same = min(col[0][1] for col in columns)
                items = tuple(col[0][0] for col in columns)
                for col in columns:
                    n, c = col.pop(0)
                    if c > same:
                        col.insert(0, (n, c - same))
                bins.add(same, items, capacity - sum(items))
    for n in sorted(left, reverse=True):
        bins.best_fit(n, left[n])
    return bins.runs()


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple]]:
    """The plan with the fewest bins over a few group counts and limits of small.

    The last limit leaves no large pieces, which is best fit by falling
    length: where many lengths are large, rounding them up costs more.
    """
    pieces = sum(c for n, c in counts.items() if n < capacity)
    tries = [plan(counts, capacity, max(1, min(g, pieces // 4)), capacity // s)
             for g, s in ((12, 4), (24, 3), (48, 4), (24, 2), (1, 1))]
    return min(tries, key=lambda runs: sum(b for b, _ in runs))


def places(runs: list[tuple[int, tuple]]) -> dict[str, np.ndarray]:
    """For ranks of each length, from ``low`` on: sequence of the first, and offset in it."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for bins, items in runs:
        offset = 0
        for n in items:
            rows.append((n, used[n], sequence, offset))
            used[n] += bins
            offset += n
        sequence += bins
    rows.sort()
    a = np.asarray(rows, np.int64).reshape(-1, 4)
    return {"at": (a[:, 0] << 44) + a[:, 1], "low": a[:, 1], "sequence": a[:, 2], "offset": a[:, 3]}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``pieces`` is read twice, so pass a cut one."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    look = places(best_plan(counts, capacity))
    shared = pieces.sparkSession.sparkContext.broadcast(look)  # bounded by capacity, see plan()
    columns = pieces.columns
    tie = F.xxhash64("doc_id", "piece", "ids_crc32")
    ranked = (grouped_rank(pieces.withColumn("__tie", tie), ["length"], "__tie", "__rank")
              .select(*columns, "__rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            n = b.column("length").to_numpy()
            rank = b.column("__rank").to_numpy()
            i = np.searchsorted(p["at"], (n << 44) + rank, "right") - 1
            yield pa.record_batch(
                [b.column(c) for c in columns]
                + [pa.array(p["sequence"][i] + rank - p["low"][i]), pa.array(p["offset"][i])],
                names=[*columns, "sequence_id", "offset"])

    fields = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocab: str, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack all documents; one row per piece."""
    return pack(cut(token_pieces(docs, vocab, capacity, with_ids), "pieces"), capacity)
