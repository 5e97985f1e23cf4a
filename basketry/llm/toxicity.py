"""Toxic spans with a linear-chain conditional random field.

Token labels come from document labels: a word is a toxic token of a toxic
document when its document frequencies among labelled texts say so clearly.
A two-state chain (clean, toxic) with one emission weight per word and a
transition matrix is fitted to these labelled tokens by conditional
likelihood.  Forward-backward gives each token's marginal; the chance that no
token at all is toxic gives the document's score, calibrated on the labels;
runs of likely tokens give the offending offsets.

Defined results: a null or empty text has no tokens and gets the score of a
text without toxic tokens; ids of null are not held out; rows repeated in the
labels count once; without labels of both kinds every score is 0; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut
from .flat import mix
from .letters import LetterWords, text_slices

#: The fit uses about this many labelled documents, half of them toxic: the bound of the sample.
TRAIN_DOCS = 10_000
#: Token windows and how many of them the chain is fitted on, at most.
WINDOW = 64
TRAIN_WINDOWS = 20_000
#: Neighbouring tokens whose chances are held at once during the fit.
PAIRS = 1 << 16
#: A word is evidence from this many toxic texts on, ...
MIN_TEXTS = 4
#: ... this much more frequent among toxic than clean texts, at this z-value.
MIN_RATIO, MIN_Z = 6.0, 4.0
MODULUS, HELD = 5, 0

SPANS = "array<struct<start:long,end:long,probability:double>>"


@dataclass
class Chain:
    """Emission weights of known words (sorted hashes), transitions and calibration."""

    words: np.ndarray
    emission: np.ndarray
    bias: float = -4.0
    #: log-potentials [from][to] of the states clean (0) and toxic (1)
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    scale: float = 1.0
    shift: float = 0.0

    def log_odds(self, hashes: np.ndarray) -> np.ndarray:
        """Emission log-odds of toxic for each token."""
        if not len(self.words):
            return np.full(len(hashes), self.bias)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.emission[at], 0.0) + self.bias

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * evidence + self.shift)))


def _steps(first: np.ndarray):
    """Texts by falling length, and how many of them are longer than each position."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    start, size = first[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")
    return start, size, active


def forward_backward(s: np.ndarray, first: np.ndarray, move: np.ndarray):
    """Log-odds messages of a two-state chain, all texts of a batch step by step.

    ``s``: emission log-odds of all tokens, text d owning ``first[d]:first[d+1]``.
    Returns the forward log-odds (with own emission) and the backward ones
    (without); their sum is the marginal's log-odds.
    """
    start, size, active = _steps(first)
    (a00, a01), (a10, a11) = move
    fwd, bwd = np.empty(len(s)), np.zeros(len(s))
    prev = None
    for t, k in enumerate(active):
        at = start[:k] + t
        if t == 0:
            prev = s[at] + (a01 - a00)
        else:
            r = prev[:k]
            prev = s[at] + np.logaddexp(a11 + r, a01) - np.logaddexp(a10 + r, a00)
        fwd[at] = prev
    last = start + size - 1
    prev = np.zeros(len(start))
    for t in range(1, len(active)):  # texts that have a token t before their last
        k = active[t]
        at = last[:k] - t
        x = s[at + 1] + prev[:k]
        prev = np.logaddexp(a11 + x, a10) - np.logaddexp(a01 + x, a00)
        bwd[at] = prev
    return fwd, bwd


def no_toxic_token(s: np.ndarray, bwd: np.ndarray, first: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Log-probability of each text's all-clean labelling."""
    step = np.logaddexp(0.0, move[0, 1] - move[0, 0] + s + bwd)
    total = np.concatenate([[0.0], np.cumsum(step)])
    return -(total[first[1:]] - total[first[:-1]])


def fit_chain(windows: list[tuple[np.ndarray, np.ndarray]], n_words: int, steps: int = 80):
    """Emission weights, bias and transitions of greatest conditional likelihood.

    ``windows``: (word number or -1, label 0/1) arrays.  Gradients are label
    counts minus forward-backward expectations; small L2 term; Adam steps.
    """
    first = np.concatenate([[0], np.cumsum([len(w) for w, _ in windows])]).astype(np.int64)
    word = np.concatenate([w for w, _ in windows])
    y = np.concatenate([v for _, v in windows]).astype(float)
    inner = np.ones(len(word), bool)
    inner[first[:-1]] = False
    pair = np.flatnonzero(inner)
    known = word >= 0
    theta = np.zeros(n_words + 5)  # emissions, bias, transitions
    theta[n_words] = -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    seen = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = ((y[pair - 1] == a) & (y[pair] == b)).sum()
    starts = first[:-1]
    for step in range(1, steps + 1):
        move = theta[n_words + 1:].reshape(2, 2)
        s = theta[n_words] + np.where(known, theta[np.maximum(word, 0)], 0.0)
        fwd, bwd = forward_backward(s, first, move)
        p = 1 / (1 + np.exp(-(fwd + bwd)))
        both = np.zeros((2, 2))
        for k in range(0, len(pair), PAIRS):
            at = pair[k:k + PAIRS]
            r, x = fwd[at - 1], s[at] + bwd[at]
            logs = np.stack([np.zeros(len(at)) + move[0, 0], move[0, 1] + x,
                             move[1, 0] + r, move[1, 1] + r + x])
            logs -= np.logaddexp.reduce(logs, axis=0)
            both += np.exp(logs).sum(axis=1).reshape(2, 2)
        gap = y - p
        grad = np.zeros_like(theta)
        grad[:n_words] = np.bincount(word[known], gap[known], n_words)[:n_words]
        grad[n_words] = gap.sum()
        g = seen - both
        g[0, 0] += (1 - y[starts]).sum() - (1 - p[starts]).sum()
        g[0, 1] += y[starts].sum() - p[starts].sum()
        grad[n_words + 1:] = g.ravel()
        grad -= 0.05 * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.3 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return theta[:n_words], float(theta[n_words]), theta[n_words + 1:].reshape(2, 2)


def evidence_of(chain: Chain, texts: list, spans: bool = True):
    """Per text: log-odds that it has a toxic token, and its likely runs of tokens."""
    n = len(texts)
    evidence, runs = np.full(n, -20.0), [[] for _ in range(n)]
    for i, j in text_slices(texts):
        w = LetterWords(texts[i:j])
        s = chain.log_odds(w.hashes)
        fwd, bwd = forward_backward(s, w.first, chain.move)
        clean = np.minimum(no_toxic_token(s, bwd, w.first, chain.move), -1e-12)
        evidence[i:j] = np.clip(np.log(-np.expm1(clean)) - clean, -20, 20)
        if spans:
            likely = np.flatnonzero(fwd + bwd > 0)
            doc = np.searchsorted(w.first, likely, "right") - 1
            p = 1 / (1 + np.exp(-(fwd + bwd)[likely]))
            before = None
            for k, d, q in zip(likely.tolist(), doc.tolist(), p.tolist()):
                start, end = int(w.starts[k] - w.at[d]), int(w.ends[k] - w.at[d])
                own = runs[i + d]
                if before == (k - 1, d):
                    own[-1] = {"start": own[-1]["start"], "end": end,
                               "probability": max(own[-1]["probability"], q)}
                else:
                    own.append({"start": start, "end": end, "probability": q})
                before = (k, d)
    return evidence, runs


def _word_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) to (word, toxic texts, clean texts) of each slice."""
    for b in batches:
        texts, toxic = b.column(1).to_pylist(), np.asarray(b.column(0).to_pylist(), bool)
        for i, j in text_slices(texts):
            w = LetterWords(texts[i:j])
            if not len(w.hashes):
                continue
            pairs = np.unique(np.stack([w.hashes, w.doc_of().astype(np.uint64)]), axis=1)
            words, at = np.unique(pairs[0], return_inverse=True)
            bad = toxic[i:j][pairs[1].astype(np.int64)]
            yield pa.record_batch(
                [pa.array(words.view(np.int64)),
                 pa.array(np.bincount(at, bad).astype(np.int64)),
                 pa.array(np.bincount(at, ~bad).astype(np.int64))], names=["word", "bad", "good"])


def _windows(words: np.ndarray):
    """(toxic, text) to token windows: word numbers (int32) and labels (int8) as bytes, whether any is toxic,
    and a draw by text and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, toxic = b.column(1).to_pylist(), np.asarray(b.column(0).to_pylist(), bool)
            for i, j in text_slices(texts):
                w = LetterWords(texts[i:j])
                if not len(w.hashes):
                    continue
                number, label, hit, draws = [], [], [], []
                at = np.minimum(np.searchsorted(words, w.hashes), len(words) - 1)
                word = np.where(words[at] == w.hashes, at, -1).astype(np.int32)
                y = (word >= 0) & np.repeat(toxic[i:j], w.count)
                for d in range(j - i):
                    first, last = w.first[d], w.first[d + 1]
                    own = w.hashes[first:last].sum(dtype=np.uint64)
                    place = mix(own + mix(np.arange(first, last, WINDOW).astype(np.uint64) - np.uint64(first)))
                    for k, h in zip(range(first, last, WINDOW), place.tolist()):
                        e = min(k + WINDOW, last)
                        number.append(word[k:e].tobytes())
                        label.append(y[k:e].astype(np.int8).tobytes())
                        hit.append(bool(y[k:e].any()))
                        draws.append(h / 2 ** 64)
                yield pa.record_batch([pa.array(number, pa.binary()), pa.array(label, pa.binary()),
                                       pa.array(hit, pa.bool_()), pa.array(draws, pa.float64())],
                                      names=["word", "y", "hit", "draw"])

    return run


def held_out_rows(docs: DataFrame) -> DataFrame:
    rest = F.crc32(F.col("doc_id").cast("string")) % MODULUS
    return docs.withColumn("held_out", F.coalesce(rest == HELD, F.lit(False)))


def sample_rows(docs: DataFrame, labels: DataFrame, train_docs: int) -> DataFrame | None:
    """toxic, text and weight of the texts that the fit uses: of each label about ``train_docs / 2`` at most.

    Ids are drawn by their hash.  Rows whose texts are equal but for case and
    white space are one observation (with the label of most of them); other
    texts never are, however alike.  ``weight`` is what a row stands for.
    """
    known = (held_out_rows(labels.where("toxic is not null and doc_id is not null"))
             .where(~F.col("held_out")).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")))
    known = cut(known, "toxic-labels")
    size = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    if len(size) < 2:
        return None
    share = {c: min(1.0, train_docs / 2 / n) for c, n in size.items()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    of_class = F.when(F.col("toxic"), F.lit(share[True])).otherwise(F.lit(share[False]))
    ids = known.where(draw < of_class).select("doc_id", "toxic", (1 / of_class).alias("weight"))
    # about train_docs ids at most, whatever the size of the labels
    chosen = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id")
    plain = F.lower(F.trim(F.regexp_replace("text", r"\s+", " ")))
    text = chosen.groupBy(F.xxhash64(plain).alias("k")).agg(
        (F.avg(F.col("toxic").cast("int")) >= 0.5).alias("toxic"), F.min("text").alias("text"),
        F.max("weight").alias("weight"))
    # repeated ids can bring more texts than ids were drawn
    return cut(text.orderBy(F.xxhash64("k")).limit(2 * train_docs).select("toxic", "text", "weight"), "toxic-sample")


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Chain:
    """A chain fitted on labelled rows that are not held out, see ``sample_rows``."""
    spark = docs.sparkSession
    flat_chain = Chain(np.zeros(0, np.uint64), np.zeros(0), shift=-50.0)
    sample = sample_rows(docs, labels, train_docs)
    if sample is None:
        return flat_chain
    total = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = total.get(True, 0), total.get(False, 0)
    if not n1 or not n0:
        return flat_chain
    stats = sample.select("toxic", "text").mapInArrow(_word_texts, "word long, bad long, good long").groupBy("word").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    p1, p0 = (F.col("bad") + 0.5) / (n1 + 1), (F.col("good") + 0.5) / (n0 + 1)
    p = (F.col("bad") + F.col("good") + 1) / (n1 + n0 + 2)
    z = (p1 - p0) / F.sqrt(p * (1 - p) * (1.0 / n1 + 1.0 / n0))
    listed = stats.where((F.col("bad") >= MIN_TEXTS) & (p1 / p0 >= MIN_RATIO) & (z >= MIN_Z))
    words = np.sort(np.asarray([r["word"] for r in listed.select("word").collect()],
                               np.int64).view(np.uint64))  # bounded by the sample
    chain = Chain(words, np.zeros(len(words)))
    if len(words):
        # a fit sample of bounded size: toxic windows up to half of it, clean ones the rest
        windows = sample.select("toxic", "text").mapInArrow(
            _windows(words), "word binary, y binary, hit boolean, draw double")
        rows = windows.where("hit").orderBy("draw").limit(TRAIN_WINDOWS // 2).collect()
        rows += windows.where("not hit").orderBy("draw").limit(TRAIN_WINDOWS - len(rows)).collect()
        chain.emission, chain.bias, chain.move = fit_chain(
            [(np.frombuffer(r["word"], np.int32), np.frombuffer(r["y"], np.int8)) for r in rows], len(words))
    shared = spark.sparkContext.broadcast(chain)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e, _ = evidence_of(shared.value, b.column(1).to_pylist(), spans=False)
            yield pa.record_batch([b.column(0), pa.array(e), b.column(2)], names=["toxic", "evidence", "weight"])

    pdf = sample.mapInArrow(measure, "toxic boolean, evidence double, weight double").toPandas()
    chain.scale, chain.shift = _logistic(pdf["evidence"].to_numpy(), pdf["toxic"].to_numpy(float),
                                         pdf["weight"].to_numpy())
    return chain


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and intercept of a one-variable weighted logistic fit, by Newton steps."""
    share = weight / weight.mean()
    mean = float((share * y).mean())
    a, b = 0.0, float(np.log((mean + 1e-6) / (1 - mean + 1e-6)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = share * p * (1 - p) + 1e-9
        g = np.array([(share * (y - p) * x).sum() - 1e-3 * a, (share * (y - p)).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        d = np.linalg.solve(h, g)
        a, b = a + float(np.clip(d[0], -1, 1)), b + float(np.clip(d[1], -2, 2))
        if abs(d).max() < 1e-8:
            break
    return max(a, 0.0), b


def score_documents(docs: DataFrame, chain: Chain) -> DataFrame:
    """``row`` (all columns but text), text, score, predicted and spans of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    d = docs.select(F.struct(*others).alias("row"), F.col("text").cast("string").alias("text"))
    kind = d.schema["row"].dataType.simpleString()
    found = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e, runs = evidence_of(shared.value, b.column(1).to_pylist())
            score = shared.value.score(e)
            yield pa.record_batch(
                [b.column(0), b.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                 pa.array(runs, found)], names=["row", "text", "score", "predicted", "spans"])

    return d.mapInArrow(run, f"row {kind}, text string, score double, predicted int, spans {SPANS}")


def toxic_scores(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted and spans of every document."""
    chain = train(docs, labels, train_docs)
    scored = score_documents(held_out_rows(docs.select("doc_id", "text")), chain)
    return scored.select("row.doc_id", "row.held_out", "score", "predicted", "spans")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents whose score is below a half, columns unchanged."""
    kept = score_documents(docs, train(docs, labels)).where("predicted = 0")
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
