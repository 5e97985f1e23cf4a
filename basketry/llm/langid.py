"""Language identification with interpolated Kneser-Ney character models.

One model per language over the characters of single words (padded with
spaces, order 5).  Counts of the highest order are raw, lower orders count
distinct preceding characters.  All languages share one sorted array of
n-gram hashes per order; beside each hash lie, per language, the discounted
probability of the n-gram and the weight it passes on as a context.  A text's
language has the lowest cross-entropy per character; a temperature and
per-language rejection limits are calibrated on labelled texts that took no
part in the counts.

Defined results: texts that are null or have no letter are ``und`` with score
0; labels that are null are not learned; rows with a null id count as not
held out; without any labelled row every text is ``und``; repeated rows are
scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, row_key
from .flat import mix
from .letters import LetterWords, ranges, text_slices

ORDER = 5
DISCOUNT = 0.75
PAD = 32
#: The counts use about this many labelled documents of each language, the
#: calibration a fifth as many others: the bound of the fitted sample.
TRAIN_DOCS = 2_000
#: Parts of the texts of a language that has fewer: each is measured by the others' counts.
FOLDS = 5
UNDETERMINED = "und"
#: Share of a language's calibration texts that its rejection limit refuses.
REJECTED_SHARE = 0.002

_ROUND = mix(np.arange(11, 11 + ORDER, dtype=np.uint64)) | np.uint64(1)


def gram_hashes(codes: np.ndarray) -> list[np.ndarray]:
    """Hashes of the n-grams of order 1..n that end at the last of ``codes[:, n]``'s columns."""
    out, h = [], np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1]):
        h = mix(h + (codes[:, codes.shape[1] - 1 - k].astype(np.uint64) + np.uint64(1)) * _ROUND[k])
        out.append(h)
    return out


def padded(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Windows of ORDER characters for each word: at its last pad, each letter and the end.

    Returns the windows and how many belong to each word (letters + 2); the
    first window of a word is its empty context only.
    """
    size = ends - starts
    full = size + ORDER + 1
    base = np.cumsum(full) - full
    line = np.full(int(full.sum()), PAD, np.uint32)
    line[ranges(base + ORDER, size)] = codes[ranges(starts, size)]
    at = ranges(base + ORDER - 1, size + 2)
    return np.lib.stride_tricks.sliding_window_view(line, ORDER)[at - ORDER + 1], size + 2


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, gram, n) of the highest order, added up per slice."""
    for b in batches:
        pdf = pd.DataFrame({"lang": b.column(0).to_pylist(), "text": b.column(1).to_pylist()})
        for lang, own in pdf.groupby("lang"):
            texts = own["text"].tolist()
            for i, j in text_slices(texts):
                w = LetterWords(texts[i:j])
                if not len(w.starts):
                    continue
                _, first, n = np.unique(w.hashes, return_index=True, return_counts=True)
                windows, size = padded(w.codes, w.starts[first], w.ends[first])
                weight = np.repeat(n, size)
                keep = np.ones(len(windows), bool)
                keep[np.cumsum(size) - size] = False
                windows, weight = windows[keep], weight[keep]
                h = gram_hashes(windows)[-1]
                _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
                total = np.bincount(inverse, weight).astype(np.int64)
                line = np.ascontiguousarray(windows[first]).tobytes().decode("utf-32-le", "replace")
                grams = [line[k:k + ORDER] for k in range(0, len(line), ORDER)]
                yield pa.record_batch([pa.array([lang] * len(grams)), pa.array(grams),
                                       pa.array(total)], names=["lang", "gram", "n"])


@dataclass
class LanguageModels:
    """Sorted hashes per order with the languages' probabilities and context weights."""

    langs: list[str]
    keys: list[np.ndarray] = field(default_factory=list)
    alpha: list[np.ndarray] = field(default_factory=list)
    weight: list[np.ndarray] = field(default_factory=list)
    floor: np.ndarray | None = None
    temperature: float = 1.0
    limits: np.ndarray | None = None

    @classmethod
    def from_counts(cls, grams: pd.DataFrame) -> "LanguageModels":
        """``grams``: lang, gram (ORDER characters), n."""
        langs = sorted(grams["lang"].unique())
        raw = "".join(grams["gram"]).encode("utf-32-le")
        codes = np.frombuffer(raw, np.uint32).reshape(-1, ORDER)
        own = pd.Categorical(grams["lang"], langs).codes
        gram = gram_hashes(codes)
        context = gram_hashes(codes[:, :-1])
        self = cls(langs)
        letters = len(np.unique(codes[:, -1])) + 1
        parts = []  # per language and order: grams, alpha, contexts, weight
        for x in range(len(langs)):
            rows = own == x
            n = grams["n"].to_numpy()[rows].astype(float)
            levels = []
            for k in range(ORDER, 0, -1):
                h = gram[k - 1][rows]
                if k == ORDER:
                    unique, first, inverse = np.unique(h, return_index=True, return_inverse=True)
                    count = np.bincount(inverse, n)
                else:  # distinct longer n-grams that end in this one
                    longer, at = np.unique(gram[k][rows], return_index=True)
                    unique, inverse = np.unique(h[at], return_inverse=True)
                    count = np.bincount(inverse).astype(float)
                    order = np.argsort(h, kind="stable")
                    first = order[np.searchsorted(h[order], unique)]
                if k == 1:
                    total = count.sum()
                    levels.append((unique, np.maximum(count - DISCOUNT, 0) / total, None,
                                   DISCOUNT * len(count) / total / letters))
                    continue
                contexts, back = np.unique(context[k - 2][rows][first], return_inverse=True)
                total = np.bincount(back, count)
                types = np.bincount(back)
                levels.append((unique, np.maximum(count - DISCOUNT, 0) / total[back], contexts,
                               DISCOUNT * types / total))
            parts.append(levels[::-1])
        self.floor = np.asarray([p[0][3] for p in parts], np.float32)
        for k in range(ORDER):
            keys = np.unique(np.concatenate(
                [p[k][0] for p in parts] + [p[k + 1][2] for p in parts if k + 1 < ORDER]))
            alpha = np.zeros((len(keys), len(langs)), np.float32)
            weight = np.ones((len(keys), len(langs)), np.float32)
            for x, p in enumerate(parts):
                alpha[np.searchsorted(keys, p[k][0]), x] = p[k][1]
                if k + 1 < ORDER:
                    weight[np.searchsorted(keys, p[k + 1][2]), x] = p[k + 1][3]
            self.keys.append(keys)
            self.alpha.append(alpha)
            self.weight.append(weight)
        return self

    def word_log_probs(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log-probability of each word (with its end) in each language."""
        windows, size = padded(codes, starts, ends)
        p = above = None
        for k, h in enumerate(gram_hashes(windows)):
            at = np.minimum(np.searchsorted(self.keys[k], h), len(self.keys[k]) - 1)
            hit = (self.keys[k][at] == h)[:, None]
            alpha = np.where(hit, self.alpha[k][at], np.float32(0))
            if k == 0:
                p = alpha + self.floor
            else:
                p[1:] = alpha[1:] + above[:-1] * p[1:]
            above = np.where(hit, self.weight[k][at], np.float32(1))
        logs = np.log(p)
        base = np.cumsum(size) - size
        logs[base] = 0
        return np.add.reduceat(logs, base, axis=0)

    def entropies(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text in each language, and its characters."""
        out = np.zeros((len(texts), len(self.langs)))
        chars = np.zeros(len(texts))
        for i, j in text_slices(texts):
            w = LetterWords(texts[i:j])
            if not len(w.starts):
                continue
            _, first, inverse = np.unique(w.hashes, return_index=True, return_inverse=True)
            each = self.word_log_probs(w.codes, w.starts[first], w.ends[first])
            doc, n = w.doc_of(), j - i
            for x in range(len(self.langs)):
                out[i:j, x] = -np.bincount(doc, each[inverse, x], n)
            chars[i:j] = np.bincount(doc, w.ends - w.starts + 1, n)
        return out / np.maximum(chars, 1)[:, None], chars

    def posteriors(self, entropy: np.ndarray) -> np.ndarray:
        z = (entropy.min(axis=1, keepdims=True) - entropy) * self.temperature
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True)

    def calibrate(self, entropy: np.ndarray, truth: np.ndarray) -> None:
        """Temperature of least log loss, and the limit of each language's own texts."""
        best = np.inf
        for t in np.geomspace(0.5, 64, 22):
            self.temperature, keep = t, self.temperature
            loss = -np.log(np.maximum(
                self.posteriors(entropy)[np.arange(len(truth)), truth], 1e-9)).mean()
            if loss < best - 1e-6:
                best = loss
            else:
                self.temperature = keep
        for x in range(len(self.langs)):
            own = entropy[truth == x, x]
            if len(own):
                self.limits[x] = np.quantile(own, 1 - REJECTED_SHARE) * 1.02


def learned_rows(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """held_out of each document: its id's CRC-32 modulo ``parts`` is ``held``."""
    rest = F.crc32(F.col("doc_id").cast("string")) % parts
    return docs.withColumn("held_out", F.coalesce(rest == held, F.lit(False)))


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> LanguageModels | None:
    """Models from rows that are not held out; about ``train_docs`` texts of each language."""
    spark = docs.sparkSession
    known = docs.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return None
    key = row_key(F.col("doc_id"), F.col("lang"), F.col("text"))
    draw = F.pmod(key, F.lit(1 << 30)) / float(1 << 30)
    # languages of fewer texts count them all; each fold is measured by a model without it
    small = F.col("lang").isin([k for k, n in sizes.items() if n < train_docs])
    fold = F.when(small, F.pmod(F.shiftrightunsigned(key, 32), F.lit(FOLDS)).cast("int")).otherwise(-1)
    share = F.create_map(*[F.lit(v) for k, n in sizes.items()
                           for v in (k, min(1.2, 1.2 * train_docs / n))])[F.col("lang")]
    sample = cut(known.where(draw < share)
                 .select("lang", "text", (small | (draw < share / 1.2)).alias("counted"), fold.alias("fold")),
                 "lang-sample")
    counted = sample.where("counted")

    def count(rows: DataFrame) -> pd.DataFrame:
        return (rows.select("lang", "text").mapInArrow(_count_grams, "lang string, gram string, n long")
                .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())  # bounded by the sample

    rows = count(counted)
    if not len(rows):
        return None
    model = LanguageModels.from_counts(rows)
    model.limits = np.full(len(model.langs), np.inf)
    pdf = calibration_rows(sample.where("not counted"), model)
    for k in range(FOLDS) if min(sizes.values()) < train_docs else ():
        rows = count(counted.where(F.col("fold") != k))
        if len(rows):
            pdf = pd.concat([pdf, calibration_rows(sample.where(F.col("fold") == k),
                                                   LanguageModels.from_counts(rows), model.langs)])
    if len(pdf):
        model.calibrate(np.stack(pdf["entropy"].to_numpy()),
                        np.asarray([model.langs.index(x) for x in pdf["lang"]]))
    return model


def calibration_rows(held: DataFrame, model: LanguageModels, langs: list[str] | None = None) -> pd.DataFrame:
    """lang and entropy (in each of ``langs``) of texts that took no part in the model's counts."""
    shared = held.sparkSession.sparkContext.broadcast(model)
    at = [(langs or model.langs).index(x) for x in model.langs]
    width = len(langs or model.langs)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            entropy, chars = shared.value.entropies(b.column(1).to_pylist())
            keep = chars > 0
            yield pa.record_batch(
                [pa.array(np.asarray(b.column(0).to_pylist(), object)[keep], pa.string()),
                 pa.array(list(entropy[keep]), pa.list_(pa.float64()))], names=["lang", "entropy"])

    pdf = held.select("lang", "text").mapInArrow(measure, "lang string, entropy array<double>").toPandas()
    pdf = pdf[pdf["lang"].isin(model.langs)]

    def spread(entropy: np.ndarray) -> np.ndarray:  # a language all of whose texts are held out is no rival
        out = np.full(width, np.inf)
        out[at] = entropy
        return out

    return pdf.assign(entropy=[spread(x) for x in pdf["entropy"]])


def predict(docs: DataFrame, model: LanguageModels | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy (of the predicted language) and rejected."""
    out = "doc_id long, held_out boolean, lang_pred string, score double, entropy double, rejected boolean"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            n = b.num_rows
            lang, score = [UNDETERMINED] * n, np.zeros(n)
            entropy, refused = np.zeros(n), np.ones(n, bool)
            if m is not None and n:
                every, chars = m.entropies(b.column(2).to_pylist())
                best, some = every.argmin(axis=1), chars > 0
                langs = np.asarray(m.langs, object)
                lang = np.where(some, langs[best], UNDETERMINED).tolist()
                score = np.where(some, m.posteriors(every)[np.arange(n), best], 0.0)
                entropy = np.where(some, every[np.arange(n), best], 0.0)
                refused = ~some | (entropy > m.limits[best])
            yield pa.record_batch(
                [b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score),
                 pa.array(entropy), pa.array(refused)],
                names=["doc_id", "held_out", "lang_pred", "score", "entropy", "rejected"])

    return docs.select(F.col("doc_id").cast("long"), "held_out", F.col("text").cast("string")).mapInArrow(run, out)


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Train on the rows that are not held out, predict every row."""
    d = learned_rows(docs)
    return predict(d, train(d, train_docs))
