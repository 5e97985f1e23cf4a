"""Whitening by a covariance over distinct vectors weighted with their multiplicity.

Equal integer vectors are grouped; each distinct one counts with its number of
copies, or once.  Sums are exact; the covariance is a weighted matrix product
of centred vectors; every distinct vector is whitened once and the result is
joined back to the rows.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are left out; so are vectors of another length than the most common
one (of equally common lengths the least stays) and vectors with an entry of
2**31 or more, which have no exact sums in 64 bits.  Rows with a null or a
repeated id stay, each on its own.  Components whose eigenvalue is not above
rounding (none, if all vectors are equal) are not returned; an empty table
gives an empty result.  Columns beside id and vector are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut
from .multi_index import finite, matrix, same_length, spread_join

ENTRY_LIMIT = float(1 << 31)
_LOW = 20  # bits of the low part of an entry when sums are taken
RESULT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
          "explained double, identity_error double")


@dataclass
class Centre:
    """The mean as a whole part and a remainder: mean = base + rest / n, exactly."""

    n: int
    base: np.ndarray  # int64
    rest: np.ndarray  # int64, 0 <= rest < n

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean, rounded once."""
        return (x - self.base).astype(float) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * x - S)**2, exact."""
        d = x - self.base
        reach = (int(np.abs(d).max(initial=0)) + 1) * self.n
        if x.shape[1] * reach * reach < 1 << 62:
            d = d * self.n - self.rest
        else:
            d = d.astype(object) * self.n - self.rest.astype(object)
        return [int(v) for v in (d * d).sum(axis=1)]


def integer_vectors(vectors: DataFrame, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """vec_id and x, the entries as floor(scale * c) + shift, of the rows that take part."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    v = same_length(v.where(finite("v", ENTRY_LIMIT)), "v")
    return v.select("vec_id", F.transform("v", lambda c: (F.floor(c * scale) + shift).cast("long")).alias("x"))


def centre(distinct: DataFrame) -> Centre | None:
    """Exact number and sums of the weighted vectors; one row per dimension reaches the driver."""
    kind = "dim int, high long, low long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, w = matrix(b.column(0)), b.column(1).to_numpy()
                yield pa.record_batch([pa.array(np.arange(x.shape[1], dtype=np.int32)), pa.array(w @ (x >> _LOW)),
                                       pa.array(w @ (x & ((1 << _LOW) - 1))),
                                       pa.array(np.full(x.shape[1], w.sum()))], names=["dim", "high", "low", "n"])

    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    got = (distinct.select("x", "fit").mapInArrow(run, kind).groupBy("dim")
           .agg(whole("high"), whole("low"), whole("n")).orderBy("dim").collect())
    if not got or not got[0]["n"]:
        return None
    n = int(got[0]["n"])
    parts = [divmod((int(r["high"]) << _LOW) + int(r["low"]), n) for r in got]
    return Centre(n, np.array([b for b, _ in parts], np.int64), np.array([r for _, r in parts], np.int64))


def products(rows: DataFrame, vec: str, weight: str, prepare) -> np.ndarray:
    """Sum of weight * v v' over all rows, v = prepare(matrix); dim x dim numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                v = prepare(matrix(b.column(0)))
                part = (v * b.column(1).to_numpy()[:, None].astype(float)).T @ v
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                  names=["i", "j", "v"])

    got = (rows.select(vec, weight).mapInArrow(run, "i int, j int, v double").groupBy("i", "j")
           .agg(F.sum("v").alias("v")).toPandas())
    size = int(got["i"].max()) + 1 if len(got) else 0
    out = np.zeros((size, size))
    out[got["i"], got["j"]] = got["v"]
    out[got["j"], got["i"]] = got["v"]
    return out


def whiten(vectors: DataFrame, components: int = 8, weights: str = "counts") -> DataFrame:
    """``RESULT`` rows for each vector and each of the first ``components``.

    ``weights``: "counts" fits on all rows, "one" on each distinct vector
    once; n and the sums in ``deviation`` are of the fit list.
    """
    spark = vectors.sparkSession
    rows = cut(integer_vectors(vectors), "whiten-rows")
    fit: Column = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    distinct = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")).withColumn("fit", fit)
    distinct = cut(distinct, "whiten-distinct")
    mean = centre(distinct)
    if mean is None:
        return spark.createDataFrame([], RESULT)
    cov = products(distinct, "x", "fit", mean.centred) / mean.n
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > max(values.max(), 0.0) * len(values) * np.finfo(float).eps][:components]
    if not len(order):
        return spark.createDataFrame([], RESULT)
    values, axes = values[order], axes[:, order]
    turn = axes / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(0))
            z = mean.centred(x) @ turn
            exact = [Decimal(d) if d < 10 ** 38 else None for d in mean.deviation(x)]
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(exact, pa.decimal128(38, 0)),
                                   pa.array(list(z), pa.list_(pa.float64()))],
                                  names=["x", "copies", "fit", "deviation", "z"])

    white = cut(distinct.mapInArrow(run, "x array<long>, copies long, fit long, deviation decimal(38,0), "
                                         "z array<double>"), "whiten-values")
    # what came out, not what should have: second moments and means of the whitened values
    with_one = products(white, "z", "fit", lambda z: np.hstack([z, np.ones((len(z), 1))])) / mean.n
    got = with_one[:-1, :-1] - np.outer(with_one[-1, :-1], with_one[-1, :-1])
    error = float(np.abs(got - np.eye(len(got))).max())
    share = F.array(*[F.lit(float(v / np.trace(cov))) for v in values])
    total = int(white.agg(F.sum("copies")).first()[0])
    back = spread_join(rows, white.drop("fit"), "x", "copies", total)
    return (back.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(mean.n).cast("long").alias("n"), "deviation",
                    "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
