"""Whitening of embeddings by an exact spectrum.

Entries become whole numbers, so count, sums and scatter are exact integers
that Spark adds up in any order. The scatter's characteristic polynomial is
computed modulo primes and combined, its real roots are isolated exactly, and
components come from the null space at each root (``exact_spectrum``). Vectors
are never shuffled: three passes read a stored table, and what reaches the
driver has the size of the dimension squared.

Defined cases: rows whose vector is NULL or holds a NULL, NaN or infinite
entry are dropped, and so are vectors of another length than the most frequent
one (the longer of two equally frequent ones); repeated rows count each time; a
NULL id stays. A direction without any variance has no scale: only components
of positive eigenvalue are returned, so a table of equal vectors, or an empty
one, gives no rows. A deviation beyond 64 bits is NULL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm import exact_spectrum as S
from txnflow.llm.common import column as named
from txnflow.llm.common import store
from txnflow.llm.words import list_array

SCALE, SHIFT = 64, 1_000_000
MOST = 32
#: Rows multiplied at once; with entries below 2^20 their products add up exactly as doubles.
BLOCK, SMALL = 4096, 1 << 20


@dataclass(frozen=True)
class Whitening:
    """What a fit learns. ``sums`` are of the shifted entries x - SHIFT."""

    n: int
    sums: list[int]
    components: np.ndarray  # dimension x components, unit columns
    scales: list[float]  # square roots of the scatter's eigenvalues
    explained: list[float]


def whole_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, y): the usable vectors as whole numbers floor(SCALE * c), stored; x is y + SHIFT."""
    v = named(vector).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    good = df.where(named(vector).isNotNull() & finite)
    whole = store(good.select(named(id_column).alias("id"), F.transform(v, lambda c: F.floor(c * SCALE)).alias("y")), "vectors")
    lengths = whole.groupBy(F.size("y").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "d"))["d"]).first()[0]
    return whole.where(F.size("y") == most) if most else whole.where("false")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    y = batch.column("y")
    return y.flatten().to_numpy().reshape(len(y), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count (-2, 0), sums (-1, j) and sums of products (i, j) of a task's rows, exact."""
    n, total, products = 0, None, None
    for batch in batches:
        if not len(batch):
            continue
        y = _matrix(batch)
        if total is None:
            d = y.shape[1]
            total, products = np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
        for at in range(0, len(y), BLOCK):
            part = y[at : at + BLOCK]
            n += len(part)
            if np.abs(part.astype(float)).max() < SMALL:
                part = part.astype(float)
                products += (part.T @ part).astype(np.int64).astype(object)
                total += part.sum(axis=0).astype(np.int64).astype(object)
            else:
                part = part.astype(object)
                products += part.T.dot(part)
                total += part.sum(axis=0)
    if total is None:
        return
    d = len(total)
    rows = [(-2, 0, n), *((-1, j, total[j]) for j in range(d))]
    rows += [(i, j, products[i, j]) for i in range(d) for j in range(i, d)]
    i, j, v = zip(*rows)
    values = pa.array([Decimal(int(x)) for x in v], pa.decimal128(38, 0))
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], ["i", "j", "v"])


def fit(vectors: DataFrame, most: int = MOST) -> Whitening | None:
    """The whitening of ``whole_vectors``; None where nothing varies."""
    sums = vectors.select("y").mapInArrow(_sums, "i int, j int, v decimal(38, 0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    got = {(i, j): int(v) for i, j, v in sums.collect()}  # one number for each pair of dimensions
    if not got:
        return None
    n, d = got[-2, 0], sum(i == -1 for i, _ in got)
    total = [got[-1, j] for j in range(d)]
    # n^2 times the covariance
    scatter = [[n * got[min(i, j), max(i, j)] - total[i] * total[j] for j in range(d)] for i in range(d)]
    spark = vectors.sparkSession
    roots = S.largest_roots(S.characteristic_polynomial(spark, scatter), min(most, d))
    found = S.components(spark, scatter, roots, min(most, d))
    if not found:
        return None
    whole = sum(scatter[i][i] for i in range(d)) << S.ROOT_BITS
    return Whitening(
        n,
        total,
        np.array([v for _, v in found]).T,
        [math.sqrt(root / (1 << S.ROOT_BITS)) for root, _ in found],
        [root / whole for root, _ in found],
    )


def _centred(y: np.ndarray, model: Whitening) -> np.ndarray:
    """n * y - sums, exact."""
    most = model.n * int(np.abs(y.astype(float)).max(initial=0)) + max(map(abs, model.sums))
    if most < 1 << 62:
        return model.n * y - np.array(model.sums, dtype=np.int64)
    return model.n * y.astype(object) - np.array(model.sums, dtype=object)


def _project(centred: np.ndarray, model: Whitening) -> np.ndarray:
    # both n of the mean and of the scale cancel
    return (centred.astype(float) @ model.components) / np.array(model.scales)


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened): deviation is the sum of (n x - S)^2, whitened an array of components."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            centred = _centred(_matrix(batch), model)
            w = _project(centred, model)
            out = list_array(pa.array(w.ravel()), np.full(len(w), w.shape[1]))
            if float(np.abs(centred.astype(float)).max()) ** 2 * centred.shape[1] < 2**62:
                deviation = pa.array((centred.astype(np.int64) ** 2).sum(axis=1))
            else:
                exact = (centred.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([v if v < 1 << 63 else None for v in exact.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), deviation, out], ["id", "deviation", "whitened"])

    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(task, f"id {id_type}, deviation long, whitened array<double>")


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = len(model.scales)
        total = np.zeros((c + 1, c))
        for batch in batches:
            if len(batch):
                w = _project(_centred(_matrix(batch), model), model)
                total[:c] += w.T @ w
                total[c] += w.sum(axis=0)
        i, j = np.indices(total.shape)
        columns = [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "v"])

    rows = vectors.select("y").mapInArrow(task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    c = len(model.scales)
    total = np.zeros((c + 1, c))
    for i, j, v in rows.collect():  # components squared
        total[i, j] = v
    mean = total[c] / model.n
    return float(np.abs(total[:c] / model.n - np.outer(mean, mean) - np.eye(c)).max())


def whiten(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", most: int = MOST) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    vectors = whole_vectors(df, id_column, vector)
    model = fit(vectors, most)
    if model is None:
        kind = vectors.schema["id"].dataType.simpleString()
        schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, model)
    rows = transform(vectors, model).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*(F.lit(x) for x in model.explained))
    return rows.select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
