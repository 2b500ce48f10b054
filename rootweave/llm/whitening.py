"""Whitening of vectors: centred, projected on their main components, scaled to unit variance.

Components become whole numbers, x = floor(``scale`` * c) + ``offset``, so that sums and distances from
the mean are exact. The covariance comes from two passes: sums first, then products of the centred
vectors, added up per task and then by pair of dimensions. The covariance is a table of dimension by
dimension numbers, which no number of rows enlarges; its largest eigenpairs are found on the driver by
contour integration, see :mod:`rootweave.llm.feast`. A third pass whitens, and two more over its result
measure how far its covariance is from the identity.

Scale: every pass reads each row once and shuffles per task one number for each pair of dimensions;
no row meets another. With d dimensions a task holds d * d numbers.

Defined cases: rows whose vector is null or holds null or non-finite components, or components of
``LIMIT`` or more, are dropped, and so are empty vectors, which have no components; vectors of different
lengths are fitted apart, n counts those of one length; components without variance (an eigenvalue of
at most ``FLAT`` of the trace) are left out, so a single vector gives no row; a deviation beyond a long is
null; null and repeated ids are kept as they are; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootweave.llm import feast
from rootweave.llm.common import arrow_batches
from rootweave.workspace import Workspace

LIMIT = 1 << 40
FLAT = 1e-12
RESULT = "n long, deviation long, component int, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Fit:
    """What the vectors of one length have in common."""

    n: int
    sums: np.ndarray
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors in columns
    trace: float


def _numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> DataFrame:
    """(dim, _id, x) of the rows that remain."""
    c = F.col(vector_col).cast("array<double>")
    usable = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LIMIT))
    x = F.transform(c, lambda v: F.floor(v * scale) + F.lit(offset).cast("long"))
    return vectors.filter(usable & (F.size(vector_col) > 0)).select(
        F.size(vector_col).alias("dim"), F.col(id_col).alias("_id"), x.alias("x")
    )


def _rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The column ``x`` of a batch as a matrix."""
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(rows: DataFrame, dim: int) -> tuple[int, np.ndarray]:
    """How many rows there are and the sum of each component; exact for whole numbers."""
    whole = rows.schema["x"].dataType.elementType.typeName() == "long"
    kind = np.int64 if whole else np.float64

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, kind)
        for batch in batches:
            n += batch.num_rows
            total += _rows(batch, dim).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim), pa.int32()), pa.array(np.full(dim, n), pa.int64()), pa.array(total)], names=["i", "n", "total"]
        )

    parts = rows.select("x").mapInArrow(add, f"i int, n long, total {'long' if whole else 'double'}")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    total = np.zeros(dim, kind)
    for row in found:
        total[row["i"]] = row["total"]
    return (found[0]["n"] if found else 0), total


def _covariance(rows: DataFrame, dim: int, n: int, total: np.ndarray) -> np.ndarray:
    """The covariance, divisor n, of the column ``x``; the matrix has dim * dim numbers."""
    upper = np.triu_indices(dim)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = np.zeros((dim, dim))
        for batch in batches:
            centred = _centred(_rows(batch, dim), n, total)
            product += centred.T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(product[upper])], names=["i", "j", "product"]
        )

    found = rows.select("x").mapInArrow(add, "i int, j int, product double").groupBy("i", "j").agg(F.sum("product").alias("product")).collect()
    out = np.zeros((dim, dim))
    for row in found:
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["product"] / n
    return out


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """Rows minus their mean; whole numbers are subtracted before anything is rounded."""
    if x.dtype.kind != "i":
        return x - total / n
    base = total // n
    return (x - base) - (total - base * n) / n


def _deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """The exact squared distance of n * x from the sums, or None beyond a long."""
    largest = float(np.abs(x).max(initial=0)) * n + float(np.abs(total).max(initial=0))
    if largest * largest * x.shape[1] < 2.0**62:
        return ((n * x - total) ** 2).sum(axis=1).tolist()
    scaled = np.array([int(v) for v in total], object)
    exact = (((n * x.astype(object)) - scaled) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def fit(rows: DataFrame, dim: int, components: int) -> Fit:
    """Sums and main components of the ``dim`` long vectors ``x`` of ``rows``."""
    n, total = _sums(rows, dim)
    covariance = _covariance(rows, dim, n, total)
    values, vectors = feast.largest(covariance, components)
    trace = float(np.trace(covariance))
    varied = values > FLAT * trace
    return Fit(n, total, values[varied], vectors[:, varied], trace)


def transform(rows: DataFrame, dim: int, fitted: Fit) -> DataFrame:
    """``rows(dim, _id, x)`` as (_id, deviation, x), the new x being the whitened vector."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        scaled = f.vectors / np.sqrt(f.values)
        for batch in batches:
            x = _rows(batch, dim)
            white = _centred(x, f.n, f.sums) @ scaled
            limits = np.arange(len(x) + 1, dtype=np.int32) * len(f.values)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("_id")), pa.array(_deviations(x, f.n, f.sums), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(limits), pa.array(white.ravel())),
                ],
                names=["_id", "deviation", "x"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.select("_id", "x").mapInArrow(whiten, f"_id {kind}, deviation long, x array<double>")


def whiten(
    vectors: DataFrame, ws: Workspace, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8,
    scale: int = 1024, offset: int = 100_000,
) -> DataFrame:
    """(``id_col``, component, n, deviation, whitened, explained, identity_error), one row per vector and component.

    ``component`` counts from 1 by falling variance, of which ``explained`` is the share; ``identity_error`` is the largest
    entry of the whitened vectors' covariance minus the identity.
    """
    with arrow_batches(vectors.sparkSession):
        rows = ws.stage(_numbers(vectors, id_col, vector_col, scale, offset), "numbers")
        # One row for each length: at most the root of twice the number of all components.
        lengths = [row["dim"] for row in rows.select("dim").distinct().orderBy("dim").collect()]
        return reduce(DataFrame.unionByName, [_whitened(rows.filter(F.col("dim") == d), d, ws, id_col, components) for d in lengths], _none(vectors, id_col))


def _none(vectors: DataFrame, id_col: str) -> DataFrame:
    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.sparkSession.createDataFrame([], f"`{id_col}` {kind}, {RESULT}")


def _whitened(rows: DataFrame, dim: int, ws: Workspace, id_col: str, components: int) -> DataFrame:
    fitted = fit(rows, dim, components)
    kept = len(fitted.values)
    if not kept:
        return _none(rows.withColumnRenamed("_id", id_col), id_col)
    white = ws.stage(transform(rows, dim, fitted), "whitened")
    measured = _covariance(white, kept, *_sums(white, kept))
    error = float(np.abs(measured - np.eye(kept)).max())
    shares = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values])
    each = white.select("_id", "deviation", F.posexplode("x").alias("at", "whitened"))
    return each.select(
        F.col("_id").alias(id_col), F.lit(fitted.n).cast("long").alias("n"), "deviation", (F.col("at") + 1).alias("component"),
        "whitened", shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )
