"""Whitening of embeddings by shifted Cholesky QR.

Rows become whole numbers on a grid, and each distinct row is fitted once. The centred rows are orthogonalised without
ever being gathered: a pass over them adds up the Gram matrix of the rows times all inverse factors so far (triangular
solves in the tasks), the driver takes the next Cholesky factor of it, shifted as long as the rows may be too near to
dependence, and passes go on until the Gram matrix is a projection. The product of the factors has the singular values
and right vectors of the centred rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wayfold.llm.batches import slices
from wayfold.session import durable

SCALE, SHIFT = 64, 1_000_000
#: An entry times ``SCALE`` beyond this has no whole number of 64 bits for certain; its row is left out as if it were not finite.
FARTHEST = float(1 << 61)
#: A pass ends the search when the Gram matrix is a projection to this.
ORTHOGONAL = 1e-12
MOST_PASSES = 12
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """What the fit leaves: number and exact sums of the distinct rows, unit components by falling eigenvalue, and quality figures."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # one per row
    eigenvalues: np.ndarray  # zero where the rows have no extent
    trace: float
    passes: int
    identity_error: float | None


def on_grid(embedding: str | Column) -> Column:
    """The row as whole numbers, ``floor(SCALE c) + SHIFT``; null for a null or empty row or one with a null or non-finite entry."""
    v = F.col(embedding) if isinstance(embedding, str) else embedding
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < FARTHEST / SCALE))
    return F.when((F.size(v) > 0) & usable, F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT))


def _matrix(batch: pa.RecordBatch, name: str, d: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(-1, d)


def _sums(x: DataFrame, d: int) -> tuple[int, list[int]]:
    """Exact number and sums of rows: low and high halves of the entries are added up apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            m = _matrix(batch, "x", d)
            n += len(m)
            low += (m & 0xFFFFFFFF).sum(0)
            high += (m >> 32).sum(0)
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()), "low": low, "high": high})

    parts = x.mapInArrow(run, "i int, n long, low long, high long").groupBy("i").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high")],
    )
    rows = {r["i"]: r for r in parts.collect()}  # one row per dimension
    if not rows:
        return 0, [0] * d
    return rows[0]["n"], [int(rows[i]["low"]) + (int(rows[i]["high"]) << 32) for i in range(d)]


def scaled_difference(m: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S`` without rounding: in 64 bits where that is certain to suffice, else in Python's integers."""
    most = max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0
    if n * most < 1 << 61 and max(map(abs, sums), default=0) < 1 << 61:
        return n * m - np.array(sums, np.int64)
    return n * m.astype(object) - np.array(sums, object)


def _centred(m: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return scaled_difference(m, n, sums).astype(np.float64) / n


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """The rows times the inverse of each upper factor in turn, by substitution over the columns."""
    for r in factors:
        q = np.empty_like(rows)
        for j in range(r.shape[0]):
            q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        rows = q
    return rows


def _gram(x: DataFrame, d: int, n: int, sums: list[int], factors: list[np.ndarray], onto: np.ndarray | None = None) -> np.ndarray:
    """Gram matrix of the centred rows times all inverse factors (and then ``onto``), one sum per task, added up entry by entry."""
    width = d if onto is None else onto.shape[1]
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in slices(batches, 2048):
            q = _solved(_centred(_matrix(batch, "x", d), n, sums), factors)
            q = q if onto is None else q @ onto
            total += q.T @ q
        yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(len(upper[0])), pa.int32()), "v": total[upper]})

    entries = x.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
    gram = np.zeros((width, width))
    for k, v in entries.collect():  # half of width x width numbers, whatever the number of rows
        gram[upper[0][k], upper[1][k]] = gram[upper[1][k], upper[0][k]] = v
    return gram


def fit(x: DataFrame, d: int, most: int = 16) -> Whitening:
    """Components of the distinct rows ``x`` (a written table: it is read once per pass) of ``d`` whole numbers."""
    n, sums = _sums(x, d)
    none = Whitening(n, tuple(sums), np.eye(d), np.zeros(d), 0.0, 0, None)
    if n == 0:
        return none
    gram = _gram(x, d, n, sums, [])
    size = float(np.trace(gram))
    if size == 0:
        return none
    factors: list[np.ndarray] = []
    unit = np.finfo(float).eps / 2
    while True:
        # The shift keeps the factor real whatever the condition; once rows are near orthogonal it is below rounding.
        extent = size if not factors else float(np.linalg.norm(gram, 2))
        shift = 11 * (n * d + d * (d + 1)) * unit * extent if not factors else 4 * d * unit * extent
        shift = min(shift, extent / 64)
        factors.append(np.linalg.cholesky(gram + shift * np.eye(d)).T)
        gram = _gram(x, d, n, sums, factors)
        if np.abs(gram @ gram - gram).max() <= ORTHOGONAL or len(factors) >= MOST_PASSES:
            break
    r = np.eye(d)
    for factor in factors:
        r = factor @ r
    # The last Gram matrix is the identity, or a projection where the rows have fewer dimensions than columns.
    held, vectors = np.linalg.eigh(gram)
    _, singular, components = np.linalg.svd(np.sqrt(np.where(held > 0.5, held, 0.0))[:, None] * vectors.T @ r)
    eigenvalues = singular**2 / n
    eigenvalues[eigenvalues <= eigenvalues[0] * 1e-22] = 0.0
    eigenvalues[int((held > 0.5).sum()) :] = 0.0
    k = int((eigenvalues[:most] > 0).sum())
    covariance = _gram(x, d, n, sums, [], components[:k].T / np.sqrt(eigenvalues[:k])) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(n, tuple(sums), components, eigenvalues, float(eigenvalues.sum()), len(factors), error)


def _exact_squares(difference: np.ndarray) -> list[int | None]:
    """Sums of squares of whole numbers; null where 64 bits do not hold the sum."""
    rough = (difference.astype(np.float64) ** 2).sum(1)
    if difference.dtype != object and (len(rough) == 0 or rough.max() < 2.0**62):
        return (difference * difference).sum(1).tolist()
    exact = (sum(int(v) ** 2 for v in row) for row in difference)
    return [v if v < 1 << 63 else None for v in exact]


def transform(rows: DataFrame, model: Whitening, most: int = 16) -> DataFrame:
    """Whitened coordinates of rows ``vec_id``, ``x``, one per row and component."""
    d, n, sums = len(model.sums), model.n, list(model.sums)
    k = min(most, d)
    values = model.eigenvalues[:k]
    onto = model.components[:k].T / np.sqrt(np.where(values > 0, values, np.nan))
    explained = [float(v / model.trace) if model.trace else None for v in values]
    error, schema = model.identity_error, to_arrow_schema(StructType.fromDDL(OUT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            difference = scaled_difference(_matrix(batch, "x", d), n, sums)
            whitened = (difference.astype(np.float64) / n) @ onto
            here = len(difference)
            at = pa.array(np.repeat(np.arange(here), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1), here), pa.int32()), pa.array([n] * (here * k), pa.int64()),
                    pa.array(_exact_squares(difference), pa.int64()).take(at), pa.array(whitened.ravel(), from_pandas=True),
                    pa.array(explained * here, pa.float64()), pa.array([error] * (here * k), pa.float64()),
                ],
                schema=schema,
            )

    return rows.mapInArrow(run, OUT)


def whiten(vectors: DataFrame, embedding: str = "embedding", most: int = 16) -> DataFrame:
    """Whitened coordinates of every usable row, with the number fitted, exact deviation, share of the variance and the error left.

    A row is left out if its vector is null or empty, holds a null or non-finite entry or one too large for whole numbers, or
    has another length than most usable rows (of equally frequent lengths, the smaller). Equal rows are fitted once and each
    returned; a dimension without extent changes nothing. A component without extent has a share of 0 and no coordinate
    (null), and if no row differs there is no share either. No rows give no rows. Other columns are left out.
    """
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), on_grid(embedding).alias("x")).where(F.col("x").isNotNull())
    lengths = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], OUT)
    d = lengths["d"]
    x = x.where(F.size("x") == d)
    model = fit(durable(x.select("x").distinct(), "distinct_vectors"), d, most)
    return transform(x, model, most)
