"""Embedding whitening: vectors on a grid of whole numbers, projected on the leading components of their covariance.

Entries become ``floor(64 * c) + 1000000``.  The fit list is each distinct grid vector once.  Its sums are exact; its
covariance (centred first, divisor n) is summed from blocks of tasks, and ``spectrum`` finds the leading eigenpairs by
LDL' inertia counts and Rayleigh quotient iteration.  Only numbers of the size of the dimension reach the driver.  Each
row is then centred, projected and scaled to variance one; the covariance of the whitened fit list is measured again.

Rows whose vector is null, or holds null or non-finite entries or such beyond 2^50, are left out.  Vectors must have one
length: that of most distinct ones (the greater of several such); rows of another length are left out too.  A null id is
carried through and repeated rows are whitened alike.  Components of no variance (to rounding) have no scale and are
left out, so there may be fewer than asked for; an empty table, or one of equal vectors, gives no rows.  A deviation
beyond 64 bits is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import stage
from snapstats.llm.spectrum import leading

GRID, SHIFT, COMPONENTS, LARGEST = 64, 1_000_000, 16, 2.0**50
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
BLOCK_ROWS = 4096
NOTHING = 1e-12  # of the trace: variance that is rounding


def grid_rows(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Usable rows of a batch: their places, their lengths, and all their grid entries less ``SHIFT``, one after another."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries are NaN
    usable = np.asarray(column.is_valid()) & (lengths > 0)
    row = np.repeat(np.arange(len(column)), lengths)
    with np.errstate(invalid="ignore"):
        bad = ~(np.abs(entries * GRID) < LARGEST)
    usable[row[bad]] = False
    return np.nonzero(usable)[0], lengths[usable], np.floor(entries[usable[row]] * GRID).astype(np.int64)


def _packed(batches):
    """Grid vectors as bytes, of four or eight a number, so that equal ones are equal."""
    for batch in batches:
        places, lengths, entries = grid_rows(batch.column(0))
        out, ends = [], np.cumsum(lengths)
        narrow = entries.astype("<i4")
        wide = np.add.reduceat(narrow != entries, ends - lengths) > 0 if len(places) else places
        for a, b, w in zip((ends - lengths).tolist(), ends.tolist(), wide.tolist(), strict=True):
            out.append(b"\x08" + entries[a:b].astype("<i8").tobytes() if w else b"\x04" + narrow[a:b].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["x"])


def _unpacked(batches, block: int = BLOCK_ROWS):
    """Blocks of rows as a matrix of longs."""
    for batch in batches:
        for k in range(0, len(batch), block):
            rows = batch.column(0).slice(k, block).to_pylist()
            yield np.stack([np.frombuffer(r, "<i4" if r[0] == 4 else "<i8", offset=1).astype(np.int64) for r in rows])


def _sums(batches):
    total = None
    for rows in _unpacked(batches):
        total = rows.sum(0) + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.int64())], ["i", "s"])


def covariance(vectors: DataFrame, n: int, mean: np.ndarray, basis: np.ndarray | None = None) -> np.ndarray:
    """Of the rows less ``mean``, times ``basis`` if given: sums of products over n."""
    def products(batches):
        total = None
        for rows in _unpacked(batches):
            centred = rows - mean
            centred = centred if basis is None else centred @ basis
            total = centred.T @ centred + (0 if total is None else total)
        if total is not None:
            i, j = (a.ravel() for a in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    size = len(mean) if basis is None else basis.shape[1]
    out = np.zeros((size, size))
    for i, j, v in vectors.mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = v / n
    return out


class Fit:
    """n, sums and mean of the fit list (less ``SHIFT``), eigenvalues, eigenvectors, trace, and the measured error."""

    def __init__(self, vectors: DataFrame, components: int = COMPONENTS):
        size = F.when(F.substring("x", 1, 1) == F.lit(b"\x04"), F.lit(4)).otherwise(F.lit(8))
        sized = vectors.withColumn("d", ((F.octet_length("x") - 1) / size).cast("int"))
        most = sized.groupBy("d").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
        self.n, self.dimension = (most["n"], most["d"]) if most else (0, 0)
        self.values, self.vectors, self.trace, self.error = np.zeros(0), np.zeros((0, 0)), 0.0, 0.0
        self.sums = [0] * self.dimension
        if not self.n:
            return
        own = sized.where(F.col("d") == self.dimension).select("x")
        for i, s in own.mapInArrow(_sums, "i int, s long").groupBy("i").agg(F.sum("s")).collect():
            self.sums[i] = s
        mean = self.mean
        matrix = covariance(own, self.n, mean)
        self.trace = float(np.trace(matrix))
        values, vectors_ = leading(matrix, components)
        kept = values > NOTHING * self.trace
        self.values, self.vectors = values[kept], vectors_[:, kept]
        if kept.any():
            again = covariance(own, self.n, mean, self.basis)
            self.error = float(np.abs(again - np.eye(len(again))).max())

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def basis(self) -> np.ndarray:
        """Columns that project a centred row on components of variance one."""
        return self.vectors / np.sqrt(self.values)


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of (n * x - S)^2, exact; null beyond 64 bits.  ``SHIFT`` cancels out."""
    if len(rows) and n * float(np.abs(rows).max()) + max(map(abs, sums)) < 2**62:
        off = n * rows - np.array(sums, np.int64)
        if len(sums) * float(np.abs(off).max()) ** 2 < 2**62:
            return (off * off).sum(1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in rows.tolist()]
    return [x if x < 2**63 else None for x in exact]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per usable row and component."""
    vectors = stage(embeddings.select("embedding").mapInArrow(_packed, "x binary").distinct(), "whitening-vectors")
    fit = Fit(vectors, components)
    n, sums, mean, basis, size = fit.n, fit.sums, fit.mean if fit.n else None, fit.basis, fit.dimension
    explained, error, k = fit.values / (fit.trace or 1.0), fit.error, len(fit.values)

    def project(batches):
        for batch in batches:
            places, lengths, entries = grid_rows(batch.column(1))
            own = lengths == size
            if not k or not own.any():
                continue
            rows = entries[np.repeat(own, lengths)].reshape(-1, size)
            ids = batch.column(0).take(pa.array(np.repeat(places[own], k)))
            deviation = pa.array(deviations(rows, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k)))
            whitened = (rows - mean) @ basis
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()), pa.array(np.full(len(ids), n), pa.int64()), deviation,
                pa.array(whitened.ravel()), pa.array(np.tile(explained, len(rows))), pa.array(np.full(len(ids), error))],
                [f.split()[0] for f in RESULT.split(", ")])

    return embeddings.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(project, RESULT)
