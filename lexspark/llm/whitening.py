"""Whitening of embeddings by matrix-free block subspace iteration.

The covariance V is never formed. A block Q of orthonormal columns is refined: one Spark pass over the centred rows X
gives Xᵀ(XQ)/n = VQ, a Rayleigh-Ritz step turns the block towards V's eigenvectors, and the residuals |Vq - eq| of the
wanted columns, which follow from the same pass, decide whether another pass is needed. Columns beyond the wanted ones
guard them; where residuals fall slowly, because eigenvalues are close, the block is widened, up to all of the space,
where one step is exact. So the iteration always ends with certified components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm._scratch import Scratch
from lexspark.operators.relational import spread

#: The grid: an entry c becomes floor(GRID * c) + SHIFT.
GRID, SHIFT = 64, 1_000_000
#: Columns of the first block for each wanted component, and passes in which residuals must fall to a quarter.
GUARD, PATIENCE = 4, 4
#: Residuals, as a share of the largest eigenvalue, at which components count as found.
TOLERANCE = 1e-13
#: Partial results that one task adds up, and lengths of vectors that are told apart.
FANIN, LENGTHS = 64, 64
#: Components whose eigenvalue is a smaller share of the trace than this have no spread to divide by.
FLAT = 1e-12


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    x = batch.column(column)
    return x.flatten().to_numpy().reshape(len(x), -1)


def _summed(rows: DataFrame, part, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all tasks of the float arrays that ``part`` makes of a task's batches: first within tasks, then of
    some tasks' arrays in a task until few are left, so that the driver adds up at most ``FANIN`` of them."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                got = part(batch)
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float64).tobytes()], pa.binary())], ["total"])

    def more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column(0):
                got = np.frombuffer(x.as_py())
                total = got.copy() if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    sums, tasks = rows.mapInArrow(first, "total binary"), rows.rdd.getNumPartitions()
    while tasks > FANIN:
        tasks = -(-tasks // FANIN)
        sums = sums.repartition(tasks).mapInArrow(more, "total binary")
    return sum((np.frombuffer(bytes(r.total)) for r in sums.collect()), np.zeros(int(np.prod(shape)))).reshape(shape)


class Components:
    """Leading eigenvectors of the covariance of distinct integer rows: ``vectors`` (columns), ``values``, ``trace``, ``n``,
    ``sums``, ``passes`` over the rows and ``residual``, the largest certified one as a share of the first eigenvalue."""

    def __init__(self, fit: DataFrame, dims: int, k: int, tolerance: float = TOLERANCE, guard: int = GUARD, seed: int = 0):
        self.n, self.sums = _sums(fit, dims)
        n, sums = self.n, self.sums
        block = min(dims, max(1, guard * k))
        rng = np.random.default_rng(seed)
        q = np.linalg.qr(rng.standard_normal((dims, block)))[0]
        self.passes, best, waited = 0, np.inf, 0
        k = min(k, dims)
        while True:
            got = _summed(fit, lambda batch, q=q: _product(_matrix(batch), n, sums, q), (dims + 1, block))
            vq, self.trace = got[:dims] / n, got[dims, 0] / n
            self.passes += 1
            # the best combinations of the block, their eigenvalues, and how far each is from an eigenvector
            small = q.T @ vq
            values, turn = np.linalg.eigh((small + small.T) / 2)
            order = np.argsort(values)[::-1]
            values, turn = values[order], turn[:, order]
            vectors, images = q @ turn, vq @ turn
            residual = np.linalg.norm(images - vectors * values, axis=0)[:k].max() / max(values[0], np.finfo(float).tiny)
            if self.trace <= 0 or residual <= tolerance * max(1.0, np.sqrt(dims) / 8):
                break
            if block == dims and self.passes > 1 and residual >= best / 2:
                if residual > 1e-10:
                    raise RuntimeError(f"residuals stay at {residual:.3g} of the largest eigenvalue")
                break  # the whole space: rounding is all that is left
            if residual <= best / 4:
                best, waited = residual, 0
            else:
                waited += 1
            q = np.linalg.qr(vectors if block == dims else images)[0]
            if waited >= PATIENCE and block < dims:
                wider = min(dims, 2 * block)
                q = np.linalg.qr(np.hstack([q, rng.standard_normal((dims, wider - block))]))[0]
                block, waited = wider, 0
        kept = [i for i in range(k) if self.trace > 0 and values[i] > FLAT * self.trace]
        self.vectors, self.values, self.residual = vectors[:, kept], values[kept], float(residual)


def _sums(fit: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """The number of rows and the exact sums of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, dtype=object)
        for batch in batches:
            n += batch.num_rows
            total += _matrix(batch).astype(object).sum(axis=0) if np.abs(_matrix(batch)).max(initial=0) > 1 << 40 else _matrix(batch).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array([*range(-1, dims)], pa.int32()), pa.array([str(x) for x in (n, *total)], pa.string())], ["at", "total"])

    added = fit.mapInArrow(run, "at int, total string").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r["at"]: int(r["total"]) for r in added.collect()}  # a row for each dimension
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(dims)], dtype=object)


def _exact(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums as whole numbers: longs, or Python's where these do not hold them."""
    most = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0)
    return n * x - sums.astype(np.int64) if most < 1 << 62 else n * x.astype(object) - sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less the mean, from the exact difference."""
    return _exact(x, n, sums).astype(np.float64) / n


def _product(x: np.ndarray, n: int, sums: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Xᵀ(XQ) of a batch of rows; one more row begins with the sum of all squares."""
    c = _centred(x, n, sums)
    last = np.zeros((1, q.shape[1]))
    last[0, 0] = (c * c).sum()
    return np.vstack([c.T @ (c @ q), last])


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """The exact sum over dimensions of (n * x - sums) ** 2 of each row; beyond a long it is refused."""
    d = _exact(x, n, sums)
    if d.dtype == object or d.shape[1] * (int(np.abs(d).max(initial=0)) ** 2) >= 1 << 63:
        out = (d.astype(object) ** 2).sum(axis=1).tolist()
        if any(y >= 1 << 63 for y in out):
            raise OverflowError("a deviation is beyond a long")
        return out
    return (d * d).sum(axis=1).tolist()


def whiten(rows: DataFrame, k: int = 16, tolerance: float = TOLERANCE, guard: int = GUARD) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue, residual, passes): a row for each
    row of ``rows`` (vec_id, embedding) with a finite vector and each component up to ``k``.

    Entries go to a grid of whole numbers; components are unit eigenvectors of the covariance of the distinct grid vectors
    (divisor n), numbered from 1 by falling eigenvalue, each of one sign for all rows, with residuals of at most ``tolerance``
    of the largest eigenvalue (or of rounding, where the block has become the whole space). ``identity_error`` is measured
    over the distinct vectors in one more pass.

    Rows whose vector is null or holds null or non-finite entries are left out. Vectors of each length are fitted apart,
    and empty ones have no components; more than ``LENGTHS`` lengths are refused. Components without spread (an eigenvalue
    below 1e-12 of the trace, as with fewer distinct vectors than components) have no rows. Rows that repeat get rows
    each; a null id passes. Entries whose grid value is beyond a long, and deviations beyond one, raise an error. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "whitening")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double, residual double, passes int"
    v = F.col("embedding").cast("array<double>")
    finite = F.col("embedding").isNotNull() & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    grid = F.transform(v, lambda c: F.when(F.abs(c * GRID) < float(1 << 62), F.floor(c * GRID) + SHIFT).otherwise(F.raise_error("an entry is beyond the grid").cast("long")))
    table = spread(rows.select("vec_id", "embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(finite).select("vec_id", grid.alias("x")).withColumn("length", F.size("x"))
    table = scratch.write(table, "grid")
    lengths = sorted(r["length"] for r in table.where("length > 0").select("length").distinct().limit(LENGTHS + 1).collect())
    if len(lengths) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    out = spark.createDataFrame([], schema)
    for dims in lengths:
        own = table.where(F.col("length") == dims)
        fit = scratch.write(own.select("x").distinct(), "distinct")
        found = Components(fit, dims, k, tolerance, guard)
        n, sums, scale = found.n, found.sums, found.vectors / np.sqrt(found.values) if len(found.values) else found.vectors
        size = scale.shape[1]
        if not size:
            continue
        gram = _summed(fit, lambda batch, n=n, sums=sums, scale=scale: (lambda y: y.T @ y)(_centred(_matrix(batch), n, sums) @ scale), (size, size)) / n
        error = float(np.abs(gram - np.eye(size)).max())
        scratch.drop(fit)
        out = out.unionByName(own.select("vec_id", "x").mapInArrow(_projector(found, scale, error), schema))
    return out


def _projector(found: Components, scale: np.ndarray, error: float):
    n, sums, size = found.n, found.sums, scale.shape[1]
    explained = found.values / found.trace
    values, residual, passes = found.values, found.residual, found.passes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = _matrix(batch)
            y = _centred(x, n, sums) @ scale
            each = np.repeat(np.arange(rows), size)
            columns = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * size, n, dtype=np.int64)),
                pa.array(_deviation(x, n, sums), pa.int64()).take(pa.array(each)),
                pa.array(y.ravel()),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * size, error)),
                pa.array(np.tile(values, rows)),
                pa.array(np.full(rows * size, residual)),
                pa.array(np.full(rows * size, passes, dtype=np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue", "residual", "passes"])

    return run
