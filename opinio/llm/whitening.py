"""Embedding whitening by mixed-precision refinement of eigenvectors.

Vectors become integers x (``floor(scale * c) + offset``), so that counts, sums and
deviations are exact. Three passes over the table, each a map whose partial sums are combined
by grouped aggregation before they reach the driver (d, d*d and k*k numbers for d
dimensions and k components, whatever the number of rows):

1. n and the sums S of every dimension, exact.
2. The covariance V, centred before multiplying: x minus the whole part of S/n is exact, the
   broken part is subtracted in double precision.
3. The covariance of the whitened rows, which gives ``identity_error``.

Eigenvectors of V are found on the driver in float32 first and corrected by Ogita-Aishima
iterations: with R = I - X'X and T = X'VX, formed by matrix multiplications in extended
precision, X becomes X + XE, where E follows from R, T and the gaps between eigenvalues. Eigenvalues
closer than the iteration can tell apart form clusters; a cluster's vectors are
rotated by the solution of their own small problem, X_c'(V - m)X_c in double precision, then iterated again.

Edge cases. NULL vectors and vectors with NULL or non-finite entries are dropped; so are vectors whose
number of entries is not the most frequent one (of equally frequent ones the larger stays) and
vectors with an entry that has no integer form (2^52 or more in size). Repeated rows count each; a NULL vec_id is carried through.
Components without variance (eigenvalue at most 1e-12 of the trace) cannot be whitened and
give no rows, so one row alone, or equal rows alone, give none. ``deviation`` is NULL where it exceeds a
long. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import ship, table

ship(__name__)

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
FLAT = 1e-12  # share of the trace below which a component has no variance
LARGEST = float(1 << 52)
NEAR = 1e-14  # gap between eigenvalues, as a share of the largest, that double precision cannot tell from none
SETTLED = 1e-9  # a correction this small leaves an error of its square


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """(rows, dimensions) integers x of a batch of usable vectors."""
    column = batch["vector"]
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * values.reshape(len(column), -1)).astype(np.int64) + OFFSET


def usable(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, vector as doubles) of the rows that take part, and their number of dimensions."""
    v = F.col("vector")
    fit = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    # false for NaN, too: NaN is larger than any number here
    fit = fit.where(v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & (F.abs(e) * SCALE < LARGEST)) & (F.size(v) > 0))
    sizes = fit.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.max(F.struct("n", "d"))).first()[0]
    d = int(top["d"]) if top else 0
    return fit.where(F.size(v) == d), d


def _summed(rows: DataFrame, partial, kind: str) -> dict[int, object]:
    """Sums by place of what ``partial`` (batches -> array) gives for each task."""
    np_kind = np.int64 if kind == "bigint" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = partial(batches)
        if total is not None:
            flat = np.asarray(total, np_kind).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int64)), pa.array(flat)], ["place", "value"])

    out = rows.mapInArrow(run, f"place bigint, value {kind}").groupBy("place").agg(
        F.sum(F.col("value").cast("decimal(38,0)") if kind == "bigint" else F.col("value")).alias("value"))
    got = out.toArrow()
    return dict(zip(got["place"].to_pylist(), got["value"].to_pylist()))


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, sums of x by dimension)."""
    def partial(batches):
        total = None
        for b in batches:
            if b.num_rows:
                x = _matrix(b)
                mine = np.append(x.sum(0), len(x))
                total = mine if total is None else total + mine
        return total

    sums = _summed(rows, partial, "bigint")
    return int(sums.get(d, 0)), [int(sums.get(k, 0)) for k in range(d)]


def centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whole and broken part of the means."""
    whole = [s // n for s in sums]
    return np.array(whole, np.int64), np.array([(s - w * n) / n for s, w in zip(sums, whole)])


def covariance(rows: DataFrame, n: int, sums: list[int], project: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of x, or of its centred projections."""
    whole, broken = centre(n, sums)

    def partial(batches):
        total = None
        for b in batches:
            if b.num_rows:
                y = (_matrix(b) - whole).astype(np.float64) - broken
                y = y if project is None else y @ project
                total = y.T @ y if total is None else total + y.T @ y
        return total

    size = len(sums) if project is None else project.shape[1]
    got = _summed(rows, partial, "double")
    v = np.array([got.get(k, 0.0) for k in range(size * size)]).reshape(size, size) / n
    return (v + v.T) / 2


def _clusters(values: np.ndarray, gap: float) -> list[slice]:
    """Runs of two or more neighbours (values rise) that lie within ``gap`` of the one before."""
    ends = [0, *(np.flatnonzero(np.diff(values) > gap) + 1).tolist(), len(values)]
    return [slice(a, b) for a, b in zip(ends, ends[1:]) if b - a > 1]


def refined_eigenvectors(v: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix."""
    norm = float(np.abs(v).sum(1).max())
    if norm == 0:
        return np.zeros(len(v)), np.eye(len(v))
    a = (v / norm).astype(np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    one = np.eye(len(v), dtype=np.longdouble)
    for _ in range(rounds):
        r = one - x.T @ x
        t = x.T @ a @ x
        values = t.diagonal() / (1 - r.diagonal())
        off = t - np.diag(values)
        # eigenvalues closer than the remaining error (or double precision) allows to tell apart are a cluster
        near = max(10 * (float(np.linalg.norm(off.astype(float), 2)) + float(np.linalg.norm(r.astype(float), 2))), NEAR)
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > near
        e = np.where(apart, (t + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
        x = x + x @ e
        order = np.argsort(values.astype(float), kind="stable")
        x, values = x[:, order], values[order]
        for c in _clusters(values.astype(float), near):
            mid = values[c].mean()
            own = x[:, c].T @ (a @ x[:, c] - mid * x[:, c])
            x[:, c] = x[:, c] @ np.linalg.eigh(((own + own.T) / 2).astype(float))[1]
        if float(np.abs(e).max()) < SETTLED:
            break
    x = x / np.sqrt((x * x).sum(0))
    values = ((a @ x) * x).sum(0) * norm
    order = np.argsort(-values.astype(float), kind="stable")
    return values[order].astype(float), x[:, order].astype(float)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component."""
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    rows, d = usable(rows, id_col, vector_col)
    if d == 0:
        return spark.createDataFrame([], schema)
    n, sums = exact_sums(rows, d)
    v = covariance(rows, n, sums)
    values, vectors = refined_eigenvectors(v)
    trace = float(np.trace(v))
    kept = [k for k in range(min(components, d)) if values[k] > FLAT * trace]
    if not kept:
        return spark.createDataFrame([], schema)
    share = values[kept] / trace
    scaled = vectors[:, kept] / np.sqrt(values[kept])
    error = float(np.abs(covariance(rows, n, sums, scaled) - np.eye(len(kept))).max())
    whole, broken = centre(n, sums)
    rest = np.array([s - int(w) * n for s, w in zip(sums, whole)], object)  # n * broken, exact

    def deviations(y: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)^2 for y = x - whole: exact, in Python's integers where 64 bits may not do."""
        if (float(np.abs(y).max()) + 1) * n * d ** 0.5 < 2.0 ** 31:
            z = n * y - rest.astype(np.int64)
            return (z * z).sum(1).tolist()
        z = n * y.astype(object) - rest
        return [s if s < 1 << 63 else None for s in (z * z).sum(1).tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            y = _matrix(b) - whole
            white, m, k = (y.astype(np.float64) - broken) @ scaled, len(y), len(kept)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                b["vec_id"].take(pa.array(each)), pa.array(np.tile(np.array(kept, np.int32) + 1, m)),
                pa.array(np.full(m * k, n)), pa.array(deviations(y), pa.int64()).take(pa.array(each)),
                pa.array(white.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def op12_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
