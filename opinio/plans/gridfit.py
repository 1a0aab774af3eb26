"""All logistic regressions of a parameter grid at once (M13): one job an iteration.

The training rows are turned into sparse blocks once and kept on the executors, and so is what each model has
come to, in a partition of its own. In every round the models that still run hand their coefficients to all partitions of
the blocks; one pass over the blocks gives the losses and gradients of all of them, added up by model in the
model's own task, which takes the next step: L-BFGS, or its orthant-wise form where there is an L1
share. The driver only learns which models still run, and at the end the coefficients; the rounds end when none is left.

The objective is that of Spark ML's binomial ``LogisticRegression`` with standardisation and an unpenalised intercept:
mean log loss + reg * ((1 - mix) / 2 |b|^2 + mix |b|_1), where b are the coefficients of features
divided by their deviations. Results are given as Spark ML models, so they score, store and load as any other.

A model's task holds (2 * MEMORY + 8) vectors of the vocabulary's size, a task of the blocks one matrix of coefficients and
one of gradients, of the vocabulary's size by the number of models.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.session import checkpoint_root

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

BLOCK_VALUES = 500_000  # values of a block: bounds a task's working arrays
MEMORY = 10
SETTLED = 5  # iterations whose mean gain decides whether a model has settled
TRIALS = 25  # points tried along one direction
FAN_IN = 8  # partial sums that a task adds up
KEPT_EVERY = 20  # rounds after which the models' state is written to the checkpoint folder: bounds what a lost executor costs


def sparse_blocks(rows: DataFrame, label: str, features: str) -> RDD:
    """(labels, row starts, columns, values) of the rows, in blocks of about BLOCK_VALUES values, each beside the number of its
    partition, by which they are dealt; the caller unpersists."""
    parts = F.unwrap_udt(features)
    # dense vectors have no indices
    index = F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1))
    flat = rows.select(F.col(label).cast("double").alias("y"), index.alias("i"), parts["values"].alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                b = batch.slice(lo, 1000)
                starts = b["i"].offsets.to_numpy()
                held.append((b["y"].to_numpy(zero_copy_only=False), np.diff(starts),
                             b["i"].flatten().to_numpy(zero_copy_only=False), b["v"].flatten().to_numpy(zero_copy_only=False)))
                size += len(held[-1][2])
                if size >= BLOCK_VALUES:
                    yield one(held)
                    held, size = [], 0
        if held:
            yield one(held)

    def one(held: list) -> pa.RecordBatch:
        y, n, i, v = (np.concatenate(x) for x in zip(*held))
        block = y, np.concatenate([[0], np.cumsum(n)]), i.astype(np.int32), v.astype(np.float64)
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, protocol=5)], pa.binary())], ["block"])

    packed = flat.mapInArrow(pack, "block binary").rdd
    numbered = packed.mapPartitionsWithIndex(lambda i, held: ((i, bytes(r[0])) for r in held))
    return numbered.partitionBy(packed.getNumPartitions(), int).persist(StorageLevel.MEMORY_AND_DISK)


def _tree_sum(parts: RDD) -> tuple:
    """Sum of tuples of arrays and numbers, level by level in tasks until one is left: the driver gets that one, whatever the
    number of partitions."""
    add = lambda a, b: tuple(x + y for x, y in zip(a, b))
    n = parts.getNumPartitions()
    while n > 1:
        n = -(-n // FAN_IN)
        parts = (parts.mapPartitionsWithIndex(lambda i, held, n=n: ((i % n, x) for x in held))
                 .reduceByKey(add, n, int).values())
    return parts.reduce(add)


@dataclass
class Moments:
    n: float
    positive: float
    mean: np.ndarray
    deviation: np.ndarray  # with divisor n - 1; 0 where a feature is constant


def moments(blocks: RDD, size: int) -> Moments:
    def part(held: Iterator[bytes]) -> Iterator[tuple]:
        n, positive, first, second = 0.0, 0.0, np.zeros(size), np.zeros(size)
        for _, raw in held:
            y, _, i, v = pickle.loads(raw)
            n, positive = n + len(y), positive + y.sum()
            first += np.bincount(i, v, size)
            second += np.bincount(i, v * v, size)
        yield n, positive, first, second

    n, positive, first, second = _tree_sum(blocks.mapPartitions(part))
    mean = first / max(n, 1)
    spread = np.maximum(second - n * mean * mean, 0) / max(n - 1, 1)
    # rounding of a constant feature is no spread
    return Moments(n, positive, mean, np.sqrt(np.where(spread > 1e-12 * (second / max(n, 1) + 1e-300), spread, 0)))


def _add_block(raw: bytes, points: list[tuple], sums: list[tuple]) -> list[tuple]:
    """``sums`` and the block's (log loss, gradient by coefficient, gradient by offset) at every (coefficients, offset)."""
    y, starts, i, v = pickle.loads(raw)
    each = np.diff(starts)
    rows = np.repeat(np.arange(len(y)), each)
    out = []
    for (w, b), (loss, gradient, by_offset) in zip(points, sums):  # a model at a time: working arrays of the block's size
        margin = np.bincount(rows, v * w[i], len(y)) + b
        rest = 1 / (1 + np.exp(-np.clip(margin, -700, 700))) - y
        gradient += np.bincount(i, v * np.repeat(rest, each), len(w))
        out.append((loss + (np.logaddexp(0, margin) - y * margin).sum(), gradient, by_offset + rest.sum()))
    return out


def losses_and_gradients(blocks: RDD, coefficients: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every row of ``coefficients``: summed log loss, gradient by coefficient, gradient by offset. One job."""
    sent = blocks.context.broadcast((coefficients, offsets))

    def part(held: Iterator[tuple]) -> Iterator[tuple]:
        points = list(zip(*sent.value))
        sums = [(0.0, np.zeros(len(w)), 0.0) for w, _ in points]
        for _, raw in held:
            sums = _add_block(raw, points, sums)
        yield tuple(np.array(x) for x in zip(*sums))

    try:
        return _tree_sum(blocks.mapPartitions(part))
    finally:
        sent.unpersist()


def _direction(gradient: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """-H gradient by the two-loop recursion over the last (step, change of gradient)."""
    q, kept = gradient.copy(), []
    for s, y in reversed(steps):
        a = (s @ q) / (s @ y)
        q -= a * y
        kept.append(a)
    if steps:
        s, y = steps[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(steps, reversed(kept)):
        q += s * (a - (y @ q) / (s @ y))
    return -q


class Descent:
    """Minimises f(x) + sum(l1 * |x|), told f and its gradient at the point ``asked`` (None once settled). Its fields are plain
    values, so that it can travel between rounds.

    Without L1 the step is found by bisection on the weak Wolfe conditions, with L1 by backtracking in the orthant."""

    def __init__(self, x: np.ndarray, l1: np.ndarray, max_iter: int, tol: float):
        self.x, self.l1, self.max_iter, self.tol = x, l1, max_iter, tol
        self.asked, self.g, self.steps, self.done = x, None, [], 0

    @classmethod
    def of(cls, fields: dict) -> Descent:
        run = cls.__new__(cls)
        vars(run).update(fields)
        return run

    def tell(self, f: float, g: np.ndarray) -> None:
        new = self.asked
        value = f + (self.l1 * np.abs(new)).sum()
        if self.g is None:
            self.g, self.value, self.values = g, value, [value]
            return self._turn()
        self.trials += 1
        enough = False
        if np.isfinite(value) and value <= self.value + 1e-4 * (self.slope @ (new - self.x)):
            if self.best is None or value < self.best[0]:
                self.best = value, new, g
            enough = self.l1.any() or g @ self.d >= 0.9 * (self.g @ self.d)
            if not enough:
                self.low = self.t
        elif self.best is not None:
            enough = True
        else:
            self.high = self.t
        if not enough and self.trials < TRIALS:
            self.t = 2 * self.t if self.high == np.inf else (self.low + self.high) / 2
            return self._try()
        if self.best is None:
            return self._settle()
        value, new, g = self.best
        s, y = new - self.x, g - self.g
        if s @ y > 1e-14 * (y @ y):
            self.steps = [*self.steps[-MEMORY + 1:], (s, y)]
        self.x, self.g, self.value, self.done = new, g, value, self.done + 1
        self.values = [*self.values[-SETTLED:], value]
        if len(self.values) > SETTLED and self.values[0] - value <= SETTLED * self.tol * max(abs(value), 1e-6):
            return self._settle()
        self._turn()

    def _turn(self) -> None:
        x, g, l1 = self.x, self.g, self.l1
        sparse = l1.any()
        slope = g
        if sparse:
            slope = np.where(x != 0, g + l1 * np.sign(x), np.where(g + l1 < 0, g + l1, np.where(g - l1 > 0, g - l1, 0.0)))
        size = np.linalg.norm(slope)
        if self.done >= self.max_iter or size <= 1e-12:
            return self._settle()
        d = _direction(slope, self.steps)
        if sparse:
            d = np.where(d * slope < 0, d, 0.0)
        if d @ slope >= 0:
            d, self.steps = -slope, []
        self.slope, self.d = slope, d
        self.t, self.low, self.high, self.best, self.trials = (1.0 if self.steps else 1 / size), 0.0, np.inf, None, 0
        self._try()

    def _try(self) -> None:
        new = self.x + self.t * self.d
        if self.l1.any():
            orthant = np.where(self.x != 0, np.sign(self.x), -np.sign(self.slope))
            new = np.where((self.l1 == 0) | (new * orthant > 0), new, 0.0)
        self.asked = new

    def _settle(self) -> None:
        self.asked = self.g = self.slope = self.d = self.best = None
        self.steps = []


@dataclass
class Fit:
    coefficients: np.ndarray
    intercept: float
    objective: float
    iterations: int


def fit_all(blocks: RDD, size: int, penalties: list[tuple[float, float]], max_iter: int = 100, tol: float = 1e-8) -> tuple[list[Fit], int]:
    """A fit for every (reg, mix), and the number of rounds (jobs after the moments)."""
    m = moments(blocks, size)
    if m.n == 0 or m.positive in (0, m.n):
        raise ValueError("training rows of both labels are needed")
    used = m.deviation > 0
    scale = np.where(used, 1 / np.where(used, m.deviation, 1), 0.0)
    shift = m.mean * scale  # features are centred as well: the intercept then moves on its own
    bias, n_rows, n, width = np.log(m.positive / (m.n - m.positive)), m.n, len(penalties), blocks.getNumPartitions()
    sc = blocks.context
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(SparkSession.getActiveSession()))
    sent = sc.broadcast((scale, shift))

    def begin(held: Iterator[tuple]) -> Iterator[tuple]:
        for k, (reg, mix) in held:
            yield k, vars(Descent(np.append(np.zeros(size), bias), np.append(np.full(size, reg * mix), 0.0), max_iter, tol))

    def hand_out(held: Iterator[tuple]) -> Iterator[tuple]:
        """The points asked for, to every partition of the blocks."""
        by, off = sent.value
        for k, run in held:
            if (x := run["asked"]) is not None:
                point = k, x[:-1] * by, x[-1] - off @ x[:-1]
                yield from ((i, point) for i in range(width))

    def measure(held: Iterator[tuple]) -> Iterator[tuple]:
        """Points come first, blocks after them."""
        names, points, sums = [], [], []
        for _, item in held:
            if isinstance(item, tuple):
                names.append(item[0])
                points.append(item[1:])
                sums.append((0.0, np.zeros(size), 0.0))
            else:
                sums = _add_block(item, points, sums)
        yield from zip(names, sums)

    def step(held: Iterator[tuple]) -> Iterator[tuple]:
        """A model's state, then the sums at the point it asked for."""
        by, off = sent.value
        runs: dict[int, Descent] = {}
        for k, item in held:
            if isinstance(item, dict):
                runs[k] = Descent.of(item)
                continue
            loss, gradient, by_offset = item
            x, ridge = runs[k].asked, penalties[k][0] * (1 - penalties[k][1])
            runs[k].tell(loss / n_rows + ridge / 2 * (x[:-1] @ x[:-1]),
                         np.append((gradient * by - off * by_offset) / n_rows + ridge * x[:-1], by_offset / n_rows))
        yield from ((k, vars(run)) for k, run in runs.items())

    def fitted(item: tuple) -> tuple:
        by, off = sent.value
        k, run = item
        x = run["x"]
        return k, (x[:-1] * by, float(x[-1] - off @ x[:-1]), float(run["value"]), run["done"])

    state = sc.parallelize(list(enumerate(penalties)), n).partitionBy(n, int).mapPartitions(begin, True).persist(StorageLevel.MEMORY_AND_DISK)
    rounds, live = 0, n
    try:
        while live:
            sums = (state.mapPartitions(hand_out).partitionBy(width, int).union(blocks).mapPartitions(measure)
                    .reduceByKey(lambda a, b: tuple(x + y for x, y in zip(a, b)), n, int))
            before, state = state, state.union(sums).mapPartitions(step, True).persist(StorageLevel.MEMORY_AND_DISK)
            rounds += 1
            if rounds % KEPT_EVERY == 0:
                state.checkpoint()
            live = sum(state.map(lambda item: item[1]["asked"] is not None).collect())
            before.unpersist()
        fits = dict(state.map(fitted).collect())
    finally:
        state.unpersist()
        sent.unpersist()
    return [Fit(*fits[k]) for k in range(n)], rounds


def as_model(spark, fit: Fit, features: str, uid: str) -> LogisticRegressionModel:
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        uid, _py2java(spark.sparkContext, Vectors.dense(fit.coefficients)), fit.intercept)
    java.set(java.featuresCol(), features)
    return LogisticRegressionModel(java)


def fit_grid(train: DataFrame, label: str, penalties: list[tuple[float, float]], max_iter: int = 100, tol: float = 1e-8,
             features: str = "tfidf") -> list[LogisticRegressionModel]:
    """A fitted Spark ML model for every (reg, mix) of ``penalties``."""
    first = train.select(F.unwrap_udt(features).alias("v")).select(
        F.max(F.coalesce(F.col("v.size"), F.size("v.values")))).first()[0]
    if first is None:
        raise ValueError("training rows of both labels are needed")
    blocks = sparse_blocks(train, label, features)
    try:
        fits, _ = fit_all(blocks, int(first), penalties, max_iter, tol)
    finally:
        blocks.unpersist()
    return [as_model(train.sparkSession, f, features, f"grid_{reg}_{mix}") for f, (reg, mix) in zip(fits, penalties)]
