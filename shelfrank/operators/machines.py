"""Kernel machines, fitted on all rows in passes over the table as it lies: expanded features are never stored."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.split import SEED

# Tasks get the functions themselves; the module need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A machine per class is weighed in every pass; more values are no class label.
MAX_CLASSES = 100
# Steps that the solver remembers, lengths tried for a step, and the change of the loss at which it ends.
MEMORY = 10
TRIALS = 30
TOLERANCE = 1e-6


def _numbers(batch: pa.RecordBatch, names: Sequence[str], features: Sequence[str]) -> np.ndarray:
    columns = []
    for name, feature in zip(names, features, strict=True):
        column = batch.column(name)
        held = column.to_numpy(zero_copy_only=False)
        if column.null_count or np.isnan(held).any():
            raise ValueError(f"{feature} has missing values")
        columns.append(held)
    return np.column_stack(columns)


@dataclass(frozen=True)
class KernelMachine:
    """One-against-rest linear machines on random features of the Gaussian kernel (Rahimi and Recht, 2007)."""

    features: tuple[str, ...]
    weights: np.ndarray
    offsets: np.ndarray
    #: A column per class: a coefficient per wave, and the intercept.
    planes: np.ndarray | None = None

    def expand(self, points: np.ndarray) -> np.ndarray:
        return math.sqrt(2.0 / len(self.offsets)) * np.cos(points @ self.weights.T + self.offsets)

    def margins(self, points: np.ndarray) -> np.ndarray:
        return self.expand(points) @ self.planes[:-1] + self.planes[-1]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the prediction: the class whose machine is surest, of equals the first."""
        names = [f"_f{i}" for i in range(len(self.features))]
        carried, machine = df.columns, self

        def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                best = machine.margins(_numbers(batch, names, machine.features)).argmax(axis=1)
                columns = [*[batch.column(c) for c in carried], pa.array(best, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, [*carried, "prediction"])

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        read = df.select("*", *[F.col(f).cast("double").alias(n) for f, n in zip(self.features, names, strict=True)])
        return read.mapInArrow(predicted, f"{kinds}, prediction int")


Loss = tuple[float, np.ndarray]


def minimise(start: np.ndarray, iterations: int, tolerance: float = TOLERANCE) -> Generator[np.ndarray, Loss, np.ndarray]:
    """Limited-memory BFGS with the weak Wolfe conditions: yields points, is sent loss and gradient there, returns the best point."""
    point = start
    loss, slope = yield point
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        direction, scales = -slope, []
        for s, y in reversed(steps):
            scales.append(s @ direction / (s @ y))
            direction = direction - scales[-1] * y
        if steps:
            s, y = steps[-1]
            direction = direction * (s @ y / (y @ y))
        for (s, y), a in zip(steps, reversed(scales), strict=True):
            direction = direction + (a - y @ direction / (s @ y)) * s
        fall = slope @ direction
        if fall >= 0:
            direction, fall, steps = -slope, -(slope @ slope), []
        if fall == 0:
            return point
        low, high, length, best = 0.0, math.inf, 1.0 if steps else 0.5 / math.sqrt(-fall), None
        for _ in range(TRIALS):
            trial = point + length * direction
            found, there = yield trial
            if found > loss + 1e-4 * length * fall:
                high = length
            else:
                best = trial, found, there
                if there @ direction >= 0.9 * fall:
                    break
                low = length
            length = 2 * length if high == math.inf else (low + high) / 2
        if best is None:
            return point
        trial, found, there = best
        s, y = trial - point, there - slope
        if s @ y > 1e-12 * (y @ y):
            steps = [*steps, (s, y)][-MEMORY:]
        change = loss - found
        point, loss, slope = trial, found, there
        if change <= tolerance * max(abs(loss), tolerance):
            return point
    return point


def _solved(start: np.ndarray, iterations: int, evaluate: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minimise the loss of every column of ``start``; each pass weighs the next point of all that are not done."""
    searches = {c: minimise(start[:, c], iterations) for c in range(start.shape[1])}
    points = {c: next(search) for c, search in searches.items()}
    planes = start.copy()
    while points:
        asked = sorted(points)
        for c in asked:
            planes[:, c] = points[c]
        losses, slopes = evaluate(planes)
        for c in asked:
            try:
                points[c] = searches[c].send((losses[c], slopes[:, c]))
            except StopIteration as done:
                planes[:, c] = done.value
                del points[c]
    return planes


def _hinge(rows: DataFrame, machine: KernelMachine, classes: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Sums over all rows of each class's hinge loss and its gradient; a row per partition comes back."""
    names = list(rows.columns)[:-1]

    def evaluate(planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = KernelMachine(machine.features, machine.weights, machine.offsets, planes)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, slope = np.zeros(classes), np.zeros_like(own.planes)
            for batch in batches:
                waves = own.expand(_numbers(batch, names, own.features))
                side = np.where(batch.column("class").to_numpy()[:, None] == np.arange(classes), 1.0, -1.0)
                short = 1.0 - side * (waves @ own.planes[:-1] + own.planes[-1])
                pull = np.where(short > 0, -side, 0.0)
                loss += np.maximum(short, 0.0).sum(axis=0)
                slope[:-1] += waves.T @ pull
                slope[-1] += pull.sum(axis=0)
            yield pa.RecordBatch.from_pydict({"loss": [loss.tobytes()], "slope": [slope.tobytes()]})

        found = rows.mapInArrow(sums, "loss binary, slope binary").collect()
        # In one order, so that equal sums add up to equal totals.
        parts = sorted((bytes(r["loss"]), bytes(r["slope"])) for r in found)
        losses = sum(np.frombuffer(p[0]) for p in parts)
        return losses, sum(np.frombuffer(p[1]).reshape(planes.shape) for p in parts)

    return evaluate


def _moments(rows: DataFrame, machine: KernelMachine, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and, as a column, deviation of each wave; 1 for one that is constant."""
    names = list(rows.columns)[:-1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(machine.offsets)))
        for batch in batches:
            waves = machine.expand(_numbers(batch, names, machine.features))
            total += [waves.sum(axis=0), (waves * waves).sum(axis=0)]
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    parts = sorted(bytes(r["sums"]) for r in rows.mapInArrow(sums, "sums binary").collect())
    mean, square = sum(np.frombuffer(p) for p in parts).reshape(2, -1) / n
    spread = np.sqrt(np.maximum(square - mean * mean, 0.0))
    return mean, np.where(spread > 1e-9, spread, 1.0)[:, None]


def fit_kernel_machine(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    waves: int = 64,
    iterations: int = 20,
    cost: float = 1.0,
) -> KernelMachine:
    """Kernel width 1 / (features * variance of all cells); hinge loss with the given cost, on all rows.

    All machines are weighed in the same passes, which expand a batch of rows at a time.
    """
    row = train.agg(
        F.count("*").alias("n"),
        F.count(label).alias("known"),
        F.min(label).alias("low"),
        F.max(label).alias("high"),
        *[f(F.col(c).cast("double")).alias(f"{c}|{s}") for c in features for s, f in [("m", F.avg), ("v", F.var_pop)]],
    ).first()
    if not row["n"] or row["known"] < row["n"] or row["low"] < 0 or row["high"] >= MAX_CLASSES:
        raise ValueError(f"{label} must be a class from 0 to {MAX_CLASSES - 1} in every row, and there must be one")
    if any(row[f"{c}|m"] is None for c in features):
        raise ValueError("a feature has missing values")
    means = np.array([row[f"{c}|m"] for c in features])
    variance = float(np.mean([row[f"{c}|v"] for c in features]) + means.var())
    gamma = 1.0 / (len(features) * variance) if variance else 1.0
    rng = np.random.default_rng(SEED)
    machine = KernelMachine(
        tuple(features),
        rng.normal(0.0, math.sqrt(2 * gamma), (waves, len(features))),
        rng.uniform(0.0, 2 * math.pi, waves),
    )
    classes, penalty = row["high"] + 1, 1.0 / (cost * row["n"])
    rows = train.select(*[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)], F.col(label).cast("int").alias("class"))
    hinge = _hinge(rows, machine, classes)
    mean, spread = _moments(rows, machine, row["n"])

    def unscaled(planes):
        steep = planes[:-1] / spread
        return np.vstack([steep, planes[-1] - mean @ steep])

    # Waves are centred and scaled for the solver alone: the penalty is that of the waves as they are.
    def evaluate(planes):
        plain = unscaled(planes)
        losses, slopes = hinge(plain)
        losses, slopes, steep = losses / row["n"], slopes / row["n"], plain[:-1]
        inner = (slopes[:-1] - mean[:, None] * slopes[-1] + penalty * steep) / spread
        return losses + penalty / 2 * (steep * steep).sum(axis=0), np.vstack([inner, slopes[-1]])

    planes = unscaled(_solved(np.zeros((waves + 1, classes)), iterations, evaluate))
    return KernelMachine(machine.features, machine.weights, machine.offsets, planes)
