"""Logistic regressions of two classes for many settings at once: validation folds, penalties, iterations.

Spark ML fits a point of a grid on its own: it reads the vectors, scales them, keeps the scaled copy, and passes over it
for every step of every point. Here documents are stored once, in blocks, as they are. What a fold's weights and
the scaling of its learning part do to a vector is done to the coefficients, and a pass over the blocks gives the losses and
gradients of all folds and penalties. Points that differ in their number of iterations are one path, taken at
several places.

The objective, the start and the steps (L-BFGS of ten pairs, strong Wolfe conditions) are those of Spark ML, so the
coefficients are the same up to rounding; tests hold them against each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.operators.trees import chunks, entries, vector_width
from opinia.session import materialize

#: What points may differ in.
SEARCHED = {"regParam", "maxIter"}
#: Pairs of steps and changes of the gradient that a path remembers.
PAIRS = 10
#: Values of the objective that tell whether it still falls.
VALUES = 20
#: Trials of a line search, and of its narrowing.
TRIALS = 10
#: A feature whose variance is that much smaller than its mean square is a constant.
CONSTANT = 1e-11
#: Columns of a sum that move together.
SLICE = 1 << 14

#: Documents of one fold in blocks: labels, entries per document, features and values as arrays; values by the first
#: of some kinds that holds all of them exactly, as a pass reads whole blocks, and most counts are small.
BLOCK_KINDS = {"label": np.int8, "width": np.int32, "index": np.int32}
VALUE_KINDS = ("u1", "f4", "f8")
BLOCK = ", ".join(["fold int", *(f"{c} binary" for c in BLOCK_KINDS), "kind string", "value binary"])


def shares(model, points: Sequence[dict]) -> bool:
    """Whether the points are fitted here: those of a logistic regression with Spark ML's defaults otherwise."""
    if type(model) is not LogisticRegression or not {p.name for point in points for p in point} <= SEARCHED:
        return False

    def others(m) -> dict:
        return {p.name: v for p, v in m.extractParamMap().items() if p.name not in SEARCHED | {"tol"}}

    return others(model) == others(LogisticRegression())


def class_sizes(vectors: DataFrame, held_out: Sequence[int]) -> dict[int, tuple[int, int]] | None:
    """Documents without each fold, with label 0 and with label 1; None when a fold is empty, or the others
    have not both classes and no other."""
    found = vectors.groupBy("fold", "label").agg(F.count("*").alias("n")).where("fold IS NOT NULL").collect()
    sizes = {}
    for f in held_out:
        counts = {}
        for r in found:
            if r["fold"] != f:
                counts[r["label"]] = counts.get(r["label"], 0) + r["n"]
        if counts.keys() != {0.0, 1.0} or all(r["fold"] != f for r in found):
            return None
        sizes[f] = (counts[0.0], counts[1.0])
    # Labels of documents that are only scored have to be in the blocks too.
    return sizes if all(r["label"] in (0.0, 1.0) for r in found) else None


def narrowed(value: np.ndarray) -> tuple[str, np.ndarray]:
    """The values by the first of ``VALUE_KINDS`` that holds them exactly, and its name."""
    with np.errstate(invalid="ignore", over="ignore"):
        return next((kind, short) for kind in VALUE_KINDS if ((short := value.astype(kind)) == value).all() or kind == "f8")


def in_blocks(vectors: DataFrame) -> DataFrame:
    """``vectors (fold, label, features)`` with many documents of a fold a row, stored. Without a fold there is no place."""

    def pack(batches):
        for batch in chunks(batches, vector_width):
            width, index, value = entries(batch.column("features"))
            fold, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "label"))
            for f in np.unique(fold):
                of = fold == f
                kept = np.repeat(of, width)
                arrays = {"label": label[of], "width": width[of], "index": index[kept]}
                columns = [pa.array([arrays[c].astype(kind).tobytes()], pa.binary()) for c, kind in BLOCK_KINDS.items()]
                kind, short = narrowed(value[kept])
                columns = [pa.array([int(f)], pa.int32()), *columns, pa.array([kind]), pa.array([short.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["fold", *BLOCK_KINDS, "kind", "value"])

    known = vectors.where("fold IS NOT NULL").select(F.col("fold").cast("int"), F.col("label").cast("double"), "features")
    return materialize(known.mapInArrow(pack, BLOCK), "blocks")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(fold, label, width, index, value)`` of one block at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            label, width, index = (np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in BLOCK_KINDS.items())
            value = np.frombuffer(batch.column("value")[k].as_buffer(), batch.column("kind")[k].as_py())
            # Stored short; numpy looks up and counts by its own kind of index several times faster.
            yield batch.column("fold")[k].as_py(), label, width, index.astype(np.intp), value.astype(float)


def summed(stored: DataFrame, add: Callable, shape: tuple[int, int]) -> np.ndarray:
    """The sum of what ``add(total, *block)`` adds to an array of ``shape``, over all blocks.

    A task adds up its own blocks. Slices of columns are added by a shuffle, in the order of the tasks, so the
    driver gets one array.
    """

    def of_task(batches):
        total = np.zeros(shape)
        for block in blocks(batches):
            add(total, *block)
        task = TaskContext.get().partitionId()
        for at in range(0, shape[1], SLICE):
            part = total[:, at : at + SLICE]
            if part.any():
                columns = [pa.array([at], pa.int32()), pa.array([task], pa.int32()), pa.array([part.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["at", "task", "sums"])

    def of_slice(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        total = 0.0
        for chunk in table.column("sums").chunks:
            for held in chunk:
                total = total + np.frombuffer(held.as_buffer())
        columns = [table.column("at").slice(0, 1), pa.array([total.tobytes()], pa.binary())]
        return pa.table(columns, ["at", "sums"])

    slices = stored.mapInArrow(of_task, "at int, task int, sums binary").groupBy("at")
    found = slices.applyInArrow(of_slice, "at int, sums binary").toArrow()
    total = np.zeros(shape)
    for at, held in zip(found.column("at").to_pylist(), found.column("sums")):
        part = total[:, at : at + SLICE]
        part += np.frombuffer(held.as_buffer()).reshape(part.shape)
    return total


def sums_without(sums: dict, fold: int):
    """The sum over all folds but one."""
    return sum(v for f, v in sorted(sums.items()) if f != fold)


def moments(stored: DataFrame, folds: Sequence[int], size: int) -> tuple[dict, dict]:
    """Sums of values and of their squares by feature, of each fold."""

    def add(total, fold, label, width, index, value):
        at = 2 * folds.index(fold)
        total[at] += np.bincount(index, value, size)
        total[at + 1] += np.bincount(index, value * value, size)

    folds = list(folds)
    found = summed(stored, add, (2 * len(folds), size))
    return tuple({f: found[2 * i + k] for i, f in enumerate(folds)} for k in (0, 1))


def margins(weights: np.ndarray, intercept: float, width: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The margin of every document of a block."""
    found = np.full(len(width), intercept)
    some = np.flatnonzero(width)
    if len(some):
        starts = (np.cumsum(width) - width)[some]
        found[some] += np.add.reduceat(value * weights.take(index), starts)
    return found


class Direction:
    """The last steps of a path, and where it goes from them."""

    def __init__(self) -> None:
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, step: np.ndarray, change: np.ndarray) -> None:
        self.pairs = [(step, change), *self.pairs][:PAIRS]

    def of(self, gradient: np.ndarray) -> np.ndarray:
        found, seen = gradient.copy(), []
        for step, change in self.pairs:
            product = step @ change
            share = step @ found / product
            if math.isnan(share):
                raise ArithmeticError("not a number")
            found -= share * change
            seen.append((share, product))
        if self.pairs:
            step, change = self.pairs[0]
            if not step @ change >= 0:
                raise ArithmeticError("not convex")
            found *= step @ change / (change @ change)
        for (step, change), (share, product) in reversed(list(zip(self.pairs, seen))):
            found += (share - change @ found / product) * step
        return -found


def cubic(low: tuple, high: tuple) -> float:
    """Where a cubic through two ``(step, value, slope)`` is least, not too close to either."""
    (a, f, d), (b, g, e) = sorted((low, high))
    one = d + e - 3 * (f - g) / (a - b)
    square = one * one - d * e
    two = math.sqrt(square) if square >= 0 else math.nan
    below = e - d + 2 * two
    t = b - (b - a) * (e + two - one) / below if below else math.nan
    if t < a + 0.1 * (b - a):
        return a + 0.1 * (b - a)
    return a + 0.9 * (b - a) if t > a + 0.9 * (b - a) else t


def line_search(value: float, slope: float, t: float) -> Generator[float, tuple[float, float], float]:
    """The step that meets the strong Wolfe conditions: yields steps, is sent ``(value, slope)`` there. The step that
    it returns is the last that it yielded."""
    if slope > 0:
        raise ArithmeticError("not downhill")

    def too_high(c, low) -> bool:
        return c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]

    low = (0.0, value, slope)
    ends = None
    for trial in range(TRIALS):
        c = (t, *(yield t))
        if not math.isfinite(c[1]):
            t /= 2.0
            continue
        if c[1] > value + 1e-4 * t * slope or (trial > 0 and c[1] >= low[1]):
            ends = (low, c)
            break
        if abs(c[2]) <= 0.9 * abs(slope):
            return t
        if c[2] >= 0:
            ends = (c, low)
            break
        low = c
        t *= 1.5
    if ends is None:
        raise ArithmeticError("no step found")
    low, high = ends
    for _ in range(TRIALS):
        t = cubic(low, high)
        c = (t, *(yield t))
        if too_high(c, low):
            high = c
            continue
        if abs(c[2]) <= 0.9 * abs(slope):
            return t
        if c[2] * (high[0] - low[0]) >= 0:
            high = low
        low = c
    raise ArithmeticError("no step found in an interval")


def path(x: np.ndarray, tol: float, most: int) -> Generator[np.ndarray, tuple[float, np.ndarray], list[np.ndarray]]:
    """The points after 0, 1, ... iterations, ``most`` at the most: yields points, is sent the objective and its gradient there.

    It ends early when the gradient vanishes, when the objective has not fallen for ``VALUES`` iterations, or
    when no step is found twice in a row.
    """
    value, gradient = yield x
    first, recent, taken, known, failed = value, [math.inf], [x], Direction(), False
    while len(taken) <= most:
        if abs(value - max(recent)) <= tol * first and len(recent) > 1:
            break
        if np.linalg.norm(gradient) <= max(tol * value, 1e-8):
            break
        try:
            along = known.of(gradient)
            search = line_search(value, gradient @ along, 1.0 / np.linalg.norm(along) if len(taken) == 1 else 1.0)
            t = next(search)
            while True:
                ahead = x + along * t
                new_value, new_gradient = yield ahead
                try:
                    t = search.send((new_value, new_gradient @ along))
                except StopIteration:
                    break
            if t * np.linalg.norm(gradient) < 1e-10:
                raise ArithmeticError("no step is left")
        except ArithmeticError:
            if failed:
                break
            known, failed = Direction(), True
            continue
        known.add(ahead - x, new_gradient - gradient)
        x, value, gradient, failed = ahead, new_value, new_gradient, False
        recent = [*recent, value][-VALUES:]
        taken.append(x)
    return taken


class Problem:
    """The regression of one learning part and penalty, on features scaled to unit variance and centred.

    ``scale`` turns a stored value into a scaled one, 0 where the feature is a constant or has no weight.
    """

    def __init__(self, fold: int, penalty: float, sizes: tuple[int, int], scale: np.ndarray, mean: np.ndarray) -> None:
        self.fold, self.penalty, self.n, self.size = fold, penalty, sum(sizes), len(scale)
        self.kept = np.flatnonzero(scale)
        self.scale = scale[self.kept]
        self.centre = mean[self.kept] * self.scale
        self.start = np.r_[np.zeros(len(self.kept)), math.log(sizes[1] / sizes[0])]

    def plain(self, x: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights and intercept for stored values."""
        weights = np.zeros(self.size)
        weights[self.kept] = x[:-1] * self.scale
        return weights, float(x[-1] - x[:-1] @ self.centre)

    def objective(self, x: np.ndarray, sums: np.ndarray) -> tuple[float, np.ndarray]:
        """The mean loss and its gradient with the penalty, from the sums of a pass."""
        gradient = np.r_[sums[self.kept] * self.scale - self.centre * sums[-2], sums[-2]] / self.n
        gradient[:-1] += self.penalty * x[:-1]
        return float(sums[-1] / self.n + 0.5 * self.penalty * (x[:-1] @ x[:-1])), gradient


def losses(stored: DataFrame, problems: list[Problem], at: list[np.ndarray]) -> np.ndarray:
    """For each problem the gradient by stored values, that of the intercept, and the loss, summed over the documents
    that it learns from."""
    spark, size = stored.sparkSession, problems[0].size
    known = [(p.fold, *p.plain(x)) for p, x in zip(problems, at)]
    held = spark.sparkContext.broadcast(known)

    def add(total, fold, label, width, index, value):
        for k, (without, weights, intercept) in enumerate(held.value):
            if without != fold:
                margin = margins(weights, intercept, width, index, value)
                other = np.logaddexp(0.0, -margin)
                slope = np.exp(-other) - label
                total[k, :size] += np.bincount(index, value * np.repeat(slope, width), size)
                total[k, size] += slope.sum()
                total[k, size + 1] += np.where(label > 0, other, other + margin).sum()

    found = summed(stored, add, (len(known), size + 2))
    held.destroy()
    return found


def fit(stored: DataFrame, problems: list[Problem], tol: float, most: int) -> list[list[np.ndarray]]:
    """The paths of all problems, a step of each from every pass over the blocks."""
    paths = [path(p.start, tol, most) for p in problems]
    asked = {k: next(walk) for k, walk in enumerate(paths)}
    found: list = [None] * len(paths)
    while asked:
        sums = losses(stored, [problems[k] for k in asked], list(asked.values()))
        ahead = {}
        for (k, x), row in zip(asked.items(), sums):
            try:
                ahead[k] = paths[k].send(problems[k].objective(x, row))
            except StopIteration as end:
                found[k] = end.value
        asked = ahead
    return found


def scored(stored: DataFrame, models: dict[int, list[tuple[np.ndarray, float]]]) -> dict[int, DataFrame]:
    """``(label, m0, m1, ...)`` of each fold, stored: the margins of its documents by its own models."""
    spark = stored.sparkSession
    found = {}
    for f, own in models.items():
        held = spark.sparkContext.broadcast(own)
        names = [f"m{i}" for i in range(len(own))]

        def score(batches, held=held, names=names):
            for _, label, *rest in blocks(batches):
                each = [margins(weights, intercept, *rest) for weights, intercept in held.value]
                columns = [pa.array(label.astype(float)), *map(pa.array, each)]
                yield pa.RecordBatch.from_arrays(columns, ["label", *names])

        schema = ", ".join(f"{c} double" for c in ["label", *names])
        found[f] = materialize(stored.where(F.col("fold") == f).mapInArrow(score, schema), "margins")
        held.destroy()
    return found


def search(
    vectors: DataFrame,
    model: LogisticRegression,
    points: Sequence[dict],
    sizes: dict[int, tuple[int, int]],
    size: int,
    weights: Callable[[int], np.ndarray] | None = None,
) -> dict[int, DataFrame]:
    """``(label, m0, m1, ...)`` for each fold in ``sizes``: its documents with the margin of each point, fitted on all others.

    ``vectors`` are ``(fold, label, features)``, ``sizes`` comes from :func:`class_sizes`, and ``weights(fold)`` gives what the
    features are multiplied by before a fit without that fold.
    """
    stored = in_blocks(vectors)
    folds = sorted(r["fold"] for r in stored.select("fold").distinct().collect())
    totals, squares = moments(stored, folds, size)
    default = {p.name: v for p, v in model.extractParamMap().items()}
    wanted = [default | {p.name: v for p, v in point.items()} for point in points]
    penalties = sorted({w["regParam"] for w in wanted})
    problems = []
    for f in sizes:
        n = sum(sizes[f])
        total, square = sums_without(totals, f), sums_without(squares, f)
        spread = square - total * total / n
        varies = spread > CONSTANT * square
        factor = np.ones(size) if weights is None else weights(f)
        # The factor is divided out again by the standard deviation, down to its sign.
        scale = np.zeros(size)
        scale[varies] = np.sign(factor[varies]) / np.sqrt(spread[varies] / max(n - 1, 1))
        problems += [Problem(f, penalty, sizes[f], scale, total / n) for penalty in penalties]
    paths = fit(stored, problems, default["tol"], max(w["maxIter"] for w in wanted))
    models = {f: [] for f in sizes}
    for w in wanted:
        for problem, walked in zip(problems, paths):
            if problem.penalty == w["regParam"]:
                models[problem.fold].append(problem.plain(walked[min(w["maxIter"], len(walked) - 1)]))
    return scored(stored, models)
