"""Linear classifiers, all classes or flags in the same passes over the stored rows.

The models are the columns of one weight matrix (terms + 1 rows, the last for the intercept).  Each pass reads the rows
once and returns the loss and the gradient, or the curvature along a direction, of all models that are not
done.  The losses are sums over the weighted rows plus half the squared norm of the weights:

- flags: logistic loss, the intercept free; limited-memory quasi-Newton steps, each flag with its own memory, in step;
- classes: squared hinge loss, the intercept a weight like the others; trust-region Newton steps whose inner systems
  are solved by preconditioned conjugate gradients, each class with its own region, all in step.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.operators.passes import Sparse, gathered, numbers, sliced, summed, tasks_of

#: Steps that a model remembers; each takes two numbers per weight on the driver (60: 120 MB for 25,000 terms and 5 models).
MEMORY = 60
#: Slopes of a logistic fit that count as level, against the squared norm of its weights.
LEVEL = 5e-3
#: Trust region: shares of the predicted decrease at which a step is taken and the region shrinks or grows.
TAKEN, POOR, GOOD = 1e-4, 0.25, 0.75
INNER_STEPS = 15
#: Size of an inner system's rest, against the gradient.
INNER_REST = 0.25


@dataclass(frozen=True)
class Linear:
    """Weights (terms + 1, models), the gradients' norms there and at zero, and the passes it took."""

    weights: np.ndarray
    gradients: np.ndarray
    at_zero: np.ndarray
    passes: int
    converged: bool
    #: Of packed rows (see ``passes.Sparse``): the value of a count per term.
    scale: np.ndarray | None = None


def entry_columns(rows: DataFrame) -> list[str]:
    """The columns with the entries of the rows."""
    return [c for c in ("indices", "values", "length") if c in rows.columns]


@dataclass(frozen=True)
class Problem:
    """Stored rows, the names of the columns with targets (1 or -1) and with weights of the rows, one per model."""

    rows: DataFrame
    targets: tuple[str, ...]
    weights: tuple[str, ...]
    width: int
    free_intercept: bool
    tasks: int | None = None
    #: Of packed rows (see ``passes.Sparse``): the value of a count per term.
    scale: np.ndarray | None = None

    def chosen(self) -> DataFrame:
        return self.rows.select(*entry_columns(self.rows), *dict.fromkeys([*self.targets, *self.weights]))

    def names(self) -> tuple[tuple[str, ...], tuple[str, ...], int, np.ndarray | None]:
        """What the tasks need; they can't take the table with them."""
        return self.targets, self.weights, self.width, self.scale

    def only(self, models: np.ndarray) -> Problem:
        """The problem of some models (their places); the tasks read and multiply only what these need."""
        return replace(self, targets=tuple(self.targets[m] for m in models), weights=tuple(self.weights[m] for m in models))

    def penalised(self, weights: np.ndarray) -> np.ndarray:
        """The weights that the penalty counts."""
        if not self.free_intercept:
            return weights
        out = weights.copy()
        out[-1] = 0
        return out


def margins(rows: Sparse, weights: np.ndarray) -> np.ndarray:
    return rows.times(weights[:-1]) + weights[-1]


def backwards(rows: Sparse, residuals: np.ndarray, width: int, power: int = 1) -> np.ndarray:
    return np.vstack([rows.transposed_times(residuals, width, power), residuals.sum(0)])


def logistic_pass(problem: Problem, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss per model and gradient."""
    shape, (targets, shares, width, scale) = weights.shape, problem.names()

    def statistics(batch: pa.RecordBatch) -> np.ndarray:
        rows, y, c = Sparse(batch, scale), numbers(batch, targets), numbers(batch, shares)
        z = y * margins(rows, weights)
        residuals = -c * y * np.exp(-np.logaddexp(0, z))
        return np.concatenate([backwards(rows, residuals, width).ravel(), (c * np.logaddexp(0, -z)).sum(0)])

    found = summed(problem.chosen(), weights.size + shape[1], statistics, problem.tasks)
    counted = problem.penalised(weights)
    return found[weights.size :] + 0.5 * (counted**2).sum(0), found[: weights.size].reshape(shape) + counted


def logistic_curvature(problem: Problem, weights: np.ndarray) -> np.ndarray:
    """The diagonal of the curvature of the logistic loss."""
    shape, (targets, shares, width, scale) = weights.shape, problem.names()

    def statistics(batch: pa.RecordBatch) -> np.ndarray:
        rows, y, c = Sparse(batch, scale), numbers(batch, targets), numbers(batch, shares)
        z = y * margins(rows, weights)
        return backwards(rows, c * np.exp(-np.logaddexp(0, z) - np.logaddexp(0, -z)), width, 2)

    return summed(problem.chosen(), weights.size, statistics, problem.tasks).reshape(shape) + problem.penalised(np.ones(shape))


def hinge_pass(problem: Problem, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Squared hinge loss per model, gradient, and the diagonal of the curvature."""
    shape, (targets, shares, width, scale) = weights.shape, problem.names()

    def statistics(batch: pa.RecordBatch) -> np.ndarray:
        rows, y, c = Sparse(batch, scale), numbers(batch, targets), numbers(batch, shares)
        short = np.maximum(0, 1 - y * margins(rows, weights))
        first = backwards(rows, -2 * c * y * short, width)
        second = backwards(rows, 2 * c * (short > 0), width, 2)
        return np.concatenate([first.ravel(), second.ravel(), (c * short**2).sum(0)])

    found = summed(problem.chosen(), 2 * weights.size + shape[1], statistics, problem.tasks)
    first, second, loss = found[: weights.size], found[weights.size : 2 * weights.size], found[2 * weights.size :]
    counted = problem.penalised(weights)
    return loss + 0.5 * (counted**2).sum(0), first.reshape(shape) + counted, second.reshape(shape) + 1


def curvature_pass(problem: Problem, weights: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The curvature of the squared hinge loss at ``weights`` along one direction per model."""
    targets, shares, width, scale = problem.names()

    def statistics(batch: pa.RecordBatch) -> np.ndarray:
        rows, y, c = Sparse(batch, scale), numbers(batch, targets), numbers(batch, shares)
        active = y * margins(rows, weights) < 1
        return backwards(rows, 2 * c * active * margins(rows, directions), width)

    found = summed(problem.chosen(), weights.size, statistics, problem.tasks)
    return found.reshape(weights.shape) + problem.penalised(directions)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One product per model."""
    return np.einsum("wm,wm->m", a, b)


def fit_logistic(problem: Problem, tolerance: float = 1e-3, passes: int = 300) -> Linear:
    """Limited-memory quasi-Newton steps of all models side by side, each with its own memory and step length.  Done when
    every model's gradient is below ``tolerance`` times its gradient at zero and level (see :func:`steep`); a model that is
    done, or has found its step length, takes no part in the passes for the others."""
    rows = gathered(problem.rows)
    problem = replace(problem, rows=rows, tasks=tasks_of(rows))
    weights = np.zeros((problem.width + 1, len(problem.targets)))
    loss, gradient = logistic_pass(problem, weights)
    at_zero = np.linalg.norm(gradient, axis=0)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    # Directions are measured by the curvature at zero, so common and rare terms move alike.
    first = 1 / np.maximum(logistic_curvature(problem, weights), 1e-12)
    scale, used = np.ones(len(loss)), 2
    rounding = 1e-9 * loss
    live = at_zero > 0
    while live.any() and used < passes:
        direction = -two_loops(gradient, steps, scale * first) * live
        slope = dots(direction, gradient)
        if (slope[live] >= 0).any():
            steps, direction = [], -gradient * first * live
            slope = dots(direction, gradient)
        length, open_models = np.ones(len(live)), live.copy()
        new_loss, new_gradient = loss.copy(), gradient.copy()
        while True:
            there = weights + length * direction
            some = np.flatnonzero(open_models)
            new_loss[some], new_gradient[:, some] = logistic_pass(problem.only(some), there[:, some])
            used += 1
            open_models &= (new_loss > loss + 1e-4 * length * slope) & (length > 1e-10)
            if not open_models.any() or used >= passes:
                break
            length = np.where(open_models, shortened(length, slope, new_loss - loss), length)
        s, y = there - weights, new_gradient - gradient
        product, square = dots(s, y), dots(y * first, y)
        counts = product > 1e-12 * np.maximum(square, 1e-300)
        steps = [*steps[1 - MEMORY :], (s, y, np.where(counts, 1 / np.where(counts, product, 1), 0))]
        scale = np.where(counts, product / np.where(counts, square, 1), scale)
        weights, loss, gradient = there, new_loss, new_gradient
        live = live & ((np.linalg.norm(gradient, axis=0) > tolerance * at_zero) | steep(problem, weights, gradient, rounding))
    norms = np.linalg.norm(gradient, axis=0)
    done = (norms <= tolerance * at_zero) & ~steep(problem, weights, gradient, rounding)
    return Linear(weights, norms, at_zero, used, bool(done.all()), problem.scale)


def steep(problem: Problem, weights: np.ndarray, gradient: np.ndarray, rounding: np.ndarray) -> np.ndarray:
    """Per model whether its loss with its penalty still changes along its weights or its intercept, against the penalty.  The
    gradient at zero grows with the rows and the penalty does not, so with many rows a small share of it is no optimum yet."""
    counted = problem.penalised(weights)
    along, level = np.abs(dots(counted, gradient)), np.abs(gradient[-1])
    return np.maximum(along, level) > LEVEL * dots(counted, counted) + rounding


def shortened(length: np.ndarray, slope: np.ndarray, rise: np.ndarray) -> np.ndarray:
    """Per model the lowest point of the parabola through the loss here, its slope, and the loss ``length`` ahead; at
    most half and at least a tenth of ``length``."""
    bend = rise - slope * length
    return np.clip(-0.5 * slope * length**2 / np.where(bend > 0, bend, 1), 0.1 * length, 0.5 * length)


def two_loops(gradient: np.ndarray, steps: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]], scale: np.ndarray) -> np.ndarray:
    """Per model the inverse curvature that its last steps show, on top of ``scale``, times the gradient.  A step comes with the inverse of
    its product with the gradient's change, 0 for a model that it tells nothing about."""
    q, shares = gradient.copy(), []
    for s, y, inverse in reversed(steps):
        share = dots(s, q) * inverse
        shares.append(share)
        q -= share * y
    q *= scale
    for (s, y, inverse), share in zip(steps, reversed(shares), strict=True):
        q += s * (share - dots(y, q) * inverse)
    return q


def inner_steps(curved: Callable[[np.ndarray, np.ndarray], np.ndarray], gradient, diagonal, radius, live):
    """Per model a step that lowers the quadratic model inside its region (measured by ``diagonal``), the model's decrease
    and the passes used.  Conjugate gradients; a model that reaches its border or a small rest stands still."""
    step, rest = np.zeros_like(gradient), -gradient * live
    scaled = rest / diagonal
    direction, product = scaled.copy(), dots(rest, scaled)
    goal = INNER_REST**2 * product
    going, used = live & (product > 0), 0
    while going.any() and used < INNER_STEPS:
        bent = curved(direction * going, going)
        used += 1
        bend = dots(direction, bent)
        length = np.where(going, product / np.where(bend > 0, bend, 1), 0)
        ahead = step + length * direction
        outside = going & (dots(ahead * diagonal, ahead) >= radius**2)
        if outside.any():
            # To the border of the region: the positive root of |step + t direction| = radius.
            a, b = dots(direction * diagonal, direction), dots(step * diagonal, direction)
            c = dots(step * diagonal, step) - radius**2
            root = (-b + np.sqrt(np.maximum(b * b - a * c, 0))) / np.where(a > 0, a, 1)
            length = np.where(outside, root, length)
            ahead = step + length * direction
        step, rest = ahead, rest - length * bent
        scaled = rest / diagonal
        new_product = dots(rest, scaled)
        going = going & ~outside & (new_product > goal)
        direction = np.where(going, scaled + new_product / np.where(product > 0, product, 1) * direction, 0)
        product = new_product
    # rest = -(gradient + H step), so the predicted decrease is half of step . (rest - gradient).
    return step, 0.5 * dots(step, rest - gradient * live), used


def fit_squared_hinge(problem: Problem, tolerance: float = 1e-3, passes: int = 300) -> Linear:
    """Trust-region Newton, all models in step.  Done when every model's gradient is below ``tolerance`` times its
    gradient at zero."""
    problem = replace(problem, tasks=tasks_of(problem.rows))
    weights = np.zeros((problem.width + 1, len(problem.targets)))
    loss, gradient, diagonal = hinge_pass(problem, weights)
    at_zero = np.linalg.norm(gradient, axis=0)
    radius = np.sqrt(dots(gradient / diagonal, gradient))
    used, first = 1, True
    live = at_zero > 0
    while live.any() and used < passes:
        here = weights
        step, expected, inner = inner_steps(lambda d, going: curvature_pass(problem, here, d), gradient, diagonal, radius, live)
        new_loss, new_gradient, new_diagonal = hinge_pass(problem, weights + step)
        used += inner + 1
        length = np.sqrt(dots(step * diagonal, step))
        if first:
            radius, first = np.where(live, np.minimum(radius, length), radius), False
        share = np.where(expected > 0, (loss - new_loss) / np.where(expected > 0, expected, 1), 0)
        radius = np.where(live & (share < POOR), 0.25 * np.minimum(length, radius), radius)
        radius = np.where(live & (share > GOOD), np.maximum(radius, 4 * length), radius)
        taken = live & (share > TAKEN)
        weights = np.where(taken, weights + step, weights)
        loss, gradient, diagonal = np.where(taken, new_loss, loss), np.where(taken, new_gradient, gradient), np.where(taken, new_diagonal, diagonal)
        # A region without size can't improve any more: rounding.
        live = live & (np.linalg.norm(gradient, axis=0) > tolerance * at_zero) & (radius > 1e-12)
    norms = np.linalg.norm(gradient, axis=0)
    return Linear(weights, norms, at_zero, used, bool((norms <= tolerance * at_zero).all()), problem.scale)


def scored(rows: DataFrame, model: Linear, name: str = "margins") -> DataFrame:
    """``rows`` (with the columns of their entries, which go) plus an array of margins, one per model."""
    weights, scale = model.weights, model.scale
    entries = entry_columns(rows)
    kept = [c for c in rows.columns if c not in entries]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField(name, T.ArrayType(T.DoubleType()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = margins(Sparse(batch, scale), weights)
            found = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), found], names=[*kept, name])

    return rows.select(*kept, *entries).mapInArrow(task, schema)


def largest(margins: Column) -> Column:
    """Place of the largest margin, the first on ties."""
    return F.array_position(margins, F.array_max(margins)).cast("int") - 1


# The functions travel with the tasks, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
