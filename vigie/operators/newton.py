"""Penalised logistic regression by damped Newton steps, several models per pass.

Every pass reads the encoded training rows once and sums, for each model, the loss,
its gradient and its Hessian (a Gram matrix); the sums are a few hundred numbers per
model, and the driver solves for the next step.  The models of a cross-validation
differ in the fold they leave out and in their scaler.  A scaler is an affine map of
the encoded columns, so it is applied to the sums, not to the rows.

A model is done when no entry of its mean gradient exceeds ``TOL``: with a strictly
convex objective that certifies the optimum, whatever path led there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: largest entry of the mean gradient (loss and penalty) of a finished model
TOL = 1e-10
MAX_PASSES = 100
#: encoded columns up to which the Hessian is formed (its size is their square)
MAX_COLUMNS = 600


class NotConverged(Exception):
    """The optimum was not certified within ``MAX_PASSES`` passes."""


@dataclass
class Fitted:
    """Weights in the model's own scale, with the certificate."""

    weights: np.ndarray
    intercept: float
    gradient: float     # largest entry of the mean gradient at the weights
    gap: float          # half the squared Newton decrement: estimated distance of the objective to its minimum
    passes: int
    rows: int


@dataclass
class _State:
    scale: np.ndarray           # maps augmented encoded rows to the model's own
    at: np.ndarray              # weights that the next pass evaluates, intercept last
    step: float = 1.0
    base: np.ndarray | None = None      # last accepted weights
    value: float = np.inf               # objective there
    slope: float = 0.0
    direction: np.ndarray | None = None
    result: Fitted | None = None


def _sums(points: np.ndarray, models: list[int]):
    """One row per partition and model: (model, n, positives, loss, gradient, Hessian as one array)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = points.shape[1]
        total = np.zeros((len(models), 3 + size + size * size))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            if np.isnan(x).any() or np.isnan(y).any():
                raise ValueError("a feature or an outcome of the training set is null or NaN")
            x = np.hstack([x, np.ones((len(x), 1))])
            fold = batch.column(2).fill_null(-1).to_numpy()
            for k, j in enumerate(models):
                rows = fold != j
                a, b = (x, y) if rows.all() else (x[rows], y[rows])
                z = a @ points[k]
                p = np.exp(-np.logaddexp(0, -z))
                total[k, 0] += len(b)
                total[k, 1] += b.sum()
                total[k, 2] += (np.logaddexp(0, z) - b * z).sum()
                total[k, 3:3 + size] += a.T @ (p - b)
                total[k, 3 + size:] += (a.T @ (a * (p * (1 - p))[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(models, pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["model", "sums"])

    return run


def _pass(data: DataFrame, points: np.ndarray, models: list[int]) -> dict[int, np.ndarray]:
    parts = data.mapInArrow(_sums(points, models), "model int, sums array<double>")
    rows = parts.select("model", F.posexplode("sums").alias("pos", "x")).groupBy("model", "pos").agg(F.sum("x").alias("x")).collect()
    size = points.shape[1]
    out = {j: np.zeros(3 + size + size * size) for j in models}
    for r in rows:  # (columns + 1) squared numbers a model
        out[r["model"]][r["pos"]] = r["x"]
    return out


def fit(data: DataFrame, n_columns: int, models: list[int], scales: dict[int, tuple[np.ndarray, np.ndarray]] | None = None,
        C: float = 1.0) -> dict[int, Fitted]:
    """Weights of each model, all fitted in the same passes.

    ``data``: columns x (array of encoded values), y (0.0 or 1.0), fold (int or
    null).  Model j is trained on the rows whose fold is not j.  ``scales[j]``: mean
    and deviation of each encoded column in the model's own scale (default 0, 1).
    Objective: sum of losses + |weights|^2 / (2 C), intercept not penalised.
    """
    size = n_columns + 1
    ridge = np.append(np.full(n_columns, 1.0 / C), 0.0)
    states = {}
    for j in models:
        mean, std = (scales or {}).get(j, (np.zeros(n_columns), np.ones(n_columns)))
        own = np.diag(np.append(1.0 / std, 1.0))
        own[-1, :-1] = -mean / std
        states[j] = _State(scale=own, at=np.zeros(size))
    for passes in range(1, MAX_PASSES + 1):
        open_models = [j for j, s in states.items() if s.result is None]
        if not open_models:
            break
        points = np.stack([states[j].scale @ states[j].at for j in open_models])
        for j, sums in _pass(data, points, open_models).items():
            _advance(states[j], sums, ridge, passes)
    late = [j for j, s in states.items() if s.result is None]
    if late:
        raise NotConverged(f"models {late} after {MAX_PASSES} passes")
    return {j: s.result for j, s in states.items()}


def _advance(s: _State, sums: np.ndarray, ridge: np.ndarray, passes: int) -> None:
    """Take the evaluated point or halve the step; choose the next point or finish."""
    size = len(s.at)
    n, positives, loss = sums[:3]
    if n == 0 or positives in (0, n):
        raise ValueError("a training set needs rows of both outcomes")
    value = loss + 0.5 * float(ridge @ s.at ** 2)
    gradient = s.scale.T @ sums[3:3 + size] + ridge * s.at
    worst = float(np.abs(gradient).max() / n)
    # a step must gain a share of what its slope promises, up to rounding
    if s.base is not None and value > s.value + 1e-4 * s.step * s.slope + 1e-12 * abs(s.value) and worst > TOL:
        s.step /= 2
        s.at = s.base + s.step * s.direction
        return
    hessian = s.scale.T @ sums[3 + size:].reshape(size, size) @ s.scale + np.diag(ridge)
    direction = -np.linalg.lstsq(hessian, gradient, rcond=None)[0]
    slope = float(gradient @ direction)
    if worst <= TOL:
        s.result = Fitted(s.at[:-1].copy(), float(s.at[-1]), worst, -slope / 2, passes, int(n))
        return
    s.base, s.value, s.slope, s.direction, s.step = s.at, value, slope, direction, 1.0
    s.at = s.base + direction
