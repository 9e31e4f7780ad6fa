"""Ridge logistic models over a path of penalties and folds, fitted together.

With k folds and m penalties there are (k + 1) * m models: for each penalty one on all rows and one without each fold.
One pass sums the cross products of the features in each fold; those of a model's rows are the total less its fold's.
A quarter of them bounds the curvature of the logistic loss, so one eigendecomposition for each set of rows gives the
steps of all its penalties. After that every pass over the rows adds up the gradients of all models that have not
settled, as one matrix product on each Arrow batch. Steps are accelerated and start anew where they overshoot.

The loss is mean log loss plus penalty / 2 times the squared length of the coefficients of columns scaled to unit
deviation; the intercept is free, a column without deviation has coefficient 0.

Cross products, p * p numbers for each fold, and coefficients are model data: they are held in the driver, so more
than ``MAX_FEATURES`` features are refused. Rows never are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .evaluate import pair_wins
from .models import with_folds

MAX_FEATURES = 2_000
LANES = 128
PIECE = 1 << 16


@dataclass
class RidgePath:
    """Fitted path: coefficients and intercepts by fold (the last one: all rows) and penalty."""

    penalties: list[float]
    coefficients: np.ndarray  # folds + 1, penalties, features
    intercepts: np.ndarray  # folds + 1, penalties
    passes: int


def penalties_of(cross: np.ndarray, target: np.ndarray, n: int = 50, ratio: float = 1e-4) -> list[float]:
    """Log-spaced penalties, strongest first, from the sums of one set of rows; the first leaves hardly any coefficient."""
    _, scale, _ = _scaled(cross)
    slope = target[1:] - cross[0, 1:] / cross[0, 0] * target[0]
    top = np.abs(np.divide(slope, scale, out=np.zeros_like(scale), where=scale > 0)).max(initial=0.0) / cross[0, 0] / 1e-3
    return [float(x) for x in np.geomspace(top, top * ratio, n)] if top > 0 else [1.0]


def _scaled(cross: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, deviations and correlations from the cross products of (1, features)."""
    n = cross[0, 0]
    mean = cross[0, 1:] / n
    spread = cross[1:, 1:] / n - np.outer(mean, mean)
    variance = np.diag(spread).copy()
    variance[variance <= 1e-12 * np.maximum(np.diag(cross)[1:] / n, 1e-300)] = 0.0
    scale = np.sqrt(variance * n / max(n - 1, 1))
    inverse = np.divide(1.0, scale, out=np.zeros_like(scale), where=scale > 0)
    return mean, scale, spread * np.outer(inverse, inverse)


def _design(batch: pd.DataFrame) -> np.ndarray:
    return np.column_stack([np.ones(len(batch)), np.stack(batch["x"].to_numpy())])


def _pieces(total: np.ndarray) -> pd.DataFrame:
    """A task's sums, cut into rows of at most ``PIECE`` numbers."""
    flat = total.ravel()
    starts = range(0, len(flat), PIECE)
    return pd.DataFrame({"id": range(len(starts)), "lane": TaskContext.get().partitionId() % LANES, "part": [flat[i : i + PIECE] for i in starts]})


def _summed(rows: DataFrame, partial, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over all tasks of the array that ``partial`` makes of a task's batches; many tasks are added in lanes first."""
    schema = "id long, lane int, part array<double>"

    def of_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield _pieces(partial(batches))

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": parts["id"].iloc[:1], "lane": 0, "part": [np.sum(np.stack(parts["part"].to_numpy()), axis=0)]})

    laned = rows.mapInPandas(of_task, schema).groupBy("id", "lane").applyInPandas(add, schema)
    found = laned.groupBy("id").applyInPandas(add, schema).orderBy("id").select("part").collect()
    return np.concatenate([r["part"] for r in found]).reshape(shape) if found else np.zeros(shape)


def _sums(rows: DataFrame, folds: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Cross products of (1, features), and of these with the label, in each fold: one pass."""

    def partial(batches: Iterator[pd.DataFrame]) -> np.ndarray:
        total = np.zeros((folds, width, width + 1))
        for batch in batches:
            for fold, part in batch.groupby("fold"):
                x = _design(part)
                total[fold] += x.T @ np.column_stack([x, part["y"].to_numpy()])
        return total

    sums = _summed(rows, partial, (folds, width, width + 1))
    return sums[:, :, :-1], sums[:, :, -1]


def _gradients(rows: DataFrame, weights: np.ndarray, left_out: np.ndarray) -> np.ndarray:
    """Gradient sums of the log loss: one row for each model (row of ``weights``); a model skips its fold ``left_out``."""
    sent = rows.sparkSession.sparkContext.broadcast((weights, left_out))

    def partial(batches: Iterator[pd.DataFrame]) -> np.ndarray:
        w, out = sent.value
        total = np.zeros_like(w)
        for batch in batches:
            if len(batch):
                x = _design(batch)
                miss = 1.0 / (1.0 + np.exp(-np.clip(x @ w.T, -500, 500))) - batch["y"].to_numpy()[:, None]
                miss[batch["fold"].to_numpy()[:, None] == out[None, :]] = 0.0
                total += miss.T @ x
        return total

    total = _summed(rows, partial, weights.shape)
    sent.destroy()
    return total


def fit_path(rows: DataFrame, folds: int, penalties: Sequence[float] | None = None, n_penalties: int = 50,
             tolerance: float = 1e-5, max_passes: int = 300) -> RidgePath:
    """All models over ``rows`` (fold 0..folds-1, y 0 or 1, x array of features).

    A model has settled when no component of its scaled gradient exceeds ``tolerance``.
    """
    first = rows.select(F.size("x").alias("p")).first()
    if first is None:
        raise ValueError("no rows to fit")
    if first["p"] > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features: prune them first")
    width = first["p"] + 1
    cross, target = _sums(rows, folds, width)
    all_cross, all_target = cross.sum(axis=0), target.sum(axis=0)
    path = [float(v) for v in penalties] if penalties is not None else penalties_of(all_cross, all_target, n_penalties)
    m = len(path)
    lam = np.tile(np.asarray(path), folds + 1)
    owner = np.repeat(np.arange(folds + 1), m)
    left_out = np.where(owner < folds, owner, -1)
    means, scales, vectors, values, sizes, starts = [], [], [], [], [], []
    for f in range(folds + 1):
        c, t = (all_cross - cross[f], all_target - target[f]) if f < folds else (all_cross, all_target)
        if not 0 < t[0] < c[0, 0]:
            raise ValueError("every set of rows needs both labels")
        mean, scale, corr = _scaled(c)
        value, vector = np.linalg.eigh(corr)
        means.append(mean)
        scales.append(scale)
        vectors.append(vector)
        values.append(np.maximum(value, 0.0))
        sizes.append(c[0, 0])
        starts.append(np.log(t[0] / (c[0, 0] - t[0])))
    mean, scale = np.stack(means)[owner], np.stack(scales)[owner]
    inverse = np.divide(1.0, scale, out=np.zeros_like(scale), where=scale > 0)
    size = np.asarray(sizes)[owner]
    at = np.zeros((len(owner), width))  # intercept of centred columns, then scaled coefficients
    at[:, 0] = np.asarray(starts)[owner]
    before, age = at.copy(), np.zeros(len(owner))
    open_ = np.arange(len(owner))
    passes = 0

    def raw(models: np.ndarray, points: np.ndarray) -> np.ndarray:
        beta = points[:, 1:] * inverse[models]
        return np.column_stack([points[:, 0] - (beta * mean[models]).sum(axis=1), beta])

    while len(open_) and passes < max_passes:
        ahead = at[open_] + (age[open_] / (age[open_] + 3.0))[:, None] * (at[open_] - before[open_])
        g = _gradients(rows, raw(open_, ahead), left_out[open_])
        passes += 1
        slope = (g[:, 1:] - mean[open_] * g[:, :1]) * inverse[open_] / size[open_, None] + lam[open_, None] * ahead[:, 1:]
        free = g[:, 0] / size[open_]
        new = ahead.copy()
        new[:, 0] -= 4.0 * free
        for f in np.unique(owner[open_]):
            of = owner[open_] == f
            step = (slope[of] @ vectors[f]) / (values[f][None, :] / 4.0 + lam[open_[of], None])
            new[of, 1:] -= step @ vectors[f].T
        over = free * (new[:, 0] - at[open_, 0]) + (slope * (new[:, 1:] - at[open_, 1:])).sum(axis=1) > 0
        age[open_] = np.where(over, 0.0, age[open_] + 1.0)
        before[open_], at[open_] = at[open_], new
        settled = np.maximum(np.abs(free), np.abs(slope).max(axis=1, initial=0.0)) < tolerance
        open_ = open_[~settled]
    if len(open_):
        raise RuntimeError(f"{len(open_)} of {len(owner)} models have not settled in {max_passes} passes")
    out = raw(np.arange(len(owner)), at)
    return RidgePath(path, out[:, 1:].reshape(folds + 1, m, -1), out[:, 0].reshape(folds + 1, m), passes)


def _margins(rows: DataFrame, weights: np.ndarray, keep: list[str], by_fold: bool) -> DataFrame:
    """``keep`` and ``margins``, one for each penalty: by the model that left the row's fold out, or by the last one."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = sent.value
        for batch in batches:
            if not len(batch):
                continue
            x = _design(batch)
            out = np.zeros((len(batch), w.shape[1]))
            models = batch["fold"].to_numpy() if by_fold else np.full(len(batch), len(w) - 1)
            for f in np.unique(models):
                out[models == f] = x[models == f] @ w[f].T
            yield batch[keep].assign(margins=list(out))

    return rows.mapInPandas(score, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", margins array<double>")


def path_scores(rows: DataFrame, path: RidgePath) -> DataFrame:
    """``penalty_no, penalty, auc, folds``: mean over folds of the area under the curve on the rows left out.

    Folds whose rows have one label only do not count.
    """
    weights = np.concatenate([path.intercepts[:, :, None], path.coefficients], axis=2)
    scored = stage(_margins(rows, weights, ["fold", "y"], by_fold=True), "margins")
    long = scored.select("fold", "y", F.posexplode("margins").alias("penalty_no", "score")).select("fold", "y", "penalty_no", (F.col("score") + F.lit(0.0)).alias("score"))
    wins = pair_wins(long, ["penalty_no", "fold"], "score", "y")
    each = wins.select("penalty_no", ((F.col("correct") + F.col("ties") / 2) / F.col("total")).alias("auc"))
    named = F.element_at(F.array(*[F.lit(v) for v in path.penalties]), F.col("penalty_no") + 1)
    return each.groupBy("penalty_no").agg(F.avg("auc").alias("auc"), F.count("*").alias("folds")).withColumn("penalty", named)


def folded_rows(df: DataFrame, label: str, key: str, features: str, folds: int) -> DataFrame:
    """fold, y, x of the rows that have a label; stored."""
    known = df.where(F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("y"), features)
    return stage(with_folds(known, "y", key, folds).select("fold", "y", vector_to_array(features).alias("x")), "folds")


def cv_ridge(train: DataFrame, test: DataFrame, label: str, key: str, features: str = "features", folds: int = 10,
             penalties: Sequence[float] | None = None, n_penalties: int = 50, **limits) -> tuple[DataFrame, DataFrame]:
    """(``key, probability`` of ``test`` at the best penalty, the path with its mean areas).

    The best penalty has the largest mean area under the curve, the stronger one among equals.
    """
    rows = folded_rows(train, label, key, features, folds)
    path = fit_path(rows, folds, penalties, n_penalties, **limits)
    board = stage(path_scores(rows, path), "path")
    best = board.orderBy(F.col("auc").desc(), "penalty_no").select("penalty_no").first()
    at = best["penalty_no"] if best else 0
    weights = np.append(path.intercepts[-1, at], path.coefficients[-1, at])[None, None, :]
    asked = test.select(key, vector_to_array(features).alias("x"))
    scored = _margins(asked, weights, [key], by_fold=False)
    return scored.select(key, (1 / (1 + F.exp(-F.get("margins", 0)))).alias("probability")), board
