"""All heads of a multi-label classifier trained together: every label and every candidate in one pass per step.

A head is one label under one candidate (an L2 strength). Its loss is the mean binary cross-entropy over the
training rows plus the candidate's penalty on weights of standardised features, the intercept left free: the objective of
one logistic regression per label. Each step broadcasts the weights of the heads that still move (features x heads), every task
sums the losses and gradients of its rows by products of matrices over slices of them, sums meet per block of features, and the driver moves
each head by its own limited-memory quasi-Newton step and step length. A head stops when its gradient is
small. Heads are taken in blocks so that weights never exceed ``WEIGHTS`` numbers, whatever the number of labels.

``certificates`` recomputes loss and gradient of fitted heads in a pass of its own: the proof that they are optimal.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import gathered, stored
from .train import feature_stages

#: Numbers in the weights of the heads that are trained together.
WEIGHTS = 1 << 22
#: Numbers in the working arrays of a task.
CELLS = 1 << 21
MEMORY = 10
BLOCK = 2048


@dataclass
class Heads:
    """``weights`` (features + 1 x heads; the last row holds intercepts, in units of the raw features), heads ordered by
    candidate, then label."""

    weights: np.ndarray
    n_labels: int
    regs: tuple[float, ...]

    def candidate(self, i: int) -> np.ndarray:
        return self.weights[:, i * self.n_labels : (i + 1) * self.n_labels]


def sparse_features(model, rows: DataFrame, text_col: str, ids_col: str) -> DataFrame:
    """``idx``, ``val`` (the stored values of the feature vector) and ``y`` (label ids) per row."""
    vec = F.unwrap_udt(F.col("features"))
    feats = model.transform(rows.select(F.col(text_col), F.col(ids_col).alias("_y")))
    return feats.select(vec["indices"].alias("idx"), vec["values"].alias("val"), F.col("_y").cast("array<int>").alias("y"))


def _parts(batches: Iterator[pa.RecordBatch], heads: int, dense: int = 0) -> Iterator[tuple]:
    """(row numbers per value, feature, value, row numbers per label, label, rows) of slices whose products fit in ``CELLS``, as do
    (with ``dense`` features) their rows as a matrix."""
    for batch in batches:
        start = 0
        sizes = np.concatenate([[0], np.cumsum(batch.column(0).value_lengths().to_numpy(zero_copy_only=False) + 1)])
        while start < batch.num_rows:
            most = max(1, CELLS // heads)
            if dense:  # the matrices are rows x heads and rows x features in use: a row's values are never that many copies
                end = min(start + max(1, CELLS // max(heads, dense)), batch.num_rows)
            else:
                end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + most, side="right")) - 1)
            part = batch.slice(start, end - start)
            idx, val, y = part.column(0), part.column(1), part.column(2)
            n = part.num_rows
            row = np.repeat(np.arange(n), idx.value_lengths().to_numpy(zero_copy_only=False))
            of = np.repeat(np.arange(n), y.value_lengths().to_numpy(zero_copy_only=False))
            yield row, idx.flatten().to_numpy(), val.flatten().to_numpy(), of, y.flatten().to_numpy(), n
            start = end


def _sum_by(keys: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``rows`` by key: size x columns."""
    out = np.zeros((size, rows.shape[1]))
    if len(keys):
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.diff(keys[order], prepend=-1))
        out[keys[order[first]]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _matrix(row, idx, val, n: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """The features in use and the rows as a matrix over them: sums over values become products of matrices."""
    used = np.zeros(features, dtype=bool)
    used[idx] = True
    cols = np.flatnonzero(used)
    place = np.cumsum(used) - 1
    x = np.zeros((n, len(cols)))
    x[row, place[idx]] = val  # a sparse vector holds each feature once
    return cols, x


def _margins(w: np.ndarray, row, idx, val, n: int) -> np.ndarray:
    cols, x = _matrix(row, idx, val, n, len(w) - 1)
    return x @ w[cols] + w[-1]


def _blocks(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    keep = [b for b in range(0, len(table), BLOCK) if table[b : b + BLOCK].any()]
    yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int32()), pa.array([table[b : b + BLOCK].tobytes() for b in keep], pa.binary())], ["block", "sums"])


def _summed(partial: DataFrame, rows: int, columns: int) -> np.ndarray:
    """Partial tables of (block, sums) added up, block by block, then brought together (rows x columns: bounded)."""

    def add(key, table):
        total = sum(np.frombuffer(x.as_py(), dtype=np.float64) for x in table.column("sums"))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((rows, columns))
    for r in partial.groupBy("block").applyInArrow(add, "block int, sums binary").collect():
        part = np.frombuffer(r["sums"], dtype=np.float64).reshape(-1, columns)
        out[r["block"] : r["block"] + len(part)] = part
    return out


def _losses(rows: DataFrame, w: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Sums over all rows: gradient per feature, of the intercepts, and (last row) the loss, per head. ``labels`` names each head's label."""
    shared = rows.sparkSession.sparkContext.broadcast((w, labels))

    def run(batches):
        weights, own = shared.value
        total = np.zeros((len(weights) + 1, weights.shape[1]))
        n_labels = int(own.max()) + 1
        for row, idx, val, of, y, n in _parts(batches, weights.shape[1], len(weights) - 1):
            cols, x = _matrix(row, idx, val, n, len(weights) - 1)
            z = x @ weights[cols] + weights[-1]
            truth = np.zeros((n, n_labels))
            known = y < n_labels
            truth[of[known], y[known]] = 1
            truth = truth[:, own]
            total[-1] += (np.logaddexp(0, z) - truth * z).sum(axis=0)
            rest = 1 / (1 + np.exp(-np.clip(z, -700, 700))) - truth
            total[cols] += x.T @ rest
            total[-2] += rest.sum(axis=0)
        yield from _blocks(total)

    out = _summed(rows.mapInArrow(run, "block int, sums binary"), len(w) + 1, w.shape[1])
    shared.unpersist()
    return out


def feature_spread(rows: DataFrame, n_features: int) -> tuple[int, np.ndarray]:
    """(rows, sample standard deviation per feature)."""

    def run(batches):
        total = np.zeros((n_features + 1, 2))
        for row, idx, val, _, _, n in _parts(batches, 2):
            total[:-1] += _sum_by(idx, np.column_stack([val, val * val]), n_features)
            total[-1] += n
        yield from _blocks(total)

    sums = _summed(rows.mapInArrow(run, "block int, sums binary"), n_features + 1, 2)
    n = int(sums[-1, 0])
    mean = sums[:-1, 0] / max(n, 1)
    return n, np.sqrt(np.maximum(sums[:-1, 1] - n * mean * mean, 0) / max(n - 1, 1))


def _objective(rows: DataFrame, x: np.ndarray, scale: np.ndarray, penalty: np.ndarray, labels: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, gradient) per head at ``x``, in weights of standardised features."""
    w = x.copy()
    w[:-1] *= scale[:, None]
    sums = _losses(rows, w, labels)
    grad = sums[:-1] / n
    grad[:-1] = grad[:-1] * scale[:, None] + penalty * x[:-1]
    return sums[-1] / n + 0.5 * penalty * (x[:-1] ** 2).sum(axis=0), grad


def _directions(grad: np.ndarray, past: list[tuple]) -> np.ndarray:
    """Limited-memory quasi-Newton directions, each head by its own history (rho 0: that step is none of the head's)."""
    q, keep = grad.copy(), []
    for s, y, rho in reversed(past):
        a = rho * (s * q).sum(axis=0)
        q -= a * y
        keep.append(a)
    gain = np.ones(grad.shape[1])
    for s, y, rho in past:  # the last step of each head scales
        gain = np.where(rho > 0, 1 / np.maximum(rho * (y * y).sum(axis=0), 1e-300), gain)
    q *= gain
    for (s, y, rho), a in zip(past, reversed(keep)):
        q += s * (a - rho * (y * q).sum(axis=0))
    return -q


def _minimised(rows: DataFrame, scale: np.ndarray, penalty: np.ndarray, labels: np.ndarray, n: int, max_passes: int, tol: float) -> np.ndarray:
    heads = len(labels)
    x = np.zeros((len(scale) + 1, heads))
    value, grad = _objective(rows, x, scale, penalty, labels, n)
    past: list[tuple] = []
    d, step = -grad, 1 / np.maximum(1.0, np.sqrt((grad * grad).sum(axis=0)))
    for _ in range(max_passes):
        live = np.sqrt((grad * grad).sum(axis=0)) > tol
        if not live.any():
            break
        slope = (d * grad).sum(axis=0)
        trial = x + np.where(live, step, 0) * d
        at = np.flatnonzero(live)  # the others stay where they are
        v, g = value.copy(), grad.copy()
        v[at], g[:, at] = _objective(rows, trial[:, at], scale, penalty[at], labels[at], n)
        good = live & (v <= value + 1e-4 * step * slope + 1e-12)
        s, y = np.where(good, trial - x, 0), np.where(good, g - grad, 0)
        sy = (s * y).sum(axis=0)
        past = (past + [(s, y, np.where(sy > 1e-18, 1 / np.maximum(sy, 1e-18), 0))])[-MEMORY:]
        x, value, grad = np.where(good, trial, x), np.where(good, v, value), np.where(good, g, grad)
        fresh = _directions(grad, past)
        down = (fresh * grad).sum(axis=0) < 0
        d = np.where(good, np.where(down, fresh, -grad), d)
        step = np.where(good, 1.0, step / 2)
    x[:-1] *= scale[:, None]
    return x


def fit_heads(rows: DataFrame, n_features: int, n_labels: int, regs: Sequence[float] = (0.01, 0.1), max_passes: int = 150,
              tol: float = 1e-5) -> Heads:
    """Heads for every label and candidate from ``rows`` (``sparse_features``; stored or cached, as each step reads them)."""
    rows = gathered(rows)
    n, spread = feature_spread(rows, n_features)
    scale = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 0)
    labels = np.tile(np.arange(n_labels), len(regs))
    penalty = np.repeat(np.array(regs, dtype=np.float64), n_labels)
    at_once = max(1, WEIGHTS // (n_features + 1))
    parts = [_minimised(rows, scale, penalty[a : a + at_once], labels[a : a + at_once], n, max_passes, tol)
             for a in range(0, len(labels), at_once)]
    return Heads(np.concatenate(parts, axis=1) if parts else np.zeros((n_features + 1, 0)), n_labels, tuple(regs))


def certificates(rows: DataFrame, heads: Heads, n_features: int) -> list[tuple[int, int, float, float]]:
    """(candidate, label, objective, gradient norm) of every fitted head, recomputed over ``rows``."""
    rows = gathered(rows)
    n, spread = feature_spread(rows, n_features)
    scale = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 0)
    out, at_once = [], max(1, WEIGHTS // (n_features + 1))
    penalty = np.repeat(np.array(heads.regs), heads.n_labels)
    for a in range(0, heads.weights.shape[1], at_once):
        w = heads.weights[:, a : a + at_once].copy()
        w[:-1] *= spread[:, None]
        own = np.arange(a, a + w.shape[1])
        value, grad = _objective(rows, w, scale, penalty[own], own % max(heads.n_labels, 1), n)
        out += [(int(h // heads.n_labels), int(h % heads.n_labels), float(v), float(g)) for h, v, g in zip(own, value, np.sqrt((grad * grad).sum(axis=0)))]
    return out


def _counts(rows: DataFrame, w: np.ndarray, t: float) -> np.ndarray:
    """tp, fp, fn and loss per label; in the last row rows, exactly right rows."""
    shared = rows.sparkSession.sparkContext.broadcast(w)
    n_labels = w.shape[1]

    def run(batches):
        weights = shared.value
        total = np.zeros((n_labels + 1, 4))
        for row, idx, val, of, y, n in _parts(batches, n_labels, len(weights) - 1):
            z = _margins(weights, row, idx, val, n)
            truth = np.zeros((n, n_labels), dtype=bool)
            truth[of, y] = True
            said = 1 / (1 + np.exp(-np.clip(z, -700, 700))) >= t
            total[:-1] += np.stack([(said & truth).sum(axis=0), (said & ~truth).sum(axis=0), (~said & truth).sum(axis=0),
                                    (np.logaddexp(0, z) - truth * z).sum(axis=0)], axis=1)
            total[-1, :2] += n, (said == truth).all(axis=1).sum()
        yield from _blocks(total)

    return _summed(rows.mapInArrow(run, "block int, sums binary"), n_labels + 1, 4)


def score_heads(rows: DataFrame, w: np.ndarray, t: float = 0.5) -> dict[str, float]:
    """Multi-label metrics and mean loss of one candidate's heads over ``rows``."""
    c = _counts(rows, w, t)
    tp, fp, fn = c[:-1, 0], c[:-1, 1], c[:-1, 2]

    def ratio(a, b):
        return float(a / b) if b else 0.0

    f1 = 2 * tp / np.maximum(2 * tp + fp + fn, 1)
    return {"micro_f1": ratio(2 * tp.sum(), 2 * tp.sum() + fp.sum() + fn.sum()), "macro_f1": float(f1.mean()) if len(f1) else 0.0,
            "micro_precision": ratio(tp.sum(), tp.sum() + fp.sum()), "micro_recall": ratio(tp.sum(), tp.sum() + fn.sum()),
            "subset_acc": ratio(c[-1, 1], c[-1, 0]), "loss": ratio(c[:-1, 3].sum(), c[-1, 0] * max(len(f1), 1))}


def select_and_test_heads(data: DataFrame, text_col: str, ids_col: str, n_labels: int, regs: Sequence[float] = (0.01, 0.1),
                          num_features: int = 1 << 12, max_passes: int = 150, tol: float = 1e-5):
    """Rows with ``split`` (train, val, test), texts and label ids: all candidates of all labels are trained together, the first with the
    strictly best validation macro F1 is scored on test once.

    Returns (feature model, heads, chosen candidate, table of ``candidate, reg, split``, the metrics, ``loss`` and ``chosen``, training rows)."""
    parts = {s: data.where(F.col("split") == s) for s in ("train", "val", "test")}
    model = Pipeline(stages=feature_stages(text_col, num_features)).fit(parts["train"])
    feats = {s: stored(sparse_features(model, d, text_col, ids_col), f"heads_{s}") for s, d in parts.items()}
    heads = fit_heads(feats["train"], num_features, n_labels, regs, max_passes, tol)
    rows = [(i, float(reg), "val", score_heads(feats["val"], heads.candidate(i))) for i, reg in enumerate(regs)]
    best = max(range(len(regs)), key=lambda i: (rows[i][3]["macro_f1"], -i))
    rows.append((best, float(regs[best]), "test", score_heads(feats["test"], heads.candidate(best))))
    names = list(rows[0][3])
    table = data.sparkSession.createDataFrame(
        [(i, reg, s, *[m[c] for c in names], i == best) for i, reg, s, m in rows],
        "candidate int, reg double, split string, " + ", ".join(f"{c} double" for c in names) + ", chosen boolean")
    return model, heads, best, table, feats["train"]
