"""All folds and penalties of a logistic search as one problem: one pass over the rows per Newton step."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Newton steps at most, and the decrement, as a share of the loss, at which a model is done.
STEPS = 100
DONE = 1e-14


@dataclass
class Stack:
    """Models (penalty, held-out fold), each with the scale of its training rows and its weights in that scale."""

    penalties: Sequence[float]
    folds: int
    mean: np.ndarray
    std: np.ndarray
    class_weight: np.ndarray
    weights: np.ndarray
    passes: int = 0

    def probability(self, features: Sequence[str]) -> Column:
        """Array of (candidate, held_out, probability) of a row."""
        cells = []
        for c in range(len(self.penalties)):
            for f in range(self.folds):
                w = self.weights[c, f]
                slope = np.divide(w[1:], self.std[f], out=np.zeros(len(features)), where=self.std[f] > 0)
                margin = F.lit(float(w[0] - slope @ self.mean[f]))
                for name, s in zip(features, slope, strict=True):
                    margin = margin + F.col(name) * F.lit(float(s))
                cells.append(F.struct(F.lit(c).alias("candidate"), F.lit(f).alias("held_out"), (1 / (1 + F.exp(-margin))).alias("probability")))
        return F.array(*cells)


def fold_scales(rows: DataFrame, features: Sequence[str], label: str, folds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, deviations and balanced class weights of the rows outside each fold, from one aggregation."""
    stats = [x for c in features for x in (F.avg(c), F.var_pop(c))]
    found = rows.groupBy("fold").agg(F.count("*"), F.count_if(F.col(label) == 1), *stats).collect()
    by = {r[0]: np.array([float(x or 0) for x in r[1:]]) for r in found}
    mean, std, weight = [], [], []
    for fold in range(folds):
        own = [v for k, v in by.items() if k != fold]
        n = sum(v[0] for v in own)
        positives = sum(v[1] for v in own)
        if not 0 < positives < n:
            raise ValueError(f"the rows outside fold {fold} are of one class")
        centre = sum(v[0] * v[2::2] for v in own) / n
        spread = sum(v[0] * (v[3::2] + (v[2::2] - centre) ** 2) for v in own)
        mean.append(centre)
        std.append(np.sqrt(spread / max(n - 1, 1)))
        weight.append((n / (2 * (n - positives)), n / (2 * positives)))
    return np.array(mean), np.array(std), np.array(weight)


def _pass(rows: DataFrame, features: Sequence[str], label: str, stack: Stack) -> np.ndarray:
    """Loss, gradient and Hessian of every model, added up over the rows: (candidate, fold, 1 + p + p * p)."""
    p = len(features) + 1
    shape = (len(stack.penalties), stack.folds, 1 + p + p * p)
    mean, std, class_weight, weights = stack.mean, stack.std, stack.class_weight, stack.weights

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            fold, y = b.column(0).to_numpy(), b.column(1).to_numpy()
            x = np.stack([b.column(k).to_numpy() for k in range(2, 1 + p)], 1) if p > 1 else np.empty((len(y), 0))
            for f in range(shape[1]):
                own, t = x[fold != f], y[fold != f]
                scaled = np.divide(own - mean[f], std[f], out=np.zeros_like(own), where=std[f] > 0)
                design = np.concatenate([np.ones((len(t), 1)), scaled], 1)
                cost = class_weight[f][t.astype(int)]
                for c in range(shape[0]):
                    margin = design @ weights[c, f]
                    prob = 0.5 * (1 + np.tanh(margin / 2))
                    curve = cost * prob * (1 - prob)
                    total[c, f, 0] += cost @ (np.logaddexp(0, margin) - t * margin)
                    total[c, f, 1 : 1 + p] += design.T @ (cost * (prob - t))
                    total[c, f, 1 + p :] += (design.T @ (design * curve[:, None])).ravel()
        yield pa.record_batch({"sums": pa.array([total.tobytes()], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            for part in b.column(0).to_pylist():
                total += np.frombuffer(part).reshape(shape)
        yield pa.record_batch({"sums": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select("fold", label, *features).mapInArrow(sums, "sums binary")
    middle = math.isqrt(max(rows.rdd.getNumPartitions(), 1))
    if middle > 1:
        parts = parts.repartition(middle).mapInArrow(merge, "sums binary")
    return sum((np.frombuffer(r["sums"]).reshape(shape) for r in parts.toLocalIterator()), np.zeros(shape))


def fit_stack(rows: DataFrame, features: Sequence[str], label: str, penalties: Sequence[float], folds: int) -> Stack:
    """Balanced, L2-penalised logistic models of every penalty C on the rows outside every fold.

    rows: features and label as doubles without NULLs, fold as int; cached, as each step
    reads them once. All models take their Newton steps together: tasks add up each one's
    loss, gradient and Hessian, a second level of tasks adds up theirs, and the driver gets
    the square root of the number of partitions of such sums. A step that does not lower a
    model's loss is halved. Features of one value get the weight zero.
    """
    mean, std, class_weight = fold_scales(rows, features, label, folds)
    p = len(features) + 1
    stack = Stack(penalties, folds, mean, std, class_weight, np.zeros((len(penalties), folds, p)))
    kept, best, step = stack.weights.copy(), np.full(stack.weights.shape[:2], np.inf), np.zeros_like(stack.weights)
    open_ = np.ones(best.shape, bool)
    ridge = np.ones(p)
    ridge[0] = 0
    for stack.passes in range(1, STEPS + 1):
        found = _pass(rows, features, label, stack)
        for c, f in zip(*np.nonzero(open_), strict=True):
            w = stack.weights[c, f]
            loss = found[c, f, 0] + (ridge * w) @ w / (2 * penalties[c])
            if loss > best[c, f] * (1 + 1e-15):
                step[c, f] /= 2
                stack.weights[c, f] = kept[c, f] + step[c, f]
                open_[c, f] = np.abs(step[c, f]).max() > 1e-12
                continue
            best[c, f], kept[c, f] = loss, w
            slope = found[c, f, 1 : 1 + p] + ridge * w / penalties[c]
            curve = found[c, f, 1 + p :].reshape(p, p) + np.diag(ridge / penalties[c])
            step[c, f] = -np.linalg.lstsq(curve, slope, rcond=None)[0]
            if -(slope @ step[c, f]) <= DONE * max(loss, 1):
                open_[c, f] = False
            else:
                stack.weights[c, f] = w + step[c, f]
        if not open_.any():
            break
    stack.weights = kept
    return stack
