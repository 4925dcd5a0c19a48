"""Second-order gradient boosting on binned features: gradient histograms added up by Spark, one pass per tree level."""

from __future__ import annotations

import json
import math
import random
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.sources.tables import drop_scratch, scratch_path

#: Rows of a block; a block is one row of the table that the passes read.
BLOCK_ROWS = 1 << 15
#: Trees after which margins are written anew; passes apply the trees since then themselves.
REFRESH = 10
#: Up to so many tasks' histograms are added up where the tree grows; those of more meet in tasks by feature.
DIRECT_TASKS = 8
#: Quantile error of the bins, as one part in so many.
ACCURACY = 10_000
#: A split gains more than rounding.
LEAST_GAIN = 1e-9
STATE = "block string, size int, bins binary, label binary, weight binary, heaviest double, margin binary"
SPLIT_NAMES = ["feature", "node", "bin", "gain", "left_g", "left_h", "g", "h"]
SPLIT_TYPES = [pa.int32()] * 3 + [pa.float64()] + [pa.int64()] * 4


@dataclass
class Tree:
    """Nodes in order of making, the root first; left is -1 at leaves. Rows with x <= threshold (bin <= cut) go left."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def leaf(self, cover: float, value: float) -> int:
        for column, v in ((self.feature, 0), (self.cut, 0), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.gain, 0.0), (self.cover, cover), (self.value, value)):
            column.append(v)
        return len(self.left) - 1

    def descend(self, x: np.ndarray, at: Sequence[float]) -> np.ndarray:
        """The leaf of each row of x, whose columns are compared with ``at`` of the nodes."""
        inner = np.asarray(self.left) >= 0
        own = np.arange(len(inner))
        # Left and right child of each node in turn; a leaf is its own child, so rows wait there.
        child = np.where(inner, (self.left, self.right), own).T.ravel()
        depth = np.zeros(len(own), int)
        for n in own[inner]:
            depth[[self.left[n], self.right[n]]] = depth[n] + 1
        feature, at = np.asarray(self.feature), np.asarray(at)
        flat, first, node = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1], np.zeros(len(x), np.int64)
        for _ in range(depth.max(initial=0)):
            right = ~(flat.take(first + feature.take(node)) <= at.take(node))
            node = child.take(2 * node + right)
        return node


def quantile_cuts(df: DataFrame, vector: str, width: int, bins: int) -> list[np.ndarray]:
    """Ascending upper bounds of all bins but the last, per feature; every feature in one aggregation."""
    probabilities = [k / bins for k in range(bins)]
    found = df.agg(*[F.percentile_approx(F.get(vector, k), probabilities, ACCURACY).alias(f"_{k}") for k in range(width)]).head()
    return [np.unique(np.array(v or [], float)) for v in found]


def _blocks(df: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Blocks of binned rows: x (array), label, weight -> STATE, with margins of zero."""
    kind = np.uint8 if max(map(len, cuts), default=0) < 256 else np.uint16

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0

        def block():
            x, y, w = (np.concatenate(v) for v in zip(*held, strict=True))
            # Named by what it holds: a task that runs again draws the same rows.
            name = f"{zlib.crc32(x.tobytes()):08x}{zlib.crc32(y.tobytes()):08x}-{number}"
            return pa.record_batch({"block": [name], "size": pa.array([len(y)], pa.int32()), "bins": [x.tobytes()], "label": [y.tobytes()], "weight": [w.tobytes()], "heaviest": [float(w.max())], "margin": [np.zeros(len(y)).tobytes()]})

        number = 0
        for b in batches:
            flat = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(cuts))
            x = np.stack([np.searchsorted(c, flat[:, k]) for k, c in enumerate(cuts)], 1).astype(kind)
            held.append((x, b.column(1).to_numpy(zero_copy_only=False).astype(np.uint8), b.column(2).to_numpy(zero_copy_only=False)))
            count += b.num_rows
            if count >= BLOCK_ROWS:
                yield block()
                held, count, number = [], 0, number + 1
        if count:
            yield block()

    return df.mapInArrow(pack, STATE)


@dataclass(frozen=True)
class Options:
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    gamma: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    ridge: float = 1.0
    max_bins: int = 256
    seed: int = 42

    def value(self, g: float, h: float) -> float:
        return -self.learning_rate * g / (h + self.ridge) if h + self.ridge > 0 else 0.0


@dataclass
class Pass:
    """What a task needs to bring a block to the present: the trees since its margins, and the open tree."""

    cuts: list[np.ndarray]
    trees: list[Tree]
    tree: Tree
    open: list[int]
    chosen: list[int]
    scale: float
    draw: str
    subsample: float

    def rows(self, b: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        kind = np.uint8 if max(map(len, self.cuts), default=0) < 256 else np.uint16
        x = np.frombuffer(b["bins"], kind).reshape(b["size"], len(self.cuts))
        margin = np.frombuffer(b["margin"]).copy()
        for t in self.trees:
            margin += np.asarray(t.value)[t.descend(x, t.cut)]
        return x, np.frombuffer(b["label"], np.uint8), np.frombuffer(b["weight"]), margin

    def histograms(self, b: dict) -> Iterator[tuple[int, np.ndarray]]:
        """(feature, (open nodes, bins, 2)) of a block, in whole units of 1 / scale."""
        x, y, w, margin = self.rows(b)
        p = 0.5 * (1 + np.tanh(margin / 2))
        place = np.full(len(self.tree.left), -1)
        place[self.open] = np.arange(len(self.open))
        node = place[self.tree.descend(x, self.tree.cut)]
        used = node >= 0
        if self.subsample < 1:
            seed = zlib.crc32(f"{self.draw}/{b['block']}".encode())
            used &= np.random.default_rng(seed).random(b["size"]) < self.subsample
        x, node = x[used], node[used]
        g = np.rint((w * (p - y))[used] * self.scale)
        h = np.rint((w * p * (1 - p))[used] * self.scale)
        for f in self.chosen:
            bins = len(self.cuts[f]) + 1
            slot = node * bins + x[:, f]
            size = len(self.open) * bins
            both = np.stack([np.bincount(slot, v, size) for v in (g, h)], 1)
            yield f, both.astype(np.int64).reshape(len(self.open), bins, 2)


def best_splits(total: np.ndarray, scale: float, ridge: float, least: float) -> list[tuple]:
    """For each node of a feature's histogram (bin, gain, left sums, all sums); ties go to the lowest bin."""
    left = total.cumsum(1)
    whole = left[:, -1:, :]
    right = whole - left

    def worth(s):
        g, h = s[..., 0] / scale, s[..., 1] / scale
        return np.divide(g * g, h + ridge, out=np.zeros(g.shape), where=h + ridge > 0)

    gain = worth(left) + worth(right) - worth(whole)
    floor = max(least * scale, 1)
    gain[(left[..., 1] < floor) | (right[..., 1] < floor)] = -np.inf
    at = gain.argmax(1)
    return [(int(k), float(gain[n, k]), *map(int, left[n, k]), *map(int, whole[n, 0])) for n, k in enumerate(at)]


def add_up(blocks: Iterable[dict], todo: Pass) -> dict[int, np.ndarray]:
    total: dict[int, np.ndarray] = {}
    for b in blocks:
        for f, h in todo.histograms(b):
            total[f] = total[f] + h if f in total else h
    return total


def splits_of(total: dict[int, np.ndarray], todo: Pass, options: Options) -> Iterator[tuple]:
    for f, h in total.items():
        for n, line in enumerate(best_splits(h, todo.scale, options.ridge, options.min_child_weight)):
            yield f, todo.open[n], *line


def level_of_table(state: DataFrame, tasks: int, todo: Pass, options: Options) -> Iterable[tuple]:
    """Best split of each open node by each feature, and its sums (SPLIT_NAMES): one pass over the blocks.

    Tasks add up their blocks' histograms. Those of one feature meet in one task, which
    returns a line per node, so the driver gets no histogram; with DIRECT_TASKS tasks or
    fewer it gets theirs instead, which spares a shuffle. Both give the same splits.
    """

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, h in add_up((row for b in batches for row in b.to_pylist()), todo).items():
            yield pa.record_batch({"feature": pa.array([f], pa.int32()), "sums": [h.tobytes()]})

    def merged(parts: Iterable[tuple[int, bytes]]) -> Iterator[tuple]:
        total: dict[int, np.ndarray] = {}
        for f, blob in parts:
            h = np.frombuffer(blob, np.int64).reshape(len(todo.open), -1, 2)
            total[f] = total[f] + h if f in total else h
        return splits_of(total, todo, options)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = list(merged(pair for b in batches for pair in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)))
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines, strict=True), SPLIT_TYPES, strict=True)], names=SPLIT_NAMES)

    sums = state.mapInArrow(sums_of, "feature int, sums binary")
    if tasks <= DIRECT_TASKS:
        return merged(map(tuple, sums.collect()))
    schema = ", ".join(f"{n} {t}" for n, t in zip(SPLIT_NAMES, ["int"] * 3 + ["double"] + ["long"] * 4, strict=True))
    return map(tuple, sums.repartition(min(tasks, len(todo.chosen)), "feature").mapInArrow(choose, schema).collect())


def grow(level_of: Callable[[Pass, Options], Iterable[tuple]], cuts: list[np.ndarray], since: list[Tree],
         scale: float, options: Options, k: int) -> Tree:
    """Tree number k, level by level."""
    drawn = random.Random(f"{options.seed}/{k}").sample(range(len(cuts)), max(1, round(len(cuts) * options.colsample_bytree))) if cuts else []
    tree = Tree()
    tree.leaf(0.0, 0.0)
    level = [0]
    for _ in range(options.max_depth):
        if not level or not drawn:
            break
        todo = Pass(cuts, since, tree, level, sorted(drawn), scale, f"{options.seed}/{k}", options.subsample)
        found: dict[int, list[dict]] = {}
        for line in level_of(todo, options):
            found.setdefault(line[1], []).append(dict(zip(SPLIT_NAMES, line, strict=True)))
        level = []
        for node, lines in sorted(found.items()):
            best = min(lines, key=lambda r: (-r["gain"], r["feature"]))
            if node == 0:
                tree.cover[0] = best["h"] / scale
                tree.value[0] = options.value(best["g"] / scale, tree.cover[0])
            if best["gain"] < max(options.gamma, LEAST_GAIN):
                continue
            tree.feature[node], tree.cut[node], tree.gain[node] = best["feature"], best["bin"], best["gain"]
            tree.threshold[node] = float(cuts[best["feature"]][best["bin"]])
            sides = (best["left_g"], best["left_h"]), (best["g"] - best["left_g"], best["h"] - best["left_h"])
            tree.left[node], tree.right[node] = (tree.leaf(h / scale, options.value(g / scale, h / scale)) for g, h in sides)
            level += [tree.left[node], tree.right[node]]
    return tree


def grow_in_task(state: DataFrame, cuts: list[np.ndarray], scale: float, options: Options) -> list[Tree]:
    """All trees of a table of one block's rows at most, grown by one task from the same sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [row for b in batches for row in b.to_pylist()]
        trees: list[Tree] = []
        for k in range(options.n_estimators):
            since = trees[-1:]
            for b in blocks:
                b["margin"] = Pass(cuts, since, Tree(), [], [], scale, "", 1.0).rows(b)[3].tobytes()
            trees.append(grow(lambda todo, o: splits_of(add_up(blocks, todo), todo, o), cuts, [], scale, options, k))
        yield pa.record_batch({"trees": [json.dumps([asdict(t) for t in trees])]})

    return [Tree(**t) for t in json.loads(state.coalesce(1).mapInArrow(run, "trees string").head()[0])]


def _refresh(state: DataFrame, todo: Pass) -> DataFrame:
    """The blocks with the margins after all trees so far."""
    names = [f.split()[0] for f in STATE.split(", ")]

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, row in enumerate(b.to_pylist()):
                one = b.slice(n, 1)
                margin = pa.array([todo.rows(row)[3].tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([*[one.column(k) for k in range(len(names) - 1)], margin], names=names)

    return state.mapInArrow(advance, STATE)


def _written(blocks: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(blocks.sparkSession, "blocks")
    blocks.write.parquet(path)
    return blocks.sparkSession.read.schema(STATE).parquet(path).persist(), path


class BoostedTrees(Estimator):
    """Boosted trees for a 0/1 label by log loss, with the first and second derivative of each row.

    A node's worth is G^2 / (H + ridge) over its rows' gradients and curvatures; a split is
    made where both sides hold a curvature of ``min_child_weight`` and their worth exceeds
    the node's by ``gamma`` or more. A leaf moves the margin by -learning_rate * G / (H + ridge).
    Each tree sees a share ``colsample_bytree`` of the features and ``subsample`` of the rows.
    Candidate thresholds are ``max_bins`` quantiles of each feature, so features of fewer
    values that are not rare have all of them. Features must not be NULL or NaN.

    Rows become blocks of binned values in a table of the shared folder, one byte a value,
    beside their margins; every tree level is one pass over it, with one shuffle of histograms
    (tasks x features x open nodes x bins). Sums are whole numbers in units that follow from
    the total weight, so they and the trees do not depend on the order or repetition of tasks.
    A table of BLOCK_ROWS rows or fewer is fitted by one task from the same sums.
    An empty table gives a model without trees; labels of one class give trees of one leaf.
    """

    def __init__(self, featuresCol: str = "features", labelCol: str = "label", weightCol: str = "weight", **options):
        super().__init__()
        self.columns = (featuresCol, labelCol, weightCol)
        self.options = Options(**options)

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        vector, label, weight = self.columns
        options = self.options
        rows = dataset.select(vector_to_array(vector).alias("x"), F.col(label).cast("int").alias("y"), F.col(weight).cast("double").alias("w"))
        found = rows.agg(F.max(F.size("x")), F.count("*")).head()
        width = found[0] or 0
        cuts = quantile_cuts(rows, "x", width, options.max_bins) if width else []
        blocks = _blocks(rows, cuts)
        if found[1] > BLOCK_ROWS:
            # A file for each block, so that the passes use all cores however few tasks made the blocks.
            blocks = blocks.repartition(-(-found[1] // BLOCK_ROWS))
        state, path = _written(blocks)
        try:
            total = state.agg(F.sum("size"), F.max("size"), F.max("heaviest")).head()
            count, largest, heaviest = total[0] or 0, total[1] or 1, total[2] or 1.0
            # Block sums stay exact as doubles, totals as 64-bit integers.
            scale = 2.0 ** math.floor(min(52 - math.log2(largest * heaviest), 62 - math.log2(max(count, 1) * heaviest)))
            if count == 0:
                trees = []
            elif count <= BLOCK_ROWS:
                trees = grow_in_task(state, cuts, scale, options)
            else:
                tasks = state.rdd.getNumPartitions()
                trees, done = [], 0
                for k in range(options.n_estimators):
                    if k - done >= REFRESH:
                        after, at = _written(_refresh(state, Pass(cuts, trees[done:], Tree(), [], [], scale, "", 1.0)))
                        state.unpersist()
                        drop_scratch(after.sparkSession, path)
                        state, path, done = after, at, k
                    trees.append(grow(lambda todo, o: level_of_table(state, tasks, todo, o), cuts, trees[done:], scale, options, k))
        finally:
            state.unpersist()
            drop_scratch(state.sparkSession, path)
        return BoostedTreesModel(featuresCol=vector, trees=json.dumps([asdict(t) for t in trees]))


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees: adds rawPrediction, probability and prediction to rows with a features vector."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", typeConverter=TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "nodes of all trees as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", trees: str = "[]"):
        super().__init__()
        self._setDefault(featuresCol="features", trees="[]")
        self._set(**self._input_kwargs)

    def fitted(self) -> list[Tree]:
        return [Tree(**t) for t in json.loads(self.getOrDefault(self.trees))]

    def nodes(self) -> list[dict]:
        """A line per node, in the form of attribution.node_table."""
        return [
            {"tree": k, "node": n, "left": t.left[n], "right": t.right[n], "feature": t.feature[n] if t.left[n] >= 0 else -1, "threshold": t.threshold[n],
             "categories": -1, "cover": t.cover[n], "value": t.value[n], "weight": 1.0, "gain": t.gain[n]}
            for k, t in enumerate(self.fitted()) for n in range(len(t.left))
        ]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.fitted()

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            rows = np.stack(x.to_numpy())
            out = np.zeros(len(x))
            for t in trees:
                out += np.asarray(t.value)[t.descend(rows, t.threshold)]
            return pd.Series(out)

        taken = {c.lower() for c in dataset.columns}
        own = "_margin"
        while own in taken:
            own += "_"
        p = 1 / (1 + F.exp(-F.col(own)))
        return (
            dataset.withColumn(own, margin(vector_to_array(self.getOrDefault(self.featuresCol))))
            .withColumn("rawPrediction", array_to_vector(F.array(-F.col(own), F.col(own))))
            .withColumn("probability", array_to_vector(F.array(1 - p, p)))
            .withColumn("prediction", (F.col(own) > 0).cast("double"))
            .drop(own)
        )


def paths(spark: SparkSession, model: BoostedTreesModel, features: Sequence[str]) -> DataFrame:
    """The trees as a table: tree, path from the root (L and R), feature, threshold, gain, cover, value.

    Leaves have no feature, threshold or gain. cover is the curvature of the training rows.
    """
    lines = []
    for k, t in enumerate(model.fitted()):
        stack = [(0, "")]
        while stack:
            n, path = stack.pop()
            inner = t.left[n] >= 0
            split = (features[t.feature[n]], t.threshold[n], t.gain[n]) if inner else (None, None, None)
            lines.append((k, path, *split, t.cover[n], t.value[n]))
            if inner:
                stack += [(t.left[n], path + "L"), (t.right[n], path + "R")]
    return spark.createDataFrame(lines, "tree int, path string, feature string, threshold double, gain double, cover double, value double")


def gain_importance(spark: SparkSession, model: BoostedTreesModel, features: Sequence[str]) -> DataFrame:
    """Feature, splits, total and mean gain over all trees, and the share of the total; features without a split have zeros."""
    inner = paths(spark, model, features).where("feature IS NOT NULL")
    found = inner.groupBy("feature").agg(F.count("*").alias("splits"), F.sum("gain").alias("total_gain"))
    every = spark.createDataFrame([(f,) for f in features], "feature string").join(found, "feature", "left").na.fill(0)
    whole = found.agg(F.sum("total_gain").alias("_all"))
    return every.crossJoin(F.broadcast(whole)).select(
        "feature", "splits", "total_gain", F.coalesce(F.try_divide("total_gain", "splits"), F.lit(0.0)).alias("mean_gain"),
        F.coalesce(F.try_divide("total_gain", "_all"), F.lit(0.0)).alias("share"),
    )
