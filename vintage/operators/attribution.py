"""Shapley values of tree models from their node tables, and of any model from coalitions."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from vintage.functions.ordering import hash_rank
from vintage.operators.boosting import BoostedTreesModel
from vintage.operators.score import positive_probability
from vintage.sources.tables import cut_lineage, model_features, scratch_path

#: Coalitions that are all taken; models with more features sample as many.
ALL_COALITIONS = 2048
#: Rows that a task explains with the same tables, and rows of them in one look-up.
CHUNK_ROWS = 1 << 16
PASS_ROWS = 1 << 13
#: Levels of a subtree whose leaves are looked up together.
BUNDLE_LEVELS = 2
#: Numbers of leaf tables that are worked out at once.
TABLE_CELLS = 1 << 16
NODES = "tree int, node int, left int, right int, feature int, threshold double, categories int, cover double, value double, weight double"


def node_table(model: PipelineModel) -> DataFrame:
    """(tree, node, left, right, feature, threshold, cover, value, weight) of a fitted forest or boosted model.

    cover is the weight of the training rows that reached the node, in a boosted model their
    curvature. A forest's values are probabilities and its trees weigh the same; a boosted
    model's are log-odds.
    """
    last = model.stages[-1]
    spark = SparkSession.getActiveSession()
    if isinstance(last, BoostedTreesModel):
        return spark.createDataFrame(last.nodes(), NODES)
    path = scratch_path(spark, "trees")
    last.write().overwrite().save(path)
    weight = 1.0 / len(last.treeWeights)
    n = F.col("nodeData")
    stats = n["impurityStats"]
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"), n["split"]["numCategories"].alias("categories"),
        total.alias("cover"), (stats[1] / total).alias("value"), F.lit(weight).alias("weight"),
    )


@dataclass
class Bundle:
    """A subtree of few levels: its leaves as (features, low, high, shares, worth) and what tells them apart.

    tests are (feature, low, high); asked has, for each leaf and each of its features, the
    tests and the answers that a row in the leaf's interval (low, high] gives.
    """

    tests: list[tuple[int, float, float]]
    leaves: list[tuple]
    asked: list[list[tuple[tuple[int, bool], ...]]]


def mean_value(nodes: list[dict]) -> float:
    """Mean over all leaves by their share of the training rows."""
    by = {(r["tree"], r["node"]): r for r in nodes}
    mean = 0.0
    stack = [(r, 1.0) for r in nodes if r["node"] == 0]
    while stack:
        r, reach = stack.pop()
        if r["left"] < 0:
            mean += r["value"] * r["weight"] * reach
        elif r["categories"] != -1:
            raise ValueError("trees with categorical splits are not supported")
        else:
            stack += [(c, reach * c["cover"] / r["cover"]) for c in (by[r["tree"], r["left"]], by[r["tree"], r["right"]])]
    return mean


def tree_bundles(nodes: list[dict]) -> list[list[Bundle]]:
    """The leaves of each tree, those of one subtree of BUNDLE_LEVELS levels together.

    Splits of one feature along a path are one interval (low, high] and one share: the part
    of the training rows that the path keeps at them.
    """
    by = {(r["tree"], r["node"]): r for r in nodes}

    def children(r: dict) -> tuple[dict, dict]:
        return by[r["tree"], r["left"]], by[r["tree"], r["right"]]

    def narrowed(r: dict, path: dict) -> list[dict]:
        f, at = r["feature"], r["threshold"]
        a, b, z = path.get(f, (-np.inf, np.inf, 1.0))
        left, right = (c["cover"] / r["cover"] for c in children(r))
        return [{**path, f: (a, min(b, at), z * left)}, {**path, f: (max(a, at), b, z * right)}]

    def fill(bundle: Bundle, r: dict, path: dict, asked: dict) -> None:
        if r["left"] < 0:
            own = sorted(path)
            bundle.leaves.append((np.array(own, int), *(np.array([path[f][k] for f in own]) for k in range(3)), r["value"] * r["weight"]))
            bundle.asked.append([asked[f] for f in own])
            return
        f, test = r["feature"], len(bundle.tests)
        bundle.tests.append((f, -np.inf, r["threshold"]))
        for c, narrow, answer in zip(children(r), narrowed(r, path), (True, False), strict=True):
            fill(bundle, c, narrow, {**asked, f: (*asked.get(f, ()), (test, answer))})

    out = []
    for root in (r for r in nodes if r["node"] == 0):
        seen = [root]
        for r in seen:
            seen += children(r) if r["left"] >= 0 else ()
        height = {}
        for r in reversed(seen):
            height[r["node"]] = 1 + max(height[r["left"]], height[r["right"]]) if r["left"] >= 0 else 0
        bundles, stack = [], [(root, {})]
        while stack:
            r, path = stack.pop()
            if height[r["node"]] > BUNDLE_LEVELS:
                stack += zip(children(r), narrowed(r, path), strict=True)
                continue
            own = sorted(path)
            bundles.append(Bundle([(f, *path[f][:2]) for f in own], [], []))
            fill(bundles[-1], r, path, {f: ((k, True),) for k, f in enumerate(own)})
        out.append(bundles)
    return out


@cache
def _quadrature(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre points and weights of the integral from 0 to 1."""
    points, weights = np.polynomial.legendre.leggauss(n)
    return (points + 1) / 2, weights / 2


def shapley_parts(inside: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Path-dependent Shapley values (k, ...) of leaves of worth 1 and k features, for rows that are inside or not.

    Such a leaf is the game whose worth is, for each feature, 1 or 0 where the feature is
    known (the row lies in the interval or not) and the share where it is not. The weight of
    coalitions of s others, s! (k - 1 - s)! / k!, is the integral of u^s (1 - u)^(k - 1 - s),
    so a feature's part is the integral of the product of share * (1 - u) + inside * u over
    the others: a polynomial of degree k - 1, which Gauss-Legendre quadrature of k / 2 points
    gives exactly.
    """
    k = len(inside)
    total = np.zeros(np.broadcast_shapes(inside.shape, share.shape))
    for u, weight in zip(*_quadrature(k // 2 + 1), strict=True):
        terms = share * (1 - u) + inside * u
        before, after = np.ones_like(terms), np.ones_like(terms)
        for j in range(1, k):
            np.multiply(before[j - 1], terms[j - 1], out=before[j])
            np.multiply(after[k - j], terms[k - j], out=after[k - 1 - j])
        total += weight * before * after
    return (inside - share) * total


def add_leaf(x: np.ndarray, leaf: tuple, phi: np.ndarray, value: np.ndarray) -> None:
    """Add the parts of one leaf to phi (features, rows) and value (rows), for x (features, rows)."""
    features, low, high, share, worth = leaf
    if not len(features):
        value += worth
        return
    inside = ((x[features] > low[:, None]) & (x[features] <= high[:, None])).astype(float)
    value += worth * inside.prod(0)
    phi[features] += worth * shapley_parts(inside, share[:, None])


def _bits(k: int) -> np.ndarray:
    """(k, 2^k): the answers that each number stands for."""
    return (np.arange(1 << k) >> np.arange(k)[:, None] & 1).astype(bool)


def _leaf_tables(leaves: list[tuple]) -> list[np.ndarray]:
    """For each leaf (k, 2^k): its features' parts for every set of them that a row is inside of."""
    out: list = [None] * len(leaves)
    sizes: dict[int, list[int]] = {}
    for n, leaf in enumerate(leaves):
        sizes.setdefault(len(leaf[0]), []).append(n)
    for k, all_ in sizes.items():
        inside = _bits(k).astype(float)[:, None, :]
        step = max(1, TABLE_CELLS // max(1, k << k))
        for some in (all_[at : at + step] for at in range(0, len(all_), step)):
            share = np.array([leaves[n][3] for n in some]).reshape(len(some), k).T[:, :, None]
            worth = np.array([leaves[n][4] for n in some])[:, None]
            parts = worth * shapley_parts(inside, share)
            for at, n in enumerate(some):
                out[n] = parts[:, at]
    return out


def shapley_of_trees(x: np.ndarray, trees: list[list[Bundle]]) -> tuple[np.ndarray, np.ndarray]:
    """Path-dependent Shapley values (rows, features) and values (rows) of a sum of trees.

    What a bundle adds depends only on the answers to its tests. With more rows than sets of
    answers these are worked out once, and each row looks up its own; else, and for rows
    with values that are not finite, each leaf is worked out for each row.
    """
    whole = np.isfinite(x).all(1)
    n, d = int(whole.sum()), x.shape[1]
    phi, value = np.zeros((d, len(x))), np.zeros(len(x))
    odd, plain = np.ascontiguousarray(x[~whole].T), np.ascontiguousarray(x[whole].T)
    odd_phi, odd_value = np.zeros(odd.shape), np.zeros(len(x) - n)
    own_phi, own_value = np.zeros((d + 1, n)), np.zeros(n)

    ends: list[set] = [set() for _ in range(d)]
    for f, low, high in (t for bundles in trees for b in bundles for t in b.tests):
        ends[f].update((low, high))
    cuts = [np.array(sorted(e - {-np.inf, np.inf})) for e in ends]
    kind = np.min_scalar_type(max((len(c) for c in cuts), default=0) + 1)
    bins = [np.searchsorted(c, v).astype(kind) for c, v in zip(cuts, plain, strict=True)]

    def span(f: int, low: float, high: float) -> tuple:
        """The first bin of (low, high] and how many follow; a bin that no row has if it is empty."""
        top = len(cuts[f])
        first = 0 if low == -np.inf else int(np.searchsorted(cuts[f], low)) + 1
        last = top if high == np.inf else int(np.searchsorted(cuts[f], high))
        return (kind.type(first), kind.type(last - first)) if first <= last else (kind.type(top + 1), kind.type(0))

    for bundles in trees:
        if len(odd_value):
            for leaf in (leaf for b in bundles for leaf in b.leaves):
                add_leaf(odd, leaf, odd_phi, odd_value)
        known = [b for b in bundles if 1 << len(b.tests) < n]
        for leaf in (leaf for b in bundles if 1 << len(b.tests) >= n for leaf in b.leaves):
            add_leaf(plain, leaf, own_phi, own_value)
        tables = iter(_leaf_tables([leaf for b in known for leaf in b.leaves]))
        for b in known:
            t = len(b.tests)
            answers = _bits(t)
            features = sorted({int(f) for leaf in b.leaves for f in leaf[0]})
            row = {f: k for k, f in enumerate(features)}
            sums = np.zeros((len(features) + 1, 1 << t))
            for leaf, asked, parts in zip(b.leaves, b.asked, tables):
                inside = np.zeros(1 << t, int)
                for k, tests in enumerate(asked):
                    inside |= np.logical_and.reduce([answers[i] if yes else ~answers[i] for i, yes in tests]).astype(int) << k
                for f, part in zip(leaf[0], parts, strict=True):
                    sums[row[f]] += part[inside]
                sums[-1] += leaf[4] * (inside == (1 << len(asked)) - 1)
            spans = [(f, *span(f, low, high)) for f, low, high in b.tests]
            wide = np.min_scalar_type(1 << t)
            for at in range(0, n, PASS_ROWS):
                part = slice(at, at + PASS_ROWS)
                place = np.zeros(len(own_value[part]), wide)
                for k, (f, first, more) in enumerate(spans):
                    place |= (bins[f][part] - first <= more).astype(wide) << wide.type(k)
                place = place.astype(np.intp)
                for f, line in zip((*features, d), sums, strict=True):
                    own_phi[f, part] += line.take(place, mode="clip")
    phi[:, whole], value[whole] = own_phi[:d], own_phi[d] + own_value
    phi[:, ~whole], value[~whole] = odd_phi, odd_value
    return phi.T, value


def tree_attribution(model: PipelineModel, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Path-dependent Shapley values of a forest (probability) or boosted model (log-odds).

    key..., feature, phi, base, value, in the form of permutation_attribution; the parts of a
    row add up to value - base exactly. The node table, as large as the model that the driver
    holds anyway, goes to the tasks; no other row than those of df is scored. The rows are
    dealt to all cores, as a row costs a look-up for every few leaves of the model, and a
    task works out what it looks up once for CHUNK_ROWS rows.
    """
    features = model_features(model)
    nodes = [r.asDict() for r in node_table(model).collect()]
    base = mean_value(nodes)
    for stage in model.stages:
        if isinstance(stage, SQLTransformer):
            df = stage.transform(df)
    keyed = df.select(*key, *[F.col(c).cast("double").alias(f"_x{k}") for k, c in enumerate(features)])
    schema = StructType([*keyed.select(*key).schema.fields, StructField("_phi", ArrayType(DoubleType())), StructField("value", DoubleType())])
    width = len(key)

    def explained(held: list[pa.RecordBatch], trees: list[list[Bundle]]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        x = np.stack([rows.column(width + k).to_numpy() for k in range(len(features))], 1)
        phi, value = shapley_of_trees(x, trees)
        starts = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(features))
        lists = pa.ListArray.from_arrays(starts, pa.array(np.ascontiguousarray(phi).ravel()))
        found = pa.table([*(rows.column(k) for k in range(width)), lists, pa.array(value)], names=[*rows.schema.names[:width], "_phi", "value"])
        yield from found.to_batches(max_chunksize=PASS_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, held = None, []
        for b in batches:
            trees = trees or tree_bundles(nodes)
            held.append(b)
            if sum(len(h) for h in held) >= CHUNK_ROWS:
                yield from explained(held, trees)
                held = []
        if held:
            yield from explained(held, trees)

    names = F.array(*map(F.lit, features))
    dealt = keyed.repartition(df.sparkSession.sparkContext.defaultParallelism)
    found = dealt.mapInArrow(run, schema).select(*key, "value", F.posexplode("_phi").alias("_f", "phi"))
    return found.select(*key, F.get(names, F.col("_f")).alias("feature"), "phi", F.lit(float(base)).alias("base"), "value")


def coalitions(d: int, most: int = ALL_COALITIONS, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Coalitions (as 0/1 rows) of 1 to d - 1 features with their Shapley kernel weights; all, or drawn in pairs."""
    sizes = np.arange(1, d)
    mass = (d - 1) / (sizes * (d - sizes))
    if 2**d - 2 <= most:
        z = np.array(list(itertools.product((0, 1), repeat=d)))[1:-1]
        size = z.sum(1)
        return z, (d - 1) / (np.array([math.comb(d, s) for s in size]) * size * (d - size))
    rng = random.Random(seed)
    drawn: dict[tuple, int] = {}
    for _ in range(most // 2):
        size = rng.choices(sizes.tolist(), mass.tolist())[0]
        own = set(rng.sample(range(d), size))
        for side in (own, set(range(d)) - own):
            row = tuple(int(j in side) for j in range(d))
            drawn[row] = drawn.get(row, 0) + 1
    return np.array(list(drawn)), np.array(list(drawn.values()), float)


def coalition_solver(z: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The (d, m + 2) matrix that turns a row's worths (none, each coalition, all) into its Shapley values.

    Weighted least squares under the constraint that the values add up to all - none: the
    last feature is eliminated, and as coalitions and weights are those of every row, so
    are the normal equations' inverse and this matrix.
    """
    m, d = z.shape
    if d == 1:
        return np.array([[-1.0, 1.0]])
    x = z[:, :-1] - z[:, -1:]
    solve = np.linalg.solve(x.T @ (x * weight[:, None]), (x * weight[:, None]).T)
    # y = f_c - f_none - z_last * (f_all - f_none)
    worth = np.zeros((m, m + 2))
    worth[:, 1:-1] = np.eye(m)
    worth[:, 0] = -1 + z[:, -1]
    worth[:, -1] = -z[:, -1]
    part = solve @ worth
    rest = -part.sum(0)
    rest[0] -= 1
    rest[-1] += 1
    return np.vstack([part, rest])


def coalition_attribution(model: PipelineModel, df: DataFrame, background: DataFrame, key: Sequence[str],
                          draws: int = 20, most: int = ALL_COALITIONS, seed: int = 42, output: str = "probability") -> DataFrame:
    """Shapley values of any model by weighted least squares: key..., feature, phi, base, value.

    A coalition's worth is the mean score of rows that have its features from the explained
    row and the others from ``draws`` background rows, the same ones for all rows and
    coalitions. The scores are weighted and added up in one aggregation per row. Per row the
    parts add up to value - base. With all coalitions (most is 2^d - 2 or more) the only
    error is that of the drawn background.
    """
    if output not in ("probability", "log_odds"):
        raise ValueError(f"unknown output: {output}")
    features = model_features(model)
    for stage in model.stages:
        if isinstance(stage, SQLTransformer):
            df, background = stage.transform(df), stage.transform(background)
    d = len(features)
    z, weight = coalitions(d, most, seed) if d > 1 else (np.zeros((0, 1), int), np.zeros(0))
    solver = coalition_solver(z, weight)
    vector = F.array(*[F.col(c).cast("double") for c in features])
    numbered = hash_rank(background.select(*features), features, seed=seed, out="_n").where(F.col("_n") <= draws)
    pool = cut_lineage(numbered.select((F.col("_n") - 1).cast("int").alias("_slot"), vector.alias("_b")))
    size = pool.count()
    if size == 0:
        raise ValueError("the background is empty")
    spark = df.sparkSession
    members = np.vstack([np.zeros((1, d), int), z, np.ones((1, d), int)])
    table = [(k, [bool(v) for v in row], [float(v) for v in solver[:, k]]) for k, row in enumerate(members)]
    chosen = spark.createDataFrame(table, "_c int, _in array<boolean>, _w array<double>")
    last = len(members) - 1
    grid = df.select(*key, vector.alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(last))).alias("_c"))
    grid = grid.join(F.broadcast(chosen), "_c")
    grid = grid.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(size - 1)))).join(F.broadcast(pool), "_slot")
    hybrid = F.zip_with(F.zip_with("_in", "_x", lambda i, x: F.when(i, x)), "_b", lambda own, other: F.coalesce(own, other))
    ready = grid.select(*key, "_c", "_w", array_to_vector(hybrid).alias("features"))
    after = next(k for k, s in enumerate(model.stages) if isinstance(s, VectorAssembler)) + 1
    p = positive_probability()
    if output == "log_odds":
        tiny = F.lit(1e-300)
        p = F.log(F.greatest(p, tiny)) - F.log(F.greatest(1 - p, tiny))
    scored = PipelineModel(stages=model.stages[after:]).transform(ready).select(*key, "_c", "_w", (p / size).alias("_f"))
    parts = [F.sum(F.get("_w", k) * F.col("_f")).alias(f"_phi{k}") for k in range(d)]
    ends = [F.sum(F.when(F.col("_c") == at, F.col("_f"))).alias(name) for at, name in ((0, "base"), (last, "value"))]
    found = scored.groupBy(*key).agg(*parts, *ends)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_phi{k}").alias("phi")) for k, c in enumerate(features)])
    return found.select(*key, F.inline(cells), "base", "value")
