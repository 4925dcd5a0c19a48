"""Hard negatives by Fagin's threshold algorithm over integer vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, batch_of, cut, discard, partitions

#: Bytes of anchors (with their windows) that are sent to the executors at once.
ANCHOR_BYTES = 16 << 20
#: Vectors whose lists are sorted together in a task.
BLOCK = 1 << 14
#: Entries of each list that the steps of sorted access read up to; the last step reads what is left.
DEPTHS = (16, 128)

#: Scores beyond what a long holds are given as this.
MOST = 2**63 - 1
_SCORED = "anchor long, window int, vec_id long, score long"


def clean_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v) of rows that take part; v holds floor(256 x) of each component as a whole double."""
    x = F.col(vector).cast("array<double>")
    finite = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * 256).cast("double"))
    known = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull())
    return known.where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"))


def exact_products(rows: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Integer inner products of whole doubles: by doubles where every partial sum is exact, else by Python's integers."""
    if not rows.size:
        return np.zeros(len(rows), np.int64)
    if float(np.abs(a).sum()) * float(np.abs(rows).max()) < 2**53:
        return (rows @ a).astype(np.int64)
    whole = [int(c) for c in a]
    return np.array([sum(int(c) * w for c, w in zip(r, whole, strict=True)) for r in rows], object)


class Lists:
    """A block of vectors of one length with, for each dimension, its rows in ascending order of the component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32) if vectors.size else np.empty(vectors.shape, np.int32)

    def search(self, a: np.ndarray, allowed: np.ndarray, windows: list[tuple[float, float, int]], kept: list[list[tuple[int, int]]]) -> None:
        """The best rows of each window by the threshold algorithm; kept is updated in place.

        windows: (least, most, k); kept: for each the (score, vec_id) pairs so far, best
        first, also of earlier blocks. Lists are read from their high end where the anchor's
        component is positive and from their low end where it is negative; components of
        zero need no list. Every row met is scored at once from its whole vector. A row not
        yet met scores at most the threshold, the anchor's product with the last components
        read. A window is done once the threshold is strictly below its kth score (an
        equal score could win by its id) or below the window itself.
        """
        n = len(self.ids)
        used = np.flatnonzero(a)
        met = ~allowed
        done = 0
        for depth in (*[d for d in DEPTHS if d * len(used) < n], n):
            if depth < n:
                rows = np.concatenate([self.order[n - depth : n - done, used[a[used] > 0]].ravel(), self.order[done:depth, used[a[used] < 0]].ravel()])
                new = np.unique(rows[~met[rows]])
            else:
                new = np.flatnonzero(~met)
            met[new] = True
            done = depth
            score = exact_products(self.vectors[new], a) if len(new) < n else exact_products(self.vectors, a)
            for (least, most, k), best in zip(windows, kept, strict=True):
                floor = best[k - 1][0] if len(best) >= k else least
                good = np.flatnonzero((score >= max(least, floor)) & (score <= most))
                if len(good) > k:
                    cut_at = np.partition(score[good], len(good) - k)[len(good) - k]
                    good = good[score[good] >= cut_at]
                found = sorted([*best, *((int(score[g]), int(self.ids[new[g]])) for g in good)], key=lambda x: (-x[0], x[1]))
                best[:] = found[:k]
            if depth == n or met.all():
                return
            last = np.where(a[used] > 0, self.vectors[self.order[n - depth, used], used], self.vectors[self.order[depth - 1, used], used])
            threshold = sum(int(x) * int(y) for x, y in zip(last, a[used], strict=True))
            if all(threshold < (best[k - 1][0] if len(best) >= k else least) for (least, _, k), best in zip(windows, kept, strict=True)):
                return


def _searched(rows: DataFrame, anchors: list[dict], same: bool) -> DataFrame:
    """Each task's best rows (anchor, window, vec_id, score) for anchors with windows; same: of the anchor's label, else of others."""
    sent = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_SCORED)
        own = [{**x, "v": np.frombuffer(x["v"], np.float64), "kept": [[] for _ in x["windows"]]} for x in sent.value]
        held: list[pa.RecordBatch] = []
        size = 0

        def block() -> None:
            ids = np.concatenate([b.column(0).to_numpy() for b in held])
            labels = np.concatenate([b.column(1).to_numpy() for b in held])
            lengths = np.concatenate([b.column(2).value_lengths().to_numpy() for b in held])
            flat = np.concatenate([b.column(2).flatten().to_numpy() for b in held])
            ends = np.cumsum(lengths)
            for width in np.unique(lengths):
                at = np.flatnonzero(lengths == width)
                lists_of = {}
                vectors = flat[(ends[at] - width)[:, None] + np.arange(width)]
                groups = [(label, at[labels[at] == label]) for label in np.unique(labels[at])] if same else [(None, at)]
                for label, rows_ in groups:
                    lists_of[label] = Lists(ids[rows_], labels[rows_], vectors[np.searchsorted(at, rows_)])
                for x in own:
                    lists = lists_of.get(x["label"] if same else None)
                    if lists is None or len(x["v"]) != width:
                        continue
                    allowed = lists.ids != x["id"] if same else lists.labels != x["label"]
                    lists.search(x["v"], allowed, x["windows"], x["kept"])

        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= BLOCK:
                block()
                held, size = [], 0
        if size:
            block()
        for a in range(0, len(own), 1000):
            flat = [(x["at"], w, i, min(max(s, -MOST), MOST)) for x in own[a : a + 1000] for w, best in enumerate(x["kept"]) for s, i in best]
            yield batch_of(schema, dict(zip(("anchor", "window", "vec_id", "score"), zip(*flat, strict=True), strict=True)) if flat else {c: [] for c in ("anchor", "window", "vec_id", "score")})

    return rows.select("vec_id", "label", "v").mapInArrow(run, _SCORED)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each (anchor, window), with rank from 1."""
    order = F.struct((-F.col("score")).alias("down"), "vec_id")
    lists = found.groupBy("anchor", "window").agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("best"))
    return lists.select("anchor", "window", F.posexplode("best").alias("at", "one")).select(
        "anchor", "window", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.down")).alias("score")
    )


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, vector: str = "embedding") -> DataFrame:
    """Per anchor and positive, the first negatives whose score is least to most per cent of the positive's.

    vectors: vec_id, label, an array of numbers, any others; anchor: which rows are anchors, by F.col("vec_id") and F.col("label").
    Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    A score is the integer inner product of floor(256 x) with the anchor's; higher ones come
    first, ties by vec_id. Positives are the first other rows of the anchor's label, other
    meaning another vec_id; negatives have another label. Rows with a NULL id, label or
    vector, or any component that is NULL or not finite, take no part, and rows meet only
    those of their own length. Repeated rows count each, as anchors as well. Scores
    beyond 64 bits are given as the largest ones. Anchors without
    a positive, and positives without a negative, have no rows; so has an empty table.

    Anchors are a stated query set against all rows: they go to the executors in blocks of
    bounded bytes, and a task runs the threshold algorithm on its own vectors' lists,
    carrying its best from block to block. What tasks return is their best alone.
    """
    rows = cut(clean_vectors(vectors, vector))
    chosen = cut(rows.where(anchor).withColumn("at", F.monotonically_increasing_id()))
    width = chosen.agg(F.sum(F.size("v")), F.count("*")).first()
    blocks = partitions((width[0] or 0) * 8 + (width[1] or 0) * 512, ANCHOR_BYTES)
    block = F.pmod(F.xxhash64("at"), F.lit(blocks))
    found = []
    for number in range(blocks):
        own = chosen.where(block == number)
        sent = {r["at"]: {"at": r["at"], "id": r["vec_id"], "label": r["label"], "v": np.array(r["v"], np.float64).tobytes()} for r in own.toArrow().to_pylist()}
        wide = [{**x, "windows": [(-np.inf, np.inf, positives)]} for x in sent.values()]
        first = cut(_first(_searched(rows, wide, True), positives))
        for r in first.orderBy("anchor", "rank").toArrow().to_pylist():
            p = r["score"]
            sent[r["anchor"]].setdefault("windows", []).append((-(-least * p // 100), most * p // 100, negatives))
        wanted = [x for x in sent.values() if "windows" in x]
        best = _first(_searched(rows, wanted, False), negatives)
        scored = first.select("anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        named = own.select(F.col("at").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        joined = best.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(scored, ["anchor", "window"]).join(named, "anchor")
        found.append(cut(joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")))
        discard(first)
    out = found[0]
    return out if len(found) == 1 else rows.sparkSession.read.schema(out.schema).parquet(*[f._cut_path for f in found])


#: DuckDB's form; products of whole doubles are exact here.
ORACLE = """
WITH known AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM known a JOIN known b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""
