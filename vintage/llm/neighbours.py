"""Approximate nearest neighbours by a permutation index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, batch_of, cut, partitions

#: Pivots are this many times the root of the vectors, and at most MAX_PIVOTS: a sample, all that the index is fitted on.
ROOT_PIVOTS = 4
MAX_PIVOTS = 16384
#: Nearest pivots that post a vector or probe for it.
PREFIX = 48
#: Of n vectors the RERANK * n ** (2 / 3) nearest by footrule have their inner products taken.
RERANK = 3.0
#: Vectors of one inverted file, products with pivots at once, bytes of different query vectors that are broadcast at once, rows sent at once.
BLOCK = 16384
CELLS = 1 << 22
QUERY_BYTES = 1 << 25
PASS = 512

_CLASSES = "vec binary, ids array<long>"


def _valid(value: list | None, dim: int | None = None) -> np.ndarray | None:
    if not value or None in value or (dim is not None and len(value) != dim):
        return None
    x = np.array(value, np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def vector_classes(vectors: DataFrame, k: int) -> DataFrame:
    """(vec, ids): each different vector as doubles, with its k + 1 least ids.

    Equal vectors have equal scores and ties go to the smaller id, so no other member of a
    class can be among the k nearest of anything. Tasks shorten lists before the shuffle.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_CLASSES)
        for b in batches:
            found: dict[bytes, list[int]] = {}
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if i is not None and (x := _valid(v)) is not None:
                    found.setdefault((x + 0.0).tobytes(), []).append(i)
            yield batch_of(schema, {"vec": list(found), "ids": [sorted(set(i))[: k + 1] for i in found.values()]})

    least = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    return vectors.mapInArrow(gather, _CLASSES).groupBy("vec").agg(least.alias("ids"))


class PermutationIndex:
    """Pivots, and the order in which a vector sees them.

    A coordinate is appended that gives all indexed vectors the largest norm; the largest
    inner product is then the nearest vector, and pivots are ranked by it too.
    """

    def __init__(self, pivots: np.ndarray, top_norm: float):
        self.top = top_norm
        self.pivots = self._lifted(pivots)
        self.prefix = min(PREFIX, len(pivots))

    def _lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.top**2 - (x * x).sum(1)))
        return np.concatenate([x, rest[:, None]], 1)

    def nearest(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """The nearest pivots of each vector, in order."""
        lifted = np.concatenate([x, np.zeros((len(x), 1))], 1) if query else self._lifted(x)
        step, found = max(1, CELLS // len(self.pivots)), [np.empty((0, self.prefix), np.int64)]
        for start in range(0, len(x), step):
            far = -(lifted[start : start + step] @ self.pivots.T)
            few = np.sort(np.argpartition(far, self.prefix - 1, axis=1)[:, : self.prefix], axis=1)
            order = np.argsort(np.take_along_axis(far, few, 1), axis=1, kind="stable")
            found.append(np.take_along_axis(few, order, 1))
        return np.concatenate(found)

    def postings(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each pivot: the vectors that post it, and at which place."""
        near = self.nearest(x)
        order = np.argsort(near.ravel(), kind="stable")
        ends = np.cumsum(np.bincount(near.ravel(), minlength=len(self.pivots)))
        member, place = order // self.prefix, order % self.prefix
        return [(member[a:b], place[a:b].astype(np.int32)) for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def footrule(self, probes: np.ndarray, posts: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
        """Footrule distance of one query (its nearest pivots) to the n vectors of an inverted file, halved.

        Only the files of its own pivots are read. A pivot that only one side posts counts as
        if the other had it behind its last: both at places a and b then save
        a + b - 2 * prefix + |a - b|, twice the larger place less the prefix. What all share is left out.
        """
        acc = np.zeros(n, np.int32)
        for at, pivot in enumerate(probes):
            member, place = posts[pivot]
            acc[member] += np.maximum(place, np.int32(at)) - np.int32(self.prefix)
        return acc


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    pivots: int | None = None,
    rerank: float | None = None,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The k nearest found of each query by largest inner product.

    vectors: vec_id, embedding, any others; queries: rows of the same columns whose ids are
    ids of vectors (a query is no neighbour of itself). Vectors are posted in the inverted
    files of their PREFIX nearest pivots. Queries come in blocks that are broadcast, QUERY_BYTES
    of different vectors in expectation; each ranks every block of BLOCK vectors by
    footrule over the files of its own nearest pivots, and the nearest share (rerank) is
    ranked by its inner products in double precision. Pivots grow as the root of the
    vectors and files with it, so a query reads postings as the root of the table up to
    MAX_PIVOTS (in proportion beyond); the share falls as the third root. pivots, rerank:
    numbers of one's own instead; rerank 1 is exact.

    Vectors that are NULL, zero, or hold NULL or non-finite components take no part, as
    queries neither, nor do rows without an id, nor vectors of another length than most
    (of equally frequent lengths the larger one stays). Equal vectors are searched once.
    Repeated rows count once. Fewer candidates than k give all; an empty table gives none.
    Returns query_id, rank, vec_id, score; ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    table = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    classes = cut(vector_classes(table, k))
    lengths = classes.groupBy(F.octet_length("vec").alias("bytes")).count().orderBy(F.desc("count"), F.desc("bytes")).first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, n = lengths["bytes"], lengths["count"]
    pivots = pivots or min(MAX_PIVOTS, max(PREFIX, int(np.ceil(ROOT_PIVOTS * n**0.5))))
    rerank = rerank or min(1.0, RERANK * n ** (-1 / 3))
    classes = classes.where(F.octet_length("vec") == width)
    asked_rows = _query_rows(queries.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")), width)
    asked_rows = cut(asked_rows)
    asked = cut(asked_rows.select("vec").distinct())
    blocks = partitions(asked.count(), max(1, QUERY_BYTES // width))
    sample = _matrix(classes.orderBy(F.xxhash64("vec"), "vec").limit(pivots).select("vec").toArrow(), width)
    index = spark.sparkContext.broadcast(PermutationIndex(sample, _top_norm(classes)))
    found = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("vec"), F.lit(blocks)) == block).toArrow()
        if own.num_rows:
            part = _search(classes, index, spark.sparkContext.broadcast(_matrix(own, width)), k, rerank, width)
            found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = F.slice(F.sort_array(F.flatten(F.collect_list(F.arrays_zip(F.col("costs").alias("cost"), F.col("ids").alias("id"))))), 1, k + 1)
    lists = found.groupBy("vec").agg(best.alias("best"))
    return (
        asked_rows.join(lists, "vec")
        .select("query_id", F.posexplode(F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("place", "hit"))
        .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.cost")).alias("score"))
    )


def _query_rows(queries: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("query_id long, vec binary")
        for b in batches:
            rows = [(i, x) for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if i is not None and (x := _valid(v, width // 8)) is not None]
            yield batch_of(schema, {"query_id": [r[0] for r in rows], "vec": [(r[1] + 0.0).tobytes() for r in rows]})

    return queries.mapInArrow(run, "query_id long, vec binary").distinct()


def _matrix(rows: pa.Table, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("vec").to_pylist()), np.float64).reshape(-1, width // 8)


def _top_norm(classes: DataFrame) -> float:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("norm double")
        for b in batches:
            norms = [float(np.linalg.norm(np.frombuffer(v))) for v in b.column(0).to_pylist()]
            yield batch_of(schema, {"norm": [max(norms, default=0.0)]})

    return classes.select("vec").mapInArrow(run, "norm double").agg(F.max("norm")).first()[0]


def _search(classes: DataFrame, index, asked, k: int, rerank: float, width: int) -> DataFrame:
    """(vec, ids, costs) of each query vector and task: the nearest ids found, costs are negative scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, perm = asked.value, index.value
        probes = perm.nearest(queries, query=True)
        none = np.iinfo(np.int64).max
        best_score, best_id = np.full((len(queries), k + 1), -np.inf), np.full((len(queries), k + 1), none)

        def rank(vecs: list[bytes], ids: list[list[int]]) -> None:
            x = np.frombuffer(b"".join(vecs), np.float64).reshape(-1, width // 8)
            posts = perm.postings(x)
            take = max(min(len(x), k + 1), int(np.ceil(rerank * len(x))))
            last = min(k + 1, take)
            for q, vec in enumerate(queries):
                chosen = np.argpartition(perm.footrule(probes[q], posts, len(x)), take - 1)[:take] if take < len(x) else np.arange(len(x))
                score = np.einsum("ij,j->i", x[chosen], vec)
                top = score >= max(np.partition(score, -last)[-last], best_score[q, -1])
                if top.any():
                    own = [ids[c] for c in chosen[top].tolist()]
                    all_scores = np.concatenate([best_score[q], np.repeat(score[top], [len(i) for i in own])])
                    all_ids = np.concatenate([best_id[q], np.array([i for o in own for i in o], np.int64)])
                    order = np.lexsort((all_ids, -all_scores))[: k + 1]
                    best_score[q], best_id[q] = all_scores[order], all_ids[order]

        vecs, ids = [], []
        for b in batches:
            vecs += b.column(0).to_pylist()
            ids += b.column(1).to_pylist()
            while len(vecs) >= BLOCK:
                rank(vecs[:BLOCK], ids[:BLOCK])
                vecs, ids = vecs[BLOCK:], ids[BLOCK:]
        if vecs:
            rank(vecs, ids)
        schema = arrow_schema("vec binary, ids array<long>, costs array<double>")
        filled = (best_id != none).sum(1)
        for start in range(0, len(queries), PASS):
            own = [q for q in range(start, min(start + PASS, len(queries))) if filled[q]]
            yield batch_of(schema, {"vec": [queries[q].tobytes() for q in own], "ids": [best_id[q, : filled[q]].tolist() for q in own], "costs": [(-best_score[q, : filled[q]]).tolist() for q in own]})

    return classes.mapInArrow(run, "vec binary, ids array<long>, costs array<double>")
