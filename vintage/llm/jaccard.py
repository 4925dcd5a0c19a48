"""Similar documents by a prefix-tree join of their word n-gram sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, batch_of, bounded_batches, cut, discard, mix64, partitions, row_keys, runs
from vintage.llm.components import components
from vintage.llm.simhash import fingerprint_of

#: Codes that one bucket of the count holds, about.
BUCKET_CODES = 1 << 20
#: Codes of a set behind the one under which it is posted that its path in the tree shows.
PATH = 32
#: Bits of a set's map, on which its codes fall.
MAP_BITS = 2048
#: Longs of a set's SimHash, by which neighbours are chosen.
SKETCH = 4
#: Sets in one tree; a larger group becomes several trees that cover all its pairs.
TREE_SETS = 2048
#: Neighbours with which each set is compared at once before the trees are joined, and places after it at which they are looked for.
NEAR = 6
PLACES = (1, 2, 3)

_PIECE = "piece long, doc_id array<long>, k1 array<long>, k2 array<long>, cls array<string>, n array<long>, owner binary, codes binary"


def set_codes(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit codes of the distinct shingles; with fewer words, of the whole sequence."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w, 42) for w in (text or "").encode().lower().split()], np.uint64)
    if not len(h):
        return h
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix64(out) * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k]
    return np.unique(mix64(out))


def map_of(codes: np.ndarray) -> np.ndarray:
    """The bits on which codes fall. Maps of two sets differ in no more bits than the sets in codes."""
    bits = np.zeros(MAP_BITS, bool)
    bits[(codes % np.uint64(MAP_BITS)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


def sketch_of(codes: np.ndarray) -> list[int]:
    """A SimHash of SKETCH longs."""
    return [fingerprint_of(mix64(codes ^ np.uint64(seed))) for seed in range(1, SKETCH + 1)]


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shingles that a set of n shares at least with any similar one."""
    return -(-percent * n // 100)


def margin(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shingles that two similar sets share at least among the least codes of both; grows with n."""
    return np.maximum(1, (100 - percent) * n // 100)


def pieces_of(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row for each batch: keys, classes and sizes of its rows, and the least codes of each set.

    Of two similar sets, the margin(n) least codes that they share lie among the first
    n - needed(n) + margin(n) codes of the one with n, and, as the other may be larger by
    100 / percent, among the first n - needed(n) + margin(100 n / percent) of either.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        schema, first = arrow_schema(_PIECE), TaskContext.get().partitionId() << 32
        for number, b in enumerate(batches):
            cls, sizes, owners, low = [], [], [], []
            for k, text in enumerate(b.column(3).to_pylist()):
                own = set_codes(text, words)
                n = len(own)
                cls.append(xxhash.xxh3_128_hexdigest(own.tobytes()) if n else None)
                sizes.append(n)
                if n:
                    show = min(n, int(n - needed(n, percent) + margin(100 * n // percent, percent)))
                    tested = n - needed(n, percent) + margin(n, percent)
                    owners.append((np.arange(show) < tested).astype(np.uint16) << 15 | np.uint16(k))
                    low.append(own[:show])
            yield batch_of(schema, {
                "piece": [first + number], "doc_id": [b.column(0).to_pylist()], "k1": [b.column(1)], "k2": [b.column(2)], "cls": [cls], "n": [sizes],
                "owner": [np.concatenate([*owners, np.empty(0, np.uint16)]).tobytes()], "codes": [np.concatenate([*low, np.empty(0, np.uint64)]).tobytes()],
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_keys(), "text").mapInArrow(run, _PIECE)


def shared_counts(pieces: DataFrame) -> DataFrame:
    """(piece, at, shared): how many of a row's tested codes other rows show too. Rows without any are left out.

    Codes travel packed, four bytes and their owner each, to buckets whose number follows
    their total. Two codes of one bucket that agree in 32 bits count as one, which only
    lets more rows through.
    """
    spark = pieces.sparkSession
    total = (pieces.agg(F.sum(F.octet_length("codes"))).first()[0] or 0) // 8
    n = max(partitions(total, BUCKET_CODES), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("bucket int, piece long, owner binary, residue binary")
        for b in batches:
            for piece, owner, codes in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                code, who = np.frombuffer(codes, np.uint64), np.frombuffer(owner, np.uint16)
                bucket = ((code >> np.uint64(32)) % np.uint64(n)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                starts, ends = runs(bucket[order])
                parts = [order[a:z] for a, z in zip(starts, ends, strict=True)]
                yield batch_of(schema, {
                    "bucket": bucket[order][starts], "piece": [piece] * len(parts),
                    "owner": [who[p].tobytes() for p in parts], "residue": [code[p].astype(np.uint32).tobytes() for p in parts],
                })

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("piece long, at array<int>, shared array<long>")
        held: list[tuple[int, bytes, bytes]] = []
        now = None

        def flush() -> Iterator[pa.RecordBatch]:
            residue = [np.frombuffer(r, np.uint32) for _, _, r in held]
            _, inverse, times = np.unique(np.concatenate(residue), return_inverse=True, return_counts=True)
            found = np.split(times[inverse] > 1, np.cumsum([len(r) for r in residue])[:-1])
            for (piece, owner, _), hit in zip(held, found, strict=True):
                who = np.frombuffer(owner, np.uint16)
                at, shared = np.unique(who[hit & (who >> 15 == 1)] & np.uint16(0x7FFF), return_counts=True)
                if len(at):
                    yield batch_of(schema, {"piece": [piece], "at": [at], "shared": [shared]})

        for b in batches:
            for bucket, *row in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if bucket != now and held:
                    yield from flush()
                    held = []
                now = bucket
                held.append(tuple(row))
        if held:
            yield from flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("piece long, at int, shared long")
        total, now = np.zeros(1 << 15, np.int64), None

        def flush() -> pa.RecordBatch:
            at = np.flatnonzero(total)
            out = batch_of(schema, {"piece": [now] * len(at), "at": at.astype(np.int32), "shared": total[at]})
            total[at] = 0
            return out

        for b in batches:
            for k, piece in enumerate(b.column(0).to_pylist()):
                if piece != now and now is not None:
                    yield flush()
                now = piece
                total[b.column(1)[k].values.to_numpy()] += b.column(2)[k].values.to_numpy()
        if now is not None:
            yield flush()

    dealt = pieces.select("piece", "owner", "codes").mapInArrow(deal, "bucket int, piece long, owner binary, residue binary")
    counted = dealt.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(count, "piece long, at array<int>, shared array<long>")
    return counted.repartition(n, "piece").sortWithinPartitions("piece").mapInArrow(add, "piece long, at int, shared long")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cls, codes, map, sketch) of the wanted rows (k1, k2, cls)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("cls string, codes array<long>, map binary, sketch array<long>")
        for b in batches:
            own = [set_codes(t, words) for t in b.column(1).to_pylist()]
            yield batch_of(schema, {"cls": b.column(0), "codes": [c.view(np.int64) for c in own], "map": [map_of(c).tobytes() for c in own], "sketch": [sketch_of(c) for c in own]})

    texts = docs.select(*row_keys(), "text").join(wanted, ["k1", "k2"]).select("cls", "text")
    return texts.mapInArrow(run, "cls string, codes array<long>, map binary, sketch array<long>").dropDuplicates(["cls"])


def postings(sets: DataFrame, percent: int) -> DataFrame:
    """(key, cls, n, rest, path, sketch): sets under each of the first codes that a similar one must share one of.

    Codes are ordered by the number of sets that hold them, then by value; key holds both.
    A code of one set only matches nothing, so it uses up a part of what the set may miss.
    rest is the number of codes after the key that others hold, path the first of them.
    """
    flat = sets.select("cls", F.size("codes").alias("n"), F.explode("codes").alias("code"))
    often = flat.groupBy("code").agg(F.count("*").alias("df")).where("df > 1")
    key = F.shiftleft(F.least("df", F.lit(1 << 22)), 40).bitwiseOR(F.shiftrightunsigned("code", 24)).alias("key")
    ordered = flat.join(often, "code").groupBy("cls", "n").agg(F.sort_array(F.collect_list(key)).alias("keys"))
    first = F.expr(f"size(keys) - CAST(({percent}L * n + 99) DIV 100 AS INT) + 1")
    ordered = ordered.withColumn("first", first).where("first > 0").join(sets.select("cls", "sketch"), "cls")
    posted = ordered.select("cls", "n", "keys", "sketch", F.posexplode(F.slice("keys", F.lit(1), "first")).alias("at", "key"))
    return posted.select("key", "cls", "n", (F.size("keys") - F.col("at") - 1).alias("rest"), F.slice("keys", F.col("at") + 2, F.lit(PATH)).alias("path"), "sketch")


def _enough(shared: Column, n1: Column, n2: Column, percent: int) -> Column:
    return shared * (100 + percent) >= (n1 + n2) * percent


def _neighbours(posts: DataFrame, percent: int, by: list[Column]) -> DataFrame:
    """Pairs (u, v): each set with those of other roots soon after it in its keys' groups whose SimHash is closest."""
    order = Window.partitionBy("key").orderBy(*by)
    own = ["cls", "n", "rest", "root", "sketch"]
    after = F.array(*[F.lead(F.struct(*own), k).over(order) for k in PLACES])
    beside = posts.select(*own, after.alias("after")).select(*own, F.explode("after").alias("next")).where("next.root <> root")
    beside = beside.where(_enough(F.least("rest", "next.rest") + 1, F.col("n"), F.col("next.n"), percent))
    apart = F.expr(" + ".join(f"bit_count(sketch[{k}] ^ next.sketch[{k}])" for k in range(SKETCH)))
    met = beside.groupBy(F.col("cls").alias("u"), F.col("next.cls").alias("v")).agg(F.min(apart).alias("apart"))
    best = met.groupBy("u").agg(F.slice(F.array_sort(F.collect_list(F.struct("apart", "v"))), 1, NEAR).alias("best"))
    return best.select("u", F.explode("best.v").alias("v"))


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (u, v) whose whole sets are similar."""
    x = sets.select(F.col("cls").alias("u"), F.col("codes").alias("x"))
    y = sets.select(F.col("cls").alias("v"), F.col("codes").alias("y"))
    both = pairs.join(x, "u").join(y, "v")
    return both.where(_enough(F.size(F.array_intersect("x", "y")), F.size("x"), F.size("y"), percent)).select("u", "v")


def tree_pairs(paths: list[list[int]], n: np.ndarray, rest: np.ndarray, root: np.ndarray, maps: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of rows with different roots that may be similar; paths are in ascending order.

    The rows form a prefix tree: those with equal first codes share a node. Each node is
    visited once with all sets that are still open there, and what they share with its
    path so far is kept for the whole subtree. A set is closed where this and the codes
    left to it or to the subtree's longest set are not enough for the subtree's smallest
    set, or where the subtree holds its own root alone. A code beyond a set's shown path
    counts as shared. At a leaf the two sets' maps bound their difference from below.
    """
    out: list[tuple[int, int]] = []
    size = len(paths)
    known = np.array([len(p) for p in paths])
    width = max(1, int(known.max())) if size else 1
    shown = np.full((size, width), np.iinfo(np.int64).max)
    for k, p in enumerate(paths):
        shown[k, : len(p)] = p
    last = np.where(known > 0, shown[np.arange(size), np.maximum(known - 1, 0)], -1)
    cut_off = known < rest

    def close(open_: np.ndarray, has: np.ndarray, left: np.ndarray, a: int, b: int, depth: int) -> np.ndarray:
        most = 1 + has + np.minimum(left, rest[a:b].max() - depth)
        keep = (open_ < b) & (most * (100 + percent) >= (n[open_] + n[a:b].min()) * percent)
        if (root[a:b] == root[a]).all():
            keep &= root[open_] != root[a]
        return keep

    stack = [(0, size, 0, np.arange(size), np.zeros(size, np.int64))]
    while stack:
        a, b, depth, open_, has = stack.pop()
        ends = a
        while ends < b and known[ends] == depth:  # the sets whose shown path ends here
            y = ends
            seen = (shown[open_] <= (shown[y, depth - 1] if depth else -1)).sum(1)
            most = 1 + has + np.minimum(rest[open_] - seen, rest[y] - depth)
            good = (open_ < y) & (root[open_] != root[y]) & (most * (100 + percent) >= (n[open_] + n[y]) * percent)
            x = open_[good]
            apart = np.bitwise_count(maps[x] ^ maps[y]).sum(1, dtype=np.int64)
            x = x[(n[x] + n[y] - apart) * (100 + percent) >= 2 * percent * (n[x] + n[y])]
            out += [(int(k), y) for k in x]
            ends += 1
        if ends == b:
            continue
        starts, stops = runs(shown[ends:b, depth])
        for s, e in zip(starts + ends, stops + ends, strict=True):
            code = shown[s, depth]
            view = shown[open_]
            more = has + ((view == code).any(1) | (cut_off[open_] & (last[open_] < code)))
            keep = close(open_, more, rest[open_] - (view <= code).sum(1), s, e, depth + 1)
            if keep.any():
                stack.append((s, e, depth + 1, open_[keep], more[keep]))
    return out


def _tree_join(posts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (u, v) with different roots that the trees cannot rule out.

    A group of one root alone has none. Of a large group the sets of its commonest root
    are dealt to several trees and the others go to each; where the others are many too,
    there is a tree for each two parts of the group.
    """
    by_root = posts.groupBy("key", "root").agg(F.count("*").alias("rows"))
    groups = by_root.groupBy("key").agg(F.max(F.struct("rows", "root")).alias("major"), F.sum("rows").alias("all"), F.count("*").alias("roots")).where("roots > 1")
    groups = groups.select("key", F.col("major.root").alias("major"), F.ceil(F.col("all") / TREE_SETS).cast("int").alias("m"), (F.col("all") - F.col("major.rows") <= TREE_SETS).alias("few"))
    own = "CAST(pmod(xxhash64(cls), m) AS INT)"
    every = "sequence(0, m - 1)"
    trees = F.expr(
        f"""CASE WHEN m = 1 THEN array(struct(0 AS i, 0 AS j))
                 WHEN few AND root = major THEN array(struct({own} AS i, 0 AS j))
                 WHEN few THEN transform({every}, k -> struct(k AS i, 0 AS j))
                 ELSE transform({every}, k -> struct(least(k, {own}) AS i, greatest(k, {own}) AS j)) END"""
    )
    dealt = posts.drop("sketch").join(groups, "key").select("key", "cls", "n", "rest", "root", "path", F.inline(trees)).join(sets.select("cls", "map"), "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("u string, v string")
        held: list[tuple] = []
        now = None

        def flush() -> pa.RecordBatch:
            cls, n, rest, root, paths, maps = zip(*held, strict=True)
            _, number = np.unique(np.array(root), return_inverse=True)
            found = tree_pairs(list(paths), np.array(n, np.int64), np.array(rest, np.int64), number, np.frombuffer(b"".join(maps), np.uint64).reshape(len(n), -1), percent)
            pairs = {(min(cls[x], cls[y]), max(cls[x], cls[y])) for x, y in found}
            return batch_of(schema, {"u": [p[0] for p in pairs], "v": [p[1] for p in pairs]})

        for b in batches:
            for key, i, j, *row in zip(*(b.column(k).to_pylist() for k in range(9)), strict=True):
                if (key, i, j) != now and held:
                    yield flush()
                    held = []
                now = (key, i, j)
                held.append(tuple(row))
        if held:
            yield flush()

    parts = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "path", "cls")
    return dealt.select("key", "i", "j", "cls", "n", "rest", "root", "path", "map").mapInArrow(run, "u string, v string").distinct()


def similar_documents(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs (doc_id, text, any others).

    Documents link if their sets of distinct shingles have a Jaccard similarity of
    percent / 100 or more; component_id is the least doc_id that links reach, the row's own
    included. All of it is exact up to collisions of 64-bit codes within compared sets and
    128-bit ones of whole sets. A text with fewer words than a shingle is one shingle; NULL
    and wordless texts have none and link with nothing, not even each other. Equal texts
    are one set whose rows all appear in the result. A row whose doc_id is NULL links too
    but names no component; the id is NULL where no row has one. Empty tables give none.

    Sets that show too few codes that others show as well are done. Of the others one of
    each class is read again; its codes are ordered by rarity and it is posted under the
    rarest of them. A set is first compared with a few neighbours under its keys, so that
    most of a group of copies becomes one component by comparisons in proportion to its
    members; then the trees are joined for all that lies in different components.
    """
    pieces = cut(pieces_of(docs, words, percent))
    rows = pieces.select("piece", F.posexplode(F.arrays_zip("doc_id", "k1", "k2", "cls", "n")).alias("at", "row")).select("piece", "at", "row.*")
    least = F.expr(f"greatest(1, n * {100 - percent} DIV 100)")
    shown = rows.where("n > 0").join(shared_counts(pieces), ["piece", "at"]).where(F.col("shared") >= least)
    wanted = shown.groupBy("cls").agg(F.min(F.struct("k1", "k2")).alias("row")).select("cls", "row.*")
    sets = cut(_sets(docs, wanted, words))
    posts = cut(postings(sets, percent))
    rooted, links = posts.withColumn("root", F.col("cls")), None
    # Neighbours in the trees, then neighbours by lot, which join what the first have left apart.
    for by in ([F.col("path"), F.col("cls")], [F.xxhash64("cls", "key"), F.col("cls")]):
        near = cut(_similar(_neighbours(rooted, percent, by), sets, percent))
        links = near if links is None else links.unionAll(near)
        roots = cut(components(links))
        rooted = posts.join(roots, posts["cls"] == roots["node"], "left").withColumn("root", F.coalesce("root", "cls")).drop("node")
    more = cut(_similar(_tree_join(rooted, sets, percent), sets, percent))
    discard(posts, sets)
    if more.take(1):
        roots = components(links.unionAll(more))
    ids = rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    ids = ids.join(roots, ids["cls"] == roots["node"], "left").select("cls", "least", F.coalesce("root", "cls").alias("root"))
    named = ids.groupBy("root").agg(F.min("least").alias("named"))
    ids = ids.join(named, "root").select("cls", F.col("named").alias("least"))
    found = rows.join(ids, "cls", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


#: DuckDB's form: every pair of documents that share a shingle.
ORACLE = """
WITH RECURSIVE said AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS s FROM said, unnest(range(1, greatest(len(w) - 2, 2))) r(k) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM met JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * o >= 85 * (p.n + q.n - o)
), sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, b AS other FROM sides UNION SELECT reach.doc_id, sides.b FROM reach JOIN sides ON reach.other = sides.a)
SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY d.doc_id
"""
