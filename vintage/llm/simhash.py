"""Near duplicates by SimHash fingerprints and pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, batch_of, bounded_batches, cut, discard, row_keys, runs, unused
from vintage.llm.components import components

#: Bits of a fingerprint that may differ within a link, and segments of the ring.
MAX_BITS = 3
SEGMENTS = 4
#: Members that are compared at once within a group of equal keys.
BLOCK = 512

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANE = np.arange(8, dtype=np.int64) * 256


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of so many words, repeats included; ASCII is lower-cased first."""
    import xxhash

    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), 42)], np.uint64)
    flat, digest = b" ".join(found), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = [0, *ends.tolist()]
    return np.array([digest(flat[a:b], 42) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=False)], np.uint64)


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes, as a signed 64-bit number; 0 without hashes."""
    if not len(hashes):
        return 0
    lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _LANE
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits((2 * counts > len(hashes)).ravel(), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, keys: bool = False) -> DataFrame:
    """(doc_id, fp) of each row, with keys also the row's (k1, k2); fp is a signed 64-bit number, 0 without words."""
    bounded_batches(docs.sparkSession)
    out = "doc_id long, fp long" + ", k1 long, k2 long" * keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(out)
        for b in batches:
            fps = [fingerprint_of(shingle_hashes(t, words)) for t in b.column(1).to_pylist()]
            yield batch_of(schema, {"doc_id": b.column(0), "fp": fps} | ({"k1": b.column(2), "k2": b.column(3)} if keys else {}))

    return docs.select(F.col("doc_id").cast("long"), "text", *(row_keys() if keys else [])).mapInArrow(run, out)


def _piece(fp: str, start: int, width: int) -> str:
    """Bits of a fingerprint from a position on the ring of 64."""
    return f"(shiftrightunsigned({fp}, {start % 64}) & {(1 << width) - 1})"


def chain_keys(fp: str = "fp") -> Column:
    """Keys that two fingerprints within MAX_BITS share at least one of.

    The ring has four segments of 16 bits, so each may differ by 3/4 of a bit in
    proportion. Some start exists from which every chain of l segments differs by at
    most 3l/4 bits: the first segment not at all, the first two by one bit, the first
    three by two. Of two halves of the second segment one is then equal, and of three
    parts of the third segment one is equal. A key names the start and those choices
    and holds the equal bits, 29 or 30 of them.
    """
    keys = []
    for start in range(SEGMENTS):
        for half in range(2):
            at = 16 * start + 16 + 8 * half
            for part, (offset, width) in enumerate(((0, 5), (5, 5), (10, 6))):
                name = (start * 2 + half) * 3 + part
                keys.append(
                    f"{name}L << 32 | {_piece(fp, 16 * start, 16)} << 14 | {_piece(fp, at, 8)} << 6 | {_piece(fp, 16 * start + 32 + offset, width)}"
                )
    return F.expr(f"array({', '.join(keys)})")


def within_chains(x: np.ndarray) -> np.ndarray:
    """Whether differing bits x leave a start on the ring whose chains all stay within their budgets."""
    segment = np.stack([np.bitwise_count(x >> np.uint64(16 * k) & np.uint64(0xFFFF)) for k in range(SEGMENTS)]).astype(np.int64)
    ok = np.zeros(x.shape, bool)
    for start in range(SEGMENTS):
        fits, total = np.ones(x.shape, bool), np.zeros(x.shape, np.int64)
        for length in range(1, SEGMENTS + 1):
            total = total + segment[(start + length - 1) % SEGMENTS]
            fits &= SEGMENTS * total <= MAX_BITS * length
        ok |= fits
    return ok


def linked(fps: np.ndarray, free: list[int]) -> np.ndarray:
    """The least index that each of distinct fingerprints reaches over links of MAX_BITS.

    free: positions at which they may differ. Up to BLOCK members are compared with each
    other, chains first. More are dealt again by each quarter of the free positions: of
    links of three bits at least one quarter is equal, so no link is lost and no task
    compares all pairs of a large group.
    """
    label = np.arange(len(fps))
    if len(fps) <= BLOCK:
        x = fps[:, None] ^ fps[None, :]
        near = within_chains(x)
        near &= np.bitwise_count(x) <= MAX_BITS
        while True:
            low = np.where(near, label[None, :], len(fps)).min(1)
            if (low == label).all():
                return label
            label = low
    pairs = []
    for quarter in np.array_split(np.array(free), SEGMENTS):
        mask = np.uint64(sum(1 << int(k) for k in quarter))
        order = np.argsort(fps & mask, kind="stable")
        for a, b in zip(*runs((fps & mask)[order]), strict=True):
            if b - a > 1:
                own = order[a:b]
                got = linked(fps[own], [k for k in free if k not in set(quarter.tolist())])
                pairs.append(np.stack([own, own[got]], 1)[got != np.arange(len(own))])
    return _least_reached(len(fps), np.concatenate([*pairs, np.empty((0, 2), np.int64)]))


def _least_reached(n: int, pairs: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while len(pairs):
        low = label.copy()
        np.minimum.at(low, pairs[:, 0], label[pairs[:, 1]])
        np.minimum.at(low, pairs[:, 1], label[pairs[:, 0]])
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    return label


def links(fps: DataFrame, shuffle_partitions: int | None = None) -> DataFrame:
    """Edges (u, v) between distinct fingerprints fp that connect the same ones as all links do.

    Fingerprints meet under their chain keys; each group of a key gives the edges of its
    stars only, never its pairs.
    """
    spark = fps.sparkSession
    n = shuffle_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("u long, v long")
        rest_k, rest_f = np.empty(0, np.int64), np.empty(0, np.int64)

        def stars(keys: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a, b in zip(*runs(keys), strict=True):
                if b - a > 1:
                    own = fp[a:b]
                    got = linked(own.view(np.uint64), list(range(64)))
                    moved = got != np.arange(len(own))
                    if moved.any():
                        yield batch_of(schema, {"u": own[moved], "v": own[got[moved]]})

        for b in batches:
            k = np.concatenate([rest_k, b.column(0).to_numpy()])
            f = np.concatenate([rest_f, b.column(1).to_numpy()])
            last = np.searchsorted(k, k[-1]) if len(k) else 0  # the last key may go on
            yield from stars(k[:last], f[:last])
            rest_k, rest_f = k[last:], f[last:]
        yield from stars(rest_k, rest_f)

    return (
        fps.select(F.explode(chain_keys()).alias("key"), "fp")
        .repartition(n, "key")
        .sortWithinPartitions("key", "fp")
        .mapInArrow(group, "u long, v long")
        .distinct()
    )


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """Components of documents whose fingerprints differ by MAX_BITS bits at most.

    docs: doc_id, text, any others. Returns (doc_id, fp, fingerprint, component_id) for
    each row: fingerprint as 16 hexadecimal digits, component_id the least doc_id that
    its links reach, its own included. NULL and wordless texts have fingerprint zero and
    link like any other. A row whose doc_id is NULL links too, but names no component;
    the id is NULL where no row of the component has one. Equal rows stay, in one
    component. An empty table gives none.
    """
    marked = cut(fingerprints(docs, words))
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fp")))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = named.join(ids, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, words: int = 3) -> DataFrame:
    """Rows of docs, all columns: of each component of near_duplicates the row of the least doc_id.

    Rows without a doc_id stay only where no row of their component has one; ties go to the
    least hash of id and text, and of equal rows one stays. NULL and wordless texts are one
    component, with all that link to fingerprint zero. Empty tables give none.
    """
    marked = cut(fingerprints(docs, words, keys=True))
    distinct = cut(marked.select("fp").distinct())
    roots = components(links(distinct))
    rooted = marked.join(roots, marked["fp"] == roots["node"], "left")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    names = [unused(docs.columns, "k1"), unused(docs.columns, "k2")]
    first = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min(order).alias("first"))
    stay = cut(first.select(F.col("first.k1").alias(names[0]), F.col("first.k2").alias(names[1])))
    kept = docs.withColumns(dict(zip(names, row_keys(), strict=True))).join(stay, names, "left_semi")
    if marked.groupBy("k1", "k2").count().where("count > 1").take(1):
        kept = kept.dropDuplicates(names)
    discard(marked, distinct)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
