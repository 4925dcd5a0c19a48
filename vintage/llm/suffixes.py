"""Repeated byte strings by a depth-limited radix sort of suffixes."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import PASS_BYTES, arrow_schema, batch_of, bounded_batches, cut, mix64, partitions, ragged_take, runs, text_bytes

#: Bytes of a suffix that one digit of the first pass holds.
DIGIT = 32
#: Bytes of text in a chunk of documents and in a bucket of digits.
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
#: Suffixes that a task gathers before it sends them on, and different surroundings of one
#: digit from which on a task sends the suffixes straight to the last pass.
FLUSH = 400_000
HOT = 64
#: Different surroundings of one digit that one task of the last pass compares; digits with
#: more are dealt by whole windows. Suffixes whose windows such a task holds at once.
GROUP = 1024
SLAB = 16_384

_PACKED = "kind int, target int, blob binary"
_DOCS = "chunk int, doc_id long, sub int, packed binary"
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, kept binary"
COVER, OPEN, HOT_OPEN, DIGITS, AROUND, WINDOWS, RUNS = range(7)
#: Columns of a packed table: suffix digits are two hashes, a place is chunk, doc_id, sub and position.
_PLACE = (("chunk", "<i4"), ("doc", "<i8"), ("sub", "<i4"), ("at", "<u4"))
_HASHED = (("a", "<u8"), ("b", "<u8"), *_PLACE)
_RUN = (*_PLACE, ("n", "<u4"))
_AROUND = (*_PLACE, ("left", "<u1"), ("size", "<u1"))


@lru_cache(maxsize=2)
def _tables(seed: int) -> tuple[np.ndarray, np.uint64, np.uint64]:
    """A random number for each byte, and an odd base with its inverse."""
    rng = np.random.Generator(np.random.PCG64(seed))
    byte = rng.integers(0, 2**64, 256, np.uint64)
    base = int(rng.integers(0, 2**64, 1, np.uint64)[0]) | 5
    return byte, np.uint64(base), np.uint64(pow(base, -1, 2**64))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n."""
    if seed not in _POWERS or len(_POWERS[seed][0]) <= n:
        _, base, inverse = _tables(seed)
        one = np.ones(1, np.uint64)
        _POWERS[seed] = tuple(np.concatenate([one, np.cumprod(np.full(n + n // 4, x))]) for x in (base, inverse))
    return _POWERS[seed]


class Hashes:
    """Hashes of any stretch of some bytes, from sums over prefixes."""

    def __init__(self, data: np.ndarray, seed: int = 7):
        self.up, down = _powers(seed, len(data) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_tables(seed)[0][data] * down[: len(data)])])

    def all(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mix64((self.sums[width:] - self.sums[:n]) * self.up[:n])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.up[start])


def _slide(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least or largest of each so many neighbours."""
    pick = np.minimum if least else np.maximum
    have, out = 1, x
    while 2 * have <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[: len(out) - width + have], out[width - have :]) if have < width else out


def pieces(length: int, width: int) -> Iterator[tuple[int, int, int, int]]:
    """(from, to, first, last) of stretches of a long text whose windows start at first to last."""
    for first in range(0, max(1, length - width + 1), PASS_BYTES):
        last = min(first + PASS_BYTES, length - width + 1)
        yield max(0, first - width), min(length, last + 2 * width), first, last


class Anchors:
    """Gathers the suffixes of texts that enter the first pass.

    Of the suffixes within each window the one with the least hash of its first digit is
    taken. Equal windows take it at the same place, so a repeated window always meets its
    other occurrences in the group of that digit.
    """

    def __init__(self, width: int):
        self.width, self.reach = width, width - DIGIT
        self.found: list[tuple] = []
        self.n = 0

    def add(self, texts: list[tuple[tuple[int, int, int], bytes]]) -> None:
        """texts: ((chunk, doc_id, sub), bytes)."""
        batch, size = [], 0
        for place, raw in texts:
            if len(raw) < self.width:
                continue
            for lo, hi, first, last in pieces(len(raw), self.width):
                batch.append((place, raw[lo:hi], lo, first, last, len(raw)))
                size += hi - lo
                if size >= PASS_BYTES:
                    self._pass(batch)
                    batch, size = [], 0
        if batch:
            self._pass(batch)

    def _pass(self, batch: list[tuple]) -> None:
        width, reach = self.width, self.reach
        data = np.frombuffer(b"".join(x[1] for x in batch), np.uint8)
        sizes = np.array([len(x[1]) for x in batch], np.int64)
        base = np.cumsum(sizes) - sizes
        hashes = Hashes(data)
        digit = hashes.all(DIGIT) | np.uint64(1)
        low = _slide(digit, reach + 1, True)  # of the window that starts here
        owned = np.zeros(len(low) + 1, np.int8)
        for b, (_, _, lo, first, last, _) in zip(base.tolist(), batch, strict=True):
            owned[b + first - lo] += 1
            owned[b + last - lo] -= 1
        low *= np.cumsum(owned[:-1]).astype(np.uint64)
        pad = np.zeros(reach, np.uint64)
        chosen = np.flatnonzero(_slide(np.concatenate([pad, low, pad]), reach + 1, False) == digit)
        if not len(chosen):
            return
        unit = np.searchsorted(base, chosen, "right") - 1
        offset = np.array([x[2] for x in batch], np.int64)
        length = np.array([x[5] for x in batch], np.int64)
        at = chosen - base[unit] + offset[unit]
        left, right = np.minimum(reach, at), np.minimum(width, length[unit] - at)
        around = hashes.at(chosen - left, chosen + right) ^ mix64((left * 4096 + right).astype(np.uint64))
        places = [np.array([x[0][k] for x in batch], np.int64)[unit] for k in range(3)]
        self.found.append((digit[chosen], around, *places, at))
        self.n += len(chosen)

    def take(self) -> list[np.ndarray]:
        out = [np.concatenate([f[k] for f in self.found]) for k in range(6)] if self.found else [np.empty(0, np.int64)] * 6
        self.found, self.n = [], 0
        return out


def _first_of(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns (a, b, chunk, doc, sub, at) in order of a, b and place, and whether each is the first of its a and b.

    Equal rows stay together: a place that came twice is not later than itself.
    """
    a, b, chunk, doc, sub, at = columns
    order = np.lexsort((at, sub, doc, b, a))
    a, b, chunk, doc, sub, at = (c[order] for c in (a, b, chunk, doc, sub, at))
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    same = (doc == doc[lead]) & (sub == sub[lead]) & (at == at[lead])
    return [a, b, chunk, doc, sub, at], new | same


def _pack(columns: list[np.ndarray], layout: tuple) -> bytes:
    import zstandard

    body = b"".join(np.ascontiguousarray(c.astype(t)).tobytes() for c, (_, t) in zip(columns, layout, strict=True))
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(blobs: Iterable[bytes], layout: tuple) -> list[np.ndarray]:
    import zstandard

    z = zstandard.ZstdDecompressor()
    width = sum(np.dtype(t).itemsize for _, t in layout)
    parts: list[list[np.ndarray]] = [[] for _ in layout]
    for blob in blobs:
        raw = z.decompress(blob)
        n, start = len(raw) // width, 0
        for k, (_, t) in enumerate(layout):
            parts[k].append(np.frombuffer(raw, t, n, start))
            start += n * np.dtype(t).itemsize
    return [np.concatenate([*p, np.empty(0, t)]) for p, (_, t) in zip(parts, layout, strict=True)]


def _dealt(kind: int, target: np.ndarray, columns: list[np.ndarray], layout: tuple) -> Iterator[pa.RecordBatch]:
    """Rows packed by their target."""
    order = np.argsort(target, kind="stable")
    target, columns = target[order], [c[order] for c in columns]
    schema = arrow_schema(_PACKED)
    starts, ends = runs(target)
    for k in range(0, len(starts), 256):
        rows = [(int(target[x]), _pack([c[x:y] for c in columns], layout)) for x, y in zip(starts[k : k + 256], ends[k : k + 256], strict=True)]
        yield batch_of(schema, {"kind": [kind] * len(rows), "target": [r[0] for r in rows], "blob": [r[1] for r in rows]})


def _places(columns: list[np.ndarray], keep: np.ndarray, kind: int) -> Iterator[pa.RecordBatch]:
    own = [c[keep] for c in columns[2:]]
    yield from _dealt(kind, own[0], own, _PLACE)


def _windows_near(raw: bytes, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows that hold a digit at one of these places, and two hashes of each."""
    starts, a, b = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    steps = np.arange(width - DIGIT + 1)
    for lo, hi, first, last in pieces(len(raw), width):
        near = at[(at >= first) & (at <= last + width)]
        s = np.unique((near[:, None] - steps).ravel())
        s = s[(s >= first) & (s < last)]
        if len(s):
            data = np.frombuffer(raw[lo:hi], np.uint8)
            starts.append(s)
            a.append(Hashes(data, 7).at(s - lo, s - lo + width))
            b.append(Hashes(data, 11).at(s - lo, s - lo + width))
    return np.concatenate(starts), np.concatenate(a), np.concatenate(b)


def remove_repeats(docs: DataFrame, width: int = 100, keep: bool = False, hot: int = HOT) -> DataFrame:
    """Remove bytes covered by a string of width bytes that also starts earlier.

    Suffixes are sorted by digits, the most significant first, and only through width
    bytes. A group of one leaves the sort after any pass; groups that are equal through
    all digits are exactly the repeated windows.

    Pass 1. The first digit has DIGIT bytes. Of the suffixes in each window the one whose
    digit has the least hash enters (see Anchors), about one of 35; the others follow it.
    A task sends the first suffix of each surrounding of each digit and marks the later
    ones as covered itself. Groups of one end here.
    Pass 2. In a group with one surrounding (all bytes of all windows around the digit)
    every suffix but the first is covered. Of groups with several surroundings the first
    of each goes on.
    Pass 3. Those are dealt by their digit again, with the bytes around them, and all
    windows in these are grouped by all their bytes; all but the first are covered. Where
    a digit has over hot surroundings in a task or GROUP in all, the windows themselves
    are dealt instead, of each task the first of its kind, so no group lands in one task.

    docs: doc_id, text, any others. A NULL text counts as empty. Texts are UTF-8 bytes,
    of any length, and matches never cross texts. A NULL doc_id comes before all others.
    Rows with one doc_id and different texts are different documents, in order of the
    crc32 of their texts; equal rows count as one document and each gets its result. An
    empty table gives none. Equality is that of 128 hashed bits. Returns OUT; spans holds
    starts and ends in turn, kept the remaining bytes (NULL unless keep).
    """
    if not 2 * DIGIT <= width <= 140:
        raise ValueError(f"width must lie between {2 * DIGIT} and 140")
    spark = docs.sparkSession
    bounded_batches(spark)
    total = text_bytes(docs)
    chunks, buckets = partitions(total, CHUNK_BYTES), partitions(total, BUCKET_BYTES)
    keyed = docs.select(
        F.expr(f"CAST(pmod(xxhash64(doc_id, text), {chunks}) AS INT)").alias("chunk"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"),
        F.expr("CAST(crc32(coalesce(text, '')) - 2147483648 AS INT)").alias("sub"),
        "text",
        F.col("doc_id").isNull().alias("no_id"),
    )

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(width)
        for b in batches:
            places = zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)
            anchors.add([(p, (t or "").encode()) for p, t in zip(places, b.column(3).to_pylist(), strict=True)])
            if anchors.n > FLUSH:
                yield from _send(anchors.take(), buckets, hot)
        yield from _send(anchors.take(), buckets, hot)

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = []
        for b in batches:
            own = np.array(b.column(0).to_pylist(), np.int64) == DIGITS
            blobs += b.column(2).filter(pa.array(own)).to_pylist()
            yield b.filter(pa.array(~own))
        if blobs:
            columns, first = _first_of(_unpack(blobs, _HASHED))
            mark = columns[5] == 2**32 - 1
            starts, ends = runs(columns[0])
            different = np.repeat(np.add.reduceat(_changes(columns) + GROUP * mark, starts), ends - starts)
            yield from _places(columns, ~first, COVER)
            yield from _places(columns, first & ~mark & (different > 1) & (different <= GROUP), OPEN)
            yield from _places(columns, first & ~mark & (different > GROUP), HOT_OPEN)

    met = cut(keyed.mapInArrow(first_pass, _PACKED).repartition(buckets, "target").mapInArrow(second_pass, _PACKED))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z, schema = zstandard.ZstdCompressor(level=3), arrow_schema(_DOCS)
        for b in batches:
            packed = [z.compress((t or "").encode()) for t in b.column(3).to_pylist()]
            yield batch_of(schema, {"chunk": b.column(0), "doc_id": b.column(1), "sub": b.column(2), "packed": packed})

    dealt = keyed.mapInArrow(pack, _DOCS).repartition(chunks, "chunk")

    def by_document(places: list[np.ndarray]) -> dict[tuple[int, int], np.ndarray]:
        """Rows of each (doc_id, sub)."""
        _, doc, sub = places[:3]
        if not len(doc):
            return {}
        order = np.lexsort((sub, doc))
        key = np.ones(len(order), bool)
        key[1:] = (doc[order][1:] != doc[order][:-1]) | (sub[order][1:] != sub[order][:-1])
        starts = np.flatnonzero(key)
        ends = np.r_[starts[1:], len(order)]
        return {(int(doc[order[a]]), int(sub[order[a]])): order[a:b] for a, b in zip(starts, ends, strict=True)}

    def windows(texts: pa.Table, found: pa.Table) -> pa.Table:
        import zstandard

        z, out = zstandard.ZstdDecompressor(), []
        blobs = list(zip(found.column("kind").to_pylist(), found.column("blob").to_pylist(), strict=True))
        open_, hot_open = (_unpack([b for k, b in blobs if k == kind], _PLACE) for kind in (OPEN, HOT_OPEN))
        rows, hot_rows = by_document(open_), by_document(hot_open)
        around, done, size = [], [], 0
        for chunk, doc, sub, packed in zip(*(c.to_pylist() for c in texts.columns[:4]), strict=True):
            own, hot_own = rows.pop((doc, sub), None), hot_rows.pop((doc, sub), None)
            if own is None and hot_own is None:
                continue
            raw = z.decompress(packed)
            if own is not None:
                for p in open_[3][own].tolist():
                    left = min(p, width - DIGIT)
                    around.append((zlib.crc32(raw[p : p + DIGIT]), chunk, doc, sub, p, left, raw[p - left : p + width]))
            if hot_own is not None:
                s, a, b = _windows_near(raw, hot_open[3][hot_own].astype(np.int64), width)
                done.append((a, b, *(np.full(len(s), x, np.int64) for x in (chunk, doc, sub)), s))
                size += len(s)
                if size > FLUSH:
                    out += _send_windows([np.concatenate(c) for c in zip(*done, strict=True)], buckets)
                    done, size = [], 0
        if done:
            out += _send_windows([np.concatenate(c) for c in zip(*done, strict=True)], buckets)
        out += _send_around(around, buckets)
        return pa.Table.from_batches(out, arrow_schema(_PACKED))

    def last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, list[bytes]] = {AROUND: [], WINDOWS: []}
        for b in batches:
            kinds = np.array(b.column(0).to_pylist(), np.int64)
            for kind, own in blobs.items():
                own += b.column(2).filter(pa.array(kinds == kind)).to_pylist()
            yield b.filter(pa.array(kinds == RUNS))
        if blobs[WINDOWS]:
            columns, first = _first_of(_unpack(blobs[WINDOWS], _HASHED))
            yield from _send_runs([c[~first] for c in columns[2:]])
        for columns in _windows_around(blobs[AROUND], width):
            columns, first = _first_of(columns)
            yield from _send_runs([c[~first] for c in columns[2:]])

    chunk_of = F.col("target").alias("chunk")
    covers, open_ = met.where(f"kind = {COVER}"), met.where(f"kind IN ({OPEN}, {HOT_OPEN})")
    near = (
        dealt.groupBy("chunk")
        .cogroup(open_.select("kind", chunk_of, "blob").repartition(chunks, "chunk").groupBy("chunk"))
        .applyInArrow(windows, _PACKED)
        .repartition(buckets, "target")
        .mapInArrow(last_pass, _PACKED)
    )
    covered = covers.unionAll(near).select("kind", chunk_of, "blob").repartition(chunks, "chunk")

    def cover(texts: pa.Table, found: pa.Table) -> pa.Table:
        import zstandard

        z = zstandard.ZstdDecompressor()
        blobs = list(zip(found.column("kind").to_pylist(), found.column("blob").to_pylist(), strict=True))
        around = _unpack([b for k, b in blobs if k == COVER], _PLACE)
        window = _unpack([b for k, b in blobs if k == RUNS], _RUN)
        rows = [by_document(around), by_document(window)]
        out: dict[str, list] = {f.name: [] for f in arrow_schema(OUT)}
        none = np.empty(0, np.int64)
        for _, doc, sub, packed in zip(*(c.to_pylist() for c in texts.columns[:4]), strict=True):
            raw = z.decompress(packed)
            p = around[3][rows[0].get((doc, sub), none)].astype(np.int64)
            own = rows[1].get((doc, sub), none)
            s, n = window[3][own].astype(np.int64), window[4][own].astype(np.int64)
            starts = np.concatenate([np.maximum(0, p - (width - DIGIT)), s])
            ends = np.concatenate([np.minimum(len(raw), p + width), s + n - 1 + width])
            spans = _merged(starts, ends)
            kept = b"".join(raw[a:b] for a, b in zip([0, *spans[1::2]], [*spans[::2], len(raw)], strict=True))
            out["doc_id"].append(None if doc == -(2**63) else doc)
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(len(raw) - len(kept))
            out["n_spans"].append(len(spans) // 2)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["spans"].append(spans)
            out["kept"].append(kept if keep else None)
        return pa.Table.from_pydict(out, schema=arrow_schema(OUT))

    return dealt.groupBy("chunk").cogroup(covered.groupBy("chunk")).applyInArrow(cover, OUT)


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """1 where a sorted row has another digit or surrounding than the one before."""
    new = np.ones(len(columns[0]), np.int64)
    new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    return new


def _send(columns: list[np.ndarray], buckets: int, most: int) -> Iterator[pa.RecordBatch]:
    """What a task passes on: later places of a surrounding are covered; the rest meets others of its digit."""
    if not len(columns[0]):
        return
    columns, first = _first_of(columns)
    starts, ends = runs(columns[0])
    hot = np.repeat(np.add.reduceat(_changes(columns), starts) > most, ends - starts)
    yield from _places(columns, ~first, COVER)
    yield from _places(columns, first & hot, HOT_OPEN)
    send = first & ~hot
    rest = [c[send] for c in columns]
    marks = np.unique(columns[0][hot])
    if len(marks):  # these digits have several surroundings, though they are not sent here
        zero = np.zeros(len(marks), np.int64)
        fill = (marks, zero.astype(np.uint64), zero, zero + (2**63 - 1), zero, zero + (2**32 - 1))
        rest = [np.concatenate([c, f]) for c, f in zip(rest, fill, strict=True)]
    yield from _dealt(DIGITS, (rest[0] >> np.uint64(8)) % np.uint64(buckets), rest, _HASHED)


def _send_around(around: list[tuple], buckets: int) -> list[pa.RecordBatch]:
    """Open suffixes (digit, chunk, doc, sub, at, left, bytes) with the bytes around them, packed by digit."""
    import zstandard

    z, schema, packed = zstandard.ZstdCompressor(level=3), arrow_schema(_PACKED), {}
    for row in around:
        packed.setdefault(row[0] % buckets, []).append(row)
    rows = []
    for bucket, own in packed.items():
        columns = [np.array([r[k] for r in own], np.int64) for k in range(1, 6)] + [np.array([len(r[6]) for r in own])]
        head = b"".join(c.astype(t).tobytes() for c, (_, t) in zip(columns, _AROUND, strict=True))
        rows.append((bucket, z.compress(np.uint32(len(own)).tobytes() + head + b"".join(r[6] for r in own))))
    return [batch_of(schema, {"kind": [AROUND] * len(rows), "target": [r[0] for r in rows], "blob": [r[1] for r in rows]})] if rows else []


def _windows_around(blobs: list[bytes], width: int) -> Iterator[list[np.ndarray]]:
    """All windows (two hashes and their place) of suffixes that came with the bytes around them, whole digits at a time."""
    import zstandard

    if not blobs:
        return
    z, parts, texts = zstandard.ZstdDecompressor(), [], []
    for blob in blobs:
        raw = z.decompress(blob)
        n, start, columns = int(np.frombuffer(raw[:4], np.uint32)[0]), 4, []
        for _, t in _AROUND:
            columns.append(np.frombuffer(raw, t, n, start).astype(np.int64))
            start += n * np.dtype(t).itemsize
        parts.append(columns)
        texts.append(np.frombuffer(raw, np.uint8, -1, start))
    chunk, doc, sub, at, left, size = (np.concatenate(c) for c in zip(*parts, strict=True))
    data = np.concatenate(texts)
    base = np.cumsum(size) - size
    digits = ragged_take(data, base + left, np.full(len(base), DIGIT), np.arange(len(base))).reshape(-1, DIGIT // 8, 8).copy().view(np.uint64)[:, :, 0]
    order = np.lexsort(digits.T)
    _, ends = runs_of_rows(digits[order])
    lo = 0
    while lo < len(order):
        hi = int(ends[min(len(ends) - 1, np.searchsorted(ends, lo + SLAB))])
        own = order[lo:hi]
        part = ragged_take(data, base, size, own)
        at_base = np.cumsum(size[own]) - size[own]
        n = size[own] - width + 1
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        s = np.repeat(at_base, n) + step
        place = [np.repeat(c[own], n) for c in (chunk, doc, sub)]
        yield [Hashes(part, 7).at(s, s + width), Hashes(part, 11).at(s, s + width), *place, np.repeat((at - left)[own], n) + step]
        lo = hi


def runs_of_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal rows."""
    new = np.r_[True, (rows[1:] != rows[:-1]).any(1)]
    starts = np.flatnonzero(new)
    return starts, np.r_[starts[1:], len(rows)]


def _send_windows(columns: list[np.ndarray], buckets: int) -> list[pa.RecordBatch]:
    columns, first = _first_of(columns)
    own = [c[first] for c in columns]
    return [*_dealt(WINDOWS, (own[0] >> np.uint64(8)) % np.uint64(buckets), own, _HASHED), *_send_runs([c[~first] for c in columns[2:]])]


def _send_runs(places: list[np.ndarray]) -> list[pa.RecordBatch]:
    """Covered window starts (chunk, doc, sub, at) as runs, packed by chunk."""
    chunk, doc, sub, at = places
    order = np.lexsort((at, sub, doc, chunk))
    chunk, doc, sub, at = (c[order].astype(np.int64) for c in places)
    if not len(at):
        return []
    new = np.ones(len(at), bool)
    new[1:] = (chunk[1:] != chunk[:-1]) | (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1]) | (at[1:] > at[:-1] + 1)
    starts = np.flatnonzero(new)
    ends = np.r_[starts[1:], len(at)]
    n = at[ends - 1] - at[starts] + 1
    return list(_dealt(RUNS, chunk[starts], [c[starts] for c in (chunk, doc, sub, at)] + [n], _RUN))


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """Starts and ends, in turn, of the union of spans; spans that touch are one."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]
    return np.stack([starts[new], reach[last]], 1).ravel().tolist()
