"""Language identification by prediction by partial matching."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, batch_of, bounded_batches, cut, passes

#: Bytes of a context at most; a text begins as if after so many line feeds.
DEPTH = 3
#: Grams that reach the driver at most (an equal part for each language, its rarest go first), and bytes of the table of code lengths.
MAX_GRAMS = 1_000_000
TABLE_BYTES = 48 << 20
#: Evidence counts as if from so many bytes at most when code lengths become a score.
SCORE_BYTES = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_GRAMS = "lang string, gram long, n long"
OUT = "doc_id long, lang_pred string, score double, bits double"


def _joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of texts, each behind DEPTH line feeds, and the length of each with them."""
    raw = [b"\n" * DEPTH + (t or "").encode() for t in texts]
    return _LOWER[np.frombuffer(b"".join(raw), np.uint8)], np.array([len(r) for r in raw], np.int64)


def _grams(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The grams of DEPTH + 1 bytes within texts, as numbers."""
    if len(data) <= DEPTH:
        return np.empty(0, np.uint32)
    wide = data.astype(np.uint32)
    code = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
    ends = np.cumsum(lengths)
    crossing = (ends[:-1, None] - np.arange(1, DEPTH + 1)).ravel()
    keep = np.ones(len(code), bool)
    keep[crossing[crossing < len(code)]] = False
    return code[keep]


def gram_counts(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over all rows with a text and a language; counted in tasks, then summed."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, total = arrow_schema(_GRAMS), {}

        def flush(name: str) -> pa.RecordBatch:
            grams, n = _summed(total.pop(name))
            return batch_of(schema, {"lang": [name] * len(grams), "gram": grams.astype(np.int64), "n": n})

        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for name in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs, strict=True) if x == name]
                for lo, hi in passes(own):
                    total.setdefault(name, []).append(np.unique(_grams(*_joined(own[lo:hi])), return_counts=True))
                if len(total[name]) > 16:
                    total[name] = [_summed(total[name])]
                    if len(total[name][0][0]) > 1_000_000:  # a task sends on what it can't hold
                        yield flush(name)
        for name in list(total):
            yield flush(name)

    known = docs.where(f"text IS NOT NULL AND {lang} IS NOT NULL").select("text", F.col(lang).alias("lang"))
    return known.mapInArrow(count, _GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    found, at = np.unique(grams, return_inverse=True)
    return found, np.bincount(at, n, len(found)).astype(np.int64)


@dataclass
class ContextTrees:
    """Frozen code lengths of all languages.

    symbol: class of each byte (the last class is any byte that no language has seen).
    node: for each three symbols, the row of the deepest context that is kept for them.
    bits: code length of a symbol after a context, for each language.
    """

    langs: list[str]
    symbol: np.ndarray
    node: np.ndarray
    bits: np.ndarray

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Code lengths in bits (text, language) and bytes of each text."""
        totals = np.zeros((len(texts), len(self.langs)))
        sizes = np.zeros(len(texts), np.int64)
        a = int(self.symbol.max()) + 1
        for lo, hi in passes(texts):
            data, lengths = _joined(texts[lo:hi])
            s = self.symbol[data]
            context = self.node[(s[:-3] * a + s[1:-2]) * a + s[2:-1]]
            rows = context * a + s[3:]
            ends = np.cumsum(lengths)
            for k, (start, end) in enumerate(zip(ends - lengths, ends - DEPTH, strict=True)):
                for x in range(start, end, 1 << 20):
                    totals[lo + k] += self.bits[rows[x : min(end, x + (1 << 20))]].sum(0, dtype=np.float64)
            sizes[lo:hi] = lengths - DEPTH
        return totals, sizes


def context_trees(names: np.ndarray, grams: np.ndarray, counts: np.ndarray, table_bytes: int = TABLE_BYTES) -> ContextTrees:
    """Build the trees from counts of grams by language.

    In a context that n symbols followed, t of them distinct, a symbol seen c times has
    probability c / (n + t); t / (n + t) escapes to the context one byte shorter, where
    the symbols already ruled out are excluded. Below the empty context all bytes are
    alike. Bytes that no language has seen share one class, which costs each of them
    what it would alone. The contexts kept are those of the largest share in any one
    language that fit table_bytes; another is coded as its longest suffix that is kept.
    """
    if not len(grams):
        return ContextTrees([], np.zeros(256, np.int64), np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    names, lang = np.unique(names, return_inverse=True)
    langs, gram, n = names.tolist(), grams.astype(np.int64), counts.astype(np.float64)
    quad = np.stack([(gram >> s) & 255 for s in (24, 16, 8, 0)], 1)
    seen = np.unique(quad)
    a = len(seen) + 1
    symbol = np.full(256, a - 1, np.int64)
    symbol[seen] = np.arange(len(seen))
    quad = symbol[quad]
    weight = np.ones(a)
    weight[-1] = max(1, 256 - len(seen))
    room = max(1, table_bytes // (4 * a * max(1, len(langs))))

    # The contexts kept: the empty one, then the most frequent ones while they fit. One is kept
    # only if the one that it escapes to is, for that one is shorter and at least as frequent.
    found = []
    for length in range(1, DEPTH + 1):
        keys, at = np.unique(_context(quad, length, a), return_inverse=True)
        # A context counts by its share in the language that uses it most, so a rare language keeps its own.
        share = np.zeros(len(keys))
        for k in range(len(langs)):
            own = lang == k
            share = np.maximum(share, np.bincount(at[own], n[own], len(keys)) / max(n[own].sum(), 1))
        found.append((np.full(len(keys), length), keys, share))
    lengths, keys, frequency = (np.concatenate(x) for x in zip(*found, strict=True))
    top = np.lexsort((keys, lengths, -frequency))[: room - 1]
    kept = {0: (np.zeros(1, np.int64), np.zeros(1, np.int64))}  # by length: contexts in order, and their rows
    for length in range(1, DEPTH + 1):
        rank = np.flatnonzero(lengths[top] == length)
        order = np.argsort(keys[top[rank]])
        kept[length] = keys[top[rank]][order], rank[order] + 1
    size = len(top) + 1
    bits = np.zeros((size, a, len(langs)), np.float32)
    for k in range(len(langs)):
        own = lang == k
        p = np.zeros((size, a))
        for length in range(DEPTH + 1):
            keys, target = kept[length]
            if not len(keys):
                continue
            count = np.zeros((len(keys), a))
            ctx = _context(quad[own], length, a)
            at = np.searchsorted(keys, ctx)
            hit = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == ctx)
            np.add.at(count, (at[hit], quad[own][hit, 3]), n[own][hit])
            if length:
                shorter_keys, shorter_rows = kept[length - 1]
                base = p[shorter_rows[np.searchsorted(shorter_keys, keys % a ** (length - 1))]]
            else:
                base = np.full(count.shape, 1 / 256)
            t = (count > 0).sum(1, keepdims=True)
            total = count.sum(1, keepdims=True)
            left = ((count == 0) * base * weight).sum(1, keepdims=True)
            known = np.where(left > 0, total + t, total)  # nothing to escape to if every byte was seen
            with np.errstate(divide="ignore", invalid="ignore"):
                mixed = np.where(count > 0, count / known, t / known * base / left)
            p[target] = np.where(total > 0, mixed, base)
        bits[:, :, k] = -np.log2(p)
    node = np.zeros(a**3, np.int32)
    grid = np.arange(a**3)
    for length in range(1, DEPTH + 1):
        lookup = np.full(a**length, -1, np.int32)
        lookup[kept[length][0]] = kept[length][1]
        found = lookup[grid % a**length]
        node[found >= 0] = found[found >= 0]
    return ContextTrees(langs, symbol, node, bits.reshape(size * a, len(langs)))


def _context(quad: np.ndarray, length: int, a: int) -> np.ndarray:
    """The number of the context of so many symbols before each gram's last one."""
    key = np.zeros(len(quad), np.int64)
    for k in range(3 - length, 3):
        key = key * a + quad[:, k]
    return key


def fit(docs: DataFrame, lang: str = "lang", max_grams: int = MAX_GRAMS, table_bytes: int = TABLE_BYTES) -> ContextTrees:
    """Trees from all rows of docs that have a text and a language.

    Grams are counted over every whole text. If more than max_grams remain, each language
    has an equal part of them, what some do not need being shared by the others, and the
    driver receives those above the least count that lets a language's own fit.
    """
    counts = cut(gram_counts(docs, lang))
    sizes: dict[str, list] = {}
    for r in counts.groupBy("lang", F.expr("CAST(floor(log2(n) * 4) AS INT)").alias("size")).count().collect():
        sizes.setdefault(r["lang"], []).append((r["size"], r["count"]))
    least, room = [], max_grams
    for left, (name, own) in zip(range(len(sizes), 0, -1), sorted(sizes.items(), key=lambda x: (sum(c for _, c in x[1]), x[0])), strict=True):
        part, taken, low = room // left, 0, 0.0
        for size, count in sorted(own, reverse=True):
            if taken + count > part:
                low = 2 ** ((size + 1) / 4)
                break
            taken += count
        room -= taken
        least.append((name, low))
    if any(low for _, low in least):
        bounds = docs.sparkSession.createDataFrame(least, "lang string, least double")
        counts = counts.join(F.broadcast(bounds), "lang").where(F.col("n") >= F.col("least")).select("lang", "gram", "n")
    rows = counts.toArrow()
    coded = rows.column("lang").combine_chunks().dictionary_encode() if rows.num_rows else None
    names = np.array(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if rows.num_rows else np.empty(0, str)
    return context_trees(names, rows.column("gram").to_numpy(), rows.column("n").to_numpy(), table_bytes)


def predict(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """The language whose tree gives each text the shortest code.

    docs: doc_id, text, any others. A text that is NULL or has no letter is `und` with
    score 0, as is every text if no language was learned. Equal code lengths go to the
    name that sorts first. Any length is read whole. Repeated rows stay; an empty table
    gives none. score is the share of the best language when code lengths, as if from
    SCORE_BYTES bytes at most, are read as likelihoods; bits is its code length.
    """
    import regex

    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, schema, model = regex.compile(r"\p{L}"), arrow_schema(OUT), shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            read = [k for k, t in enumerate(texts) if t and model.langs and letter.search(t)]
            names, scores, best_bits = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            totals, sizes = model.score([texts[k] for k in read])
            for k, bits, size in zip(read, totals, sizes, strict=True):
                best = int(bits.argmin())
                likely = np.exp2((bits[best] - bits) * min(1.0, SCORE_BYTES / size))
                names[k], scores[k], best_bits[k] = model.langs[best], float(1 / likely.sum()), float(bits[best])
            yield batch_of(schema, {"doc_id": b.column(0), "lang_pred": names, "score": scores, "bits": best_bits})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT)


def held_out(column: str = "doc_id") -> F.Column:
    """Rows kept from learning: crc32 of the id as text leaves remainder 0 by 5. A NULL id is never held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))
