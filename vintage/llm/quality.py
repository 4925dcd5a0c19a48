"""Document quality by co-training a text view and a metadata view."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, batch_of, bounded_batches, cut
from vintage.llm.linear import Design, logistic, sigmoid

#: Labelled texts, and unlabelled ones, that models are fitted on at most, those least by a hash of their id.
SAMPLE = 12_000
POOL = 12_000
#: Rounds of exchange, pseudo-labels that a view passes on in each, and how sure it must be.
ROUNDS = 5
PASSED = 400
SURE = 0.9
#: Buckets of hashed metadata.
META = 512
OUT = "doc_id long, p_text double, p_meta double, score double, high_quality boolean"

_KIND = np.zeros(256, np.int64)
for _chars, _k in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3), (b" \t\n\r", 4), (b".,;:?'\"-()", 5), (b"!", 6), (b"|", 7), (b"#$%&*@^~<>{}[]=+/\\_`", 8)):
    _KIND[np.frombuffer(_chars, np.uint8)] = _k
_KIND[128:] = 9
_SENTENCE = re.compile(r"[.!?](?:\s|$)")
TEXT_VIEW = 26


def text_view(text: str | None) -> list[float]:
    """Shares of kinds of bytes, and how words, lines and sentences repeat and how long they are."""
    text = text or ""
    raw = text.encode()
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=10) / max(1, len(raw))
    words = text.split()
    lines = [s for line in text.split("\n") if (s := line.strip())]
    n, distinct, different_lines = len(words), len(set(words)), len(set(lines))
    follows = sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(1, n - 1)
    heaped = sum(not w[-1].isalnum() and not w[-2:-1].isalnum() for w in words) / max(1, n)
    upper = sum(w.isupper() for w in words) / max(1, n)
    length = len(text) / max(1, n)
    sentences = len(_SENTENCE.findall(text))
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)
    return [
        *kinds[1:],
        float(np.log1p(n)) / 10,
        distinct / max(1, n),
        distinct / max(1.0, float(n) ** 0.5) / 20,
        pairs,
        follows,
        heaped,
        upper,
        min(length, 40) / 10,
        different_lines / max(1, len(lines)),
        min(n / max(1, len(lines)), 200) / 100,
        min(n / max(1, sentences), 100) / 50,
        float(kinds[6] > 0.01),
        float(kinds[7] > 0.01),
        float(kinds[8] > 0.01),
        float(upper > 0.5),
        float(follows > 0.2),
        float(not n),
    ]


def meta_view(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    """Buckets of what is known about a document besides its text."""
    import zlib

    size = -1 if n_chars is None else int(max(0, n_chars)).bit_length()
    named = [f"lang {lang}", f"source {source}", f"size {size}", f"lang {lang} size {size}"]
    return sorted({zlib.crc32(x.encode()) % META for x in named})


@dataclass
class CoTrained:
    """Both views' weights, the text view's scale, calibrations of each and how they combine."""

    mean: np.ndarray
    scale: np.ndarray
    text: tuple[np.ndarray, float]
    meta: tuple[np.ndarray, float]
    calibrated: list[tuple[np.ndarray, float]]
    combined: tuple[np.ndarray, float]

    def score(self, text: np.ndarray, meta: Design) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = [_dense((text - self.mean) / self.scale).dot(self.text[0]) + self.text[1], meta.dot(self.meta[0]) + self.meta[1]]
        views = np.stack([_platt(z[k], self.calibrated[k]) for k in range(2)], 1)
        w, bias = self.combined
        return (*sigmoid(views).T, sigmoid(views @ w + bias))


def _dense(x: np.ndarray) -> Design:
    return Design.of([[]] * len(x), 0, x)


def _platt(z: np.ndarray, fitted: tuple[np.ndarray, float]) -> np.ndarray:
    return np.clip(z, -20, 20) * fitted[0][0] + fitted[1]


_ROWS = "doc_id long, y int, text array<double>, meta array<int>"


def _views(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_ROWS)
        for b in batches:
            text = [text_view(t) for t in b.column(2).to_pylist()]
            meta = [meta_view(*m) for m in zip(*(b.column(k).to_pylist() for k in (3, 4, 5)), strict=True)]
            yield batch_of(schema, {"doc_id": b.column(0), "y": b.column(1), "text": text, "meta": meta})

    return rows.select("doc_id", "y", "text", "lang", "source", "n_chars").mapInArrow(run, _ROWS)


def _with_metadata(docs: DataFrame) -> DataFrame:
    """docs with the columns that the views read; those that it lacks are NULL."""
    have = set(docs.columns)
    kinds = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    return docs.select(*((F.col(c) if c in have else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, pool: int = POOL, rounds: int = ROUNDS) -> CoTrained:
    """Co-train both views on at most sample labelled and pool unlabelled documents (their ids are broadcast).

    A fifth of the labelled ones is kept for calibration. In each round each view labels
    the documents of the pool that it is surest of, as many of either class as fits the
    share of classes, and the other view learns from them. In the end each view's log-odds
    are calibrated, and a logistic regression over both combines them.
    """
    bounded_batches(docs.sparkSession)
    table = _with_metadata(docs)
    known = labels.where(f"doc_id IS NOT NULL AND {label} IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    labelled = _views(table.join(F.broadcast(chosen), "doc_id"))
    ids = table.select("doc_id").where("doc_id IS NOT NULL").join(known, "doc_id", "left_anti").distinct()
    others = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(pool).withColumn("y", F.lit(-1))
    data = cut(labelled.unionAll(_views(table.join(F.broadcast(others), "doc_id")))).toArrow().sort_by([("doc_id", "ascending")])
    y = np.array(data.column("y").to_pylist(), np.int64)
    text = np.array(data.column("text").to_pylist(), np.float64).reshape(len(y), TEXT_VIEW)
    meta = Design.of(data.column("meta").to_pylist(), META)
    mean, scale = (text.mean(0), text.std(0) + 1e-6) if len(y) else (np.zeros(TEXT_VIEW), np.ones(TEXT_VIEW))
    views = [_dense((text - mean) / scale), meta]
    turn = (np.array(data.column("doc_id").to_pylist(), np.int64) * 2654435761 >> 7) % 5
    kept = (y >= 0) & (turn == 0)
    train = (y >= 0) & ~kept
    share = float(y[train].mean()) if train.any() else 0.5
    own = [np.where(train, y, -1), np.where(train, y, -1)]  # labels that each view learns from; -1: none
    models: list[tuple[np.ndarray, float]] = []
    for turn_ in range(rounds + 1):
        models = [logistic(v.take(o >= 0), o[o >= 0].astype(float)) for v, o in zip(views, own, strict=True)]
        if turn_ == rounds:
            break
        scores = [sigmoid(v.dot(m[0]) + m[1]) for v, m in zip(views, models, strict=True)]
        for k in range(2):
            free = (y < 0) & (own[1 - k] < 0)
            for value, n in ((1, round(PASSED * share)), (0, round(PASSED * (1 - share)))):
                sure = scores[k] if value else 1 - scores[k]
                best = np.argsort(np.where(free, -sure, 1), kind="stable")[:n]
                best = best[free[best] & (sure[best] >= SURE)]
                own[1 - k][best] = value
    z = [v.dot(m[0]) + m[1] for v, m in zip(views, models, strict=True)]
    held = y[kept].astype(float)
    calibrated = [logistic(_dense(np.clip(s[kept], -20, 20)[:, None]), held, l2=1e-6) for s in z]
    calibrated = [c if c[0][0] > 0 else (np.zeros(1), c[1]) for c in calibrated]  # a view that misleads says nothing
    both = np.stack([_platt(s[kept], c) for s, c in zip(z, calibrated, strict=True)], 1).reshape(-1, 2)
    return CoTrained(mean, scale, models[0], models[1], calibrated, logistic(_dense(both), held, l2=1e-3))


def score(docs: DataFrame, model: CoTrained, least: float = 0.5) -> DataFrame:
    """Calibrated probability of high quality by each view and by both, for every row.

    docs: doc_id, text, and lang, source and n_chars where known; other columns are left
    alone. NULL and empty texts and NULL metadata are values like others. Whole texts are
    read. Repeated rows stay and get equal scores; an empty table gives none. Without
    labels every score is one half.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(OUT)
        for b in batches:
            text = np.array([text_view(t) for t in b.column(1).to_pylist()], np.float64).reshape(-1, TEXT_VIEW)
            meta = Design.of([meta_view(*m) for m in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)), strict=True)], META)
            by_text, by_meta, both = shared.value.score(text, meta)
            yield batch_of(schema, {"doc_id": b.column(0), "p_text": by_text, "p_meta": by_meta, "score": both, "high_quality": both >= least})

    return _with_metadata(docs).mapInArrow(run, OUT)
