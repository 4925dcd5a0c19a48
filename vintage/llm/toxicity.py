"""Toxicity by a chain of linear classifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, batch_of, bounded_batches, cut, fnv
from vintage.llm.linear import Design, logistic, logit, sigmoid

#: Labelled texts that models are fitted on at most, those least by a hash of their id; features kept; folds.
SAMPLE = 20_000
FEATURES = 8192
FOLDS = 4
#: A feature must occur in so many texts of the sample.
LEAST_TEXTS = 4
#: The last is the label itself; the others are parts of it, told apart by the words below.
CATEGORIES = ("insult", "contempt", "other", "toxic")

# Words that tell the categories of a toxic text apart.
INSULT = frozenset("idiot idiots moron morons stupid loser losers clown clowns fool fools dumb imbecile jerk".split())
CONTEMPT = frozenset("trash scum worthless pathetic disgusting garbage filth vermin vile disgrace".split())

_TOKEN = re.compile(r"[^\W_]+")
OUT = "doc_id long, p_insult double, p_contempt double, p_other double, p_toxic double, toxic boolean"


class Features(dict):
    """Feature hashes of a token: the token, and how it begins; made anew once it has grown large."""

    def __missing__(self, token: str) -> tuple[int, ...]:
        names = [f"w {token}"] + [f"p {token[:n]}" for n in (4, 5) if len(token) > n]
        self[token] = out = tuple(fnv(n.encode(), 9) - (1 << 63) for n in names)
        return out


def tokens(text: str | None) -> set[str]:
    return set(_TOKEN.findall((text or "").lower()))


@dataclass
class Chain:
    """Weights of each category's model over text features and the log-odds of the categories before it."""

    features: dict[int, int]
    models: list[tuple[np.ndarray, float]]
    threshold: float

    def probabilities(self, design: Design) -> np.ndarray:
        dense = np.zeros((len(design), 0))
        for w, bias in self.models:
            z = design.with_dense(dense).dot(w) + bias
            dense = np.concatenate([dense, np.clip(z, -14, 14)[:, None]], 1)
        return sigmoid(dense)


def _sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> DataFrame:
    """(doc_id, text, y) of labelled texts; the ids are broadcast, size at most. An id that is labelled twice counts as toxic if once."""
    known = labels.where(f"doc_id IS NOT NULL AND {label} IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("y").cast("int").alias("y"))


def _feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, n, toxic): texts of the sample that have a feature, and the toxic ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, known = arrow_schema("feature long, n long, toxic long"), Features()
        for b in batches:
            known = Features() if len(known) > 300_000 else known
            rows = [np.array(list({f for t in tokens(x) for f in known[t]}), np.int64) for x in b.column(1).to_pylist()]
            y = np.repeat(np.array(b.column(2).to_pylist(), np.int64), [len(r) for r in rows])
            found, at = np.unique(np.concatenate([*rows, np.empty(0, np.int64)]), return_inverse=True)
            n = np.bincount(at, minlength=len(found))
            yield batch_of(schema, {"feature": found, "n": n, "toxic": np.bincount(at, y, len(found)).astype(np.int64)})

    return sample.mapInArrow(run, "feature long, n long, toxic long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def _chosen(rows: list[set[str]], features: dict[int, int], known: Features) -> list[list[int]]:
    return [sorted({features[f] for t in r for f in known[t] if f in features}) for r in rows]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, features: int = FEATURES) -> Chain:
    """Fit the chain on at most sample labelled texts.

    Features are those whose odds of being in a toxic text are over twice those of any
    text, which some reach at any share of toxic labels; the best by gain in log-likelihood stay. Each model but the first also gets the log-odds of the categories
    before it; in training these are out-of-fold, so that a later model sees them as
    wrong as they will be. The threshold is the one of best F1 out of fold.
    """
    bounded_batches(docs.sparkSession)
    taken = cut(_sample(docs, labels, label, sample))
    size = taken.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("toxic")).first()
    share = (size["toxic"] + 0.5) / (size["n"] + 1)
    p = F.col("toxic") / F.col("n")
    part = lambda n, q, base: F.when(n > 0, n * F.log(q / F.lit(base))).otherwise(0.0)
    gain = part(F.col("toxic"), p, share) + part(F.col("n") - F.col("toxic"), 1 - p, 1 - share)
    best = (
        _feature_counts(taken)
        .where((F.col("n") >= LEAST_TEXTS) & (F.col("toxic") * (1 - share) > 2 * share * (F.col("n") - F.col("toxic"))))
        .select("feature", gain.alias("gain"))
        .where("gain > 3")
        .orderBy(F.desc("gain"), "feature")
        .limit(features)
        .toArrow()
    )
    index = {f: k for k, f in enumerate(best.column("feature").to_pylist())}
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, known = arrow_schema("doc_id long, y int, kind int, at array<int>"), Features()
        for b in batches:
            known = Features() if len(known) > 300_000 else known
            found = [tokens(t) for t in b.column(1).to_pylist()]
            kind = [bool(f & INSULT) + 2 * bool(f & CONTEMPT) for f in found]
            yield batch_of(schema, {"doc_id": b.column(0), "y": b.column(2), "kind": kind, "at": _chosen(found, shared.value, known)})

    data = taken.mapInArrow(rows, "doc_id long, y int, kind int, at array<int>").toArrow().sort_by([("doc_id", "ascending"), ("kind", "ascending")])
    y, kind = (np.array(data.column(c).to_pylist(), np.int64) for c in ("y", "kind"))
    design = Design.of(data.column("at").to_pylist(), len(index))
    fold = (np.array(data.column("doc_id").to_pylist(), np.int64) * 2654435761 >> 7) % FOLDS
    targets = [y * (kind & 1), y * (kind >> 1), y * (kind == 0), y]
    models, dense = [], np.zeros((len(y), 0))
    for target in targets:
        x = design.with_dense(dense)
        out = np.zeros(len(y))
        for k in range(FOLDS):
            w, bias = logistic(x.take(fold != k), target[fold != k].astype(float))
            own = fold == k
            out[own] = x.take(own).dot(w) + bias
        models.append(logistic(x, target.astype(float)))
        dense = np.concatenate([dense, np.clip(out, -14, 14)[:, None]], 1)
    return Chain(index, models, _best_threshold(sigmoid(dense[:, -1]), y))


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold of best F1, halfway to the next probability; above all if nothing is toxic."""
    if not y.sum():
        return 1.1
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    k = int(f1.argmax())
    low, high = (p[order[k + 1]] if k + 1 < len(p) else 0.0), p[order[k]]
    return float(sigmoid((logit(np.array(low)) + logit(np.array(high))) / 2))


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """Probability of each category, and the decision, for every row.

    docs: doc_id, text, any others. A NULL text counts as empty; without features a text
    gets the share that the models start from. Whole texts are read. Repeated rows stay
    and get equal results; an empty table gives none. If no label is positive, or there
    are none at all, nothing is toxic.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, own, known = arrow_schema(OUT), shared.value, Features()
        numbers: dict[str, list[int]] = {}
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                if len(numbers) > 300_000:
                    numbers, known = {}, Features()
                found = tokens(text)
                for t in found:
                    if t not in numbers:
                        numbers[t] = [own.features[f] for f in known[t] if f in own.features]
                        del known[t]
                rows.append(sorted({f for t in found for f in numbers[t]}))
            p = own.probabilities(Design.of(rows, len(own.features)))
            columns = {f"p_{c}": p[:, k] for k, c in enumerate(CATEGORIES)}
            yield batch_of(schema, {"doc_id": b.column(0), **columns, "toxic": p[:, -1] >= own.threshold})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT)


def clean_documents(docs: DataFrame, chain: Chain) -> DataFrame:
    """Rows of docs, all columns, that the chain does not call toxic; a NULL text stays."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.pandas_udf("boolean")
    def toxic(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, known = shared.value, Features()
        for text in texts:
            known = Features() if len(known) > 300_000 else known
            rows = _chosen([tokens(t) for t in text], own.features, known)
            yield pd.Series(own.probabilities(Design.of(rows, len(own.features)))[:, -1] >= own.threshold)

    bounded_batches(docs.sparkSession)
    return docs.where(~toxic("text"))
