"""Line dedup by overlapping windows of three lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.functions.columns import unused
from vintage.llm.common import arrow_schema, batch_of, bounded_batches, cut, mix64, row_key

#: Lines of a window.
WINDOW = 3
BLANK = " \t\r"
_WINDOWS = "row long, doc_id long, first int, last int, window long"


def windows_of(text: str | None, size: int = WINDOW) -> tuple[list[int], list[int], np.ndarray]:
    """First and last line and hash of each window of so many consecutive lines that are not blank."""
    import xxhash

    lines = [(k, s) for k, line in enumerate((text or "").split("\n")) if (s := line.strip(BLANK))]
    n = len(lines) - size + 1
    if n <= 0:
        return [], [], np.empty(0, np.uint64)
    own = np.array([xxhash.xxh64_intdigest(s.encode(), 5) for _, s in lines], np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + mix64(own[k : k + n])
    at = [k for k, _ in lines]
    return at[:n], at[size - 1 :], mix64(total)


def repeated_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(row, starts, ends): windows of each text that also occur earlier.

    Earlier means a smaller doc_id, or the same document and an earlier line. Windows meet
    by hash: each hash that occurs again keeps its least place, a partial minimum however
    often it occurs, and joins the windows, which Spark can split where one is very common.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_WINDOWS)
        for b in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            for row, doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                first, last, window = windows_of(text, size)
                out["row"] += [row] * len(first)
                out["doc_id"] += [doc_id] * len(first)
                out["first"] += first
                out["last"] += last
                out["window"] += window.view(np.int64).tolist()
            yield batch_of(schema, out)

    keyed = docs.select(row_key().alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), "text")
    found = cut(keyed.mapInArrow(run, _WINDOWS))
    place = F.struct("doc_id", "row", "first")
    least = cut(found.groupBy("window").agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1").select("window", "least"))
    later = found.join(least, "window").where(place > F.col("least"))
    return later.groupBy("row").agg(F.array_distinct(F.collect_list(F.struct("first", "last"))).alias("_spans"))


def _without(text: str, spans: list) -> tuple[str, int]:
    """The text without the lines that spans cover, and how many those are."""
    lines = text.split("\n")
    edge = np.zeros(len(lines) + 1, np.int64)
    for s in spans:
        edge[s["first"]] += 1
        edge[s["last"] + 1] -= 1
    covered = np.cumsum(edge[:-1]) > 0
    return "\n".join(line for line, gone in zip(lines, covered.tolist(), strict=True) if not gone), int(covered.sum())


def dedup_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows of docs, all columns, with text after removal, and n_removed lines.

    Lines are what line feeds part; they are compared without spaces, tabs and carriage
    returns around them, and blank ones take no part in windows but go with a window that
    spans them. Positions that later occurrences cover are merged and removed; a text keeps
    its other lines, in order. A NULL text stays NULL with n_removed 0. Texts with fewer than
    size lines keep them all. A NULL doc_id comes before all others. Rows with one doc_id
    and different texts are different documents; equal rows count as one document, and
    each gets its result. An n_removed column of docs is replaced. Empty tables give none.
    """

    @F.pandas_udf("text string, n int")
    def clean(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = [(None, 0) if t is None else _without(t, s) for t, s in zip(text, spans, strict=True)]
        return pd.DataFrame(rows, columns=["text", "n"])

    row, line_row, covered, cleaned = (unused(docs.columns, name) for name in ("_row", "_line_row", "_covered", "_clean"))
    spans = repeated_lines(docs, size).select(F.col("row").alias(line_row), F.col("_spans").alias(covered))
    touched = F.col(covered).isNotNull()
    joined = docs.withColumn(row, row_key()).join(spans, F.col(row) == F.col(line_row), "left")
    done = joined.withColumn(cleaned, clean(F.when(touched, F.col("text")), covered))
    return done.select(
        *(F.when(touched, F.col(cleaned)["text"]).otherwise(F.col("text")).alias("text") if c == "text" else c for c in docs.columns if c != "n_removed"),
        F.when(touched, F.col(cleaned)["n"]).otherwise(0).alias("n_removed"),
    )


ORACLE = """
WITH lines AS (
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k, unnest(string_split(text, chr(10))) AS line
    FROM documents WHERE text IS NOT NULL
), trimmed AS (
    SELECT doc_id, k, trim(line, ' ' || chr(9) || chr(13)) AS s FROM lines
), windows AS (
    SELECT doc_id, k AS first, lead(k, 2) OVER w AS last, s AS a, lead(s) OVER w AS b, lead(s, 2) OVER w AS c
    FROM trimmed WHERE s <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), ranked AS (
    SELECT doc_id, first, last, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, first) AS n
    FROM windows WHERE last IS NOT NULL
), covered AS (
    SELECT DISTINCT r.doc_id, l.k FROM ranked r JOIN lines l ON l.doc_id = r.doc_id AND l.k BETWEEN r.first AND r.last
    WHERE r.n > 1
), kept AS (
    SELECT l.doc_id, count(*) AS n_lines, count(c.k) AS n_removed,
        coalesce(string_agg(CASE WHEN c.k IS NULL THEN l.line END, chr(10) ORDER BY l.k), '') AS text
    FROM lines l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.k = l.k GROUP BY l.doc_id
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, sha256(text) AS kept_sha256 FROM kept
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
