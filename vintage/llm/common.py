"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch. Texts are long, so a batch stays at some megabytes.
BATCH_ROWS = 512
#: Bytes of text that one vectorised pass in a worker handles.
PASS_BYTES = 1 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables that cut lineage: spark.checkpoint.dir, or one of our own on local masters."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="llm-tables-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: no lineage behind it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that cut() wrote; nothing may read them any more."""
    for df in tables:
        path = getattr(df, "_cut_path", None)
        if path:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def row_key() -> Column:
    """Tells rows apart by id and text; equal rows are one document."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.col("doc_id").isNull(), "text")


def row_keys(first: str = "k1", second: str = "k2") -> list[Column]:
    """128 bits that tell rows apart by id and text; equal rows are one document."""
    parts = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.col("doc_id").isNull(), F.col("text")]
    return [F.xxhash64(*parts).alias(first), F.xxhash64(F.lit("second"), *parts).alias(second)]


def unused(taken: Iterable[str], stem: str) -> str:
    """A column name that is not taken, in any case."""
    names = {c.lower() for c in taken}
    while stem.lower() in names:
        stem += "_"
    return stem


def partitions(total: int, each: int) -> int:
    return max(1, -(-int(total) // each))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes in a column of texts, from one scan."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def passes(texts: Iterable[str | None], limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit characters together (one row at least)."""
    start, size, end = 0, 0, 0
    for end, text in enumerate(texts, 1):
        size += len(text or "")
        if size >= limit:
            yield start, end
            start, size = end, 0
    if start < end:
        yield start, end


_TYPES = {
    "int": pa.int32(),
    "long": pa.int64(),
    "float": pa.float32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of "name type, name type"; workers have no session to ask."""
    return pa.schema([(name, _TYPES[kind]) for name, kind in (field.split() for field in schema.split(","))])


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply fn to columns of each Arrow batch; fn returns columns of a new one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = arrow_schema(schema)
        for batch in batches:
            yield batch_of(arrow, fn(batch.to_pydict()))

    return df.mapInArrow(run, schema)


def ragged_take(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The concatenation of flat[starts[i] : starts[i] + lengths[i]] over i in index."""
    n = lengths[index]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[index] - ends + n, n) + np.arange(total)]


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal values in a sorted array."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut_at = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.r_[0, cut_at], np.r_[cut_at, len(keys)]


def mix64(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def fnv(token: bytes, seed: int) -> int:
    """A 64-bit hash of a token that every worker computes alike."""
    import xxhash

    return xxhash.xxh64_intdigest(token, seed)
