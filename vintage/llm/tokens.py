"""BPE encoding and decoding through a table of distinct words."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, bounded_batches, partitions, ragged_take, text_bytes

#: Bytes of text in a chunk of documents, and words in a bucket of the word table (by bytes of text that feed it).
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20

# The byte-level splitting pattern, spelled out for code points below U+0180.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_DIGITS = "0-9²³¹¼½¾"
_SPACE = "\t\n\x0b\x0c\r \x85\xa0"
_LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^{_SPACE}{_LETTERS}{_DIGITS}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)

_DOCS = "chunk int, doc_id long, packed binary"
_WORDS = "bucket int, chunk int, words binary"
_IDS = "chunk int, bucket int, ids binary"
OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, text string, ids binary"


class Codec:
    """A tokenizer file of the tokenizers library, opened once in each worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.added = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def split(self, text: str) -> list[str]:
        """Words and added tokens of a text; joined they give the text."""
        if self.special is None or not any(t in text for t in self.added):
            return self._split(text)
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            out += [part] if k % 2 else self._split(part) if part else []
        return out

    def _split(self, text: str) -> list[str]:
        raw = text.encode()
        if text.isascii() or np.frombuffer(raw, np.uint8).max(initial=0) <= 0xC5:  # below U+0180
            return _LATIN.findall(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch(words, add_special_tokens=False)]

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all pieces, and where each id's piece starts and how long it is."""
        alphabet = _byte_alphabet()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        table = [b""] * (max(vocab.values(), default=-1) + 1)
        for piece, i in vocab.items():
            table[i] = piece.encode() if piece in self.added else bytes(alphabet[c] for c in piece)
        lengths = np.array([len(p) for p in table], np.int64)
        return np.frombuffer(b"".join(table), np.uint8), np.cumsum(lengths) - lengths, lengths


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _bucket_of(words: list[str], buckets: int) -> np.ndarray:
    import zlib

    return np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), np.int64, len(words))


def _by_bucket(words: Iterable[str], buckets: int) -> list[list[str]]:
    """The distinct words of a chunk by bucket, each list in order."""
    ordered = sorted(words)
    at = _bucket_of(ordered, buckets)
    out: list[list[str]] = [[] for _ in range(buckets)]
    for word, b in zip(ordered, at.tolist(), strict=True):
        out[b].append(word)
    return out


def _pack(words: list[str]) -> bytes:
    import zstandard

    raw = [w.encode() for w in words]
    lengths = np.array([len(w) for w in raw], np.uint32).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(np.uint32(len(raw)).tobytes() + lengths + b"".join(raw))


def _unpack(blob: bytes) -> list[str]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw[:4], np.uint32)[0])
    ends = (np.cumsum(np.frombuffer(raw[4 : 4 + 4 * n], np.uint32).astype(np.int64)) + 4 + 4 * n).tolist()
    starts = [4 + 4 * n, *ends]
    return [raw[a:b].decode() for a, b in zip(starts, ends, strict=False)]


def encode_decode(docs: DataFrame, tokenizer: str, keep: bool = False) -> DataFrame:
    """Encode and decode every text as the tokenizer file says.

    The texts are dealt once, compressed, to chunks of CHUNK_BYTES. Each chunk's distinct
    words go to buckets by their hash; a bucket encodes each of its distinct words once
    and answers with the ids in the order of the chunk's words; the chunk joins the ids
    back to the positions of its texts and decodes them by the table of pieces, which is
    as long as the vocabulary. Chunks and buckets follow the bytes of text, so that no
    task holds more at a larger input.

    docs: doc_id, text, any others. A NULL text counts as empty: no ids, and an empty
    decoded text. Repeated rows and rows of one doc_id are encoded row by row; a NULL
    doc_id stays NULL. A text may be of any length. An empty table gives no rows.
    Returns OUT: text (decoded) and ids (little-endian unsigned 32-bit) are NULL unless keep.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    total = text_bytes(docs)
    chunks, buckets = partitions(total, CHUNK_BYTES), partitions(total, BUCKET_BYTES)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdCompressor(level=3)
        schema = arrow_schema(_DOCS)
        for b in batches:
            packed = [z.compress((t or "").encode()) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], schema=schema)

    dealt = (
        docs.select(F.expr(f"CAST(pmod(xxhash64(doc_id, text), {chunks}) AS INT)").alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(pack, _DOCS)
        .repartition(chunks, "chunk")
    )

    def chunk_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (codec, z), found = _worker_codec(tokenizer), {}
        for b in batches:
            for chunk, packed in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                found.setdefault(chunk, set()).update(codec.split(z.decompress(packed).decode()))
        schema = arrow_schema(_WORDS)
        for chunk in list(found):
            lists = _by_bucket(found.pop(chunk), buckets)
            rows = [(k, chunk, _pack(w)) for k, w in enumerate(lists) if w]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        codec, z, known, now = _worker_codec(tokenizer)[0], zstandard.ZstdCompressor(level=1), {}, None
        schema = arrow_schema(_IDS)
        for b in batches:
            for bucket, chunk, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bucket != now:
                    known, now = {}, bucket
                words = _unpack(blob)
                fresh = [w for w in words if w not in known]
                for k in range(0, len(fresh), 5000):
                    part = fresh[k : k + 5000]
                    for w, ids in zip(part, codec.encode(part), strict=True):
                        known[w] = np.array(ids, np.uint32).tobytes()
                got = [known[w] for w in words]
                lengths = np.array([len(i) // 4 for i in got], np.uint32).tobytes()
                packed = z.compress(lengths + b"".join(got))
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((chunk, bucket, packed), schema, strict=True)], schema=schema)

    encoded = dealt.mapInArrow(chunk_words, _WORDS).repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(encode_words, _IDS).repartition(chunks, "chunk")

    def join_back(texts: pa.Table, tables: pa.Table) -> pa.Table:
        codec, z = _worker_codec(tokenizer)
        piece_bytes, piece_start, piece_len = codec.table
        number: dict[str, int] = {}  # one string for each distinct word, not for each position
        positions = [
            np.array([number.setdefault(w, len(number)) for w in codec.split(z.decompress(p).decode())], np.int32)
            for p in texts.column("packed").to_pylist()
        ]
        lists = _by_bucket(number, buckets)
        order, flat, lens = [np.empty(0, np.int64)], [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for bucket, blob in sorted(zip(tables.column("bucket").to_pylist(), tables.column("ids").to_pylist(), strict=True)):
            words, lists[bucket] = lists[bucket], []
            raw = np.frombuffer(z.decompress(blob), np.uint32)
            n = raw[: len(words)].astype(np.int64)
            if int(n.sum()) + len(words) != len(raw):
                raise ValueError("a chunk's words do not fit the ids that came back")
            order.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            lens.append(n)
            flat.append(raw[len(words) :])
        ids_flat, came = np.concatenate(flat), np.concatenate(lens)
        lengths, starts = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        lengths[np.concatenate(order)], starts[np.concatenate(order)] = came, np.cumsum(came) - came
        del number, lists
        out: dict[str, list] = {f.name: [] for f in arrow_schema(OUT)}
        for doc_id, at in zip(texts.column("doc_id").to_pylist(), positions, strict=True):
            ids = ragged_take(ids_flat, starts, lengths, at)
            decoded = ragged_take(piece_bytes, piece_start, piece_len, ids.astype(np.int64)).tobytes()
            text = decoded.decode("utf-8", "replace")
            out["doc_id"].append(doc_id)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
            out["text"].append(text if keep else None)
            out["ids"].append(ids.astype("<u4").tobytes() if keep else None)
        return pa.Table.from_pydict(out, schema=arrow_schema(OUT))

    return dealt.groupBy("chunk").cogroup(encoded.groupBy("chunk")).applyInArrow(join_back, OUT)


_CODECS: dict[str, tuple] = {}


def _worker_codec(path: str) -> tuple:
    """The codec of this worker; opened at the first chunk and kept for the next."""
    import zstandard

    if path not in _CODECS:
        codec = Codec(path)
        codec.table = codec.pieces()
        _CODECS[path] = (codec, zstandard.ZstdDecompressor())
    return _CODECS[path]
