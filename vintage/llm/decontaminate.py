"""Benchmark decontamination by template windows with slot checks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, batch_of, bounded_batches, cut, fnv, mix64, passes, row_key

#: Tokens of a template window, fixed words it must have, and share of an item's windows that must be found.
WINDOW = 6
FIXED_WORDS = 3
SHARE = 0.6
#: Tokens by which windows of one alignment may drift apart, and share of an item's slots that must agree.
DRIFT = 4
AGREE = 0.5
#: Bits that a window's hash has in the filter that texts meet before the join.
FILTER_BITS = 22

# Words that stand for numbers (the first of them have one digit), and units when a number comes before them.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
SMALL_WORDS = frozenset("zero one two three four five six seven eight nine".split())
UNITS = frozenset(
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds "
    "ounce ounces oz ton tons ml l liter liters litre litres gallon gallons second seconds s minute minutes min hour hours "
    "h hr hrs day days week weeks month months year years cent cents dollar dollars euro euros usd eur percent degree "
    "degrees celsius fahrenheit mph kmh watt watts volt volts joule joules newton newtons meter meters metre metres".split()
)
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:\n]")
WORD, CAPITAL, NUMBER, MARK, UNIT = range(5)
_SLOT = {"number": 1, "name": 2, "unit": 3}
_HITS = "row long, doc_id long, plain boolean, at long, window long, slots array<long>"


class Vocabulary(dict):
    """Numbers of tokens, with the hash, kind and case (1: has small letters, 2: capitals only) of each, and whether it is a number of one digit; made anew once it has grown large."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes: list[int] = []
        self.kinds: list[int] = []
        self.cases: list[int] = []
        self.small: list[bool] = []

    def __missing__(self, token: str) -> int:
        low = token.lower()
        if token in ".!?:\n":
            kind = MARK
        elif token[0].isdigit() or low in NUMBER_WORDS:
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        else:
            kind = CAPITAL if token[0].isupper() else WORD
        self[token] = number = len(self.hashes)
        self.hashes.append(fnv(low.encode(), 3))
        self.kinds.append(kind)
        self.small.append(kind == NUMBER and (len(token) == 1 or low in SMALL_WORDS))
        self.cases.append(int(token != token.upper()) + 2 * int(token.isupper() and len(token) > 1))
        return number


def templates(texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
    """Tokens of all texts as templates: text, hash with typed placeholders, slot type (0: none), slot value (odd: a number of one digit).

    Numbers, units after numbers, and capitalised words that do not begin a sentence are
    slots; a run of such words is one name, a run of numbers one number. Capitals tell no names in a sentence that has
    nothing else. Two more arrays hold all words and numbers as they are, whatever their
    case: text, hash.
    """
    found = [_TOKEN.findall(t or "") for t in texts]
    ids = np.array([n for f in found for n in map(vocabulary.__getitem__, f)], np.int64)
    text = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    hashes = np.array(vocabulary.hashes, np.uint64)[ids]
    kind = np.array(vocabulary.kinds, np.int64)[ids]
    before = np.full(len(ids), MARK)
    before[1:] = np.where(text[1:] == text[:-1], kind[:-1], MARK)
    slot = np.zeros(len(ids), np.int64)
    slot[kind == NUMBER] = _SLOT["number"]
    slot[(kind == UNIT) & (before == NUMBER)] = _SLOT["unit"]
    case = np.array(vocabulary.cases, np.int64)[ids]
    starts = kind == MARK
    starts[1:] |= text[1:] != text[:-1]
    sentence = np.cumsum(starts)
    small, large = (np.bincount(sentence, case == c) for c in (1, 2))
    shouted = ((small == 0) & (large > 1))[sentence] if len(ids) else starts
    slot[(kind == CAPITAL) & (before != MARK) & ~shouted] = _SLOT["name"]
    runs_on = np.zeros(len(ids), bool)
    runs_on[1:] = ((slot[1:] == _SLOT["name"]) | (slot[1:] == _SLOT["number"])) & (slot[1:] == slot[:-1]) & (text[1:] == text[:-1])
    keep = (kind != MARK) & ~runs_on
    group = np.cumsum(~runs_on) - 1
    place = np.arange(len(ids)) - np.flatnonzero(~runs_on)[group] if len(ids) else np.empty(0, np.int64)
    value = np.zeros(int(group[-1]) + 1 if len(ids) else 0, np.uint64)
    np.add.at(value, group, hashes * (2 * place + 1).astype(np.uint64))
    small = np.bincount(group, ~np.array(vocabulary.small, bool)[ids], len(value)) == 0
    value, small = value[group[keep]], small[group[keep]]
    said = kind != MARK
    plain = text[said], mix64(hashes[said] ^ np.uint64(0xA24BAED4963EE407))
    slot, hashes = slot[keep], hashes[keep]
    typed = np.where(slot > 0, mix64(slot.astype(np.uint64) + np.uint64(17)), hashes)
    value = mix64(value + slot.astype(np.uint64)) & ~np.uint64(1) | (small & (slot > 0)).astype(np.uint64)
    return text[keep], typed, slot, value, *plain


def windows(text: np.ndarray, typed: np.ndarray, slot: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of windows within texts that have FIXED_WORDS words besides slots (all of them, if shorter)."""
    n = len(text) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    words = np.zeros(n, np.int64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + typed[k : k + n]
        words += slot[k : k + n] == 0
    good = (text[:n] == text[width - 1 :]) & (words >= min(width, FIXED_WORDS))
    return np.flatnonzero(good), mix64(total[good] + np.uint64(width))


def _template_windows(rows: DataFrame, widths: list[tuple[bool, int]], bitmap=None) -> DataFrame:
    """Windows (row, doc_id, plain, at, window, slots) of rows (row, doc_id, text); at counts tokens from the text's begin.

    widths: whether of plain words or of templates, and how many tokens. slots: type and place of each slot in turn with its value. With a bitmap only windows that it may hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, vocabulary = arrow_schema(_HITS), Vocabulary()
        bits = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for b in batches:
            rows_, ids, texts = (c.to_pylist() for c in b.columns)
            for lo, hi in passes(texts):
                if len(vocabulary.hashes) > 300_000:
                    vocabulary = Vocabulary()
                text, typed, slot, value, words_text, words = templates(texts[lo:hi], vocabulary)
                none = np.zeros(len(words), np.int64)
                for plain, width in widths:
                    own_text, own_slot = (words_text, none) if plain else (text, slot)
                    first = np.searchsorted(own_text, np.arange(hi - lo))
                    at, hashed = windows(own_text, words if plain else typed, own_slot, width)
                    if bits is not None:
                        key = (hashed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                        own = (bits[key >> 3] >> (key & 7).astype(np.uint8)) & 1 == 1
                        at, hashed = at[own], hashed[own]
                    if len(at):
                        slots = [[] if plain else value[a : a + width][slot[a : a + width] > 0].view(np.int64).tolist() for a in at]
                        yield batch_of(
                            schema,
                            {
                                "row": [rows_[lo + t] for t in own_text[at]],
                                "doc_id": [ids[lo + t] for t in own_text[at]],
                                "plain": [plain] * len(at),
                                "at": at - first[own_text[at]],
                                "window": hashed.view(np.int64),
                                "slots": slots,
                            },
                        )

    return rows.select("row", "doc_id", "text").mapInArrow(run, _HITS)


def _template_lengths(items: DataFrame) -> DataFrame:
    """(row, plain, tokens): how many tokens each item has as plain words and as a template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, vocabulary = arrow_schema("row long, plain boolean, tokens long"), Vocabulary()
        for b in batches:
            found = templates(b.column(1).to_pylist(), vocabulary)
            for plain, text in ((False, found[0]), (True, found[4])):
                yield batch_of(schema, {"row": b.column(0), "plain": [plain] * b.num_rows, "tokens": np.bincount(text, minlength=b.num_rows)})

    return items.select("row", "text").mapInArrow(run, "row long, plain boolean, tokens long")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """Items found in documents: (row, doc_id, item_id, at, found, of).

    Templates of both sides are cut into windows; windows of texts that the filter of the
    benchmark's windows lets through (it loses none) join them by hash. Items of one
    template whose slots repeat alike are one class, joined once. Windows of one text and
    class that lie equally far apart in both, give or take DRIFT tokens, form an alignment.
    It counts if the share of the item's windows is found, and if slots are consistent: a
    slot value of the item always meets the same value in the text. Numbers of one digit
    stand in two roles by chance; they may meet several, of which the most frequent agrees,
    if AGREE of all slots do. So a question with other numbers or names counts as well as a verbatim one.
    found: windows in the alignment, at: its first token. An item shorter than a window is one window. Besides
    templates, plain words are matched in the same way, without regard to case, marks and
    slots, so that a verbatim item is found however it is written.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = cut(benchmark.where("text IS NOT NULL").select(F.xxhash64("item_id", "text").alias("row"), F.col("item_id").cast("long").alias("doc_id"), "text").distinct())
    lengths = cut(_template_lengths(items).where("tokens > 0").distinct())
    widths = sorted((r[0], r[1]) for r in lengths.select("plain", F.least("tokens", F.lit(window)).alias("w")).distinct().collect())
    sized = items.join(lengths, "row")
    asked = None
    for plain, width in widths:  # only short items have a width of their own
        own = sized.where((F.least("tokens", F.lit(window)) == width) & (F.col("plain") == plain))
        part = _template_windows(own, [(plain, width)])
        asked = part if asked is None else asked.unionAll(part)
    keyed = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    if asked is None:
        return spark.createDataFrame([], "row long, doc_id long, item_id long, at long, found long, of long")
    asked = cut(asked)
    buckets = asked.select(F.expr(f"CAST(shiftrightunsigned(window, {64 - FILTER_BITS}) AS INT)").alias("k")).distinct().toArrow()
    flags = np.zeros(1 << FILTER_BITS, np.uint8)
    flags[buckets.column("k").to_numpy()] = 1
    bitmap = spark.sparkContext.broadcast(np.packbits(flags, bitorder="little").tobytes())
    seen = _template_windows(keyed, widths, bitmap)
    classes = cut(_item_classes(asked))
    wanted = classes.select("class", "of", F.explode("windows").alias("w")).select("class", "of", F.col("w.at").alias("item_at"), F.col("w.window").alias("window"), F.col("w.roles").alias("roles"))
    met = seen.join(wanted, "window").withColumn("lead", F.col("at") - F.col("item_at"))
    # One lead alone, and two rows of bands, one half a band further, so that any DRIFT of leads lies within a band.
    bands = F.array(F.col("lead") * 3, *(F.floor((F.col("lead") + shift) / (2 * DRIFT)) * 3 + k for k, shift in ((1, 0), (2, DRIFT))))
    pairs = F.arrays_zip(F.col("roles").alias("i"), F.col("slots").alias("d"))
    aligned = (
        met.withColumn("band", F.explode(bands))
        .groupBy("row", "doc_id", "class", "of", "band")
        .agg(F.least(F.countDistinct("item_at"), F.countDistinct("at")).alias("found"), F.min("lead").alias("at"), F.flatten(F.collect_list(pairs)).alias("pairs"))
        .where(F.col("found") >= F.col("of") * share)
    )
    different = F.array_distinct("pairs")
    bound = F.filter(different, lambda d: d["i"] > 0)
    strict = F.size(bound) == F.size(F.array_distinct(F.transform(bound, lambda d: d["i"])))
    loose = F.filter("pairs", lambda p: p["i"] < 0)
    often = F.transform(F.array_distinct(loose), lambda d: F.struct(d["i"].alias("i"), F.size(F.filter(loose, lambda p: p == d)).alias("n")))
    best = F.transform(F.array_distinct(F.transform(loose, lambda p: p["i"])), lambda i: F.array_max(F.transform(F.filter(often, lambda m: m["i"] == i), lambda m: m["n"])))
    agreeing = F.size("pairs") - F.size(loose) + F.aggregate(best, F.lit(0), lambda total, n: total + n)
    consistent = strict & (agreeing >= F.size("pairs") * AGREE)
    held = aligned.where(consistent).select("row", "doc_id", "class", "at", "found", "of").distinct()
    return held.join(classes.select("class", "items"), "class").select("row", "doc_id", F.explode_outer("items").alias("item_id"), "at", "found", "of")


def _item_classes(asked: DataFrame) -> DataFrame:
    """(class, items, windows, of): items whose windows are the same and whose slots hold equal values at the same places.

    windows: array of (at, window, roles); roles number the item's different slot values, below zero those that bind nothing.
    A class lists its items' different ids (none, if they are NULL).
    """
    own = asked.groupBy("row", "plain", "doc_id").agg(F.sort_array(F.collect_set(F.struct("at", "window", "slots"))).alias("w"))
    values = own.withColumn("values", F.array_distinct(F.flatten("w.slots")))
    numbered = F.transform(
        "w", lambda w: F.struct(w["at"].alias("at"), w["window"].alias("window"), F.transform(w["slots"], lambda v: F.array_position("values", v) * F.when(v % 2 == 0, 1).otherwise(-1)).alias("roles"))
    )
    alike = values.select("plain", numbered.alias("windows"), "doc_id").groupBy("plain", "windows").agg(F.collect_set("doc_id").alias("items"))
    return alike.select(F.xxhash64("plain", "windows").alias("class"), "items", "windows", F.size("windows").cast("long").alias("of"))


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(row, item_ids) of documents that hold items of the benchmark."""
    return matches(docs, benchmark, window, share).groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids) of every document.

    docs: doc_id, text; benchmark: item_id, text; any other columns are left alone. NULL
    and empty texts and items match nothing. Rows with one doc_id are judged by their own
    text; equal rows all get the same result. A NULL item_id contaminates without being
    listed. An empty benchmark leaves all clean; an empty table gives none. Texts of any
    length are read whole.
    """
    found = leaks(docs, benchmark, window, share)
    narrow = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    return narrow.join(found, "row", "left").select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """Rows of docs, all columns, that hold no item of the benchmark."""
    found = leaks(docs, benchmark, window, share).select(F.col("row").alias("_leak_row"))
    return docs.join(found, row_key() == F.col("_leak_row"), "left_anti")
