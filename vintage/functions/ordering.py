"""Ranks, running totals and exact quantiles without a single-task window.

A plain ``ORDER BY`` window without partition keys, or one whose partition key
is hot, sends all its rows to one task. Everything here first splits the order
into buckets by a deterministic, monotone function of the ordering value. Only
the bucket totals (a bounded number of rows per key) go through a global
window; rows themselves are ordered within (key, bucket). Bucket membership
depends on values only, so a lost executor recomputes the same buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.functions.columns import BATCH, batches, melt, row_hash

# Up to this many rows Spark's own percentile() is used. It keeps a map of all
# distinct values in one task, so the map entries per job are bounded as well.
EXACT_ROWS = 1_000_000
EXACT_CELLS = 4_000_000
# Rows that one bucket of an order holds, so the number of buckets follows the table.
SINGLE_TASK_ROWS = 1_000_000
BROADCAST_ROWS = 500_000
MAX_BUCKETS = 8192
ACCURACY = 10_000
HASH_BITS = 16


def buckets_for(rows: int) -> int:
    return max(1, min(MAX_BUCKETS, rows // max(SINGLE_TASK_ROWS, 10)))


def cut_points(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """Values that split ``value`` into even buckets, as many as its rows fill.

    The table is counted first, which reads no more than its filter columns; one
    that fills a single bucket needs no sketch.
    """
    buckets = buckets_for(df.count()) if buckets is None else buckets
    if buckets == 1:
        return []
    probs = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    sketch = F.expr(f"percentile_approx(CAST(`{value}` AS DOUBLE), array({probs}), {ACCURACY})")
    found = df.agg(sketch).head()[0]
    return sorted({x for x in found or [] if math.isfinite(x)})


def _with_bucket(df: DataFrame, value: str, cuts: Sequence[float]) -> DataFrame:
    if not cuts:
        return df.withColumn("_bucket", F.lit(0))
    keyed = df.withColumn("_order", F.col(value).cast("double"))
    found = Bucketizer(
        splits=[-math.inf, *cuts, math.inf], inputCol="_order", outputCol="_bucket", handleInvalid="keep"
    ).transform(keyed)
    # Never NULL, or the join below would push a NULL filter into one of its two
    # readers of the groups and keep Spark from sharing their shuffle.
    bucket = F.coalesce(F.col("_bucket").cast("int"), F.lit(-1))
    return found.withColumn("_bucket", bucket).drop("_order")


def _grouped(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add ``_by``: the keys as one value that is never NULL.

    Equality of such values lets NULL keys match, and joins, groups and windows on
    it ask for the same partitioning; a null-safe join on the keys would not.
    """
    return df.withColumn("_by", F.struct(*by)) if by else df


def _join_offsets(rows: DataFrame, offsets: DataFrame, by: Sequence[str],
                  few: bool = False) -> DataFrame:
    """Attach per-(by, bucket) offsets.

    Without keys the offsets are one row per bucket, at most 2 ** HASH_BITS, so
    they are broadcast. With keys that takes a bound the caller knows (``few``);
    else Spark decides, and a shuffled join leaves rows where the window after
    it needs them.
    """
    on = ["_by", "_bucket"] if by else ["_bucket"]
    right = offsets.drop(*by)
    return rows.join(F.broadcast(right) if few or not by else right, on)


def _slots(by: Sequence[str]) -> list[str]:
    return ["_by", "_bucket"] if by else ["_bucket"]


def running_totals(
    groups: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Add ``cum_<s>`` (inclusive) and ``all_<s>`` for each column of ``sums``.

    ``groups`` holds one row per distinct (by, order), already aggregated.
    """
    if cuts is None:
        cuts = cut_points(groups, order)
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    part = ["_by"] if by else [F.lit(0)]
    whole = Window.partitionBy(*part)
    if not cuts:
        # A single bucket starts at zero: no totals are joined, which Spark would broadcast as a page of memory.
        upto = whole.orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = _grouped(groups, by).withColumns(
            {**{f"all_{s}": F.sum(s).over(whole) for s in sums}, **{f"cum_{s}": F.sum(s).over(upto) for s in sums}}
        )
        return ranked.drop("_by")
    rows = _grouped(_with_bucket(groups, order, cuts), by)
    totals = rows.groupBy(*_slots(by)).agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = whole.orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *_slots(by),
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(whole).alias(f"all_{s}") for s in sums],
    )
    inside = Window.partitionBy(*_slots(by)).orderBy(direction(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    joined = _join_offsets(rows, offsets, by)
    out = joined.withColumns({f"cum_{s}": F.col(f"_o_{s}") + F.sum(s).over(inside) for s in sums})
    return out.drop("_by", "_bucket", *[f"_o_{s}" for s in sums])


def _hash_offsets(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    counts = rows.groupBy(*_slots(by)).agg(F.count("*").alias("_size"))
    part = ["_by"] if by else [F.lit(0)]
    w = Window.partitionBy(*part).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_start", F.coalesce(F.sum("_size").over(w), F.lit(0)))


def _with_hash(df: DataFrame, key: Sequence[str], seed: int, bits: int) -> DataFrame:
    hashed = df.withColumn("_hash", row_hash(df, key, seed))
    bucket = F.shiftright("_hash", 64 - bits) if bits else F.lit(0).cast("long")
    return hashed.withColumn("_bucket", bucket)


def hash_rank(df: DataFrame, key: Sequence[str], by: Sequence[str] = (), seed: int = 42,
              out: str = "rank", bits: int = HASH_BITS) -> DataFrame:
    """Exact 1-based position of each row in a seeded shuffle of its group.

    ``key`` identifies a row, so the shuffle is the same on every run.
    """
    rows = _grouped(_with_hash(df, key, seed, bits), by)
    joined = _join_offsets(rows, _hash_offsets(rows, by).drop("_size"), by)
    w = Window.partitionBy(*_slots(by)).orderBy("_hash", *key)
    ranked = joined.withColumn(out, F.col("_start") + F.row_number().over(w))
    return ranked.drop("_hash", "_by", "_bucket", "_start")


def take_by_hash(df: DataFrame, key: Sequence[str], n: int | None = None,
                 quotas: DataFrame | None = None, by: Sequence[str] = (), seed: int = 42,
                 bits: int = HASH_BITS, total: int | None = None) -> DataFrame:
    """Exactly ``n`` seeded-random rows, or ``quota`` rows of each group.

    Buckets that start past the quota are dropped before any row is shuffled
    for ranking, so only about the sample itself is ordered.
    ``quotas`` has one row per group: the ``by`` columns and ``quota``;
    ``total`` is their sum if known. Each kept bucket but the last of a group
    holds a row of the sample, so there are at most ``total`` of them plus one
    per group: below BROADCAST_ROWS they go to the rows, not the rows to them.
    """
    rows = _grouped(_with_hash(df, key, seed, bits), by)
    offsets = _hash_offsets(rows, by).drop("_size")
    if quotas is None:
        offsets = offsets.withColumn("quota", F.lit(n).cast("long"))
    else:
        offsets = offsets.join(_grouped(quotas, by).select("_by", "quota"), "_by")
    offsets = offsets.filter(F.col("_start") < F.col("quota"))
    few = total is not None and total <= BROADCAST_ROWS
    joined = _join_offsets(rows, offsets, by, few)
    w = Window.partitionBy(*_slots(by)).orderBy("_hash", *key)
    ranked = joined.withColumn("_rank", F.col("_start") + F.row_number().over(w))
    kept = ranked.filter(F.col("_rank") <= F.col("quota"))
    return kept.drop("_hash", "_by", "_bucket", "_start", "quota", "_rank")


def _lerp(lo: float, hi: float, pos: float) -> float:
    return lo + (hi - lo) * (pos - math.floor(pos))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    counts: dict[str, int] | None = None,
    limit: int | None = None,
) -> dict[str, list[float] | None]:
    """Interpolated quantiles of whole columns, a few doubles per column.

    ``counts`` are non-NULL counts if the caller has them already; ``limit``
    overrides EXACT_ROWS.
    """
    limit = EXACT_ROWS if limit is None else limit
    columns = list(columns)
    if not columns:
        return {}
    if counts is None:
        counts = non_null_counts(df, columns)
    out: dict[str, list[float] | None] = {c: None for c in columns if not counts[c]}
    small = [c for c in columns if 0 < counts[c] <= limit]
    width = max(1, EXACT_CELLS // max([counts[c] for c in small], default=1))
    for batch in batches(small, min(width, BATCH)):
        row = df.agg(
            *[F.percentile(F.col(c).cast("double"), list(map(float, probs))).alias(c) for c in batch]
        ).head()
        out.update({c: list(row[c]) for c in batch})
    large = [c for c in columns if counts[c] > limit]
    for batch in batches(large, 10):
        out.update(_bracketed_quantiles(df, batch, probs, counts))
    return out


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    found: dict[str, int] = {}
    for batch in batches(columns):
        found.update(df.agg(*[F.count(c).alias(c) for c in batch]).head().asDict())
    return found


def _bracketed_quantiles(df, columns, probs, counts):
    """Bracket each quantile with a sketch, then order only the bracketed values.

    Pass 1 sketches [p - eps, p + eps]; pass 2 counts the values below each
    bracket; pass 3 ranks the few values inside. A bracket that turns out not
    to hold its rank is widened to the whole column.
    """
    eps = 2.0 / ACCURACY
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        edges = [e for p in probs for e in (max(p - eps, 0.0), min(p + eps, 1.0))]
        aggs += [
            F.percentile_approx(x, edges, ACCURACY).alias(f"e_{c}"),
            F.min(x).alias(f"lo_{c}"),
            F.max(x).alias(f"hi_{c}"),
        ]
    row = df.agg(*aggs).head()
    slots = []
    for c in columns:
        for i, p in enumerate(probs):
            lo, hi = row[f"e_{c}"][2 * i : 2 * i + 2]
            lo = row[f"lo_{c}"] if p <= eps else lo
            hi = row[f"hi_{c}"] if p >= 1 - eps else hi
            pos = (counts[c] - 1) * p
            slots.append({"c": c, "i": i, "pos": pos, "lo": lo, "hi": hi})

    def inside(s):
        x = F.col(s["c"]).cast("double")
        return (x >= s["lo"]) & (x <= s["hi"])

    tally = df.agg(
        *[F.count_if(F.col(s["c"]).cast("double") < s["lo"]).alias(f"b{j}") for j, s in enumerate(slots)],
        *[F.count_if(inside(s)).alias(f"n{j}") for j, s in enumerate(slots)],
    ).head()
    for j, s in enumerate(slots):
        s["below"] = tally[f"b{j}"]
        if not s["below"] <= math.floor(s["pos"]) <= math.ceil(s["pos"]) < s["below"] + tally[f"n{j}"]:
            s.update(lo=row[f"lo_{s['c']}"], hi=row[f"hi_{s['c']}"], below=0)

    cells = F.array(
        *[
            F.when(inside(s), F.struct(F.lit(j).alias("slot"), F.col(s["c"]).cast("double").alias("value")))
            for j, s in enumerate(slots)
        ]
    )
    values = (
        df.select(F.inline(F.array_compact(cells)))
        .groupBy("slot", "value")
        .agg(F.count("*").alias("n"))
    )
    ranked = running_totals(values, "value", ["n"], by=["slot"])
    first = F.create_map(*[F.lit(v) for j, s in enumerate(slots) for v in (j, math.floor(s["pos"]) - s["below"])])
    second = F.create_map(*[F.lit(v) for j, s in enumerate(slots) for v in (j, math.ceil(s["pos"]) - s["below"])])
    picked = (
        ranked.groupBy("slot")
        .agg(
            F.min(F.when(F.col("cum_n") > first[F.col("slot")], F.col("value"))).alias("lo"),
            F.min(F.when(F.col("cum_n") > second[F.col("slot")], F.col("value"))).alias("hi"),
        )
        .collect()
    )
    out = {c: [0.0] * len(probs) for c in columns}
    for r in picked:
        s = slots[r["slot"]]
        out[s["c"]][s["i"]] = _lerp(r["lo"], r["hi"], s["pos"])
    return out


def grouped_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str],
                      probs: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles per group: by..., column, n, q0, q1, ...

    Equal values are counted before the shuffle and a hot group is ordered by
    many tasks, so no group has to fit one task.
    """
    cells = melt(df, columns, keep=by)
    counts = cells.groupBy(*by, "column", "value").agg(F.count("*").alias("n"))
    cuts = cut_points(cells, "value")
    ranked = running_totals(counts, "value", ["n"], by=[*by, "column"], cuts=cuts)
    value, cum = F.col("value"), F.col("cum_n")
    aggs: list[Column] = [F.max("all_n").alias("n")]
    for i, p in enumerate(probs):
        pos = (F.col("all_n") - 1) * F.lit(float(p))
        aggs += [
            F.min(F.when(cum > F.floor(pos), value)).alias(f"_lo{i}"),
            F.min(F.when(cum > F.ceil(pos), value)).alias(f"_hi{i}"),
        ]
    picked = ranked.groupBy(*by, "column").agg(*aggs)
    quantiles = []
    for i, p in enumerate(probs):
        pos = (F.col("n") - 1) * F.lit(float(p))
        step = (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (pos - F.floor(pos))
        quantiles.append((F.col(f"_lo{i}") + step).alias(f"q{i}"))
    return picked.select(*by, "column", "n", *quantiles)


def modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-NULL text per column (and group); smallest wins ties."""
    counts = (
        melt(df, columns, keep=by, dtype="string")
        .groupBy(*by, "column", "value")
        .agg(F.count("*").alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
    return (
        counts.groupBy(*by, "column")
        .agg(best.alias("best"))
        .select(*by, "column", F.col("best.value").alias("mode"), (-F.col("best.neg")).alias("n"))
    )
