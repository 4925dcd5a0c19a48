"""Prefix tree of conversations by vertical bitmaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, batch_of, cut, discard, partitions, runs

#: Turns of one range of conversation ids, about, and conversations of one shard within it.
RANGE_TURNS = 1 << 15
SHARD = 4096
#: Turns at which a shard ends even if it has fewer conversations.
SHARD_TURNS = 1 << 18

_LOCAL = "shard long, at long, until long, node string, parent string, depth long, n long, first long, words long, ends string"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_key, words): turns by number from 0, NULL turns first, ties by key.

    turn_key is 128 bits of role and text, NULL as empty; the texts themselves go no
    further. Rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("turn_key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "turn_key")
    return turns.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "turn_key", "words")


def rebuilt(turns: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first h turns are those of the head of their block, h = crc32(conv_id) % most.

    The head of conversation c is c - c % block. Returns turns like numbered_turns() and,
    so that one without turns stays, a row of position -1 for each conversation.
    """
    convs = turns.where("pos = 0").select("conv_id", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int").alias("h"))
    heads = turns.where(F.col("pos") < most).select(F.col("conv_id").alias("head"), "pos", "turn_key", "words")
    wants = convs.where("h > 0").select("conv_id", "h", (F.col("conv_id") - F.col("conv_id") % block).alias("head"))
    borrowed = wants.join(heads, "head").where("pos < h").select("conv_id", "pos", "turn_key", "words")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most))
    own = turns.where(F.col("pos") >= h)
    marks = convs.select("conv_id", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("turn_key"), F.lit(0).cast("long").alias("words"))
    return borrowed.unionAll(own).unionAll(marks)


def shard_nodes(ids: list[int], turns: list[list[tuple[str, int]]]) -> list[tuple]:
    """(until, node, parent, depth, n, first, words, ends) of the prefix tree of some conversations, parents first.

    ids ascend. Postings hold for each position and turn the bitset of the conversations that
    have it there. Depth first, a node's bitset meets the postings of the next position: what
    is left of it is a child, its popcount the child's number of conversations, its lowest
    bit the least of them. until is the number of the last node of the subtree, plus one.
    """
    import xxhash

    postings: dict[tuple[int, str], int] = {}
    ended: dict[int, int] = {}
    for k, own in enumerate(turns):
        bit = 1 << k
        for d, (key, _) in enumerate(own):
            postings[d, key] = postings.get((d, key), 0) | bit
        ended[len(own)] = ended.get(len(own), 0) | bit

    def listed(bits: int) -> str:
        out = []
        while bits:
            low = bits & -bits
            out.append(str(ids[low.bit_length() - 1]))
            bits ^= low
        return ",".join(out)

    out: list[list] = []
    stack: list[tuple] = [((1 << len(ids)) - 1, 0, "", None, 0)]
    while stack:
        if isinstance(stack[-1], int):
            out[stack.pop()][0] = len(out)
            continue
        bits, depth, node, parent, words = stack.pop()
        done = bits & ended.get(depth, 0)
        stack.append(len(out))
        out.append([0, node, parent, depth, bits.bit_count(), ids[(bits & -bits).bit_length() - 1], words, listed(done)])
        rest = bits & ~done
        while rest:
            key, count = turns[(rest & -rest).bit_length() - 1][depth]
            child = rest & postings[depth, key]
            rest ^= child
            stack.append((child, depth + 1, xxhash.xxh3_128_hexdigest(f"{node}/{key}"), node, count))
    return [tuple(x) for x in out]


def local_nodes(rebuilt_turns: DataFrame) -> DataFrame:
    """Nodes of the tree of each shard of conversations with adjacent ids; at is their number, parents first."""
    turns = cut(rebuilt_turns)
    n = partitions(turns.count(), RANGE_TURNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_LOCAL)
        ids: list[int] = []
        held: list[list[tuple[str, int]]] = []
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            found = shard_nodes(ids, held)
            for a in range(0, len(found), 10_000):
                until, node, parent, depth, size, first, words, ends = zip(*found[a : a + 10_000], strict=True)
                yield batch_of(schema, {
                    "shard": [ids[0]] * len(node), "at": range(a, a + len(node)), "until": until, "node": node, "parent": parent,
                    "depth": depth, "n": size, "first": first, "words": words, "ends": ends,
                })

        for b in batches:
            for conv, _, key, words in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if not ids or ids[-1] != conv:
                    if len(ids) == SHARD or rows >= SHARD_TURNS:
                        yield from flush()
                        ids, held, rows = [], [], 0
                    ids.append(conv)
                    held.append([])
                if key is not None:
                    held[-1].append((key, words))
                    rows += 1
        if ids:
            yield from flush()

    ordered = turns.repartitionByRange(n, "conv_id").sortWithinPartitions("conv_id", "pos")
    found = cut(ordered.select("conv_id", "pos", "turn_key", "words").mapInArrow(run, _LOCAL))
    discard(turns)
    return found


def _subtree_sums(local: DataFrame) -> DataFrame:
    """(node, n_leaves, saved) of local nodes with values leaf and saved, summed over each shard's subtrees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("node string, n_leaves long, saved long")
        held: list[pa.RecordBatch] = []
        now = None

        def flush() -> pa.RecordBatch:
            at, until, leaf, saved = (np.concatenate([h.column(k).to_numpy() for h in held]) for k in (1, 2, 4, 5))
            total = [np.r_[0, np.cumsum(x)] for x in (leaf, saved)]
            return batch_of(schema, {"node": pa.concat_arrays([h.column(3) for h in held]), "n_leaves": total[0][until] - total[0][at], "saved": total[1][until] - total[1][at]})

        for b in batches:
            shard = b.column(0).to_numpy()
            for a, z in zip(*runs(shard), strict=True):
                if shard[a] != now and held:
                    yield flush()
                    held = []
                now = shard[a]
                held.append(b.slice(a, z - a))
        if held:
            yield flush()

    n = int(local.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = local.repartition(n, "shard").sortWithinPartitions("shard", "at")
    sums = ordered.select("shard", "at", "until", "node", "leaf", "saved").mapInArrow(run, "node string, n_leaves long, saved long")
    return sums.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def _end_digests(local: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes where conversations end: their ids, ascending, joined by commas.

    Shards hold adjacent ids, so the pieces of a node are hashed one after the other in the
    order of the shards, and no task holds a list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        schema = arrow_schema("node string, ends_sha256 string")
        now, digest = None, None
        for b in batches:
            nodes, sums = [], []
            for node, ends in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if node != now:
                    if digest is not None:
                        nodes.append(now)
                        sums.append(digest.hexdigest())
                    now, digest = node, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
            yield batch_of(schema, {"node": nodes, "ends_sha256": sums})
        if digest is not None:
            yield batch_of(schema, {"node": [now], "ends_sha256": [digest.hexdigest()]})

    n = int(local.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = local.where("ends <> ''").select("node", "shard", "ends").repartition(n, "node").sortWithinPartitions("node", "shard")
    return pieces.select("node", "ends").mapInArrow(run, "node string, ends_sha256 string")


def prefix_tree(rebuilt_turns: DataFrame) -> DataFrame:
    """One row per node of the tree of all conversations; see conversation_tree for the columns.

    Each shard of conversations gives its own tree by bitmaps. A node has the same key, 128
    bits of its path, in all shards, so counts and least members are sums and minima over
    shards, of which each sends one row for each node. A node's own value counts in the
    shard of its least member alone, as leaf and saved tokens: subtree sums are then sums
    over the shards' subtrees too.
    """
    local = local_nodes(rebuilt_turns)
    merged = local.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.sum("n").alias("n_convs"), F.min("first").alias("conv_id"), F.max("words").alias("words")
    )
    nodes = cut(merged)
    below = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes_with = cut(nodes.join(below, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    value = nodes_with.select(
        "node", F.col("conv_id").alias("least"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    )
    own = F.col("first") == F.col("least")
    valued = local.join(value, "node").select("shard", "at", "until", "node", F.when(own, F.col("leaf")).otherwise(0).alias("leaf"), F.when(own, F.col("saved")).otherwise(0).alias("saved"))
    sums, ends = _subtree_sums(valued), _end_digests(local)
    above = nodes_with.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes_with.join(above, "parent", "left").join(sums, "node").join(ends, "node", "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_tree(conversations: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """Prefix tree of rebuilt conversations (conv_id, turn, role, text, any others): one row per node.

    conv_id: least member; depth; parent_conv_id: least member of the parent, NULL for the
    root; n_convs: conversations that start with the node's turns; n_children; n_leaves and
    saved_tokens: over the subtree, childless nodes and, of each node, its last text's words
    for every conversation but one; ends_sha256: of the ids that end at the node. Turns are
    equal if role and text are, NULL as empty. NULL turn numbers come first; turns of one
    number are ordered by their hash, and repeated rows are turns of their own. Rows
    without a conv_id are left out. A conversation of no turns is a member of the root.
    An empty table gives no nodes.
    """
    return prefix_tree(rebuilt(cut(numbered_turns(conversations)), block, most))


#: DuckDB's form: CRC-32 by its table, prefixes as lists of turns.
ORACLE = """
WITH RECURSIVE bits AS (
  SELECT i AS start, CAST(i AS BIGINT) AS v, 0 AS step FROM range(256) r(i)
  UNION ALL SELECT start, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM bits WHERE step < 8
), crc AS (SELECT list(v ORDER BY start) AS t FROM bits WHERE step = 8),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
         {'r': coalesce(role, ''), 't': coalesce(text, '')} AS said FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
                          lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc
), built AS (
  SELECT c.conv_id, s.pos, s.said FROM convs c JOIN turns s ON s.conv_id = c.conv_id - c.conv_id % 20 AND s.pos < c.h
  UNION ALL SELECT c.conv_id, s.pos, s.said FROM convs c JOIN turns s ON s.conv_id = c.conv_id AND s.pos >= c.h
), whole AS (
  SELECT c.conv_id, list(said ORDER BY pos) FILTER (pos IS NOT NULL) AS path FROM convs c LEFT JOIN built USING (conv_id) GROUP BY 1
), members AS (
  SELECT conv_id, coalesce(len(path), 0) AS total, d AS depth, CASE WHEN d = 0 THEN [] ELSE path[1:d] END AS path
  FROM whole, unnest(range(coalesce(len(path), 0) + 1)) r(d)
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (total = depth), '') AS ends
  FROM members GROUP BY 1, 2
), family AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.path[n.depth].t, '[^\\x20\\x09-\\x0D]+')) END AS saved
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
), inside AS (
  SELECT path[1:a] AS path, a AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens FROM family, unnest(range(depth + 1)) r(a) GROUP BY 1, 2
)
SELECT conv_id, CAST(f.depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM family f JOIN inside i ON f.depth = i.depth AND f.path = i.path
"""
