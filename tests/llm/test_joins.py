"""N-gram join, conversation tree and hard negatives against brute force."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintage.llm import conversations, jaccard, negatives


def shingles(text, words=4):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()


def reached(n, linked):
    root = list(range(n))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                root[find(a)] = find(b)
    return [find(k) for k in range(n)]


def brute_join(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    roots = reached(len(rows), lambda a, b: sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))
    least = {}
    for (doc, _), r, own in zip(rows, roots, sets, strict=True):
        if doc is not None and own:
            least[r] = min(doc, least.get(r, doc))
    return sorted((str(d), len(s), str(least.get(r) if s else d)) for (d, _), r, s in zip(rows, roots, sets, strict=True))


@pytest.fixture(scope="module")
def family():
    """Near copies of some texts around the limit, a passage that very many share, odd rows."""
    rng = np.random.default_rng(5)
    rows = []
    passage = [f"p{k}" for k in range(40)]
    for k in range(60):
        rows.append((k, " ".join([f"w{k}x{j}" for j in range(int(rng.integers(3, 120)))] + passage)))
    for stem in range(4):
        base = [f"s{stem}y{j}" for j in range(int(rng.integers(60, 200)))]
        for copy in range(40):
            own = list(base)
            for at in rng.choice(len(own), int(rng.integers(0, 5)), replace=False):
                own[at] = f"edit{rng.integers(6)}"
            rows.append((1000 * stem + 100 + copy, " ".join(own)))
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "one two"), (9004, "One  two"), (9005, "one two three"), (9006, "é É x y z"), (9007, "É É x y z")]
    rows += [(None, rows[70][1]), (5, rows[5][1]), (9010, "word " * 30_000), (9011, rows[61][1].upper())]
    return rows


def test_ngram_join(spark, family):
    docs = spark.createDataFrame([(d, t, "a", "b", "c") for d, t in family], "doc_id long, text string, cls string, n string, k1 string")
    got = jaccard.similar_documents(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_join(family)
    assert jaccard.similar_documents(docs.limit(0)).count() == 0


def test_ngram_join_of_many_trees(spark, family, monkeypatch):
    monkeypatch.setattr(jaccard, "TREE_SETS", 7)
    monkeypatch.setattr(jaccard, "NEAR", 1)
    monkeypatch.setattr(jaccard, "PATH", 3)
    docs = spark.createDataFrame(family, "doc_id long, text string")
    got = jaccard.similar_documents(docs, percent=80).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_join(family, 80)


def test_trees_rule_out_no_similar_pair():
    rng = np.random.default_rng(2)
    bases = rng.choice(300, (5, 50))
    sets = [sorted({*rng.choice(bases[k % 5], int(rng.integers(40, 50)), replace=False), *rng.choice(300, int(rng.integers(0, 6)))}) for k in range(200)]
    maps = np.stack([jaccard.map_of(np.array(own, np.uint64)) for own in sets])
    for width in (2, 8, 64):
        for roots in (np.arange(200), np.arange(200) // 40):
            found = set()
            for key in {c for s in sets for c in s}:
                own = sorted((s[s.index(key) + 1 :][:width], k) for k, s in enumerate(sets) if key in s)
                who = [k for _, k in own]
                n, rest = np.array([len(sets[k]) for k in who]), np.array([len(sets[k]) - sets[k].index(key) - 1 for k in who])
                found |= {tuple(sorted((who[x], who[y]))) for x, y in jaccard.tree_pairs([p for p, _ in own], n, rest, roots[who], maps[who], 85)}
            near = {(a, b) for a in range(200) for b in range(a + 1, 200) if roots[a] != roots[b] and 100 * len({*sets[a]} & {*sets[b]}) >= 85 * len({*sets[a]} | {*sets[b]})}
            assert near <= found
    assert near and len(found) < 200 * 199 / 4


def brute_tree(rows, block=20, most=4):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, (role or "", text or "")))
    convs = {c: [t for _, _, t in sorted(own, key=lambda x: x[:2])] for c, own in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = convs.get(c - c % block, [])[:h] + own[h:]
    nodes = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes.setdefault(tuple(built[c][:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].split()) for p in below if p)
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        ends = ",".join(str(c) for c in members if len(built[c]) == len(path))
        children = sum(len(p) == len(path) + 1 for p in below)
        parent = nodes[path[:-1]][0] if path else None
        out.append((members[0], len(path), str(parent), len(members), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


TALKS = "conv_id long, turn long, role string, text string, pos string, node string"


def talks(n=130):
    rng = np.random.default_rng(8)
    said = [("user", f"say {'word ' * int(k)}") for k in range(4)] + [(None, "x"), ("assistant", None), ("user", ""), ("a", "bc"), ("ab", "c")]
    rows = []
    for c in [*rng.choice(400, n, replace=False).tolist(), 10**12, 10**12 + 7]:
        for turn in range(int(rng.integers(1, 9))):
            role, text = said[0] if turn == 0 and rng.random() < 0.6 else said[int(rng.integers(len(said)))]
            rows.append((int(c), None if turn == 0 and c % 3 == 0 else turn, role, text))
    rows += [(500, t, "user", f"long {t}") for t in range(300)]
    rows.append((None, 0, "user", "nobody"))
    rng.shuffle(rows)
    return [(None if c is None else int(c), None if t is None else int(t), r, x) for c, t, r, x in rows]


@pytest.mark.parametrize("shard", [4096, 5])
def test_conversation_tree(spark, monkeypatch, shard):
    monkeypatch.setattr(conversations, "SHARD", shard)
    monkeypatch.setattr(conversations, "RANGE_TURNS", 200)
    rows = talks()
    table = spark.createDataFrame([(*r, "p", "q") for r in rows], TALKS)
    got = conversations.conversation_tree(table).collect()
    assert sorted((r.conv_id, r.depth, str(r.parent_conv_id), *r[3:]) for r in got) == brute_tree(rows)
    assert conversations.conversation_tree(table.limit(0)).count() == 0


def brute_negatives(rows):
    known = [(i, y, [int(np.floor(256 * float(x))) for x in v]) for i, y, v in rows if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, label, v in known:
        if a % 10:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(v, w, strict=True)), i, y) for i, y, w in known if len(w) == len(v)), key=lambda x: x[:2])
        positives = [(i, -s) for s, i, y in scored if y == label and i != a][:5]
        for p, score in positives:
            fits = [(i, -s) for s, i, y in scored if y != label and 30 * score <= -100 * s <= 90 * score][:10]
            out += [(a, p, rank, i, score, s) for rank, (i, s) in enumerate(fits, 1)]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(5, 12))
    rows = [(k, int(k % 5), (centre[k % 5] * rng.random() + rng.normal(size=12) * 0.6).tolist()) for k in range(400)]
    rows += [(k, int(k % 3), [1.0] * 12) for k in range(1000, 1040)]  # ties
    rows += [(2000, 1, None), (2001, None, [1.0] * 12), (2002, 1, [None] + [1.0] * 11), (2003, 1, [float("nan")] + [1.0] * 11), (2004, 2, [float("inf")] * 12), (2010, 1, [0.0] * 12)]
    rows += [(3000, 1, []), (3001, 2, []), (3010, 1, [1.0, 2.0]), (3011, 1, [1.0, 2.5]), (3012, 2, [1.0, 1.0]), (None, 1, [1.0] * 12), (3020, 1, [1e6, 2e6]), (3021, 1, [1e6, 3.0]), (3022, 2, [5e5, 2.0])]
    table = spark.createDataFrame([(i, y, v, "a", "w") for i, y, v in rows], "vec_id long, label int, embedding array<double>, anchor string, window string")
    for block, size in ((1 << 14, 16 << 20), (50, 20_000)):
        monkeypatch.setattr(negatives, "BLOCK", block)
        monkeypatch.setattr(negatives, "ANCHOR_BYTES", size)
        got = negatives.hard_negatives(table.repartition(3), F.col("vec_id") % 10 == 0)
        assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)
    huge = spark.createDataFrame([(0, 1, [1e12]), (1, 1, [1e12]), (2, 2, [1e3])], "vec_id long, label int, embedding array<double>")
    assert negatives.hard_negatives(huge, F.col("vec_id") == 0).count() == 0
    assert negatives.hard_negatives(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_lists_stop_early():
    """With few dimensions and a far anchor most rows are never met."""
    rng = np.random.default_rng(1)
    v = np.floor(rng.normal(size=(20_000, 2)) * 256)
    lists = negatives.Lists(np.arange(20_000), np.zeros(20_000), v)
    seen = []
    products = negatives.exact_products
    negatives.exact_products = lambda rows, a: seen.append(len(rows)) or products(rows, a)
    try:
        best = [[]]
        lists.search(np.array([300.0, 2.0]), np.ones(20_000, bool), [(-np.inf, np.inf, 5)], best)
    finally:
        negatives.exact_products = products
    score = v @ np.array([300.0, 2.0])
    assert [i for _, i in best[0]] == np.lexsort((np.arange(20_000), -score))[:5].tolist()
    assert sum(seen) < 2000
