"""Near duplicates, repeated lines and bytes, leaks, against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintage.llm import components, decontaminate, lines, simhash, suffixes

EXTRA = "doc_id long, text string, fp string, n_removed string, row string"


def frame(spark, rows):
    """doc_id and text, with columns whose names clash with those of results."""
    return spark.createDataFrame([(k, t, "x", "y", "z") for k, t in rows], EXTRA)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(7)
    stems = ["lo", "mi", "ra", "tek", "sun", "var", "no", "pel"]
    word = lambda: "".join(rng.choice(stems) for _ in range(rng.integers(1, 4)))
    line = lambda: " ".join(word() for _ in range(12))
    base = ["\n".join(line() for _ in range(8)) for _ in range(20)]
    rows = list(enumerate(base))
    for k, text in enumerate(base[:10]):
        own = text.split(" ")
        own[int(rng.integers(len(own)))] = "changed"
        rows.append((100 + k, " ".join(own)))
    rows += [(200 + k, base[k]) for k in range(6)]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "one two"), (304, "one two"), (None, base[3]), (305, "a" * 3000), (306, "ab" * 400 + "x" + "ab" * 200)]
    rows += [(400, "\n".join(base[0].split("\n")[2:6]) + "\n\n" + line()), (5, base[5]), (0, "another text of the same id")]
    rows += [(401, ("intro " + line() + "\n") * 3 + base[1][:150])]
    return rows


def brute_fp(text):
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(spark, texts):
    got = simhash.near_duplicates(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    fps = [brute_fp(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(texts):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    want = sorted((str(d), f"{fps[k]:016x}", least.get(find(k))) for k, (d, _) in enumerate(texts))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want


def test_large_groups_lose_no_link():
    rng = np.random.default_rng(0)
    base = int(rng.integers(0, 2**62))
    own = {base ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(1500)}
    fps = np.array(sorted(own), np.uint64)
    got = simhash.linked(fps, list(range(64)))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    label = np.arange(len(fps))
    while (low := np.where(near, label[None, :], len(fps)).min(1)).tolist() != label.tolist():
        label = low
    assert (got == label).all()


def test_every_near_pair_shares_a_key(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(-(2**63), 2**63, 300)
    b = [int(x) ^ (lambda m: m - (1 << 64) if m >> 63 else m)(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 4), replace=False))) for x in a]
    rows = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b, strict=True)], "a long, b long")
    keyed = rows.select(simhash.chain_keys("a").alias("p"), simhash.chain_keys("b").alias("q"))
    assert keyed.selectExpr("arrays_overlap(p, q) AS ok").where("NOT ok").count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7), (0, 1)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_of_each_component(spark, texts):
    docs = frame(spark, texts).withColumn("k1", F.lit("own")).withColumn("K2", F.lit("own"))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    fps = [brute_fp(t) for _, t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            near = [b for b in range(len(texts)) if (fps[a] ^ fps[b]).bit_count() <= 3]
            root[a] = min(root[b] for b in near)
    groups = {}
    for k, (doc, _) in enumerate(texts):
        groups.setdefault(root[k], []).append(doc)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(d for d in g if d is not None) for g in groups.values())
    assert simhash.one_of_each(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def brute_bytes(rows, width):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        raw = (text or "").encode()
        gone, fresh = np.zeros(len(raw), bool), set()
        for k in range(len(raw) - width + 1):
            if raw[k : k + width] in seen or raw[k : k + width] in fresh:
                gone[k : k + width] = True
            fresh.add(raw[k : k + width])
        seen |= fresh
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.setdefault(doc, []).append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [64, 1])
def test_repeated_bytes(spark, texts, hot):
    rows = [r for r in texts if r not in ((0, "another text of the same id"), texts[-3])]  # ids once
    rows = list({r[0]: r for r in rows}.values())
    got = suffixes.remove_repeats(frame(spark, rows), hot=hot, keep=True).collect()
    want = brute_bytes(rows, 100)
    assert {r.doc_id: [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)] for r in got} == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_repeated_bytes_of_odd_tables(spark, texts):
    docs = frame(spark, texts)
    assert suffixes.remove_repeats(docs).count() == len(texts)
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0
    same = frame(spark, [(1, "word " * 50 + "end"), (1, "word " * 50 + "end")])
    assert len({(r.n_removed, r.kept_sha256) for r in suffixes.remove_repeats(same).collect()}) == 1


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(4)
    part = "".join(rng.choice(list("abcdefgh "), 4000))
    rows = [(1, part * 3), (2, part[1500:2500] + "z"), (3, "y" + part)]
    monkeypatch.setattr(suffixes, "PASS_BYTES", 700)
    monkeypatch.setattr(suffixes.pieces, "__defaults__", None)
    got = {r.doc_id: [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)] for r in suffixes.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute_bytes(rows, 100)
    spans = [list(range(a, b)) for _, _, a, b in suffixes.pieces(5000, 100)]
    assert sum(spans, []) == list(range(4901))


def brute_lines(rows):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        every = text.split("\n")
        full = [(k, s.strip(" \t\r")) for k, s in enumerate(every) if s.strip(" \t\r")]
        gone = set()
        for k in range(len(full) - 2):
            window = tuple(s for _, s in full[k : k + 3])
            if window in seen:
                gone |= set(range(full[k][0], full[k + 2][0] + 1))
            seen.add(window)
        out.append((doc, "\n".join(s for k, s in enumerate(every) if k not in gone), len(gone)))
    return out


def test_repeated_lines(spark, texts):
    rows = [(k, t) for k, t in {r[0]: r for r in texts}.values() if k is not None and t is not None]
    got = lines.dedup_lines(frame(spark, rows))
    assert sorted((r.doc_id, r.text, r.n_removed) for r in got.collect()) == brute_lines(rows)


def test_repeated_lines_of_odd_tables(spark, texts):
    docs = frame(spark, texts)
    got = lines.dedup_lines(docs)
    assert sorted(got.columns) == sorted(docs.columns)
    assert got.count() == len(texts)
    assert [r.text for r in got.collect() if r.doc_id == 300] == [None]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


ITEM = "If Alice buys 12 apples and 30 pears for 7 dollars, how many apples does Alice have after Bob takes 12 of them?"


def test_leaks(spark, texts):
    plain = texts[8][1].split("\n")[1]
    bench = spark.createDataFrame([(1, ITEM, 5), (2, plain, 5), (3, None, 5), (4, "", 5), (None, ITEM, 5), (6, "Very short words here", 5)], "item_id long, text string, doc_id int")
    rows = [
        *texts,
        (900, "Homework. " + ITEM + " Thanks."),
        (901, "Now: If Maria Lopez buys 15 apples and 41 pears for 9 euros, how many apples does Maria Lopez have after Sam takes 15 of them?"),
        (902, "If Maria buys 15 apples and 41 pears for 9 euros, how many apples does Maria have after Sam takes 99 of them?"),
        (903, "These are very short words here."),
    ]
    docs = frame(spark, rows)
    got = {r.doc_id: r.item_ids for r in decontaminate.decontaminate(docs, bench).collect() if r.contaminated}
    want = {k for k, t in texts if t and plain in t}
    assert set(got) == want | {900, 901, 903}
    assert got[900] == [1] and got[901] == [1] and got[903] == [6]
    kept = decontaminate.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 for k, t in rows if k not in got and not (k in want))
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0


def test_leaks_in_any_case(spark):
    names = "Anna Berg met Carl Dorn. Emil Falk paid 9 euros."
    few = "Paris, 12 May 1900: 30 kg, 40 km and 50 miles"
    item = "A farmer sells 12 boxes of pears to Alice. How many boxes are left when Bob buys 5 of the others?"
    bench = spark.createDataFrame([(1, item), (2, names), (3, few)], "item_id long, text string")
    rows = [
        (1, "READ THIS. " + item.upper() + " THANKS"),
        (2, "notes (" + item.lower().replace(".", "").replace("?", "") + ") end"),
        (3, "Then: " + names),
        (4, "SO " + names.upper()),
        (5, "It was in " + few + " they say"),
        (7, "A farmer sells pears. How many boxes are left? Paris, 1900, was another place where Carl met Emil and paid 3 euros for all of it."),
    ]
    got = {r.doc_id: r.item_ids for r in decontaminate.decontaminate(frame(spark, rows), bench).collect()}
    assert got == {1: [1], 2: [1], 3: [2], 4: [2], 5: [3], 7: []}


def test_leaks_with_rewritten_slots(spark):
    asked = "The shop on the corner sold 25 loaves of fresh bread in the early morning and then gave 2 of them to Alice before she took 2 buses home again."
    bench = spark.createDataFrame([(1, asked), (2, asked.replace("25", "90")), (3, asked), (4, None), (None, asked)], "item_id long, text string")
    words = "The shop on the corner sold {} loaves of fresh bread in the early morning and then gave {} of them to {} before she took {} buses home again."
    rows = [
        (1, words.format("twenty five", "2", "Alice", "2")),
        (2, words.format("25", "3", "Alice", "5")),
        (3, words.format("one hundred and twenty", "7", "Carla Maria", "7")),
        (4, words.format("30", "2", "Alice", "2").replace("early morning", "early and rather cold morning")),
        (5, "The shop on the corner sold 25 loaves. " * 40),
        (6, "In the early morning she took 2 buses and then gave 25 loaves of fresh bread to the shop on the corner."),
    ]
    got = {r.doc_id: r.item_ids for r in decontaminate.decontaminate(frame(spark, rows), bench).collect()}
    assert {d: got[d] for d in (1, 2, 4)} == {1: [1, 2, 3], 2: [1, 2, 3], 4: [1, 2, 3]}
    assert got[3] == [1, 2, 3]
    assert got[5] == got[6] == []
