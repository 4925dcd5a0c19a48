"""Language, quality, toxicity and tokens on small tables with odd rows."""

import functools
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintage.llm import language, quality, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, toxic int"


def words(rng, stems, n):
    return " ".join(rng.choice(stems) for _ in range(n))


def corpus(spark, n=120):
    """Two languages; ids 1000 on are odd rows; columns score and toxic clash with those of results."""
    rng = np.random.default_rng(1)
    stems = {"en": ["the", "ing", "other", "shall", "with"], "de": ["der", "ung", "schön", "über", "nicht"]}
    rows = []
    for k in range(n):
        lang = "en" if k % 2 else "de"
        text = words(rng, stems[lang], 30)
        if k % 5 == 0:
            text += " idiot scum"
        rows.append((k, text, lang, f"s{k % 3}", len(text), 0.5, 7))
    long = words(rng, stems["en"], 60_000)
    rows += [(1000, None, "en", None, None, None, None), (1001, "", None, "s0", 0, 0.0, 1), (1002, "12 34 ?!", "de", "s1", 8, 0.0, 1)]
    rows += [(1003, long, "en", "s0", len(long), 0.0, 1), (1003, long, "en", "s0", len(long), 0.0, 1), (None, "der schön ung", None, "s1", 13, 0.0, 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return corpus(spark).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, int(k % 5 != 0), int(k % 5 == 0)) for k in range(100)]
    return spark.createDataFrame([*rows, (3, 1, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


def test_language(docs):
    trees = language.fit(docs.where(~language.held_out()))
    got = {r.doc_id: r for r in language.predict(docs, trees).collect()}
    want = {r.doc_id: r.lang for r in docs.collect()}
    assert all(got[k].lang_pred == want[k] for k in range(120))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [got[k].lang_pred for k in (1000, 1001, 1002)] == ["und"] * 3
    assert got[1003].lang_pred == "en" and got[None].lang_pred == "de"
    assert language.predict(docs, trees).count() == docs.count()


def test_a_rare_language_keeps_its_statistics_under_small_limits(spark):
    """One text in a hundred is of a third language, made of the others' letters in another order."""
    rng = np.random.default_rng(2)
    letters = list("abcdefghijklmnop")
    stems = {lang: ["".join(rng.choice(letters, 5)) for _ in range(size)] for lang, size in (("aa", 60), ("bb", 60), ("zz", 12))}
    langs = ["zz" if k % 100 == 0 else "aa" if k % 2 else "bb" for k in range(1200)]
    rows = [(k, words(rng, stems[lang], 12), lang) for k, lang in enumerate(langs)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.gram_counts(table, "lang").count()
    for limits in ({"max_grams": found // 4}, {"table_bytes": 40_000}, {"max_grams": found // 2, "table_bytes": 40_000}):
        trees = language.fit(table, **limits)
        got = {r.doc_id: r.lang_pred for r in language.predict(table, trees).collect()}
        assert all(got[k] == "zz" for k in range(0, 1200, 100)), limits
        assert sum(got[k] == lang for k, lang in enumerate(langs)) >= 1180
    everything = language.fit(table, max_grams=found)
    assert np.array_equal(everything.bits, language.fit(table).bits)


def test_language_lengths_are_a_distribution(docs):
    trees = language.fit(docs)
    a = int(trees.symbol.max()) + 1
    weight = np.ones(a)
    weight[-1] = 256 - (a - 1)
    total = (2.0 ** -trees.bits.reshape(-1, a, 2).astype(float) * weight[None, :, None]).sum(1)
    assert np.allclose(total, 1, atol=1e-4)


def test_language_matches_a_plain_model():
    """Code lengths equal those of a dictionary model with the same escapes and exclusions."""
    text = b"\n\n\nabracadabra abra"
    grams = [text[k : k + 4] for k in range(len(text) - 3)]
    found = {g: grams.count(g) for g in grams}
    codes = np.array([int.from_bytes(g, "big") for g in found])
    trees = language.context_trees(np.array(["x"] * len(found)), codes, np.array(list(found.values())))

    @functools.cache
    def p(context, byte):
        n = {}
        for g, c in found.items():
            if g[3 - len(context) : 3] == context:
                n[g[3]] = n.get(g[3], 0) + c
        lower = (lambda b: p(context[1:], b)) if context else (lambda b: 1 / 256)
        if not n:
            return lower(byte)
        if byte in n:
            return n[byte] / (sum(n.values()) + len(n))
        left = sum(lower(b) for b in range(256) if b not in n)
        return len(n) / (sum(n.values()) + len(n)) * lower(byte) / left

    for sample in ("abra", "cad!", "zzz", "ra abé"):
        raw = b"\n\n\n" + sample.encode()
        want = sum(-np.log2(p(raw[k - 3 : k], raw[k])) for k in range(3, len(raw)))
        assert abs(trees.score([sample])[0][0, 0] - want) < 1e-3


def test_language_without_training(spark, docs):
    none = docs.limit(0)
    trees = language.fit(none)
    assert {r.lang_pred for r in language.predict(docs, trees).collect()} == {"und"}
    assert language.predict(none, trees).count() == 0


def test_toxicity(docs, labels):
    chain = toxicity.fit(docs, labels)
    got = toxicity.predict(docs, chain).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[k].toxic == (k % 5 == 0) for k in range(120))
    assert not any(by_id[k].toxic for k in (1000, 1001, 1002, 1003, None))
    assert by_id[0].p_insult > 0.5 > by_id[1].p_insult
    kept = toxicity.clean_documents(docs, chain)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.toxic for r in got)


@pytest.mark.parametrize("clean", [2, 1])
def test_toxicity_when_half_or_more_are_toxic(spark, clean):
    rng = np.random.default_rng(4)
    stems = ["the", "ing", "other", "shall", "with"]
    rows = [(k, words(rng, stems, 30) + (" idiot scum" if k % 4 >= clean else ""), int(k % 4 >= clean)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()
    chain = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic").where("doc_id < 320"))
    got = {r.doc_id: r.toxic for r in toxicity.predict(docs, chain).collect()}
    assert got == {k: bool(y) for k, _, y in rows}
    assert toxicity.clean_documents(docs, chain).count() == 100 * clean


def test_toxicity_without_labels(docs, labels):
    chain = toxicity.fit(docs, labels.limit(0))
    assert not any(r.toxic for r in toxicity.predict(docs, chain).collect())
    assert toxicity.predict(docs.limit(0), chain).count() == 0


def test_quality(docs, labels):
    heap = docs.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.regexp_replace("text", " ", "!!! ")).otherwise(F.col("text")))
    model = quality.fit(heap, labels)
    got = {r.doc_id: r for r in quality.score(heap, model).collect()}
    assert all(got[k].high_quality == (k % 5 != 0) for k in range(120))
    assert quality.score(heap, model).count() == docs.count()
    assert all(0 <= r.score <= 1 for r in got.values())
    bare = quality.score(docs.select("doc_id", "text"), model)
    assert bare.count() == docs.count()


def test_quality_without_labels(docs, labels):
    model = quality.fit(docs, labels.limit(0))
    assert {round(r.score, 6) for r in quality.score(docs, model).collect()} == {0.5}


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_tokens_equal_the_library(spark, docs, path):
    from tokenizers import Tokenizer

    odd = [(2000, "a <|endoftext|> b's    x\n\n 12½ 日本語 \u001c z"), (2001, "  it's  ''s \r\n\t"), (2002, " \u0085ſǅ ²³ <|endoftext|><|endoftext|>"), (None, None), (2003, "x" * 5000)]
    table = docs.select("doc_id", "text").unionAll(spark.createDataFrame(odd, "doc_id long, text string"))
    tok = Tokenizer.from_file(path)
    want = []
    for r in table.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = tokens.encode_decode(table, path, keep=True).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert sorted(r.text for r in got) == sorted(r.text or "" for r in table.collect())


def test_tokens_in_many_chunks(docs, path, monkeypatch):
    whole = {(r.doc_id, r.ids_sha256) for r in tokens.encode_decode(docs, path).collect()}
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 30_000)
    monkeypatch.setattr(tokens, "BUCKET_BYTES", 50_000)
    assert {(r.doc_id, r.ids_sha256) for r in tokens.encode_decode(docs, path).collect()} == whole


def test_tokens_of_nothing(docs, path):
    assert tokens.encode_decode(docs.limit(0), path).count() == 0
