"""The pipeline's stages in order, each held against what it was given."""

import hashlib
import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_duplicates import brute_fp  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")
def test_stages_in_order(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name in list(stages)[:-1]:
        kept = spark.createDataFrame(stages[name](spark, docs, DATA).collect(), docs.schema)
        assert kept.columns == columns
        now = {r.doc_id: r.text for r in kept.collect()}
        assert len(now) == kept.count() and set(now) <= set(texts)
        if name != "line_dedup":
            assert all(now[k] == texts[k] for k in now)
        if name == "near_dedup":
            fps = {k: brute_fp(t) for k, t in texts.items()}
            root = {k: k for k in fps}
            for _ in range(len(fps)):
                low = {a: min(root[b] for b in fps if (fps[a] ^ fps[b]).bit_count() <= 3) for a in fps}
                if low == root:
                    break
                root = low
            assert sorted(now) == sorted({r for r in root.values()})
        docs, texts = kept, now
    coded = {r.doc_id: r for r in stages["bpe"](spark, docs, DATA).collect()}
    assert set(coded) == set(texts)
    assert all(coded[k].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for k, t in texts.items())
