"""The pipeline stage by stage against plain versions on a small table."""

import collections
import hashlib
import os

import pytest

import corpus_pipeline as P
from ratewise.llm import toxicity

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
public_tokenizers = pytest.importorskip("public_tokenizers")


def stage(spark, docs, name, tmp):
    made = dict(P.STAGES)[name](spark, docs, SF_DIR)
    made.write.parquet(f"{tmp}/{name}")
    return spark.read.parquet(f"{tmp}/{name}")


def test_stages(spark, folder):
    from tests.llm.test_near_dup import brute

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    calm = stage(spark, docs, "toxicity", folder)
    scores = {r.doc_id: r.score for r in toxicity.scores(docs, labels).collect()}
    assert calm.columns == docs.columns
    assert {r.doc_id for r in calm.collect()} == {d for d, s in scores.items() if s < 0.5}

    single = stage(spark, calm, "near_dup", folder)
    rows = [(r.doc_id, r.text) for r in calm.select("doc_id", "text").collect()]
    want = {d for d, (_, root) in brute(rows, 5, 80).items() if d == root}
    assert single.columns == docs.columns
    assert {r.doc_id for r in single.collect()} == want

    pure = stage(spark, single, "decontamination", folder)
    words = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c if c.isdigit() or "a" <= c <= "z" or ord(c) > 127 else " " for c in t or "").split(" ")
    split = lambda t: [w for w in words(t) if w]
    spans = set()
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = split(r.text)
        spans |= {tuple(w[i : i + min(10, len(w))]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(s) for s in spans}
    dirty = lambda t: any(tuple(split(t)[i : i + n]) in spans for n in sizes for i in range(len(split(t)) - n + 1))
    assert {r.doc_id for r in pure.collect()} == {r.doc_id for r in single.collect() if not dirty(r.text)}

    mixed = stage(spark, pure, "mixing", folder)
    assert mixed.columns == docs.columns
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= {r.doc_id for r in pure.collect()} and max(copies.values()) <= 3

    tokens = stage(spark, mixed, "token_ids", folder).orderBy("start").collect()
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert [r.doc_id for r in tokens] == sorted(copies.elements())
    start = 0
    for r in tokens:
        assert r.start == start and r.tokens == full.encode(texts[r.doc_id], add_special_tokens=False).ids + [1]
        start += r.n_tokens


def test_run_twice_gives_the_same_documents(spark):
    digest = lambda df: hashlib.sha256(repr(sorted((r.doc_id, r.n_tokens) for r in df.collect())).encode()).hexdigest()
    assert digest(P.run(spark, SF_DIR)) == digest(P.run(spark, SF_DIR))
