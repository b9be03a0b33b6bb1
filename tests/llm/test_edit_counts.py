"""Edit-aware counts against encoding the whole text again."""

import random

import pytest
from pyspark.sql import functions as F

from ratewise.llm import edit_counts as E

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_random_edits_equal_full_encoding(tokenizer):
    rng = random.Random(3)
    encoder = E.WordEncoder(PATH)
    alphabet = "ab é.\n  x9İſ,ñ'st" + "  ΣςА"
    for _ in range(40):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 1500)))
        counted = E.CountedText(text, *E._leaves(text, encoder), encoder)
        for _ in range(12):
            start, n = rng.randrange(0, len(text) + 3), rng.choice([0, 1, 5, 300])
            new = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 7, 400, 3000])))
            counted.edit(start, n, new)
            text = text[:start] + new + text[start + n :]
            assert counted.text == text
            assert counted.n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids)
            assert counted.tree.leaves[:, 0].sum() == len(text)


def test_few_characters_are_encoded_again():
    encoder = E.WordEncoder(PATH)
    text = "word and more " * 5000
    counted = E.CountedText(text, *E._leaves(text, encoder), encoder)
    counted.edit(30_000, 3, "new")
    assert counted.encoded < 100


def test_tables(spark, tokenizer):
    rows = [(1, "one two three", "z"), (2, None, "z"), (3, "", None), (1, "one two three", "z"), (None, "a b", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits_of string")
    edits = spark.createDataFrame(
        [(1, 2, 0, 3, "four"), (1, 1, 3, 1, ""), (2, 1, 5, 1, "x y"), (3, None, None, None, None), (9, 1, 0, 0, "gone")],
        "doc_id long, seq long, start long, n_deleted long, inserted string",
    )
    done = E.apply_edits(E.with_edits(E.build(docs, PATH), edits), PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in done) == [
        ("1", "fourtwo three"), ("1", "fourtwo three"), ("2", "x y"), ("3", ""), ("None", "a b"),
    ]
    for r in done:
        assert r.tokens_after == len(tokenizer.encode(r.text, add_special_tokens=False).ids)
        assert sum(r.leaf_tokens) == r.tokens_after and sum(r.leaf_chars) == r.n_chars == len(r.text)
    empty = E.build(docs.limit(0).withColumn("edits", F.lit(None).cast(E.EDITS)), PATH, "edits")
    assert E.apply_edits(empty, PATH).count() == 0
