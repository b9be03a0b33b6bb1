"""Toxicity, surrogates, shards and token files on awkward rows."""

import glob
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import shards, surrogates, token_store, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def toxic_corpus(n=900, seed=4):
    rng = random.Random(seed)
    calm = [f"calm{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(calm) for _ in range(rng.randrange(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grumpf", "grumpfolo", "grumpfasi", "zaxxed"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_documents(spark):
    rows, labels = toxic_corpus()
    odd = [(5000, None, 1), (5001, "", None), (None, "calm1", 0), (5002, "grumpf " * 40_000, 1), (0, rows[0][1], 1)]
    docs = spark.createDataFrame([(*r, 0) for r in rows] + odd, "doc_id long, text string, score long")
    table = spark.createDataFrame([*labels, (1, None), (None, 1), (7777, 1)], "doc_id long, toxic int")
    got = toxicity.scores(docs, table).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held) / len(held)
    assert right > 0.95
    assert next(r for r in got if r.doc_id == 5002).predicted == 1
    assert {r.doc_id for r in toxicity.without_toxic(docs, table).collect()} == {r.doc_id for r in got if not r.predicted}


def test_the_sample_is_bounded(spark):
    rows, labels = toxic_corpus(3000)
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    taken = [sorted(r.doc_id for r in toxicity.labelled_sample(d, table, 200).collect()) for d in (docs, docs.repartition(7))]
    assert taken[0] == taken[1] and len(taken[0]) == 200
    assert not any(zlib.crc32(str(d).encode()) % 5 == 0 for d in taken[0])
    assert toxicity.labelled_sample(docs, table, 100_000).count() == sum(zlib.crc32(str(d).encode()) % 5 != 0 for d, _ in rows)


def test_toxicity_without_examples(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.scores(docs, none).collect()] == [0.5, 0.5]
    assert toxicity.scores(docs.limit(0), none).count() == 0


KEY = b"test key"


def test_surrogates_keep_type_format_distinctness_and_reference(spark):
    rng = random.Random(8)
    ip = lambda: ".".join(str(rng.randrange(1, 255)) for _ in range(4))
    mails = [f"{w}.{i}@mail{i % 7}.example.com" for i, w in enumerate(["anna", "bob", "éva"] * 40)]
    rows = [(i, f"Write to {m} or {m.upper()}, from {ip()}.") for i, m in enumerate(mails)]
    rows += [
        (900, "Call +1 (415) 555-2671 or +14155552671; card 4111 1111 1111 1111, again 4111111111111111."),
        (901, 'Dear Mrs. Clara Miller, Mr Miller-Smith and Госпожа Анна Иванова; token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"'),
        (902, "Clara met Mrs CLARA MILLER. IBAN DE89 3704 0044 0532 0130 00"),
        (903, None), (904, ""), (None, rows[0][1]), (0, rows[0][1]), (905, "no 123 such 4.0 thing v1.2.3.4.5"), (906, "x " * 60_000 + mails[0]),
    ]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_entities long")
    for limit in (500_000, -1):
        got = {(r.doc_id, r.text): r for r in surrogates.pseudonymised(docs, KEY, broadcast_entities=limit).collect()}
        pairs = {}
        by_id = {}
        for r in got.values():
            by_id[r.doc_id] = r
        for d, text in rows:
            made = by_id[d].text
            before, after = surrogates.entities(text or ""), surrogates.entities(made or "")
            assert [k for *_, k, _ in before] == [k for *_, k, _ in after]
            if not before:
                assert made == text
            for (a, b, kind, real), (c, e, _, fake) in zip(before, after):
                assert pairs.setdefault((kind, real), fake) == fake and fake != real
                old, new = text[a:b], made[c:e]
                assert old.isupper() == new.isupper()
                if kind in ("card", "phone", "secret", "account"):
                    assert [ch.isalnum() or ch for ch in old] == [ch.isalnum() or ch for ch in new]
        kinds = [k for k, _ in pairs]
        assert len({(k, v) for (k, _), v in pairs.items()}) == len(pairs)
        assert not {v for v in pairs.values()} & {r for _, r in pairs}
        assert {"email", "ip", "phone", "card", "secret", "person_f", "person_m", "account"} <= set(kinds)
        fake = by_id[901].text
        assert fake.split("Mrs. ")[1].split()[0] in surrogates.GIVEN["f", "latin"]
        assert fake.split("Госпожа ")[1].split()[0] in surrogates.GIVEN["f", "cyrillic"]
        digits = "".join(c for c in by_id[900].text.split("card ")[1].split(",")[0] if c.isdigit())
        assert surrogates._luhn(digits) == 0


def test_people_keep_their_surrogate_in_every_form(spark):
    rows = [
        (1, "Mrs Clara Miller met Mrs Miller. Dr Clara Miller left; CLARA MILLER, Clara and Miller's dog stayed. Mr Miller-Smith came."),
        (2, "Prof Zelda Quast spoke."), (3, "Mrs Zelda Quast spoke; Quast-Haus, Zelda-Maria."), (4, "Clara Miller has no title here."),
        (5, "Frau Anna-Maria Vogt, Frau Maria Vogt, Dr Vogt, Anna Vogt; Mr Kim Vogt and Kim."),
        *((100 + i, f"Mrs {name} Miller") for i, name in enumerate(f"N{a}{b}" for a in "aeiou" for b in "bcdfgklmnr")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (500_000, -1):
        got = {r.doc_id: r.text for r in surrogates.pseudonymised(docs, KEY, broadcast_entities=limit).collect()}
        first, last = got[1].split("Mrs ")[1].split(" met")[0].split(" ")
        assert got[1].startswith(
            f"Mrs {first} {last} met Mrs {last}. Dr {first} {last} left; {first.upper()} {last.upper()}, {first} and {last}'s dog stayed. Mr "
        )
        assert first in surrogates.GIVEN["f", "latin"] and {"Clara", "Miller"}.isdisjoint({first, last})
        zelda, quast = got[2].removeprefix("Prof ").split(" ")[:2]
        assert got[3] == f"Mrs {zelda} {quast} spoke; {quast}-Haus, {zelda}-Maria." and zelda in surrogates.GIVEN["f", "latin"]
        assert got[4] == rows[3][1]
        anna, maria, vogt = got[5].removeprefix("Frau ").split(",")[0].replace("-", " ").split(" ")
        kim = got[5].rsplit(" ", 1)[1].rstrip(".")
        assert got[5] == f"Frau {anna}-{maria} {vogt}, Frau {maria} {vogt}, Dr {vogt}, {anna} {vogt}; Mr {kim} {vogt} and {kim}."
        namesakes = [got[d].split(" ")[1:] for d, _ in rows[5:]]
        assert {s for _, s in namesakes} == {last} and len({f for f, _ in namesakes} | {first}) == len(namesakes) + 1


def test_clashes_are_resolved(spark):
    known = spark.createDataFrame([("ip", f"10.0.0.{i}") for i in range(1, 255)] + [("email", f"{c}@b.de") for c in "abcdefgh"], "kind string, canonical string")
    made = surrogates.attempts(known, KEY).collect()
    assert len(made) == known.count() and len({(r.kind, r.made) for r in made}) == len(made)
    assert not {r.made for r in made} & {r.canonical for r in made}
    assert any(r.attempt for r in made)


def test_shards(spark):
    rng = random.Random(9)
    words = ["a", "bb", "ccc"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(int(rng.paretovariate(1.2) * 5) % 3000)), rng.choice(["en", "de", None]), rng.choice(["s0"] * 5 + ["s1", None])) for i in range(1500)]
    rows += [(2000 + i, "copy " * 30, "en", f"s{i % 3}") for i in range(40)] + [(3000, None, "en", "s0"), (3001, "", "de", "s1"), (None, "x", None, None), (5, rows[5][1], "en", "s0")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, lang string, source string, shard int")
    for n in (1, 7, 24):
        got = shards.shard(docs, n).collect()
        assert len(got) == len(rows)
        sizes, slots, where, weight = [0] * n, [[] for _ in range(n)], {}, {}
        for r in got:
            sizes[r.shard] += r.size
            slots[r.shard].append(r.slot)
            where.setdefault((r.text_crc32, r.size), set()).add(r.shard)
            weight[r.text_crc32, r.size] = weight.get((r.text_crc32, r.size), 0) + r.size
        assert all(sorted(s) == list(range(len(s))) for s in slots)
        assert all(len(s) == 1 for k, s in where.items() if weight[k] <= sum(sizes) / n)
        assert max(sizes) - sum(sizes) / n <= max(r.size for r in got)
    want = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    target = sum(sizes) // 5
    assert max(r.shard for r in shards.shard(docs, target_bytes=target).collect()) == 5 - (sum(sizes) % 5 == 0)
    assert shards.shard(docs.limit(0), 24).count() == 0
    one = [r.shard for r in shards.shard(docs.limit(1), 24).collect()]
    assert len(one) == 1 and 0 <= one[0] < 24


def test_one_text_above_a_shard_is_parted(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    counts = [r["count"] for r in shards.shard(docs, 8).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) < 40


def test_texts_are_encoded_as_by_the_library(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    rng = random.Random(11)
    parts = ["The", "vida.###", "cat's", "a'S", "x.'", "wow!!!", "É.", "h\u0331", "H\u0331", "<\u0338", "x<|endoftext|>.", "<|ENDOFTEXT|>", "_", "a_", "12", "K", "ſt", "日本", "Σας,", "'", "ñandú***", "\x1c"]
    texts = [rng.choice(["", " ", "\n"]) + rng.choice([" ", "\t", "", "  "]).join(rng.choices(parts, k=rng.randrange(12))) for _ in range(400)]
    texts += [None, "", " ", "z" * 3000, "long " * 20_000]
    monkeypatch.setattr(token_store, "SLICE_BYTES", 500)
    for name, by_word in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        full = Tokenizer.from_file(public_tokenizers.path(name))
        encoder = token_store.WordEncoder(public_tokenizers.path(name), memo_bytes=3000)
        assert encoder.by_word == by_word
        column, got = pa.array(["before", *texts]).slice(1), []
        for start, rows in token_store._slices(column):
            ids, sizes = encoder.encode_all(column.slice(start, rows), 1)
            assert len(sizes) == rows and encoder.used <= 3000
            got += [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [full.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
        assert "z" * 3000 not in {w.decode("utf-8") for w in [*encoder.young, *encoder.old]}
        assert not len(list(token_store._slices(column.slice(0, 0))))
        assert [len(x) for x in encoder.encode_all(column.slice(0, 0), 1)] == [0, 0]


def test_letters_of_a_slice_are_encoded_as_by_the_library():
    import pyarrow as pa
    from tokenizers import Tokenizer

    full, encoder = Tokenizer.from_file(PATH), token_store.WordEncoder(PATH)
    texts = [form.format(chr(c)) for c in range(0x260) for form in ("{}", "x{}Y.", "{0}{0}!?", "É{}")]
    ids, sizes = encoder.encode_all(pa.array(texts), 1)
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [full.encode(t, add_special_tokens=False).ids + [1] for t in texts]


def test_forms_of_a_word_take_one_place_in_memory(monkeypatch):
    import pyarrow as pa

    rng = random.Random(8)
    words = sorted({"".join(rng.choices("abcdeéç", k=9)) for _ in range(600)})
    encoder, asked = token_store.WordEncoder(PATH, memo_bytes=150_000), []
    letters = encoder._letters
    monkeypatch.setattr(encoder, "_letters", lambda key: asked.append(key) or letters(key))
    for _ in range(3):
        rng.shuffle(words)
        forms = [form(w) for w in words for form in (str, str.capitalize, "{},".format, "{}.".format)]
        encoder.encode_all(pa.array([" ".join(forms)]), 1)
    assert sorted(k.decode("utf-8") for k in asked) == sorted(words)


def test_token_files_round_trip(spark, folder):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(PATH)
    rng = random.Random(6)
    alphabet = ["The", "cat's", "naïve", "É", "x y", "a\x1cb", "ΣΑΣ", "<|endoftext|>", "12.5", "ﬁ", "é", "İstanbul", "日本語", "!!", "_a_", "don't", " ", "ǅ", "ſ", "\n", "\t"]
    texts = [" ".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) + rng.choice(["", " ", "\n"]) for _ in range(300)]
    rows = [(rng.randrange(10_000), t) for t in texts] + [(None, "no id"), (3, None), (3, ""), (3, "a"), (3, "a"), (4, "long " * 70_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, tokens string").repartition(5)
    token_store.write_tokens(docs, f"{folder}/t", PATH)
    stored = token_store.read_tokens(spark, f"{folder}/t")
    got = stored.orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: -1 if d is None else d)
    want = sorted((str(d), full.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows)
    assert sorted((str(r.doc_id), list(r.tokens)) for r in got) == want
    start = 0
    for r in got:
        assert (r.start, r.n_tokens) == (start, len(r.tokens))
        start += r.n_tokens
    sums = {(r.start, r.n_tokens): r.ids_crc32 for r in token_store.with_crc32(stored).collect()}
    assert all(sums[r.start, r.n_tokens] == zlib.crc32(np.array(r.tokens, "<u4").tobytes()) for r in got)

    import pyarrow.parquet as pq

    group = pq.ParquetFile(sorted(glob.glob(f"{folder}/t/*.parquet"))[0]).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "RLE_DICTIONARY" in columns["tokens.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_offset_index

    token_store.write_tokens(docs.limit(0), f"{folder}/none", PATH)
    assert token_store.read_tokens(spark, f"{folder}/none").count() == 0
