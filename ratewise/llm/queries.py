"""Registered queries of the operators: production parameters, whole tables, contract columns."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import (
    decontamination,
    edit_counts,
    line_dedup,
    mixing,
    near_dup,
    periodic_runs,
    quality,
    shards,
    signature_join,
    surrogates,
    token_store,
    toxicity,
    turn_repair,
)
from ratewise.session import scratch_path

QUERIES = {}
ORACLE = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- op2: mixing ------------------------------------------------------------------

_WORD = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"

_MIX_SQL = f"""WITH sized AS (
  SELECT doc_id, source, len({_WORD.format("coalesce(text, '')")}) AS size,
    md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS digest FROM documents),
ranked AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
  row_number() OVER (ORDER BY source ASC NULLS LAST) AS r FROM sized GROUP BY source),
weighted AS (SELECT source, source_size, [5.0, 2.0, 1.0][(r - 1) % 3 + 1]::DOUBLE AS w, source_size * 3.0::DOUBLE AS cap FROM ranked),
shared AS (SELECT *, sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER before, 0.0) AS rest,
    sum(w) OVER () - coalesce(sum(w) OVER before, 0.0) AS open
  FROM weighted WINDOW before AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(rest / open, cap / w) AS level FROM shared WHERE NOT cap * open <= w * rest),
plan AS (SELECT source, source_size, CASE WHEN cap * open <= w * rest THEN cap ELSE w * level END AS target
  FROM shared LEFT JOIN level ON true),
whole AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM plan),
running AS (SELECT source, digest, sum(size) AS s, sum(sum(size)) OVER (PARTITION BY source ORDER BY digest) AS upto
  FROM sized GROUP BY source, digest),
cuts AS (SELECT w.source, max(digest) AS cut FROM whole w JOIN running r ON w.source IS NOT DISTINCT FROM r.source
  WHERE upto - s / 2.0::DOUBLE <= target - whole * source_size GROUP BY w.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (whole + CASE WHEN digest <= cut THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s JOIN whole w ON s.source IS NOT DISTINCT FROM w.source LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source"""


@register("op2_mixing", _MIX_SQL)
def op2_mixing(spark, sf_dir):
    """Weights 5, 2, 1 over the sources, all words shared out, at most 3 repetitions."""
    mixed = mixing.mix(documents(spark, sf_dir), weights=(5, 2, 1), budget=1.0, max_epochs=3.0, seed=17)
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


# --- op5: line dedup ---------------------------------------------------------------

_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINES_SQL = f"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT row, i, lines[i] AS line,
    {_ASCII_LOWER.format("trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM (SELECT row, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)),
frequent AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10),
kept AS (SELECT row, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text FROM lines
  WHERE key NOT IN (SELECT key FROM frequent) GROUP BY row)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row)"""


@register("op5_line_dedup", _LINES_SQL)
def op5_line_dedup(spark, sf_dir):
    """Lines whose key is in at least 10 documents are dropped everywhere."""
    cleaned = line_dedup.drop_lines(documents(spark, sf_dir), min_docs=10, min_chars=1)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


# --- op7: benchmark decontamination --------------------------------------------------

_ALNUM_WORDS = f"regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_LEAKS_SQL = f"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_ALNUM_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_ALNUM_WORDS} AS words FROM benchmark),
wins AS (SELECT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT n FROM wins),
doc_wins AS (SELECT row, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT row, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, lengths WHERE len(words) >= n)),
found AS (SELECT DISTINCT d.row, d.i, d.n, w.item_id FROM doc_wins d JOIN wins w ON d.n = w.n AND d.win = w.win),
hit AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM found) GROUP BY row),
held AS (SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN held USING (row)"""


@register("op7_decontamination", _LEAKS_SQL)
def op7_decontamination(spark, sf_dir):
    """Spans of 10 words that documents share with benchmark items, by winnowed 5-grams."""
    found = decontamination.scan(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), span=10, k=5)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


# --- op10: near duplicates -----------------------------------------------------------

def _linked_sql(percent: int, columns: str) -> str:
    """Components of documents by the similarity of their sets of 3-word shingles."""
    return f"""WITH RECURSIVE docs AS (SELECT doc_id, {_WORD.format(_ASCII_LOWER.format("coalesce(text, '')"))} AS words FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + least(len(words), 3) - 1], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM docs WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT p.a, p.b FROM pairs p JOIN sizes x ON p.a = x.doc_id JOIN sizes y ON p.b = y.doc_id
  WHERE 100 * p.both >= {percent} * (x.n + y.n - p.both)),
reach(a, b) AS (SELECT doc_id, doc_id FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, {columns}
FROM docs d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON d.doc_id = r.a"""


@register("op10_near_dup", _linked_sql(85, "r.component_id, d.doc_id = r.component_id AS kept"))
def op10_near_dup(spark, sf_dir):
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.85 or more."""
    return near_dup.near_duplicates(documents(spark, sf_dir), shingle=3, similarity=0.85)


# --- op3: toxicity; no SQL twin, tested by held-out accuracy ---------------------------


@register("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    return toxicity.scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


# --- op8: token ids; no SQL twin, tested by an exact round trip ------------------------


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op8_token_ids")
def op8_token_ids(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(documents(spark, sf_dir), path, vocabulary(), end_id=1)
    return token_store.with_crc32(token_store.read_tokens(spark, path))


# --- op9: quality rules --------------------------------------------------------------

_STRIPPED = "regexp_replace({0}, '[\\x20\\x09-\\x0D]', '', 'g')"


def _bins_sql() -> str:
    values = {
        "symbol_share": "10000 * n_symbols // greatest(word_chars, 1)",
        "dup_line_share": "10000 * n_dup_lines // greatest(n_lines, 1)",
        "repeat_share": "10000 * n_repeat_words // greatest(n_words, 1)",
        "word_length": "100 * word_chars // greatest(n_words, 1)",
    }
    rows = [
        f"SELECT row, '{name}' AS measure, {least} AS spread, {low} AS low_fails, least({values[name]} // {width}, {quality.BINS - 1}) AS bin FROM rated"
        for name, (width, least, low) in quality.MEASURES.items()
    ]
    return " UNION ALL ".join(rows)


def _quartile_sql(group: str) -> str:
    by = f"{group}, " if group else ""
    return f"""(SELECT {by}measure, max(total) AS total, min(bin) FILTER (4 * upto >= total) AS q1, min(bin) FILTER (4 * upto >= 3 * total) AS q3
      FROM (SELECT {by}measure, bin, sum(n) OVER (PARTITION BY {by}measure ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {by}measure) AS total
        FROM (SELECT {by}measure, bin, count(*) AS n FROM good GROUP BY ALL)) GROUP BY {by}measure)"""


_QUALITY_SQL = f"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text,
    {_WORD.format("coalesce(text, '')")} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length({_STRIPPED.format("x")}) > 0) AS lines FROM documents),
wins AS (SELECT row, i, array_to_string(words[i:i + 7], ' ') AS win
  FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS i FROM docs WHERE len(words) >= 8)),
again AS (SELECT row, count(DISTINCT p) AS n FROM (
  SELECT row, unnest(range(i, i + 8)) AS p FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS c FROM wins) WHERE c > 1) GROUP BY row),
numbers AS (SELECT row, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length({_STRIPPED.format("text")}) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM docs LEFT JOIN again USING (row)),
rated AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM numbers),
binned AS ({_bins_sql()}),
good AS (SELECT lang, source, measure, bin FROM binned JOIN rated USING (row) WHERE NOT base_failed),
picked AS (SELECT s.lang, s.source, s.measure,
    CASE WHEN s.total >= 50 THEN s.q1 WHEN l.total >= 50 THEN l.q1 ELSE a.q1 END AS q1,
    CASE WHEN s.total >= 50 THEN s.q3 WHEN l.total >= 50 THEN l.q3 ELSE a.q3 END AS q3
  FROM {_quartile_sql("lang, source")} s JOIN {_quartile_sql("lang")} l ON s.lang IS NOT DISTINCT FROM l.lang AND s.measure = l.measure
    JOIN {_quartile_sql("")} a ON s.measure = a.measure),
verdict AS (SELECT b.row, bool_and(p.q1 IS NOT NULL AND b.bin <= p.q3 + greatest(3 * (p.q3 - p.q1), b.spread)
    AND (NOT b.low_fails OR b.bin >= p.q1 - greatest(3 * (p.q3 - p.q1), b.spread))) AS passed
  FROM binned b JOIN rated r USING (row) LEFT JOIN picked p
    ON r.lang IS NOT DISTINCT FROM p.lang AND r.source IS NOT DISTINCT FROM p.source AND b.measure = p.measure GROUP BY b.row)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND passed AS kept
FROM rated JOIN verdict USING (row)"""


@register("op9_quality_rules", _QUALITY_SQL)
def op9_quality_rules(spark, sf_dir):
    """Base rules of 20 words and 30 per cent, then fences per language and source."""
    rated = quality.assess(documents(spark, sf_dir), min_group=50, fences=3)
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# --- op6: sharding; the tree has no SQL twin, tested by balance and invariants ----------


@register("op6_sharding")
def op6_sharding(spark, sf_dir):
    """24 shards of near equal bytes; equal texts share a shard."""
    dealt = shards.shard(documents(spark, sf_dir), n_shards=24)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# --- op4: surrogates for personal data; no SQL twin, tested on planted entities ----------

_PII_KEY = b"key of the registered query; a caller brings its own"


@register("op4_pii_surrogates")
def op4_pii_surrogates(spark, sf_dir):
    """Every text with its personal data replaced."""
    return surrogates.pseudonymised(documents(spark, sf_dir), _PII_KEY)


# --- op1: edit-aware token counts; no SQL twin, tested against full encoding --------------


def _derived_edits():
    """Three edits of every document, at places that follow from its id: insert, delete, replace."""
    place = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.length(F.coalesce("text", F.lit(""))) + 1)
    edit = lambda seq, n, text: F.struct(
        F.lit(seq).cast("long").alias("seq"),
        place(seq).alias("start"),
        F.lit(n).cast("long").alias("n_deleted"),
        F.coalesce(text, F.lit("")).alias("inserted"),
    )
    return F.array(
        edit(1, 0, F.concat(F.lit(" "), "source", F.lit(" "))), edit(2, 20, F.lit("")), edit(3, 5, F.col("lang"))
    ).cast(edit_counts.EDITS)


@register("op1_edit_counts")
def op1_edit_counts(spark, sf_dir):
    """Token counts of every document before and after three edits."""
    trees = edit_counts.build(documents(spark, sf_dir).withColumn("edits", _derived_edits()), vocabulary(), "edits")
    return edit_counts.apply_edits(trees, vocabulary()).select(
        "doc_id", "n_edits", "tokens_before", "tokens_after", "n_chars", "chars_encoded"
    )


# --- op11: conversation structure ---------------------------------------------------------

# CRC-32 in SQL: the table of all bytes, and the checksum of an ASCII string with it.
_CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: xor(x >> 1, (x & 1) * 3988292384)) ORDER BY b) AS t FROM range(256) r(b))"""


def _crc_sql(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda x, c: xor(x >> 8, t[(xor(x, c) & 255) + 1])), 4294967295)"


# Edits in SQL: every state keeps its cheapest repair so far, with the audit and the text themselves.
_REPAIR_SQL = f"""WITH RECURSIVE {_CRC_TABLE},
rows AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS h FROM conversations, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM rows WHERE h <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, left(role, 1) AS initial,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
judged AS (SELECT *, CASE WHEN bare = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal FROM placed),
inserts(p, q, cost, letters, added) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 5, 'I', 'user:' || chr(10)), (1, 2, 5, 'I', 'user:' || chr(10)), (3, 2, 5, 'I', 'user:' || chr(10)), (2, 3, 5, 'I', 'assistant:' || chr(10)),
    (0, 3, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 3, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
edits(p, q, cost, letter, initial, given) AS (VALUES (0, 0, 2, 'D', '', ''), (1, 1, 2, 'D', '', ''), (2, 2, 2, 'D', '', ''), (3, 3, 2, 'D', '', ''),
    (0, 1, 0, 'K', 's', ''), (0, 2, 0, 'K', 'u', ''), (1, 2, 0, 'K', 'u', ''), (3, 2, 0, 'K', 'u', ''), (2, 3, 0, 'K', 'a', ''),
    (0, 2, 1, 'R', '', 'user'), (1, 2, 1, 'R', '', 'user'), (3, 2, 1, 'R', '', 'user'), (2, 3, 1, 'R', '', 'assistant')),
best(conv_id, i, state, way) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'text': ''}} FROM damaged
  UNION ALL
  SELECT b.conv_id, b.i + 1, e.q, min({{
      'cost': b.way.cost + n.cost + e.cost + CASE WHEN e.letter <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END,
      'audit': b.way.audit || n.letters || e.letter,
      'text': b.way.text || n.added || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN j.role || ':' || j.text || chr(10) ELSE e.given || ':' || j.text || chr(10) END}})
  FROM best b JOIN judged j ON b.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = b.i + 1
    JOIN inserts n ON n.p = b.state
    JOIN edits e ON e.p = n.q AND (e.letter = 'D' OR j.fault IS NULL OR j.fault = 'truncated') AND (e.letter <> 'K' OR e.initial = j.initial)
  GROUP BY b.conv_id, b.i + 1, e.q),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM judged GROUP BY conv_id),
ended AS (SELECT b.conv_id, min({{'cost': b.way.cost + n.cost, 'audit': b.way.audit || n.letters, 'text': b.way.text || n.added}}) AS way
  FROM best b JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.n JOIN inserts n ON n.p = b.state AND n.q IN (0, 3) GROUP BY b.conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(way.cost, 0) AS BIGINT) AS cost, coalesce(way.audit, '') AS audit,
  sha256(CASE WHEN length(way.text) > 0 THEN left(way.text, length(way.text) - 1) ELSE '' END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id"""


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Turns with planted faults, by a checksum of ``conv_id:turn``; nulls are one space."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    told = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("_kind"))
    is_kind = lambda n: F.col("_kind") == n
    text = F.when(is_kind(1), "").when(is_kind(2), F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(is_kind(3), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return told.where(~is_kind(0)).select(
        "conv_id", "turn", F.when(is_kind(4), "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("_copy")
    ).drop("_copy")


def _same_conv(left: DataFrame, right: DataFrame):
    return left["conv_id"].eqNullSafe(right["conv_id"])


@register("op11_turn_repair", _REPAIR_SQL)
def op11_turn_repair(spark, sf_dir):
    """Least repairs of all conversations after planted faults."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    report, repaired = turn_repair.repair(damaged_turns(turns))
    digests = turn_repair.conversation_digests(repaired)
    every = turns.select("conv_id").distinct()
    told = every.join(report, _same_conv(every, report), "left").drop(report["conv_id"])
    told = told.join(digests, _same_conv(every, digests), "left").drop(digests["conv_id"])
    number = lambda name: F.coalesce(name, F.lit(0).cast("long")).alias(name)
    # A conversation without turns after the damage has no report: zeros; a gap that 64 bits cannot tell stays null.
    return told.select(
        "conv_id",
        F.when(F.col("audit").isNull(), F.lit(0).cast("long")).otherwise(F.col("gaps")).alias("gaps"),
        *map(number, ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


# --- op12: periodic runs ----------------------------------------------------------------

_RUNS_SQL = f"""WITH {_CRC_TABLE},
split AS (SELECT row_number() OVER () AS row, doc_id, {_WORD.format("coalesce(text, '')")} AS words FROM documents),
hashed AS (SELECT row, doc_id, words, len(words) AS n, {_crc_sql("CAST(doc_id AS VARCHAR)")} AS h FROM split, crc),
aimed AS (SELECT *, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a FROM hashed),
sized AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM aimed),
docs AS (SELECT row, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n),
    lambda i: words[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE words END AS words FROM sized),
places AS (SELECT row, n, CAST(unnest(range(n)) AS BIGINT) AS i, unnest(words) AS w FROM docs),
equal AS (SELECT x.row, x.i, y.i - x.i AS q FROM places x JOIN places y ON x.row = y.row AND x.w = y.w AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
stretches AS (SELECT row, q, min(i) AS s, count(*) + q AS len FROM
  (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM equal) GROUP BY row, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT * FROM stretches x WHERE NOT EXISTS
  (SELECT 1 FROM stretches y WHERE y.row = x.row AND y.q < x.q AND y.s <= x.s AND y.s + y.len >= x.s + x.len)),
listed AS (SELECT row, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS text FROM runs GROUP BY row),
best AS (SELECT * FROM runs x WHERE NOT EXISTS (SELECT 1 FROM runs y WHERE y.row = x.row AND
  (y.len * x.q > x.len * y.q OR (y.len * x.q = x.len * y.q AND (y.s < x.s OR (y.s = x.s AND y.q < x.q)))))),
dropped AS (SELECT DISTINCT row, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT row, string_agg(w, ' ' ORDER BY i) AS text FROM places ANTI JOIN dropped USING (row, i) GROUP BY row)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(s AS BIGINT) AS start, CAST(len AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
  CAST(1000 * len // q AS BIGINT) AS exponent_milli, sha256(coalesce(l.text, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed l USING (row) LEFT JOIN best USING (row) LEFT JOIN kept k USING (row)"""


def planted_run(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by their id, ends in a repetition of some of its own words; a row without id stays as it is."""
    if doc_id is None or not words:
        return words
    part, rest = divmod(zlib.crc32(str(doc_id).encode("ascii")), 10)
    if rest:
        return words
    n = len(words)
    at = part % n
    period = 1 + (n - at) // (3 + part % 8)
    return words[:at] + [words[at + i % period] for i in range(n - at)]


def _sha256(text):
    return F.sha2(text.cast("binary"), 256)


@register("op12_periodic_runs", _RUNS_SQL)
def op12_periodic_runs(spark, sf_dir):
    """Runs of at least 24 words and three periods in every text, a tenth of them with a planted one."""
    found = periodic_runs.periodic_runs(documents(spark, sf_dir), min_words=24, min_repeats=3, rewrite=planted_run)
    line = lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(F.expr("(1000 * longest.length) div longest.period")).alias("exponent_milli"),
        _sha256(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"),
        _sha256(F.col("collapsed")).alias("collapsed_sha256"),
    )


# --- op13: n-gram Jaccard join ------------------------------------------------------------


@register("op13_jaccard_join", _linked_sql(90, "r.component_id"))
def op13_jaccard_join(spark, sf_dir):
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return signature_join.jaccard_components(documents(spark, sf_dir), shingle=3, similarity=0.9)
