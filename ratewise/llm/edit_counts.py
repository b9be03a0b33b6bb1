"""Token counts that follow edits without encoding whole texts again.

For tokenizers that never join characters across white space, a text is a run
of pre-tokens (words and the white space before them) with independent counts.
A document keeps a segment tree: leaves of up to LEAF_WORDS words with their
characters and tokens, inner nodes with the sums. An edit is located by
descending on characters; the words it touches, out to the next white space on
both sides, are counted before and after, and the difference is added to the
leaf and to the nodes above it.

Defined results: a null text counts as empty; an edit reaching past the end is
cut there; edits of one document are applied in the order of ``seq``, each
against the text that the ones before left, equal ``seq`` by position and text;
a null or empty edit list changes nothing; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm import kernels as K
from ratewise.llm.token_store import WordEncoder

LEAF_WORDS = 32
_BLANK = " \t\n\r\v\f"
_WORDS = re.compile(rf"[{_BLANK}]*[^{_BLANK}]+")

#: Type of the edits of one document: replace ``n_deleted`` characters from ``start`` by ``inserted``.
EDITS = "array<struct<seq: long, start: long, n_deleted: long, inserted: string>>"
_TREE = "leaf_chars array<int>, leaf_tokens array<int>"


@functools.cache
def _encoder(path: str) -> WordEncoder:
    encoder = WordEncoder(path)
    if not encoder.by_word:
        raise ValueError(f"{path} joins characters across white space; counts of its parts don't add up")
    return encoder


class SegmentTree:
    """Sums of characters and tokens over the leaves, as a heap in one array."""

    def __init__(self, chars, tokens):
        self.n = len(chars)
        self.width = 1 << max(0, self.n - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width : self.width + self.n, 0] = chars
        self.sums[self.width : self.width + self.n, 1] = tokens
        for i in range(self.width - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    def leaf_of(self, position: int) -> tuple[int, int]:
        """Leaf that holds a character, and the characters before the leaf."""
        node, before = 1, 0
        while node < self.width:
            left = int(self.sums[2 * node, 0])
            if position - before < left:
                node = 2 * node
            else:
                before, node = before + left, 2 * node + 1
        leaf = min(node - self.width, self.n - 1)
        if leaf < node - self.width:  # the end of the text belongs to the last leaf
            before = int(self.sums[1, 0]) - int(self.sums[self.width + leaf, 0])
        return leaf, before

    def add(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.width + leaf
        while node:
            self.sums[node] += (chars, tokens)
            node //= 2

    @property
    def leaves(self) -> np.ndarray:
        return self.sums[self.width : self.width + self.n]


def _leaves(text: str, encoder: WordEncoder) -> tuple[list[int], list[int]]:
    """Characters and tokens of each leaf; white space at the end joins the last one."""
    chars, tokens = [], []
    ends = [m.end() for m in _WORDS.finditer(text)][LEAF_WORDS - 1 :: LEAF_WORDS]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    start = 0
    for end in ends:
        chars.append(end - start)
        tokens.append(_count(text[start:end], encoder))
        start = end
    return chars, tokens


def _count(text: str, encoder: WordEncoder) -> int:
    return len(encoder.encode(text.encode("utf-8", "surrogatepass"))) // 4


def _edge(text: str, at: int, step: int) -> int:
    """The next white space (or end) from ``at`` going left or right."""
    if step < 0:
        while at > 0 and text[at - 1] not in _BLANK:
            at -= 1
    else:
        while at < len(text) and text[at] not in _BLANK:
            at += 1
    return at


class CountedText:
    """A text with the segment tree of its counts."""

    def __init__(self, text: str, chars, tokens, encoder: WordEncoder):
        self.text, self.tree, self.encoder = text, SegmentTree(chars, tokens), encoder
        self.encoded = 0

    def edit(self, start: int, n_deleted: int, inserted: str) -> None:
        start = max(0, min(start, len(self.text)))
        end = min(len(self.text), start + max(0, n_deleted))
        a, b = _edge(self.text, start, -1), _edge(self.text, end, 1)
        old, new = self.text[a:b], self.text[a:start] + inserted + self.text[end:b]
        change = _count(new, self.encoder) - _count(old, self.encoder)
        self.encoded += len(old) + len(new)
        # The characters go leaf by leaf; all of the change in tokens goes to the leaf of the first
        # touched word, after the counts of the other touched leaves have moved there.
        first, before = self.tree.leaf_of(a)
        self.text = self.text[:start] + inserted + self.text[end:]
        last, _ = self.tree.leaf_of(max(a, b - 1))
        if last > first:  # the region spans leaves: they become one
            part = self.tree.leaves[first + 1 : last + 1].copy()
            for i, (c, t) in enumerate(part, first + 1):
                self.tree.add(i, -int(c), -int(t))
                self.tree.add(first, int(c), int(t))
        self.tree.add(first, len(new) - len(old), change)
        chars = int(self.tree.leaves[first, 0])
        if chars > 64 * LEAF_WORDS:
            self._split(first, before, chars)

    def _split(self, leaf: int, before: int, chars: int) -> None:
        """Cut a leaf that edits have grown; only its own characters are counted again."""
        piece = self.text[before : before + chars]
        self.encoded += len(piece)
        more = _leaves(piece, self.encoder)
        if len(more[0]) > 1:
            old = self.tree.leaves
            self.tree = SegmentTree(*(np.concatenate([old[:leaf, k], more[k], old[leaf + 1 :, k]]) for k in (0, 1)))

    @property
    def n_tokens(self) -> int:
        return int(self.tree.sums[1, 1])


def build(docs: DataFrame, tokenizer: str, *keep: str) -> DataFrame:
    """(doc_id, text, leaf_chars, leaf_tokens) and the columns in ``keep``: the leaves of each document's tree."""

    def run(batch):
        chars, tokens = [], []
        for text in batch.column("text").to_pylist():
            c, t = _leaves(text or "", _encoder(tokenizer))
            chars.append(c)
            tokens.append(t)
        return {"leaf_chars": chars, "leaf_tokens": tokens}

    kept = ("doc_id", "text", *keep)
    return K.map_batches(docs.select(*kept), run, _TREE, kept)


def apply_edits(trees: DataFrame, tokenizer: str) -> DataFrame:
    """Apply the ``edits`` column (type EDITS) to each row of ``build``.

    (doc_id, text, leaf_chars, leaf_tokens, n_edits, tokens_before, tokens_after,
    n_chars, chars_encoded): the new state, the counts, and how many characters
    were encoded for the change.
    """
    schema = f"text string, {_TREE}, n_edits long, tokens_before long, tokens_after long, n_chars long, chars_encoded long"
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def run(batch):
        out = {name: [] for name in names}
        columns = (batch.column(c).to_pylist() for c in ("text", "leaf_chars", "leaf_tokens", "edits"))
        for text, chars, tokens, edits in zip(*columns):
            counted = CountedText(text or "", chars, tokens, _encoder(tokenizer))
            before = counted.n_tokens
            ordered = sorted(edits or [], key=lambda e: (e["seq"] or 0, e["start"] or 0, e["inserted"] or ""))
            for e in ordered:
                counted.edit(e["start"] or 0, e["n_deleted"] or 0, e["inserted"] or "")
            leaves = counted.tree.leaves
            row = (counted.text, leaves[:, 0], leaves[:, 1], len(ordered), before, counted.n_tokens, len(counted.text), counted.encoded)
            for name, value in zip(names, row):
                out[name].append(value)
        return out

    return K.map_batches(trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits"), run, schema, ("doc_id",))


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Bring a table of edits (doc_id, seq, start, n_deleted, inserted) to the documents they change."""
    listed = edits.groupBy(F.col("doc_id").alias("_doc")).agg(
        F.collect_list(F.struct("seq", "start", "n_deleted", "inserted")).cast(EDITS).alias("edits")
    )
    return trees.join(listed, trees["doc_id"] == F.col("_doc"), "left").drop("_doc")
