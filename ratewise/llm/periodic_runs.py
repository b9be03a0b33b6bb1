"""Maximal periodic runs of words, found with a dictionary of basic factors.

The words of a text become numbers. For each power of two L the factors of L
words get names: the pair of names of their halves, ranked by a sort, so that
equal factors have equal names and no hash can err. An occurrence of a factor
whose next occurrence follows within 2 L words proposes that distance as a
period; occurrences that continue one progression, or the one a word further
on, lie in one stretch and are proposed once. A proposal is extended in both
directions to the longest stretch with that period, kept if it is long enough
and no divisor of the period is a period too, and stored once.

A run of smallest period q and at least 3 q words is always found: take the
first L >= q. It is below 2 q, so a factor of L words at the run's start and its
copy q words on both lie inside; a copy at a smaller distance would make q
reducible. Short runs are found at the level whose double is still in
``min_words``. Levels end where no name repeats.

Each text is searched in its task; nothing is shuffled, and a task holds the
names of one level of one text. Defined results: a null, empty or blank text
has no words and no runs; each row is searched on its own, repeated rows alike;
an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame

from ratewise.llm import kernels as K

Run = tuple[int, int, int]


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def _common(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the common prefix, read in blocks that double."""
    n, at, step = min(len(left), len(right)), 0, 64
    while at < n:
        upto = min(n, at + step)
        differ = left[at:upto] != right[at:upto]
        if differ.any():
            return at + int(differ.argmax())
        at, step = upto, 2 * step
    return n


def _prime_factors(n: int) -> list[int]:
    found, f = [], 2
    while f * f <= n:
        if n % f == 0:
            found.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return [*found, n] if n > 1 else found


def _irreducible(words: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether no divisor of ``period`` is a period of the stretch."""
    return not any(
        np.array_equal(words[start : end - period // f], words[start + period // f : end]) for f in _prime_factors(period)
    )


def _proposals(names: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(distance, place) of each factor whose next occurrence is within twice its length, sorted."""
    order = np.argsort(names, kind="stable")
    here, there = order[:-1], order[1:]
    distance = there - here
    near = (names[here] == names[there]) & (distance <= 2 * width)
    here, distance = here[near], distance[near]
    order = np.lexsort((here, distance))
    return distance[order], here[order]


def _stretch(words: np.ndarray, at: int, period: int, width: int) -> tuple[int, int]:
    """The longest stretch with this period around two equal factors of ``width`` words."""
    start = at - _common(words[:at][::-1], words[: at + period][::-1])
    upto = at + width
    return start, upto + period + _common(words[upto:], words[upto + period :])


def find_runs(words: np.ndarray, min_words: int = 24, min_repeats: int = 3) -> list[Run]:
    """(start, length, period) of every maximal run, sorted by start, then period.

    A run has at least ``min_words`` words and ``min_repeats`` (3 or more) times its smallest period.
    """
    if min_repeats < 3 or min_words < 2:
        raise ValueError("min_repeats must be at least 3 and min_words at least 2")
    n, width, names = len(words), 1, words
    runs: set[Run] = set()
    # A factor of L words and its copy at distance L or less lie in a run of 2 L words.
    while n >= max(min_words, 2 * width):
        if 4 * width > min_words:
            distances, places = _proposals(names, width)
            k = 0
            while k < len(places):
                period = int(distances[k])
                start, end = _stretch(words, int(places[k]), period, width)
                if end - start >= max(min_words, min_repeats * period) and _irreducible(words, start, end, period):
                    runs.add((start, end - start, period))
                # Later proposals of this distance that lie in the same stretch say nothing new.
                same = int(np.searchsorted(distances, period, side="right"))
                k += max(1, int(np.searchsorted(places[k:same], end - period - width, side="right")))
        pairs = names[:-width] * (int(names.max()) + 1) + names[width:]
        unique, names = np.unique(pairs, return_inverse=True)
        if len(unique) == len(names):
            break
        width *= 2
    return sorted(runs, key=lambda run: (run[0], run[2]))


def longest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period; ties to the smallest start, then period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def repeats(n: int, runs: list[Run]) -> np.ndarray:
    """Marks the words that some run holds after its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:n]) > 0


_RUN = "struct<start: long, length: long, period: long>"


def periodic_runs(
    docs: DataFrame,
    min_words: int = 24,
    min_repeats: int = 3,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(doc_id, n_words, runs, longest, collapsed) of every document.

    ``collapsed`` is the text with each run cut to its first period, its words
    joined by one space. ``rewrite`` may change the words of a row, as UTF-8,
    before the search.
    """
    named = ("start", "length", "period")

    def run(batch):
        out = {"n_words": [], "runs": [], "longest": [], "collapsed": []}
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), K.text_bytes(batch.column("text"))):
            words = (text or b"").split()
            if rewrite is not None:
                words = rewrite(doc_id, words)
            runs = find_runs(numbered(words), min_words, min_repeats)
            if runs:
                kept = [words[i] for i in np.flatnonzero(~repeats(len(words), runs))]
            else:
                kept = words
            best = longest(runs)
            out["n_words"].append(len(words))
            out["runs"].append([dict(zip(named, r)) for r in runs])
            out["longest"].append(dict(zip(named, best)) if best else None)
            out["collapsed"].append(b" ".join(kept).decode("utf-8"))
        return out

    return K.map_batches(
        docs.select("doc_id", "text"), run, f"n_words long, runs array<{_RUN}>, longest {_RUN}, collapsed string", ("doc_id",)
    )
