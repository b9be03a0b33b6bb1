"""Stop-word lists: those that ship with Spark MLlib, kept beside this module, plus caller's additions."""

from __future__ import annotations

import functools
from importlib import resources

# Tokens added to the English list.
EXTRA_ENGLISH = ("s", "t", "2", "m", "ve")

# Languages Spark has a list for.
LANGUAGES = (
    "danish", "dutch", "english", "finnish", "french", "german", "hungarian",
    "italian", "norwegian", "portuguese", "russian", "spanish", "swedish", "turkish",
)


@functools.cache
def stop_words(language: str) -> tuple[str, ...]:
    """The list of a language; reading it needs no session."""
    if language not in LANGUAGES:
        raise ValueError(f"no stop words for {language!r}")
    raw = resources.files(__package__).joinpath("stopword_lists", f"{language}.txt").read_text(encoding="utf-8")
    return tuple(sorted({w.strip() for w in raw.splitlines() if w.strip()}))


def english_stop_words() -> tuple[str, ...]:
    """English list united with the additions."""
    return tuple(sorted(set(stop_words("english")) | set(EXTRA_ENGLISH)))
