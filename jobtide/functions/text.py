"""Text predicates and folds as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word character in any script, spelled out because engines disagree on \b.
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
WORD_START = rf"(?<!{WORD})"
WORD_END = rf"(?!{WORD})"
ACCENT_IN_CLASS = re.compile(r"\[[^\]]*[^\x00-\x7f][^\]]*\]")


def fold_german(text: Column) -> Column:
    """Lower case with umlauts folded to their base vowel and ß to ss."""
    vowels = F.translate(text, "äöüÄÖÜ", "aouAOU")
    return F.lower(F.replace(vowels, F.lit("ß"), F.lit("ss")))


def ignore_case(pattern: str) -> str:
    """Case-insensitive form of a pattern.

    Java folds ASCII cheaply and everything else at a high price, so letters beyond ASCII are spelled
    out in both cases instead, unless they stand in a character class already.
    """
    if ACCENT_IN_CLASS.search(pattern):
        return "(?iu)" + pattern
    return "(?i)" + "".join(both_cases(c) for c in pattern)


def both_cases(letter: str) -> str:
    """The letter as an expression, in both cases if it is beyond ASCII."""
    other = letter.swapcase()
    if letter.isascii() or len(other) != 1 or other == letter:
        return letter
    return f"[{letter}{other}]"


def finds(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


def finds_ignoring_case(text: Column, pattern: str) -> Column:
    return text.rlike(ignore_case(pattern))


def bounded(pattern: str, grouped: bool = True) -> str:
    """Put word boundaries around a pattern.

    Ungrouped, the boundaries bind to the first and last alternative only, so `a|b` also finds
    words that merely start with `a` or end with `b`.
    """
    inner = f"(?:{pattern})" if grouped else pattern
    return f"{WORD_START}{inner}{WORD_END}"


def finds_word(text: Column, pattern: str) -> Column:
    return finds_ignoring_case(text, bounded(pattern))


def has_text(text: Column, more_than: int) -> Column:
    return text.isNotNull() & (F.length(text) > more_than)


def in_context(text: Column, pattern: str, chars: int = 45) -> Column:
    """The first match with up to `chars` characters on either side, on one line."""
    around = f".{{0,{chars}}}"
    window = f"(?s)({around}{bounded(pattern)}{around})"
    found = F.regexp_extract(F.lower(text), window, 1)
    return F.replace(F.nullif(found, F.lit("")), F.lit("\n"), F.lit(" "))


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def stage_label(stage: Column) -> Column:
    return F.replace(stage, F.lit("_"), F.lit(" "))
