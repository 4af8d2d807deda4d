"""Words, digits and lists held in strings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode decimal digits, as in the usual notion of "is a digit".
ANY_DIGIT = r"\p{Nd}"
ALL_DIGITS = r"^\p{Nd}*$"


def _quoted(separator: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() and not ch.isspace() else ch for ch in separator)


def split_words(text: Column, separator: str = " ") -> Column:
    """Words of ``text``: blanks at the end are dropped, inner blanks are kept.

    An empty text has one empty word; a text of separators only has none.
    """
    pattern = _quoted(separator)
    if len(separator) == 1:
        trimmed = F.rtrim(text, F.lit(separator))
    else:
        trimmed = F.regexp_replace(text, f"(?:{pattern})+$", "")
    no_words = F.array().cast("array<string>")
    return F.when((trimmed == "") & (text != ""), no_words).otherwise(F.split(trimmed, pattern, -1))


def has_digit(text: Column) -> Column:
    return text.rlike(ANY_DIGIT)


def all_digits(text: Column) -> Column:
    """True when every character is a digit; so is an empty text."""
    return text.rlike(ALL_DIGITS)


def drop_digit_words(words: Column) -> Column:
    return F.filter(words, lambda word: ~has_digit(word))


def drop_stop_words(words: Column, stop_words: Iterable[str]) -> Column:
    """Words that hold no digit and are not in a list known to the driver.

    The list becomes a hashed set in the generated code. For a list that lives
    in a table see ``operators.words.remove_stop_words``.
    """
    stops = list(stop_words)
    if not stops:
        return drop_digit_words(words)
    return F.filter(words, lambda word: ~(word.isin(*stops) | has_digit(word)))
