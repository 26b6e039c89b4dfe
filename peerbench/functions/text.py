"""Text normalisation shared by all operators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerbench.constants import NULL_TOKENS

WHITESPACE = " \t\n\r\x0b\x0c\xa0"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def norm_key(c: Column) -> Column:
    """Codes compare trimmed and in upper case."""
    return F.upper(strip(c))


def null_token(c: Column) -> Column:
    """Trimmed text, or null where it is blank or a word for "no value"."""
    t = strip(c.cast("string"))
    return F.when(~F.lower(t).isin(*NULL_TOKENS), t)


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def blank_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def one_line(c: Column) -> Column:
    """Line breaks inside a header count as spaces."""
    return strip(F.regexp_replace(c, r"[\n\r]", " "))


def any_word(words: Sequence[str]) -> str:
    """A regex that finds any of the given literal words."""
    return "|".join(re.escape(w) for w in words)


def has_any(c: Column, words: Sequence[str]) -> Column:
    return c.rlike(any_word(words))


def parts(c: Column, n: int | Column) -> Column:
    """All different substrings of n characters; a shorter text is its own only part."""
    last = F.greatest(F.length(c) - (n - 1), F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(c, i, F.lit(n))))
