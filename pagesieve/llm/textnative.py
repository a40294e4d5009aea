"""Column functions on words and lines that stay in the JVM.

Words are ``[^\\x20\\x09-\\x0D]+``, lines are cut at ``\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def without(text: Column, signs: str) -> Column:
    """``text`` without any of ``signs``; searching for a sign is faster than translating every one."""
    for sign in signs:
        text = F.replace(text, F.lit(sign), F.lit(""))
    return text


def words(text: Column) -> Column:
    """All words in order; null has none."""
    spaced = F.coalesce(text, F.lit(""))
    for sign in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(sign), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    """Number of words, without making them."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def lines_with_words(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: without(x, BLANKS) != "")
