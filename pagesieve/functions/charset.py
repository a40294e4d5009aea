"""Charset checks, guesses and decoding, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let

_BAD = "\ufffd"

# guessed charset -> JVM charset, in the order they are tried
CANDIDATES = (
    ("iso2022_jp", "ISO-2022-JP"),
    ("euc_jp", "EUC-JP"),
    ("cp932", "windows-31j"),
    ("cp1252", "windows-1252"),
)

KANA = r"[\x{3040}-\x{30ff}]"
WESTERN_TRACES = (
    r"[A-Za-z][^\x00-\x7f]{1,2}[A-Za-z]"
    r"""|(?:^|[\s>"'(/])[^\x00-\x7f][a-z]"""
    r"|[\x{e000}-\x{f8ff}]"
)


def is_utf8(payload: Column) -> Column:
    return F.is_valid_utf8(payload.cast("string"))


def _has_escape(payload: Column) -> Column:
    # ISO-2022-JP is 7-bit; it shows by its escape sequences only
    return F.decode(payload, "ISO-8859-1").rlike(r"\x1b(?:\$[@B]|\([BJI])")


def _clean(payload: Column, jvm_name: str) -> Column:
    """Decoded text, NULL when a byte does not decode.

    A Western text can pass as a Japanese one: an accented letter and the byte
    after it then make one sign. Such a text has no kana, but signs amid or at
    the start of Latin words, or signs no font defines.
    """

    def judged(text):
        fits = ~F.contains(text, F.lit(_BAD))
        if jvm_name in ("EUC-JP", "windows-31j"):
            fits = fits & (text.rlike(KANA) | ~text.rlike(WESTERN_TRACES))
        return F.when(fits, text)

    return let(F.decode(payload, jvm_name), judged)


def guess_charset(payload: Column) -> Column:
    """Name of the first charset the bytes decode under, NULL if none does."""

    def guess(b):
        found = F.when(_has_escape(b) & _clean(b, "ISO-2022-JP").isNotNull(), "iso2022_jp").when(
            is_utf8(b), "utf-8")
        for name, jvm_name in CANDIDATES[1:]:
            found = found.when(_clean(b, jvm_name).isNotNull(), name)
        return found

    return let(payload, guess)


def decode_text(payload: Column) -> Column:
    """Bytes -> text under the guessed charset, else UTF-8 with replacement."""

    def decoded(b):
        return F.coalesce(
            F.when(_has_escape(b), _clean(b, "ISO-2022-JP")),
            F.when(is_utf8(b), b.cast("string")),
            *[_clean(b, jvm_name) for _, jvm_name in CANDIDATES[1:]],
            F.make_valid_utf8(b.cast("string")),
        )

    return let(payload, decoded)
