"""Regular expressions over bytes.

A page's charset is unknown when its tags are searched, so patterns must see
bytes. Decoding as ISO-8859-1 maps every byte to one character; a match is
turned back into its bytes by encoding the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def byte_view(payload: Column) -> Column:
    """Binary column -> string with one character per byte."""
    return F.decode(payload, "ISO-8859-1")


def view_bytes(view: Column) -> Column:
    """Inverse of :func:`byte_view`."""
    return F.encode(view, "ISO-8859-1")


def first_group(view: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match; NULL without a match, ``''`` for an empty group.

    The subject is scanned once; the group is then taken from the (short)
    whole match.
    """
    whole = F.nullif(F.regexp_extract(view, pattern, 0), F.lit(""))
    return F.regexp_extract(whole, pattern, group)


def all_groups(view: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(view, F.lit(pattern), F.lit(group))


def longest(candidates: Column) -> Column:
    """Longest element of an array, the first one on ties; NULL if empty."""
    ranked = F.transform(
        candidates,
        lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("i"), x.alias("x")),
    )
    return F.array_max(ranked)["x"]
