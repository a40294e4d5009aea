"""Predicates and flags on records and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.annotation import annotated_languages, dominant_language
from .skew import lookup_join


def http_header(name: str, headers: str = "http_headers") -> Column:
    """An HTTP header by name, in any case."""
    return F.element_at(F.col(headers), name.lower())


def is_html_response(match: str = "exact", headers: str = "http_headers") -> Column:
    """A stored response served as HTML.

    ``exact``: the content type is just ``text/html``; with parameters behind it
    the page is not taken. ``prefix`` takes those too.
    """
    kind = http_header("content-type", headers)
    if match == "exact":
        html = kind == P.HTML_CONTENT_TYPE
    elif match == "prefix":
        html = kind.rlike(r"(?i)^text/html\s*(;|$)")
    else:
        raise ValueError("match must be 'exact' or 'prefix'")
    return (F.col("rec_type") == "response") & html


def is_metadata() -> Column:
    return F.col("rec_type") == "metadata"


def has_language_annotation(fields: Column) -> Column:
    return annotated_languages(fields).isNotNull()


def dominant_language_is(fields: Column, target: str) -> Column:
    return F.coalesce(dominant_language(annotated_languages(fields)) == target, F.lit(False))


def filter_extracted(df: DataFrame, text: str = "text") -> DataFrame:
    """Pages whose extraction gave text."""
    return df.where(F.col(text).isNotNull())


def flag_too_short(df: DataFrame, text: str = "text", min_chars: int = P.SHORT_TEXT_BELOW) -> DataFrame:
    """Add ``rejected`` and ``rejected_reason``; rows are flagged, not dropped."""
    short = F.length(text) < min_chars
    return df.withColumn("rejected", short).withColumn(
        "rejected_reason", F.when(short, P.REJECTED_SHORT).otherwise(F.lit(""))
    )


def size_guard(df: DataFrame, max_bytes: int, payload: str = "payload") -> DataFrame:
    """Pages cheap enough to extract. See :func:`size_guard_report` for the rest."""
    return df.where(F.octet_length(payload) <= max_bytes)


def size_guard_report(df: DataFrame, max_bytes: int, payload: str = "payload") -> DataFrame:
    """Pages and bytes on either side of the size guard."""
    return df.groupBy((F.octet_length(payload) <= max_bytes).alias("kept")).agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.octet_length(payload)).alias("bytes")
    )


def drop_failed_archives(df: DataFrame, failures: DataFrame, spread) -> DataFrame:
    """All rows of a failed archive go. ``spread``: columns that differ within an archive.

    ``failures`` lists archives, so it is small next to the rows, yet one
    failed archive may hold many of them.
    """
    return lookup_join(df, failures.select("warc_path").distinct(), ["warc_path"], "left_anti", spread)
