"""The crawl's own page annotation: ``key: value`` lines with embedded JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

LANGUAGES_TYPE = (
    "STRUCT<reliable: BOOLEAN, `text-bytes`: BIGINT, languages: ARRAY<STRUCT<"
    "code: STRING, `code-iso-639-3`: STRING, `text-covered`: DOUBLE, score: DOUBLE, name: STRING>>>"
)


def _trim(text: Column) -> Column:
    return F.btrim(text, F.lit(P.TEXT_SPACE))


def parse_header_lines(block: Column, lower_keys: bool = False, first_wins: bool = False) -> Column:
    """CRLF lines holding a colon -> map, split at the first colon, both sides trimmed.

    A repeated key keeps its last value, or its first with ``first_wins``.
    """
    lines = F.filter(F.split(block, "\r\n"), lambda x: F.contains(x, F.lit(":")))

    def entry(line):
        key = F.substring_index(line, ":", 1)
        name = _trim(key)
        return F.struct(
            (F.lower(name) if lower_keys else name).alias("key"),
            _trim(F.substr(line, F.length(key) + 2)).alias("value"),
        )

    entries = F.transform(lines, entry)
    return F.map_from_entries(F.reverse(entries) if first_wins else entries)


def raw_fields(payload: Column) -> Column:
    """Annotation payload -> MAP<STRING, STRING> with unparsed values."""
    return parse_header_lines(payload.cast("string"))


def looks_braced(value: Column) -> Column:
    return F.startswith(value, F.lit("{")) & F.endswith(value, F.lit("}"))


def parsed_value(value: Column, json: str = "braces") -> Column:
    """One annotation value as VARIANT.

    ``braces``: only values that start with ``{`` and end with ``}`` are JSON.
    ``any``: every value that is valid JSON. Other values stay strings. A braced
    value that is not JSON becomes NULL under ``braces``; see ``malformed_fields``.
    """
    as_json = F.try_parse_json(value)
    as_text = F.to_variant_object(F.array(value))
    text = F.variant_get(as_text, "$[0]", "variant")
    if json == "braces":
        return F.when(looks_braced(value), as_json).otherwise(text)
    if json == "any":
        return F.coalesce(as_json, text)
    raise ValueError("json must be 'braces' or 'any'")


def parse_fields(payload: Column, json: str = "braces") -> Column:
    """Annotation payload -> MAP<STRING, VARIANT>."""
    return F.transform_values(raw_fields(payload), lambda _, v: parsed_value(v, json))


def malformed_fields(fields: Column) -> Column:
    """True when a braced value of a raw field map is not JSON."""
    return F.exists(
        F.map_values(fields), lambda v: looks_braced(v) & F.try_parse_json(v).isNull()
    )


def language_report(fields: Column) -> Column:
    """Typed view of the language entry of a raw field map; NULL if absent."""
    value = F.element_at(fields, P.LANGUAGE_KEY)
    return F.when(looks_braced(value), F.from_json(value, LANGUAGES_TYPE))


def annotated_languages(fields: Column) -> Column:
    return language_report(fields)["languages"]


def dominant_language(languages: Column) -> Column:
    """Code with the highest ``text-covered``; the first one on ties."""
    ranked = F.transform(
        languages,
        lambda x, i: F.struct(x["text-covered"].alias("n"), (-i).alias("i"), x["code"].alias("code")),
    )
    return F.array_max(ranked)["code"]
