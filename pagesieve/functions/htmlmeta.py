"""Metadata of an HTML page, searched in its bytes.

Every function takes the byte view of a page (see ``bytesview``) and gives a
string column; NULL means "not present".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .bind import let
from .bytesview import all_groups, first_group, longest, view_bytes
from .charset import decode_text


def _text(view: Column) -> Column:
    return decode_text(view_bytes(view))


def html_lang(view: Column) -> Column:
    """Value of the last ``lang="`` on the line of the ``<html`` tag."""
    return first_group(view, P.HTML_LANG)


def declared_charset(view: Column) -> Column:
    """Charset named by the XML declaration or a meta tag."""
    return let(
        F.regexp_extract(view, P.DECLARED_CHARSET, 0),
        lambda whole: F.coalesce(*[
            F.nullif(F.regexp_extract(whole, P.DECLARED_CHARSET, g), F.lit("")) for g in (1, 2, 3, 4)
        ]),
    )


def meta_description(view: Column) -> Column:
    return _text(longest(all_groups(view, P.DESCRIPTION_META, 2)))


def meta_title(view: Column) -> Column:
    """Longest title meta tag; the title element only when there is no such tag."""
    tagged = longest(all_groups(view, P.TITLE_META, 2))
    return _text(F.coalesce(tagged, first_group(view, P.TITLE_TAG)))


def meta_heading(view: Column) -> Column:
    """Longest h1-h6 content without inner tags."""
    cleaned = F.transform(
        all_groups(view, P.HEADING, 1),
        lambda h: F.btrim(F.regexp_replace(h, P.ANY_TAG, ""), F.lit(P.BYTE_SPACE)),
    )
    return _text(longest(cleaned))


def lang_probe(description: Column, title: Column, heading: Column) -> Column:
    """Text a language is identified on: description, else title, else heading.

    The later ones are not evaluated when an earlier one is long enough.
    """

    def over(value, limit):
        return let(value, lambda v: F.when(F.length(v) > limit, v))

    chosen = F.coalesce(
        over(description, P.DESCRIPTION_OVER), over(title, P.TITLE_OVER), over(heading, P.HEADING_OVER))
    return F.replace(chosen, F.lit("\n"), F.lit(" "))


def lang_probe_text(view: Column) -> Column:
    return lang_probe(meta_description(view), meta_title(view), meta_heading(view))


# names looked up for the descriptive output columns
AUTHOR_NAMES = ("author", "article:author", "dc.creator")
DATE_NAMES = ("article:published_time", "date", "dc.date", "dcterms.created")
IMAGE_NAMES = ("og:image", "twitter:image")
PAGETYPE_NAMES = ("og:type",)
SITE_NAMES = ("og:site_name", "application-name")
SECTION_NAMES = ("article:section",)
TAG_NAMES = ("keywords", "news_keywords", "article:tag")
LICENSE_NAMES = ("dc.rights", "dcterms.license")


def meta_value(view: Column, names) -> Column:
    """Longest content of the named meta tags; NULL if absent or empty."""
    value = longest(all_groups(view, P.meta_tag(names), 2))
    return F.nullif(_text(value), F.lit(""))


def meta_joined(view: Column, names) -> Column:
    """All contents of the named meta tags, joined by commas; ``''`` if none."""
    return _text(F.array_join(all_groups(view, P.meta_tag(names), 2), ","))
