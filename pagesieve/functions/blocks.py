"""Page text as an ordered array of blocks, without leaving the row.

A page is cut at its block-level tags by a chain of regular expressions over
the whole string; one array of small structs per page comes out. Nothing here
shuffles: the neighbour-aware content rule reads the previous and the next
element of the same array.

Control characters serve as marks while the text is cut: U+0001 starts a
block, U+0002 ends the tag name after it, U+0003 / U+0004 surround link text.
Such characters in the page itself become blanks first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let

# elements that never hold content of the page itself
RAW_ELEMENTS = ("script", "style", "noscript", "template")
SIDE_ELEMENTS = ("head", "nav", "footer", "aside", "form")

BLOCK_TAGS = (
    "h[1-6]|p|li|tr|div|ul|ol|dl|dt|dd|table|thead|tbody|tfoot|caption|article|section|main|"
    "header|blockquote|pre|figure|figcaption|address|details|summary|fieldset|hr|br|body|html|center"
)

# named characters decoded besides the numeric forms; the ampersand comes last
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "),
    ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"), ("&middot;", "·"), ("&bull;", "•"),
    ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"),
    ("&ldquo;", "“"), ("&rdquo;", "”"), ("&laquo;", "«"), ("&raquo;", "»"), ("&euro;", "€"),
    ("&yen;", "¥"), ("&pound;", "£"), ("&deg;", "°"), ("&times;", "×"),
    ("&amp;", "&"),
)

_WIDE = r"\x{3040}-\x{30ff}\x{3400}-\x{9fff}"
WORD = rf"[^\s{_WIDE}]+"
WIDE_CHAR = rf"[{_WIDE}]"

# content rule (Kohlschütter et al. 2010, word count and link density tree)
MAX_LINK_DENSITY = 0.333333
MAX_PREV_LINK_DENSITY = 0.555556


def _gone(text: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(text, pattern, by)


def _numeric_entities(text: Column) -> Column:
    """Decode ``&#39;`` and ``&#x27;`` forms, by cutting at them and joining again."""
    pattern = "&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"

    def character(ref):
        body = F.regexp_replace(ref, "[&#;]", "")
        point = F.when(
            F.lower(body).startswith("x"), F.conv(F.substr(body, F.lit(2)), 16, 10)
        ).otherwise(body).cast("bigint")
        shown = point.between(32, 0xD7FF) | point.between(0xE000, 0x10FFFF)
        return F.when(
            shown, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        ).otherwise(F.lit(" "))

    def joined(t):
        refs = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), character)
        return F.array_join(
            F.zip_with(F.split(t, pattern), refs, lambda x, c: F.concat(x, F.coalesce(c, F.lit("")))),
            "",
        )

    return let(text, lambda t: F.when(F.contains(t, F.lit("&#")), joined(t)).otherwise(t))


def decode_entities(text: Column) -> Column:
    def decoded(t):
        out = _numeric_entities(t)
        for name, char in ENTITIES:
            out = F.replace(out, F.lit(name), F.lit(char))
        return out

    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), decoded(t)).otherwise(t))


def word_count(text: Column) -> Column:
    """Words of a text with single blanks; two characters of a script without
    blanks count as one word."""

    def count(t):
        wide = F.regexp_count(t, F.lit(WIDE_CHAR))
        mixed = F.regexp_count(t, F.lit(WORD)) + F.floor((wide + 1) / 2)
        blanks = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
        return F.when(t == "", 0).when(t.rlike(WIDE_CHAR), mixed).otherwise(blanks + 1).cast("int")

    return let(text, count)


def _one_blank(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\x00-\x20]+", " "))


def marked_text(html: Column, formatting: bool = False, tables: bool = True) -> Column:
    """HTML -> text with block and link marks, all other tags removed."""
    raw = "|".join(rf"<{tag}(?:[\s/][^>]*)?>.*?(?:</{tag}\s*>|\z)" for tag in RAW_ELEMENTS)
    side = "|".join(
        rf"<{tag}(?:[\s/][^>]*)?>.*?</{tag}\s*>" for tag in SIDE_ELEMENTS + (() if tables else ("table",)))
    s = let(html, lambda h: F.when(h.rlike(r"[\x01-\x04]"), _gone(h, r"[\x01-\x04]", " ")).otherwise(h))
    s = _gone(s, rf"(?is)<!--.*?(?:-->|\z)|{raw}")
    s = _gone(s, rf"(?is){side}", "\x01")
    if formatting:
        s = _gone(s, r"(?i)<(?:b|strong)(?:\s[^>]*)?>\s?([^<\s][^<]*)</(?:b|strong)\s*>", "**$1**")
    s = _gone(s, r"(?i)<a(?:\s[^>]*)?>", "\x03")
    s = _gone(s, r"(?i)</a\s*>", "\x04")
    s = _gone(s, r"(?i)<t[dh](?:[\s/][^>]*)?>", " | ")
    s = _gone(s, rf"(?i)<(?:/(?:{BLOCK_TAGS})\s*|({BLOCK_TAGS})(?:[\s/][^>]*)?)>", "\x01$1\x02")
    return _gone(s, r"<[a-zA-Z/!?][^>]*(?:>|\z)")


def html_blocks(html: Column, formatting: bool = False, tables: bool = True) -> Column:
    """HTML -> ARRAY<STRUCT<tag, text, words, link_words>>, empty blocks left out."""

    def opened(piece):
        body = F.substring_index(piece, "\x02", -1)
        return F.struct(
            F.when(F.contains(piece, F.lit("\x02")), F.lower(F.substring_index(piece, "\x02", 1)))
            .otherwise(F.lit("")).alias("tag"),
            body.alias("body"),
            _one_blank(decode_entities(F.translate(body, "\x03\x04", ""))).alias("text"),
        )

    def finished(b):
        linked = F.array_join(
            F.regexp_extract_all(b["body"], F.lit(r"\x03([^\x03\x04]*)"), F.lit(1)), " ")
        return F.struct(
            b["tag"].alias("tag"),
            b["text"].alias("text"),
            word_count(b["text"]).alias("words"),
            F.when(F.contains(b["body"], F.lit("\x03")), word_count(_one_blank(linked)))
            .otherwise(F.lit(0)).alias("link_words"),
        )

    pieces = F.filter(F.split(marked_text(html, formatting, tables), "\x01"),
                      lambda p: ~F.endswith(p, F.lit("\x02")) & (p != ""))
    full = F.filter(F.transform(pieces, opened), lambda b: b["text"] != "")
    return F.transform(full, finished)


def content_blocks(blocks: Column) -> Column:
    """Keep the blocks the word-count / link-density rule takes as content.

    Table rows are short by nature; they are judged by link density alone.
    """

    def density(b):
        return F.coalesce(b["link_words"] / F.greatest(b["words"], F.lit(1)), F.lit(0.0))

    def words(b):
        return F.coalesce(b["words"], F.lit(0))

    def judge(b, i):
        prev, after = F.get(blocks, i - 1), F.get(blocks, i + 1)
        long_or_near_long = (words(b) > 16) | (words(after) > 15) | (words(prev) > 4)
        after_links = (words(b) > 40) | (words(after) > 17)
        ruled = F.when(density(prev) <= MAX_PREV_LINK_DENSITY, long_or_near_long).otherwise(after_links)
        keep = (density(b) <= MAX_LINK_DENSITY) & ((b["tag"] == "tr") | ruled)
        return F.struct(b["tag"].alias("tag"), b["text"].alias("text"), keep.alias("keep"))

    return F.filter(F.transform(blocks, judge), lambda b: b["keep"])


def join_blocks(kept: Column, formatting: bool = False) -> Column:
    """Kept blocks -> text, one per line; NULL when there is none."""

    def line(b):
        row = F.when(b["tag"] == "tr", F.concat(b["text"], F.lit(" |")))
        if formatting:
            row = row.when(
                b["tag"].rlike("^h[1-6]$"),
                F.concat(F.repeat(F.lit("#"), F.substr(b["tag"], F.lit(2)).try_cast("int")),
                         F.lit(" "), b["text"]),
            ).when(b["tag"] == "li", F.concat(F.lit("- "), b["text"]))
        return row.otherwise(b["text"])

    return F.nullif(F.array_join(F.transform(kept, line), "\n"), F.lit(""))
