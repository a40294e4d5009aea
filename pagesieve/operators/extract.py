"""Main text of pages, blocks repeated over the corpus, descriptive columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import htmlmeta as H
from ..functions.bind import compute, let
from ..functions.blocks import content_blocks, html_blocks, join_blocks
from .skew import drop_frequent


def explode_blocks(df: DataFrame, html: str, id_cols, formatting: bool = False,
                   tables: bool = True) -> DataFrame:
    """One row per block: ``id_cols, pos, tag, text, words, link_words``."""
    return df.select(
        *id_cols, F.posexplode(html_blocks(F.col(html), formatting, tables)).alias("pos", "b")
    ).select(*id_cols, "pos", "b.*")


def main_text(df: DataFrame, html: str, out: str = "text", formatting: bool = False,
              tables: bool = True) -> DataFrame:
    """Add ``out``: content blocks of the page, one per line; NULL if none."""
    blocks = compute(df, {"_blocks": html_blocks(F.col(html), formatting, tables)})
    text = join_blocks(content_blocks(F.col("_blocks")), formatting)
    return compute(blocks, {out: text}).drop("_blocks")


def raw_and_formatted_text(df: DataFrame, html: str) -> DataFrame:
    """Add ``raw_text`` (plain) and ``text`` (Markdown)."""
    return main_text(main_text(df, html, "raw_text"), html, "text", formatting=True)


def drop_repeated_blocks(blocks: DataFrame, max_repeats: int = 2, min_chars: int = 20) -> DataFrame:
    """Drop blocks whose text occurs more than ``max_repeats`` times in the corpus.

    Blocks under ``min_chars`` are not judged.
    """
    key = F.when(F.length("text") >= min_chars, F.unhex(F.md5(F.col("text").cast("binary"))))
    return drop_frequent(blocks, key, max_repeats)


def text_of_blocks(blocks: DataFrame, id_cols) -> DataFrame:
    """Blocks back to one text per page, in block order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "text")))
    return blocks.groupBy(*id_cols).agg(
        F.array_join(F.transform(ordered, lambda b: b["text"]), "\n").alias("text")
    )


def page_metadata(df: DataFrame, view: str, url: str) -> DataFrame:
    """Add the descriptive columns of a page from its byte view and its URL."""
    v = F.col(view)
    host = F.try_parse_url(F.col(url), F.lit("HOST"))
    return compute(df, {
        "title": H.meta_title(v),
        "author": H.meta_value(v, H.AUTHOR_NAMES),
        "hostname": host,
        "date": F.regexp_substr(H.meta_value(v, H.DATE_NAMES), F.lit(r"\d{4}-\d{2}-\d{2}")),
        "image": H.meta_value(v, H.IMAGE_NAMES),
        "pagetype": H.meta_value(v, H.PAGETYPE_NAMES),
        "source": F.col(url),
        "source-hostname": F.coalesce(H.meta_value(v, H.SITE_NAMES), host),
        "excerpt": H.meta_description(v),
        "categories": H.meta_joined(v, H.SECTION_NAMES),
        "tags": H.meta_joined(v, H.TAG_NAMES),
        "license": H.meta_value(v, H.LICENSE_NAMES),
    })


def _half(digest: Column, start: int) -> Column:
    """32 bits of a token's hex digest as a number."""
    return F.conv(F.substr(digest, F.lit(start), F.lit(8)), 16, 10).cast("bigint")


def fingerprint_of(text: Column) -> Column:
    """64-bit simhash of the words of ``text``, 16 hex digits; null without words.

    Charikar (2002): each word votes on every bit by its own hash; a bit is set
    when more than half of the words have it. Two votes share one 64-bit
    counter, 32 bits each, so a text may have up to 2^31 words. The counters are
    folded over the text's words inside the row: nothing is exploded, shuffled or
    joined back.
    """
    digests = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"[^\s]+"), F.lit(0)),
                          lambda w: F.md5(w.cast("binary")))
    halves = F.transform(digests, lambda d: F.struct(_half(d, 1).alias("hi"), _half(d, 9).alias("lo")))

    def bit(half, i):
        return F.shiftright(half, i).bitwiseAND(F.lit(1))

    zero = F.struct(F.lit(0).cast("bigint").alias("n"), *[F.lit(0).cast("bigint").alias(f"v{i}") for i in range(32)])
    votes = F.aggregate(halves, zero, lambda acc, x: F.struct(
        (acc["n"] + 1).alias("n"),
        *[(acc[f"v{i}"] + bit(x["hi"], i) + F.shiftleft(bit(x["lo"], i), 32)).alias(f"v{i}") for i in range(32)]))

    def decided(v, low_half):
        value = F.lit(0).cast("bigint")
        for i in range(32):
            count = F.shiftright(v[f"v{i}"], 32) if low_half else v[f"v{i}"].bitwiseAND(F.lit(0xFFFFFFFF))
            value = value + F.when(count * 2 > v["n"], F.lit(1 << i)).otherwise(F.lit(0))
        return F.lpad(F.lower(F.hex(value)), 8, "0")

    return let(votes, lambda v: F.when(v["n"] > 0, F.concat(decided(v, False), decided(v, True))))


def fingerprint(df: DataFrame, id_cols, text: str) -> DataFrame:
    """``id_cols`` + ``fingerprint``: 64-bit simhash of the words, 16 hex digits.

    Charikar (2002): each word votes on every bit by its own hash; a bit is set
    when more than half of the words have it. Two votes share one 64-bit
    counter, 32 bits each, so a text may have up to 2^31 words. Votes are
    added up before the shuffle; texts are not shuffled. The same hash as
    :func:`fingerprint_of`; this way costs a shuffle of counters by key but runs
    as generated code: at sf0.1 the registered query takes 4.5 s this way and
    80 s with the in-row fold, whose higher-order functions are interpreted.
    """
    words = df.select(
        *id_cols,
        F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[^\s]+"), F.lit(0))).alias("w"),
    ).select(*id_cols, F.md5(F.col("w").cast("binary")).alias("d")).select(
        *id_cols, _half(F.col("d"), 1).alias("hi"), _half(F.col("d"), 9).alias("lo"))

    def bit(half, i):
        return F.shiftright(F.col(half), i).bitwiseAND(F.lit(1))

    votes = words.groupBy(*id_cols).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(bit("hi", i) + F.shiftleft(bit("lo", i), 32)).alias(f"v{i}") for i in range(32)],
    )

    def decided(low_half):
        value = F.lit(0).cast("bigint")
        for i in range(32):
            count = F.shiftright(F.col(f"v{i}"), 32) if low_half else F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF))
            value = value + F.when(count * 2 > F.col("n"), F.lit(1 << i)).otherwise(F.lit(0))
        return F.lpad(F.lower(F.hex(value)), 8, "0")

    return votes.select(*id_cols, F.concat(decided(False), decided(True)).alias("fingerprint"))
