"""Inputs the tables do not hold, derived from ``pages`` by Spark.

The same derivations, written in SQL, are the ``WITH`` parts of ``checks.sql``.
Everything follows from a page's own id, address and text, and grows with the
table: 25 consecutive pages share one archive, as in a crawl.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesieve.functions.annotation import raw_fields
from pagesieve.session import spread

PAGES_PER_ARCHIVE = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with language, host and the page's bytes."""
    return table(spark, sf_dir, "pages").withColumns({
        "lang": F.regexp_extract("html", '<html lang="(..)"', 1),
        "host": F.regexp_extract("url", "^https?://([^/?#]+)", 1),
        "payload": F.col("html").cast("binary"),
    })


def meta_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with meta tags spliced in behind ``<head>``, by the shape of the address.

    ``#top``: a short description. ``.html``: a long one. ``/``: two of them.
    ``utm_source``: content before name, which is no match. ``ref=``: a title
    tag with empty content, which shuts out the title element.
    """
    host, url = F.col("host"), F.col("url")
    spliced = (
        F.when(F.endswith(url, F.lit("#top")), F.lit('<meta name="description" content="Ten chars.">'))
        .when(F.endswith(url, F.lit(".html")),
              F.concat(F.lit('<meta name="description" content="A page kept at '), host, F.lit('">')))
        .when(F.endswith(url, F.lit("/")),
              F.concat(F.lit('<meta name="description" content="'), host,
                       F.lit('"><meta property="twitter:description" content="It\'s the page of '),
                       host, F.lit(' again">')))
        .when(F.contains(url, F.lit("utm_source")),
              F.lit('<meta content="content first, name behind" name="description">'))
        .when(F.contains(url, F.lit("ref=")), F.lit('<meta name="title" content="">'))
        .otherwise(F.lit(""))
    )
    extra = F.concat(
        F.lit('<meta name="author" content="Desk '), host,
        F.lit('"><meta property="og:type" content="article"><meta name="keywords" content="'),
        F.col("lang"), F.lit(","), host,
        F.lit('"><meta property="og:site_name" content="Site '), host, F.lit('">'),
    )
    html = F.replace("html", F.lit("<head>"), F.concat(F.lit("<head>"), spliced, extra))
    return pages(spark, sf_dir).withColumn("html", html).withColumn("payload", F.col("html").cast("binary"))


def table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a two by two table at the end of the article."""
    cells = F.concat(
        F.lit("<table><tr><th>Host</th><th>Lang</th></tr><tr><td>"), F.col("host"),
        F.lit("</td><td>"), F.col("lang"), F.lit("</td></tr></table></article>"),
    )
    return pages(spark, sf_dir).withColumn("html", F.replace("html", F.lit("</article>"), cells))


def archive_of(page_id: Column) -> Column:
    number = F.floor(page_id / PAGES_PER_ARCHIVE).cast("string")
    return F.concat(F.lit("seg-"), F.lpad(number, 9, "0"), F.lit(".warc.gz"))


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their annotation text in ``note``.

    Addresses with ``ref=`` are annotated without languages; those ending in
    ``/`` with a tie in which the page's language comes second.
    """
    src = pages(spark, sf_dir)

    def entry(code, covered):
        return F.concat(F.lit('{"code":"'), code, F.lit('","text-covered":'), F.lit(covered),
                        F.lit(',"score":'), F.length("html").cast("string"), F.lit(".0}"))

    english = F.lit("en")
    listed = (
        F.when(F.endswith("url", F.lit("/")),
               F.concat(entry(english, "0.5"), F.lit(","), entry(F.col("lang"), "0.5")))
        .otherwise(F.concat(entry(F.col("lang"), "0.8"), F.lit(","), entry(english, "0.12")))
    )
    languages = F.concat(
        F.lit('languages-cld2: {"reliable":true,"text-bytes":'), F.length("html").cast("string"),
        F.lit(',"languages":['), listed, F.lit("]}\r\n"),
    )
    note = F.concat(
        F.lit("fetchTimeMs: "), F.length("url").cast("string"),
        F.lit("\r\ncharset-detected: UTF-8\r\nno colon here\r\nsource: "), F.col("url"), F.lit("\r\n"),
        F.when(F.contains("url", F.lit("ref=")), F.lit("")).otherwise(languages),
    )
    return src.withColumn("note", note)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response and an annotation record per page, in page order.

    Addresses with ``#top`` are served with a charset parameter, those with
    ``ref=`` as PDF, so neither is taken as an HTML page.
    """
    base = annotated(spark, sf_dir).withColumns({
        "warc_path": archive_of(F.col("page_id")),
        "page_record": F.concat(F.lit("<urn:md5:"), F.md5("url"), F.lit(">")),
        "note_record": F.concat(F.lit("<urn:md5:"), F.md5(F.concat("url", F.lit("!"))), F.lit(">")),
        "content_type": F.when(F.endswith("url", F.lit("#top")), "text/html; charset=utf-8")
        .when(F.contains("url", F.lit("ref=")), "application/pdf").otherwise(F.lit("text/html")),
    })
    none = F.lit(None).cast("string")
    two = F.explode(F.array(
        F.struct((F.col("page_id") * 2).alias("rec_seq"), F.lit("response").alias("rec_type"),
                 F.col("page_record").alias("record_id"), none.alias("concurrent_to"),
                 F.col("content_type").alias("content_type"), F.col("payload").alias("payload")),
        F.struct((F.col("page_id") * 2 + 1).alias("rec_seq"), F.lit("metadata").alias("rec_type"),
                 F.col("note_record").alias("record_id"), F.col("page_record").alias("concurrent_to"),
                 none.alias("content_type"), F.col("note").cast("binary").alias("payload")),
    ))
    rows = base.select("warc_path", F.lit(0).cast("bigint").alias("block_start"),
                       F.col("url").alias("target_uri"), two.alias("r")).select(
        "warc_path", "block_start", "target_uri", "r.*")
    return rows.withColumns({
        "rec_headers": F.create_map(
            F.lit("WARC-Type"), F.col("rec_type"), F.lit("WARC-Record-ID"), F.col("record_id"),
            F.lit("WARC-Target-URI"), F.col("target_uri")),
        "http_headers": F.when(F.col("content_type").isNotNull(),
                               F.create_map(F.lit("content-type"), F.col("content_type"))),
        "content_length": F.octet_length("payload").cast("bigint"),
        "fields": F.when(F.col("rec_type") == "metadata", raw_fields(F.col("payload"))),
        "torn": F.lit(False),
        "coded": F.lit(False),
    })


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id`` and the raw fields of its annotation."""
    return annotated(spark, sf_dir).select(
        "page_id", raw_fields(F.col("note").cast("binary")).alias("fields"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive paths, once for every language in them, so most are listed repeatedly."""
    return pages(spark, sf_dir).select(
        archive_of(F.col("page_id")).alias("warc_path"), "lang").distinct().select("warc_path")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some archives done, some failed, by the digest of their path; the rest not listed."""
    digit = F.substr(F.md5("warc_path"), F.lit(1), F.lit(1))
    return manifest(spark, sf_dir).distinct().select(
        "warc_path",
        F.when(digit < "6", "ok").when(digit < "a", "failed").alias("status"),
        F.lit(0).cast("bigint").alias("batch_id"),
    ).where(F.col("status").isNotNull())
