"""The whole job: archive records in, documents out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import htmlmeta as H
from ..functions.annotation import (
    annotated_languages, dominant_language, malformed_fields, parsed_value,
)
from ..functions.bind import compute, let
from ..functions.bytesview import byte_view
from ..functions.charset import decode_text
from ..operators.documents import final_document
from ..operators.extract import (
    drop_repeated_blocks, fingerprint_of, main_text, page_metadata, text_of_blocks,
)
from ..operators.filters import (
    drop_failed_archives, filter_extracted, flag_too_short,
    is_html_response, is_metadata,
)
from ..operators.langid import filter_predicted_language, predict_language
from ..operators.pairing import carry_pair, keyed_pair
from ..operators.positions import attach, keep_positions, position_bitmaps
from ..session import spread

ORDER = ("block_start", "rec_seq")
KEY = ("warc_path", "held")


@dataclass(frozen=True)
class Settings:
    """Parameters of a run."""

    target: str = "ja"
    classify: bool = True              # second opinion of the language model
    mode: str = "raw"                  # 'raw' or 'text'
    pairing: str = "positional"        # or 'keyed', or 'content_first'
    content_match: str = "exact"       # or 'prefix'
    json: str = "braces"               # or 'any'
    fail_mode: str = "record"          # bad annotation: drop it, or its 'archive'
    max_repeats: int | None = None     # drop text lines seen more often than this
    body_gate: bool = False            # language model on the extracted text too
    min_chars: int = 400
    run_date: str | None = None


def slim_records(records: DataFrame, settings: Settings) -> DataFrame:
    """What pairing needs of every record; page contents are not read for it.

    Damaged records (``torn``, or ``coded`` bodies that could not be undone) take
    their place in the order like any other: a damaged page is held, so the
    annotation behind it pairs with it and not with an earlier page; its
    document is then dropped, as :func:`html_pages` has whole pages only, and
    :func:`quarantined` lists it.

    ``note`` judges an annotation, once: its ``fields``, and whether it is
    ``wanted`` (dominant language is the target), ``unnamed`` (no language
    list) or ``broken`` (bad JSON, or a language list without a winner).
    """

    def judged(fields):
        def by_languages(languages):
            top = dominant_language(languages)
            bad = malformed_fields(fields) | (languages.isNotNull() & top.isNull())
            return F.struct(
                fields.alias("fields"),
                F.coalesce(~bad & (top == settings.target), F.lit(False)).alias("wanted"),
                languages.isNull().alias("unnamed"),
                bad.alias("broken"),
            )
        return let(annotated_languages(fields), by_languages)

    return records.select(
        "warc_path", *ORDER, "record_id", "concurrent_to", "rec_headers",
        F.coalesce(is_html_response(settings.content_match), F.lit(False)).alias("is_page"),
        F.coalesce(is_metadata(), F.lit(False)).alias("is_note"),
        F.when(is_metadata(), judged(F.col("fields"))).alias("note"),
    ).where("is_page OR is_note")


def failed_archives(records: DataFrame, settings: Settings) -> DataFrame:
    """Archives where an unreadable annotation meets a held page.

    An annotation without a held page before it is never read, so it fails
    nothing. Whether a page is still held is judged by annotations alone.
    """
    broken = F.col("note.broken")
    return carry_pair(
        slim_records(records, settings), "warc_path", ORDER, opens=F.col("is_page"),
        closes=F.col("is_note"), accepts=broken, consumes=broken | F.col("note.wanted"),
    ).select("warc_path").distinct()


def quarantined(records: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Records the job leaves out, with the reason, for inspection."""
    broken = slim_records(records, settings).where("note.broken").select(
        "warc_path", *ORDER, "record_id", F.lit("annotation").alias("reason"))
    return records.where("torn OR coded").select(
        "warc_path", *ORDER, "record_id",
        F.when(F.col("torn"), "torn").otherwise(F.lit("coded body")).alias("reason"),
    ).unionByName(broken)


def usable_records(records: DataFrame, settings: Settings, stage: str | None = None) -> DataFrame:
    """Records of archives without a failure, if failures count per archive."""
    if settings.fail_mode == "record":
        return records
    if settings.fail_mode != "archive":
        raise ValueError("fail_mode must be 'record' or 'archive'")
    failed = _staged(failed_archives(records, settings), stage, "failed")
    return drop_failed_archives(records, failed, [*ORDER])


def html_pages(records: DataFrame, settings: Settings) -> DataFrame:
    """Whole HTML responses: ``warc_path, held`` and what later steps need."""
    whole = ~F.col("torn") & ~F.col("coded")
    return records.where(is_html_response(settings.content_match) & whole).select(
        "warc_path", F.struct(*ORDER).alias("held"), "record_id", "payload", "rec_headers",
        F.col("target_uri").alias("url"),
    )


def candidates(records: DataFrame, settings: Settings, stage: str | None = None) -> DataFrame:
    """Pages whose annotation names the target language as dominant.

    ``warc_path, held, rec_headers, fields, payload, url``: pairs are found on
    slim rows; their page positions become bitmaps that filter the page scan
    (:func:`at_positions`), so pages are not shuffled to meet their pairs.
    """
    slim = slim_records(records, settings)
    pages = html_pages(records, settings).drop("rec_headers")
    if settings.pairing == "keyed":
        notes = slim.where("is_note AND note.wanted").select(
            "concurrent_to", "rec_headers", "note.fields")
        return keyed_pair(_staged(notes, stage, "pairs"), pages).drop("concurrent_to")
    pairs = carry_pair(
        slim.withColumn("fields", F.col("note.fields")), "warc_path", ORDER,
        opens=F.col("is_page"), closes=F.col("is_note"),
        accepts=F.col("note.wanted"), keep=("rec_headers", "fields"),
    ).drop("pos")
    return at_positions(pages.drop("record_id"), _staged(pairs, stage, "pairs"), stage, "pairs-bitmaps")


def at_positions(pages: DataFrame, chosen: DataFrame, stage: str | None, name: str) -> DataFrame:
    """``pages`` at the positions of ``chosen`` (keyed by ``KEY``, one row each), with its columns.

    The positions filter the page scan as bitmaps; ``chosen`` is then broadcast to the
    kept pages when its rows and bytes are within bounds. Pages move through no shuffle
    unless ``chosen`` is beyond those bounds; then only the kept pages do.
    """
    bitmaps = _staged(position_bitmaps(chosen.select("warc_path", F.col("held.rec_seq").alias("rec_seq"))),
                      stage, name)
    kept = keep_positions(pages, bitmaps, seq=F.col("held.rec_seq"))
    return attach(kept, chosen, list(KEY))


def pair_content_first(documents: DataFrame, records: DataFrame, settings: Settings) -> DataFrame:
    """The older order of work: pages are judged before any annotation is read.

    Only pages that passed open; the first annotation behind one that is in the
    target language or names no languages closes it, and only the former yields
    a document. ``documents`` hold ``warc_path, held``; ``fields`` is added.
    """
    notes = slim_records(records, settings).where("is_note").withColumn("fields", F.col("note.fields"))
    opened = documents.select("warc_path", "held.*", F.lit(True).alias("is_page"))
    pairs = carry_pair(
        notes.where(~F.col("is_page")).unionByName(opened, allowMissingColumns=True),
        "warc_path", ORDER, opens=F.col("is_page"), closes=F.col("is_note"),
        accepts=F.col("note.wanted"), consumes=F.col("note.wanted") | F.col("note.unnamed"),
        keep=("fields",),
    )
    return documents.join(pairs.drop("pos"), list(KEY))


def classified(pages: DataFrame, profile: DataFrame, target: str, stage: str | None = None) -> DataFrame:
    """Pages whose description, title or heading is in ``target``, with ``prediction``.

    Only keys and the short probe text go through the model; the accepted
    positions then filter the pages as bitmaps (:func:`at_positions`).
    """
    probes = compute(pages.select(*KEY, "payload"), {
        "probe": H.lang_probe_text(byte_view(F.col("payload")))}).drop("payload")
    found = _staged(filter_predicted_language(predict_language(probes, KEY, "probe", profile), target),
                    stage, "accepted")
    return at_positions(pages, found, stage, "accepted-bitmaps")


def with_text(pages: DataFrame, settings: Settings, profile: DataFrame | None = None,
              stage: str | None = None) -> DataFrame:
    """Add the text-mode columns; pages without text are dropped."""
    parsed = page_metadata(
        pages.withColumn("view", byte_view(F.col("payload"))), "view", "url"
    ).drop("view").withColumn("html", decode_text(F.col("payload"))).drop("payload")
    texts = filter_extracted(main_text(main_text(parsed, "html", "raw_text"), "html", "text",
                                       formatting=True)).drop("html")
    texts = _staged(texts, stage, "texts")
    if settings.max_repeats is not None:
        lines = texts.select(*KEY, F.posexplode(F.split("text", "\n")).alias("pos", "text"))
        kept = text_of_blocks(drop_repeated_blocks(lines, settings.max_repeats), KEY)
        texts = texts.drop("text").join(kept, list(KEY))
    if settings.body_gate:
        body = predict_language(texts, KEY, "raw_text", profile)
        texts = texts.join(filter_predicted_language(body, settings.target).select(*KEY), list(KEY))
    return flag_too_short(texts, "text", settings.min_chars).withColumn("fingerprint", fingerprint_of(F.col("raw_text")))


def _staged(pages: DataFrame, stage: str | None, name: str) -> DataFrame:
    if stage is None:
        return pages
    path = f"{stage}/{name}"
    pages.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spread(pages.sparkSession.read.parquet(path))


def refine(records: DataFrame, settings: Settings, profile: DataFrame | None = None,
           stage: str | None = None) -> DataFrame:
    """Records -> final documents.

    ``records`` should be a landed table (see ``land_records``). With ``stage``
    the selected pages, and in text mode their texts, are written there: the
    later steps then read the few pages in the target language, column by
    column, and a lost executor costs no second pass over the archives.
    """
    usable = usable_records(records, settings, stage)
    if settings.pairing == "content_first":
        pages = classified(html_pages(usable, settings).drop("record_id"), profile, settings.target, stage)
        pages = with_text(pages, settings, profile, stage)
        return _documents(pair_content_first(pages, usable, settings), settings)
    if settings.pairing not in ("positional", "keyed"):
        raise ValueError("pairing must be 'positional', 'keyed' or 'content_first'")
    pages = _staged(candidates(usable, settings, stage), stage, "pages")
    if settings.classify:
        pages = classified(pages, profile, settings.target, stage)
    else:
        pages = pages.withColumn(
            "prediction", F.lit(None).cast("struct<code: string, prob: double>"))
    if settings.mode == "text":
        pages = with_text(pages, settings, profile, stage)
    return _documents(pages, settings)


def _documents(pages: DataFrame, settings: Settings) -> DataFrame:
    full = pages.withColumn(
        "metadata", F.transform_values("fields", lambda _, v: parsed_value(v, settings.json)))
    mode = "text" if settings.pairing == "content_first" else settings.mode
    return final_document(full, mode, settings.run_date)
