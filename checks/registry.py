"""The registered queries: each runs an operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagesieve.functions import annotation as A
from pagesieve.functions import htmlmeta as H
from pagesieve.functions.bytesview import byte_view
from pagesieve.functions.charset import decode_text, guess_charset, is_utf8
from pagesieve.operators import extract, filters, langid, progress
from pagesieve.operators.documents import raw_projection
from pagesieve.operators.pairing import carry_pair, keyed_pair
from pagesieve.plans import manifest_job as J
from pagesieve.plans.refine import ORDER, Settings, refine
from pagesieve.session import configure, work_path
from pagesieve.sources import ledger as L
from pagesieve.sources import sinks
from pagesieve.sources.manifest import read_manifest, with_location
from pagesieve.sources.warc import read_warc, write_warc
from pagesieve.streaming.ingest import ingest

from . import views as V

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_PROFILES: dict[tuple[str, str], str] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name; a trailing underscore is left out."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _QUERIES[fn.__name__.rstrip("_")] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _view() -> Column:
    return byte_view(F.col("payload"))


def trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language model of a data folder; trained and stored once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PROFILES:
        path = work_path(spark, "profile")
        langid.store_profile(
            langid.train_profile(V.table(spark, sf_dir, "documents"), "text", "lang"), path)
        _PROFILES[key] = path
    return spark.read.parquet(_PROFILES[key])


# --- page metadata ------------------------------------------------------------
@query
def html_lang(spark, sf_dir):
    return V.pages(spark, sf_dir).select("page_id", H.html_lang(_view()).alias("html_lang"))


@query
def declared_charset(spark, sf_dir):
    return V.pages(spark, sf_dir).select("page_id", H.declared_charset(_view()).alias("charset"))


@query
def meta_description(spark, sf_dir):
    return V.meta_pages(spark, sf_dir).select("page_id", H.meta_description(_view()).alias("description"))


@query
def meta_title(spark, sf_dir):
    return V.meta_pages(spark, sf_dir).select("page_id", H.meta_title(_view()).alias("title"))


@query
def meta_heading(spark, sf_dir):
    return V.pages(spark, sf_dir).select("page_id", H.meta_heading(_view()).alias("heading"))


@query
def lang_probe_text(spark, sf_dir):
    return V.meta_pages(spark, sf_dir).select("page_id", H.lang_probe_text(_view()).alias("probe"))


@query
def page_metadata(spark, sf_dir):
    src = V.meta_pages(spark, sf_dir).withColumn("view", _view())
    return extract.page_metadata(src, "view", "url").select(
        "page_id", "title", "author", "hostname", "date", "image", "pagetype", "source",
        F.col("`source-hostname`").alias("source_hostname"), "excerpt", "categories", "tags", "license")


# --- charsets -------------------------------------------------------------------
def _two_encodings(spark, sf_dir) -> DataFrame:
    """Every page in UTF-8 and in ISO-8859-1 bytes."""
    forms = F.explode(F.array(
        F.struct(F.lit("utf8").alias("form"), F.col("payload").alias("bytes")),
        F.struct(F.lit("latin1").alias("form"), F.encode("html", "ISO-8859-1").alias("bytes")),
    ))
    return V.pages(spark, sf_dir).select("page_id", forms.alias("f")).select("page_id", "f.*")


@query
def is_utf8_(spark, sf_dir):
    return _two_encodings(spark, sf_dir).select("page_id", "form", is_utf8(F.col("bytes")).alias("is_utf8"))



@query
def guess_charset_(spark, sf_dir):
    return _two_encodings(spark, sf_dir).select(
        "page_id", "form", guess_charset(F.col("bytes")).alias("charset"))



@query
def decode_text_(spark, sf_dir):
    return _two_encodings(spark, sf_dir).select("page_id", "form", decode_text(F.col("bytes")).alias("text"))



# --- text ------------------------------------------------------------------------
@query
def html_blocks(spark, sf_dir):
    return extract.explode_blocks(V.pages(spark, sf_dir), "html", ["page_id"])


@query
def main_text(spark, sf_dir):
    return extract.main_text(V.pages(spark, sf_dir), "html").select("page_id", "text")


@query
def main_text_markdown(spark, sf_dir):
    return extract.main_text(V.pages(spark, sf_dir), "html", formatting=True).select("page_id", "text")


@query
def main_text_tables(spark, sf_dir):
    src = V.table_pages(spark, sf_dir)
    both = extract.main_text(extract.main_text(src, "html", "with_tables"), "html", "without_tables",
                             tables=False)
    return both.select("page_id", "with_tables", "without_tables")


@query
def raw_and_formatted_text(spark, sf_dir):
    return extract.raw_and_formatted_text(V.pages(spark, sf_dir), "html").select(
        "page_id", "raw_text", "text")


@query
def filter_extracted(spark, sf_dir):
    return filters.filter_extracted(extract.main_text(V.pages(spark, sf_dir), "html")).select(
        "page_id", F.length("text").cast("bigint").alias("n_chars"))


@query
def size_guard(spark, sf_dir):
    return filters.size_guard(V.pages(spark, sf_dir), 4000).select("page_id")


@query
def size_guard_report(spark, sf_dir):
    return filters.size_guard_report(V.pages(spark, sf_dir), 4000)


@query
def drop_repeated_blocks(spark, sf_dir):
    blocks = extract.explode_blocks(V.pages(spark, sf_dir), "html", ["page_id"])
    return extract.drop_repeated_blocks(blocks).select("page_id", "pos", "text")


@query
def flag_too_short(spark, sf_dir):
    return filters.flag_too_short(V.table(spark, sf_dir, "documents")).select(
        "doc_id", "rejected", "rejected_reason")


@query
def raw_projection_(spark, sf_dir):
    return V.pages(spark, sf_dir).select("page_id", *raw_projection(F.col("payload")))



@query
def content_fingerprint(spark, sf_dir):
    return extract.fingerprint(V.table(spark, sf_dir, "documents"), ["doc_id"], "text")


# --- language model ---------------------------------------------------------------
@query
def train_profile(spark, sf_dir):
    return langid.train_profile(V.table(spark, sf_dir, "documents"), "text", "lang")


@query
def predict_language(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    return langid.predict_language(docs, ["doc_id"], "text", trained(spark, sf_dir)).select(
        "doc_id", "prediction.code", F.round("prediction.prob", 6).alias("prob"))


@query
def top_k_languages(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    return langid.top_k_languages(docs, ["doc_id"], "text", trained(spark, sf_dir), 3).withColumn(
        "prob", F.round("prob", 6))


@query
def filter_predicted_language(spark, sf_dir):
    probes = V.meta_pages(spark, sf_dir).select("page_id", H.lang_probe_text(_view()).alias("probe"))
    found = langid.predict_language(probes, ["page_id"], "probe", trained(spark, sf_dir))
    return langid.filter_predicted_language(found, "en").select(
        "page_id", "prediction.code", F.round("prediction.prob", 6).alias("prob"))


@query
def body_language_gate(spark, sf_dir):
    texts = extract.main_text(V.pages(spark, sf_dir), "html").select("page_id", "text")
    found = langid.predict_language(texts, ["page_id"], "text", trained(spark, sf_dir))
    return langid.filter_predicted_language(found, "en").select("page_id")


@query
def label_cleanup(spark, sf_dir):
    label = F.concat(F.lit("__label__"), F.col("lang"))
    return V.table(spark, sf_dir, "documents").select("doc_id", langid.clean_label(label).alias("code"))


# --- annotations --------------------------------------------------------------------
def _fields(spark, sf_dir, json) -> DataFrame:
    rows = V.notes(spark, sf_dir).select("page_id", F.explode("fields").alias("key", "value"))
    shape = F.schema_of_variant(A.parsed_value(F.col("value"), json))
    kind = F.when(shape.startswith("OBJECT"), "object").when(shape == "BIGINT", "number").otherwise(
        F.lit("text"))
    return rows.withColumn("kind", kind)


@query
def parse_fields(spark, sf_dir):
    return _fields(spark, sf_dir, "braces")


@query
def parse_fields_any_json(spark, sf_dir):
    return _fields(spark, sf_dir, "any")


@query
def dominant_language(spark, sf_dir):
    return V.notes(spark, sf_dir).select(
        "page_id", A.dominant_language(A.annotated_languages(F.col("fields"))).alias("code"))


@query
def filter_annotated(spark, sf_dir):
    return V.notes(spark, sf_dir).where(filters.has_language_annotation(F.col("fields"))).select("page_id")


@query
def filter_dominant_language(spark, sf_dir):
    return V.notes(spark, sf_dir).where(filters.dominant_language_is(F.col("fields"), "fr")).select("page_id")


# --- records ---------------------------------------------------------------------------
@query
def filter_html_response(spark, sf_dir):
    rec = V.records(spark, sf_dir)
    return reduce(DataFrame.unionAll, [
        rec.where(filters.is_html_response(rule)).select("warc_path", "rec_seq", F.lit(rule).alias("rule"))
        for rule in ("exact", "prefix")
    ])


@query
def filter_metadata(spark, sf_dir):
    return V.records(spark, sf_dir).where(filters.is_metadata()).select("warc_path", "rec_seq")


def _archives(spark, sf_dir) -> str:
    """The derived records as gzip archives; the folder they are in."""
    path = work_path(spark, "archives")
    write_warc(V.records(spark, sf_dir), path)
    return path


def archive_name() -> Column:
    """The writer keeps one folder per archive."""
    return F.regexp_extract("warc_path", "archive=([^/]+)/", 1)


def _scanned(spark, sf_dir) -> DataFrame:
    path = _archives(spark, sf_dir)
    return read_warc(spark, path, base=path).withColumn("warc_path", archive_name())


@query
def warc_scan(spark, sf_dir):
    first = F.regexp_extract("warc_path", r"seg-(\d+)", 1).cast("bigint") * (2 * V.PAGES_PER_ARCHIVE)
    order = F.row_number().over(Window.partitionBy("warc_path").orderBy(*ORDER))
    rec = _scanned(spark, sf_dir).where(~F.col("torn"))
    return rec.select(
        "warc_path", (first + order - 1).alias("rec_seq"), "rec_type", "record_id", "target_uri",
        filters.http_header("Content-Type").alias("content_type"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.md5("payload").alias("payload_md5"))


@query
def http_header_lookup(spark, sf_dir):
    return V.records(spark, sf_dir).where("rec_type = 'response'").select(
        "warc_path", "rec_seq", filters.http_header("Content-TYPE").alias("content_type"))


@query
def rec_headers_map(spark, sf_dir):
    header = F.col("rec_headers")
    rec = V.records(spark, sf_dir)
    # rebuilt from header lines, where the first of two values must lose
    lines = F.concat(F.lit("WARC/1.0\r\nWARC-Type: overwritten\r\nWARC-Type: "), header["WARC-Type"],
                     F.lit("\r\nWARC-Record-ID: "), header["WARC-Record-ID"],
                     F.lit("\r\nWARC-Target-URI:  "), header["WARC-Target-URI"])
    parsed = rec.select("warc_path", "rec_seq", A.parse_header_lines(lines).alias("h"))
    return parsed.select(
        "warc_path", "rec_seq", F.col("h")["WARC-Type"].alias("warc_type"),
        F.col("h")["WARC-Record-ID"].alias("record_id"), F.col("h")["WARC-Target-URI"].alias("target_uri"))


@query
def lineage(spark, sf_dir):
    return _scanned(spark, sf_dir).groupBy("warc_path").agg(F.count(F.lit(1)).alias("records"))


# --- pairing ------------------------------------------------------------------------------
def _flagged(spark, sf_dir) -> DataFrame:
    rec = V.records(spark, sf_dir)
    fields = F.col("fields")
    return rec.select(
        "warc_path", "rec_seq", "record_id", "concurrent_to", "rec_type",
        F.coalesce(filters.is_html_response(), F.lit(False)).alias("is_page"),
        F.regexp_extract(F.col("payload").cast("string"), '<html lang="(..)"', 1).alias("lang"),
        A.dominant_language(A.annotated_languages(fields)).alias("dominant"))


@query
def carry_pair_(spark, sf_dir):
    return carry_pair(
        _flagged(spark, sf_dir), "warc_path", ["rec_seq"], opens=F.col("is_page"),
        closes=filters.is_metadata(), accepts=F.col("dominant") == "en",
    ).select("warc_path", "held", "pos")



@query
def carry_pair_content_first(spark, sf_dir):
    wanted = F.col("dominant") == "en"
    return carry_pair(
        _flagged(spark, sf_dir), "warc_path", ["rec_seq"],
        opens=F.col("is_page") & (F.col("lang") == "en"), closes=filters.is_metadata(),
        accepts=wanted, consumes=wanted | F.col("dominant").isNull(),
    ).select("warc_path", "held", "pos")


@query
def carry_pair_events(spark, sf_dir):
    pairs = carry_pair(
        V.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"),
        "user_id", ["ts", "event_id"], opens=F.col("event_type") == "view",
        closes=F.col("event_type") == "purchase", accepts=F.col("event_type") == "purchase",
        stretch=F.date_trunc("hour", "ts"),
    )
    return pairs.select("user_id", F.col("held.event_id").alias("view_id"),
                        F.col("pos.event_id").alias("purchase_id"))


@query
def keyed_pair_(spark, sf_dir):
    rec = _flagged(spark, sf_dir)
    notes = rec.where(filters.is_metadata() & (F.col("dominant") == "en")).select(
        "concurrent_to", F.col("record_id").alias("note_record"))
    pages = rec.where("is_page").select("warc_path", F.col("rec_seq").alias("held"), "record_id")
    return keyed_pair(notes, pages).select("warc_path", "held", "note_record")



# --- manifest and ledger ---------------------------------------------------------------------
@query
def manifest_scan(spark, sf_dir):
    path = work_path(spark, "manifest")
    V.manifest(spark, sf_dir).write.option("compression", "gzip").text(path)
    return read_manifest(spark, path).select("warc_path")


@query
def archive_location(spark, sf_dir):
    return with_location(V.manifest(spark, sf_dir), "s3a://archive/").select("warc_path", "location")


@query
def ledger_scan(spark, sf_dir):
    path = work_path(spark, "snapshot")
    listed = V.ledger(spark, sf_dir).groupBy(F.substr(F.md5("warc_path"), F.lit(1), F.lit(4))).agg(
        F.collect_list("warc_path").alias("processed_file_names"))
    listed.select("processed_file_names").write.json(path)
    return L.read_ledger_snapshot(spark, path)


@query
def ledger_distinct(spark, sf_dir):
    return progress.distinct_archives(V.manifest(spark, sf_dir))


@query
def pending_archives(spark, sf_dir):
    return progress.pending(V.manifest(spark, sf_dir), V.ledger(spark, sf_dir)).select("warc_path")


@query
def ledger_after_run(spark, sf_dir):
    path = work_path(spark, "ledger")
    L.append_ledger(V.ledger(spark, sf_dir), path, batch_id=0)
    todo = progress.distinct_archives(progress.pending(V.manifest(spark, sf_dir), L.read_ledger(spark, path)))
    done = todo.withColumn("status", F.lit("ok"))
    L.append_ledger(done, path, batch_id=1)
    return L.read_ledger(spark, path)


@query
def run_summary(spark, sf_dir):
    return progress.run_summary(V.ledger(spark, sf_dir))


@query
def drop_failed_archives(spark, sf_dir):
    failed = V.ledger(spark, sf_dir).where("status = 'failed'")
    return filters.drop_failed_archives(
        V.records(spark, sf_dir).select("warc_path", "rec_seq"), failed, ["rec_seq"])


# --- whole jobs ------------------------------------------------------------------------------
def _raw_columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        "raw_data", "encoding", F.col("rec_headers")["WARC-Record-ID"].alias("note_record"),
        F.try_variant_get(F.element_at("metadata", "fetchTimeMs"), "$", "string").alias("fetch_time"),
        "warc_path")


@query
def final_document(spark, sf_dir):
    docs = refine(V.records(spark, sf_dir), Settings(target="en", mode="text", run_date="2024-07-08"),
                  trained(spark, sf_dir), stage=work_path(spark, "stage"))
    return docs.select(
        "title", "hostname", "source", "raw_text", "text", "rejected", "rejected_reason",
        F.col("`languages-fasttext`.code").alias("language_code"),
        F.round(F.col("`languages-fasttext`.prob"), 6).alias("language_prob"),
        F.col("rec_headers")["WARC-Record-ID"].alias("note_record"),
        F.try_variant_get(F.element_at("metadata", "fetchTimeMs"), "$", "string").alias("fetch_time"),
        "warc_path", "filedate", "comments")


@query
def final_document_raw(spark, sf_dir):
    docs = refine(V.records(spark, sf_dir), Settings(target="en", mode="raw"), trained(spark, sf_dir),
                  stage=work_path(spark, "stage"))
    return _raw_columns(docs)


@query
def final_document_content_first(spark, sf_dir):
    docs = refine(V.records(spark, sf_dir), Settings(target="en", pairing="content_first"),
                  trained(spark, sf_dir), stage=work_path(spark, "stage"))
    return docs.select(
        "warc_path", F.col("rec_headers")["WARC-Record-ID"].alias("page_record"),
        F.col("rec_headers")["WARC-Type"].alias("header_type"), "text",
        F.try_variant_get(F.element_at("metadata", "fetchTimeMs"), "$", "string").alias("fetch_time"))


# --- sinks -------------------------------------------------------------------------------------
@query
def jsonl_roundtrip(spark, sf_dir):
    path = work_path(spark, "jsonl")
    docs = V.pages(spark, sf_dir).select("page_id", "url", "html", F.lit(None).cast("string").alias("license"))
    sinks.write_jsonl(docs, path)
    return spark.read.schema(docs.schema).json(path)


@query
def shard_roundtrip(spark, sf_dir):
    docs = V.pages(spark, sf_dir).select("page_id", "url", F.md5("html").alias("html_md5"))
    root = work_path(spark, "shards")
    parts = []
    for number, fmt in enumerate(("parquet", "jsonl.gz")):
        path = f"{root}/{sinks.shard_id('2024-07-08T00:00:00', number)}"
        sinks.write_shards(docs, path, fmt)
        if fmt == "parquet":
            back = spark.read.parquet(path)
        else:
            back = spark.read.schema(docs.schema).json(path)
        parts.append(back.withColumn("fmt", F.lit(fmt)))
    return reduce(DataFrame.unionByName, parts)


# --- streaming ---------------------------------------------------------------------------------
def _ingested(spark, sf_dir, runs: int, per_batch: int = 1000, interrupt=None) -> DataFrame:
    archives, out = _archives(spark, sf_dir), work_path(spark, "ingest")
    for run in range(runs):
        try:
            ingest(spark, f"{archives}/*", out, Settings(target="en", mode="raw"), trained(spark, sf_dir),
                   archives_per_batch=per_batch, base=archives, archive_name=archive_name(),
                   interrupt=interrupt if run == 0 else None)
        except Exception:  # noqa: BLE001 -- the planned stop; the next start replays the batch
            if interrupt is None or run:
                raise
    return _raw_columns(spark.read.parquet(f"{out}/documents"))


@query
def stream_ingest(spark, sf_dir):
    return _ingested(spark, sf_dir, 1)


@query
def stream_ingest_replay(spark, sf_dir):
    """Three archives a batch, stopped after the documents of batch 1 and before its ledger; started again."""
    def stop(step, batch_id):
        if step == "documents" and batch_id == 1:
            raise RuntimeError("stopped between documents and ledger")

    return _ingested(spark, sf_dir, 2, per_batch=3, interrupt=stop)


@query
def stream_resume(spark, sf_dir):
    """The same ingestion started twice: the second start finds nothing new."""
    return _ingested(spark, sf_dir, 2)


# --- the main job: manifest, ledger, shards ----------------------------------------------------
def _manifest(spark, archives: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """A manifest of the archive files below ``archives``, relative paths in name order."""
    fs, base = J._fs(spark, archives)
    found = sorted(str(s.getPath().toString()) for s in fs.globStatus(base.suffix("/archive=*/*.gz")))
    root = str(fs.makeQualified(base).toString()).rstrip("/") + "/"
    lines = [f[len(root):] for f in found] + list(extra)
    path = work_path(spark, "manifest")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return read_manifest(spark, path)


def _job(spark, sf_dir, interrupted: bool) -> DataFrame:
    archives, out = _archives(spark, sf_dir), work_path(spark, "job")
    settings, profile = Settings(target="en", mode="raw"), trained(spark, sf_dir)
    manifest = _manifest(spark, archives, ("archive=missing/part-00000.gz",) if interrupted else ())

    def stop(step, batch):
        if step == "documents" and batch == 1:
            raise KeyboardInterrupt

    if interrupted:
        try:
            J.run_manifest(spark, manifest, archives, out, settings, profile, archives_per_batch=4,
                           archive_name=archive_name(), run="20240708000000", interrupt=stop)
        except KeyboardInterrupt:
            pass
    J.run_manifest(spark, manifest, archives, out, settings, profile, archives_per_batch=4,
                   archive_name=archive_name(), run="20240708000001")
    return _raw_columns(J.committed_documents(spark, out))


@query
def manifest_job(spark, sf_dir):
    """Manifest minus ledger, three batches of archives, shards committed by ledger rows."""
    return _job(spark, sf_dir, False)


@query
def manifest_job_retry(spark, sf_dir):
    """Stopped after the documents of batch 1 and before its ledger rows, with a missing archive; run again."""
    return _job(spark, sf_dir, True)
