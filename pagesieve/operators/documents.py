"""Final documents, in either output shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P

TEXT_COLUMNS = (
    "title", "author", "hostname", "date", "fingerprint", "id", "license", "comments", "raw_text",
    "text", "language", "image", "pagetype", "filedate", "source", "source-hostname", "excerpt",
    "categories", "tags", "rejected", "rejected_reason", "languages-fasttext",
    "rec_headers", "metadata", "warc_path",
)
RAW_COLUMNS = ("raw_data", "encoding", "rec_headers", "metadata", "warc_path")


def raw_projection(payload: Column) -> list[Column]:
    """The page in base64 and the tag naming that encoding."""
    return [F.base64(payload).alias("raw_data"), F.lit(P.RAW_ENCODING).alias("encoding")]


def final_document(df: DataFrame, mode: str = "text", run_date: str | None = None) -> DataFrame:
    """Select the output columns of ``mode`` (``text`` or ``raw``).

    Text mode wants the columns of ``page_metadata``, ``raw_text``, ``text``,
    ``fingerprint``, ``rejected``, ``rejected_reason``, ``prediction`` (NULL if
    the classifier is off); both want ``rec_headers``, ``metadata``, ``warc_path``.
    """
    if mode == "raw":
        return df.select(*raw_projection(F.col("payload")), "rec_headers", "metadata", "warc_path")
    if mode != "text":
        raise ValueError("mode must be 'text' or 'raw'")
    nothing = F.lit(None).cast("string")
    fixed = df.withColumns({
        "id": nothing,
        "language": nothing,
        "comments": F.lit(""),
        "filedate": F.lit(run_date).cast("date").cast("string"),
    }).withColumnRenamed("prediction", "languages-fasttext")
    return fixed.select(*[F.col(f"`{c}`") for c in TEXT_COLUMNS])
