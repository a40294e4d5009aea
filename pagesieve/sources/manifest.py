"""Archive lists and archive locations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One archive path per line, plain or gzip; ``line_no`` keeps the order.

    A manifest is one text file of some 100,000 lines. Gzip makes it a single
    split, so the generated id follows its line order.
    """
    return (
        spark.read.text(path)
        .select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("warc_path"))
        .where(F.col("warc_path") != "")
    )


def with_location(manifest: DataFrame, base: str) -> DataFrame:
    """Add ``location``: where an archive is read from."""
    return manifest.withColumn("location", F.concat(F.lit(base), F.col("warc_path")))
