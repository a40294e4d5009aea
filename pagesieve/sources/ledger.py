"""The ledger of processed archives."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "warc_path STRING, status STRING, batch_id BIGINT"
SNAPSHOT_SCHEMA = "processed_file_names ARRAY<STRING>"


def read_ledger_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Ledger kept as JSON, one document per line; absent or unreadable means empty.

    Gives ``warc_path``, one row per listed archive.
    """
    try:
        doc = spark.read.schema(SNAPSHOT_SCHEMA).json(path)
    except AnalysisException:
        doc = spark.createDataFrame([], SNAPSHOT_SCHEMA)
    return doc.select(F.explode("processed_file_names").alias("warc_path"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger table written by :func:`append_ledger`; empty when absent."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], LEDGER_SCHEMA)


def append_ledger(entries: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Add rows to the ledger.

    With a ``batch_id`` the rows go to a folder of their own, which a repeated
    batch replaces: writing the same batch twice leaves one copy.
    """
    columns = ("warc_path", "status")
    if batch_id is None:
        entries.select(*columns, F.col("batch_id").cast("bigint")).write.mode("append").parquet(path)
    else:
        entries.select(*columns).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
