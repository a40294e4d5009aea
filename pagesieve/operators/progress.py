"""What is left to do and what was done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Manifest rows whose archive the ledger does not list as done.

    Repeated manifest rows stay repeated. A ledger with a ``status`` counts
    ``ok`` rows only, so failed archives stay pending. Spark broadcasts the
    ledger when its size allows.
    """
    done = ledger.where(F.col("status") == "ok") if "status" in ledger.columns else ledger
    return manifest.join(done.select("warc_path"), "warc_path", "left_anti")


def distinct_archives(df: DataFrame) -> DataFrame:
    return df.select("warc_path").distinct()


def run_summary(ledger: DataFrame) -> DataFrame:
    """Archives per status."""
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("archives"))
