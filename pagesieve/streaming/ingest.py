"""Incremental ingestion: new archives only, a fixed number of them per batch.

The checkpoint remembers which files were read. A batch that was interrupted
is repeated with the same files and the same number; all it writes goes to
folders named by that number and replaces what an earlier attempt left, so
each archive ends up in the output once.

Small batches are worked on together: the stream takes as many files at a time as
whole batches of ``archives_per_batch`` make up to ``archives_per_job``, and what it
took is cut into batches in the order of the archives' names. Batch ``i`` of the stream's
batch ``b`` has the number ``b * STRIDE + i``; a replay takes the same files and so
makes the same batches. Every batch keeps its own folders of documents and ledger rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.refine import Settings, failed_archives, refine
from ..sources.ledger import append_ledger
from ..sources.sinks import write_batches, write_shards
from ..sources.warc import archive_pieces, land_archives, numbered

ARCHIVES_PER_JOB = 1000
STRIDE = 1_000_000


def start_ingest(spark: SparkSession, archives: str, out: str, settings: Settings,
                 profile: DataFrame | None = None, archives_per_batch: int = 1000,
                 base: str | None = None, archive_name: Column | None = None,
                 interrupt: Callable[[str, int], None] | None = None,
                 archives_per_job: int = ARCHIVES_PER_JOB) -> StreamingQuery:
    """Start ingesting everything below ``archives`` that was not ingested before.

    Below ``out``: ``documents`` (one folder per batch), ``ledger`` (one row per
    archive), ``records`` (the landed records of a batch) and ``checkpoint``.
    ``archive_name`` derives the archive's name from ``warc_path``. ``interrupt(step,
    batch_id)`` is called for each batch after each write (``"records"``, ``"documents"``, ``"ledger"``);
    an exception there stops the query as a lost driver would, and the next start
    replays that batch into the same folders.
    """

    together = max(1, archives_per_job // archives_per_batch)

    def mark(step: str, numbers: range) -> None:
        for number in numbers if interrupt else ():
            interrupt(step, number)

    def run_batch(pieces: DataFrame, batch_id: int) -> None:
        landed = land_archives(numbered(pieces), f"{out}/records/batch_id={batch_id}", base, archive_name)
        numbers, batch_of = range(batch_id, batch_id + 1), None
        if together > 1:
            numbers, batch_of = _batches(landed, archives_per_batch, batch_id * STRIDE)
        mark("records", numbers)
        documents = refine(landed, settings, profile, stage=f"{out}/stage/batch_id={batch_id}")
        if batch_of is None:
            write_shards(documents, f"{out}/documents/batch_id={batch_id}", "parquet")
        else:
            write_batches(documents.join(batch_of, "warc_path").select(*documents.columns, "batch_id"),
                          f"{out}/documents", numbers)
        mark("documents", numbers)
        archives_read = landed.select("warc_path").distinct()
        if settings.fail_mode == "archive":
            failed = failed_archives(landed, settings).withColumn("failed", F.lit(True))
            archives_read = archives_read.join(failed, "warc_path", "left")
        else:
            archives_read = archives_read.withColumn("failed", F.lit(None).cast("boolean"))
        status = F.when(F.col("failed"), "failed").otherwise(F.lit("ok"))
        entries = archives_read.withColumn("status", status)
        if batch_of is None:
            append_ledger(entries, f"{out}/ledger", batch_id)
        else:
            write_batches(entries.join(batch_of, "warc_path").select("warc_path", "status", "batch_id"),
                          f"{out}/ledger", numbers)
        mark("ledger", numbers)

    pieces = archive_pieces(spark, archives, archives_per_batch * together)
    return (
        pieces.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _batches(landed: DataFrame, per_batch: int, first: int) -> tuple[range, DataFrame]:
    """Numbers of the batches that the landed archives make in name order, and ``warc_path, batch_id``."""
    names = sorted(r.warc_path for r in landed.select("warc_path").distinct().collect())   # of one job's archives
    rows = [(name, first + i // per_batch) for i, name in enumerate(names)]
    table = landed.sparkSession.createDataFrame(rows, "warc_path string, batch_id bigint")
    return range(first, first + max(1, -(-len(names) // per_batch))), F.broadcast(table)


def ingest(spark: SparkSession, *args, **kwargs) -> None:
    """:func:`start_ingest`, to completion."""
    start_ingest(spark, *args, **kwargs).awaitTermination()
