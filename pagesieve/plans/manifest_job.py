"""The main job: the archives of a manifest that the ledger does not hold as done, in batches.

Every batch of a run lands its archives, makes their documents, writes them as one shard and
then writes one ledger row per archive of the batch. The ledger rows are the commit mark:

* documents go to ``{out}/shards/{shard}``, ``shard = shard_id(run, batch)``, by Spark's own
  job commit (``_SUCCESS`` once all files are in place);
* then the batch's ledger rows go to ``{out}/ledger/run={run}/batch={batch}``: archive,
  ``status`` (``ok`` or ``failed``), run, batch, shard and, for a failure, the error's class;
* readers (:func:`committed_documents`) take only ledger folders with ``_SUCCESS``, each
  archive's latest attempt, and from each shard only the archives whose latest attempt is
  ``ok`` there. A shard that no committed ledger row names is an interrupted attempt and is
  never read; its archives are still pending and are done again by the next run.

The ledger is a table of attempts. :func:`archive_states` takes each archive's latest one
(``max_by`` over run and batch); an archive is pending while that is not ``ok``, so failed
archives are taken again by every run until they succeed. An archive without records is
``ok``. When a batch fails as a whole (a damaged archive stops Spark's job), each of its
archives is tried alone, and only those that fail alone are ``failed``.

Small batches are worked on together, as the fixed cost of a job's plans would otherwise be
paid for every few archives: the first batch alone, then two, four and so on
(:func:`waves`), as long as they hold ``archives_per_job`` archives at most. The batches
of such a wave share one shard, named by the first of them, and one committed ledger
folder; each archive's row keeps its own batch. A wave that fails is halved.

``interrupt(step, batch)``, called for each batch after each write (``"documents"``,
``"ledger"``), lets a test stop the job between the two, as a lost driver would.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.progress import pending
from ..sources.sinks import shard_id, write_shards
from ..sources.warc import archive_pieces, land_archives
from .refine import Settings, failed_archives, refine

ATTEMPTS = "warc_path string, name string, status string, run string, batch bigint, shard string, error string"
ARCHIVES_PER_JOB = 1000


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def committed_folders(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Folders below ``root`` matching ``pattern`` that hold ``_SUCCESS``."""
    fs, base = _fs(spark, root)
    found = fs.globStatus(base.suffix(f"/{pattern}/_SUCCESS")) or []
    return sorted(str(status.getPath().getParent().toString()) for status in found)


def read_attempts(spark: SparkSession, out: str) -> DataFrame:
    """All committed ledger rows of ``out``; none before the first run."""
    folders = committed_folders(spark, f"{out}/ledger", "run=*/batch=*")
    if not folders:
        return spark.createDataFrame([], ATTEMPTS)
    return spark.read.schema(ATTEMPTS).parquet(*folders)


def archive_states(attempts: DataFrame) -> DataFrame:
    """Each archive's latest attempt: ``warc_path, name, status, run, batch, shard, error``."""
    latest = F.max_by(F.struct("name", "status", "run", "batch", "shard", "error"), F.struct("run", "batch"))
    return attempts.groupBy("warc_path").agg(latest.alias("s")).select("warc_path", "s.*")


def committed_documents(spark: SparkSession, out: str, fmt: str = "parquet", schema=None) -> DataFrame | None:
    """Documents of every archive whose latest attempt is ``ok``, read from that attempt's shard."""
    states = archive_states(read_attempts(spark, out)).where("status = 'ok'")
    shards = [r.shard for r in states.select("shard").distinct().collect()]     # one per batch
    fs, _ = _fs(spark, out)
    paths = [f"{out}/shards/{s}" for s in sorted(shards)
             if fs.exists(_fs(spark, f"{out}/shards/{s}/_SUCCESS")[1])]
    if not paths:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    docs = reader.parquet(*paths) if fmt == "parquet" else reader.json(paths)
    docs = docs.withColumn("_shard", F.regexp_extract(F.input_file_name(), r"/shards/([^/]+)/", 1))
    wanted = states.select(F.col("name").alias("_name"), F.col("shard").alias("_in"))
    return docs.join(wanted, (F.col("warc_path") == F.col("_name")) & (F.col("_shard") == F.col("_in")),
                     "left_semi").drop("_shard")


def _entries(spark: SparkSession, batches: list[list[str]], first: int, name: Column | None) -> DataFrame:
    rows = spark.createDataFrame([(p, n) for n, paths in enumerate(batches, first) for p in paths],
                                 "warc_path string, batch bigint")
    return rows.withColumn("name", name if name is not None else F.col("warc_path"))


def run_manifest(spark: SparkSession, manifest: DataFrame, base: str, out: str, settings: Settings,
                 profile: DataFrame | None = None, archives_per_batch: int = 1000, fmt: str = "parquet",
                 archive_name: Column | None = None, run: str | None = None,
                 interrupt: Callable[[str, int], None] | None = None, archives_per_job: int = ARCHIVES_PER_JOB) -> int:
    """Process the pending archives of ``manifest`` (``line_no, warc_path``, paths below ``base``).

    Returns the number of batches run. ``archive_name`` derives the documents' ``warc_path``
    from the manifest's path (the ledger keeps the manifest's path); ``fmt`` is
    ``parquet`` or ``jsonl.gz``. Archives listed twice are done once.
    """
    run = run or datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    states = archive_states(read_attempts(spark, out)).select("warc_path", "status")
    todo = pending(manifest, states).groupBy("warc_path").agg(F.min("line_no").alias("line_no"))
    listed = f"{out}/work/run={run}/todo"
    todo.write.mode("overwrite").parquet(listed)
    ordered, batch = spark.read.parquet(listed), 0
    for count in waves(archives_per_batch, archives_per_job):
        # the driver takes one wave of paths at a time: it must name the files it reads
        rows = ordered.orderBy("line_no", "warc_path").limit(count * archives_per_batch).collect()
        paths = [r.warc_path for r in rows]
        if not paths:
            return batch
        parts = [paths[i:i + archives_per_batch] for i in range(0, len(paths), archives_per_batch)]
        _one_wave(spark, parts, base, out, settings, profile, fmt, archive_name, run, batch, interrupt)
        batch += len(parts)
        line, path = rows[-1].line_no, rows[-1].warc_path
        ordered = spark.read.parquet(listed).where(
            (F.col("line_no") > line) | ((F.col("line_no") == line) & (F.col("warc_path") > path)))


def waves(per_batch: int, per_job: int) -> Iterator[int]:
    """Batches worked on together: 1, 2, 4, ... as far as ``per_job`` archives go, without end."""
    count, most = 1, max(1, per_job // per_batch)
    while True:
        yield min(count, most)
        count = min(2 * count, most)


def _one_wave(spark, batches, base, out, settings, profile, fmt, archive_name, run, first, interrupt):
    paths, shard = [p for b in batches for p in b], shard_id(run, first)
    try:
        failed = _documents(spark, paths, base, out, settings, profile, fmt, archive_name, run, first, shard)
        errors = {}
    except Exception as error:                      # a damaged archive stops the whole wave
        if len(paths) == 1:
            failed, errors = set(), {paths[0]: type(error).__name__}
        elif len(batches) > 1:
            half = len(batches) // 2
            for start, part in ((0, batches[:half]), (half, batches[half:])):
                _one_wave(spark, part, base, out, settings, profile, fmt, archive_name, run, first + start, interrupt)
            return
        else:
            for number, path in enumerate(paths):
                _one_wave(spark, [[path]], base, out, settings, profile, fmt, archive_name,
                          f"{run}-{first:09d}", number, interrupt)
            return
    numbers = range(first, first + len(batches))
    for number in numbers if interrupt else ():
        interrupt("documents", number)
    entries = _entries(spark, batches, first, archive_name)
    status = F.when(F.col("warc_path").isin(list(errors)) | F.col("name").isin(list(failed)), "failed").otherwise("ok")
    error = F.element_at(F.create_map(*[F.lit(x) for kv in errors.items() for x in kv]), F.col("warc_path")) \
        if errors else F.lit(None).cast("string")
    entries.select("warc_path", "name", status.alias("status"), F.lit(run).alias("run"), "batch",
                   F.lit(None if errors else shard).cast("string").alias("shard"), error.alias("error")).coalesce(
        1).write.mode("overwrite").parquet(f"{out}/ledger/run={run}/batch={first}")
    for number in numbers if interrupt else ():
        interrupt("ledger", number)


def _documents(spark, paths, base, out, settings, profile, fmt, archive_name, run, batch, shard) -> set[str]:
    """Write the batch's documents; the names of its failed archives."""
    work = f"{out}/work/run={run}/batch={batch}"
    landed = land_archives(archive_pieces(spark, [f"{base.rstrip('/')}/{p}" for p in paths]), f"{work}/records",
                           base, archive_name)
    docs = refine(landed, settings, profile, stage=f"{work}/stage")
    write_shards(docs, f"{out}/shards/{shard}", fmt)
    if settings.fail_mode != "archive":
        return set()
    return {r.warc_path for r in failed_archives(landed, settings).collect()}     # at most the batch's archives
