"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the byte-level functions rely on.
SESSION_CONF = {
    # decode()/encode() accept every JVM charset (Shift_JIS, EUC-JP, ...)
    "spark.sql.legacy.javaCharsets": "true",
    # a malformed byte becomes U+FFFD instead of failing the job; the charset
    # cascade uses that character as its "does not decode" signal
    "spark.sql.legacy.codingErrorAction": "true",
    # base64 without line breaks
    "spark.sql.chunkBase64String.enabled": "false",
    # repeated header / annotation keys: the last one wins
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options this package needs on ``spark`` and return it."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, visible to every executor.

    It is the folder named by ``spark.checkpoint.dir``. Only when a session
    names none (tests, local mode) one is made and set for this session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="pagesieve-")
    spark.sparkContext.setCheckpointDir(made)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/pagesieve/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a stored table that half of them at most would work on.

    A small table in one file is one task, whatever follows. A large one has
    more splits than cores and is left as it is, without a shuffle. ``df`` must
    be a plain scan, whose splits are known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df
