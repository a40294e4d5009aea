"""Writers for documents."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jsonl(df: DataFrame, path: str, mode: str = "append", compression: str | None = None) -> None:
    """JSON lines: UTF-8, nulls written out, characters unescaped."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def shard_id(run_time: str, batch_id: int) -> str:
    """Directory name of a shard; sorts by run time, then batch.

    It depends on its arguments only, so a repeated batch writes to the same place.
    """
    stamp = "".join(ch for ch in run_time if ch.isdigit())
    return f"shard-{stamp}-{batch_id:09d}"


def write_shards(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Compressed shards of documents, one folder per call, written in parallel.

    ``parquet`` (zstd) or ``jsonl.gz``.
    """
    if fmt == "parquet":
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    elif fmt == "jsonl.gz":
        write_jsonl(df, path, mode, "gzip")
    else:
        raise ValueError("fmt must be 'parquet' or 'jsonl.gz'")


def write_batches(df: DataFrame, path: str, numbers: range) -> None:
    """Rows of several batches, one folder ``batch_id=<number>`` each; what these folders held is replaced."""
    spark = df.sparkSession
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def folders():
        found = (s.getPath() for s in fs.globStatus(root.suffix("/batch_id=*")) or [])
        return [p for p in found if int(p.getName().split("=")[1]) in numbers]

    for folder in folders():
        fs.delete(folder, True)
    df.repartition("batch_id").write.mode("append").option("compression", "zstd").partitionBy("batch_id").parquet(path)
    if not folders():                       # no rows at all: the schema is kept
        df.drop("batch_id").limit(0).write.option("compression", "zstd").parquet(f"{path}/batch_id={numbers[0]}")
