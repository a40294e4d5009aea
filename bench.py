"""Headline queries, timed. Prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) is the data, ``BENCH_CPUS`` the
local cores. Every query is written to the ``noop`` sink, so all its columns
are computed for all rows. Names on the command line restrict the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks import registry  # noqa: E402

HEADLINE = (
    "lang_probe_text", "page_metadata", "html_blocks", "main_text_markdown", "drop_repeated_blocks",
    "content_fingerprint", "train_profile", "predict_language", "top_k_languages",
    "parse_fields", "carry_pair", "carry_pair_content_first", "carry_pair_events",
    "warc_scan", "drop_failed_archives", "jsonl_roundtrip", "shard_roundtrip",
    "final_document_raw", "final_document", "stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    all_queries = registry.queries()
    # start the JVM's code paths and train the model outside the measured time
    spark.read.parquet(f"{sf_dir}/pages.parquet").write.format("noop").mode("overwrite").save()
    registry.trained(spark, sf_dir)
    times = {}
    for name in chosen:
        start = time.time()
        all_queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
