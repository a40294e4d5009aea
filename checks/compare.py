"""Run queries next to their DuckDB twins and compare the rows.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("checks")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted(([r[n] for n in names] for r in df.collect()), key=_key)


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(([r[i] for i in order] for r in cur.fetchall()), key=_key)


def main(sf_dir="/root/testdata/sf0.01", *names):
    from checks import registry, sql

    spark, con = session(), duck(sf_dir)
    oracles = sql.oracle_sql()
    bad = []
    for name, query in registry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = rows_of_spark(query(spark, sf_dir))
            took = time.time() - start
            if name not in oracles:
                print(f"{name:28s} rows={len(got[1]):7d} {took:6.2f}s (no twin)", flush=True)
                continue
            want = rows_of_duck(con, oracles[name])
            same = got == want
            print(f"{name:28s} rows={len(got[1]):7d} {took:6.2f}s duck={time.time() - start - took:5.2f}s "
                  f"{'ok' if same else 'DIFFERENT'}", flush=True)
            if not same:
                bad.append(name)
                print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
                for g, w in list(x for x in zip(got[1], want[1]) if x[0] != x[1])[:2]:
                    print("   spark", str(g)[:600])
                    print("   duck ", str(w)[:600])
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"{name:28s} FAILED {type(e).__name__} {str(e)[:900]}", flush=True)
    print("different or failed:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
