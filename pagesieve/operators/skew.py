"""Joins that hold when one key has a large share of all rows.

Four ways, by what is known about the smaller side:

* its row count is checked and small -> broadcast (:func:`lookup_join`);
* it is small next to the other side, but not bounded -> each of its rows is
  repeated once per salt, and the other side spreads its rows over the salts
  (:func:`salted_join`);
* its rows are wide, as they hold lists -> their bytes are checked as well as their
  count, and beyond that they are not repeated per salt (:func:`wide_join`);
* it is as large as the other side (keys found in that very side) -> only the
  heavy keys, whose number is bounded whatever the data, are broadcast, and the
  others go through a shuffle in which no key is heavy any more
  (:func:`drop_frequent`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20
SALTS = 32
HEAVY_SLOTS = 10_000


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                spread: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Equi join where a hot key of ``left`` is cut into ``salts`` parts.

    ``spread`` names columns of ``left`` whose values differ within a key.
    ``how`` must keep or drop left rows one by one: inner, left, left_semi, left_anti.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = right.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                spread: Sequence[str], max_rows: int = BROADCAST_ROWS,
                rows: int | None = None) -> DataFrame:
    """Broadcast ``right`` if it has at most ``max_rows`` rows, else salt the join.

    ``rows`` is a known upper bound of its rows. Without one ``right`` is
    counted, so pass a stored table.
    """
    if rows is None:
        rows = right.limit(max_rows + 1).count()
    if rows <= max_rows:
        return left.join(F.broadcast(right), list(on), how)
    return salted_join(left, right, on, how, spread)


def _bytes(value: Column, kind: T.DataType) -> Column:
    """About the bytes of a value in a row that is sent."""
    fixed, more = F.lit(8).cast("bigint"), None
    if isinstance(kind, T.StringType | T.BinaryType):
        more = F.octet_length(value)
    elif isinstance(kind, T.StructType):
        more = sum((_bytes(value[f.name], f.dataType) for f in kind), fixed)
    elif isinstance(kind, T.ArrayType):
        more = F.aggregate(value, fixed, lambda n, x: n + _bytes(x, kind.elementType))
    return fixed if more is None else fixed + F.coalesce(more.cast("bigint"), F.lit(0))


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row of ``df``, from its fields' kinds and the lengths of what varies."""
    return F.lit(8) + sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0))


def wide_join(left: DataFrame, right: DataFrame, on: Sequence[str], max_rows: int = BROADCAST_ROWS,
              max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join with a stored ``right`` whose rows may be wide.

    The driver gets at most ``max_bytes`` of its rows, or of its keys, which leave the
    rows of ``left`` that are shuffled. A key with many rows of ``left`` is then cut by
    the skew join of adaptive execution, which repeats ``right`` for that key alone.
    """
    small = lambda df: df.select(row_bytes(df).alias("b")).agg(
        (F.count("b") <= max_rows) & (F.coalesce(F.sum("b"), F.lit(0)) <= max_bytes)).first()[0]
    if small(right):
        return left.join(F.broadcast(right), list(on), "inner")
    keys = right.select(*on)
    if len(on) < len(right.columns) and small(keys):
        left = left.join(F.broadcast(keys), list(on), "left_semi")
    return left.join(right, list(on), "inner")


def drop_frequent(rows: DataFrame, key: Column, max_count: int,
                  slots: int = HEAVY_SLOTS) -> DataFrame:
    """Drop every row whose ``key`` occurs more than ``max_count`` times.

    NULL keys are kept. A key is heavy if it holds at least ``1 / slots`` of all
    keyed rows; there are at most ``slots`` of those, so their table is
    broadcast. What remains is shuffled, and none of its keys exceeds that share.
    """
    keyed = rows.withColumn("_key", key)
    counts = (
        keyed.where(F.col("_key").isNotNull())
        .groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    )
    total = counts.agg(F.sum("_n")).scalar()
    frequent = counts.where(F.col("_n") > max_count)
    is_heavy = F.col("_n") * F.lit(slots) >= total
    heavy = frequent.where(is_heavy).select("_key")
    light = frequent.where(~is_heavy).select("_key")
    return (
        keyed.join(F.broadcast(heavy), "_key", "left_anti")
        .join(light, "_key", "left_anti")
        .drop("_key")
    )
