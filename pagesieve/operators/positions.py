"""Sets of record positions as bitmaps, used as a filter inside a scan in place of a join.

A record's position is ``(warc_path, rec_seq)``. ``rec_seq`` comes from the scan's row ids:
its high bits name the scan partition (the "stretch"), its low 33 bits count rows within it,
so positions are dense within a stretch. A set of positions becomes one bitmap per archive,
stretch and bucket of 32,768 positions (``bitmap_construct_agg``, 4 KB each, built by a
partial aggregation). Bitmaps are broadcast and a row is kept when its bit is set: the rows
being filtered (pages with their contents) stay in their scan task and are never shuffled.

The broadcast is bounded: bitmaps are counted and sent in as many rounds as
``max_bytes`` asks, each round a scan of the rows against its share of the bitmaps; a
row meets exactly one round, the one holding its bucket. One round is the usual case:
a bitmap costs one bit per record of the batch and 4 KB at least per archive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRETCH_BITS = 33                 # low bits of a row id: the row within its scan partition
BUCKET_BYTES = 4096               # Spark's bitmap: 32,768 positions
MAX_BYTES = 64 * 1024 * 1024
MAX_ROWS = 500_000


def _place(seq: Column) -> tuple[Column, Column, Column]:
    """Stretch, bucket and bit of a position."""
    within = seq.bitwiseAND(F.lit((1 << STRETCH_BITS) - 1)) + 1
    return F.shiftright(seq, STRETCH_BITS), F.bitmap_bucket_number(within), F.bitmap_bit_position(within)


def position_bitmaps(positions: DataFrame, archive: str = "warc_path", seq: str = "rec_seq") -> DataFrame:
    """``archive, _stretch, _bucket, _bits``: the positions of ``positions`` as bitmaps."""
    stretch, bucket, bit = _place(F.col(seq))
    return positions.select(archive, stretch.alias("_stretch"), bucket.alias("_bucket"), bit.alias("_bit")).groupBy(
        archive, "_stretch", "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def has_bit(bits: Column, bit: Column) -> Column:
    """Whether ``bit`` is set in ``bits`` (byte ``bit / 8``, bit ``bit % 8`` from the lowest)."""
    byte = F.conv(F.hex(bits.substr((F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def keep_positions(rows: DataFrame, bitmaps: DataFrame, archive: str = "warc_path", seq: Column | None = None,
                   max_bytes: int = MAX_BYTES) -> DataFrame:
    """Rows of ``rows`` whose position is in ``bitmaps`` (a stored table); rows are not shuffled."""
    stretch, bucket, bit = _place(F.col("rec_seq") if seq is None else seq)
    placed = rows.withColumns({"_stretch": stretch, "_bucket": bucket, "_bit": bit})
    count = bitmaps.count()
    rounds = max(1, -(-count * (BUCKET_BYTES + 256) // max_bytes))
    kept = None
    for r in range(rounds):
        share = bitmaps if rounds == 1 else bitmaps.where(
            F.pmod(F.xxhash64(archive, "_stretch", "_bucket"), F.lit(rounds)) == r)
        found = placed.join(F.broadcast(share), [archive, "_stretch", "_bucket"]).where(
            has_bit(F.col("_bits"), F.col("_bit")))
        kept = found if kept is None else kept.unionByName(found)
    return kept.drop("_stretch", "_bucket", "_bit", "_bits")


def size_bound(df: DataFrame) -> int:
    """Spark's own estimate of a stored table's bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def attach(rows: DataFrame, small: DataFrame, on: Sequence[str], max_rows: int = MAX_ROWS,
           max_bytes: int = MAX_BYTES) -> DataFrame:
    """Inner join of ``rows`` with a stored table ``small`` keyed by unique positions.

    ``small`` is broadcast when both its row count and its size are within bounds, so
    ``rows`` stays in its scan task; beyond them ``rows`` (already filtered to the
    positions of ``small``) is shuffled.
    """
    if small.limit(max_rows + 1).count() <= max_rows and size_bound(small) <= max_bytes:
        return rows.join(F.broadcast(small), list(on))
    return rows.join(small, list(on))
