"""Line deduplication with overlapping windows of three lines.

Lines that hold a word are numbered; every three in a row are a window, known by
two 64-bit hashes. A window found more than once, anywhere, keeps its first
occurrence (smallest document id, then place); the lines of all others are
removed. Windows overlap, so the covered places of a document are merged, and a
line goes if any removed window covers it.

Windows are counted before they are shuffled. Windows that hold a large share of
all occurrences are few and their table is broadcast, the others are joined by
hash. Texts are moved once, to meet the places to remove.

Cases: null text has no lines and stays null. A text of less than three lines
with words has no window and stays as it is. Lines without a word stay, and do
not part windows. A text whose lines are all removed becomes its remaining lines,
or an empty one. Rows with the same id and text count as one document: they get
the same result, and their number does not make a window repeated. Null ids come
first. Columns besides the text are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bind import let
from ..session import work_path
from . import textnative as T

WIDTH = 3
HEAVY_SLOTS = 10_000


def _same_document(a: str, b: str) -> Column:
    return F.col(f"{a}.ln_id").eqNullSafe(F.col(f"{b}.ln_id")) & (F.col(f"{a}.ln_hash") == F.col(f"{b}.ln_hash"))


def windows(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """``ln_id, ln_hash, pos, h1, h2``: the windows of every distinct document."""

    def hashed(lines: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(lines) - width)

        def window(i: Column) -> Column:
            parts = [F.get(lines, i + k) for k in range(width)]
            return F.struct(i.alias("pos"), F.xxhash64(*parts).alias("h1"),
                            F.xxhash64(F.lit(width), *parts).alias("h2"))

        return F.when(F.size(lines) < width, F.array().cast("array<struct<pos:int,h1:bigint,h2:bigint>>")).otherwise(
            F.transform(starts, window))

    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("ln_id"), F.xxhash64(text_col).alias("ln_hash"),
        F.inline(let(T.lines_with_words(F.col(text_col)), hashed)))
    return rows


def later_occurrences(found: DataFrame) -> DataFrame:
    """Rows of ``found``, a stored table of windows, that repeat an earlier one."""
    place = F.struct("ln_id", "ln_hash", "pos")
    repeated = found.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n"),
    ).where(F.col("first") != F.col("last")).select("h1", "h2", "first", "n")
    path = work_path(found.sparkSession, "line-windows")
    repeated.write.parquet(path)
    repeated = found.sparkSession.read.parquet(path)
    total = found.count()
    heavy = F.col("n") * HEAVY_SLOTS >= total  # at most HEAVY_SLOTS windows
    many = repeated.where(heavy).select("h1", "h2", F.col("first").alias("often_first"))
    few = repeated.where(~heavy).select("h1", "h2", "first")
    known = found.join(F.broadcast(many), ["h1", "h2"], "left")
    by_heavy = known.where(F.col("often_first").isNotNull()).withColumn("first", F.col("often_first"))
    by_light = known.where(F.col("often_first").isNull()).join(few, ["h1", "h2"])
    hits = by_heavy.unionByName(by_light)
    return hits.where(place != F.col("first")).select("ln_id", "ln_hash", "pos")


def kept_lines(text: Column, removed: Column, width: int = WIDTH) -> Column:
    """``text`` without the lines that windows starting at ``removed`` cover, and their number.

    Windows count lines with words; those are translated to line numbers, and
    what is left of all line numbers is put together again.
    """

    def cut(lines: Column) -> Column:
        def numbered(numbers: Column) -> Column:
            with_words = F.filter(numbers, lambda i: T.without(F.get(lines, i), T.BLANKS) != "")
            return let(with_words, lambda w: F.array_distinct(F.flatten(F.transform(
                removed, lambda p: F.slice(w, p + 1, width)))))

        def rest(numbers: Column) -> Column:
            return let(numbered(numbers), lambda gone: F.struct(
                F.array_join(F.transform(F.array_except(numbers, gone), lambda i: F.get(lines, i)), "\n").alias("text"),
                F.size(gone).cast("bigint").alias("n")))

        return let(F.sequence(F.lit(0), F.size(lines) - 1), rest)

    return let(F.split(text, "\n"), cut)


def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          width: int = WIDTH, count_col: str = "ln_removed") -> DataFrame:
    """``docs`` with later occurrences of repeated windows cut out of the text; ``count_col`` lines were cut."""
    spark = docs.sparkSession
    path = work_path(spark, "lines")
    windows(docs, id_col, text_col, width).write.parquet(path)
    later = later_occurrences(spark.read.parquet(path))
    cuts = later.groupBy("ln_id", "ln_hash").agg(F.sort_array(F.collect_set("pos")).alias("ln_cuts"))
    rows = docs.withColumns({"ln_id": F.col(id_col), "ln_hash": F.xxhash64(text_col)})
    joined = rows.alias("d").join(cuts.alias("c").hint("shuffle_hash"), _same_document("d", "c"), "left").select(
        *[F.col(f"d.`{c}`") for c in docs.columns], F.col("c.ln_cuts"))
    cut = F.when(F.col("ln_cuts").isNotNull(), kept_lines(F.col(text_col), F.col("ln_cuts"), width))
    out = joined.select(*[f"`{c}`" for c in docs.columns], cut.alias("ln_cut"))
    return out.select(
        *[F.coalesce(F.col("ln_cut.text"), F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`")
          for c in docs.columns],
        F.coalesce(F.col("ln_cut.n"), F.lit(0)).cast("bigint").alias(count_col))
