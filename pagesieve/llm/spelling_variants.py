"""Spelling variants by permuterm rotations.

Every word ``w`` gets a terminator, ``w$``, and all its rotations. Two kinds of keys come
from them:

* a whole rotation ``s[j:] + s[:j]`` of ``s = w$`` (the word in the role of the shorter one);
* a rotation that starts after position ``i`` with its last character, ``w[i]``, left out:
  ``w[i+1:] $ w[:i]``. This is the prefix range of rotations that skips the edited character.

Words that differ only by a replacement at ``i`` share the second kind at ``i``; a word and
the same word with ``w[i]`` deleted meet as second kind (longer word) and first kind
(shorter word). Deleting any character of a run of equal characters gives the same word,
so only the last position of a run is used for deletions, and every near pair meets in
exactly one key. Keys are grouped (a sort by key in Spark, the "sorted rotations"); a key
determines the word up to one character, so a group holds at most one whole rotation and
one entry per letter, at most ``1 + ALPHABET`` rows, whatever the data. Each group gives
every member its neighbour count and its best neighbour; they are summed over groups by
word. Pairs are never listed.

``forms(docs)``: runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts (null: none), A-Z lower-cased
only. ``h`` = unsigned crc32 of UTF-8 ``<doc_id>:<run>``; if ``h % 31 == 0`` the run loses its
code point ``h % length``. A null ``doc_id`` makes ``h`` null: nothing is deleted. Words are the
distinct results of at least ``min_length`` code points found ``min_count`` times or more in all
texts (repeated rows count again). Near: one inserted, deleted or replaced code point. A word's
form is its near word of largest ``n`` (ties: smallest in code-point order) if that ``n`` is at
least ``factor`` times its own; ``root`` follows forms to the end (``n`` grows tenfold each step,
so chains are short and never cycle). An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_path

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = 26 + 64          # code points a word can hold after lower-casing A-Z
END = "$"                   # not a letter of any word
DELETE_EVERY = 31


def word_counts(docs: DataFrame, min_length: int = 7, min_count: int = 2,
                text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(word, n): the words and how often they stand in all texts."""
    runs = docs.select(F.col(f"`{id_col}`").alias("_id"),
                       F.explode(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(LETTERS), 0)).alias("run"))
    run = F.translate("run", UPPER, LOWER)
    h = F.crc32(F.concat(F.col("_id").cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
    word = F.when(h % DELETE_EVERY == 0, cut).otherwise(run)
    counted = runs.select(word.alias("word")).where(F.length("word") >= min_length).groupBy("word").count()
    return counted.where(F.col("count") >= min_count).select("word", F.col("count").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(key, whole, canonical, word, n): both kinds of keys of every word."""
    s = F.concat(F.col("word"), F.lit(END))
    size = F.length("word")
    whole = F.transform(F.sequence(F.lit(0), size), lambda j: F.struct(
        F.concat(s.substr(j + 1, size + 1), s.substr(F.lit(1), j)).alias("key"),
        F.lit(True).alias("whole"), F.lit(False).alias("canonical")))
    skipping = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.concat(s.substr(i + 2, size + 1), s.substr(F.lit(1), i)).alias("key"), F.lit(False).alias("whole"),
        ((i == size - 1) | (F.col("word").substr(i + 1, F.lit(1)) != F.col("word").substr(i + 2, F.lit(1))))
        .alias("canonical")))
    return words.select("word", "n", F.explode(F.concat(whole, skipping)).alias("k")).select(
        "k.key", "k.whole", "k.canonical", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best): best = (-n, word) of the best near word, or null."""
    rows = rotations(words)
    group = Window.partitionBy("key")
    ranked = group.orderBy("whole", F.desc("n"), "word")      # entries of the second kind first
    entry = F.struct((-F.col("n")).alias("neg_n"), F.col("word").alias("word"))
    skip = ~F.col("whole")
    rows = rows.withColumn("place", F.row_number().over(ranked)).select(
        "word", "n", "whole", "canonical", "place",
        F.count(F.when(skip, 1)).over(group).alias("n_skip"),
        F.count(F.when(F.col("whole"), 1)).over(group).alias("n_whole"),
        F.count(F.when(skip & F.col("canonical"), 1)).over(group).alias("n_canonical"),
        F.min(F.when(skip & (F.col("place") == 1), entry)).over(group).alias("skip1"),
        F.min(F.when(skip & (F.col("place") == 2), entry)).over(group).alias("skip2"),
        F.min(F.when(F.col("whole"), entry)).over(group).alias("best_whole"),
        F.min(F.when(skip & F.col("canonical"), entry)).over(group).alias("best_canonical"))
    replaced_best = F.when(F.col("place") == 1, F.col("skip2")).otherwise(F.col("skip1"))
    deleted_best = F.when(F.col("canonical"), F.col("best_whole"))
    count = F.when(F.col("whole"), F.col("n_canonical")).otherwise(
        F.col("n_skip") - 1 + F.when(F.col("canonical"), F.col("n_whole")).otherwise(0))
    best = F.when(F.col("whole"), F.col("best_canonical")).otherwise(F.least(replaced_best, deleted_best))
    return rows.groupBy("word", "n").agg(F.sum(count).alias("n_near"), F.min(best).alias("best"))


def forms(spark: SparkSession, docs: DataFrame, min_length: int = 7, min_count: int = 2, factor: int = 10,
          text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(word, form, root, n, n_near, form_n); see the module."""
    path = work_path(spark, "spelling-words")
    found = neighbours(word_counts(docs, min_length, min_count, text_col, id_col))
    good = F.col("best").isNotNull() & (-F.col("best.neg_n") >= factor * F.col("n"))
    found.select("word", "n", F.col("n_near").cast("bigint").alias("n_near"),
                 F.when(good, F.col("best.word")).alias("form"),
                 F.when(good, -F.col("best.neg_n")).cast("bigint").alias("form_n")).write.parquet(path)
    table = spark.read.parquet(path)
    largest = table.agg(F.max("n")).first()[0] or 1
    steps, reach = 0, 1                 # a chain has at most log_factor(largest) + 1 links
    while reach < 2 + int(largest).bit_length():
        steps, reach = steps + 1, 2 * reach
    links = table.where(F.col("form").isNotNull()).select("word", F.col("form").alias("up"))
    for _ in range(steps):            # pointer jumping: each step doubles the links followed
        further = links.select(F.col("word").alias("via"), F.col("up").alias("next"))
        step = work_path(spark, "spelling-links")
        links.join(further, F.col("up") == F.col("via"), "left").select(
            "word", F.coalesce("next", "up").alias("up")).write.parquet(step)
        links = spark.read.parquet(step)
    return table.join(links, "word", "left").select(
        "word", "form", F.coalesce("up", "word").alias("root"), "n", "n_near", "form_n")
