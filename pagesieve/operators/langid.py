"""Language identification with a character-trigram model kept as a table.

Training counts all trigrams per language, with Laplace-smoothed log
probabilities (a multinomial model). Weights are integers, millionths of a nat, so sums do not
depend on the order of addition.

Prediction explodes a text's trigrams, looks each up in the profile and sums
one column per language. Only (id, sums) rows are shuffled, and sums are
combined before the shuffle, so neither a common trigram nor a long text makes
a hot task. A profile of up to ``BROADCAST_BYTES`` is broadcast, a larger one joined
with salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..session import work_path
from .skew import lookup_join

SCALE = 1_000_000
BROADCAST_BYTES = 100 * 1024 * 1024  # a profile row: a trigram and one number per language


def normalized(text: Column) -> Column:
    """Lower-case letters with single blanks around every word."""
    letters = F.regexp_replace(F.lower(text), r"[^\p{L}]+|[\x{10000}-\x{10ffff}]+", " ")
    return F.concat(F.lit(" "), F.trim(letters), F.lit(" "))


def trigrams(text: Column) -> Column:
    """All overlapping trigrams of the normalized text, one pass."""
    return F.regexp_extract_all(normalized(text), F.lit("(?=(...))"), F.lit(1))


def chunks(text: Column) -> Column:
    """The normalized text word by word: the blanks before a word, the word, and two characters more.

    A text's trigrams are exactly those of its chunks, each once: a chunk's trigrams start
    at its blanks and its word's letters, and those reach two characters beyond the word.
    """
    return F.regexp_extract_all(normalized(text), F.lit("(?=( +[^ ]+.{0,2})) +[^ ]+"), F.lit(1))


def chunk_trigrams(chunk: Column) -> Column:
    """All overlapping trigrams of a chunk."""
    return F.regexp_extract_all(chunk, F.lit("(?=(...))"), F.lit(1))


def clean_label(label: Column) -> Column:
    """Language code of a model label."""
    return F.replace(label, F.lit(P.LABEL_PREFIX), F.lit(""))


def train_profile(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Labelled texts -> ``(lang, gram, weight, default_weight)``.

    ``weight`` is what a trigram adds over ``default_weight``, the share of a
    trigram the profile does not list. Words are counted first, so that the texts give
    a row per word and only distinct words are taken apart.
    """
    words = (
        docs.where(F.col(lang_col).isNotNull())
        .select(clean_label(F.col(lang_col)).alias("lang"), F.explode(chunks(F.col(text_col))).alias("chunk"))
        .groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = (
        words.select("lang", F.explode(chunk_trigrams(F.col("chunk"))).alias("gram"), "n")
        .groupBy("lang", "gram").agg(F.sum("n").alias("c"))
    )
    # stored, as three figures come from them: the texts are gone through once
    path = work_path(docs.sparkSession, "gram-counts")
    counts.write.parquet(path)
    counts = docs.sparkSession.read.parquet(path)
    vocabulary = (
        counts.groupBy("gram").agg(F.sum("c").alias("all")).where(F.col("all") > 0)
        .agg(F.count(F.lit(1))).scalar()
    )
    totals = counts.groupBy("lang").agg(F.sum("c").alias("total"))  # one row per language

    def milli(p):
        return F.round(F.log(p) * SCALE).cast("bigint")

    space = F.col("total") + vocabulary
    return (
        counts.join(totals, "lang")
        .select(
            "lang", "gram",
            milli((F.col("c") + 1) / space).alias("weight"),
            milli(F.lit(1.0) / space).alias("default_weight"),
        )
        .withColumn("weight", F.col("weight") - F.col("default_weight"))
    )


def store_profile(profile: DataFrame, path: str) -> DataFrame:
    """Write the model and read it back, so that training runs once."""
    profile.write.mode("overwrite").parquet(path)
    return profile.sparkSession.read.parquet(path)


def profile_languages(profile: DataFrame) -> list[tuple[str, int, int]]:
    """``(code, default_weight, trigrams)`` per language, in code order: the model's label list."""
    rows = (
        profile.groupBy("lang").agg(F.first("default_weight").alias("w"), F.count(F.lit(1)).alias("n"))
        .orderBy("lang").collect()
    )
    return [(r["lang"], r["w"], r["n"]) for r in rows]


def score_languages(df: DataFrame, id_cols: Sequence[str], text_col: str,
                    profile: DataFrame) -> DataFrame:
    """``id_cols`` + ``languages``: ARRAY<STRUCT<code, prob, score>>, best first.

    Texts without a letter have no prediction and no row. ``profile`` is a
    stored table (see :func:`store_profile`).
    """
    labels = profile_languages(profile)
    wide = profile.groupBy("gram").agg(*[
        F.coalesce(F.max(F.when(F.col("lang") == code, F.col("weight"))), F.lit(0)).alias(f"w{i}")
        for i, (code, _, _) in enumerate(labels)
    ])
    grams = df.select(*id_cols, F.explode(trigrams(F.col(text_col))).alias("gram"))
    hits = lookup_join(grams, wide, ["gram"], "left", list(id_cols),
                       max_rows=BROADCAST_BYTES // (64 + 8 * len(labels)),
                       rows=sum(n for _, _, n in labels))
    sums = hits.groupBy(*id_cols).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.sum(f"w{i}"), F.lit(0)).alias(f"s{i}") for i in range(len(labels))],
    )
    scores = F.array(*[
        F.struct(
            F.lit(code).alias("code"),
            (F.col(f"s{i}") + F.col("n") * F.lit(default)).alias("score"),
        )
        for i, (code, default, _) in enumerate(labels)
    ])
    best = F.array_max(F.transform(F.col("scores"), lambda x: x["score"]))
    likelihoods = F.transform(
        F.col("scores"),
        lambda x: F.struct(
            (-x["score"]).alias("cost"), x["code"].alias("code"),
            F.exp((x["score"] - F.col("best")) / SCALE).alias("e"),
        ),
    )
    total = F.aggregate(F.col("ranked"), F.lit(0.0), lambda a, x: a + x["e"])
    return (
        sums.select(*id_cols, scores.alias("scores"))
        .withColumn("best", best)
        .withColumn("ranked", F.array_sort(likelihoods))
        .withColumn("total", total)
        .select(*id_cols, F.transform(
            "ranked",
            lambda x: F.struct(
                x["code"].alias("code"), (x["e"] / F.col("total")).alias("prob"),
                (-x["cost"]).alias("score"),
            ),
        ).alias("languages"))
    )


def predict_language(df: DataFrame, id_cols: Sequence[str], text_col: str,
                     profile: DataFrame) -> DataFrame:
    """``id_cols`` + ``prediction``: STRUCT<code, prob>, the best label of each text."""
    top = F.col("languages")[0]
    return score_languages(df, id_cols, text_col, profile).select(
        *id_cols, F.struct(top["code"].alias("code"), top["prob"].alias("prob")).alias("prediction")
    )


def top_k_languages(df: DataFrame, id_cols: Sequence[str], text_col: str, profile: DataFrame,
                    k: int = 1) -> DataFrame:
    """One row per text and rank: ``id_cols, rank, code, prob``."""
    return (
        score_languages(df, id_cols, text_col, profile)
        .select(*id_cols, F.posexplode(F.slice("languages", 1, k)).alias("pos", "x"))
        .select(*id_cols, (F.col("pos") + 1).alias("rank"), "x.code", "x.prob")
    )


def filter_predicted_language(df: DataFrame, target: str, enabled: bool = True,
                              prediction: str = "prediction") -> DataFrame:
    """Rows whose best label is ``target``; without a prediction a row is dropped.
    Switched off, everything passes."""
    return df.where(F.col(f"{prediction}.code") == target) if enabled else df
