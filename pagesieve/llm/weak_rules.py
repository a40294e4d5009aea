"""Quality by weak supervision: rules vote or abstain, their accuracies are estimated, a posterior decides.

Every rule looks at a whole text and votes +1 (good), -1 (bad) or 0 (abstains).
No label is used. How often a vote of a rule agrees with the unknown quality is
estimated by expectation-maximisation over the vote patterns of all documents
(Dawid and Skene 1979): with R rules there are at most 3^R patterns, so the
documents are counted by pattern once, by Spark, and the iterations run on those
counts. The posterior of a document is then an expression of its votes.

Everything is built-in functions over a row; nothing is exploded or shuffled but
the pattern counts.

Cases: null text has no word, fails the base rules and is rejected. An empty
table leaves the starting chances in place. Very long texts cost n log n.
Repeated rows get equal rows. Null ids pass through. The operator adds columns
starting with ``q_`` only; other columns are kept as they are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bind import compute, let
from ..session import work_path
from . import textnative as T

WINDOW = 5
SYMBOLS = "#*$%&|<>"


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words lie in a window of ``width`` words that the text holds twice or more, the first included.

    Windows are hashed. Only where hashes repeat are they sorted together with
    their places; equal neighbours are the repeated windows, and the words they
    cover are counted from gap to gap.
    """

    def hashed(w: Column) -> Column:
        n = F.size(w) - (width - 1)
        windows = F.arrays_zip(*[F.slice(w, k + 1, n).alias(f"w{k}") for k in range(width)])
        return F.transform(windows, lambda x: F.xxhash64(x))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeats(s: Column) -> Column:
            def equal(i: Column, j: Column) -> Column:
                return F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))

            places = F.sequence(F.lit(0), F.size(s) - 1)
            twice = F.filter(places, lambda i: equal(i, i - 1) | equal(i, i + 1))
            return F.sort_array(F.transform(twice, lambda i: F.get(s, i)["i"]))

        def length(p: Column) -> Column:
            reach = F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(width)), F.lit(width)))
            return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

        return let(placed, lambda s: let(repeats(s), length))

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))

    return F.when(F.size(words) <= width, F.lit(0)).otherwise(let(hashed(words), counted))


def measures(text: Column) -> dict[str, Column]:
    """What the rules look at, by name."""
    known = F.coalesce(text, F.lit(""))

    def count(pattern: str) -> Column:
        return F.regexp_count(known, F.lit(pattern)).cast("bigint")

    return {
        "q_words": let(T.words(text), lambda w: F.struct(
            F.size(w).cast("bigint").alias("n"), repeated_words(w).cast("bigint").alias("repeated"))),
        "q_lines": let(T.lines_with_words(text), lambda x: F.struct(
            F.size(x).cast("bigint").alias("n"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("repeated"))),
        "q_word_chars": F.length(T.without(known, T.BLANKS)).cast("bigint"),
        "q_n_symbols": count(f"[{SYMBOLS}]"),
        "q_n_upper": count(r"\p{Lu}"),
        "q_n_shouts": count("!"),
        "q_n_stops": count("[.?!]"),
    }


@dataclass(frozen=True)
class Rule:
    """Votes -1 where ``bad`` holds, +1 where ``good`` does, else 0. A ``defect`` rule hardly
    ever fires on a good text; where it is silent that says little."""

    name: str
    bad: str
    good: str = "false"
    defect: bool = True


# Conditions on the measures; shares are per 100 words or per 100 signs of words.
RULES = (
    Rule("symbols", bad="100 * q_n_symbols > 20 * q_n_words"),
    Rule("shouting", bad="100 * q_n_upper > 40 * q_word_chars or 100 * q_n_shouts > 15 * q_n_words"),
    Rule("repetition", bad="100 * q_n_repeat_words > 20 * q_n_words or 100 * q_n_dup_lines > 50 * q_n_lines"),
    Rule("odd_words", bad="q_word_chars > 14 * q_n_words or 10 * q_word_chars < 25 * q_n_words"),
    Rule("length", bad="q_n_words < 10", good="q_n_words >= 25", defect=False),
    Rule("sentences", bad="q_n_words >= 25 and 200 * q_n_stops < q_n_words",
         good="100 * q_n_stops between 2 * q_n_words and 50 * q_n_words", defect=False),
    Rule("plain_prose", bad="false",
         good="100 * q_n_symbols < q_n_words and 100 * q_n_upper < 25 * q_word_chars", defect=False),
)


def vote(rule: Rule) -> Column:
    return F.when(F.expr(rule.bad), -1).when(F.expr(rule.good), 1).otherwise(0)


def measured(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with the measures and one vote per rule, each evaluated once."""
    rows = compute(docs, measures(F.col(text_col)))
    rows = rows.select("*", F.col("q_words.n").alias("q_n_words"), F.col("q_words.repeated").alias("q_n_repeat_words"),
                       F.col("q_lines.n").alias("q_n_lines"), F.col("q_lines.repeated").alias("q_n_dup_lines"))
    return rows.select("*", F.array(*[vote(r) for r in rules]).alias("q_votes"))


@dataclass(frozen=True)
class Estimate:
    """Share of good documents, and by rule and class the chance of each vote (-1, 0, 1)."""

    prior: float
    chances: tuple[tuple[tuple[float, float, float], tuple[float, float, float]], ...]


def start(rules: Sequence[Rule]) -> Estimate:
    """Where the estimation begins: nine of ten documents are good, defect rules rarely
    fire and then are right, the others mostly say good of good ones."""
    defect = ((0.3, 0.68, 0.02), (0.002, 0.978, 0.02))
    merit = ((0.1, 0.5, 0.4), (0.01, 0.14, 0.85))
    return Estimate(0.9, tuple(defect if r.defect else merit for r in rules))


def log_odds(estimate: Estimate, votes: Sequence[int]) -> float:
    total = math.log(estimate.prior / (1 - estimate.prior))
    for (bad, good), v in zip(estimate.chances, votes, strict=True):
        total += math.log(good[v + 1] / bad[v + 1])
    return total


def maximise(patterns: Sequence[tuple[Sequence[int], int]], rules: Sequence[Rule], rounds: int = 200,
             anchor: float = 0.02) -> Estimate:
    """Expectation-maximisation over ``(votes, number of documents)``.

    The starting chances count as ``anchor`` times as many documents in each class, which
    keeps the classes from changing their meaning.
    """
    first = found = start(rules)
    weight = 1 + anchor * sum(n for _, n in patterns)
    for _ in range(rounds):
        mass = [weight * (1 - first.prior), weight * first.prior]
        seen = [[[weight * x for x in side] for side in rule] for rule in first.chances]
        for votes, n in patterns:
            good = 1 / (1 + math.exp(-max(-500.0, min(500.0, log_odds(found, votes)))))
            for side, share in ((0, 1 - good), (1, good)):
                mass[side] += n * share
                for k, v in enumerate(votes):
                    seen[k][side][v + 1] += n * share
        prior = mass[1] / (mass[0] + mass[1])
        chances = tuple(tuple(tuple(x / sum(side) for x in side) for side in rule) for rule in seen)
        moved = abs(prior - found.prior)
        found = Estimate(prior, chances)
        if moved < 1e-9:
            break
    return found


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES) -> Estimate:
    """From rows with ``q_votes``: one count per pattern, at most 3^R rows."""
    rows = docs.groupBy("q_votes").count().collect()
    return maximise(sorted((tuple(r["q_votes"]), r["count"]) for r in rows), rules)


def posterior(found: Estimate, rules: Sequence[Rule] = RULES) -> Column:
    """Probability that a document is good, from its votes."""
    odds = F.lit(math.log(found.prior / (1 - found.prior)))
    for k, (bad, good) in enumerate(found.chances):
        v = F.col("q_votes")[k]
        parts = [math.log(g / b) for g, b in zip(good, bad, strict=True)]
        odds = odds + F.when(v == -1, parts[0]).when(v == 1, parts[2]).otherwise(parts[1])
    return 1 / (1 + F.exp(-odds))


def base_failed() -> Column:
    """Fails outright, whatever the votes: hardly a word, or a fifth of them repeated."""
    return (F.col("q_n_words") < 10) | (100 * F.col("q_n_repeat_words") > 20 * F.col("q_n_words"))


def judge(docs: DataFrame, text_col: str = "text", least: float = 0.5, rules: Sequence[Rule] = RULES,
          keep: Sequence[str] | None = None) -> DataFrame:
    """All rows with the measures, ``q_posterior``, ``q_base_failed`` and ``q_kept``.

    Texts are gone through once: the measures, with the columns to ``keep`` (all by
    default), are stored in the shared folder, and patterns are counted from there.
    """
    rows = measured(docs, text_col, rules).drop("q_words", "q_lines")
    if keep is not None:
        rows = rows.select(*keep, *[c for c in rows.columns if c.startswith("q_")])
    path = work_path(docs.sparkSession, "quality")
    rows.write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    found = estimate(rows, rules)
    rows = rows.withColumn("q_posterior", posterior(found, rules)).withColumn("q_base_failed", base_failed())
    return rows.withColumn("q_kept", ~F.col("q_base_failed") & (F.col("q_posterior") >= least))
