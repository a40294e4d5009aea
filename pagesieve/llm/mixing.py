"""Mixing sources to target weights by hierarchical budgeting.

A tree of domain, language and source has a weight at every node. A token budget
is handed down: children of a node share its budget by weight. No child can take
more than its leaves hold in the allowed number of epochs; what it cannot take is
shared among its siblings by weight, and only when all of them are full does the
parent fall short, which its own siblings then make up for. With the capacities
summed up the tree first, one way down does this: at each level the children are
ordered by capacity per weight, and running sums tell from which child on nobody
is full.

A leaf's stream is its documents in seeded random order, a new order for every
epoch, one epoch after the other. The leaf gives the shortest prefix of that
stream that holds its budget, in whole documents. So an epoch is taken in full,
or up to a place in its order. That place is found without sorting a leaf: tokens
are summed by slices of the order, the slice that holds the place is looked into,
and the document there becomes a threshold. A document is then taken or not by a
comparison in its own row.

Cases: null or missing language, source or domain are a branch named ``unknown``.
Null text has no token and costs nothing. Documents with equal ids have one place
in every order and are taken together; null ids are one such id. Weights are
integers; a name without a weight has the default one; weight 0 takes nothing.
Empty table: no rows. Columns starting with ``mx_`` are the operator's own, others
are kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bind import compute
from ..operators.skew import salted_join
from ..session import work_path
from . import textnative as T

LEVELS = ("mx_domain", "mx_lang", "mx_source")
SLICES = 1024
ORDER_BITS = 60
BROADCAST_LEAVES = 100_000


@dataclass(frozen=True)
class Mix:
    """``weights`` by level (domain, language, source), then by name; ``budget_percent`` of all tokens."""

    weights: Sequence[Mapping[str, int]] = field(default_factory=lambda: ({}, {}, {}))
    default_weights: Sequence[int] = (100, 100, 100)
    budget_percent: int = 60
    max_epochs: int = 2
    seed: int = 1


def _named(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("unknown"))


def order_key(seed: int, epoch: Column, id_col: Column) -> Column:
    """A document's place in the order of an epoch: 60 bits of a hash."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, ORDER_BITS // 4), 16, 10).cast("bigint")


def slice_of(key: Column) -> Column:
    return F.shiftright(key, ORDER_BITS - SLICES.bit_length() + 1)


def _weight(level: Column, names: Mapping[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, weight in sorted(names.items()):
        out = F.when(level == name, weight).otherwise(out)
    return out.cast("bigint")


def share_out(nodes: DataFrame, parents: Sequence[str], name: str, given: str, out: str) -> DataFrame:
    """Share ``given`` (one value per parent) among its children by ``weight``, none above ``capacity``.

    Children in order of capacity per weight: one is full if, with all before it
    full, its share of the rest reaches its capacity. From the first that is not
    full on, all get the same budget per weight. Children without weight get nothing.
    """
    order = Window.partitionBy(*parents).orderBy(F.col("capacity") / F.col("weight"), name)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    rest = F.col(given) - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    weighted = nodes.where(F.col("weight") > 0).withColumns({
        "ratio": F.col("capacity") / F.col("weight"), "rest": rest, "heavy": F.sum("weight").over(after)})
    full = F.col("rest") * F.col("weight") >= F.col("capacity") * F.col("heavy")
    first = F.min(F.when(~full, F.struct("ratio", F.col(name).alias("name"), "rest", "heavy"))).over(
        Window.partitionBy(*parents))
    share = F.when(F.col("first").isNull() | (F.col("ratio") < F.col("first.ratio")), F.col("capacity")).otherwise(
        F.expr("first.rest * weight div first.heavy"))
    return weighted.withColumn("first", first).withColumn(
        out, F.least(share, F.col("capacity")).cast("bigint")).drop("first", "ratio", "rest", "heavy")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``(levels, tokens)`` per leaf -> the same with ``budget``."""
    sized = leaves.withColumn("leaf_capacity", F.col("tokens") * mix.max_epochs)
    parents: list[str] = []
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budget = total * mix.budget_percent // 100
    table = None
    for depth, level in enumerate(LEVELS):
        nodes = sized.groupBy(*parents, level).agg(F.sum("leaf_capacity").alias("capacity")).withColumn(
            "weight", _weight(F.col(level), mix.weights[depth], mix.default_weights[depth]))
        if parents:
            nodes = nodes.join(table, parents)
        else:
            nodes = nodes.withColumn("given0", F.lit(budget).cast("bigint"))
        table = share_out(nodes, parents, level, f"given{depth}", f"given{depth + 1}").select(
            *parents, level, f"given{depth + 1}")
        parents = [*parents, level]
    return leaves.join(table.withColumnRenamed(f"given{len(LEVELS)}", "budget"), list(LEVELS), "left").withColumn(
        "budget", F.coalesce(F.col("budget"), F.lit(0)))


def with_leaf(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, domain: Column) -> DataFrame:
    return compute(docs, {"mx_tokens": T.word_count(F.col(text_col))}).withColumns({
        "mx_domain": _named(domain), "mx_lang": _named(F.col(lang_col)), "mx_source": _named(F.col(source_col))})


def _leaf_join(rows: DataFrame, leaves: DataFrame, n_leaves: int, spread: Sequence[str]) -> DataFrame:
    """Few leaves are broadcast, whatever their share of the rows; many are joined with salt."""
    if n_leaves <= BROADCAST_LEAVES:
        return rows.join(F.broadcast(leaves), list(LEVELS))
    return salted_join(rows, leaves, list(LEVELS), "inner", spread)


def thresholds(slim: DataFrame, mix: Mix, id_col: str) -> DataFrame:
    """``slim``: a stored table of id, leaf and tokens. Per leaf: ``mx_full`` epochs are
    taken whole, of the next one the documents whose order key is at most ``mx_last`` (null: none)."""
    spark = slim.sparkSession
    root = work_path(spark, "mixing")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("mx_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, mix).withColumns({
        "mx_full": F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int")}
    ).withColumn("mx_rest", F.col("budget") - F.col("mx_full") * F.col("tokens"))
    budgets.write.parquet(f"{root}/budgets")
    budgets = spark.read.parquet(f"{root}/budgets")
    n_leaves = budgets.count()
    partial = budgets.where("mx_rest > 0").select(*LEVELS, "mx_full", "mx_rest")
    keyed = _leaf_join(slim.where("mx_tokens > 0"), partial, n_leaves, [id_col]).withColumn(
        "key", order_key(mix.seed, F.col("mx_full"), F.col(id_col))).withColumn("slice", slice_of(F.col("key")))
    sums = keyed.groupBy(*LEVELS, "slice").agg(
        F.sum("mx_tokens").alias("in_slice"), F.first("mx_rest").alias("mx_rest"))
    order = Window.partitionBy(*LEVELS).orderBy("slice")
    ends = sums.withColumn("before", F.sum("in_slice").over(order) - F.col("in_slice")).where(
        (F.col("before") < F.col("mx_rest")) & (F.col("before") + F.col("in_slice") >= F.col("mx_rest")))
    ends = ends.select(*LEVELS, "slice", "before")  # one slice per leaf
    inside = _leaf_join(keyed, ends.withColumnRenamed("slice", "end_slice"), n_leaves, [id_col]).where(
        F.col("slice") == F.col("end_slice"))
    # equal ids share a place: add them up first
    by_key = inside.groupBy(*LEVELS, "key").agg(
        F.sum("mx_tokens").alias("n"), F.first("before").alias("before"), F.first("mx_rest").alias("mx_rest"))
    running = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("key")) - F.col("n") + F.col("before")
    last = by_key.withColumn("start", running).where(F.col("start") < F.col("mx_rest")).groupBy(*LEVELS).agg(
        F.max("key").alias("mx_last"))
    out = budgets.join(last, list(LEVELS), "left").select(*LEVELS, "mx_full", "mx_last", "budget", "tokens")
    out.write.parquet(f"{root}/thresholds")
    return spark.read.parquet(f"{root}/thresholds")


def mix_sources(docs: DataFrame, domain: Column, mix: Mix, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The mixture: a row of ``docs`` per epoch that takes it, with ``mx_epoch``, tokens and leaf."""
    rows = with_leaf(docs, id_col, text_col, lang_col, source_col, domain)
    path = work_path(docs.sparkSession, "mixing-slim")
    rows.select(F.col(id_col).alias("mx_id"), *LEVELS, "mx_tokens").write.parquet(path)
    limits = thresholds(docs.sparkSession.read.parquet(path), mix, "mx_id")
    taken = _leaf_join(rows, limits.drop("budget", "tokens"), limits.count(), [id_col]).withColumn(
        "mx_key", order_key(mix.seed, F.col("mx_full"), F.col(id_col)))
    # documents without tokens are taken where their whole leaf or their place is
    epochs = F.col("mx_full") + F.when(F.col("mx_key") <= F.col("mx_last"), 1).otherwise(0)
    return taken.withColumn("mx_epochs", epochs).where("mx_epochs > 0").withColumn(
        "mx_epoch", F.explode(F.sequence(F.lit(0), F.col("mx_epochs") - 1))).drop(
        "mx_full", "mx_last", "mx_key", "mx_epochs")
