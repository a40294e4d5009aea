"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` written, and evaluated, once.

    A column used in several places of an expression is otherwise copied to
    each of them, and such copies multiply from function to function.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def compute(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated here, once per row.

    The row is put through a one-element generator. Unlike a projection, Spark
    neither copies it into later expressions nor moves a filter on its result
    below it, so a costly column is not computed for rows an earlier join drops.
    """
    built = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(built)))
