"""Predicates over check results, and gates."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def condition(rule: str | Column | None | Iterable) -> Column:
    """A Spark SQL predicate, a column, or several that must all hold (our reading of a list); None always holds, NULL does not.

    ``size(check.participants_id) > 0`` says that a list is not empty, as does ``<> array()``.
    """
    if rule is None:
        return F.lit(True)
    if isinstance(rule, str):
        return F.coalesce(F.expr(rule), F.lit(False))
    if isinstance(rule, Column):
        return F.coalesce(rule, F.lit(False))
    return reduce(lambda a, b: a & b, map(condition, rule), F.lit(True))


def gate(context: DataFrame, rule: str | Column | None | Iterable) -> DataFrame:
    """The context if the rule holds for it, else no rows: no row in, no report out."""
    return context.where(condition(rule))


def holds_for_any(rows: DataFrame, rule: str | Column | None = None) -> DataFrame:
    """One row, ``holds``: whether any row fits; for gates on long results of any size."""
    return rows.where(condition(rule)).limit(1).agg((F.count("*") > 0).alias("holds"))
