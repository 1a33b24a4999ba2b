"""Helpers that keep a costly expression from being evaluated twice."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` where ``value`` is evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Like ``withColumns``, but later filters read the computed values.

    A filter over ``withColumn`` output is pushed below the projection with its
    expression copied into it, so a regular expression over the whole text runs
    once per use. A one-row ``inline`` stops that; filters that only touch the
    input columns still move down to the scan.
    """
    names = set(columns)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*kept, F.inline(F.array(packed)))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def is_blank(c: Column) -> Column:
    return F.coalesce(c == "", F.lit(True))


def any_of(tests: list[Column]) -> Column:
    return reduce(or_, tests) if tests else F.lit(False)
