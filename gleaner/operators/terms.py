"""Words of texts and queries, and the constants of their scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

K1 = 1.2
B = 0.75
TERM = r"[\pL\pN]+"
DIGITS = 9


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def query_terms(queries: DataFrame) -> DataFrame:
    """Distinct (query_id, term) pairs."""
    return queries.select("query_id", F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
