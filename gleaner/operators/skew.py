"""Joins and caps that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_BROADCAST_BYTES = 64 << 20
SALTS = 64


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure a table that is meant to be small: one pass, one number back."""
    size = df.select(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()
    return (size["b"] or 0) <= max_bytes


def row_hash(df: DataFrame) -> Column:
    """Hash over all columns that can be hashed; the same on every retry."""
    usable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{c}`") for c in usable])


def join_dimension(
    df: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
    skewed: bool = True,
) -> DataFrame:
    """Attach a small table; ``how`` is inner, left, left_semi or left_anti.

    The size of ``dim`` is measured. Below the bound it is broadcast. Above it,
    ``dim`` is replicated once per salt and ``df`` salted, so that a key with a
    third of all rows is spread over many tasks. With ``skewed=False`` (a key
    that is close to unique in ``df``) it is a plain shuffled join instead.
    """
    if fits_broadcast(dim, max_bytes):
        return df.join(F.broadcast(dim), on, how)
    if not skewed:
        return df.join(dim, on, how)
    keys = [on] if isinstance(on, str) else list(on)
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")
    salted = df.withColumn("_salt", F.pmod(row_hash(df), F.lit(SALTS)))
    spread = dim.withColumn("_salt", F.explode(salts))
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


def _ranked(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def first_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None
) -> DataFrame:
    """First ``n`` rows of each group, optionally with their rank.

    Spark cuts each map partition to the first ``n`` before the shuffle
    (``WindowGroupLimit``, up to rank 1000). A hot group still sends n rows per
    map task to one place, so for n above 1 a round over parts of each group
    comes first: the first ``n`` of a group are among the first ``n`` of its
    parts. For n = 1 that leaves one row per map task, and a second shuffle of
    mostly unique keys would cost more than it saves.
    """
    if n > 1:
        # parts follow the map task, which is the same when a task is retried
        parts = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        df = _ranked(parts, [*keys, "_part"], order, n, "_rank").drop("_part", "_rank")
    kept = _ranked(df, keys, order, n, rank or "_rank")
    return kept if rank else kept.drop("_rank")
