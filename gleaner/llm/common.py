"""What several operators share: the word pattern, running totals over hot keys, file access in tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    blanks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D]", " ")
    return F.array_remove(F.split(blanks, " "), "")


def unit(*columns: Column, seed: int = 0) -> Column:
    """A hash of the columns as a double in [0, 1), with 53 random bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") / F.lit(float(2**53))


def running_total(
    df: DataFrame,
    key: str,
    line: str,
    value: str,
    out: str,
    ties: Sequence[str] = (),
    rows: DataFrame | None = None,
    few_keys: bool = False,
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same key that come earlier on the line.

    ``line`` is a double in [0, 1) that is spread evenly, as a hash is; rows of
    equal ``line`` follow ``ties``. A key of n rows is cut into sqrt(n) buckets of
    the line, so that neither a bucket nor the table of bucket sums gets more
    than about sqrt(n) rows of it. ``rows`` may bring (key, n_rows), else they are counted.
    Keys must not be null. ``df`` is read twice. ``few_keys`` says that the number
    of keys has a proven small bound; their counts are then sent to every task, and
    rows are first dealt by key and bucket, never by key alone.
    """
    counted = rows if rows is not None else df.groupBy(key).agg(F.count("*").alias("n_rows"))
    counted = F.broadcast(counted) if few_keys else counted
    sized = df.join(counted.select(F.col(key), F.col("n_rows").alias("_n")), key)
    bucketed = sized.withColumn("_bucket", F.floor(F.col(line) * F.ceil(F.sqrt("_n"))).cast("long")).drop("_n")
    sums = bucketed.groupBy(key, "_bucket").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(key, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = (
        Window.partitionBy(key, "_bucket").orderBy(line, *ties).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        bucketed.join(bases, [key, "_bucket"])
        .withColumn(out, (F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("long"))
        .drop("_bucket", "_base")
    )


def file_system(uri: str):
    """(file system, path) of a URI, for reading and writing inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def publish(uri: str, write) -> int:
    """Writes a file under a name of its own and then moves it into place; returns its size.

    A task that runs twice writes the same bytes twice, and a reader never sees a
    part of a file. ``write`` gets the open stream.
    """
    import os
    import uuid

    store, path = file_system(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(draft) as stream:
        write(stream)
        size = stream.tell()
    store.move(draft, path)
    return size
