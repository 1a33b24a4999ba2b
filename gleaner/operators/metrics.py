"""Run counters and reports over a run log: source, kind, n, url, error, ts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KINDS = ("scraped", "uploaded", "skipped")


def _total(kind: str):
    counted = F.sum(F.when(F.col("kind") == kind, F.col("n")))
    return F.coalesce(counted, F.lit(0)).cast("long").alias(kind)


def source_counters(log: DataFrame) -> DataFrame:
    """Scraped, uploaded and skipped per source, errors counted as rows."""
    return log.groupBy("source").agg(
        *[_total(k) for k in KINDS], F.count_if(F.col("kind") == "error").alias("errors")
    )


def merge_counters(scraped: DataFrame, uploaded: DataFrame, skipped: DataFrame) -> DataFrame:
    """Three (source, n) tables side by side; missing counts are 0. One shuffle."""
    tagged = [
        t.select("source", "n", F.lit(k).alias("kind"))
        for t, k in zip((scraped, uploaded, skipped), KINDS, strict=True)
    ]
    rows = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return rows.groupBy("source").agg(*[_total(k) for k in KINDS])


def run_totals(log: DataFrame) -> DataFrame:
    """One row: start, end, duration and the sum of each counter."""
    start, end = F.min("ts"), F.max("ts")
    seconds = (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6
    return log.agg(
        start.alias("start_time"),
        end.alias("end_time"),
        seconds.alias("duration_seconds"),
        *[_total(k).alias(f"total_{k}") for k in KINDS],
        F.count_if(F.col("kind") == "error").alias("total_errors"),
    )


def first_errors(log: DataFrame, n: int = 10, tie: str = "url") -> DataFrame:
    """First ``n`` errors in order of occurrence, long fields cut for display."""
    errors = log.where(F.col("kind") == "error").orderBy("ts", tie).limit(n)
    return errors.select(
        "source",
        "ts",
        F.substring("url", 1, 50).alias("url"),
        F.substring("error", 1, 100).alias("error"),
    )


def reason_counts(judged: DataFrame) -> DataFrame:
    """Rows per source and rejection reason; accepted rows count as ``accepted``."""
    reason = F.coalesce("reason", F.lit("accepted"))
    return judged.groupBy("source", reason.alias("reason")).agg(F.count("*").alias("n"))


def run_report(log: DataFrame) -> DataFrame:
    """Report rows (section, source, kind, value): totals and per-source counts.

    A long table instead of one nested record, so that it grows with the number
    of sources without being gathered into one row.
    """
    per_source = source_counters(log).unpivot(
        ["source"], [*KINDS, "errors"], "kind", "value"
    )
    totals = per_source.groupBy("kind").agg(F.sum("value").alias("value"))
    return totals.select(
        F.lit("total").alias("section"), F.lit(None).cast("string").alias("source"), "kind", "value"
    ).unionByName(per_source.select(F.lit("by_source").alias("section"), "source", "kind", "value"))
