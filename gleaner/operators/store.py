"""Article store and manifest.

Runs append; the newest version of an id wins when the table is read. A run
never rewrites what another run wrote, and a repeated run replaces only its own
partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import MANIFEST_COLUMNS
from .skew import first_per_group


def latest(df: DataFrame, key: str = "id", order: list[Column] | None = None) -> DataFrame:
    """Newest version of each key, by ``run_seq`` unless another order is given.

    Rank 1 is cut in each map partition first, so copies of a hot key do not
    travel and whole rows are shuffled at most once.
    """
    return first_per_group(df, [key], order or [F.desc("run_seq")], 1)


def manifest_rows(articles: DataFrame, run_seq: int | None = None) -> DataFrame:
    """Light rows of articles: the text columns are never read."""
    rows = articles.select(*MANIFEST_COLUMNS)
    return rows if run_seq is None else rows.withColumn("run_seq", F.lit(run_seq).cast("long"))


def manifest_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """New ids are inserted, known ids replaced as a whole."""
    return latest(old.unionByName(new))


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Articles and last update per source.

    Ids are made distinct first, so the count is a plain sum with map-side
    combining even when one source holds most ids.
    """
    per_id = manifest.groupBy("source", "id").agg(F.max("scraped_at").alias("at"))
    return per_id.groupBy("source").agg(
        F.count("*").alias("total_articles"), F.max("at").alias("last_updated")
    )


def list_articles(manifest: DataFrame, source: str | None = None) -> DataFrame:
    rows = manifest.select(*MANIFEST_COLUMNS)
    return rows if source is None else rows.where(F.col("source") == source)


def listed_sources(manifest: DataFrame, articles: DataFrame) -> DataFrame:
    """Manifest rows of sources that have stored articles."""
    stored = articles.select("source").distinct()
    return manifest.join(stored, "source", "left_semi")


def load_article(articles: DataFrame, source: str, id_: str) -> DataFrame:
    """Point lookup: prunes to one source partition."""
    return articles.where((F.col("source") == source) & (F.col("id") == id_))


def export_articles(articles: DataFrame, source: str | None = None) -> DataFrame:
    return articles if source is None else articles.where(F.col("source") == source)


def without_source(df: DataFrame, source: str) -> DataFrame:
    return df.where(F.col("source") != source)


def clear_counts(articles: DataFrame, source: str) -> DataFrame:
    """Articles that clearing a source removes, and those that stay."""
    gone = F.col("source") == source
    return articles.agg(
        F.count_if(gone).alias("removed"), F.count_if(~gone).alias("remaining")
    )


def html_snapshots(articles: DataFrame, newest_by: list[str] | None = None) -> DataFrame:
    """Rows with a snapshot: source, id, content_html; of several with an id the one with the highest ``newest_by``."""
    rows = articles.where(F.col("content_html") != "")
    if newest_by:
        rows = latest(rows, "id", [F.desc(c) for c in newest_by])
    return rows.select("source", "id", "content_html")
