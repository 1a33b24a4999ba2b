"""Source catalog: one small row per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .skew import first_per_group, join_dimension


def with_defaults(catalog: DataFrame) -> DataFrame:
    """Fill the optional fields of a catalog."""
    return catalog.withColumns(
        {
            "enabled": F.coalesce("enabled", F.lit(True)),
            "default_tags": F.coalesce("default_tags", F.array().cast("array<string>")),
            "blog_path": F.when(
                F.col("method") == "html", F.coalesce("blog_path", F.lit("/blog"))
            ),
            "js_rendered": F.coalesce("js_rendered", F.lit(False)),
        }
    )


def enabled_sources(catalog: DataFrame) -> DataFrame:
    return catalog.where(F.coalesce("enabled", F.lit(True)))


def all_sources(rss: DataFrame, html: DataFrame) -> DataFrame:
    """Feeds and pages in one table, tagged with their method."""
    tagged_rss = rss.withColumn("method", F.lit("rss"))
    tagged_html = html.withColumn("method", F.lit("html"))
    both = tagged_rss.unionByName(tagged_html, allowMissingColumns=True)
    return both.withColumn("enabled", F.lit(True))


def prefer_feeds(catalog: DataFrame) -> DataFrame:
    """One row per source id; the feed wins over the page entry."""
    feed_first = F.when(F.col("method") == "rss", 0).otherwise(1)
    return first_per_group(catalog, ["source_id"], [feed_first], 1)


def select_sources(
    catalog: DataFrame,
    source: str | None = None,
    rss_only: bool = False,
    html_only: bool = False,
) -> DataFrame:
    """One source, else feeds only, else pages only, else all; unknown ids fail."""
    if source is not None:
        chosen = catalog.where(F.col("source_id") == source)
        if chosen.isEmpty():
            raise ValueError(f"unknown source: {source}")
        return chosen
    if rss_only:
        return catalog.where(F.col("method") == "rss")
    if html_only:
        return catalog.where(F.col("method") == "html")
    return catalog


def attach_source(df: DataFrame, catalog: DataFrame, key: str = "source_id") -> DataFrame:
    """Add the catalog columns to each row; rows of unknown sources are dropped."""
    dim = prefer_feeds(catalog)
    if key != "source_id":
        dim = dim.withColumnRenamed("source_id", key)
    return join_dimension(df, dim, key)


def scrape_method(method: Column) -> Column:
    return F.when(method == "rss", F.lit("rss")).otherwise(F.lit("html"))
