"""Whole runs as one plan: landed feeds or pages to judged articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text, urls
from ..functions.expr import is_blank
from ..operators import articles, catalog as catalogs, feeds as feed_ops, filters, pages as page_ops
from ..operators.registry import unseen
from ..operators.skew import join_dimension
from ..params import MIN_PAGE_CHARS, RunParams
from ..session import materialised


def feed_run(
    feeds: DataFrame,
    catalog: DataFrame,
    registry: DataFrame | None,
    params: RunParams,
    pages: DataFrame | None = None,
) -> DataFrame:
    """Articles of a feed run with the reason each rejected one failed.

    The cap comes before every other test. Rows without a URL or title leave
    before the registry join.
    """
    capped = feed_ops.capped_entries(feeds, params.max_per_source)
    candidates = capped.where(~is_blank(F.col("link")) & ~is_blank(F.col("title")))
    candidates = filters.exclude_urls(candidates, params.filters.exclude_patterns, "link")
    keyed = candidates.withColumns({"source": F.col("source_id"), "url": F.col("link")})
    if registry is not None and not params.force_rescrape:
        keyed = unseen(keyed, registry, keep_blank=False)
    sourced = catalogs.attach_source(keyed, catalogs.enabled_sources(catalog).where("method = 'rss'"))
    written = feed_ops.feed_text(sourced)
    if pages is not None:
        # at most max_per_source entries per source are left: several branches read them
        written = feed_ops.enrich_short(materialised(written, "entries"), pages, as_of=params.as_of)
    complete = articles.with_required_fields(feed_ops.entry_fields(written))
    built = articles.project_articles(complete, params.as_of, keep=("fetched_at", "pos"))
    return filters.with_reason(built, params.as_of, params.filters)


def page_run(
    listings: DataFrame,
    pages: DataFrame,
    catalog: DataFrame,
    registry: DataFrame | None,
    params: RunParams,
) -> DataFrame:
    """Articles of a page run with the reason each rejected one failed.

    Seen URLs leave before the cap. ``listings``: source_id, page_id, html;
    ``pages``: page_id, url, html; both may have ``landed_at``, and then later listings
    come first and the newest version of a page at ``as_of`` is read.
    """
    found = discovered(listings, catalog, registry, params)
    chosen = page_ops.cap_pages(found, params.max_per_source).select("source", "url")
    return judged_pages(chosen, pages, catalog, params)


def _page_sources(catalog: DataFrame) -> DataFrame:
    # an id that also has a feed is a feed source
    return catalogs.prefer_feeds(catalogs.enabled_sources(catalog)).where("method = 'html'")


def discovered(listings: DataFrame, catalog: DataFrame, registry: DataFrame | None, params: RunParams) -> DataFrame:
    """URLs that listings name and the registry lacks: source, url, place."""
    known = _page_sources(catalog).select("source_id", "base_url", "name", "method", "default_tags")
    sourced = catalogs.attach_source(page_ops.newest_listings_first(listings, params.as_of), known)
    listed = sourced.select(F.col("source_id").alias("source"), "base_url", "page_id", "html")
    found = page_ops.discover(listed, params.filters.exclude_patterns)
    if registry is not None and not params.force_rescrape:
        found = unseen(found, registry, keep_blank=False)
    return found


def judged_pages(chosen: DataFrame, pages: DataFrame, catalog: DataFrame, params: RunParams) -> DataFrame:
    """Articles of the ``chosen`` URLs (source, url) whose page has landed, with the reason each rejected one failed.

    The chosen side is broadcast when its size allows, and the pages are not shuffled.
    """
    sources = _page_sources(catalog)
    columns = [c for c in ("page_id", "url", "html", "landed_at") if c in pages.columns]
    landed = join_dimension(page_ops.landed_by(pages.select(*columns), params.as_of), chosen, "url", skewed=False)
    single = page_ops.as_landed(landed, ["source", "url"], params.as_of)
    authored = single.withColumn("author", text.page_author(F.col("html")))
    extracted = page_ops.extract_pages(authored)
    named = catalogs.attach_source(
        extracted.withColumnRenamed("source", "source_id"),
        sources.select("source_id", "name", "method", "default_tags"),
    )
    inputs = named.select(
        F.col("source_id").alias("source"),
        F.col("name").alias("source_name"),
        "method",
        "url",
        "title",
        "author",
        "published_date",
        "content_text",
        F.array_sort(F.array_distinct("default_tags")).alias("tags"),
    )
    complete = articles.with_required_fields(inputs, MIN_PAGE_CHARS)
    return filters.with_reason(
        articles.project_articles(complete, params.as_of), params.as_of, params.filters
    )


def unified_run(
    feeds: DataFrame,
    listings: DataFrame,
    pages: DataFrame,
    catalog: DataFrame,
    registry: DataFrame | None,
    params: RunParams,
    page_params: RunParams | None = None,
    enrich: bool = False,
) -> DataFrame:
    """One run over all chosen sources: judged articles of feed and page sources together, for one commit.

    ``catalog`` holds the sources that were chosen (``catalog.select_sources``).
    Page sources may have parameters of their own. With ``enrich`` short feed
    entries take the text of their landed page.
    """
    of_feeds = feed_run(feeds, catalog, registry, params, pages if enrich else None)
    of_pages = page_run(listings, pages, catalog, registry, page_params or params)
    return of_feeds.unionByName(of_pages, allowMissingColumns=True)


def listing_targets(catalog: DataFrame) -> DataFrame:
    """Listing page of each page source, the input of a fetcher."""
    return catalogs.enabled_sources(catalog).where("method = 'html'").select(
        "source_id", urls.listing_url(F.col("base_url"), F.col("blog_path")).alias("url"), "js_rendered"
    )
