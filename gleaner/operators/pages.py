"""Landed pages to links and articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import dates, text, urls
from ..functions.expr import with_computed
from ..params import EXCLUDE_PATTERNS, MAX_PER_SOURCE
from .skew import first_per_group


def page_links(listings: DataFrame) -> DataFrame:
    """Every link of a listing page in document order, ``pos`` from 0."""
    keep = [c for c in listings.columns if c != "html"]
    return listings.select(*keep, F.posexplode(urls.hrefs(F.col("html"))).alias("pos", "href"))


def skip_links(links: DataFrame, exclude_patterns=EXCLUDE_PATTERNS) -> DataFrame:
    """Drop links whose raw href looks like navigation or a file."""
    return links.where(~urls.is_skipped_link(F.col("href"), exclude_patterns))


def resolve_links(links: DataFrame) -> DataFrame:
    """Absolute URL of each link; links of other kinds are dropped."""
    resolved = links.withColumn("url", urls.resolve(F.col("href"), F.col("base_url")))
    return resolved.where(F.col("url").isNotNull())


def same_site(links: DataFrame) -> DataFrame:
    return links.where(urls.is_article_link(F.col("url"), F.col("base_url")))


def dedup_links(links: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """First position of each URL: a map-side combined minimum, no window."""
    return links.groupBy(*keys).agg(F.min(order).alias(order))


def discover(listings: DataFrame, exclude_patterns=EXCLUDE_PATTERNS) -> DataFrame:
    """Candidate article URLs of each source, in page order.

    Expects source, base_url, page_id and html.
    """
    links = same_site(resolve_links(skip_links(page_links(listings), exclude_patterns)))
    # one number keeps the minimum a hash aggregate; a struct would be sorted
    place = F.col("page_id").cast("decimal(19,0)") * F.lit(1 << 32) + F.col("pos")
    return dedup_links(links.withColumn("place", place), ["source", "url"], "place")


def cap_pages(candidates: DataFrame, n: int = MAX_PER_SOURCE, order: str = "place") -> DataFrame:
    """First ``n`` URLs per source, after seen ones were removed."""
    return first_per_group(candidates, ["source"], [F.col(order)], n)


def landed_by(rows: DataFrame, as_of: str | None) -> DataFrame:
    """Rows that had landed at an instant; rows without a ``landed_at`` always had."""
    if "landed_at" not in rows.columns or as_of is None:
        return rows
    return rows.where(F.col("landed_at").isNull() | (F.col("landed_at") <= F.lit(as_of).cast("timestamp")))


def as_landed(rows: DataFrame, keys: list[str], as_of: str | None = None) -> DataFrame:
    """The version of each key that was the newest at ``as_of``, so that a repeated old run reads what it read then.

    Tables without ``landed_at`` hold one version of a page; of repeated rows the smallest page_id stays.
    """
    if "landed_at" not in rows.columns:
        return first_per_group(rows, keys, [F.col("page_id")], 1)
    return first_per_group(landed_by(rows, as_of), keys, [F.desc_nulls_last("landed_at"), F.desc("page_id")], 1)


def newest_listings_first(listings: DataFrame, as_of: str | None = None) -> DataFrame:
    """Listings that had landed, with a ``page_id`` that puts the links of later ones first."""
    if "landed_at" not in listings.columns:
        return listings
    age = F.coalesce(-F.unix_micros("landed_at"), F.lit(0))
    return landed_by(listings, as_of).withColumn("page_id", age).drop("landed_at")


def extract_pages(pages: DataFrame) -> DataFrame:
    """Add content_text, title and published_date; the html column is dropped."""
    html, url = F.col("html"), F.col("url")
    # the text and the title are tested next, so they are held; the date is not
    dated = pages.withColumn("published_date", dates.page_date(html, url))
    held = with_computed(dated, content_text=text.main_text(html), title=text.page_title(html))
    return held.drop("html")
