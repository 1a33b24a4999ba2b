"""Schemas of the stored tables."""

from __future__ import annotations

ARTICLE_COLUMNS = (
    "id",
    "source",
    "source_name",
    "url",
    "title",
    "author",
    "published_date",
    "scraped_at",
    "content_text",
    "summary",
    "tags",
    "word_count",
    "metadata",
)

ARTICLE = """
    id STRING, source STRING, source_name STRING, url STRING, title STRING,
    author STRING, published_date STRING, scraped_at TIMESTAMP,
    content_text STRING, summary STRING, tags ARRAY<STRING>, word_count INT,
    metadata STRUCT<reading_time_minutes: INT, scrape_method: STRING>
"""

CATALOG = """
    source_id STRING, method STRING, name STRING, rss_url STRING,
    base_url STRING, blog_path STRING, default_tags ARRAY<STRING>,
    js_rendered BOOLEAN, enabled BOOLEAN, priority INT
"""

FEEDS_RAW = "source_id STRING, fetched_at TIMESTAMP, xml STRING"

PAGES = "page_id BIGINT, url STRING, html STRING"

PAGES_LANDED = "page_id BIGINT, url STRING, html STRING, landed_at TIMESTAMP"

LISTINGS = "source_id STRING, page_id BIGINT, html STRING, landed_at TIMESTAMP"

REGISTRY = "source STRING, url STRING"

MANIFEST = """
    source STRING, id STRING, url STRING, title STRING,
    published_date STRING, scraped_at TIMESTAMP
"""

MANIFEST_COLUMNS = ("source", "id", "url", "title", "published_date", "scraped_at")

DOCUMENT = "id STRING, source STRING, filename STRING, body STRING, metadata MAP<STRING,STRING>"

SNAPSHOT = "source STRING, id STRING, content_html STRING"

DELIVERY = """
    source STRING, article_id STRING, url STRING, filename STRING, document_id STRING, error STRING, sent_seq BIGINT
"""

RUN_COUNT = "source STRING, reason STRING, n BIGINT"
