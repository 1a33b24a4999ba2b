"""Fields of articles and rendered documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..params import (
    RETRY_BASE_SECONDS,
    RETRY_FACTOR,
    RETRY_MAX_SECONDS,
)
from .dates import local_day
from .expr import blank_to_null


def article_id(source: Column, url: Column) -> Column:
    return F.concat(source, F.lit("_"), F.substring(F.md5(url), 1, 12))


def chosen_html(content: Column, summary: Column, description: Column) -> Column:
    """Markup of the first field that is present.

    A content list counts as present even when its first value is empty.
    """
    return (
        F.when(F.size(content) > 0, F.coalesce(F.element_at(content, 1)["value"], F.lit("")))
        .when(blank_to_null(summary).isNotNull(), summary)
        .otherwise(F.coalesce(description, F.lit("")))
    )


def chosen_author(author: Column, authors: Column, source_name: Column) -> Column:
    """Author, else the first three names, else the source name."""
    names = F.transform(F.slice(authors, 1, 3), lambda a: F.coalesce(a["name"], F.lit("")))
    return F.coalesce(blank_to_null(author), blank_to_null(F.array_join(names, ", ")), source_name)


def merged_tags(default_tags: Column, terms: Column, strip) -> Column:
    """Default tags plus the lower-cased stripped terms, distinct and sorted."""
    cleaned = F.transform(F.filter(terms, lambda t: t != ""), lambda t: strip(F.lower(t)))
    empty = F.array().cast("array<string>")
    both = F.concat(F.coalesce(default_tags, empty), F.coalesce(cleaned, empty))
    return F.array_sort(F.array_distinct(both))


def document_body(a=F.col) -> Column:
    """Text document of an article; ``a`` maps a field name to its column."""
    day = local_day(a("published_date"))
    dated = F.when(day != "", F.concat(F.lit(" | "), day)).otherwise(F.lit(""))
    tags = F.array_join(a("tags"), ", ")
    has_tags = F.size(a("tags")) > 0
    has_summary = blank_to_null(a("summary")).isNotNull()
    lines = F.array(
        F.concat(F.lit("# "), a("title"), dated),
        F.lit(""),
        F.lit("## Metadata"),
        F.concat(F.lit("- Source: "), a("source_name")),
        F.concat(F.lit("- URL: "), a("url")),
        F.concat(F.lit("- Author: "), a("author")),
        F.when(has_tags, F.concat(F.lit("- Tags: "), tags)),
        F.concat(F.lit("- Word Count: "), a("word_count").cast("string")),
        F.lit(""),
        F.when(has_summary, F.concat(F.lit("## Summary\n"), a("summary"), F.lit("\n"))),
        F.lit("## Content"),
        F.coalesce(a("content_text"), F.lit("")),
    )
    return F.array_join(F.array_compact(lines), "\n")


def document_name(id_: Column, published_date: Column) -> Column:
    """``{source}_{day}_{hash}.txt``; the id is split at its last underscore."""
    day = local_day(published_date)
    dated = F.when(day != "", F.concat(F.lit("_"), day)).otherwise(F.lit(""))
    parts = r"(?s)^(.*)_([^_]*)$"
    return F.concat(
        F.regexp_extract(id_, parts, 1), dated, F.lit("_"), F.regexp_extract(id_, parts, 2), F.lit(".txt")
    )


def document_metadata(a=F.col) -> Column:
    """String map attached to a document; a missing date is the text ``None``."""
    values = {
        "source": a("source_name"),
        "url": a("url"),
        "author": a("author"),
        "published_date": F.coalesce(a("published_date"), F.lit("None")),
        "tags": F.array_join(a("tags"), ", "),
        "word_count": a("word_count").cast("string"),
    }
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])


def retry_delay(
    attempt: Column,
    base: float = RETRY_BASE_SECONDS,
    factor: float = RETRY_FACTOR,
    longest: float = RETRY_MAX_SECONDS,
) -> Column:
    """Seconds to wait after a 0-based attempt: exponential with an upper end."""
    return F.least(F.lit(base) * F.pow(F.lit(factor), attempt), F.lit(longest))
