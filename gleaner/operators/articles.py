"""The article table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fields, text
from ..functions.expr import blank_to_null
from ..schema import ARTICLE_COLUMNS
from .catalog import scrape_method


def project_articles(df: DataFrame, as_of: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Build the article columns, followed by the input columns named in ``keep``.

    Expects source, source_name, method, url, title, author, published_date
    (ISO text), content_text and tags. Plain columns throughout: whoever needs
    only ids or URLs never reads the text.
    """
    content = df.withColumn("content_text", F.coalesce("content_text", F.lit("")))
    counted = content.withColumn("word_count", text.word_count(F.col("content_text")))
    built = counted.withColumns(
        {
            "id": fields.article_id(F.col("source"), F.col("url")),
            "author": F.coalesce(blank_to_null(F.col("author")), F.col("source_name")),
            "scraped_at": F.lit(as_of).cast("timestamp"),
            "summary": text.summary(F.col("content_text")),
            "metadata": F.struct(
                text.reading_minutes(F.col("word_count")).alias("reading_time_minutes"),
                scrape_method(F.col("method")).alias("scrape_method"),
            ),
        }
    )
    return built.select(*ARTICLE_COLUMNS, *keep)


def with_required_fields(df: DataFrame, min_chars: int = 0) -> DataFrame:
    """Rows with a URL, a title and at least ``min_chars`` characters of text."""
    kept = df.where((F.col("url") != "") & (text.strip(F.col("title")) != ""))
    return kept.where(F.length("content_text") >= min_chars) if min_chars else kept
