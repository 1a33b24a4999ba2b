"""Article filters. Each test is a column, so a reason can be recorded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import instant
from ..functions.expr import any_of, with_computed
from ..functions.urls import is_excluded
from ..params import EXCLUDE_PATTERNS, FilterParams

TOO_OLD = "too_old"
WORD_COUNT = "word_count"
KEYWORD = "keyword"


def within_lookback(published: Column, as_of: str, days: int | None) -> Column:
    """True without a date, for an unreadable date, or from the cut-off on."""
    if not days:
        return F.lit(True)
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return published.isNull() | (published >= cutoff)


def within_words(words: Column, low: int = 0, high: int | None = None) -> Column:
    test = words >= low
    return test if high is None else test & (words <= high)


def minimal_keywords(keywords) -> list[str]:
    """Drop keywords that contain another one: a substring test never needs them."""
    lowered = sorted({k.lower() for k in keywords}, key=len)
    kept: list[str] = []
    for word in lowered:
        if not any(k in word for k in kept):
            kept.append(word)
    return kept


def mentions_keyword(title: Column, content: Column, keywords) -> Column:
    """Any keyword as a lower-case substring of title and text; no keywords keep all."""
    if not keywords:
        return F.lit(True)
    haystack = F.lower(
        F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(content, F.lit("")))
    )
    words = minimal_keywords(keywords)
    # exists over one element lower-cases the text once instead of once per keyword
    return F.exists(F.array(haystack), lambda t: any_of([F.contains(t, F.lit(k)) for k in words]))


def reject_reason(as_of: str, params: FilterParams) -> Column:
    """First failing test of an article row, null when it passes."""
    published = instant(F.col("published_date"))
    return (
        F.when(~within_lookback(published, as_of, params.lookback_days), F.lit(TOO_OLD))
        .when(~within_words(F.col("word_count"), params.min_words, params.max_words), F.lit(WORD_COUNT))
        .when(
            ~mentions_keyword(F.col("title"), F.col("content_text"), params.keywords),
            F.lit(KEYWORD),
        )
    )


def with_reason(articles: DataFrame, as_of: str, params: FilterParams) -> DataFrame:
    """Add ``reason``; words are counted and tests run once per row.

    The word count is held first, because the reason reads it more than once.
    """
    counted = with_computed(articles, word_count=F.col("word_count"))
    return with_computed(counted, reason=reject_reason(as_of, params))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNull()).drop("reason")


def lookback_filter(articles: DataFrame, as_of: str, days: int | None) -> DataFrame:
    return articles.where(within_lookback(instant(F.col("published_date")), as_of, days))


def word_count_filter(articles: DataFrame, low: int = 0, high: int | None = None) -> DataFrame:
    counted = with_computed(articles, word_count=F.col("word_count"))
    return counted.where(within_words(F.col("word_count"), low, high))


def keyword_filter(articles: DataFrame, keywords) -> DataFrame:
    # held, so that the search runs after a repartitioning that precedes it
    judged = with_computed(
        articles, _hit=mentions_keyword(F.col("title"), F.col("content_text"), keywords)
    )
    return judged.where("_hit").drop("_hit")


def exclude_urls(df: DataFrame, patterns=EXCLUDE_PATTERNS, url: str = "url") -> DataFrame:
    return df.where(~is_excluded(F.col(url), patterns))
