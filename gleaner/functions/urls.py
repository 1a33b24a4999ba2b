"""URL expressions.

Authority and path come from regular expressions, not from a strict URI parser,
so that a URL with an unescaped character is still split instead of lost.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ..params import EXCLUDE_PATTERNS, SKIP_LINK_PATTERNS
from .expr import any_of
from .text import VALUE, shown_markup, unescape

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"
LINK = rf"(?is)<a\b[^>]*\shref{VALUE}"


def authority(url: Column) -> Column:
    """Host with port and user info, '' when there is none."""
    return F.regexp_extract(url, _SCHEME + r"([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, _SCHEME + r"[^/?#]*([^?#]*)", 1)


def is_excluded(url: Column, patterns=EXCLUDE_PATTERNS) -> Column:
    """Case-sensitive substring test on the whole URL; a null URL is not excluded."""
    return F.coalesce(any_of([F.contains(url, F.lit(p)) for p in patterns]), F.lit(False))


def is_skipped_link(href: Column, exclude_patterns=EXCLUDE_PATTERNS) -> Column:
    """Case-insensitive search on the raw href for non-article patterns."""
    literal = [re.sub(r"([^\w/\s])", r"\\\1", p) for p in exclude_patterns]
    return href.rlike("(?i)" + "|".join(f"(?:{p})" for p in (*SKIP_LINK_PATTERNS, *literal)))


def hrefs(html: Column) -> Column:
    """All link targets in document order, none from comments and scripts."""
    return F.transform(F.regexp_extract_all(shown_markup(html), F.lit(LINK), F.lit(1)), unescape)


def resolve(href: Column, base_url: Column) -> Column:
    """Rooted links get the base in front, absolute ones stay, others are null."""
    return F.when(F.startswith(href, F.lit("/")), F.concat(base_url, href)).when(
        F.startswith(href, F.lit("http")), href
    )


def is_article_link(url: Column, base_url: Column) -> Column:
    """Same authority as the base and a path beyond the root."""
    return (authority(url) == authority(base_url)) & ~path(url).isin("", "/")


def listing_url(base_url: Column, blog_path: Column) -> Column:
    return F.concat(base_url, F.coalesce(blog_path, F.lit("/blog")))
