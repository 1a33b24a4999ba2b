"""Dates as canonical ISO text, and the instant behind it.

Text is kept because documents show the calendar day in the entry's own offset,
while filters and ordering need the instant. A date without an offset is UTC.
Missing parts become the first of their period.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .expr import blank_to_null, let
from .text import VALUE, meta_content, shown_markup, strip

_ZONE = r"([A-Za-z]{1,5}|[+-]\d{2}:?\d{2})?"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,6})\d*)?)?(?:\s*([AaPp])\.?[Mm]\b\.?)?"

# Accepted layouts and where each puts
# year|month|day|hour|minute|second|fraction|half of the day|zone.
LAYOUTS = (
    (rf"^(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}})(?:[Tt ]\s*{_TIME})?\s*{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    (
        rf"^(?:[A-Za-z]+,?\s+)?(\d{{1,2}})(?:\s+|-)([A-Za-z]{{3,9}})\.?,?(?:\s+|-)(\d{{4}}|\d{{2}})(?:,?\s+{_TIME})?\s*{_ZONE}$",
        "$3|$2|$1|$4|$5|$6|$7|$8|$9",
    ),
    (
        rf"^(?:[A-Za-z]+,\s+)?([A-Za-z]{{3,9}})\.?\s+(\d{{1,2}}),?\s+(\d{{4}})(?:,?\s+{_TIME})?\s*{_ZONE}$",
        "$3|$1|$2|$4|$5|$6|$7|$8|$9",
    ),
    (
        rf"^(?:[A-Za-z]+,?\s+)?([A-Za-z]{{3,9}})\s+(\d{{1,2}})\s+{_TIME}\s*{_ZONE}\s+(\d{{4}})$",
        "$9|$1|$2|$3|$4|$5|$6|$7|$8",
    ),
    (rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,?\s+{_TIME})?\s*{_ZONE}$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:[Tt](\d{{2}})(\d{{2}})(\d{{2}})?\s*{_ZONE})?$", "$1|$2|$3|$4|$5|$6|||$7"),
    (r"^(\d{4})(?:-(\d{2}))?$", "$1|$2|||||||"),
)
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

# Meta tags that carry a publication date, in order of preference.
DATE_METAS = (
    ("property", "article:published_time"),
    ("name", "publish_date"),
    ("name", "date"),
    ("name", "DC.date"),
    ("itemprop", "datePublished"),
    ("property", "og:published_time"),
)
_JSON_LD = r"(?is)<script\b[^>]*\stype\s*=\s*[\"']?application/ld\+json(?=[\"'\s>])[^>]*>(.*?)</script\s*>"
_JSON_LD_SCHEMA = "array<struct<datePublished:string,dateCreated:string,dateModified:string>>"


def _month_number(m: Column) -> Column:
    at = F.instr(F.lit(_MONTHS), F.lower(F.substring(m, 1, 3)))
    named = F.when((at > 0) & (at % 3 == 1), F.lpad(((at + 2) / 3).cast("int").cast("string"), 2, "0"))
    return (
        F.when(m == "", F.lit("01"))
        .when(m.rlike(r"^\d+$"), F.lpad(m, 2, "0"))
        .otherwise(F.coalesce(named, F.lit("00")))
    )


def _year(y: Column) -> Column:
    """Two digits are a year from 1950 to 2049, as mail headers have it."""
    return F.when(F.length(y) == 4, y).otherwise(F.concat(F.when(y < "50", F.lit("20")).otherwise(F.lit("19")), y))


def _hour(hour: Column, half: Column) -> Column:
    """Hour of the day; null where a half of the day is given with an hour beyond 12."""
    at = hour.try_cast("int")
    halved = F.when(at.between(1, 12), at % 12 + F.when(F.lower(half) == "p", F.lit(12)).otherwise(F.lit(0)))
    return F.lpad(F.when(hour == "", F.lit(0)).when(half == "", at).otherwise(halved).cast("string"), 2, "0")


def _zone(z: Column) -> Column:
    digits = F.regexp_replace(z, ":", "")
    return (
        F.when(F.lower(z).isin("z", "ut", "utc", "gmt"), F.lit("+00:00"))
        .when(z.rlike(r"^[+-]"), F.concat(F.substring(digits, 1, 3), F.lit(":"), F.substring(digits, 4, 2)))
        .otherwise(F.lit(""))
    )


def _canonical(p: Column) -> Column:
    def part(i: int) -> Column:
        return F.element_at(p, i)

    def or_zero(c: Column) -> Column:
        return F.when(c == "", F.lit("00")).otherwise(c)

    day = F.when(part(3) == "", F.lit("01")).otherwise(F.lpad(part(3), 2, "0"))
    fraction = F.when(
        part(7).rlike("[1-9]"), F.concat(F.lit("."), F.rpad(part(7), 6, "0"))
    ).otherwise(F.lit(""))
    iso = F.concat(
        _year(part(1)), F.lit("-"), _month_number(part(2)), F.lit("-"), day, F.lit("T"),
        _hour(part(4), part(8)), F.lit(":"), or_zero(part(5)), F.lit(":"), or_zero(part(6)),
        fraction, _zone(part(9)),
    )
    return let(iso, lambda t: F.when(instant(t).isNotNull(), t))


def parse_date(c: Column) -> Column:
    """ISO text of a date in one of the accepted layouts, null for anything else."""

    def fields(s: Column) -> Column:
        chosen = None
        for pattern, order in LAYOUTS:
            value = F.regexp_replace(s, pattern, order)
            chosen = F.when(s.rlike(pattern), value) if chosen is None else chosen.when(s.rlike(pattern), value)
        return F.split(chosen, r"\|")

    return let(let(strip(c), fields), _canonical)


def instant(iso: Column) -> Column:
    """Timestamp of ISO text; null when it is not a date."""
    timed = iso.contains(":")
    zoned = timed & iso.rlike(r"([Zz]|[+-]\d{2}:?\d{2})$")
    missing = F.when(zoned, F.lit("")).when(timed, F.lit("Z")).otherwise(F.lit("T00:00:00Z"))
    return F.concat(iso, missing).try_cast("timestamp")


def local_day(iso: Column) -> Column:
    """Calendar day as written, '' when there is no date."""
    return F.coalesce(F.substring(iso, 1, 10), F.lit(""))


def first_date(*candidates: Column) -> Column:
    """First candidate that parses."""
    parsed = F.transform(F.array(*candidates), parse_date)
    return F.try_element_at(F.filter(parsed, lambda d: d.isNotNull()), F.lit(1))


def url_date(url: Column) -> Column:
    pattern = r"/(\d{4})[/-](\d{2})[/-](\d{2})"
    found = F.regexp_extract(url, pattern, 0)
    return F.when(found != "", parse_date(F.regexp_replace(found, pattern, "$1-$2-$3")))


def time_date(html: Column) -> Column:
    """Date of the first ``<time datetime>`` element."""
    return parse_date(F.regexp_extract(shown_markup(html), rf"(?is)<time\b[^>]*\sdatetime{VALUE}", 1))


def meta_date(html: Column) -> Column:
    """First meta tag in order of preference whose content parses."""
    return let(shown_markup(html), lambda shown: first_date(*[meta_content(shown, a, v) for a, v in DATE_METAS]))


def jsonld_date(html: Column) -> Column:
    """Date from the first JSON-LD script outside comments whose first stated date parses."""

    def stated(item: Column) -> Column:
        names = ("datePublished", "dateCreated", "dateModified")
        return F.coalesce(*[blank_to_null(item[n]) for n in names])

    def of_script(text: Column) -> Column:
        items = F.from_json(text, _JSON_LD_SCHEMA)
        values = F.filter(F.transform(items, stated), lambda v: v.isNotNull())
        return parse_date(F.try_element_at(values, F.lit(1)))

    shown = F.when(F.contains(html, F.lit("<!--")), F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")).otherwise(html)
    scripts = F.regexp_extract_all(shown, F.lit(_JSON_LD), F.lit(1))
    return F.try_element_at(F.filter(F.transform(scripts, of_script), lambda d: d.isNotNull()), F.lit(1))


def page_date(html: Column, url: Column, metadata_date: Column | None = None) -> Column:
    """Extractor metadata, JSON-LD, meta tags, ``<time>``, then the URL."""
    own = [] if metadata_date is None else [parse_date(metadata_date)]
    return F.coalesce(*own, jsonld_date(html), meta_date(html), time_date(html), url_date(url))
