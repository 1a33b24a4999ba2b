"""Feed documents to entries and articles."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, fields, text, xml
from ..functions.expr import blank_to_null, let, with_computed
from ..params import MAX_PER_SOURCE, SHORT_ENTRY_CHARS
from ..session import materialised
from .pages import as_landed
from .skew import first_per_group, join_dimension

# Entries are cut out of the feed text first, so one broken entry, or a feed cut
# off in the middle, does not lose the others.
_ENTRY = r"(?s)<((?:\w+:)?(?:item|entry))(?=[\s>])[^>]*>.*?</\1\s*>"
_ENTRY_TAG = r"<(?:\w+:)?(?:item|entry)(?=[\s>])"
#: So much of a feed is looked through for a first entry before its source's cap is applied.
_HEAD_CHARS = 1 << 14
_ENTRY_SCHEMA = """
struct<
  title: struct<_VALUE: string, _type: string>,
  link: array<struct<_VALUE: string, _href: string, _rel: string>>,
  guid: struct<_VALUE: string, _isPermaLink: string>,
  `content:encoded`: array<struct<_VALUE: string, _type: string>>,
  content: array<struct<_VALUE: string, _type: string>>,
  summary: struct<_VALUE: string, _type: string>,
  description: struct<_VALUE: string, _type: string>,
  pubDate: string, published: string, `dc:date`: string,
  updated: string, `atom:updated`: string,
  created: string, `dcterms:created`: string,
  `dc:creator`: array<string>,
  author: array<struct<_VALUE: string, name: string>>,
  category: array<struct<_VALUE: string, _term: string>>
>
"""


def _entry_link(e: Column) -> Column:
    texts = F.filter(e["link"], lambda x: text.strip(x["_VALUE"]) != "")
    main = F.filter(
        e["link"], lambda x: (x["_href"] != "") & (x["_rel"].isNull() | (x["_rel"] == "alternate"))
    )
    # an id is the address of its entry unless it says otherwise
    guid = text.strip(e["guid"]["_VALUE"])
    permanent = (F.coalesce(F.lower(e["guid"]["_isPermaLink"]), F.lit("true")) != "false") & guid.rlike("^https?://")
    return F.coalesce(
        text.strip(F.try_element_at(texts, F.lit(1))["_VALUE"]),
        F.try_element_at(main, F.lit(1))["_href"],
        F.when(permanent, guid),
    )


def _entry_fields(e: Column) -> Column:
    def values(c: Column) -> Column:
        return F.transform(c, lambda x: F.struct(F.coalesce(x["_VALUE"], F.lit("")).alias("value")))

    creator = F.try_element_at(e["dc:creator"], F.lit(1))
    named = F.filter(e["author"], lambda a: a["name"].isNotNull())
    plain = F.try_element_at(e["author"], F.lit(1))["_VALUE"]
    return F.struct(
        _entry_link(e).alias("link"),
        e["title"]["_VALUE"].alias("title"),
        F.coalesce(values(e["content:encoded"]), values(e["content"])).alias("content"),
        e["summary"]["_VALUE"].alias("summary"),
        e["description"]["_VALUE"].alias("description"),
        F.coalesce(e["pubDate"], e["published"], e["dc:date"]).alias("published"),
        F.coalesce(e["updated"], e["atom:updated"]).alias("updated"),
        F.coalesce(e["created"], e["dcterms:created"]).alias("created"),
        F.coalesce(blank_to_null(plain), creator).alias("author"),
        F.transform(named, lambda a: F.struct(a["name"].alias("name"))).alias("authors"),
        F.transform(
            e["category"], lambda c: F.struct(F.coalesce(c["_term"], c["_VALUE"]).alias("term"))
        ).alias("tags"),
    )


def parse_feeds(feeds: DataFrame, max_entries: int | None = None) -> DataFrame:
    """Entries of RSS and Atom documents in feed order, ``pos`` from 0.

    With ``max_entries`` the surplus of each document is not parsed at all: an
    entry beyond that position cannot be among the first of its source.

    Character data sections become text before entries are cut, so none ends
    inside of one. Entries are then mended: names of HTML entities, ampersands that
    stand alone, markup inside titles and contents, namespace prefixes. ``status`` is
    ``ok``, ``mended``, or ``broken`` for an entry that no mending makes readable; it
    keeps its position and has only nulls. See ``feed_status`` for the counts.
    """
    found = F.regexp_extract_all(xml.plain_sections(F.col("xml")), F.lit(_ENTRY), F.lit(0))
    pieces = found if max_entries is None else F.slice(found, 1, max_entries)
    cut = feeds.select("source_id", "fetched_at", F.posexplode(pieces).alias("pos", "piece"))
    mended = let(xml.unprefixed(F.col("piece")), lambda p: let(xml.known_references(p), xml.carried_markup))
    known = with_computed(cut, mended=mended)
    parsed = with_computed(known, e=F.from_xml("mended", _ENTRY_SCHEMA))
    empty = reduce(and_, [parsed["e"][name].isNull() for name in parsed.schema["e"].dataType.names])
    status = F.when(empty, "broken").when(F.col("mended") != F.col("piece"), "mended").otherwise("ok")
    # one object per entry: filters on its fields must not repeat the parsing
    return with_computed(parsed.withColumn("status", status).drop("mended", "piece"), entry=_entry_fields(F.col("e"))).select(
        "source_id", "fetched_at", "pos", "entry.*", "status"
    )


def feed_status(feeds: DataFrame, entries: DataFrame) -> DataFrame:
    """(source_id, status, n): what became of the landed feeds and their ``parse_feeds`` entries.

    Entries are ok, mended or broken; ``cut_off`` counts entries that begin and do
    not end, ``no_entries`` feeds without any.
    """
    plain = with_computed(feeds.select("source_id", "xml"), plain=xml.plain_sections(F.col("xml"))).drop("xml")
    begun = F.coalesce(F.regexp_count("plain", F.lit(_ENTRY_TAG)), F.lit(0))
    whole = F.coalesce(F.regexp_count("plain", F.lit(_ENTRY)), F.lit(0))
    counted = with_computed(plain, begun=begun, whole=whole)
    lost = counted.groupBy("source_id").agg(
        F.sum(F.greatest(F.lit(0), F.col("begun") - F.col("whole"))).alias("cut_off"), F.count_if(F.col("begun") == 0).alias("no_entries")
    )
    tall = lost.unpivot(["source_id"], ["cut_off", "no_entries"], "status", "n").where("n > 0")
    return entries.groupBy("source_id", "status").agg(F.count("*").alias("n")).unionByName(tall)


def cap_entries(entries: DataFrame, n: int = MAX_PER_SOURCE) -> DataFrame:
    """First ``n`` raw entries per source, before any other test."""
    order = [F.desc("fetched_at"), F.col("pos")] if "fetched_at" in entries.columns else [F.col("pos")]
    return first_per_group(entries, ["source_id"], order, n)


def newest_feeds(feeds: DataFrame, n: int) -> DataFrame:
    """The landed feeds that may hold one of the first ``n`` entries of their source; the others need no parsing.

    A feed in which an entry ends early on adds one entry at least, so ``n`` such feeds of a source, the
    newest ones, hold what the cap keeps. Feeds as old as the last of these stay, and all
    feeds of a source that has fewer.
    """
    head = F.substring("xml", 1, _HEAD_CHARS)
    begins = F.substring_index(xml.sections_as_text(head), "<!--", 1).rlike(_ENTRY)
    sure = feeds.where(begins).select("source_id", "fetched_at")
    ranked = first_per_group(sure, ["source_id"], [F.desc("fetched_at")], n, rank="_rank")
    last = ranked.where((F.col("_rank") == n) & F.col("fetched_at").isNotNull())
    least = materialised(last.select(F.col("source_id").alias("_source"), F.col("fetched_at").alias("_least")), "least")
    older = F.coalesce(F.col("fetched_at") < F.col("_least"), F.lit(True))
    return feeds.join(least, (F.col("source_id") == F.col("_source")) & older, "left_anti")


def capped_entries(feeds: DataFrame, n: int = MAX_PER_SOURCE) -> DataFrame:
    """``cap_entries`` of the landed feeds' entries, of which only those of the newest feeds are parsed."""
    return cap_entries(parse_feeds(newest_feeds(feeds, n), n), n)


def feed_text(entries: DataFrame) -> DataFrame:
    """Add the plain text of each entry."""
    markup = fields.chosen_html(F.col("content"), F.col("summary"), F.col("description"))
    return with_computed(entries, content_text=text.fragment_text(markup))


def entry_fields(entries: DataFrame) -> DataFrame:
    """Article inputs from parsed entries with the catalog attached."""
    terms = F.transform("tags", lambda t: t["term"])
    return entries.select(
        F.col("source_id").alias("source"),
        F.col("name").alias("source_name"),
        "method",
        F.col("link").alias("url"),
        text.strip(F.col("title")).alias("title"),
        fields.chosen_author(F.col("author"), F.col("authors"), F.col("name")).alias("author"),
        dates.first_date(F.col("published"), F.col("updated"), F.col("created")).alias(
            "published_date"
        ),
        "content_text",
        fields.merged_tags(F.col("default_tags"), terms, text.strip).alias("tags"),
        "fetched_at",
        "pos",
    )


def enrich_short(
    entries: DataFrame, pages: DataFrame, min_chars: int = SHORT_ENTRY_CHARS, as_of: str | None = None
) -> DataFrame:
    """Replace the text of short entries by the text of their landed page.

    Used only when the page text has more than ``min_chars`` characters and is
    longer than the entry. Long entries stay out of the join; text is extracted
    once per page, and only from pages that some short entry asks for. Those
    URLs are broadcast when their size allows, so pages are not shuffled. Of
    several versions of a page the newest one at ``as_of`` counts.
    """
    size = F.length("content_text")
    short = entries.where(size < min_chars)
    long = entries.where(F.coalesce(size >= min_chars, F.lit(True)))
    wanted = short.where(F.col("url") != "").select("url").distinct()
    columns = [c for c in ("page_id", "url", "html", "landed_at") if c in pages.columns]
    asked = join_dimension(pages.select(*columns), wanted, "url", "left_semi", skewed=False)
    texts = as_landed(asked, ["url"], as_of).select("url", text.main_text(F.col("html")).alias("_page"))
    matched = short.join(texts, "url", "left")
    better = (F.length("_page") > min_chars) & (F.length("_page") > size)
    swapped = matched.withColumn(
        "content_text", F.when(better, F.col("_page")).otherwise(F.col("content_text"))
    )
    return long.unionByName(swapped.select(*entries.columns))
