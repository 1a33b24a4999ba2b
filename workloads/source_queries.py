"""Catalogs, feeds and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import dates, fields, text, urls
from gleaner.operators import catalog, feeds as feed_ops, pages as page_ops
from gleaner.operators.registry import unseen

from . import inputs as i
from .registering import query

# --- catalog ---------------------------------------------------------------------

# Feeds of the document sources and page sources of the hosts. Sources ending in
# 7 are switched off, those ending in 3 do not say; hosts on "m." are off.
RAW_CATALOG = f"""
{i.SITES},
rss AS (
  SELECT DISTINCT source AS source_id, 'Source ' || source AS name,
    'https://' || source || '.example.com' AS base_url,
    CASE WHEN source LIKE '%7' THEN false WHEN source LIKE '%3' THEN NULL ELSE true END AS enabled,
    CASE WHEN source LIKE '%5' THEN NULL ELSE 'corpus' END AS tags, CAST(NULL AS VARCHAR) AS blog_path
  FROM documents
),
html AS (
  SELECT source_id, 'Site ' || source_id AS name, base_url,
    CASE WHEN source_id LIKE 'm.%' THEN false END AS enabled, 'page' AS tags,
    CASE WHEN source_id LIKE 'blog.%' THEN '/en' ELSE '/blog' END AS blog_path
  FROM sites
),
catalog AS (
  SELECT 'rss' AS method, * FROM rss UNION ALL SELECT 'html' AS method, * FROM html
)
"""


def _rss(spark, sf_dir):
    source = F.col("source_id")
    enabled = F.when(source.like("%7"), False).when(source.like("%3"), None).otherwise(True)
    tags = F.when(~source.like("%5"), F.array(F.lit("corpus")))
    base = i.feed_catalog(spark, sf_dir).select("source_id", "name", "base_url")
    return base.withColumns({"enabled": enabled, "default_tags": tags})


def _html(spark, sf_dir):
    source = F.col("source_id")
    base = i.site_catalog(spark, sf_dir).select("source_id", "name", "base_url")
    return base.withColumns(
        {
            "enabled": F.when(source.like("m.%"), False),
            "default_tags": F.array(F.lit("page")),
            "blog_path": F.when(source.like("blog.%"), "/en"),
        }
    )


def _catalog(spark, sf_dir):
    tagged = _rss(spark, sf_dir).withColumn("method", F.lit("rss"))
    raw = tagged.unionByName(
        _html(spark, sf_dir).withColumn("method", F.lit("html")), allowMissingColumns=True
    )
    return catalog.with_defaults(raw.withColumn("js_rendered", F.lit(None).cast("boolean")))


@query(
    "source_catalog",
    f"""WITH {RAW_CATALOG} SELECT source_id, method, name, base_url, blog_path,
      coalesce(tags, '') AS tags, false AS js_rendered, coalesce(enabled, true) AS enabled FROM catalog""",
)
def source_catalog(spark, sf_dir):
    return _catalog(spark, sf_dir).select(
        "source_id", "method", "name", "base_url", "blog_path",
        F.array_join("default_tags", ", ").alias("tags"), "js_rendered", "enabled",
    )


@query(
    "enabled_sources",
    f"WITH {RAW_CATALOG} SELECT source_id, method FROM catalog WHERE coalesce(enabled, true)",
)
def enabled_sources(spark, sf_dir):
    return catalog.enabled_sources(_catalog(spark, sf_dir)).select("source_id", "method")


@query(
    "select_sources",
    f"""WITH {RAW_CATALOG}, runs AS (SELECT unnest(['all', 'rss_only', 'html_only', 'one']) AS run)
    SELECT run, source_id FROM catalog, runs WHERE run = 'all' OR (run = 'rss_only' AND method = 'rss')
      OR (run = 'html_only' AND method = 'html') OR (run = 'one' AND source_id = 'src1')""",
)
def select_sources(spark, sf_dir):
    known = _catalog(spark, sf_dir)
    runs = {
        "all": {},
        "rss_only": {"rss_only": True},
        "html_only": {"html_only": True},
        "one": {"source": "src1", "rss_only": True},
    }
    rows = None
    for run, options in runs.items():
        part = catalog.select_sources(known, **options).select(F.lit(run).alias("run"), "source_id")
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query(
    "all_sources",
    f"WITH {RAW_CATALOG} SELECT source_id, method, name, blog_path, true AS enabled FROM catalog",
)
def all_sources(spark, sf_dir):
    blog = F.coalesce("blog_path", F.lit("/blog"))
    both = catalog.all_sources(
        _rss(spark, sf_dir), _html(spark, sf_dir).withColumn("blog_path", blog)
    )
    return both.select("source_id", "method", "name", "blog_path", "enabled")


# Half of the page hosts also publish a feed under the same id.
DOUBLE_CATALOG = f"""
{i.SITES},
doubled AS (
  SELECT source_id, 'html' AS method FROM sites
  UNION ALL SELECT source_id, 'rss' FROM sites WHERE base_url LIKE 'https:%'
)
"""


def _doubled(spark, sf_dir):
    pages = i.site_catalog(spark, sf_dir)
    feeds = pages.where(F.col("base_url").startswith("https:")).withColumn("method", F.lit("rss"))
    return pages.unionByName(feeds)


@query(
    "catalog_precedence",
    f"WITH {DOUBLE_CATALOG} SELECT source_id, max(method) AS method FROM doubled GROUP BY source_id",
)
def catalog_precedence(spark, sf_dir):
    return catalog.prefer_feeds(_doubled(spark, sf_dir)).select("source_id", "method")


@query(
    "attach_source",
    f"""WITH {DOUBLE_CATALOG} SELECT page_id, {i.HOST} AS source_id, base_url,
      CASE WHEN base_url LIKE 'https:%' THEN 'rss' ELSE 'html' END AS method
    FROM pages JOIN sites ON source_id = {i.HOST}""",
)
def attach_source(spark, sf_dir):
    rows = i.pages(spark, sf_dir).select("page_id", urls.authority(F.col("url")).alias("source_id"))
    attached = catalog.attach_source(rows, _doubled(spark, sf_dir))
    return attached.select("page_id", "source_id", "base_url", "method")


@query(
    "listing_url",
    f"WITH {RAW_CATALOG} SELECT source_id, base_url || blog_path AS url FROM catalog WHERE method = 'html'",
)
def listing_url(spark, sf_dir):
    return _html(spark, sf_dir).select(
        "source_id", urls.listing_url(F.col("base_url"), F.col("blog_path")).alias("url")
    )


# --- feeds -----------------------------------------------------------------------


@query(
    "feed_entries",
    f"""WITH {i.ENTRIES} SELECT source_id, CAST(epoch_us(fetched_at) AS BIGINT) AS fetched_at,
      CAST(pos AS BIGINT) AS pos, link, title,
      CASE WHEN lang = 'en' THEN strftime(day, 'Mon, %-d %b %Y 10:00:00 GMT') END AS published,
      CASE WHEN lang <> 'en' THEN strftime(day, '%Y-%m-%dT23:30:00-05:00') END AS updated,
      CASE WHEN lang = 'en' THEN 'Feed Writer' END AS author,
      CASE WHEN lang = 'en' THEN '' ELSE 'A, B' END AS authors,
      CASE WHEN lang = 'en' THEN 'EN,Line' ELSE 'Line' END AS tags
    FROM entries""",
)
def feed_entries(spark, sf_dir):
    rows = feed_ops.parse_feeds(i.feeds(spark, sf_dir))
    return rows.select(
        "source_id",
        i.micros(F.col("fetched_at")).alias("fetched_at"),
        F.col("pos").cast("long").alias("pos"),
        "link",
        text.strip(F.col("title")).alias("title"),
        "published",
        "updated",
        "author",
        F.coalesce(F.array_join(F.col("authors.name"), ", "), F.lit("")).alias("authors"),
        F.array_join(F.transform("tags", lambda t: F.trim(t["term"])), ",").alias("tags"),
    )


# Entries with bare markup, with HTML names or with a prefix are mended; a character data section is XML.
@query(
    "feed_status",
    f"""WITH {i.ENTRIES} SELECT source_id, CASE WHEN lang = 'en' AND (pos % 4 = 2 OR pos % 4 = 1)
        OR lang <> 'en' AND pos % 3 <> 0 THEN 'mended' ELSE 'ok' END AS status, count(*) AS n
    FROM entries GROUP BY ALL""",
)
def feed_status(spark, sf_dir):
    feeds = i.feeds(spark, sf_dir)
    return feed_ops.feed_status(feeds, feed_ops.parse_feeds(feeds))


@query(
    "feed_cap",
    f"""WITH {i.ENTRIES} SELECT source_id, link FROM entries
    QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, pos) <= 50""",
)
def feed_cap(spark, sf_dir):
    return feed_ops.capped_entries(i.feeds(spark, sf_dir), 50).select("source_id", "link")


@query(
    "fragment_text",
    f"WITH {i.ENTRIES} SELECT source_id, link, content_text FROM entries",
)
def fragment_text(spark, sf_dir):
    written = feed_ops.feed_text(feed_ops.parse_feeds(i.feeds(spark, sf_dir)))
    return written.select("source_id", "link", "content_text")


@query(
    "content_choice",
    """SELECT doc_id, CASE lang WHEN 'en' THEN text WHEN 'de' THEN '' WHEN 'fr' THEN source
      ELSE '<p>' || source || '</p>' END AS html FROM documents""",
)
def content_choice(spark, sf_dir):
    lang = F.col("lang")
    value = F.when(lang == "en", F.col("text")).when(lang == "de", "")
    content = F.when(lang.isin("en", "de"), F.array(F.struct(value.alias("value"))))
    summary = F.when(lang == "es", "").otherwise(F.col("source"))
    description = F.concat(F.lit("<p>"), "source", F.lit("</p>"))
    docs = i.table(spark, sf_dir, "documents")
    return docs.select("doc_id", fields.chosen_html(content, summary, description).alias("html"))


@query(
    "author_choice",
    """SELECT doc_id, CASE lang WHEN 'en' THEN 'Writer' WHEN 'de' THEN 'A1, B, C' WHEN 'fr' THEN source
      ELSE source END AS author FROM documents""",
)
def author_choice(spark, sf_dir):
    lang = F.col("lang")
    names = F.array(*[F.struct(F.lit(n).alias("name")) for n in ("A1", "B", "C", "D")])
    unnamed = F.array(F.struct(F.lit(None).cast("string").alias("name")))
    authors = F.when(lang == "de", names).when(lang == "fr", unnamed)
    author = F.when(lang == "en", "Writer").when(lang == "de", "")
    docs = i.table(spark, sf_dir, "documents")
    chosen = fields.chosen_author(author, authors, F.col("source"))
    return docs.select("doc_id", chosen.alias("author"))


@query(
    "tag_merge",
    """SELECT doc_id, array_to_string(list_sort(list_distinct(['corpus', lang, source, ''])), '|') AS tags
    FROM documents""",
)
def tag_merge(spark, sf_dir):
    terms = F.array(
        F.concat(F.upper("lang"), F.lit("  ")), F.initcap("source"), F.lit(None).cast("string"),
        F.lit(""), F.lit("   "), F.lit("CORPUS"),
    )
    merged = fields.merged_tags(F.array(F.lit("corpus")), terms, text.strip)
    docs = i.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.array_join(merged, "|").alias("tags"))


# Publication dates in five layouts, with unreadable and missing ones in between.
FEED_DATES = """
dated AS (
  SELECT doc_id, lang, DATE '2023-11-01' + CAST(doc_id % 400 AS INTEGER) AS day FROM documents
)
"""


@query(
    "feed_date",
    f"""WITH {FEED_DATES} SELECT doc_id, CASE lang
      WHEN 'en' THEN strftime(day, '%Y-%m-%dT10:00:00+00:00')
      WHEN 'de' THEN strftime(day, '%Y-%m-%dT08:15:30.250000+02:00')
      WHEN 'fr' THEN strftime(day, '%Y-%m-%dT00:00:00') END AS published_date,
      CASE lang WHEN 'en' THEN epoch_us(day + INTERVAL 10 HOUR)
      WHEN 'de' THEN epoch_us(day + INTERVAL '6 hours 15 minutes 30.25 seconds')
      WHEN 'fr' THEN epoch_us(CAST(day AS TIMESTAMP)) END AS published_micros
    FROM dated""",
)
def feed_date(spark, sf_dir):
    day = F.date_add(F.lit("2023-11-01").cast("date"), (F.col("doc_id") % 400).cast("int"))
    lang = F.col("lang")
    rfc = F.concat(F.lit("Wed, "), F.date_format(day, "dd MMM yyyy"), F.lit(" 10:00:00 GMT"))
    iso = F.concat(day.cast("string"), F.lit("T08:15:30.25+0200"))
    long_form = F.date_format(day, "MMMM d, yyyy")
    published = F.when(lang == "en", rfc).when(lang == "de", "yesterday").otherwise("")
    updated = F.when(lang == "de", iso).when(lang == "es", "2024-13-40")
    created = F.when(lang == "fr", long_form).when(lang == "es", "soon")
    docs = i.table(spark, sf_dir, "documents")
    found = docs.select("doc_id", dates.first_date(published, updated, created).alias("published_date"))
    return found.withColumn("published_micros", i.micros(dates.instant(F.col("published_date"))))


# --- pages -----------------------------------------------------------------------


def page_text_sql(html: str) -> str:
    """The extraction rules again, for pages with an <article>."""
    t = rf"regexp_replace({html}, '(?is)<!--.*?-->', '', 'g')"
    for tag in ("script", "style", "noscript", "template"):
        t = rf"regexp_replace({t}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', '', 'g')"
    t = rf"regexp_extract({t}, '(?is)<article\b[^>]*>(.*)</article\b', 1)"
    for tag in ("nav", "footer", "aside", "header", "form"):
        t = rf"regexp_replace({t}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', '', 'g')"
    blocks = "p|br|h[1-6]|div|ul|ol|li|article|section|table|tr|td|blockquote|pre"
    t = rf"regexp_replace({t}, '(?i)</?(?:{blocks})\b[^>]*>', chr(10), 'g')"
    t = rf"regexp_replace({t}, '</?[A-Za-z][^>]*>|<[!?][^>]*>', '', 'g')"
    t = unescape_sql(t)
    t = rf"regexp_replace({t}, '[ \t\r\x0b\f\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g')"
    t = rf"regexp_replace({t}, ' ?\n[ \n]*', chr(10), 'g')"
    return i.strip_sql(t)


def unescape_sql(t: str) -> str:
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·")):
        t = f"replace({t}, '&{name};', '{char}')"
    return f"replace({t}, '&amp;', '&')"


TITLE = unescape_sql("regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1)")


@query("page_scan", "SELECT page_id, url, length(html) AS size FROM pages")
def page_scan(spark, sf_dir):
    pages = i.pages(spark, sf_dir)
    return pages.select("page_id", "url", F.length("html").cast("long").alias("size"))


@query("page_text", f"SELECT page_id, {page_text_sql('html')} AS content_text FROM pages")
def page_text(spark, sf_dir):
    return i.pages(spark, sf_dir).select("page_id", text.main_text(F.col("html")).alias("content_text"))


@query(
    "page_title",
    f"SELECT page_id, CASE WHEN url LIKE '%?%' THEN 'og ' || url ELSE {i.strip_sql(TITLE)} END AS title FROM pages",
)
def page_title(spark, sf_dir):
    og = F.concat(F.lit("<meta content='og "), "url", F.lit("' property='og:title'>"))
    html = F.when(F.col("url").contains("?"), F.concat(og, "html")).otherwise(F.col("html"))
    return i.pages(spark, sf_dir).select("page_id", text.page_title(html).alias("title"))


LINKS = r"""
links AS (
  SELECT page_id, url AS page_url, regexp_extract(url, '^[a-z]+://[^/?#]*') AS base_url,
    unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
    unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)))) AS pos
  FROM pages
)
"""


def _links(spark, sf_dir):
    base = F.regexp_extract("url", r"^[a-z]+://[^/?#]*", 0)
    listings = i.pages(spark, sf_dir).select(
        "page_id", F.col("url").alias("page_url"), base.alias("base_url"), "html"
    )
    return page_ops.page_links(listings)


@query("page_links", f"WITH {LINKS} SELECT page_id, CAST(pos AS BIGINT) AS pos, href FROM links")
def page_links(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", F.col("pos").cast("long").alias("pos"), "href")


# The driver's links are all rooted, so their position decides on a form.
FORMS = """
forms AS (
  SELECT page_id, base_url, pos, CASE pos WHEN 0 THEN href WHEN 1 THEN '/tag' || href
    WHEN 2 THEN 'https://docs.x.com' || href WHEN 3 THEN base_url || href || '?a=b#top'
    WHEN 4 THEN '/blog/tags' || href WHEN 5 THEN '/' || href
    WHEN 6 THEN '/About' || href ELSE 'mailto:' || href END AS href
  FROM links
)
"""


def _forms(spark, sf_dir):
    href, pos = F.col("href"), F.col("pos")
    formed = (
        F.when(pos == 0, href)
        .when(pos == 1, F.concat(F.lit("/tag"), href))
        .when(pos == 2, F.concat(F.lit("https://docs.x.com"), href))
        .when(pos == 3, F.concat("base_url", href, F.lit("?a=b#top")))
        .when(pos == 4, F.concat(F.lit("/blog/tags"), href))
        .when(pos == 5, F.concat(F.lit("/"), href))
        .when(pos == 6, F.concat(F.lit("/About"), href))
        .otherwise(F.concat(F.lit("mailto:"), href))
    )
    return _links(spark, sf_dir).select("page_id", "base_url", "pos", formed.alias("href"))


SKIPPED = r"""
regexp_matches(href, '(?i)^/?$|/tag/|/category/|/author/|/page/\d+|/search|/about|/contact|/products|/solutions|/platform|/company|/docs|/api|\.(jpg|png|gif|pdf|css|js)$|/careers|/jobs|/pricing|/terms|/privacy|/login|/signup')
"""
RESOLVED = f"""
{LINKS}, {FORMS},
resolved AS (
  SELECT *, CASE WHEN href LIKE '/%' THEN base_url || href ELSE href END AS url FROM forms
  WHERE href LIKE '/%' OR href LIKE 'http%'
),
on_site AS (
  SELECT * FROM resolved
  WHERE regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) = regexp_extract(base_url, '^[a-z]+://([^/?#]*)', 1)
    AND regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) NOT IN ('', '/')
)
"""


@query(
    "skip_links",
    f"WITH {LINKS}, {FORMS} SELECT page_id, CAST(pos AS BIGINT) AS pos, href FROM forms WHERE NOT {SKIPPED}",
)
def skip_links(spark, sf_dir):
    kept = page_ops.skip_links(_forms(spark, sf_dir))
    return kept.select("page_id", F.col("pos").cast("long").alias("pos"), "href")


@query("resolve_links", f"WITH {RESOLVED} SELECT page_id, href, url FROM resolved")
def resolve_links(spark, sf_dir):
    return page_ops.resolve_links(_forms(spark, sf_dir)).select("page_id", "href", "url")


@query("same_site_links", f"WITH {RESOLVED} SELECT page_id, url FROM on_site")
def same_site_links(spark, sf_dir):
    resolved = page_ops.resolve_links(_forms(spark, sf_dir))
    return page_ops.same_site(resolved).select("page_id", "url")


@query(
    "dedup_links",
    f"""WITH {RESOLVED}, sourced AS (
      SELECT regexp_extract(base_url, '://(.*)$', 1) AS source, url, page_id * 1000 + pos AS place FROM on_site)
    SELECT source, url, CAST(min(place) AS BIGINT) AS place FROM sourced GROUP BY ALL""",
)
def dedup_links(spark, sf_dir):
    links = page_ops.same_site(page_ops.resolve_links(_forms(spark, sf_dir)))
    source = urls.authority(F.col("base_url"))
    placed = links.select(source.alias("source"), "url", (F.col("page_id") * 1000 + F.col("pos")).alias("place"))
    return page_ops.dedup_links(placed, ["source", "url"], "place")


@query(
    "url_parts",
    r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS authority,
      regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages""",
)
def url_parts(spark, sf_dir):
    url = F.col("url")
    return i.pages(spark, sf_dir).select(
        "page_id", urls.authority(url).alias("authority"), urls.path(url).alias("path")
    )


# Pages whose URL has a query string were already taken.
CAPPED = f"""
seen AS (SELECT {i.HOST} AS source, url FROM pages WHERE url LIKE '%?%'),
found AS (SELECT {i.HOST} AS source, url, min(page_id) AS place FROM pages GROUP BY ALL)
"""


def seen_pages(spark, sf_dir):
    url = F.col("url")
    rows = i.pages(spark, sf_dir).where(url.contains("?"))
    return rows.select(urls.authority(url).alias("source"), "url")


@query(
    "page_cap",
    f"""WITH {CAPPED} SELECT source, url FROM found ANTI JOIN seen USING (source, url)
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY place) <= 3""",
)
def page_cap(spark, sf_dir):
    pages = i.pages(spark, sf_dir).select(urls.authority(F.col("url")).alias("source"), "url", "page_id")
    found = page_ops.dedup_links(pages, ["source", "url"], "page_id")
    fresh = unseen(found, seen_pages(spark, sf_dir), keep_blank=False)
    return page_ops.cap_pages(fresh, 3, "page_id").select("source", "url")


# Entries are headings of pages; pages whose URL has a fragment have no landed text.
@query(
    "enrich_short",
    f"""WITH entries AS (
      SELECT page_id, url, CASE WHEN url LIKE 'https%' THEN {TITLE} ELSE html END AS entry_text,
        CASE WHEN url LIKE '%#%' THEN NULL ELSE {page_text_sql('html')} END AS page_text
      FROM pages)
    SELECT page_id, CASE WHEN length(entry_text) < 200 AND length(page_text) > 200
        AND length(page_text) > length(entry_text) THEN page_text ELSE entry_text END AS content_text
    FROM entries""",
)
def enrich_short(spark, sf_dir):
    pages = i.pages(spark, sf_dir)
    heading = text.unescape(F.regexp_extract("html", "(?is)<h1>(.*?)</h1>", 1))
    content = F.when(F.col("url").startswith("https"), heading).otherwise(F.col("html"))
    entries = pages.select("page_id", "url", content.alias("content_text"))
    landed = pages.where(~F.col("url").contains("#"))
    return feed_ops.enrich_short(entries, landed).select("page_id", "content_text")


# --- page dates ------------------------------------------------------------------

PAGE_DAYS = """
days AS (
  SELECT page_id, url, html, strftime(DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER), '%Y-%m-%d') AS day
  FROM pages
)
"""


def _dated_pages(spark, sf_dir):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int"))
    return i.pages(spark, sf_dir).withColumn("day", day.cast("string"))


def _script(json_text):
    return F.concat(F.lit('<script type="application/ld+json">'), json_text, F.lit("</script>"))


def _jsonld_html():
    single = F.concat(F.lit('{"@type":"Article","datePublished":"'), "day", F.lit('T05:00:00Z"}'))
    listed = F.concat(F.lit('[{"name":"x"},{"datePublished":"","dateCreated":"'), "day", F.lit('"}]'))
    broken = F.concat(_script(F.lit("{broken")), _script(single))
    undated = _script(F.lit('{"datePublished":"not a date"}'))
    url = F.col("url")
    head = (
        F.when(url.contains("?"), _script(single))
        .when(url.contains("#"), _script(listed))
        .when(url.startswith("https"), broken)
        .otherwise(undated)
    )
    return F.concat(head, "html")


JSONLD = """
CASE WHEN url LIKE '%?%' THEN day || 'T05:00:00+00:00' WHEN url LIKE '%#%' THEN day || 'T00:00:00'
  WHEN url LIKE 'https%' THEN day || 'T05:00:00+00:00' END
"""


@query("jsonld_date", f"WITH {PAGE_DAYS} SELECT page_id, {JSONLD} AS published_date FROM days")
def jsonld_date(spark, sf_dir):
    found = dates.jsonld_date(_jsonld_html())
    return _dated_pages(spark, sf_dir).select("page_id", found.alias("published_date"))


def _meta_html():
    url = F.col("url")
    swapped = F.concat(F.lit('<meta content="'), "day", F.lit('" name="date">'))
    preferred = F.concat(F.lit('<meta property="article:published_time" content="'), "day", F.lit('T01:02:03Z"/>'))
    unreadable = F.concat(F.lit('<meta name="publish_date" content="soon">'), swapped)
    head = (
        F.when(url.contains("?"), F.concat(swapped, preferred))
        .when(url.contains("#"), unreadable)
        .when(url.startswith("https"), swapped)
        .otherwise("")
    )
    return F.concat(head, "html")


@query(
    "meta_date",
    f"""WITH {PAGE_DAYS} SELECT page_id, CASE WHEN url LIKE '%?%' THEN day || 'T01:02:03+00:00'
      WHEN url LIKE '%#%' OR url LIKE 'https%' THEN day || 'T00:00:00' END AS published_date FROM days""",
)
def meta_date(spark, sf_dir):
    return _dated_pages(spark, sf_dir).select("page_id", dates.meta_date(_meta_html()).alias("published_date"))


@query(
    "time_date",
    f"""WITH {PAGE_DAYS} SELECT page_id,
      CASE WHEN url LIKE '%?%' THEN day || 'T00:00:00' END AS published_date FROM days""",
)
def time_date(spark, sf_dir):
    first = F.when(F.col("url").contains("?"), F.col("day")).otherwise("unknown")
    html = F.concat(
        F.lit("<time>no date</time><time class='x' datetime='"), first,
        F.lit("'>t</time><time datetime='2001-01-01'></time>"), "html",
    )
    return _dated_pages(spark, sf_dir).select("page_id", dates.time_date(html).alias("published_date"))


URL_DAY = "CASE WHEN url LIKE '%?%' THEN NULL ELSE day || 'T00:00:00' END"


def _dated_url():
    slashes = F.concat(F.lit("https://x.com/"), F.replace(F.col("day"), F.lit("-"), F.lit("/")), F.lit("/t"))
    dashes = F.concat(F.lit("https://x.com/"), "day", F.lit("-t"))
    wrong = F.lit("https://x.com/2026/13/40/t")
    url = F.col("url")
    return F.when(url.contains("?"), wrong).when(url.contains("#"), slashes).otherwise(dashes)


@query("url_date", f"WITH {PAGE_DAYS} SELECT page_id, {URL_DAY} AS published_date FROM days")
def url_date(spark, sf_dir):
    return _dated_pages(spark, sf_dir).select("page_id", dates.url_date(_dated_url()).alias("published_date"))


@query(
    "page_date",
    f"""WITH {PAGE_DAYS} SELECT page_id, coalesce(
      CASE WHEN page_id % 5 = 0 THEN '2020-02-02T00:00:00' END, {JSONLD}, {URL_DAY}) AS published_date
    FROM days""",
)
def page_date(spark, sf_dir):
    own = F.when(F.col("page_id") % 5 == 0, "2020-02-02").otherwise("none")
    found = dates.page_date(_jsonld_html(), _dated_url(), own)
    return _dated_pages(spark, sf_dir).select("page_id", found.alias("published_date"))
