"""Articles: fields, filters, registry, store and documents."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from gleaner.functions import fields, text
from gleaner.operators import articles as article_ops, catalog, documents, filters, registry as reg, store
from gleaner.session import materialised, scratch_dir
from gleaner.sources import tables

from . import inputs as i
from .registering import query

# --- fields ----------------------------------------------------------------------


@query("article_id", f"WITH {i.ARTICLES} SELECT doc_id, id FROM articles")
def article_id(spark, sf_dir):
    raw = i.article_inputs(spark, sf_dir)
    return raw.select("doc_id", fields.article_id(F.col("source"), F.col("url")).alias("id"))


@query("word_count", f"SELECT doc_id, {i.words_sql('text')} AS word_count FROM documents")
def word_count(spark, sf_dir):
    docs = i.documents(spark, sf_dir)
    return docs.select("doc_id", text.word_count(F.col("text")).cast("long").alias("word_count"))


@query("summary", f"SELECT doc_id, {i.summary_sql('text')} AS summary FROM documents")
def summary(spark, sf_dir):
    docs = i.documents(spark, sf_dir)
    return docs.select("doc_id", text.summary(F.col("text")).alias("summary"))


@query(
    "reading_time",
    f"SELECT doc_id, greatest(1, {i.words_sql('text')} // 200) AS minutes FROM documents",
)
def reading_time(spark, sf_dir):
    docs = i.documents(spark, sf_dir)
    minutes = text.reading_minutes(text.word_count(F.col("text")))
    return docs.select("doc_id", minutes.cast("long").alias("minutes"))


@query(
    "article_projection",
    f"""WITH {i.ARTICLES}
    SELECT id, source, source_name, url, title, author, published_date,
      CAST(1714521600000000 AS BIGINT) AS scraped_at, content_text, summary, tags, word_count,
      greatest(1, word_count // 200) AS reading_time_minutes, 'rss' AS scrape_method
    FROM articles""",
)
def article_projection(spark, sf_dir):
    return _flat(i.articles(spark, sf_dir))


def _flat(rows):
    return rows.select(
        "id", "source", "source_name", "url", "title", "author", "published_date",
        i.micros(F.col("scraped_at")).alias("scraped_at"), "content_text", "summary",
        F.array_join("tags", ", ").alias("tags"),
        F.col("word_count").cast("long").alias("word_count"),
        F.col("metadata.reading_time_minutes").cast("long").alias("reading_time_minutes"),
        F.col("metadata.scrape_method").alias("scrape_method"),
    )


# --- filters ---------------------------------------------------------------------


@query(
    "lookback_filter",
    f"""WITH {i.ARTICLES} SELECT id, published_date FROM articles
    WHERE published_date IS NULL OR CAST(substr(published_date, 1, 10) AS DATE) >= DATE '2024-03-02'""",
)
def lookback_filter(spark, sf_dir):
    kept = filters.lookback_filter(i.articles(spark, sf_dir), i.AS_OF, 60)
    return kept.select("id", "published_date")


@query(
    "word_count_filter",
    f"WITH {i.ARTICLES} SELECT id, word_count FROM articles WHERE word_count BETWEEN 200 AND 50000",
)
def word_count_filter(spark, sf_dir):
    kept = filters.word_count_filter(i.articles(spark, sf_dir), 200, 50_000)
    return kept.select("id", F.col("word_count").cast("long").alias("word_count"))


@query(
    "keyword_filter",
    f"""WITH {i.ARTICLES} SELECT id, title FROM articles
    WHERE {i.keyword_sql("lower(title || ' ' || content_text)")}""",
)
def keyword_filter(spark, sf_dir):
    kept = filters.keyword_filter(i.articles(spark, sf_dir), i.FILTERS.keywords)
    return kept.select("id", "title")


@query("filter_reasons", f"WITH {i.ARTICLES}, {i.REASONS} SELECT id, reason FROM judged")
def filter_reasons(spark, sf_dir):
    judged = filters.with_reason(i.articles(spark, sf_dir), i.AS_OF, i.FILTERS)
    return judged.select("id", "reason")


@query(
    "exclude_urls",
    """SELECT doc_id, url FROM (
      SELECT doc_id, 'https://' || source || '.example.com/' || CASE lang WHEN 'de' THEN 'careers/'
        WHEN 'es' THEN 'Careers/' WHEN 'fr' THEN 'en/pricing-news/' ELSE '' END || doc_id AS url
      FROM documents)
    WHERE NOT (contains(url, '/careers') OR contains(url, '/jobs') OR contains(url, '/pricing')
      OR contains(url, '/terms') OR contains(url, '/privacy') OR contains(url, '/login')
      OR contains(url, '/signup'))""",
)
def exclude_urls(spark, sf_dir):
    section = (
        F.when(F.col("lang") == "de", "careers/")
        .when(F.col("lang") == "es", "Careers/")
        .when(F.col("lang") == "fr", "en/pricing-news/")
        .otherwise("")
    )
    url = F.concat(
        F.lit("https://"), "source", F.lit(".example.com/"), section, F.col("doc_id").cast("string")
    )
    docs = i.table(spark, sf_dir, "documents").select("doc_id", url.alias("url"))
    return filters.exclude_urls(docs)


@query(
    "required_fields",
    f"""WITH {i.ARTICLES} SELECT id, title FROM articles
    WHERE {i.strip_sql("title")} <> '' AND length(content_text) >= 200""",
)
def required_fields(spark, sf_dir):
    return article_ops.with_required_fields(i.articles(spark, sf_dir), 200).select("id", "title")


# --- registry --------------------------------------------------------------------


@query("registry_scan", f"WITH {i.REGISTRY} SELECT DISTINCT source, url FROM registry")
def registry_scan(spark, sf_dir):
    lines = i.registry(spark, sf_dir).select(
        F.to_json(F.create_map(F.col("source"), F.array("url", "url"))).alias("value")
    )
    return reg.registry_from_json(lines)


@query(
    "registry_build",
    f"""WITH {i.ARTICLES}, {i.REASONS}, {i.REGISTRY},
    rows AS (SELECT source, url FROM registry UNION SELECT source, url FROM judged WHERE reason IS NULL)
    SELECT source, count(*) AS n, string_agg(url, ' ' ORDER BY url) AS urls FROM rows GROUP BY source""",
)
def registry_build(spark, sf_dir):
    taken = filters.accepted(filters.with_reason(i.articles(spark, sf_dir), i.AS_OF, i.FILTERS))
    merged = materialised(reg.registry_union(i.registry(spark, sf_dir), taken))
    arrays = reg.registry_arrays(merged)
    return arrays.select(
        "source", F.size("urls").cast("long").alias("n"), F.array_join("urls", " ").alias("urls")
    )


@query(
    "registry_union",
    f"""WITH {i.ARTICLES}, {i.REASONS}, {i.REGISTRY}
    SELECT source, url FROM registry UNION SELECT source, url FROM judged WHERE reason IS NULL""",
)
def registry_union(spark, sf_dir):
    taken = filters.accepted(filters.with_reason(i.articles(spark, sf_dir), i.AS_OF, i.FILTERS))
    return reg.registry_union(i.registry(spark, sf_dir), taken)


@query("registry_sink", f"WITH {i.REGISTRY} SELECT DISTINCT source, url FROM registry")
def registry_sink(spark, sf_dir):
    path = scratch_dir(spark, "registry") + "/urls"
    tables.export_registry(i.registry(spark, sf_dir), path)
    return tables.import_registry(spark, path)


@query(
    "registry_size",
    f"WITH {i.REGISTRY} SELECT count(*) AS urls, count(DISTINCT source) AS sources FROM registry",
)
def registry_size(spark, sf_dir):
    return reg.registry_size(i.registry(spark, sf_dir))


@query(
    "unseen_urls",
    f"""WITH {i.ARTICLES}, {i.REGISTRY}
    SELECT id, source, url FROM articles ANTI JOIN registry USING (source, url)""",
)
def unseen_urls(spark, sf_dir):
    rows = i.articles(spark, sf_dir).select("id", "source", "url")
    return reg.unseen(rows, i.registry(spark, sf_dir))


@query(
    "new_urls",
    f"""WITH {i.ARTICLES}, {i.REGISTRY}
    SELECT source, url FROM articles EXCEPT SELECT source, url FROM registry""",
)
def new_urls(spark, sf_dir):
    return reg.new_urls(i.articles(spark, sf_dir), i.registry(spark, sf_dir))


@query(
    "rescrape_plan",
    f"""WITH {i.ARTICLES}, {i.REGISTRY}
    SELECT 'forced' AS mode, source, count(*) AS candidates FROM articles GROUP BY source
    UNION ALL
    SELECT 'normal', source, count(*) FROM articles ANTI JOIN registry USING (source, url)
    GROUP BY source""",
)
def rescrape_plan(spark, sf_dir):
    rows = i.articles(spark, sf_dir).select("source", "url")
    modes = {"forced": replace(i.PARAMS, force_rescrape=True), "normal": i.PARAMS}
    planned = [
        (rows if p.force_rescrape else reg.unseen(rows, i.registry(spark, sf_dir), keep_blank=False))
        .groupBy("source")
        .agg(F.count("*").alias("candidates"))
        .withColumn("mode", F.lit(mode))
        for mode, p in modes.items()
    ]
    return planned[0].unionByName(planned[1])


# --- store -----------------------------------------------------------------------

# Run 2 replaces the articles of documents labelled toxic.
VERSIONS = f"""
{i.ARTICLES},
versions AS (
  SELECT *, 1 AS run_seq FROM articles
  UNION ALL
  SELECT * REPLACE ('Revised: ' || title AS title), 2 FROM articles
  SEMI JOIN (SELECT doc_id FROM labels WHERE toxic = 1) USING (doc_id)
),
newest AS (
  SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY id ORDER BY run_seq DESC) = 1
)
"""


def _runs(spark, sf_dir):
    first = i.articles(spark, sf_dir, keep=("doc_id",))
    toxic = i.table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    second = first.join(toxic, "doc_id", "left_semi")
    second = second.withColumn("title", F.concat(F.lit("Revised: "), "title"))
    return first.drop("doc_id"), second.drop("doc_id")


@query("latest_article", f"WITH {VERSIONS} SELECT id, title, run_seq FROM newest")
def latest_article(spark, sf_dir):
    first, second = _runs(spark, sf_dir)
    versions = first.withColumn("run_seq", F.lit(1).cast("long")).unionByName(
        second.withColumn("run_seq", F.lit(2).cast("long"))
    )
    return store.latest(versions).select("id", "title", "run_seq")


@query(
    "manifest_upsert",
    f"""WITH {VERSIONS} SELECT source, id, url, title, published_date,
      CAST(1714521600000000 AS BIGINT) AS scraped_at, run_seq FROM newest""",
)
def manifest_upsert(spark, sf_dir):
    first, second = _runs(spark, sf_dir)
    merged = store.manifest_upsert(store.manifest_rows(first, 1), store.manifest_rows(second, 2))
    return merged.withColumn("scraped_at", i.micros(F.col("scraped_at")))


def _stored(spark, sf_dir):
    path = scratch_dir(spark, "store") + "/store"
    for run_seq, rows in enumerate(_runs(spark, sf_dir), start=1):
        tables.save_articles(rows, path, run_seq)
        tables.save_manifest(rows, path, run_seq)
    return path


@query("save_articles", f"WITH {VERSIONS} SELECT id, source, title, summary, word_count FROM newest")
def save_articles(spark, sf_dir):
    rows = tables.read_articles(spark, _stored(spark, sf_dir))
    return rows.select(
        "id", "source", "title", "summary", F.col("word_count").cast("long").alias("word_count")
    )


@query(
    "export_articles",
    f"""WITH {VERSIONS} SELECT id, source, source_name, url, title, author, published_date,
      CAST(1714521600000000 AS BIGINT) AS scraped_at, content_text, summary, tags, word_count,
      greatest(1, word_count // 200) AS reading_time_minutes, 'rss' AS scrape_method
    FROM newest""",
)
def export_articles(spark, sf_dir):
    return _flat(tables.read_articles(spark, _stored(spark, sf_dir)))


@query("list_articles", f"WITH {VERSIONS} SELECT id, source, url, title, published_date FROM newest")
def list_articles(spark, sf_dir):
    manifest = tables.read_manifest(spark, _stored(spark, sf_dir))
    return store.list_articles(manifest).drop("scraped_at")


@query(
    "listed_sources",
    f"""WITH {i.ARTICLES} SELECT source, id, url FROM articles
    WHERE source IN (SELECT source FROM articles WHERE word_count > 1000)""",
)
def listed_sources(spark, sf_dir):
    rows = i.articles(spark, sf_dir)
    stored = filters.word_count_filter(rows, 1001)
    return store.listed_sources(store.manifest_rows(rows), stored).select("source", "id", "url")


@query(
    "load_article",
    f"""WITH {VERSIONS} SELECT id, title, content_text FROM newest
    WHERE source = 'src1' AND id = 'src1_' || substr(md5('https://src1.example.com/1'), 1, 12)""",
)
def load_article(spark, sf_dir):
    path = _stored(spark, sf_dir)
    wanted = fields.article_id(F.lit("src1"), F.lit("https://src1.example.com/1"))
    return tables.load_article(spark, path, "src1", wanted).select("id", "title", "content_text")


@query(
    "clear_source",
    f"""WITH {i.ARTICLES} SELECT source, count(*) AS remaining,
      (SELECT count(*) FROM articles WHERE source = 'src1') AS removed
    FROM articles WHERE source <> 'src1' GROUP BY source""",
)
def clear_source(spark, sf_dir):
    path = _stored(spark, sf_dir)
    removed = tables.clear_source(spark, path, "src1")
    rows = tables.read_articles(spark, path).groupBy("source").agg(F.count("*").alias("remaining"))
    return rows.withColumn("removed", F.lit(removed).cast("long"))


@query(
    "clear_counts",
    f"""WITH {i.ARTICLES} SELECT count(*) FILTER (WHERE source = 'src1') AS removed,
      count(*) FILTER (WHERE source <> 'src1') AS remaining FROM articles""",
)
def clear_counts(spark, sf_dir):
    return store.clear_counts(i.articles(spark, sf_dir), "src1")


@query("scraped_urls", f"WITH {i.ARTICLES} SELECT DISTINCT url FROM articles")
def scraped_urls(spark, sf_dir):
    return store_urls(i.articles(spark, sf_dir))


def store_urls(rows):
    return reg.scraped_urls(store.manifest_rows(rows))


@query(
    "manifest_totals",
    f"""WITH {VERSIONS} SELECT source, count(DISTINCT id) AS total_articles,
      CAST(1714521600000000 AS BIGINT) AS last_updated FROM versions GROUP BY source""",
)
def manifest_totals(spark, sf_dir):
    first, second = _runs(spark, sf_dir)
    rows = store.manifest_rows(first, 1).unionByName(store.manifest_rows(second, 2))
    totals = store.manifest_totals(rows)
    return totals.withColumn("last_updated", i.micros(F.col("last_updated")))


@query(
    "html_snapshots",
    f"SELECT {i.HOST} AS source, url AS id, html AS content_html FROM pages WHERE url LIKE '%?%'",
)
def html_snapshots(spark, sf_dir):
    from gleaner.functions import urls

    path = scratch_dir(spark, "snapshots") + "/store"
    with_html = F.when(F.col("url").contains("?"), F.col("html")).otherwise("")
    rows = i.pages(spark, sf_dir).select(
        urls.authority(F.col("url")).alias("source"), F.col("url").alias("id"), with_html.alias("content_html"), "page_id"
    )
    # a URL that was read twice: its later page is the newer version
    tables.save_html_snapshots(rows, path, 1, newest_by=["page_id"])
    return tables.read_html_snapshots(spark, path).select("source", "id", "content_html")


# --- documents -------------------------------------------------------------------

BODY = """
'# ' || title || CASE WHEN published_date IS NULL THEN '' ELSE ' | ' || substr(published_date, 1, 10) END
|| chr(10) || chr(10) || '## Metadata' || chr(10) || '- Source: ' || source_name || chr(10)
|| '- URL: ' || url || chr(10) || '- Author: ' || author || chr(10) || '- Tags: ' || tags || chr(10)
|| '- Word Count: ' || word_count || chr(10) || chr(10)
|| CASE WHEN summary = '' THEN '' ELSE '## Summary' || chr(10) || summary || chr(10) || chr(10) END
|| '## Content' || chr(10) || content_text
"""
NAME = """
source || CASE WHEN published_date IS NULL THEN '' ELSE '_' || substr(published_date, 1, 10) END
|| '_' || substr(md5(url), 1, 12) || '.txt'
"""


@query("render_document", f"WITH {i.ARTICLES} SELECT id, {BODY} AS body FROM articles")
def render_document(spark, sf_dir):
    return i.articles(spark, sf_dir).select("id", fields.document_body().alias("body"))


@query("document_filename", f"WITH {i.ARTICLES} SELECT id, {NAME} AS filename FROM articles")
def document_filename(spark, sf_dir):
    name = fields.document_name(F.col("id"), F.col("published_date"))
    return i.articles(spark, sf_dir).select("id", name.alias("filename"))


METADATA_KEYS = ("source", "url", "author", "published_date", "tags", "word_count")


@query(
    "document_metadata",
    f"""WITH {i.ARTICLES} SELECT id, source_name AS source, url, author,
      coalesce(published_date, 'None') AS published_date, tags,
      CAST(word_count AS VARCHAR) AS word_count FROM articles""",
)
def document_metadata(spark, sf_dir):
    rows = i.articles(spark, sf_dir).select("id", fields.document_metadata().alias("m"))
    return rows.select("id", *[F.col("m")[k].alias(k) for k in METADATA_KEYS])


@query(
    "document_out",
    f"WITH {i.ARTICLES} SELECT {NAME} AS filename, {BODY} AS body, url FROM articles",
)
def document_out(spark, sf_dir):
    path = scratch_dir(spark, "documents") + "/store"
    tables.save_documents(i.articles(spark, sf_dir), path, 1)
    stored = tables.read_documents(spark, path)
    return stored.select("filename", "body", F.col("metadata")["url"].alias("url"))


def _delivery_log(spark, sf_dir):
    """Documents with a label were delivered, the others failed."""
    rows = i.articles(spark, sf_dir, keep=("doc_id",)).select("doc_id", "id", "source", "url")
    labels = i.table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("sent"))
    named = F.when(F.col("sent"), F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))
    joined = rows.join(labels, "doc_id", "left")
    return joined.select(F.col("id").alias("article_id"), "url", named.alias("document_id"), "source")


DELIVERED = f"""
{i.ARTICLES},
delivery AS (
  SELECT id AS article_id, url, source, CASE WHEN l.doc_id IS NOT NULL THEN 'doc-' || a.doc_id END AS document_id
  FROM articles a LEFT JOIN labels l ON a.doc_id = l.doc_id
)
"""


@query(
    "delivery_summary",
    f"""WITH {DELIVERED} SELECT count(*) AS total, count(document_id) AS successful,
      count(*) - count(document_id) AS failed, CAST(NULL AS VARCHAR) AS error FROM delivery""",
)
def delivery_summary(spark, sf_dir):
    return documents.delivery_summary(_delivery_log(spark, sf_dir))


@query(
    "delivery_items",
    f"""WITH {DELIVERED} SELECT source,
      CASE WHEN document_id IS NULL THEN 'failed' ELSE 'delivered' END AS outcome, article_id,
      document_id, CASE WHEN document_id IS NULL THEN url END AS url FROM delivery""",
)
def delivery_items(spark, sf_dir):
    return documents.delivery_items(_delivery_log(spark, sf_dir))


@query(
    "scrape_method",
    f"""WITH {i.SITES}, combined AS (
      SELECT DISTINCT source AS source_id, 'rss' AS method FROM documents
      UNION ALL SELECT source_id, 'html' FROM sites)
    SELECT source_id, method AS scrape_method FROM combined""",
)
def scrape_method(spark, sf_dir):
    both = i.feed_catalog(spark, sf_dir).unionByName(i.site_catalog(spark, sf_dir))
    return both.select("source_id", catalog.scrape_method(F.col("method")).alias("scrape_method"))
