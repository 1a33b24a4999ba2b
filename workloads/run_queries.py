"""Counters, spacing, whole runs and streams."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from gleaner.functions import urls
from gleaner.operators import filters, metrics, pages as page_ops, politeness
from gleaner.operators.articles import project_articles, with_required_fields
from gleaner.operators.registry import unseen
from gleaner.operators.skew import first_per_group
from gleaner.functions.fields import retry_delay
from gleaner.params import FilterParams
from gleaner.plans.commit import commit_run, run_log
from gleaner.plans.runs import feed_run, page_run, unified_run
from gleaner.session import scratch_dir
from gleaner.sources import tables
from gleaner.streaming import ingest

from . import inputs as i
from .registering import query
from .source_queries import CAPPED, SKIPPED, TITLE, page_text_sql, seen_pages

# --- counters --------------------------------------------------------------------

COUNTED = """
CAST(coalesce(sum(n) FILTER (WHERE kind = 'scraped'), 0) AS BIGINT) AS {0}scraped,
CAST(coalesce(sum(n) FILTER (WHERE kind = 'uploaded'), 0) AS BIGINT) AS {0}uploaded,
CAST(coalesce(sum(n) FILTER (WHERE kind = 'skipped'), 0) AS BIGINT) AS {0}skipped
"""


@query(
    "source_counters",
    f"""WITH {i.RUN_LOG} SELECT source, {COUNTED.format("")},
      count(*) FILTER (WHERE kind = 'error') AS errors FROM run_log GROUP BY source""",
)
def source_counters(spark, sf_dir):
    return metrics.source_counters(i.run_log(spark, sf_dir))


@query(
    "run_totals",
    f"""WITH {i.RUN_LOG} SELECT epoch_us(min(ts)) AS start_time, epoch_us(max(ts)) AS end_time,
      (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_seconds, {COUNTED.format("total_")},
      count(*) FILTER (WHERE kind = 'error') AS total_errors FROM run_log""",
)
def run_totals(spark, sf_dir):
    totals = metrics.run_totals(i.run_log(spark, sf_dir))
    return totals.withColumns({c: i.micros(F.col(c)) for c in ("start_time", "end_time")})


@query(
    "metrics_by_source",
    f"""WITH {i.RUN_LOG}, log2 AS (SELECT 'user' || split_part(split_part(url, '/', 4), '?', 1) AS source, kind, n
      FROM run_log WHERE kind <> 'error')
    SELECT source, {COUNTED.format("")} FROM log2 GROUP BY source""",
)
def metrics_by_source(spark, sf_dir):
    user = F.concat(F.lit("user"), F.regexp_extract("url", r"/(\d+)\?", 1))
    log = i.run_log(spark, sf_dir).withColumn("source", user)
    parts = [
        log.where(F.col("kind") == k).groupBy("source").agg(F.sum("n").alias("n"))
        for k in metrics.KINDS
    ]
    return metrics.merge_counters(*parts)


@query(
    "first_errors",
    f"""WITH {i.RUN_LOG} SELECT source, epoch_us(ts) AS ts, substr(url, 1, 50) AS url,
      substr(error, 1, 100) AS error FROM run_log WHERE kind = 'error' ORDER BY run_log.ts, run_log.url LIMIT 10""",
)
def first_errors(spark, sf_dir):
    rows = metrics.first_errors(i.run_log(spark, sf_dir), 10)
    return rows.withColumn("ts", i.micros(F.col("ts")))


REPORT = f"""
{i.RUN_LOG},
counted AS (
  SELECT source, {COUNTED.format("")}, count(*) FILTER (WHERE kind = 'error') AS errors
  FROM run_log GROUP BY source
),
long AS (UNPIVOT counted ON scraped, uploaded, skipped, errors INTO NAME kind VALUE value)
SELECT 'by_source' AS section, source, kind, value FROM long
UNION ALL SELECT 'total', NULL, kind, CAST(sum(value) AS BIGINT) FROM long GROUP BY kind
"""


@query("run_report", f"WITH {REPORT}")
def run_report(spark, sf_dir):
    path = scratch_dir(spark, "report") + "/report"
    tables.save_report(metrics.run_report(i.run_log(spark, sf_dir)), path)
    return spark.read.schema("section STRING, source STRING, kind STRING, value BIGINT").json(path)


@query(
    "reason_counts",
    f"""WITH {i.ARTICLES}, {i.REASONS}
    SELECT source, coalesce(reason, 'accepted') AS reason, count(*) AS n FROM judged GROUP BY ALL""",
)
def reason_counts(spark, sf_dir):
    judged = filters.with_reason(i.articles(spark, sf_dir), i.AS_OF, i.FILTERS)
    return metrics.reason_counts(judged)


# --- spacing and retries ---------------------------------------------------------

DELAYED = f"""
{i.REQUESTS},
delayed AS (
  SELECT requests.*, epoch_us(ts) AS arrival, coalesce(delay, 2.0) AS delay,
    CAST(coalesce(delay, 2.0) * 1000000 AS BIGINT) AS step
  FROM requests LEFT JOIN delays USING (domain)
)
"""


def _delayed(spark, sf_dir):
    return politeness.with_delay(i.requests(spark, sf_dir), i.delays(spark, sf_dir))


@query("domain_delay", f"WITH {DELAYED} SELECT request_id, domain, CAST(delay AS DOUBLE) AS delay FROM delayed")
def domain_delay(spark, sf_dir):
    return _delayed(spark, sf_dir).select("request_id", "domain", "delay")


@query(
    "politeness_schedule",
    f"""WITH {DELAYED}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY domain ORDER BY arrival, request_id) - 1 AS i FROM delayed),
    placed AS (
      SELECT *, CAST(step * i + max(arrival - step * i) OVER (PARTITION BY domain ORDER BY i) AS BIGINT) AS start_micros
      FROM numbered)
    SELECT request_id, domain, start_micros, (start_micros - arrival) / 1e6 AS wait_seconds FROM placed""",
)
def politeness_schedule(spark, sf_dir):
    plan = politeness.politeness_schedule(_delayed(spark, sf_dir))
    return plan.select("request_id", "domain", "start_micros", "wait_seconds")


@query(
    "can_request",
    f"""WITH {DELAYED} SELECT request_id, domain,
      coalesce(arrival - lag(arrival) OVER (PARTITION BY domain ORDER BY arrival, request_id) >= step, true) AS can_request
    FROM delayed""",
)
def can_request(spark, sf_dir):
    return politeness.can_request(_delayed(spark, sf_dir)).select("request_id", "domain", "can_request")


FAILURES = """
failures AS (
  SELECT event_id, CAST(event_id % 6 AS INTEGER) AS attempt,
    CASE WHEN user_id = 3 THEN 'SystemExit' ELSE 'Timeout' END AS error
  FROM events WHERE event_type = 'error'
)
"""


@query(
    "retry_delay",
    f"""WITH {FAILURES} SELECT event_id, least(1.0 * power(2.0, attempt * 2), 60.0) AS delay_seconds FROM failures""",
)
def retry_delays(spark, sf_dir):
    return i.failures(spark, sf_dir).select(
        "event_id", retry_delay(F.col("attempt") * 2).alias("delay_seconds")
    )


@query(
    "retry_plan",
    f"""WITH {FAILURES} SELECT event_id, attempt < 3 AND error <> 'SystemExit' AS retry,
      CASE WHEN attempt < 3 AND error <> 'SystemExit' THEN least(power(2.0, attempt), 60.0) END AS delay_seconds
    FROM failures""",
)
def retry_plan(spark, sf_dir):
    return politeness.retry_plan(i.failures(spark, sf_dir)).select("event_id", "retry", "delay_seconds")


@query(
    "retry_schedule",
    f"""WITH {FAILURES}, left_over AS (
      SELECT event_id, CAST(unnest(range(attempt, 3)) AS BIGINT) AS next_attempt FROM failures)
    SELECT event_id, next_attempt, least(power(2.0, next_attempt), 60.0) AS delay_seconds FROM left_over""",
)
def retry_schedule(spark, sf_dir):
    rows = politeness.retry_schedule(i.failures(spark, sf_dir))
    return rows.select("event_id", F.col("next_attempt").cast("long").alias("next_attempt"), "delay_seconds")


# --- whole runs ------------------------------------------------------------------

# Entries are single lines, so the word limit is low; the keywords are the common
# words of the four languages.
LINE_FILTERS = FilterParams(lookback_days=60, min_words=5, max_words=None, keywords=("the", "la ", "und"))
FEED_PARAMS = replace(i.PARAMS, filters=LINE_FILTERS)

ENTRY_ARTICLES = f"""
built AS (
  SELECT source_id AS source, fetched_at, pos, link AS url, title, content_text,
    source_id || '_' || substr(md5(link), 1, 12) AS id,
    CASE WHEN lang = 'en' THEN 'Feed Writer' ELSE 'A, B' END AS author,
    CASE WHEN lang = 'en' THEN 'corpus, en, line' ELSE 'corpus, line' END AS tags,
    CASE WHEN lang = 'en' THEN strftime(day, '%Y-%m-%dT10:00:00+00:00')
      ELSE strftime(day, '%Y-%m-%dT23:30:00-05:00') END AS published_date,
    CASE WHEN lang = 'en' THEN day + INTERVAL 10 HOUR ELSE day + INTERVAL '28 hours 30 minutes' END AS published,
    {i.words_sql("content_text")} AS word_count
  FROM candidates
),
judged AS (
  SELECT *, CASE WHEN published < TIMESTAMP '2024-03-02' THEN 'too_old'
    WHEN word_count < 5 THEN 'word_count'
    WHEN NOT (contains(t, 'the') OR contains(t, 'la ') OR contains(t, 'und')) THEN 'keyword' END AS reason
  FROM (SELECT *, lower(title || ' ' || content_text) AS t FROM built)
)
"""
CAPPED_ENTRIES = f"""
{i.ENTRIES},
capped AS (
  SELECT * FROM entries
  QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, pos) <= 50
)
"""
# The first entry of every labelled document was already taken.
FEED_RUN = f"""
{CAPPED_ENTRIES},
candidates AS (
  SELECT * FROM capped WHERE title <> '' AND NOT (pos = 0 AND doc_id IN (SELECT doc_id FROM labels))
),
{ENTRY_ARTICLES}
"""
FIRST_FEED_RUN = f"{CAPPED_ENTRIES}, candidates AS (SELECT * FROM capped WHERE title <> ''), {ENTRY_ARTICLES}"


def _seen_entries(spark, sf_dir):
    return i.registry(spark, sf_dir).withColumn("url", F.concat("url", F.lit("/0")))


def _feed_run(spark, sf_dir):
    return feed_run(
        i.feeds(spark, sf_dir), i.feed_catalog(spark, sf_dir), _seen_entries(spark, sf_dir), FEED_PARAMS
    )


@query(
    "feed_run",
    f"""WITH {FEED_RUN} SELECT id, source, url, title, author, published_date, tags, word_count,
      {i.summary_sql("content_text")} AS summary, reason FROM judged""",
)
def feed_run_query(spark, sf_dir):
    return _feed_run(spark, sf_dir).select(
        "id", "source", "url", "title", "author", "published_date",
        F.array_join("tags", ", ").alias("tags"), F.col("word_count").cast("long").alias("word_count"),
        "summary", "reason",
    )


PAGE_FILTERS = FilterParams(keywords=("the", "la ", "und"))
PAGE_PARAMS = replace(i.PARAMS, max_per_source=3, filters=PAGE_FILTERS)

PAGE_RUN = f"""
{CAPPED},
chosen AS (
  SELECT source, url FROM (SELECT *, url AS href FROM found) WHERE NOT {SKIPPED}
    AND regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) NOT IN ('', '/')
    AND (source, url) NOT IN (SELECT (source, url) FROM seen)
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY place) <= 3
),
extracted AS (
  SELECT source, url, {i.strip_sql(TITLE)} AS title, {page_text_sql("html")} AS content_text
  FROM chosen JOIN (SELECT url, html FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1)
    USING (url)
),
page_articles AS (
  SELECT *, source || '_' || substr(md5(url), 1, 12) AS id, 'Site ' || source AS author,
    {i.words_sql("content_text")} AS word_count,
    array_to_string(list_sort(['page', split_part(source, '.', -1)]), ', ') AS tags
  FROM extracted WHERE length(content_text) >= 200 AND title <> ''
),
page_judged AS (
  SELECT *, CASE WHEN word_count < 200 THEN 'word_count'
    WHEN NOT (contains(t, 'the') OR contains(t, 'la ') OR contains(t, 'und')) THEN 'keyword' END AS reason
  FROM (SELECT *, lower(title || ' ' || content_text) AS t FROM page_articles)
)
"""


def _listings(spark, sf_dir):
    """Every page is announced by a listing fragment of its host."""
    url = F.col("url")
    return i.pages(spark, sf_dir).select(
        urls.authority(url).alias("source_id"), "page_id",
        F.concat(F.lit('<li><a class="post" href="'), url, F.lit('">post</a></li>')).alias("html"),
    )


def _page_run(spark, sf_dir):
    return page_run(
        _listings(spark, sf_dir), i.pages(spark, sf_dir), i.site_catalog(spark, sf_dir), seen_pages(spark, sf_dir), PAGE_PARAMS
    )


def _unified_run(spark, sf_dir):
    seen = _seen_entries(spark, sf_dir).select("source", "url").unionByName(seen_pages(spark, sf_dir).select("source", "url"))
    return unified_run(
        i.feeds(spark, sf_dir), _listings(spark, sf_dir), i.pages(spark, sf_dir), _whole_catalog(spark, sf_dir), seen, FEED_PARAMS, PAGE_PARAMS
    )


def _whole_catalog(spark, sf_dir):
    return i.feed_catalog(spark, sf_dir).unionByName(i.site_catalog(spark, sf_dir))


@query(
    "page_run",
    f"""WITH {PAGE_RUN} SELECT id, source, url, title, author, tags, word_count,
      {i.summary_sql("content_text")} AS summary, 'html' AS scrape_method, reason FROM page_judged""",
)
def page_run_query(spark, sf_dir):
    return _page_run(spark, sf_dir).select(
        "id", "source", "url", "title", "author", F.array_join("tags", ", ").alias("tags"),
        F.col("word_count").cast("long").alias("word_count"), "summary",
        F.col("metadata.scrape_method").alias("scrape_method"), "reason",
    )


@query(
    "scrape_all",
    f"""WITH {FEED_RUN}, {PAGE_RUN}
    SELECT source, id, 'rss' AS scrape_method FROM judged WHERE reason IS NULL
    UNION ALL SELECT source, id, 'html' FROM page_judged WHERE reason IS NULL""",
)
def scrape_all(spark, sf_dir):
    rows = filters.accepted(_unified_run(spark, sf_dir))
    return rows.select("source", "id", F.col("metadata.scrape_method").alias("scrape_method"))


@query(
    "unified_report",
    f"""WITH {FEED_RUN}, {PAGE_RUN},
    taken AS (SELECT source FROM judged WHERE reason IS NULL UNION ALL SELECT source FROM page_judged WHERE reason IS NULL),
    asked AS (SELECT source FROM documents UNION SELECT {i.HOST} FROM pages)
    SELECT a.source, count(t.source) AS scraped, CAST(0 AS BIGINT) AS uploaded,
      CAST(CASE WHEN count(t.source) = 0 THEN 1 ELSE 0 END AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS errors
    FROM asked a LEFT JOIN taken t USING (source) WHERE a.source IS NOT NULL GROUP BY a.source""",
)
def unified_report(spark, sf_dir):
    path = scratch_dir(spark, "unified") + "/store"
    asked = [r["source_id"] for r in _whole_catalog(spark, sf_dir).select("source_id").distinct().collect() if r["source_id"]]
    commit_run(_unified_run(spark, sf_dir), path, "run", replace(FEED_PARAMS, dry_run=True), sources=asked)
    return metrics.source_counters(run_log(spark, path, "run")).where("source IS NOT NULL")


# --- flagship --------------------------------------------------------------------


@query(
    "page_corpus",
    f"""WITH {CAPPED.replace("min(page_id) AS place", "min(page_id) AS place, any_value(html) AS html")},
    articles AS (SELECT *, {page_text_sql("html")} AS content_text, {i.strip_sql(TITLE)} AS title FROM found),
    counted AS (SELECT *, {i.words_sql("content_text")} AS word_count FROM articles),
    kept AS (
      SELECT * FROM counted ANTI JOIN seen USING (source, url)
      WHERE length(content_text) >= 200 AND title <> '' AND word_count BETWEEN 200 AND 50000
      QUALIFY row_number() OVER (PARTITION BY source ORDER BY place) <= 50)
    SELECT source, count(*) AS n_articles, CAST(sum(word_count) AS BIGINT) AS n_words FROM kept GROUP BY source""",
)
def page_corpus(spark, sf_dir):
    """Pages to articles: text, title, length, seen URLs, cap, totals per host."""
    pages = i.pages(spark, sf_dir).withColumn("source", urls.authority(F.col("url")))
    inputs = with_required_fields(page_ops.extract_pages(pages), 200).withColumns(
        {
            "source_name": F.col("source"), "method": F.lit("html"), "author": F.lit(""),
            "tags": F.array(F.lit("page")),
        }
    )
    built = project_articles(inputs, i.AS_OF, keep=("page_id",))
    right_size = filters.word_count_filter(built, 200, 50_000)
    # pages are read once and in place: only ids and counts reach the registry join
    narrow = right_size.select("source", "url", "page_id", "word_count")
    fresh = unseen(narrow, seen_pages(spark, sf_dir), keep_blank=False)
    kept = first_per_group(fresh, ["source"], [F.col("page_id")], 50)
    return kept.groupBy("source").agg(
        F.count("*").alias("n_articles"), F.sum("word_count").alias("n_words")
    )


# --- streams ---------------------------------------------------------------------


def _drain(frame, path):
    """Run a stream over everything that has landed and read its output back."""
    writer = frame.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
    writer.trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{path}/out")


def _landed_articles(spark, sf_dir):
    """The documents as a stream; the same title in a source is the same URL."""
    schema = i.table(spark, sf_dir, "documents").schema
    # the table may be one file or a folder of part files; a plain path to a stream must be a folder, a pattern need not
    docs = ingest.read_landed(spark, f"{sf_dir}/documents.parque[t]", schema)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 120).cast("int"))
    title = F.substring_index("text", "\n", 1)
    rows = docs.select(
        "source", F.col("source").alias("source_name"), F.lit("rss").alias("method"),
        F.concat(F.lit("https://"), "source", F.lit("/"), F.md5(title)).alias("url"),
        title.alias("title"), F.lit("").alias("author"),
        F.when(F.col("lang") != "es", F.concat(day.cast("string"), F.lit("T00:00:00+00:00"))).alias("published_date"),
        F.col("text").alias("content_text"), F.array(F.col("lang")).alias("tags"), "doc_id",
    )
    return project_articles(rows, i.AS_OF, keep=("doc_id",))


STREAMED = f"""{i.ARTICLES}, {i.REASONS}"""


@query(
    "stream_dedup",
    f"""WITH {STREAMED} SELECT DISTINCT source, 'https://' || source || '/' || md5(title) AS url
    FROM judged WHERE reason IS NULL""",
)
def stream_dedup(spark, sf_dir):
    rows = ingest.dedup_stream(_landed_articles(spark, sf_dir), i.AS_OF, i.FILTERS)
    return _drain(rows.select("source", "url"), scratch_dir(spark, "dedup"))


@query(
    "stream_lookback",
    f"""WITH {STREAMED} SELECT doc_id, published_date FROM judged WHERE reason IS DISTINCT FROM 'too_old'""",
)
def stream_lookback(spark, sf_dir):
    rows = ingest.lookback_stream(_landed_articles(spark, sf_dir), i.AS_OF, 60)
    return _drain(rows.select("doc_id", "published_date"), scratch_dir(spark, "lookback"))


def _ingested(spark, sf_dir):
    base = scratch_dir(spark, "ingest")
    i.feeds(spark, sf_dir).write.parquet(f"{base}/landing")
    for _ in range(2):  # the second run finds nothing new
        ingest.start_feed_ingest(
            spark, f"{base}/landing", i.feed_catalog(spark, sf_dir), f"{base}/store", f"{base}/checkpoint", FEED_PARAMS
        ).awaitTermination()
    return f"{base}/store"


@query(
    "stream_ingest",
    f"""WITH {FIRST_FEED_RUN} SELECT id, source, title, published_date, word_count FROM judged WHERE reason IS NULL""",
)
def stream_ingest(spark, sf_dir):
    rows = tables.read_articles(spark, _ingested(spark, sf_dir))
    return rows.select(
        "id", "source", "title", "published_date", F.col("word_count").cast("long").alias("word_count")
    )


@query(
    "stream_sinks",
    f"""WITH {FIRST_FEED_RUN}, taken AS (SELECT * FROM judged WHERE reason IS NULL),
    sinks AS (SELECT unnest(['articles', 'manifest', 'registry', 'documents']) AS sink)
    SELECT sink, source, count(*) AS n FROM taken, sinks GROUP BY ALL""",
)
def stream_sinks(spark, sf_dir):
    path = _ingested(spark, sf_dir)
    sinks = {
        "articles": tables.read_articles(spark, path),
        "manifest": tables.read_manifest(spark, path),
        "registry": tables.read_registry(spark, path),
        "documents": tables.read_documents(spark, path),
    }
    rows = None
    for sink, frame in sinks.items():
        part = frame.select(F.lit(sink).alias("sink"), "source")
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("sink", "source").agg(F.count("*").alias("n"))
