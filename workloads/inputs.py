"""Fixture tables derived from the driver tables, in Spark and in SQL.

Every definition is a function of the whole driver table, so work grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.functions import urls
from gleaner.operators.articles import project_articles
from gleaner.params import FilterParams, RunParams
from gleaner.session import spread
from gleaner.sources import tables

AS_OF = "2024-05-01T00:00:00Z"
PARAMS = RunParams(as_of=AS_OF)
FILTERS = FilterParams()

# --- SQL fragments ---------------------------------------------------------------

WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"


def words_sql(text: str) -> str:
    return rf"CAST(len(regexp_extract_all({text}, '[^{WS}]+')) AS BIGINT)"


def strip_sql(text: str) -> str:
    return rf"regexp_replace({text}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def summary_sql(text: str) -> str:
    return (
        f"CASE WHEN length({text}) > 500 THEN regexp_replace(substr({text}, 1, 500), ' [^ ]*$', '')"
        f" || '...' ELSE {text} END"
    )


def keyword_sql(text: str) -> str:
    tests = " OR ".join(f"contains({text}, '{k.lower()}')" for k in FILTERS.keywords)
    return f"({tests})"


ARTICLES = f"""
raw AS (
  SELECT doc_id, lang, source, 'Source ' || source AS source_name,
    'https://' || source || '.example.com/' || doc_id AS url,
    split_part(text, chr(10), 1) AS title,
    CASE WHEN lang = 'fr' THEN 'Source ' || source ELSE 'Writer ' || (doc_id % 7) END AS author,
    CASE WHEN lang = 'es' THEN NULL ELSE
      strftime(DATE '2024-01-01' + CAST(doc_id % 120 AS INTEGER), '%Y-%m-%d') || 'T00:00:00+00:00'
    END AS published_date,
    text AS content_text
  FROM documents
),
articles AS (
  SELECT *, source || '_' || substr(md5(url), 1, 12) AS id,
    {words_sql("content_text")} AS word_count,
    {summary_sql("content_text")} AS summary,
    'corpus, ' || lang AS tags
  FROM raw
)
"""

REASONS = f"""
judged AS (
  SELECT *, CASE
    WHEN CAST(substr(published_date, 1, 10) AS DATE) < DATE '2024-03-02' THEN 'too_old'
    WHEN word_count NOT BETWEEN 200 AND 50000 THEN 'word_count'
    WHEN NOT {keyword_sql("lower(title || ' ' || content_text)")} THEN 'keyword'
  END AS reason
  FROM articles
)
"""

REGISTRY = """
registry AS (
  SELECT source, 'https://' || source || '.example.com/' || doc_id AS url
  FROM documents SEMI JOIN labels USING (doc_id)
)
"""

HOST = r"regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"

SITES = f"""
sites AS (
  SELECT {HOST} AS source_id, min(regexp_extract(url, '^[a-z]+://[^/?#]*')) AS base_url
  FROM pages GROUP BY 1
)
"""

RUN_LOG = """
run_log AS (
  SELECT event_type AS source,
    CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'uploaded'
      WHEN 'signup' THEN 'skipped' ELSE 'scraped' END AS kind,
    1 AS n, 'https://' || event_type || '.example.com/' || user_id || '?event=' || event_id AS url,
    'failed with ' || props AS error, ts, event_id
  FROM events
)
"""

REQUESTS = """
requests AS (
  SELECT event_id AS request_id, 'host' || (user_id % 20) || '.example.com' AS domain, ts FROM events
),
delays AS (
  SELECT DISTINCT domain, 3600.0 AS delay FROM requests WHERE domain LIKE 'host1%'
)
"""

# A landed feed per document with one entry per line: RSS for English, else Atom.
ENTRIES = f"""
lines AS (
  SELECT doc_id, lang, source AS source_id, TIMESTAMP '2024-01-01' + doc_id * INTERVAL 1 SECOND AS fetched_at,
    DATE '2024-01-01' + CAST(doc_id % 120 AS INTEGER) AS day,
    unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents
),
entries AS (
  SELECT source_id, fetched_at, pos, lang, doc_id, day,
    'https://' || source_id || '.example.com/' || doc_id || '/' || pos AS link,
    {strip_sql("substr(line, 1, 60)")} AS title,
    {strip_sql("line")} AS content_text
  FROM lines
)
"""


# --- Spark frames ----------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over the cores: most queries work on every text."""
    return spread(table(spark, sf_dir, "documents"))


def article_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as article inputs; French ones name no author, Spanish no date."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 120).cast("int"))
    dated = F.concat(day.cast("string"), F.lit("T00:00:00+00:00"))
    writer = F.concat(F.lit("Writer "), (F.col("doc_id") % 7).cast("string"))
    return documents(spark, sf_dir).select(
        "doc_id",
        "lang",
        "source",
        F.concat(F.lit("Source "), "source").alias("source_name"),
        F.lit("rss").alias("method"),
        document_url().alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(F.col("lang") == "fr", F.lit("")).otherwise(writer).alias("author"),
        F.when(F.col("lang") != "es", dated).alias("published_date"),
        F.col("text").alias("content_text"),
        F.array_sort(F.array(F.lit("corpus"), F.col("lang"))).alias("tags"),
    )


def document_url():
    return F.concat(F.lit("https://"), "source", F.lit(".example.com/"), F.col("doc_id").cast("string"))


def articles(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    return project_articles(article_inputs(spark, sf_dir), AS_OF, keep)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of the documents that carry a label count as seen."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return labelled.select("source", document_url().alias("url"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page table, spread over the cores."""
    return tables.read_pages(spark, f"{sf_dir}/pages.parquet")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page source per host of the page table."""
    urls_only = pages(spark, sf_dir).select("url")
    origin = F.regexp_extract("url", r"^[a-z]+://[^/?#]*", 0)
    return urls_only.groupBy(urls.authority(F.col("url")).alias("source_id")).agg(
        F.min(origin).alias("base_url")
    )


def site_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites(spark, sf_dir).select(
        "source_id",
        F.lit("html").alias("method"),
        F.concat(F.lit("Site "), "source_id").alias("name"),
        "base_url",
        F.array(F.lit("page"), F.element_at(F.split("source_id", r"\."), -1)).alias("default_tags"),
        F.lit(True).alias("enabled"),
    )


def feed_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "documents").select("source").distinct()
    return names.select(
        F.col("source").alias("source_id"),
        F.lit("rss").alias("method"),
        F.concat(F.lit("Source "), "source").alias("name"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com")).alias("base_url"),
        F.array(F.lit("corpus")).alias("default_tags"),
        F.lit(True).alias("enabled"),
    )


def _escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed feed per document with one entry per line of its text."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 120).cast("int"))
    rss_day = F.date_format(day, "d MMM yyyy")
    docs = documents(spark, sf_dir).withColumns({"day": day, "rss_day": rss_day})
    base = F.concat(document_url(), F.lit("/"))

    def rss(line, i):
        # The same entry as strict XML, with bare markup, with a lone ampersand and an HTML name, and with its end tag in a section.
        body = F.concat(F.lit("<p>"), _escape(line), F.lit("</p>"))
        markup = F.when(i % 4 == 1, body).when(
            i % 4 == 3, F.concat(F.lit("<![CDATA[<p>"), _escape(line), F.lit("</p><!-- </item> -->]]>"))
        ).otherwise(_escape(body))
        link = F.when(i % 3 == 1, F.concat(F.lit('<guid isPermaLink="true">'), base, i.cast("string"), F.lit("</guid>"))).otherwise(
            F.concat(F.lit("<link>"), base, i.cast("string"), F.lit("</link>"))
        )
        lone = F.when(i % 4 == 2, F.lit("<comments>https://c/?a=1&b=2&nbsp;R&D</comments>")).otherwise(F.lit(""))
        return F.concat(
            F.lit("<item><title> "), _escape(F.substring(line, 1, 60)), F.when(i % 4 == 2, F.lit("&nbsp;")).otherwise(F.lit(" ")),
            F.lit("</title>"), link, lone, F.lit("<category>EN </category><category>Line</category>"),
            F.lit("<dc:creator>Feed Writer</dc:creator><pubDate>Mon, "), F.col("rss_day"),
            F.lit(" 10:00:00 GMT</pubDate><description>"), markup, F.lit("</description></item>"),
        )

    def atom(line, i):
        xhtml = F.concat(F.lit('<content type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml">'), _escape(line), F.lit("</div></content></entry>"))
        whole = F.concat(
            F.lit('<entry><title type="text">'), _escape(F.substring(line, 1, 60)),
            F.lit('</title><link rel="self" href="https://feeds.example.com/self"/><link rel="alternate" href="'),
            base, i.cast("string"), F.lit('"/><author><name>A</name></author><author><name>B</name></author>'),
            F.lit('<category term="Line"/><updated>'), F.col("day").cast("string"), F.lit("T23:30:00-05:00</updated>"),
            F.when(i % 3 == 1, xhtml).otherwise(F.concat(
                F.lit('<content type="html"><![CDATA[<div>'), _escape(line), F.lit("</div><!-- end -->]]></content></entry>"),
            )),
        )
        prefixed = F.regexp_replace(F.regexp_replace(whole, "<(?=[a-z])(?!div|p>)", "<atom:"), "</(?=[a-z])(?!div|p>)", "</atom:")
        return F.when(i % 3 == 2, prefixed).otherwise(whole)

    lines = F.split("text", "\n")
    rss_doc = F.concat(
        F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>feed</title>'),
        F.array_join(F.transform(lines, rss), ""), F.lit("</channel></rss>"),
    )
    atom_doc = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>feed</title>'),
        F.array_join(F.transform(lines, atom), ""), F.lit("</feed>"),
    )
    at = F.timestamp_micros(F.lit(1704067200000000) + F.col("doc_id") * 1000000)
    return docs.select(
        F.col("source").alias("source_id"),
        at.alias("fetched_at"),
        F.when(F.col("lang") == "en", rss_doc).otherwise(atom_doc).alias("xml"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("event_type") == "purchase", "uploaded")
        .when(F.col("event_type") == "signup", "skipped")
        .otherwise("scraped")
    )
    url = F.concat(
        F.lit("https://"), "event_type", F.lit(".example.com/"), F.col("user_id").cast("string"),
        F.lit("?event="), F.col("event_id").cast("string"),
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        kind.alias("kind"),
        F.lit(1).alias("n"),
        url.alias("url"),
        F.concat(F.lit("failed with "), "props").alias("error"),
        "ts",
        "event_id",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.concat(F.lit("host"), (F.col("user_id") % 20).cast("string"), F.lit(".example.com"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), host.alias("domain"), "ts"
    )


def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    slow = requests(spark, sf_dir).where(F.col("domain").like("host1%"))
    return slow.select("domain").distinct().withColumn("delay", F.lit(3600.0))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as failed requests; one user's ended with a fatal error."""
    fatal = F.when(F.col("user_id") == 3, "SystemExit").otherwise("Timeout")
    return table(spark, sf_dir, "events").where("event_type = 'error'").select(
        "event_id", (F.col("event_id") % 6).cast("int").alias("attempt"), fatal.alias("error")
    )


def micros(c):
    return F.unix_micros(c.cast("timestamp"))
