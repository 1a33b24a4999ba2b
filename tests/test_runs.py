"""Whole runs, commits and streams."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from gleaner.operators import filters, metrics
from gleaner.operators.documents import delivery_summary
from gleaner.params import FilterParams, RunParams
from gleaner.plans.commit import commit_run, deliver_pending, judged_registry, run_log
from gleaner.plans.runs import feed_run, listing_targets, page_run
from gleaner.operators.feeds import enrich_short
from gleaner.schema import ARTICLE_COLUMNS, LISTINGS, PAGES_LANDED
from gleaner.sources import log, tables
from gleaner.sources.catalog import catalog_frame
from gleaner.sources.log import Run, draw_number, find as log_of, vacuum
from gleaner.streaming import ingest

from .conftest import plan_of

PARAMS = RunParams(as_of="2025-03-01T00:00:00Z", filters=FilterParams(min_words=2, keywords=("llm",)))
CONFIG = {
    "rss_sources": {"f": {"name": "Feed", "rss_url": "https://f/rss", "base_url": "https://f", "default_tags": ["d"]}},
    "html_sources": {"p": {"name": "Pages", "base_url": "https://p", "blog_path": "/b"}},
}


def item(url, title, text, date="Wed, 26 Feb 2025 10:00:00 GMT"):
    return f"<item><title>{title}</title><link>{url}</link><pubDate>{date}</pubDate><description>{text}</description></item>"


def feed(spark, *items, source="f", at="2025-03-01 00:00:00"):
    xml = "<rss><channel>" + "".join(items) + "</channel></rss>"
    rows = spark.createDataFrame([(source, at, xml)], "source_id STRING, at STRING, xml STRING")
    return rows.select("source_id", F.col("at").cast("timestamp").alias("fetched_at"), "xml")


ITEMS = (
    item("https://f/1", "One", "about llm agents"),
    item("https://f/careers", "Job", "about llm agents"),
    item("https://f/2", "Old", "about llm agents", "Wed, 1 Jan 2020 10:00:00 GMT"),
    item("https://f/3", "Short", "llm"),
    item("https://f/4", "Off topic", "about other things"),
    item("", "No URL", "about llm agents"),
    item("https://f/1", "One again", "about llm agents, newer"),
)


def outcome(judged):
    return sorted((r["url"], r["title"], r["reason"]) for r in judged.select("url", "title", "reason").collect())


@pytest.fixture
def known(spark):
    return catalog_frame(spark, CONFIG)


def test_feed_run(spark, known):
    judged = feed_run(feed(spark, *ITEMS), known, None, PARAMS)
    assert [r[:2] + (r[2] or "",) for r in outcome(judged)] == [
        ("https://f/1", "One", ""),
        ("https://f/1", "One again", ""),
        ("https://f/2", "Old", "too_old"),
        ("https://f/3", "Short", "word_count"),
        ("https://f/4", "Off topic", "keyword"),
    ]
    assert judged.where("title = 'One'").first()["tags"] == ["d"]


def test_unknown_sources_are_dropped(spark, known):
    assert feed_run(feed(spark, *ITEMS, source="nope"), known, None, PARAMS).isEmpty()


def test_second_run_accepts_nothing(spark, known, tmp_path):
    path, landed = str(tmp_path / "store"), feed(spark, *ITEMS)
    delivered = []

    def run(run_seq, params=PARAMS, **kw):
        seen = tables.read_registry(spark, path)
        counts = commit_run(feed_run(landed, known, seen, params), path, run_seq, params, **kw)
        return {r["reason"]: r["n"] for r in counts.collect()}

    assert run(1) == {"accepted": 2, "too_old": 1, "word_count": 1, "keyword": 1}
    # the URL stood twice in the feed: the later entry stays
    stored = tables.read_articles(spark, path).collect()
    assert [(r["url"], r["title"]) for r in stored] == [("https://f/1", "One again")]
    # rejected URLs were not registered, so they are judged again
    assert tables.read_registry(spark, path).count() == 1
    assert run(2) == {"too_old": 1, "word_count": 1, "keyword": 1}
    assert run(3, replace(PARAMS, force_rescrape=True))["accepted"] == 2
    assert tables.read_articles(spark, path).count() == 1
    assert tables.read_documents(spark, path).count() == 1


def test_dry_run_writes_articles_but_no_registry(spark, known, tmp_path):
    path, dry = str(tmp_path / "store"), replace(PARAMS, dry_run=True)
    commit_run(feed_run(feed(spark, *ITEMS), known, None, dry), path, 1, dry)
    assert tables.read_articles(spark, path).count() == 1
    assert tables.read_manifest(spark, path).count() == 1
    assert tables.read_registry(spark, path).isEmpty()
    assert tables.read_documents(spark, path).isEmpty()


def test_delivery_hook(spark, known, tmp_path):
    path, out = str(tmp_path / "store"), tmp_path / "sent"
    out.mkdir()

    def send(row):
        (out / row["filename"]).write_text(row["body"])
        return f"doc {row['filename']}"

    commit_run(feed_run(feed(spark, *ITEMS), known, None, PARAMS), path, 1, PARAMS, deliver=send)
    assert [p.name.startswith("f_2025-02-26_") for p in out.iterdir()] == [True]
    sent = tables.read_deliveries(spark, path).first()
    assert sent["document_id"] == f"doc {sent['filename']}" and sent["url"] == "https://f/1" and sent["error"] is None


def test_a_retry_sends_only_what_failed(spark, known, tmp_path):
    path, out = str(tmp_path / "store"), tmp_path / "sent"
    out.mkdir()
    more = [item(f"https://f/x{n}", f"Title {n}", "llm agents and more") for n in range(6)]

    def fails(row):
        if row["metadata"]["url"][-1] in "135":
            raise TimeoutError("no answer")
        return works(row)

    def works(row):
        with open(out / row["filename"], "a") as file:
            file.write("x")
        return "d" + row["id"]

    judged = feed_run(feed(spark, *more), known, None, PARAMS)
    commit_run(judged, path, "a", PARAMS, deliver=fails)
    log = tables.read_deliveries(spark, path)
    assert sorted((r["url"][-1], r["error"]) for r in log.where("document_id IS NULL").collect()) == [
        (n, "TimeoutError: no answer") for n in "135"
    ]
    assert delivery_summary(log).first().asDict() == {"total": 6, "successful": 3, "failed": 3, "error": None}
    run = deliver_pending(spark, path, works)
    assert run_log(spark, path, "a", run).where("kind = 'uploaded'").count() == 3
    assert delivery_summary(tables.read_deliveries(spark, path)).first()["successful"] == 6
    deliver_pending(spark, path, works)
    assert [p.read_text() for p in out.iterdir()] == ["x"] * 6
    # a new version of a document is due again
    changed = feed_run(feed(spark, item("https://f/x0", "Title 0", "llm agents and much more")), known, None, PARAMS)
    commit_run(changed, path, "b", PARAMS, deliver=works)
    assert sorted(p.read_text() for p in out.iterdir()) == ["x"] * 5 + ["xx"]


def test_report_of_a_run(spark, known, tmp_path):
    path = str(tmp_path / "store")

    def send(row):
        raise ValueError("closed")

    commit_run(feed_run(feed(spark, *ITEMS), known, None, PARAMS), path, "r", PARAMS, sources=["f", "idle"])
    sent = deliver_pending(spark, path, send)
    log = run_log(spark, path, "r", sent)
    counted = {r["source"]: r.asDict() for r in metrics.source_counters(log).where("source IS NOT NULL").collect()}
    assert counted["f"] == {"source": "f", "scraped": 2, "uploaded": 0, "skipped": 0, "errors": 1}
    assert counted["idle"] == {"source": "idle", "scraped": 0, "uploaded": 0, "skipped": 1, "errors": 0}
    totals = metrics.run_totals(log).first()
    assert totals["duration_seconds"] > 0 and (totals["total_scraped"], totals["total_skipped"], totals["total_errors"]) == (2, 1, 1)
    assert [r["error"] for r in metrics.first_errors(log).collect()] == ["ValueError: closed"]
    info = log_of(spark, path, "r").info
    assert info["accepted"] == 2 and info["judged"] == 5 and info["start"] < info["end"]
    with pytest.raises(KeyError):
        run_log(spark, path, "unknown")


def test_two_writers_get_their_own_numbers(spark, known, tmp_path):
    path = str(tmp_path / "store")
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: draw_number(spark, path), range(24)))
    assert sorted(numbers) == list(range(1, 25))
    a, b = Run(spark, path), Run(spark, path)
    rows = filters.accepted(feed_run(feed(spark, *ITEMS), known, None, PARAMS)).select(*ARTICLE_COLUMNS)
    a.write("articles", rows, "source")
    b.write("articles", rows.withColumn("title", F.lit("from b")), "source")
    assert tables.read_articles(spark, path).isEmpty()
    b.commit()
    assert [r["title"] for r in tables.read_articles(spark, path).collect()] == ["from b"]
    a.commit()
    assert tables.read_article_versions(spark, path).count() == 4
    assert [r["title"] for r in tables.read_articles(spark, path).collect()] == ["from b"]


def test_attempts_at_one_run_become_visible_once(spark, known, tmp_path):
    path = str(tmp_path / "store")
    wide = known.unionByName(known.withColumn("source_id", F.lit("g")))
    both = feed(spark, *ITEMS).unionByName(feed(spark, *ITEMS).withColumn("source_id", F.lit("g")))
    lost = Run(spark, path, "daily")  # writes two sources and is lost before its commit
    rows = filters.accepted(feed_run(both, wide, None, PARAMS)).select(*ARTICLE_COLUMNS)
    lost.write("articles", rows, "source")
    commit_run(feed_run(feed(spark, *ITEMS), known, None, PARAMS), path, "daily", PARAMS)
    assert {r["source"] for r in tables.read_articles(spark, path).collect()} == {"f"}
    assert lost.commit().number != lost.number
    assert {r["source"] for r in tables.read_articles(spark, path).collect()} == {"f"}
    assert vacuum(spark, path) == [f"articles/run_seq={lost.number}"]
    assert tables.read_articles(spark, path).count() == 1
    commit_run(feed_run(both, wide, None, PARAMS), path, "other", PARAMS)
    assert judged_registry(spark, path, "daily").isEmpty() and judged_registry(spark, path, "other").count() == 1


def test_snapshots_of_the_log_say_what_the_commits_say(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "SNAPSHOT_EVERY", 3)
    path = str(tmp_path / "store")
    for n in range(11):
        Run(spark, path, f"k{n}").commit(n=n)
        assert [(c.key, c.info["n"]) for c in log.commits(spark, path)] == [(f"k{m}", m) for m in range(n + 1)]
    assert list((tmp_path / "store/_log/snapshots").iterdir())


def test_a_new_checkpoint_loses_nothing(spark, known, tmp_path):
    path = str(tmp_path / "store")
    for n in (1, 2):
        landing = str(tmp_path / f"landing{n}")
        feed(spark, item(f"https://f/{n}", f"Title {n}", "llm agents and more")).write.parquet(landing)
        ingest.start_feed_ingest(spark, landing, known, path, str(tmp_path / f"check{n}"), PARAMS).awaitTermination()
    assert sorted(r["url"] for r in tables.read_registry(spark, path).collect()) == ["https://f/1", "https://f/2"]
    assert tables.read_articles(spark, path).count() == tables.read_documents(spark, path).count() == 2
    # the same landed files under a third checkpoint: all are known, unless the run is forced
    again = str(tmp_path / "landing1")
    ingest.start_feed_ingest(spark, again, known, path, str(tmp_path / "check3"), PARAMS).awaitTermination()
    assert tables.read_article_versions(spark, path).count() == 2
    forced = replace(PARAMS, force_rescrape=True)
    ingest.start_feed_ingest(spark, again, known, path, str(tmp_path / "check4"), forced, max_files=1).awaitTermination()
    assert tables.read_article_versions(spark, path).count() == 3 and tables.read_articles(spark, path).count() == 2


def test_short_entries_take_their_page(spark, known):
    html = "<article><p>" + "llm text " * 40 + "</p></article>"
    landed = spark.createDataFrame([(1, "https://f/3", html)], "page_id BIGINT, url STRING, html STRING")
    judged = feed_run(feed(spark, *ITEMS), known, None, PARAMS, landed)
    row = judged.where("url = 'https://f/3'").first()
    assert row["word_count"] == 80 and row["reason"] is None


def test_page_run(spark, known):
    links = "".join(f'<a href="/b/{n}">x</a>' for n in (1, 2, 2, 3, 4)) + '<a href="/about">a</a>'
    listings = spark.createDataFrame([("p", 0, links)], "source_id STRING, page_id BIGINT, html STRING")
    body = "<html><title>t{0}</title><article>" + "llm words " * 30 + "</article></html>"
    short = "<title>t</title><article>llm words</article>"
    rows = [(n, f"https://p/b/{n}", body.format(n) if n != 3 else short) for n in (1, 2, 3, 4, 5)]
    landed = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    seen = spark.createDataFrame([("p", "https://p/b/1")], "source STRING, url STRING")
    capped = replace(PARAMS, max_per_source=2)
    judged = page_run(listings, landed, known, seen, capped)
    assert [(r["url"], r["title"], r["author"]) for r in judged.collect()] == [("https://p/b/2", "t2", "Pages")]
    everything = page_run(listings, landed, known, seen, replace(capped, force_rescrape=True, max_per_source=9))
    assert sorted(r["url"][-1] for r in everything.collect()) == ["1", "2", "4"]
    assert listing_targets(known).first()["url"] == "https://p/b"


def test_runs_stay_in_the_jvm(spark, known):
    plan = plan_of(feed_run(feed(spark, *ITEMS), known, None, PARAMS))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_page_run_leaves_ids_with_a_feed_alone(spark):
    both = {**CONFIG, "html_sources": {"f": CONFIG["html_sources"]["p"]}}
    listings = spark.createDataFrame([("f", 0, '<a href="/b/1">x</a>')], "source_id STRING, page_id BIGINT, html STRING")
    landed = spark.createDataFrame([(1, "https://p/b/1", "<title>t</title>" + "llm words " * 30)], "page_id BIGINT, url STRING, html STRING")
    assert page_run(listings, landed, catalog_frame(spark, both), None, PARAMS).isEmpty()
    only = {"html_sources": both["html_sources"]}
    assert page_run(listings, landed, catalog_frame(spark, only), None, PARAMS).count() == 1


def test_bounded_stream_dedup(spark, tmp_path):
    schema = "source STRING, url STRING, at TIMESTAMP"
    rows = spark.sql("SELECT 's' AS source, 'u' AS url, timestamp'2025-01-01' AS at UNION ALL SELECT 's', 'u', timestamp'2025-01-05'")
    landing, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))
    rows.write.parquet(landing)
    kept = ingest.dedup_stream_bounded(ingest.read_landed(spark, landing, schema), "at")
    query = kept.writeStream.option("checkpointLocation", check).trigger(availableNow=True)
    query.start(out, format="parquet").awaitTermination()
    assert spark.read.schema(schema).parquet(out).count() == 1


def test_stream_is_incremental_and_repeatable(spark, known, tmp_path):
    landing, path, check = (str(tmp_path / n) for n in ("landing", "store", "check"))

    def drain():
        ingest.start_feed_ingest(spark, landing, known, path, check, PARAMS).awaitTermination()
        return sorted(r["url"] for r in tables.read_registry(spark, path).collect())

    feed(spark, *ITEMS).write.mode("append").parquet(landing)
    assert drain() == ["https://f/1"]
    assert drain() == ["https://f/1"]
    feed(spark, *ITEMS, item("https://f/9", "Nine", "more llm agents")).write.mode("append").parquet(landing)
    assert drain() == ["https://f/1", "https://f/9"]
    batch = filters.accepted(feed_run(feed(spark, *ITEMS), known, None, PARAMS))
    assert {r["id"] for r in batch.collect()} < {r["id"] for r in tables.read_articles(spark, path).collect()}
    # a batch that is repeated does not see what it registered itself
    first, second = log.commits(spark, path)
    assert judged_registry(spark, path, first.key).isEmpty()
    assert tables.read_registry_before(spark, path, second.number).count() == judged_registry(spark, path, second.key).count() == 1


def test_stream_dedup_remembers_across_runs(spark, tmp_path):
    schema = """source STRING, url STRING, title STRING, content_text STRING, word_count INT,
    published_date STRING, published_ts TIMESTAMP"""
    rows = [("s", "u", "t", "llm a b", 3, None, None), ("s", "v", "t", "llm", 1, None, None)]
    landing, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))

    def drain(n_words):
        landed = ingest.read_landed(spark, landing, schema)
        kept = ingest.dedup_stream(landed, PARAMS.as_of, FilterParams(min_words=n_words, keywords=()))
        query = kept.select("source", "url").writeStream.option("checkpointLocation", check).trigger(availableNow=True)
        query.start(out, format="parquet").awaitTermination()
        return sorted(r["url"] for r in spark.read.schema("source STRING, url STRING").parquet(out).collect())

    spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
    assert drain(2) == ["u"]
    longer = [("s", "u", "t", "llm a b", 3, None, None), ("s", "v", "t", "llm a", 2, None, None)]
    spark.createDataFrame(longer, schema).write.mode("append").parquet(landing)
    assert drain(2) == ["u", "v"]  # v was rejected before, so it may pass now


def page(n, words="llm words ", title="t", at=1):
    return n, f"https://p/b/{n}", f"<title>{title}{n}</title><article>" + words * 30 + "</article>", f"2025-02-0{at} 00:00:00"


def landed_frame(spark, rows, schema):
    frame = spark.createDataFrame(rows, schema.replace("TIMESTAMP", "STRING"))
    return frame.withColumn("landed_at", F.col("landed_at").cast("timestamp"))


def test_the_newest_version_at_the_time_of_the_run_is_read(spark, known):
    listings = landed_frame(
        spark,
        [("p", 0, '<a href="/b/1">x</a><a href="/b/2">x</a>', "2025-02-01 00:00:00"), ("p", 1, '<a href="/b/3">x</a><a href="/b/1">x</a>', "2025-02-03 00:00:00")],
        LISTINGS,
    )
    pages = landed_frame(spark, [page(1, title="old"), page(1, title="new", at=4), page(2), page(3, at=3)], PAGES_LANDED)

    def titles(as_of, n=9):
        params = replace(PARAMS, as_of=as_of, max_per_source=n)
        return sorted(r["title"] for r in page_run(listings, pages, known, None, params).collect())

    assert titles("2025-02-02T00:00:00Z") == ["old1", "t2"]
    assert titles("2025-02-05T00:00:00Z") == ["new1", "t2", "t3"]
    assert titles("2025-02-05T00:00:00Z", 2) == ["new1", "t3"]  # the later listing's links come first
    short = spark.createDataFrame([("f", "https://p/b/1", "short")], "source STRING, url STRING, content_text STRING")
    for as_of, title in (("2025-02-02", "old"), ("2025-02-05", "new")):
        texts = pages.withColumn("html", F.concat(F.lit("<article>"), F.repeat(F.regexp_extract("html", "<title>([a-z]+)", 1), 90), F.lit("</article>")))
        assert enrich_short(short, texts, as_of=as_of).first()["content_text"] == title * 90


def test_pages_and_listings_may_land_in_any_order(spark, known, tmp_path):
    listings, pages, path, check = (str(tmp_path / n) for n in ("listings", "pages", "store", "check"))

    def land(rows, schema, folder):
        landed_frame(spark, rows, schema).coalesce(1).write.mode("append").parquet(folder)

    def drain(checkpoint=check):
        ingest.start_page_ingest(spark, listings, pages, known, path, checkpoint, PARAMS).awaitTermination()
        return sorted(r["title"] for r in tables.read_articles(spark, path).collect())

    land([("p", 0, '<a href="/b/1">x</a><a href="/b/2">x</a><a href="/b/4">x</a>', None)], LISTINGS, listings)
    land([page(9), page(4, words="short ")], PAGES_LANDED, pages)
    assert drain() == []
    land([page(3)], PAGES_LANDED, pages)
    assert drain() == []
    land([page(1)], PAGES_LANDED, pages)
    assert drain() == ["t1"]  # listed in the first batch, landed in the third
    land([("p", 1, '<a href="/b/1">x</a><a href="/b/3">x</a>', None)], LISTINGS, listings)
    assert drain() == ["t1", "t3"]  # landed before it was listed
    land([page(4, words="llm and more ", title="later", at=2), page(1, title="again", at=2)], PAGES_LANDED, pages)
    assert drain() == ["later4", "t1", "t3"]  # rejected before, and a known page is left alone
    assert tables.read_article_versions(spark, path).count() == 3
    assert drain() == drain(str(tmp_path / "check2")) == ["later4", "t1", "t3"]
    assert tables.read_article_versions(spark, path).count() == 3
