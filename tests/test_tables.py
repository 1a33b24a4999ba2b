"""Catalog, feeds, pages, registry and store."""

import json

import pytest
from pyspark.sql import functions as F

from gleaner.operators import catalog, feeds, pages, registry, skew, store
from gleaner.params import FilterParams
from gleaner.session import scratch_dir
from gleaner.sources import catalog as catalog_source, tables

from .conftest import plan_of

CONFIG = {
    "rss_sources": {
        "a": {"name": "A", "rss_url": "https://a/rss", "base_url": "https://a", "default_tags": ["x"], "priority": 1},
        "off": {"name": "Off", "rss_url": "https://o/rss", "base_url": "https://o", "enabled": False},
    },
    "html_sources": {
        "b": {"name": "B", "base_url": "https://b", "js_rendered": True},
        "c": {"name": "C", "base_url": "https://c", "blog_path": "/"},
        "a": {"name": "A page", "base_url": "https://a"},
    },
    "filtering": {"min_word_count": 5, "relevant_keywords": ["k"]},
    "global": {"lookback_days": 30},
}


@pytest.fixture(params=["json", "yaml"])
def config_path(request, tmp_path):
    path = tmp_path / f"sources.{request.param}"
    if request.param == "yaml":
        yaml = pytest.importorskip("yaml")
        path.write_text(yaml.safe_dump(CONFIG))
    else:
        path.write_text(json.dumps(CONFIG))
    return str(path)


def test_catalog_file(spark, config_path):
    rows = {(r["source_id"], r["method"]): r for r in catalog_source.read_catalog(spark, config_path).collect()}
    assert set(rows) == {("a", "rss"), ("b", "html"), ("c", "html"), ("a", "html")}
    b = rows["b", "html"]
    assert (b["blog_path"], b["default_tags"], b["js_rendered"], b["enabled"]) == ("/blog", [], True, True)
    assert rows["c", "html"]["blog_path"] == "/" and rows["a", "rss"]["default_tags"] == ["x"]


def test_filter_params():
    params = catalog_source.filter_params(CONFIG)
    assert params == FilterParams(30, 5, None, ("k",), ())
    assert catalog_source.filter_params(CONFIG, lookback_days=0).lookback_days == 0


def test_select_and_prefer(spark):
    known = catalog_source.catalog_frame(spark, CONFIG)
    ids = lambda df: sorted((r["source_id"], r["method"]) for r in df.collect())
    assert ids(catalog.select_sources(known, rss_only=True, html_only=True)) == [("a", "rss")]
    assert ids(catalog.select_sources(known, html_only=True)) == [("a", "html"), ("b", "html"), ("c", "html")]
    assert ids(catalog.select_sources(known, source="b", rss_only=True)) == [("b", "html")]
    assert ids(catalog.prefer_feeds(known)) == [("a", "rss"), ("b", "html"), ("c", "html")]
    with pytest.raises(ValueError, match="nope"):
        catalog.select_sources(known, source="nope")


RSS = """<?xml version="1.0"?><rss><channel><title>f</title>
<item rdf:about="x"><title> One &amp; 1 </title><link> https://x/1 </link><description>&lt;p&gt;d&lt;/p&gt;</description>
<content:encoded><![CDATA[<p>full</p>]]></content:encoded><dc:creator>W</dc:creator><category>RAG </category></item>
<item><title>Broken</title><link>https://x/2</link><b></item>
<item><title>Three</title><link>https://x/3</link><content:encoded></content:encoded><description>d</description></item>
<item><title>Cut off</title><link>https://x/4"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="html">T</title>
<link rel="self" href="https://s"/><link rel="alternate" href="https://x/a"/>
<author><name>N1</name></author><author><name>N2</name></author><category term="K"/>
<updated>2025-01-01T00:00:00Z</updated><summary>s</summary></entry></feed>"""


@pytest.fixture
def entries(spark):
    rows = [("r", "2025-01-01 00:00:00", RSS), ("t", "2025-01-01 00:00:00", ATOM), ("e", "2025-01-01 00:00:00", "<rss/>")]
    raw = spark.createDataFrame(rows, "source_id STRING, at STRING, xml STRING")
    raw = raw.select("source_id", F.col("at").cast("timestamp").alias("fetched_at"), "xml")
    return feeds.parse_feeds(raw)


def test_malformed_feeds_are_still_used(entries):
    rows = {(r["source_id"], r["pos"]): r for r in entries.collect()}
    assert set(rows) == {("r", 0), ("r", 1), ("r", 2), ("t", 0)}
    assert rows["r", 0]["link"] == "https://x/1" and rows["r", 0]["author"] == "W"
    assert rows["r", 1]["link"] is None and rows["r", 1]["title"] is None
    assert rows["t", 0]["link"] == "https://x/a" and [a["name"] for a in rows["t", 0]["authors"]] == ["N1", "N2"]
    assert [t["term"] for t in rows["t", 0]["tags"]] == ["K"]


LENIENT = '''<?xml version="1.0"?><rss xmlns:atom="a"><channel><title>f</title><!-- <item><title>comment</title></item> -->
<atom:link rel="self" href="https://self"/>
<item><title>R&D and a&nbsp;b &copy; &unknown; &amp; &#233; &#0; end</title><link>https://x/1?a=1&b=2</link><description>fish & chips</description></item>
<item><title>Guid</title><guid>https://x/2</guid><description><![CDATA[<pre></item><item></pre> a &amp;amp; b]]></description></item>
<item><title>Not an address</title><guid isPermaLink="false">https://x/3</guid><description/></item>
<item><title>Markup</title><link>https://x/4</link><description><p>one &lt;b&gt;</p><p>two<br/>three</p></description></item>
<item><title>A <b>bold</b> head</title><link>https://x/5</link><content:encoded>&lt;p&gt;plain&lt;/p&gt;</content:encoded></item>
</channel></rss>'''
PREFIXED = '''<atom:feed xmlns:atom="http://www.w3.org/2005/Atom"><atom:entry><atom:title>P</atom:title><atom:link href="https://x/p"/>
<atom:updated>2025-01-01T00:00:00Z</atom:updated><atom:content type="xhtml"><div xmlns="x"><p>a &amp; b</p></div></atom:content></atom:entry></atom:feed>'''


def test_lenient_feeds_are_mended(spark):
    rows = [("r", LENIENT), ("p", PREFIXED), ("b", RSS), ("n", "<rss/>"), ("x", None)]
    raw = spark.createDataFrame(rows, "source_id STRING, xml STRING").withColumn("fetched_at", F.lit("2025-01-01").cast("timestamp"))
    entries = feeds.parse_feeds(raw)
    found = {(r["source_id"], r["pos"]): r for r in feeds.feed_text(entries).collect()}
    of = [found["r", k] for k in range(5)]
    assert of[0]["title"] == "R&D and a\xa0b © &unknown; & é  end" and of[0]["link"] == "https://x/1?a=1&b=2"
    assert of[0]["content_text"] == "fish & chips"
    assert of[1]["link"] == "https://x/2" and of[1]["content_text"] == "a &amp; b"
    assert of[2]["link"] is None and of[2]["title"] == "Not an address"
    assert of[3]["content_text"] == "one <b>\ntwo\nthree"
    assert of[4]["title"] == "A <b>bold</b> head" and of[4]["content_text"] == "plain"
    assert ("r", 5) not in found
    one = found["p", 0]
    assert (one["title"], one["link"], one["updated"], one["content_text"]) == ("P", "https://x/p", "2025-01-01T00:00:00Z", "a & b")
    counts = {(r["source_id"], r["status"]): r["n"] for r in feeds.feed_status(raw, entries).collect()}
    assert counts == {
        ("r", "mended"): 3, ("r", "ok"): 2, ("p", "mended"): 1, ("b", "ok"): 2, ("b", "broken"): 1, ("b", "cut_off"): 1,
        ("n", "no_entries"): 1, ("x", "no_entries"): 1,
    }


def test_feed_text(entries):
    rows = {(r["source_id"], r["pos"]): r["content_text"] for r in feeds.feed_text(entries).collect()}
    assert rows["r", 0] == "full" and rows["t", 0] == "s"


def test_feed_cap_comes_before_other_tests(spark):
    rows = spark.createDataFrame([("s", i, u) for i, u in enumerate("abc")], "source_id STRING, pos INT, url STRING")
    seen = spark.createDataFrame([("s", "a")], "source STRING, url STRING")
    capped = feeds.cap_entries(rows, 2).withColumn("source", F.col("source_id"))
    assert [r["url"] for r in registry.unseen(capped, seen).collect()] == ["b"]


def test_page_cap_comes_after_seen_removal(spark):
    rows = spark.createDataFrame([("s", u, i) for i, u in enumerate("abc")], "source STRING, url STRING, place INT")
    seen = spark.createDataFrame([("s", "a")], "source STRING, url STRING")
    capped = pages.cap_pages(registry.unseen(rows, seen), 2)
    assert sorted(r["url"] for r in capped.collect()) == ["b", "c"]


@pytest.mark.parametrize("page_chars, entry_chars, used", [(200, 10, False), (201, 10, True), (300, 199, True), (300, 200, False)])
def test_enrichment_limits(spark, page_chars, entry_chars, used):
    entries = spark.createDataFrame([("u", "e" * entry_chars)], "url STRING, content_text STRING")
    html = f"<article>{'p' * page_chars}</article>"
    landed = spark.createDataFrame([(2, "u", "<article>late</article>"), (1, "u", html)], "page_id INT, url STRING, html STRING")
    rows = feeds.enrich_short(entries, landed).collect()
    assert [r["content_text"][0] for r in rows] == (["p"] if used else ["e"])


def test_discovery_keeps_first_position(spark):
    html = "<a href='/p'>1</a><a class=x href=\"/q?a=1&amp;b=2\">2</a><a href='/p'>3</a><a href='/p#f'>4</a><a href='https://o/x'>5</a>"
    listing = spark.createDataFrame([("s", "https://b", 1, html)], "source STRING, base_url STRING, page_id INT, html STRING")
    rows = {r["url"]: int(r["place"]) % 2**32 for r in pages.discover(listing).collect()}
    assert rows == {"https://b/p": 0, "https://b/q?a=1&b=2": 1, "https://b/p#f": 3}


def test_unseen_is_per_source_and_keeps_blank_urls(spark):
    rows = spark.createDataFrame([("a", "u"), ("b", "u"), ("a", ""), ("a", None)], "source STRING, url STRING")
    seen = spark.createDataFrame([("a", "u")], "source STRING, url STRING")
    left = sorted((r["source"], r["url"] or "") for r in registry.unseen(rows, seen).collect())
    assert left == [("a", ""), ("a", ""), ("b", "u")]
    assert registry.unseen(rows, seen, keep_blank=False).count() == 1


def test_registry_arrays_split_large_sources(spark):
    rows = spark.range(1000).select(F.lit("big").alias("source"), F.concat(F.lit("u"), "id").alias("url"))
    rows = rows.unionByName(spark.createDataFrame([("small", "z"), ("small", "a"), ("small", "a")], "source STRING, url STRING"))
    arrays = registry.registry_arrays(rows, target=100).collect()
    small = [r for r in arrays if r["source"] == "small"]
    assert [r["urls"] for r in small] == [["a", "z"]]
    big = [r for r in arrays if r["source"] == "big"]
    assert len(big) == 10 and sum(len(r["urls"]) for r in big) == 1000
    assert all(r["urls"] == sorted(r["urls"]) for r in big)


def test_registry_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("s", "b"), ("s", "a"), ("t", 'q"\\é')], "source STRING, url STRING")
    tables.export_registry(rows, str(tmp_path / "lines"))
    back = tables.import_registry(spark, str(tmp_path / "lines"))
    assert sorted(map(tuple, back.collect())) == [("s", "a"), ("s", "b"), ("t", 'q"\\é')]
    whole = tmp_path / "whole.json"
    whole.write_text(json.dumps({"s": ["b", "a", "a"], "t": []}, indent=2))
    back = tables.import_registry(spark, str(whole), whole_file=True)
    assert sorted(map(tuple, back.collect())) == [("s", "a"), ("s", "b")]
    assert tables.import_registry(spark, str(tmp_path / "none"), whole_file=True).isEmpty()


def test_bucketed_registry_is_not_shuffled(spark):
    source = F.concat(F.lit("s"), F.col("id") % 3)
    rows = spark.range(50).select(source.alias("source"), F.col("id").cast("string").alias("url"))
    tables.save_registry_table(rows, "seen_urls", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = registry.unseen(rows.repartition(3), spark.table("seen_urls"), keep_blank=False)
        assert plan_of(fresh).count("Exchange hashpartitioning") == 1
        assert fresh.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


ARTICLE_ROWS = "id STRING, source STRING, url STRING, title STRING, published_date STRING, scraped_at TIMESTAMP"


def _articles(spark, *rows):
    light = spark.createDataFrame([(i, s, f"u{i}", t, None, None) for i, s, t in rows], ARTICLE_ROWS)
    return light.select(
        "*", F.lit("n").alias("source_name"), F.lit("w").alias("author"), F.lit("c").alias("content_text"),
        F.lit("c").alias("summary"), F.array(F.lit("t")).alias("tags"), F.lit(1).alias("word_count"),
        F.struct(F.lit(1).alias("reading_time_minutes"), F.lit("rss").alias("scrape_method")).alias("metadata"),
    )


def test_store(spark, tmp_path):
    path = str(tmp_path / "store")
    first, second = _articles(spark, ("1", "s", "a"), ("2", "t", "b")), _articles(spark, ("1", "s", "new"))
    assert tables.read_articles(spark, path).isEmpty()
    tables.save_articles(first, path, 1)
    tables.save_articles(second, path, 2)
    tables.save_articles(second, path, 2)  # a repeated run
    tables.save_manifest(first, path, 1)
    stored = {r["id"]: r["title"] for r in tables.read_articles(spark, path).collect()}
    assert stored == {"1": "new", "2": "b"}
    assert tables.read_articles(spark, path, "t").count() == 1
    assert tables.read_article_versions(spark, path).count() == 3
    pruned = plan_of(tables.read_articles(spark, path, "t"))
    assert "PartitionFilters: [isnotnull(source" in pruned

    tables.compact_articles(spark, path, str(tmp_path / "compact"), 3)
    assert tables.read_article_versions(spark, str(tmp_path / "compact")).count() == 2

    assert tables.clear_source(spark, path, "s") == 1
    assert [r["id"] for r in tables.read_articles(spark, path).collect()] == ["2"]
    assert [r["id"] for r in tables.read_manifest(spark, path).collect()] == ["2"]
    assert tables.clear_source(spark, path, "missing") == 0

    port = first.withColumn("source", F.lit("localhost:8080"))
    tables.save_articles(port, path, 3)
    assert tables.clear_source(spark, path, "localhost:8080") == 2
    assert tables.read_articles(spark, path, "localhost:8080").count() == 0


def test_runs_add_up_and_a_repeated_key_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [{"id": k, "source": s, "url": f"http://{s}/{k}"} for k, s in (("1", "feed"), ("2", "page:8080"))]
    for row in rows:
        save = spark.createDataFrame([(row["source"], row["url"])], "source string, url string")
        tables.save_registry(save, path, row["id"])
    assert sorted(r["url"] for r in tables.read_registry(spark, path).collect()) == [r["url"] for r in rows]
    tables.save_registry(spark.createDataFrame([("feed", "http://feed/3")], "source string, url string"), path, "1")
    assert tables.read_registry(spark, path).count() == 2
    tables.save_registry(spark.createDataFrame([("feed", "http://feed/3")], "source string, url string"), path)
    assert tables.read_registry(spark, path).count() == 3


def test_reading_newest_rows_shuffles_no_text(spark, tmp_path):
    path = str(tmp_path / "store")
    first, second = _articles(spark, ("1", "s", "a"), ("2", "t", "b")), _articles(spark, ("1", "s", "new"), ("1", "s", "new"))
    tables.save_articles(first, path)
    tables.save_articles(second, path)
    rows = tables.read_articles(spark, path)
    assert sorted(r["title"] for r in rows.collect()) == ["b", "new"]
    plan = plan_of(rows)
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "Exchange hashpartitioning" not in plan
    found = tables.load_article(spark, path, "s", "1").collect()
    assert [r["title"] for r in found] == ["new"] and tables.load_article(spark, path, "s", "9").isEmpty()
    snapshots = spark.createDataFrame([("s", "1", "<p>1"), ("s", "2", "")], "source STRING, id STRING, content_html STRING")
    assert tables.read_html_snapshots(spark, path).isEmpty()
    tables.save_html_snapshots(snapshots, path)
    tables.save_html_snapshots(snapshots.withColumn("content_html", F.lit("<p>2")), path)
    assert sorted(map(tuple, tables.read_html_snapshots(spark, path).select("id", "content_html").collect())) == [("1", "<p>2"), ("2", "<p>2")]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_dir(Cluster, "x")


def test_manifest_reads_no_text(spark, tmp_path):
    path = str(tmp_path / "store")
    tables.save_articles(_articles(spark, ("1", "s", "a")), path, 1)
    plan = plan_of(store.manifest_rows(tables.read_article_versions(spark, path)))
    assert "content_text" not in plan


def test_listed_sources_and_totals(spark):
    manifest = store.manifest_rows(_articles(spark, ("1", "s", "a"), ("1", "s", "b"), ("2", "t", "c")))
    listed = store.listed_sources(manifest, _articles(spark, ("9", "t", "x"), ("8", "t", "x")))
    assert [r["id"] for r in listed.collect()] == ["2"]
    totals = {r["source"]: r["total_articles"] for r in store.manifest_totals(manifest).collect()}
    assert totals == {"s": 1, "t": 1}


def test_large_dimension_is_salted_not_broadcast(spark):
    facts = spark.range(300).select((F.col("id") % 3).alias("k"), "id")
    dim = spark.createDataFrame([(0, "x"), (1, "y"), (5, "z")], "k BIGINT, v STRING")
    small = skew.join_dimension(facts, dim, "k")
    salted = skew.join_dimension(facts, dim, "k", max_bytes=1)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, salted.collect()))
    assert "_salt" not in salted.columns
    for how, n in (("left", 300), ("left_semi", 200), ("left_anti", 100)):
        assert skew.join_dimension(facts, dim, "k", how, max_bytes=1).count() == n


@pytest.mark.parametrize("n", [1, 7, 1500])
def test_first_per_group_with_a_hot_key(spark, n):
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5).alias("k"), "id")
    kept = skew.first_per_group(rows, ["k"], [F.desc("id")], n)
    expected = {}
    for r in sorted(rows.collect(), key=lambda r: -r["id"]):
        expected.setdefault(r["k"], []).append(r["id"])
    wanted = sorted((k, i) for k, ids in expected.items() for i in ids[:n])
    assert sorted(map(tuple, kept.collect())) == wanted
    if n <= 1000:
        assert "WindowGroupLimit" in plan_of(kept)
