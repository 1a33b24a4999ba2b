"""What larger tables showed: folders of part files, repeated ids, work that must not grow faster than its input."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gleaner.operators import bags, feeds, hybrid
from gleaner.sources import tables

from .conftest import plan_of
from .test_logs_and_search import _bm25, _top, corpus  # noqa: F401

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@needs_tables
@pytest.mark.parametrize("name", ["stream_dedup", "stream_lookback"])
def test_a_stream_reads_a_table_of_one_file_or_of_several(spark, tmp_path, name):
    spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    query = entry.queries()[name]
    whole, parts = (sorted(map(tuple, query(spark, str(d)).collect()), key=str) for d in (SF_DIR, tmp_path))
    assert whole and parts == whole


def test_an_id_that_a_run_holds_twice_keeps_its_newest_snapshot(spark, tmp_path):
    rows = spark.createDataFrame(
        [("s", "1", f"<p>{n}", n) for n in range(20)] + [("s", "2", "", 30), ("s", "2", "<p>a", 3)],
        "source STRING, id STRING, content_html STRING, page_id BIGINT",
    )
    for key, order in enumerate(("page_id", F.desc("page_id"))):
        path = str(tmp_path / str(key))
        tables.save_html_snapshots(rows.repartition(4).sortWithinPartitions(order), path, 1, newest_by=["page_id"])
        kept = tables.read_html_snapshots(spark, path).select("id", "content_html").collect()
        assert sorted(map(tuple, kept)) == [("1", "<p>19"), ("2", "<p>a")]


@pytest.mark.parametrize("group, cells", [(512, 1 << 20), (2, 64), (1, 1)])
def test_one_pass_scores_like_brute_force(corpus, spark, monkeypatch, group, cells):
    docs, queries, docs_df, queries_df = corpus
    monkeypatch.setattr(bags, "QUERY_GROUP", group)
    monkeypatch.setattr(bags, "MATRIX_CELLS", cells)
    blank = spark.createDataFrame([(500, None, 0, None), (501, "", 0, None)], docs_df.schema)
    expected = _bm25([*docs, (500, "", None), (501, "", None)], queries)
    scores = bags.lexical_scores(docs_df.unionByName(blank), queries_df)
    # words and pairs stay with their document: before, both were shuffled
    assert "Exchange" not in plan_of(scores)
    assert {(r["query_id"], r["doc_id"]): r["score"] for r in scores.collect()} == pytest.approx(expected, abs=1e-8)
    for k in (6, 500):
        ranked = bags.lexical_topk(docs_df.unionByName(blank), queries_df, k)
        found = {}
        for r in ranked.orderBy("query_id", F.desc("score"), "doc_id").collect():
            found.setdefault(r["query_id"], []).append(r["doc_id"])
        assert found == {q: d for q, d in _top(expected, queries, k).items() if d}
    nothing = spark.createDataFrame([(1, "unheard"), (2, None)], "query_id BIGINT, text STRING")
    assert bags.lexical_topk(docs_df, nothing).isEmpty() and bags.lexical_scores(docs_df.limit(0), queries_df).isEmpty()


@pytest.mark.parametrize("k, group, cells", [(2, 512, 1 << 20), (30, 2, 64)])
def test_one_pass_of_both_scores_is_the_merge_of_both_indexes(corpus, spark, monkeypatch, k, group, cells):
    docs, queries, docs_df, queries_df = corpus
    monkeypatch.setattr(bags, "QUERY_GROUP", group)
    monkeypatch.setattr(bags, "MATRIX_CELLS", cells)
    half = docs_df.withColumn("vector", F.when(F.col("doc_id") % 2 == 0, F.col("vector")))
    some = queries_df.withColumn("vector", F.when(F.col("query_id") != 2, F.col("vector"))).withColumn(
        "text", F.when(F.col("query_id") != 3, F.col("text"))
    )
    # vectors of documents without a text are ranked as well
    extra = docs_df.limit(3).select((F.col("doc_id") + 9000).alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("length"), "vector")
    whole = half.unionByName(extra.select(*half.columns))

    def rows(ranked):
        columns = ("query_id", "doc_id", "lexical", "semantic", "score")
        return {(r["query_id"], r["doc_id"]): pytest.approx([r[c] for c in columns[2:]], abs=1e-8) for r in ranked.select(*columns).collect()}

    found = rows(bags.hybrid_topk(whole.select("doc_id", "text", "length"), whole.select("doc_id", "vector"), some, k))
    merged = hybrid.hybrid_scores(whole, some, k).collect()
    assert len(merged) == len(found)
    assert all([r["lexical"], r["semantic"], r["score"]] == found[r["query_id"], r["doc_id"]] for r in merged)


def test_feeds_too_old_for_the_cap_are_not_parsed(spark, monkeypatch):
    def body(n, *inside):
        return "<rss>" + "".join(f"<item><link>https://e/{n}/{j}</link><title>{t}</title></item>" for j, t in enumerate(inside)) + "</rss>"

    hidden = "<rss><!-- <item><link>https://e/no</link></item> --></rss>"
    section = "<rss><x><![CDATA[ <item></item> ]]></x></rss>"
    rows = [("s", at, body(at, "a", "b")) for at in range(1, 9)]
    rows += [("s", 20, hidden), ("s", 21, section), ("s", 22, None), ("s", 23, ""), ("s", 8, body("8b", "a", "b", "c")), ("s", None, body("x", "a"))]
    rows += [("few", 1, body("f", "a")), ("few", None, body("g", "a"))]
    feeds_df = spark.createDataFrame(rows, "source_id STRING, at BIGINT, xml STRING").select(
        "source_id", F.timestamp_seconds("at").alias("fetched_at"), "xml"
    )
    for n in (1, 2, 3, 5, 40):
        whole = feeds.cap_entries(feeds.parse_feeds(feeds_df), n).select("source_id", F.unix_seconds("fetched_at").alias("at"), "pos")
        capped = feeds.capped_entries(feeds_df, n).select("source_id", F.unix_seconds("fetched_at").alias("at"), "pos")
        assert sorted(map(str, capped.collect())) == sorted(map(str, whole.collect()))
    read = feeds.newest_feeds(feeds_df, 2).where("source_id = 's'").select(F.unix_seconds("fetched_at").alias("at"))
    assert sorted(r["at"] for r in read.collect()) == [8, 8, 20, 21, 22, 23]
