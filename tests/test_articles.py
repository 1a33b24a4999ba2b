from dataclasses import replace

import pytest

from gleaner.functions import fields
from gleaner.operators import articles, documents, filters
from gleaner.params import RELEVANT_KEYWORDS, FilterParams, RunParams

AS_OF = "2025-03-01T00:00:00Z"
INPUT = """source STRING, source_name STRING, method STRING, url STRING, title STRING, author STRING,
published_date STRING, content_text STRING, tags ARRAY<STRING>"""


def build(spark, *rows):
    base = dict(
        source="s", source_name="Site", method="rss", url="https://x/a", title="T", author="A",
        published_date=None, content_text="llm " * 300, tags=["a", "b"],
    )
    filled = [tuple({**base, **row}.values()) for row in rows]
    return articles.project_articles(spark.createDataFrame(filled, INPUT), AS_OF)


def reasons(spark, params, *rows):
    judged = filters.with_reason(build(spark, *rows), AS_OF, params)
    return [r["reason"] for r in judged.select("reason").collect()]


def test_lookback(spark):
    params = FilterParams(min_words=0, keywords=())
    day = ["2024-12-31T00:00:00", "2024-12-30T23:59:59.999999", None, "unreadable", "2024-12-30T19:00:00-05:00"]
    rows = [{"published_date": d} for d in day]
    assert reasons(spark, params, *rows) == [None, "too_old", None, None, None]
    assert reasons(spark, replace(params, lookback_days=0), *rows) == [None] * 5


def test_word_limits(spark):
    rows = [{"content_text": "llm " * n} for n in (199, 200, 50_000, 50_001)]
    assert reasons(spark, FilterParams(), *rows) == ["word_count", None, None, "word_count"]
    open_end = FilterParams(min_words=0, max_words=None)
    assert reasons(spark, open_end, *rows) == [None] * 4


def test_keywords(spark):
    params = FilterParams(min_words=0, keywords=("rag", "MCP"))
    rows = [{"content_text": "storage"}, {"content_text": "mcp"}, {"content_text": "x"}, {"content_text": "x", "title": "RAG"}]
    assert reasons(spark, params, *rows) == [None, None, "keyword", None]
    assert reasons(spark, replace(params, keywords=()), *rows) == [None] * 4


def test_first_failing_test_is_the_reason(spark):
    row = {"published_date": "2020-01-01T00:00:00", "content_text": "x"}
    assert reasons(spark, FilterParams(), row) == ["too_old"]


def test_minimal_keywords_decide_the_same():
    kept = filters.minimal_keywords(RELEVANT_KEYWORDS)
    assert len(kept) < len(RELEVANT_KEYWORDS)
    assert all(any(k in word.lower() for k in kept) for word in RELEVANT_KEYWORDS)
    assert set(kept) <= {k.lower() for k in RELEVANT_KEYWORDS}


def test_words_are_counted_once_per_row(spark):
    from .conftest import plan_of

    judged = filters.accepted(filters.with_reason(build(spark, {}), AS_OF, FilterParams()))
    plan = plan_of(judged.select("id", "word_count"))
    assert plan.count("regexp_extract_all") <= 1


def test_projection(spark):
    row = build(spark, {"author": "", "content_text": "one two"}).first()
    assert row["author"] == "Site" and row["word_count"] == 2 and row["summary"] == "one two"
    assert row["metadata"].asDict() == {"reading_time_minutes": 1, "scrape_method": "rss"}


def test_required_fields(spark):
    rows = build(
        spark, {"content_text": "x" * 199}, {"content_text": "x" * 200}, {"title": "  "}, {"url": ""}, {"url": None}
    )
    assert articles.with_required_fields(rows, 200).count() == 1


def test_cap_must_be_positive():
    with pytest.raises(ValueError):
        RunParams(as_of=AS_OF, max_per_source=0)


def test_document(spark):
    row = build(spark, {"content_text": "Body", "published_date": "2025-01-15T23:30:00-05:00"})
    body = row.select(fields.document_body()).first()[0]
    assert body == (
        "# T | 2025-01-15\n\n## Metadata\n- Source: Site\n- URL: https://x/a\n- Author: A\n"
        "- Tags: a, b\n- Word Count: 1\n\n## Summary\nBody\n\n## Content\nBody"
    )


def test_document_without_tags_summary_and_date(spark):
    row = build(spark, {"content_text": "", "tags": []})
    rendered = documents.render_documents(row).first()
    assert rendered["body"] == (
        "# T\n\n## Metadata\n- Source: Site\n- URL: https://x/a\n- Author: A\n- Word Count: 0\n\n## Content\n"
    )
    assert rendered["metadata"]["published_date"] == "None"


def test_delivery_without_configuration(spark):
    log = spark.createDataFrame([("a", "u", "d", "s"), ("b", "u", None, "s")], "article_id STRING, url STRING, document_id STRING, source STRING")
    assert documents.delivery_summary(log).first()[:3] == (2, 1, 1)
    off = documents.delivery_summary(log, configured=False).first()
    assert off["failed"] == 2 and off["error"]
    items = {r["article_id"]: (r["outcome"], r["url"]) for r in documents.delivery_items(log).collect()}
    assert items == {"a": ("delivered", None), "b": ("failed", "u")}
