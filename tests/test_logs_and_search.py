"""Counters, spacing and ranking against brute force."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import hybrid, index, metrics, nearest, politeness, retrieval

LOG = "source STRING, kind STRING, n INT, url STRING, error STRING, ts TIMESTAMP"


@pytest.fixture
def log(spark):
    rows = [
        ("a", "scraped", 3, None, None, "2025-01-01 00:00:00"),
        ("a", "uploaded", 2, None, None, "2025-01-01 00:00:01"),
        ("b", "skipped", 1, None, None, "2025-01-01 00:00:02"),
        ("b", "error", 1, "u" * 80, "e" * 200, "2025-01-01 00:00:03.5"),
    ]
    return spark.createDataFrame(rows, LOG.replace("TIMESTAMP", "STRING")).withColumn("ts", F.col("ts").cast("timestamp"))


def test_counters(log):
    rows = {r["source"]: tuple(r)[1:] for r in metrics.source_counters(log).collect()}
    assert rows == {"a": (3, 2, 0, 0), "b": (0, 0, 1, 1)}
    totals = metrics.run_totals(log).first()
    assert totals["duration_seconds"] == 3.5 and totals["total_scraped"] == 3 and totals["total_errors"] == 1
    error = metrics.first_errors(log).first()
    assert len(error["url"]) == 50 and len(error["error"]) == 100


def test_merged_counters_use_the_union_of_sources(spark):
    parts = [spark.createDataFrame([r], "source STRING, n INT") for r in (("a", 1), ("b", 2), ("c", 3))]
    rows = {r["source"]: tuple(r)[1:] for r in metrics.merge_counters(*parts).collect()}
    assert rows == {"a": (1, 0, 0), "b": (0, 2, 0), "c": (0, 0, 3)}


def _schedule(rows):
    last, out = {}, {}
    for request_id, domain, at, delay in sorted(rows, key=lambda r: (r[2], r[0])):
        start = max(at, last[domain] + delay) if domain in last else at
        last[domain] = start
        out[request_id] = round(start - at, 6)
    return out


def _requests(spark, rows):
    df = spark.createDataFrame(rows, "request_id INT, domain STRING, at DOUBLE, delay DOUBLE")
    return df.select("request_id", "domain", F.timestamp_micros(F.round(F.col("at") * 1e6).cast("long")).alias("ts"), "delay")


@pytest.mark.parametrize("parts", [1, 3, None])
def test_schedule(spark, parts):
    known = [(1, "a", 0.0, 2.0), (2, "a", 0.5, 2.0), (3, "a", 5.0, 2.0), (4, "a", 5.1, 2.0), (5, "b", 0.1, 2.0)]
    plan = politeness.politeness_schedule(_requests(spark, known), parts=parts)
    assert {r["request_id"]: r["wait_seconds"] for r in plan.collect()} == {1: 0, 2: 1.5, 3: 0, 4: 1.9, 5: 0}


@pytest.mark.parametrize("parts", [1, 9, 60])
def test_schedule_of_a_hot_domain(spark, parts):
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 else f"d{i % 4}", round(rng.uniform(0, 300), 3), 2.0 if i % 3 else 3.0) for i in range(400)]
    rows = [(i, d, t, 2.0 if d == "hot" else 3.0) for i, d, t, _ in rows] + [(900 + i, "hot", 50.0, 2.0) for i in range(5)]
    plan = politeness.politeness_schedule(_requests(spark, rows), parts=parts)
    assert {r["request_id"]: round(r["wait_seconds"], 6) for r in plan.collect()} == _schedule(rows)

    last, expected = {}, {}
    for i, d, t, delay in sorted(rows, key=lambda r: (r[2], r[0])):
        expected[i] = d not in last or round(t - last[d], 6) >= delay
        last[d] = t
    allowed = politeness.can_request(_requests(spark, rows), parts=parts)
    assert {r["request_id"]: r["can_request"] for r in allowed.collect()} == expected


def test_one_domain_with_all_requests_is_cut_into_equal_pieces(spark):
    rng = random.Random(1)
    rows = [(i, "hot", round(rng.uniform(0, 3000), 3), 2.0) for i in range(4000)]
    pieces = politeness._pieces(_requests(spark, rows).repartition(4), "request_id", 16).groupBy("_domain", "_piece").count().collect()
    assert len(pieces) == 16 and max(r["count"] for r in pieces) < 2 * 4000 / 16
    plan = politeness.politeness_schedule(_requests(spark, rows), parts=16)
    assert {r["request_id"]: round(r["wait_seconds"], 6) for r in plan.collect()} == _schedule(rows)


def test_requests_without_a_domain(spark):
    requests = spark.createDataFrame([(1, None, 2.0), (2, None, 2.0), (3, "a", 2.0)], "request_id INT, domain STRING, delay DOUBLE")
    requests = requests.withColumn("ts", F.timestamp_seconds(F.lit(0)))
    plan = politeness.politeness_schedule(requests)
    waits = {r["request_id"]: r["wait_seconds"] for r in plan.collect()}
    assert waits == {1: 0, 2: 2, 3: 0}  # requests without a domain wait for each other


def test_domain_delay(spark):
    requests = _requests(spark, [(1, "a", 0.0, 0.0), (2, "b", 0.0, 0.0)]).drop("delay")
    delays = spark.createDataFrame([("a", 5.0)], "domain STRING, delay DOUBLE")
    rows = politeness.with_delay(requests, delays).collect()
    assert {r["domain"]: r["delay"] for r in rows} == {"a": 5.0, "b": 2.0}


def test_retries(spark):
    rows = [("u", 0, "Timeout"), ("v", 2, None), ("w", 3, "Timeout"), ("x", 0, "SystemExit")]
    failures = spark.createDataFrame(rows, "url STRING, attempt INT, error STRING")
    plan = {r["url"]: (r["retry"], r["delay_seconds"]) for r in politeness.retry_plan(failures).collect()}
    assert plan == {"u": (True, 1.0), "v": (True, 4.0), "w": (False, None), "x": (False, None)}
    schedule = politeness.retry_schedule(failures).where("url = 'u'").orderBy("next_attempt")
    assert [r["delay_seconds"] for r in schedule.collect()] == [1.0, 2.0, 4.0]


WORDS = "alpha beta gamma delta the of agent vector search rank".split()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices(WORDS[: 3 + i % 8], k=rng.randint(1, 40))), [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    docs += [(100 + i, docs[0][1], docs[0][2]) for i in range(20)]  # copies
    queries = [(i, " ".join(rng.choices(WORDS, k=3)), [rng.gauss(0, 1) for _ in range(6)]) for i in range(5)]
    docs_df = spark.createDataFrame([(i, t, len(t.split()), v) for i, t, v in docs], "doc_id BIGINT, text STRING, length INT, vector ARRAY<DOUBLE>")
    queries_df = spark.createDataFrame(queries, "query_id BIGINT, text STRING, vector ARRAY<DOUBLE>")
    return docs, queries, docs_df.repartition(5), queries_df


def _bm25(docs, queries):
    tokens = {i: re.findall(r"[^\W_]+", t) for i, t, _ in docs}
    average = sum(map(len, tokens.values())) / len(tokens)
    scores = {}
    for q, text, _ in queries:
        for term in set(text.split()):
            df = sum(term in t for t in tokens.values())
            idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
            for d, t in tokens.items():
                if tf := t.count(term):
                    part = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / average))
                    scores[q, d] = scores.get((q, d), 0) + part
    return scores


def _cosines(docs, queries):
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    return {(q, d): float(unit(qv) @ unit(dv)) for q, _, qv in queries for d, _, dv in docs}


def test_lexical(corpus):
    docs, queries, docs_df, queries_df = corpus
    rows = retrieval.lexical_scores(docs_df, queries_df).collect()
    found = {(r["query_id"], r["doc_id"]): r["score"] for r in rows}
    expected = _bm25(docs, queries)
    assert found.keys() == expected.keys()
    assert all(abs(found[p] - expected[p]) < 1e-8 for p in expected)


def _top(scores, queries, k):
    out = {}
    for q, *_ in queries:
        ranked = sorted(((-round(s, 9), d) for (qq, d), s in scores.items() if qq == q))[:k]
        out[q] = [d for _, d in ranked]
    return out


@pytest.mark.parametrize("group, block, pivots", [(512, 2 << 20, 512), (2, 16, 4), (1, 16, 1)])
def test_semantic_by_any_blocks(corpus, monkeypatch, group, block, pivots):
    docs, queries, docs_df, queries_df = corpus
    monkeypatch.setattr(nearest, "QUERY_GROUP", group)
    monkeypatch.setattr(nearest, "BLOCK_BYTES", block)
    monkeypatch.setattr(nearest, "MAX_PIVOTS", pivots)
    ranked = retrieval.hybrid_topk(hybrid.semantic_scores(docs_df, queries_df, 7), 7)
    found = {}
    for r in ranked.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["doc_id"])
    assert found == _top(_cosines(docs, queries), queries, 7)


def test_nearest_reads_only_blocks_within_reach(spark, tmp_path):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 12)) * 4
    vectors = np.concatenate([c + rng.normal(size=(60, 12)) * 0.3 for c in centres] + [np.zeros((3, 12)), np.repeat(centres[:1], 300, axis=0)])
    rows = [(int(k), v.tolist()) for k, v in enumerate(vectors)] + [(9000, None), (9001, [])]
    path = str(tmp_path / "index")
    docs = spark.createDataFrame(rows, "doc_id BIGINT, vector ARRAY<DOUBLE>")
    nearest.build_vector_index(docs.repartition(4), path, block_bytes=16 * 96)
    opened = nearest.open_vector_index(spark, path)
    asked = [(k, (centres[k] + rng.normal(size=12) * 0.1).tolist()) for k in range(12)] + [(50, [0.0] * 12), (51, None), (52, [])]
    queries = spark.createDataFrame(asked, "query_id BIGINT, vector ARRAY<DOUBLE>")
    units = nearest.unit_rows([v for _, v in rows[:-2]], 12)
    for k in (5, 5000):
        found = {}
        for r in nearest.nearest(opened, queries, k).orderBy("query_id", F.desc("score"), "doc_id").collect():
            found.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
        assert found.keys() == {q for q, v in asked if v}
        for q, v in asked:
            if v:
                scores = np.round(units @ nearest.unit_rows([v], 12)[0], 9)
                order = np.lexsort((np.arange(len(scores)), -scores))[:k]
                assert [d for d, _ in found[q]] == order.tolist()
                assert np.allclose([s for _, s in found[q]], scores[order], atol=1e-8)
    lows = {r["query_id"]: r["low"] for r in nearest.lowest_scores(opened, queries).collect()}
    assert lows == pytest.approx({q: float((units @ nearest.unit_rows([v], 12)[0]).min()) for q, v in asked if v}, abs=1e-8)
    monkey, read = nearest._scored, []
    nearest._scored = lambda index, queries, pairs, k: (read.append(pairs.count()), monkey(index, queries, pairs, k))[1]
    try:
        nearest.nearest(opened, queries.where("query_id < 12"), 5).collect()
    finally:
        nearest._scored = monkey
    assert sum(read) < 12 * opened.blocks.count() / 3
    empty = str(tmp_path / "empty")
    nearest.build_vector_index(docs.where("false"), empty)
    assert nearest.nearest(nearest.open_vector_index(spark, empty), queries).isEmpty()


@pytest.mark.parametrize("size, first", [(256, 8), (4, 1)])
def test_lexical_topk_is_the_top_of_all_scores(corpus, monkeypatch, spark, tmp_path, size, first):
    docs, queries, docs_df, queries_df = corpus
    monkeypatch.setattr(index, "BLOCK_DOCS", size)
    path = str(tmp_path / "index")
    blank = spark.createDataFrame([(500, None, 0, None), (501, "", 0, None)], docs_df.schema)
    index.build_index(docs_df.unionByName(blank), path)
    opened = index.open_index(spark, path)
    expected = _bm25([*docs, (500, "", None), (501, "", None)], queries)
    for k in (6, 500):
        ranked = index.lexical_topk(opened, queries_df, k, first)
        found = {}
        for r in ranked.orderBy("query_id", F.desc("score"), "doc_id").collect():
            found.setdefault(r["query_id"], []).append(r["doc_id"])
        assert found == {q: d for q, d in _top(expected, queries, k).items() if d}
    asked = index.ask(opened, queries_df)
    lows = {r["query_id"]: r["low"] for r in index.lowest_of(asked, first).collect()}
    assert lows == pytest.approx({q: min(s for (qq, _), s in expected.items() if qq == q) for q, *_ in queries}, abs=1e-8)
    pairs = spark.createDataFrame([(0, 3), (0, 500), (1, 104)], "query_id BIGINT, doc_id BIGINT")
    known = {(r["query_id"], r["doc_id"]): r["score"] for r in index.score_pairs(asked, pairs).collect()}
    assert known == pytest.approx({p: expected[p] for p in [(0, 3), (0, 500), (1, 104)] if p in expected}, abs=1e-8)
    nothing = spark.createDataFrame([(1, "unheard"), (2, None)], "query_id BIGINT, text STRING")
    assert index.lexical_topk(opened, nothing).isEmpty()


def test_lexical_topk_skips_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "BLOCK_DOCS", 8)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["common", "word", "here"], k=30)) + (" rare rare rare" if i % 97 == 0 else ""), 30) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, length INT")
    path = str(tmp_path / "index")
    index.build_index(docs, path)
    opened = index.open_index(spark, path)
    queries = spark.createDataFrame([(1, "rare common")], "query_id BIGINT, text STRING")
    scored, read = index.score_blocks, []
    monkeypatch.setattr(index, "score_blocks", lambda asked, chosen: (read.append(chosen.count()), scored(asked, chosen))[1])
    best = index.lexical_topk(opened, queries, 5)
    assert {r["doc_id"] % 97 for r in best.collect()} == {0}
    assert sum(read) < opened.n_blocks / 4


@pytest.mark.parametrize("k", [2, 30])
def test_hybrid_ranks_documents_and_queries_without_a_vector(corpus, spark, k):
    docs, queries, docs_df, queries_df = corpus
    has = F.col("doc_id") % 2 == 0
    half = docs_df.withColumn("vector", F.when(has, F.col("vector"))).withColumn("text", F.when(F.col("doc_id") % 10 != 4, F.col("text")))
    some = queries_df.withColumn("vector", F.when(F.col("query_id") != 2, F.col("vector"))).withColumn("text", F.when(F.col("query_id") != 3, F.col("text")))
    texts = [(d, t if d % 10 != 4 else "", v) for d, t, v in docs]
    lex = _bm25(texts, [q for q in queries if q[0] != 3])
    sem = {p: s for p, s in _cosines(docs, queries).items() if p[1] % 2 == 0 and p[0] != 2}
    expected = {}
    for q, *_ in queries:
        parts = []
        for scores in (lex, sem):
            own = {d: round(s, 9) for (qq, d), s in scores.items() if qq == q}
            low, high = min(own.values(), default=0), max(own.values(), default=0)
            parts.append({d: (s - low) / (high - low) if high > low else 1.0 for d, s in own.items()})
        sums = {d: 0.2 * parts[0].get(d, 0.0) + 0.8 * parts[1].get(d, 0.0) for d in parts[0].keys() | parts[1].keys()}
        expected[q] = [round(s, 6) for s in sorted(sums.values(), reverse=True)[:k]]
    # lengths stay those of the whole texts in the corpus average, as the column says
    lengths = half.withColumn("length", F.when(F.col("text").isNull(), 0).otherwise(F.col("length")))
    found = {}
    for r in retrieval.hybrid_topk(hybrid.hybrid_scores(lengths, some, k), k).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(round(r["score"], 6))
    assert found.keys() == expected.keys()
    for q in expected:
        assert found[q] == pytest.approx(expected[q], abs=2e-6)


def test_zero_vectors_score_zero(spark):
    docs = spark.createDataFrame([(1, "a b", 2, [0.0, 0.0]), (2, "a", 1, [1.0, 0.0])], "doc_id BIGINT, text STRING, length INT, vector ARRAY<DOUBLE>")
    queries = spark.createDataFrame([(1, "a", [1.0, 0.0])], "query_id BIGINT, text STRING, vector ARRAY<DOUBLE>")
    scores = {r["doc_id"]: r["score"] for r in hybrid.semantic_scores(docs, queries).collect()}
    assert scores == {1: 0.0, 2: 1.0}
    semantic = {r["doc_id"]: r["semantic"] for r in hybrid.hybrid_scores(docs, queries).collect()}
    assert semantic == {1: 0.0, 2: 1.0}


@pytest.mark.parametrize("k", [3, 25])
def test_hybrid_is_exact_for_the_first_k(corpus, k):
    docs, queries, docs_df, queries_df = corpus
    lex, sem = _bm25(docs, queries), _cosines(docs, queries)
    scores = {}
    for q, *_ in queries:
        lv = [round(s, 9) for (qq, _), s in lex.items() if qq == q]
        sv = [round(s, 9) for (qq, _), s in sem.items() if qq == q]
        for d, *_ in docs:
            a = (round(lex[q, d], 9) - min(lv)) / (max(lv) - min(lv)) if (q, d) in lex and max(lv) > min(lv) else 1.0 * ((q, d) in lex)
            b = (round(sem[q, d], 9) - min(sv)) / (max(sv) - min(sv))
            scores[q, d] = 0.2 * a + 0.8 * b
    ranked = retrieval.hybrid_topk(hybrid.hybrid_scores(docs_df, queries_df, k), k)
    found = {}
    for r in ranked.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(round(r["score"], 6))
    for q, values in found.items():
        best = sorted((round(s, 6) for (qq, _), s in scores.items() if qq == q), reverse=True)[:k]
        assert values == pytest.approx(best, abs=2e-6)


def test_rerank_prefers_newer_on_ties(spark):
    rows = [(1, 1, 0.5, "2024-01-01"), (1, 2, 0.5, "2025-01-01"), (1, 3, 0.1, "2025-01-01"), (1, 4, 0.5, None)]
    scores = spark.createDataFrame(rows, "query_id INT, doc_id INT, score DOUBLE, published_ts STRING")
    kept = retrieval.rerank_cut(scores, 0.2, 3).orderBy("rank").collect()
    assert [r["doc_id"] for r in kept] == [2, 1, 4]


def test_citations(spark):
    rows = [("x [1]()[2](). y [3]. z [4]().", ["1", "2", "3"]), ("a [1]()[1](). 3.5 is b [2]()!", ["1", "2"]), ("", ["1"])]
    checked = retrieval.citation_check(spark.createDataFrame(rows, "text STRING, allowed ARRAY<STRING>")).collect()
    assert [(r["cited"], r["invalid"], r["repeated"], r["uncited"]) for r in checked] == [
        (["1", "2", "4"], ["4"], 0, 1),
        (["1", "2"], [], 1, 0),
        ([], [], 0, 0),
    ]


def test_message_history_is_whole_and_in_blocks(spark):
    turns = spark.range(1000).select(F.lit(1).alias("conv_id"), "id", F.lit("user").alias("role"))
    turns = turns.select("conv_id", F.col("id").alias("turn"), "role", F.concat(F.lit("t"), "id").alias("text"))
    turns = turns.unionByName(turns.where("turn = 3"))
    parts = retrieval.message_history(turns, 100).orderBy("part").collect()
    assert [len(p["messages"]) for p in parts] == [100] * 10
    assert sum(m["copies"] for p in parts for m in p["messages"]) == 1001
    assert [m["turn"] for p in parts for m in p["messages"]] == list(range(1000))


def test_quality_labels(spark):
    posts = spark.createDataFrame([(1, 8000), (2, 7999)], "id INT, upvote_ratio_bp INT")
    papers = spark.createDataFrame([(3, "accept", 71), (4, "accept", 70), (5, "reject", 99)], "id INT, quality_verdict STRING, quality_i INT")
    blogs = spark.createDataFrame([(6, "2025-01-01")], "id INT, published_date STRING")
    labels = {r["id"]: r["label"] for r in retrieval.label_quality(posts, papers, blogs).collect()}
    assert labels == {1: "well_received", 2: "post", 3: "peer_reviewed", 4: "preprint", 5: "preprint", 6: "blog"}
