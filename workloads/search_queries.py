"""Batch search, quality labels, citations and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import text
from gleaner.operators import bags, hybrid, retrieval

from . import inputs as i
from .registering import query

# Queries are the benchmark texts; query vectors are the centroids of the labels.
LEXICAL_INPUTS = f"""
docs AS (SELECT doc_id, text, {i.words_sql("text")} AS length FROM documents),
queries AS (SELECT item_id AS query_id, text FROM benchmark)
"""
BM25 = """
wanted AS (SELECT DISTINCT query_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term FROM queries),
tokens AS (SELECT doc_id, length, unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term FROM docs),
counts AS (
  SELECT doc_id, length, term, count(*) AS tf FROM tokens SEMI JOIN wanted USING (term) GROUP BY ALL
),
corpus AS (SELECT count(*) AS n, sum(length) / count(*) AS avg_length FROM docs),
idf AS (
  SELECT term, ln(1 + ((SELECT n FROM corpus) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM counts GROUP BY term
),
lexical AS (
  SELECT query_id, doc_id, round(sum(
    idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / (SELECT avg_length FROM corpus)))), 9) AS score
  FROM counts JOIN wanted USING (term) JOIN idf USING (term) GROUP BY ALL
)
"""
LEXICAL = f"{LEXICAL_INPUTS}, {BM25}"

SEMANTIC = """
parts AS (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS p FROM embeddings),
means AS (SELECT label, p, round(avg(CAST(v AS DOUBLE)), 9) AS m FROM parts GROUP BY ALL),
centroids AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY p) AS vector FROM means GROUP BY label),
vectors AS (SELECT vec_id AS doc_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings),
semantic AS (
  SELECT query_id, doc_id, round(list_cosine_similarity(v.vector, c.vector), 9) AS score
  FROM vectors v, centroids c
),
nearest AS (
  SELECT * FROM semantic QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 50
)
"""


def _docs(spark, sf_dir):
    length = text.word_count(F.col("text"))
    return i.documents(spark, sf_dir).select("doc_id", "text", length.alias("length"))


def _queries(spark, sf_dir):
    return i.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _vectors(spark, sf_dir):
    rows = i.table(spark, sf_dir, "embeddings")
    return rows.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))


def _centroids(spark, sf_dir):
    rows = i.table(spark, sf_dir, "embeddings")
    parts = rows.select("label", F.posexplode("embedding").alias("p", "v"))
    means = parts.groupBy("label", "p").agg(F.round(F.avg(F.col("v").cast("double")), 9).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("p", "m")))
    return means.groupBy("label").agg(ordered.alias("e")).select(
        F.col("label").cast("long").alias("query_id"), F.col("e.m").alias("vector")
    )


@query("lexical_score", f"WITH {LEXICAL} SELECT query_id, doc_id, round(score, 6) AS score FROM lexical")
def lexical_score(spark, sf_dir):
    scores = retrieval.lexical_scores(_docs(spark, sf_dir), _queries(spark, sf_dir))
    return scores.select("query_id", "doc_id", F.round("score", 6).alias("score"))


@query("semantic_score", f"WITH {SEMANTIC} SELECT query_id, doc_id, round(score, 6) AS score FROM nearest")
def semantic_score(spark, sf_dir):
    scores = hybrid.semantic_scores(_vectors(spark, sf_dir), _centroids(spark, sf_dir), 50)
    return scores.withColumn("score", F.round("score", 6))


# Half of the documents have a vector; queries are benchmark texts, some with the
# centroid of the label of the same number. A missing score counts 0.
HYBRID = f"""
{SEMANTIC},
{LEXICAL_INPUTS},
{BM25},
semantic2 AS (SELECT * FROM semantic WHERE query_id IN (SELECT query_id FROM queries)),
lex_range AS (SELECT query_id, min(score) AS low, max(score) AS high FROM lexical GROUP BY query_id),
sem_range AS (SELECT query_id, min(score) AS low, max(score) AS high FROM semantic2 GROUP BY query_id),
scaled_lexical AS (
  SELECT query_id, doc_id, CASE WHEN high > low THEN (score - low) / (high - low) ELSE 1.0 END AS lexical
  FROM lexical JOIN lex_range USING (query_id)
),
scaled_semantic AS (
  SELECT query_id, doc_id, CASE WHEN high > low THEN (score - low) / (high - low) ELSE 1.0 END AS semantic
  FROM semantic2 JOIN sem_range USING (query_id)
),
scored AS (
  SELECT query_id, doc_id, coalesce(lexical, 0.0) AS lexical, coalesce(semantic, 0.0) AS semantic,
    0.2 * coalesce(lexical, 0.0) + 0.8 * coalesce(semantic, 0.0) AS score
  FROM scaled_lexical FULL JOIN scaled_semantic USING (query_id, doc_id)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored QUALIFY rank <= 50
)
"""


def _hybrid(spark, sf_dir):
    queries = _queries(spark, sf_dir).join(_centroids(spark, sf_dir), "query_id", "left")
    return bags.hybrid_topk(_docs(spark, sf_dir), _vectors(spark, sf_dir), queries, 50)


@query(
    "lexical_topk",
    f"""WITH {LEXICAL} SELECT query_id, doc_id, round(score, 6) AS score FROM lexical
      QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 50""",
)
def lexical_topk(spark, sf_dir):
    best = bags.lexical_topk(_docs(spark, sf_dir), _queries(spark, sf_dir), 50)
    return best.select("query_id", "doc_id", F.round("score", 6).alias("score"))


@query(
    "hybrid_score",
    f"""WITH {HYBRID} SELECT query_id, doc_id, round(lexical, 6) AS lexical, round(semantic, 6) AS semantic,
      round(score, 6) AS score FROM ranked""",
)
def hybrid_score(spark, sf_dir):
    rows = _hybrid(spark, sf_dir)
    return rows.select(
        "query_id", "doc_id", *[F.round(c, 6).alias(c) for c in ("lexical", "semantic", "score")]
    )


@query("hybrid_topk", f"WITH {HYBRID} SELECT query_id, doc_id, round(score, 6) AS score, rank FROM ranked")
def hybrid_topk(spark, sf_dir):
    best = retrieval.hybrid_topk(_hybrid(spark, sf_dir), 50)
    return best.select(
        "query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank")
    )


# One decimal makes scores tie, so the publication date decides.
@query(
    "rerank_cut",
    f"""WITH {SEMANTIC}, ranked AS (
      SELECT query_id, doc_id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, day DESC, doc_id) AS rank
      FROM (SELECT query_id, doc_id, round(score, 1) AS s, doc_id % 120 AS day FROM nearest) WHERE s >= 0.2)
    SELECT query_id, doc_id, s AS score, rank FROM ranked WHERE rank <= 15""",
)
def rerank_cut(spark, sf_dir):
    scores = hybrid.semantic_scores(_vectors(spark, sf_dir), _centroids(spark, sf_dir), 50)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 120).cast("int"))
    dated = scores.withColumns({"score": F.round("score", 1), "published_ts": day})
    return retrieval.rerank_cut(dated).select(
        "query_id", "doc_id", "score", F.col("rank").cast("long").alias("rank")
    )


@query(
    "quality_label",
    """SELECT 'post' AS kind, event_id AS id,
      CASE WHEN user_id * 80 >= 8000 THEN 'well_received' ELSE 'post' END AS label
    FROM events WHERE event_type = 'click'
    UNION ALL
    SELECT 'paper', doc_id, CASE WHEN quality = 1 AND doc_id % 101 > 70 THEN 'peer_reviewed' ELSE 'preprint' END
    FROM labels
    UNION ALL
    SELECT 'blog', doc_id, 'blog' FROM documents""",
)
def quality_label(spark, sf_dir):
    posts = i.table(spark, sf_dir, "events").where("event_type = 'click'").select(
        F.col("event_id").alias("id"), (F.col("user_id") * 80).alias("upvote_ratio_bp")
    )
    verdict = F.when(F.col("quality") == 1, "accept").otherwise("reject")
    papers = i.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), verdict.alias("quality_verdict"), (F.col("doc_id") % 101).alias("quality_i")
    )
    blogs = i.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return retrieval.label_quality(posts, papers, blogs).select("kind", "id", "label")


CITED = """
answers AS (
  SELECT conv_id, turn, text || ' Shown [' || turn || ']()[2]()[2](). Also [9] and [12](). End' AS text
  FROM conversations
),
marked AS (
  SELECT *, [x FOR x IN string_split(regexp_replace(text, '([.!?])([ \\t\\n\\f\\r\\x0b]+|$)', '\\1' || chr(1), 'g'), chr(1))
    IF trim(x) <> ''] AS sentences, regexp_extract_all(text, '\\[(\\d+)\\]\\(\\)', 1) AS found
  FROM answers
)
SELECT conv_id, turn,
  array_to_string([x FOR x IN list_sort(list_distinct(found))], ',') AS cited,
  array_to_string(list_sort(list_distinct([x FOR x IN found IF x NOT IN ('0', '1', '2', '3')])), ',') AS invalid,
  CAST(len([s FOR s IN sentences IF len(regexp_extract_all(s, '\\[(\\d+)\\]\\(\\)', 1))
    > len(list_distinct(regexp_extract_all(s, '\\[(\\d+)\\]\\(\\)', 1)))]) AS BIGINT) AS repeated,
  CAST(len([s FOR s IN sentences IF NOT regexp_matches(s, '\\[(\\d+)\\]\\(\\)')]) AS BIGINT) AS uncited
FROM marked
"""


@query("citation_check", f"WITH {CITED}")
def citation_check(spark, sf_dir):
    body = F.concat(
        "text", F.lit(" Shown ["), F.col("turn").cast("string"), F.lit("]()[2]()[2](). Also [9] and [12](). End")
    )
    allowed = F.array(*[F.lit(str(n)) for n in range(4)])
    answers = i.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", body.alias("text"), allowed.alias("allowed")
    )
    checked = retrieval.citation_check(answers)
    return checked.select(
        "conv_id", "turn",
        F.array_join(F.array_sort("cited"), ",").alias("cited"),
        F.array_join(F.array_sort("invalid"), ",").alias("invalid"),
        F.col("repeated").cast("long").alias("repeated"), F.col("uncited").cast("long").alias("uncited"),
    )


@query(
    "message_history",
    """SELECT conv_id, turn // 4 AS part, count(*) AS n,
      string_agg(turn || ':' || role || ':' || text, '|' ORDER BY turn, role, text) AS messages
    FROM conversations GROUP BY ALL""",
)
def message_history(spark, sf_dir):
    parts = retrieval.message_history(i.table(spark, sf_dir, "conversations"), 4)

    def line(m):
        entry = F.concat_ws(":", m["turn"].cast("string"), m["role"], m["text"])
        return F.array_join(F.array_repeat(entry, m["copies"].cast("int")), "|")

    n = F.aggregate("messages", F.lit(0).cast("long"), lambda s, m: s + m["copies"])
    return parts.select(
        "conv_id", "part", n.alias("n"), F.array_join(F.transform("messages", line), "|").alias("messages")
    )
