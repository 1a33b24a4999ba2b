"""Best documents by a weighted sum of a lexical and a semantic score, merged from two ranked lists.

Both lists are read from the top, n rows a query. Every document that either list
shows gets its other score looked up. A document that neither has shown yet cannot
beat the sum of what both lists have come down to; a query is finished when its k-th
best sum is above that, else its lists are read four times as deep. So documents
that stand in the middle of both lists are never scored.

A document may lack a text, a vector, or both, and a query its vector: a missing
score counts 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..params import LEXICAL_WEIGHT, SEMANTIC_WEIGHT, TOP_K
from ..session import materialised, scratch_dir
from .index import Asked, TextIndex, ask, best_of, build_index, lowest_of, open_index, score_pairs
from .nearest import VectorIndex, build_vector_index, lowest_scores, nearest, open_vector_index
from .retrieval import DIGITS, cosine, query_terms
from .skew import first_per_group

PAIR = ["query_id", "doc_id"]
#: How many times deeper the lists of an unfinished query are read in the next round.
DEEPER = 4


def semantic_scores(docs: DataFrame, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """Exact ``k`` nearest documents of each query by cosine, by an index that is built first.

    ``docs``: doc_id, vector. ``queries``: query_id, vector.
    """
    path = scratch_dir(docs.sparkSession, "vectors")
    build_vector_index(docs.select("doc_id", "vector"), path)
    return nearest(open_vector_index(docs.sparkSession, path), queries.select("query_id", "vector"), k)


def hybrid_scores(
    docs: DataFrame, queries: DataFrame, k: int = TOP_K, lexical_weight: float = LEXICAL_WEIGHT, semantic_weight: float = SEMANTIC_WEIGHT
) -> DataFrame:
    """The best ``k`` documents of each query, by indexes that are built first.

    ``docs``: doc_id, text, length, vector. ``queries``: query_id, text, vector. See ``merged_topk``.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "hybrid")
    build_index(docs.select("doc_id", "text", "length"), f"{path}/text", query_terms(queries).select("term"))
    vectors = docs.select("doc_id", "vector").where(F.size("vector") > 0)
    build_vector_index(vectors, f"{path}/vectors")
    text_index, vector_index = open_index(spark, f"{path}/text"), open_vector_index(spark, f"{path}/vectors")
    return merged_topk(text_index, vector_index, vectors, queries, k, lexical_weight, semantic_weight)


def _scaled(score: Column, low: Column, high: Column) -> Column:
    """0 to 1 between the lowest and the highest score of the query; 1 where these are equal, 0 where there is no score."""
    return F.coalesce(F.when(high > low, (score - low) / (high - low)).when(score.isNotNull(), F.lit(1.0)), F.lit(0.0))


def _ends(listed: DataFrame, n: int, name: str) -> DataFrame:
    """(query_id, name_high, name_last): the first score of a list, and its last one, null where the list is at its end."""
    last = F.when(F.count("*") >= n, F.min("score"))
    return listed.groupBy("query_id").agg(F.max("score").alias(f"{name}_high"), last.alias(f"{name}_last"))


def merged_topk(
    text_index: TextIndex,
    vector_index: VectorIndex,
    vectors: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    lexical_weight: float = LEXICAL_WEIGHT,
    semantic_weight: float = SEMANTIC_WEIGHT,
) -> DataFrame:
    """The exact best ``k`` of each query: query_id, doc_id, lexical, semantic, score; ties by doc_id.

    Both scores are scaled to 0..1 over all documents that have one for the query;
    documents with neither are not ranked. ``vectors`` (doc_id, vector) are those
    of the index, for looking up single scores. ``queries``: query_id, text, vector.
    """
    left = materialised(queries.select("query_id", "text", "vector"), "queries")
    asked = ask(text_index, left)
    lows = left.select("query_id").join(lowest_of(asked).withColumnRenamed("low", "lex_low"), "query_id", "left")
    lows = materialised(lows.join(lowest_scores(vector_index, left).withColumnRenamed("low", "sem_low"), "query_id", "left"), "lows")
    finished: list[DataFrame] = []
    n = DEEPER * k
    while True:
        best, unfinished = _round(asked, vector_index, vectors, left, lows, n, k, lexical_weight, semantic_weight)
        finished.append(best.join(unfinished, "query_id", "left_anti"))
        if unfinished.isEmpty():
            break
        left, asked, n = left.join(unfinished, "query_id", "left_semi"), asked.only(unfinished), n * DEEPER
    rows = finished[0]
    for more in finished[1:]:
        rows = rows.unionByName(more)
    return rows


def _round(
    asked: Asked, vector_index: VectorIndex, vectors: DataFrame, left: DataFrame, lows: DataFrame, n: int, k: int, w_lex: float, w_sem: float
) -> tuple[DataFrame, DataFrame]:
    """(best k of what n rows of both lists show, queries that are not finished)."""
    lexical = materialised(best_of(asked, n), "lexical")
    semantic = materialised(nearest(vector_index, left, n), "semantic")
    ends = lows.join(_ends(lexical, n, "lex"), "query_id", "left").join(_ends(semantic, n, "sem"), "query_id", "left")
    shown = lexical.select(*PAIR).unionByName(semantic.select(*PAIR)).distinct()
    lex = lexical.unionByName(score_pairs(asked, shown.join(lexical, PAIR, "left_anti"))).withColumnRenamed("score", "lex")
    own = vectors.select("doc_id", F.col("vector").alias("_d"))
    both = shown.join(semantic, PAIR, "left_anti").join(own, "doc_id")
    both = both.join(left.where(F.size("vector") > 0).select("query_id", F.col("vector").alias("_q")), "query_id")
    looked_up = both.select(*PAIR, F.round(cosine(F.col("_d"), F.col("_q")), DIGITS).alias("score"))
    sem = semantic.unionByName(looked_up).withColumnRenamed("score", "sem")

    def parts(lex_score: str, sem_score: str) -> tuple[Column, Column]:
        lexical_part = _scaled(F.col(lex_score), F.col("lex_low"), F.col("lex_high"))
        return lexical_part, _scaled(F.col(sem_score), F.col("sem_low"), F.col("sem_high"))

    lexical_part, semantic_part = parts("lex", "sem")
    scored = lex.join(sem, PAIR, "full_outer").join(ends, "query_id")
    summed = scored.select(*PAIR, lexical_part.alias("lexical"), semantic_part.alias("semantic")).withColumn(
        "score", w_lex * F.col("lexical") + w_sem * F.col("semantic")
    )
    best = materialised(first_per_group(summed, ["query_id"], [F.desc("score"), F.col("doc_id")], k), "best")
    kth = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    lexical_part, semantic_part = parts("lex_last", "sem_last")
    states = ends.join(kth, "query_id", "left").withColumn("bound", w_lex * lexical_part + w_sem * semantic_part)
    goes_on = F.col("lex_last").isNotNull() | F.col("sem_last").isNotNull()
    beaten = F.coalesce((F.col("n") >= k) & (F.col("least") > F.col("bound")), F.lit(False))
    return best, materialised(states.where(goes_on & ~beaten).select("query_id"), "unfinished")
