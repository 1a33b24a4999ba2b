"""Batch search over the article table: lexical, semantic and hybrid ranking.

Scores follow the published BM25 and cosine definitions. Documents carry a
``length`` in words, so corpus averages read one narrow column. ``bags`` scores a
batch of queries in one pass over the documents; ``index``, ``nearest`` and ``hybrid``
give the best of each query from an index, without scoring the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..params import RERANK_THRESHOLD, RERANK_TOP_K, TOP_K
from .bags import lexical_scores  # noqa: F401
from .skew import first_per_group
from .terms import B, DIGITS, K1, query_terms, terms  # noqa: F401

def cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    # a zero vector is similar to nothing
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b))), F.lit(0.0))


def hybrid_topk(scores: DataFrame, k: int = TOP_K) -> DataFrame:
    """Best ``k`` documents per query with their rank."""
    return first_per_group(scores, ["query_id"], [F.desc("score"), F.col("doc_id")], k, rank="rank")


def rerank_cut(
    scores: DataFrame,
    threshold: float = RERANK_THRESHOLD,
    k: int = RERANK_TOP_K,
    published: str = "published_ts",
) -> DataFrame:
    """Rows at or above the threshold, the best ``k`` per query; newer first on ties."""
    good = scores.where(F.col("score") >= threshold)
    order = [F.desc("score"), F.desc_nulls_last(published), F.col("doc_id")]
    return first_per_group(good, ["query_id"], order, k, rank="rank")


def label_quality(posts: DataFrame, papers: DataFrame, blogs: DataFrame) -> DataFrame:
    """One table of the three kinds of results with a quality label.

    Posts need ``upvote_ratio_bp``, papers ``quality_verdict`` and ``quality_i``.
    """
    well_received = F.when(F.col("upvote_ratio_bp") >= 8000, "well_received").otherwise("post")
    reviewed = F.when(
        (F.col("quality_verdict") == "accept") & (F.col("quality_i") > 70), "peer_reviewed"
    ).otherwise("preprint")
    tagged = (
        posts.withColumns({"kind": F.lit("post"), "label": well_received}),
        papers.withColumns({"kind": F.lit("paper"), "label": reviewed}),
        blogs.withColumns({"kind": F.lit("blog"), "label": F.lit("blog")}),
    )
    return (
        tagged[0]
        .unionByName(tagged[1], allowMissingColumns=True)
        .unionByName(tagged[2], allowMissingColumns=True)
    )


_CITATION = r"\[(\d+)\]\(\)"


def citation_check(answers: DataFrame) -> DataFrame:
    """Check the ``[n]()`` tokens of each answer against its allowed ids.

    ``answers``: text and ``allowed`` (array of ids as text). Adds ``cited``
    (distinct ids in order), ``invalid`` (not allowed), ``repeated`` (cited more
    than once in a sentence) and ``uncited`` (sentences without a citation).
    """
    found = F.regexp_extract_all("text", F.lit(_CITATION), F.lit(1))
    marked = F.regexp_replace("text", r"([.!?])(\s+|\z)", "$1\x01")
    sentences = F.filter(F.split(marked, "\x01"), lambda s: F.trim(s) != "")

    def ids(s: Column) -> Column:
        return F.regexp_extract_all(s, F.lit(_CITATION), F.lit(1))

    repeats = F.filter(sentences, lambda s: F.size(ids(s)) > F.size(F.array_distinct(ids(s))))
    return answers.withColumns(
        {
            "cited": F.array_distinct(found),
            "invalid": F.array_except(found, F.col("allowed")),
            "repeated": F.size(repeats),
            "uncited": F.size(F.filter(sentences, lambda s: ~s.rlike(_CITATION))),
        }
    )


HISTORY_BLOCK = 256


def message_history(turns: DataFrame, block: int = HISTORY_BLOCK) -> DataFrame:
    """Turns of a conversation in order, as arrays of consecutive turns.

    Array ``part`` holds the turns from ``part * block`` on, so a conversation of
    any length is whole but never one value. Equal rows are counted first, in
    ``copies``, so that they do not fill a group.
    """
    counted = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    part = F.floor(F.col("turn") / block).cast("long")
    entry = F.struct("turn", "role", "text", "copies")
    return counted.groupBy("conv_id", part.alias("part")).agg(
        F.array_sort(F.collect_list(entry)).alias("messages")
    )
