"""Inverted index with block maxima, and the best documents of each query without scoring the rest.

Documents are dealt to blocks of a few hundred by a hash of their id. The postings
of a term are one row per block, with the largest and the smallest share that the
term can add to a score there. A query adds these up: no document of a block can
score more than the sum of the maxima. The blocks with the highest bounds are
scored first; blocks whose bound stays below the k-th best score found are never
read. Bounds are narrow rows, a block for some hundred documents.

Scores are BM25 as in ``retrieval``: the share of a term in a document is fixed when
the index is built, its weight follows from the number of documents that hold it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..params import TOP_K
from ..session import materialised
from .skew import first_per_group
from .terms import B, DIGITS, K1, query_terms, terms

#: Documents of a block, and blocks that each query scores before it knows a threshold.
BLOCK_DOCS, FIRST_BLOCKS = 256, 8
#: Scores are rounded to nine digits; a bound counts as reached within this.
SLACK = 1e-8


@dataclass(frozen=True)
class TextIndex:
    """``postings``: term, block, top, low, n, postings (doc_id, share); ``vocabulary``: term, idf."""

    postings: DataFrame
    vocabulary: DataFrame
    n_docs: int
    n_blocks: int

    @property
    def headers(self) -> DataFrame:
        return self.postings.select("term", "block", "top", "low")


def build_index(docs: DataFrame, path: str, vocabulary: DataFrame | None = None) -> None:
    """Write the index of ``docs`` (doc_id, text, length); null texts have no postings but count as documents.

    With ``vocabulary`` (term) only these terms are posted, for a known set of queries.
    """
    spark = docs.sparkSession
    corpus = docs.agg(F.count("*").alias("n_docs"), (F.sum("length") / F.count("*")).alias("avg_length")).first()
    n_blocks = max(1, -(-corpus["n_docs"] // BLOCK_DOCS))
    average = float(corpus["avg_length"] or 1.0)
    tokens = docs.select("doc_id", "length", F.explode(terms(F.col("text"))).alias("term"))
    if vocabulary is not None:
        tokens = tokens.join(materialised(vocabulary.select("term").distinct(), "vocabulary"), "term", "left_semi")
    counts = tokens.groupBy("doc_id", "length", "term").agg(F.count("*").alias("tf"))
    norm = F.lit(K1) * (1 - B + B * F.col("length") / F.lit(average))
    share = F.col("tf") * (K1 + 1) / (F.col("tf") + norm)
    posted = counts.select("term", block_of(F.col("doc_id"), n_blocks).alias("block"), "doc_id", share.alias("share"))
    blocks = posted.groupBy("term", "block").agg(
        F.max("share").alias("top"), F.min("share").alias("low"), F.count("*").alias("n"), F.collect_list(F.struct("doc_id", "share")).alias("postings")
    )
    blocks.sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{path}/postings")
    stored = spark.read.parquet(f"{path}/postings")
    spread = stored.groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.log(1 + (F.lit(corpus["n_docs"]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    spread.select("term", "df", idf.alias("idf")).write.mode("overwrite").parquet(f"{path}/vocabulary")
    size = spark.createDataFrame([(corpus["n_docs"], n_blocks)], "n_docs long, n_blocks long").coalesce(1)
    size.write.mode("overwrite").parquet(f"{path}/corpus")


def open_index(spark: SparkSession, path: str) -> TextIndex:
    size = spark.read.parquet(f"{path}/corpus").first()
    return TextIndex(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/vocabulary"), size["n_docs"], size["n_blocks"])


def block_of(doc_id: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(n_blocks))


@dataclass(frozen=True)
class Asked:
    """What a set of queries asks of an index: ``wanted`` (query_id, term, idf) and ``bounds`` (query_id, block, high, low)."""

    index: TextIndex
    wanted: DataFrame
    bounds: DataFrame

    def only(self, queries: DataFrame) -> Asked:
        """The same for some of the queries (query_id)."""
        few = queries.select("query_id")
        return Asked(self.index, self.wanted.join(few, "query_id", "left_semi"), self.bounds.join(few, "query_id", "left_semi"))


def ask(index: TextIndex, queries: DataFrame) -> Asked:
    """The query terms that some document holds, and what any matching document of a block scores at most and at least.

    Both are written, so Spark knows their sizes in the joins that follow.
    """
    wanted = materialised(query_terms(queries).join(index.vocabulary.select("term", "idf"), "term"), "wanted")
    met = index.headers.join(wanted, "term")
    high, low = F.sum(F.col("idf") * F.col("top")), F.min(F.col("idf") * F.col("low"))
    bounds = met.groupBy("query_id", "block").agg(high.alias("high"), low.alias("low"))
    return Asked(index, wanted, materialised(bounds, "bounds"))


def score_blocks(asked: Asked, chosen: DataFrame) -> DataFrame:
    """(query_id, doc_id, score) of all matching documents of the ``chosen`` (query_id, block)."""
    keys = chosen.select("query_id", "block").join(asked.wanted, "query_id")
    met = asked.index.postings.select("term", "block", "postings").join(keys, ["term", "block"])
    rows = met.select("query_id", "idf", F.inline("postings"))
    totals = rows.groupBy("query_id", "doc_id").agg(F.sum(F.col("idf") * F.col("share")).alias("score"))
    return totals.withColumn("score", F.round("score", DIGITS))


def score_pairs(asked: Asked, pairs: DataFrame) -> DataFrame:
    """(query_id, doc_id, score) of those given pairs (query_id, doc_id) that share a term."""
    index = asked.index
    placed = pairs.select("query_id", F.col("doc_id").alias("_doc"), block_of(F.col("doc_id"), index.n_blocks).alias("block"))
    keys = placed.join(asked.wanted, "query_id")
    met = index.postings.select("term", "block", "postings").join(keys, ["term", "block"])
    own = F.filter("postings", lambda p: p["doc_id"] == F.col("_doc"))
    rows = met.select("query_id", "idf", F.inline(own))
    totals = rows.groupBy("query_id", "doc_id").agg(F.sum(F.col("idf") * F.col("share")).alias("score"))
    return totals.withColumn("score", F.round("score", DIGITS))


def _best(rows: DataFrame, k: int) -> DataFrame:
    return first_per_group(rows, ["query_id"], [F.desc("score"), F.col("doc_id")], k)


def best_of(asked: Asked, k: int, first: int = FIRST_BLOCKS) -> DataFrame:
    """The exact best ``k`` documents of each query: query_id, doc_id, score; ties by doc_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("high"), "block")
    ranked = asked.bounds.withColumn("_turn", F.row_number().over(order))
    found = materialised(_best(score_blocks(asked, ranked.where(F.col("_turn") <= first)), k), "found")
    least = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(float("-inf"))).alias("least"))
    rest = ranked.where(F.col("_turn") > first).join(least, "query_id").where(F.col("high") >= F.col("least") - SLACK)
    return _best(found.unionByName(score_blocks(asked, rest)), k)


def lowest_of(asked: Asked, first: int = FIRST_BLOCKS) -> DataFrame:
    """(query_id, low): the exact lowest score of the matching documents of each query, by the smallest shares."""
    order = Window.partitionBy("query_id").orderBy("bound", "block")
    ranked = asked.bounds.withColumnRenamed("low", "bound").withColumn("_turn", F.row_number().over(order))
    lowest = score_blocks(asked, ranked.where(F.col("_turn") <= first)).groupBy("query_id").agg(F.min("score").alias("low"))
    lowest = materialised(lowest, "lowest")
    rest = ranked.where(F.col("_turn") > first).join(lowest, "query_id").where(F.col("bound") <= F.col("low") + SLACK)
    others = score_blocks(asked, rest).groupBy("query_id").agg(F.min("score").alias("low"))
    return lowest.unionByName(others).groupBy("query_id").agg(F.min("low").alias("low"))


def lexical_topk(index: TextIndex, queries: DataFrame, k: int = TOP_K, first: int = FIRST_BLOCKS) -> DataFrame:
    """The exact best ``k`` documents of each query (query_id, text): query_id, doc_id, score; ties by doc_id.

    A query without a known term has no rows.
    """
    return best_of(ask(index, queries), k, first)
