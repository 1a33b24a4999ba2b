"""Rendered documents and delivery results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fields


def render_documents(articles: DataFrame) -> DataFrame:
    """One text document per article: filename, body, metadata. A pure projection."""
    return articles.select(
        "id",
        "source",
        fields.document_name(F.col("id"), F.col("published_date")).alias("filename"),
        fields.document_body().alias("body"),
        fields.document_metadata().alias("metadata"),
    )


def delivery_items(log: DataFrame) -> DataFrame:
    """Outcome of each delivery; the whole list stays a table."""
    return log.select(
        "source",
        F.when(F.col("document_id").isNotNull(), "delivered").otherwise("failed").alias("outcome"),
        "article_id",
        "document_id",
        F.when(F.col("document_id").isNull(), F.col("url")).alias("url"),
    )


def delivery_summary(log: DataFrame, configured: bool = True) -> DataFrame:
    """Counts of a delivery run. Without configuration everything failed."""
    delivered = F.col("document_id").isNotNull() if configured else F.lit(False)
    return log.agg(
        F.count("*").alias("total"),
        F.count_if(delivered).alias("successful"),
        F.count_if(~delivered).alias("failed"),
        F.lit(None if configured else "delivery is not configured").cast("string").alias("error"),
    )
