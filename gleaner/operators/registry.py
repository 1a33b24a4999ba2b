"""Registry of URLs already taken, as (source, url) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .skew import join_dimension

KEYS = ["source", "url"]
TARGET_URLS = 100_000


def registry_from_json(values: DataFrame, column: str = "value") -> DataFrame:
    """Rows from JSON objects that map a source to an array of URLs.

    A source may be spread over many objects; repeated URLs collapse.
    """
    parsed = F.from_json(column, "map<string,array<string>>")
    per_source = values.select(F.explode(parsed).alias("source", "urls"))
    return per_source.select("source", F.explode("urls").alias("url")).distinct()


def registry_rows(articles: DataFrame) -> DataFrame:
    """Distinct non-empty (source, url) pairs."""
    return articles.where(F.col("url") != "").select(*KEYS).distinct()


def registry_union(registry: DataFrame, articles: DataFrame) -> DataFrame:
    """Registry after a run: old rows plus the accepted articles' URLs."""
    fresh = articles.where(F.col("url") != "").select(*KEYS)
    return registry.select(*KEYS).unionByName(fresh).distinct()


def registry_arrays(registry: DataFrame, target: int = TARGET_URLS) -> DataFrame:
    """Sorted URL arrays: (source, part, parts, urls).

    A source with at most ``target`` URLs is one array. A larger one is split by
    URL hash into arrays of about ``target``, so no task holds a whole source.
    Only sources above the target are joined in, at most total / target of them.
    """
    rows = registry.select(*KEYS).distinct()
    sizes = rows.groupBy("source").count().where(F.col("count") > target)
    parts = sizes.select("source", F.ceil(F.col("count") / target).alias("parts"))
    spread = join_dimension(rows, parts, "source", "left")
    spread = spread.withColumn("parts", F.coalesce("parts", F.lit(1)).cast("long"))
    spread = spread.withColumn("part", F.pmod(F.xxhash64("url"), F.col("parts")))
    return spread.groupBy("source", "parts", "part").agg(F.array_sort(F.collect_list("url")).alias("urls"))


def registry_json(registry: DataFrame, target: int = TARGET_URLS) -> DataFrame:
    """One JSON object per array, in the layout ``registry_from_json`` reads."""
    arrays = registry_arrays(registry, target)
    packed = F.to_json(F.create_map(F.col("source"), F.col("urls")))
    return arrays.select("source", "part", packed.alias("value"))


def unseen(df: DataFrame, registry: DataFrame, keep_blank: bool = True) -> DataFrame:
    """Rows whose (source, url) is not registered.

    The test is per source and exact. Rows without a URL pass and never enter
    the join, where they would all meet in one partition; callers that dropped
    them already pass ``keep_blank=False`` and save the second branch.
    """
    known = registry.select(*KEYS)
    with_url = df.where(F.col("url") != "").join(known, KEYS, "left_anti").select(*df.columns)
    if not keep_blank:
        return with_url
    return with_url.unionByName(df.where(F.coalesce(F.col("url") == "", F.lit(True))))


def new_urls(discovered: DataFrame, registry: DataFrame) -> DataFrame:
    """Distinct discovered pairs that are not registered."""
    return discovered.select(*KEYS).subtract(registry.select(*KEYS))


def scraped_urls(manifest: DataFrame, source: str | None = None) -> DataFrame:
    """Distinct non-empty URLs, of all sources or one."""
    rows = manifest if source is None else manifest.where(F.col("source") == source)
    return rows.where(F.col("url") != "").select("url").distinct()


def registry_size(registry: DataFrame) -> DataFrame:
    """Total URLs and number of sources: two levels of counting, no distinct set."""
    per_source = registry.groupBy("source").agg(F.count("*").alias("n"))
    return per_source.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("urls"), F.count("*").alias("sources")
    )
