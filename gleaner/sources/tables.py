"""Readers and writers of the stored tables.

Every table is partitioned by run and source. Runs go through the store's commit
log (``log``): what a run wrote is seen as a whole once it is committed, a repeated
run changes nothing, and nothing that is being read is rewritten.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import store
from ..operators.documents import render_documents
from ..operators.registry import registry_from_json, registry_json
from ..schema import ARTICLE, ARTICLE_COLUMNS, DELIVERY, DOCUMENT, FEEDS_RAW, MANIFEST, PAGES, REGISTRY, SNAPSHOT
from ..session import materialised, spread
from .log import Files, Run, read_table


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spread(spark.read.schema(PAGES).parquet(path))


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    return spread(spark.read.schema(FEEDS_RAW).parquet(path))


def _save_alone(df: DataFrame, store_path: str, table: str, key: object, *partitions: str) -> None:
    """A run of one table. A key that was committed before changes nothing."""
    run = Run(df.sparkSession, store_path, None if key is None else f"{table} {key}")
    run.write(table, df, *partitions)
    run.commit()


def newest(rows: DataFrame, key: str = "id") -> DataFrame:
    """The newest version of each key in a table that was read with its ``run_seq``.

    Only the key, the run and each row's place in its file are shuffled. The
    places of superseded rows are written, so Spark knows their size: few are
    sent to the readers, and whole rows are shuffled only where most are old.
    """
    place = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    try:
        rows.select(*place.values())
    except AnalysisException:  # nothing was stored, so there are no files
        return rows
    narrow = rows.select(key, "run_seq", *[c.alias(n) for n, c in place.items()])
    order = Window.partitionBy(key).orderBy(F.desc("run_seq"), "_file", "_row")
    old = narrow.withColumn("_rank", F.row_number().over(order)).where("_rank > 1").select("_file", "_row")
    return rows.withColumns(place).join(materialised(old, "superseded"), ["_file", "_row"], "left_anti").select(*rows.columns)


def save_articles(articles: DataFrame, store_path: str, key: object = None) -> None:
    """Append articles as a run of their own; an id stored before is replaced when it is read."""
    _save_alone(articles.select(*ARTICLE_COLUMNS), store_path, "articles", key, "source")


def read_article_versions(spark: SparkSession, store_path: str) -> DataFrame:
    return read_table(spark, store_path, "articles", ARTICLE)


def read_articles(spark: SparkSession, store_path: str, source: str | None = None) -> DataFrame:
    """Newest version of every article; a source restriction prunes partitions."""
    return newest(store.export_articles(read_article_versions(spark, store_path), source)).drop("run_seq")


def load_article(spark: SparkSession, store_path: str, source: str, id_) -> DataFrame:
    """The newest version of one article; no row where there is none."""
    found = store.load_article(read_article_versions(spark, store_path), source, id_)
    return found.orderBy(F.desc("run_seq")).limit(1).drop("run_seq")


def compact_articles(spark: SparkSession, store_path: str, target_path: str, key: object = None) -> None:
    """Rewrite the newest versions as one run of another store."""
    save_articles(read_articles(spark, store_path), target_path, key)


def save_manifest(articles: DataFrame, store_path: str, key: object = None) -> None:
    _save_alone(store.manifest_rows(articles), store_path, "manifest", key, "source")


def read_manifest(spark: SparkSession, store_path: str) -> DataFrame:
    return store.latest(read_table(spark, store_path, "manifest", MANIFEST)).drop("run_seq")


def save_registry(new_rows: DataFrame, store_path: str, key: object = None) -> None:
    """Append accepted pairs."""
    _save_alone(new_rows.select("source", "url").distinct(), store_path, "registry", key, "source")


def read_registry(spark: SparkSession, store_path: str, only: list[int] | None = None) -> DataFrame:
    """Pairs that visible runs accepted; ``only`` restricts to some runs, as to those a run judged against."""
    return read_table(spark, store_path, "registry", REGISTRY, only).select("source", "url")


def read_pending(spark: SparkSession, store_path: str) -> DataFrame:
    """URLs that listings named in visible runs, also those that were read since."""
    return read_table(spark, store_path, "pending", REGISTRY).select("source", "url").distinct()


def read_registry_before(spark: SparkSession, store_path: str, run_seq: int) -> DataFrame:
    """Registry of the runs with smaller numbers."""
    rows = read_table(spark, store_path, "registry", REGISTRY)
    return rows.where(F.col("run_seq") < run_seq).select("source", "url")


def save_registry_table(registry: DataFrame, table: str, buckets: int) -> None:
    """Registry as a catalog table bucketed by the join key.

    The seen-URL join then reads it without a shuffle on its side.
    """
    rows = registry.select("source", "url").distinct().repartition(buckets, "source", "url")
    writer = rows.write.mode("overwrite").bucketBy(buckets, "source", "url")
    writer.sortBy("source", "url").saveAsTable(table)


def export_registry(registry: DataFrame, path: str) -> None:
    """Registry as JSON lines, each mapping a source to a sorted array of URLs."""
    lines = registry_json(registry)
    lines.repartitionByRange("source", "part").sortWithinPartitions("source", "part").select(
        "value"
    ).write.mode("overwrite").text(path)


def import_registry(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Registry from JSON lines, or from files that each hold one JSON object."""
    if whole_file and not Files(spark).exists(path):
        return spark.createDataFrame([], REGISTRY)
    return registry_from_json(spark.read.text(path, wholetext=whole_file))


def save_html_snapshots(articles: DataFrame, store_path: str, key: object = None, newest_by: list[str] | None = None) -> None:
    """Append a run of snapshots. An id that is in it more than once keeps the row with the highest ``newest_by``."""
    _save_alone(store.html_snapshots(articles, newest_by), store_path, "html_snapshots", key, "source")


def read_html_snapshots(spark: SparkSession, store_path: str) -> DataFrame:
    """Newest snapshot of every id: source, id, content_html."""
    return newest(read_table(spark, store_path, "html_snapshots", SNAPSHOT)).drop("run_seq")


def save_documents(articles: DataFrame, store_path: str, key: object = None) -> None:
    _save_alone(render_documents(articles), store_path, "documents", key, "source")


def read_documents(spark: SparkSession, store_path: str, run_seq: int | None = None) -> DataFrame:
    """Newest version of every document, or the documents of one run."""
    if run_seq is not None:
        return read_table(spark, store_path, "documents", DOCUMENT, [run_seq]).drop("run_seq")
    return newest(read_table(spark, store_path, "documents", DOCUMENT)).drop("run_seq")


def read_deliveries(spark: SparkSession, store_path: str) -> DataFrame:
    """The last outcome of every document that was handed over, with the run that did it."""
    return store.latest(read_table(spark, store_path, "deliveries", DELIVERY), "filename")


def save_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def clear_source(spark: SparkSession, store_path: str, source: str) -> int:
    """Hide a source's articles, snapshots and manifest; the registry stays.

    Returns the number of articles removed. Later runs may store the source anew.
    """
    versions = read_article_versions(spark, store_path).where(F.col("source") == source)
    removed = versions.select("id").distinct().count()
    run = Run(spark, store_path)
    run.commit(cleared={table: [source] for table in ("articles", "html_snapshots", "manifest")})
    return removed
