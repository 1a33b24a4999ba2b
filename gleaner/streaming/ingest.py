"""Incremental runs over landed files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import filters
from ..operators.registry import unseen
from ..params import RunParams
from ..plans.commit import commit_run
from ..plans.runs import discovered, feed_run, judged_pages
from ..schema import FEEDS_RAW, LISTINGS, PAGES_LANDED
from ..session import materialised
from ..sources import tables
from ..sources.log import Files, find


def read_landed(spark: SparkSession, path: str, schema: str, name: str | None = None, max_files: int | None = None) -> DataFrame:
    """Stream of the parquet files that appear below ``path``."""
    reader = spark.readStream.schema(schema)
    if name is not None:
        reader = reader.option("pathGlobFilter", name)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def lookback_stream(articles: DataFrame, as_of: str, days: int | None) -> DataFrame:
    """Drop late rows by the run's clock; a watermark would move with the data."""
    return filters.lookback_filter(articles, as_of, days)


def dedup_stream(articles: DataFrame, as_of: str, params) -> DataFrame:
    """First row of each (source, url) that passes the filters, over all batches.

    Filters come first: a rejected URL is not remembered and may pass later.
    """
    kept = filters.accepted(filters.with_reason(articles, as_of, params))
    return kept.dropDuplicates(["source", "url"])


def dedup_stream_bounded(articles: DataFrame, event_time: str, horizon: str = "60 days") -> DataFrame:
    """As above with state that forgets URLs older than the horizon."""
    return articles.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(["source", "url"])


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint when it was first started."""
    return json.loads(Files(spark).read(f"{checkpoint}/metadata"))["id"]


def start_ingest(
    feeds: DataFrame,
    catalog: DataFrame,
    store_path: str,
    checkpoint: str,
    params: RunParams,
    pages: DataFrame | None = None,
    deliver=None,
):
    """Run the feed plan on every batch of landed feeds and commit it to all sinks.

    The registry join replaces streaming state, so the set of known URLs may grow
    without bound. A batch is one run of the store, named after the stream's own id
    and the batch: a batch that is repeated after its commit changes nothing, one that
    failed before left nothing that is read, and a stream with a new checkpoint is
    another stream, whose runs stand beside those of the first.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key = f"stream {stream_id(spark, checkpoint)} batch {batch_id}"
        if find(spark, store_path, key) is None:
            known = tables.read_registry(spark, store_path)
            commit_run(feed_run(batch, catalog, known, params, pages), store_path, key, params, deliver)

    writer = feeds.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def start_page_ingest(
    spark: SparkSession,
    listings: str,
    pages: str,
    catalog: DataFrame,
    store_path: str,
    checkpoint: str,
    params: RunParams,
    deliver=None,
    max_files: int | None = None,
):
    """Run the page plan over two folders, of landed listings and of landed pages, in whatever order they come.

    URLs that a listing names are kept in the table ``pending`` of the store, in the
    run that found them. In each batch, URLs found in it meet all pages that have
    landed, and URLs found earlier meet the pages of the batch; so a page is read
    when the later of the two comes. What passes is registered and no longer
    pending; a page that is rejected is judged again when a new version lands. A batch
    is bounded by its files, not by a cap per source, which would lose URLs: a
    listing comes once.
    """
    blank = F.lit(None).cast("string")
    found = read_landed(spark, listings, LISTINGS, max_files=max_files).select(
        F.lit(True).alias("is_listing"), "source_id", "page_id", blank.alias("url"), "html", "landed_at"
    )
    landed = read_landed(spark, pages, PAGES_LANDED, max_files=max_files).select(
        F.lit(False).alias("is_listing"), blank.alias("source_id"), "page_id", "url", "html", "landed_at"
    )

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        key = f"stream {stream_id(session, checkpoint)} batch {batch_id}"
        if find(session, store_path, key) is not None:
            return
        known = None if params.force_rescrape else tables.read_registry(session, store_path)
        rows = materialised(batch, "landed")
        fresh = discovered(rows.where("is_listing"), catalog, known, params).select("source", "url")
        waiting = tables.read_pending(session, store_path)
        if known is not None:
            waiting = unseen(waiting, known, keep_blank=False)
        fresh = materialised(unseen(fresh, waiting, keep_blank=False), "fresh")
        everything = session.read.schema(PAGES_LANDED).parquet(pages)
        judged = judged_pages(fresh, everything, catalog, params).unionByName(
            judged_pages(waiting, rows.where("NOT is_listing").select("page_id", "url", "html", "landed_at"), catalog, params)
        )
        commit_run(judged, store_path, key, params, deliver, also={"pending": fresh})

    writer = found.unionByName(landed).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def start_feed_ingest(spark: SparkSession, landing: str, *args, max_files: int | None = None, **kwargs):
    """``start_ingest`` over a folder of landed feed files, in batches of up to ``max_files`` of them."""
    return start_ingest(read_landed(spark, landing, FEEDS_RAW, max_files=max_files), *args, **kwargs)
