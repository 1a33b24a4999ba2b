"""Store the outcome of a run in all sinks, deliver its documents, and report on it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators import filters
from ..operators.documents import render_documents
from ..operators.registry import registry_rows
from ..operators.store import latest, manifest_rows
from ..params import RunParams
from ..schema import ARTICLE_COLUMNS, DELIVERY, DOCUMENT, RUN_COUNT
from ..session import materialised
from ..sources import tables
from ..sources.log import Run, commits, find, read_table


def _now() -> str:
    return datetime.now(UTC).isoformat()


def commit_run(
    judged: DataFrame,
    store_path: str,
    key: object,
    params: RunParams,
    deliver: Callable[[dict], str] | None = None,
    sources: list[str] | None = None,
    also: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Write articles, manifest and counts, registry and documents unless a dry run, and make them visible together.

    ``key`` names the run: repeating a committed one writes nothing. What an
    attempt that did not commit has written is never read. Accepted URLs are
    registered whether or not they were delivered; rejected ones never are.
    ``sources`` are those the run asked, for the report; ``also`` are further tables
    that belong to the run. Returns counts per source and reason.
    """
    spark = judged.sparkSession
    run = Run(spark, store_path, str(key))
    if not run.finished:
        started, seen = _now(), Observation()
        observed = judged.observe(
            seen,
            F.count(F.lit(1)).alias("judged"),
            F.count_if(F.col("reason").isNull()).alias("accepted"),
            F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"),
        )
        rows = materialised(observed, "run")
        taken = filters.accepted(rows)
        if "pos" in taken.columns:
            # the same URL twice in a feed: the later entry is the one that stays
            taken = latest(taken, "id", [F.desc("fetched_at"), F.desc("pos")])
        taken = taken.select(*ARTICLE_COLUMNS)
        run.write("articles", taken, "source")
        run.write("manifest", manifest_rows(taken), "source")
        reason = F.coalesce("reason", F.lit("accepted")).alias("reason")
        run.write("run_counts", rows.groupBy("source", reason).agg(F.count("*").alias("n")))
        if not params.dry_run:
            run.write("registry", registry_rows(taken), "source")
            run.write("documents", render_documents(taken), "source")
        for table, more in (also or {}).items():
            run.write(table, more)
        run.commit(start=started, end=_now(), sources=sources, **seen.get)
    if deliver is not None and not params.dry_run:
        deliver_pending(spark, store_path, deliver)
    return read_table(spark, store_path, "run_counts", RUN_COUNT, [run.finished.number]).drop("run_seq")


_OUTCOME = pa.schema(
    [(c, pa.string()) for c in ("source", "article_id", "url", "filename", "document_id", "error")] + [("sent_seq", pa.int64())]
)


def deliver_pending(spark: SparkSession, store_path: str, send: Callable[[dict], str], key: object = None) -> int:
    """Hand every document without a successful delivery to ``send``; returns the number of the run that did.

    ``send`` gets a row as a dict (id, source, filename, body, metadata) and returns the id
    that the receiver gave it; an exception is this document's failure and stops
    no other. Outcomes are one row per document in the table ``deliveries``. A
    lost task sends its documents again: receivers key them by ``filename``.
    """
    run = Run(spark, store_path, None if key is None else f"deliveries {key}")
    if run.finished:
        return run.number
    done = tables.read_deliveries(spark, store_path).where("document_id IS NOT NULL").select("filename", F.col("sent_seq").alias("_sent"))
    documents = tables.newest(read_table(spark, store_path, "documents", DOCUMENT))
    # a newer version of a document that was delivered is due again
    due = documents.join(done, "filename", "left").where("_sent IS NULL OR run_seq > _sent")

    def handed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outcomes = []
            for row in batch.to_pylist():
                row["metadata"] = dict(row["metadata"])
                outcome = {"source": row["source"], "article_id": row["id"], "url": row["metadata"]["url"], "filename": row["filename"]}
                try:
                    outcome["document_id"] = send(row)
                except Exception as problem:  # whatever the receiver's client raises
                    outcome["error"] = f"{type(problem).__name__}: {problem}"
                outcomes.append(outcome | {"sent_seq": row["run_seq"]})
            yield pa.RecordBatch.from_pylist(outcomes, _OUTCOME)

    run.write("deliveries", due.select(*documents.columns).mapInArrow(handed, DELIVERY))
    run.commit(start=_now())
    return run.number


def run_log(spark: SparkSession, store_path: str, key: object, deliveries: int | None = None) -> DataFrame:
    """The run as log rows (source, kind, n, url, error, ts) for the counters and reports of ``metrics``.

    scraped: accepted articles of a source. skipped: 1 for a source that was asked
    and gave no new article. uploaded and error: outcomes of the delivery run with
    the number ``deliveries``. Reads the commit and narrow tables, no text.
    """
    commit = find(spark, store_path, str(key))
    if commit is None:
        raise KeyError(f"no committed run {key!r}")
    schema = "source STRING, kind STRING, n BIGINT, url STRING, error STRING, ts TIMESTAMP"
    blank = [F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("error")]
    end = F.lit(commit.info["end"]).cast("timestamp").alias("ts")
    counts = read_table(spark, store_path, "run_counts", RUN_COUNT, [commit.number])
    new = counts.where("reason = 'accepted' AND n > 0").select("source", F.lit("scraped").alias("kind"), "n", *blank, end)
    rows = spark.createDataFrame([(None, "start", 0, None, None)], "source STRING, kind STRING, n BIGINT, url STRING, error STRING")
    rows = rows.withColumn("ts", F.lit(commit.info["start"]).cast("timestamp")).unionByName(new)
    asked = spark.createDataFrame([(s,) for s in commit.info.get("sources") or []], "source STRING")
    idle = asked.join(new.select("source"), "source", "left_anti")
    rows = rows.unionByName(idle.select("source", F.lit("skipped").alias("kind"), F.lit(1).cast("bigint").alias("n"), *blank, end))
    if deliveries is not None:
        sent = read_table(spark, store_path, "deliveries", DELIVERY, [deliveries])
        kind = F.when(F.col("document_id").isNotNull(), "uploaded").otherwise("error")
        rows = rows.unionByName(sent.select("source", kind.alias("kind"), F.lit(1).cast("bigint").alias("n"), "url", "error", end))
    return rows.select(*[c.strip().split(" ")[0] for c in schema.split(",")])


def judged_registry(spark: SparkSession, store_path: str, key: object) -> DataFrame:
    """The registry that a committed run was judged against, also after later runs."""
    commit = find(spark, store_path, str(key))
    visible = commit.judged if commit else [c.number for c in commits(spark, store_path)]
    return tables.read_registry(spark, store_path, visible)
