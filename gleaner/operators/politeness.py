"""Request spacing per domain and retry plans, over logs.

A schedule depends on all earlier requests of a domain. A window over the domain
would put a busy one into a single task. So requests are sorted by domain and time
over the cluster and cut into pieces of equal size. A piece turns the time at which
its domain is free into the time at which it is free again: the later of that time
plus n delays, and a time of its own. Such a pair of numbers per piece, a max-plus
map, is all that the next pieces need; pairs are added up over the pieces of a domain,
and every piece is then finished on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.fields import retry_delay
from ..params import DEFAULT_DELAY_SECONDS, FATAL_ERRORS, MAX_RETRIES
from ..session import materialised
from .skew import join_dimension


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def with_delay(
    requests: DataFrame, delays: DataFrame, default: float = DEFAULT_DELAY_SECONDS
) -> DataFrame:
    """Configured delay of each request's domain, else the default."""
    joined = join_dimension(requests, delays.select("domain", "delay"), "domain", "left")
    return joined.withColumn("delay", F.coalesce("delay", F.lit(default)))


_PIECE = ["_domain", "_piece"]


def _pieces(requests: DataFrame, tie: str, parts: int | None) -> DataFrame:
    """Add domain, arrival and piece; written, because two steps read it and must see the same pieces.

    Keys are never null, so no null filter keeps both sides of the later join from sharing a shuffle.
    """
    spark = requests.sparkSession
    keyed = requests.withColumns(
        {"_at": _micros(F.col("ts")), "_domain": F.coalesce(F.concat(F.lit("d"), F.col("domain").cast("string")), F.lit(""))}
    )
    parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = keyed.repartitionByRange(parts, "_domain", "_at", tie)
    return materialised(ranged.withColumn("_piece", F.spark_partition_id().cast("long")), "requests")


def politeness_schedule(requests: DataFrame, tie: str = "request_id", parts: int | None = None) -> DataFrame:
    """Start and wait of each request when a domain's requests keep their delay.

    start(i) = max(arrival(i), start(i-1) + d) equals
    d*i + max over j <= i of (arrival(j) - d*j), a running maximum.
    Expects domain, ts, delay (one value per domain) and a tie-break column. A
    piece is about the ``parts``-th part of all requests, by default as many as
    the session shuffles to; a domain of any size is cut into as many as it fills.
    """
    inside = Window.partitionBy(*_PIECE).orderBy("_at", tie)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.round(F.col("delay") * 1e6).cast("long")
    local = _pieces(requests, tie, parts).withColumns({"_step": step, "_i": F.row_number().over(inside) - 1})
    local = local.withColumn("_slack", F.max(F.col("_at") - F.col("_step") * F.col("_i")).over(running))

    # one row per domain and piece: a domain has at most as many as there are pieces
    pairs = local.groupBy(*_PIECE).agg(F.count("*").alias("_n"), F.max("_slack").alias("_top"), F.max("_step").alias("_d"))
    earlier = Window.partitionBy("_domain").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = pairs.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    carried = carried.withColumn("_best", F.max(F.col("_top") - F.col("_d") * F.col("_offset")).over(earlier))

    placed = local.join(carried.select(*_PIECE, "_offset", "_best"), _PIECE, "left")
    slack = F.greatest("_best", F.col("_slack") - F.col("_step") * F.col("_offset"))
    placed = placed.withColumn("start_micros", F.col("_step") * (F.col("_offset") + F.col("_i")) + slack)
    wait = (F.col("start_micros") - F.col("_at")) / 1e6
    return placed.withColumn("wait_seconds", wait).select(*requests.columns, "start_micros", "wait_seconds")


def can_request(requests: DataFrame, tie: str = "request_id", parts: int | None = None) -> DataFrame:
    """Whether the delay had passed since the domain's previous request; pieces as in ``politeness_schedule``."""
    inside = Window.partitionBy(*_PIECE).orderBy("_at", tie)
    local = _pieces(requests, tie, parts).withColumn("_before", F.lag("_at").over(inside))
    last = local.groupBy(*_PIECE).agg(F.max("_at").alias("_last"))
    chain = Window.partitionBy("_domain").orderBy("_piece")
    carried = last.select(*_PIECE, F.lag("_last").over(chain).alias("_earlier"))
    elapsed = F.col("_at") - F.coalesce("_before", "_earlier")
    allowed = F.coalesce(elapsed >= F.round(F.col("delay") * 1e6), F.lit(True))
    return local.join(carried, _PIECE, "left").select(*requests.columns, allowed.alias("can_request"))


def retry_plan(failures: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Add ``retry`` and the wait before it; fatal errors and late attempts get none."""
    retry = (F.col("attempt") < max_retries) & ~F.coalesce(
        F.col("error").isin(*FATAL_ERRORS), F.lit(False)
    )
    return failures.withColumns(
        {"retry": retry, "delay_seconds": F.when(retry, retry_delay(F.col("attempt")))}
    )


def retry_schedule(failures: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """All remaining retries of each failure with their waits."""
    left = F.when(
        F.col("attempt") < max_retries, F.sequence(F.col("attempt").cast("int"), F.lit(max_retries - 1))
    )
    rows = failures.withColumn("next_attempt", F.explode(left))
    return rows.withColumn("delay_seconds", retry_delay(F.col("next_attempt")))
