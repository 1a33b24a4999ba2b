"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

The targets are turned into seats of ``block_words`` words. Highest quotients
target / (2 k + 1) give every source its whole number of seats, for every shard of
the mix in turn: the seats of the first j shards are the apportionment of the
first j shards' seats, which only grows with j. The documents of a source lie in
a seeded random order on one circular line of blocks, and the source's seats take
consecutive blocks from a seeded start. So a seat is a random block, all blocks
are taken equally often up to one, and at most two documents of a source are cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import SPACES, WORD, running_total
from gleaner.session import materialised

WEIGHTS = (5, 2, 1)


def _digest(prefix: str, text: Column) -> Column:
    """A seeded number below 16^13; from md5, so that other SQL engines give the same."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(prefix), text)), 1, 13), 16, 10).cast("long")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, ceiling: float = 2.0
) -> DataFrame:
    """(source, source_size, n_rows, place, target): the water level of the weights under the ceilings.

    Sources stand in code-point order with null last and take the weights in
    turn. All get ``share`` times all sizes by weight; what would lift a source
    above ``ceiling`` times its size goes to the others by weight, until none is
    above. One row per source, which is all the windows here hold.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    everyone = Window.partitionBy(F.lit(0))
    named = by_source.withColumn(
        "place", F.row_number().over(everyone.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    capped = named.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(ceiling)))
    # A source is full when the level, words per weight, reaches cap / weight; they fill in that order.
    fill = everyone.orderBy(F.col("cap") / F.col("weight"), "place")
    done = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(everyone) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(done), F.lit(0.0))
    ) / (F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(done), F.lit(0.0)))
    filled = capped.withColumn("_turn", F.row_number().over(fill)).withColumn("_level", level)
    # The first source that its level does not fill stays at that level, and so do all after it.
    open_level = F.when(F.col("_level") * F.col("weight") <= F.col("cap"), F.struct("_turn", "_level"))
    water = F.min(open_level).over(everyone)["_level"]
    return filled.withColumn("_water", water).select(
        "source",
        "source_size",
        "n_rows",
        "place",
        F.least(F.coalesce(F.col("_water") * F.col("weight"), F.col("cap")), F.col("cap")).alias("target"),
    )


def seats(targets: DataFrame, block_words: int, shards: int, seed: int, ceiling: float = 2.0) -> DataFrame:
    """(place, blocks, start, shard, first_seat, end_seat): the seats of every source in every shard.

    Each shard gets its own whole number of seats, so the shards are of one size
    up to one block. The divisor that surely gives too few seats is applied first;
    the missing ones, fewer than there are sources, go to the highest quotients,
    where equal quotients go to the source that stands first. No source gets more
    seats than ``ceiling`` rounds over its blocks.
    """
    all_targets = Window.partitionBy(F.lit(0))
    blocks = F.ceil(F.col("source_size") / F.lit(float(block_words))).cast("long")
    asked = (
        targets.withColumn("_all", F.sum("target").over(all_targets))
        .withColumn("_sources", F.count("*").over(all_targets).cast("double"))
        .where("target > 0")
        .withColumn("blocks", blocks)
        .withColumn("_seats", F.floor(F.col("_all") / block_words))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .withColumn("_house", F.floor(F.col("_seats") * (F.col("shard") + 1) / shards))
    )
    low, high = F.col("_house") - F.col("_sources") / 2, F.col("_house") + F.col("_sources") / 2
    most = F.floor(F.col("blocks") * F.lit(float(ceiling)))
    first = F.when(low > 0, F.least(F.floor(F.col("target") * low / F.col("_all") + 0.5), most)).otherwise(0).cast("long")
    last = F.least(F.floor(F.col("target") * high / F.col("_all") + 0.5) + 1, most).cast("long")
    based = asked.withColumn("_first", first).withColumn("_last", F.greatest(last, F.col("_first")))
    of_shard = Window.partitionBy("shard")
    short = F.col("_house") - F.sum("_first").over(of_shard)
    tried = (
        based.withColumn("_short", short)
        .withColumn("_seat", F.explode(F.sequence(F.col("_first"), F.col("_last"))))
        .withColumn("_quotient", F.col("target") / (2 * F.col("_seat") + 1))
        .withColumn("_turn", F.row_number().over(of_shard.orderBy(F.desc("_quotient"), "place", "_seat")))
    )
    # Seat numbers from ``most`` on do not exist; they must not use up a turn either.
    won = (
        tried.withColumn("_real", (F.col("_seat") < most).cast("int"))
        .withColumn(
            "_real_turn",
            F.sum("_real").over(of_shard.orderBy("_turn").rowsBetween(Window.unboundedPreceding, 0)),
        )
        .groupBy("place", "blocks", "shard", "_first")
        .agg(F.sum(((F.col("_real") == 1) & (F.col("_real_turn") <= F.col("_short"))).cast("long")).alias("_more"))
        .withColumn("end_seat", F.col("_first") + F.col("_more"))
    )
    previous = F.lag("end_seat", 1, 0).over(Window.partitionBy("place").orderBy("shard"))
    start = F.pmod(_digest(f"{seed}:start:", F.col("place").cast("string")), F.col("blocks"))
    return won.select("place", "blocks", start.alias("start"), "shard", previous.alias("first_seat"), "end_seat")


def _overlap(low: Column, high: Column, other_low: Column, other_high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(high, other_high) - F.greatest(low, other_low))


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    ceiling: float = 2.0,
    block_words: int = 8,
    shards: int = 16,
    seed: int = 7,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, line (its place), cuts.

    ``taken`` counts the words that the mix takes of it, repeats included, and
    ``cuts`` lists them as (shard, lap, from_word, to_word), word numbers from 0 and
    the end excluded. A document is taken at most ``ceiling`` times, and the
    ``cuts`` of a lap are disjoint. A null text has size 0 and is never taken; a
    null source is a source. Rows that are the same in doc_id, source and size may
    stand for each other. Reruns agree, as order and starts come from hashes of
    doc_id and ``seed``. Reads doc_id, text and source only.
    """
    sizes = materialised(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    return mixed_sizes(sizes, weights, share, ceiling, block_words, shards, seed)


def mixed_sizes(
    sizes: DataFrame, weights: Sequence[float], share: float, ceiling: float, block_words: int, shards: int, seed: int
) -> DataFrame:
    """``mixed`` of rows (doc_id, source, size) that are already counted; other columns stay."""
    targets = materialised(source_targets(sizes, weights, share, ceiling), "targets")
    plan = seats(targets, block_words, shards, seed, ceiling)
    by_source = plan.groupBy("place").agg(
        F.first("blocks").alias("_blocks"),
        F.first("start").alias("_start"),
        F.sort_array(F.collect_list(F.struct("shard", "first_seat", "end_seat"))).alias("_seats"),
    )
    placed = targets.select(
        F.coalesce(F.col("source"), F.lit("")).alias("_source"),
        F.col("source").isNull().alias("_none"),
        "place",
        "source_size",
        "target",
    )
    lined = (
        sizes.withColumn("_source", F.coalesce(F.col("source"), F.lit("")))
        .withColumn("_none", F.col("source").isNull())
        .join(placed, ["_source", "_none"])
        .drop("_source", "_none")
        .withColumn(
            "_line",
            _digest(f"{seed}:", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("double") / F.lit(float(16**13)),
        )
    )
    counts = targets.select("place", "n_rows")
    offset = running_total(lined, "place", "_line", "size", "line", ["doc_id", "size"], counts)
    return (
        offset.join(by_source, "place", "left")
        .withColumn("cuts", _cuts(block_words, ceiling))
        .select(
            *sizes.columns,
            "source_size",
            "target",
            F.aggregate("cuts", F.lit(0).cast("long"), lambda a, c: a + c["to_word"] - c["from_word"]).alias("taken"),
            "line",
            "cuts",
        )
    )


def _cuts(block_words: int, ceiling: float) -> Column:
    """Where the seats of the row's source, shard by shard and round by round, meet its words.

    Seat k stands for block (start + k) mod blocks in round k div blocks. A run of
    seats is one stretch of the unrolled line of rounds, which starts at block
    ``start`` of the circle; a document meets it once per round, or twice where
    the circle's end lies inside the run.
    """
    blocks, start = F.col("_blocks"), F.col("_start")
    low, size = F.col("line"), F.col("size")

    def of_lap(run: Column, lap: Column) -> Column:
        # On lap n the circle is walked once more from its block 0; seat numbers count from block ``start`` of lap 0.
        first_block = F.greatest(run["first_seat"] + start - lap * blocks, F.lit(0))
        end_block = F.least(run["end_seat"] + start - lap * blocks, blocks)
        from_word = F.greatest(first_block * block_words - low, F.lit(0))
        to_word = F.least(end_block * block_words - low, size)
        return F.struct(
            run["shard"].alias("shard"),
            lap.cast("int").alias("lap"),
            from_word.cast("long").alias("from_word"),
            to_word.cast("long").alias("to_word"),
        )

    laps = F.sequence(F.lit(0), F.lit(int(ceiling) + 1))
    pieces = F.flatten(F.transform("_seats", lambda run: F.transform(laps, lambda lap: of_lap(run, lap))))
    met = F.filter(pieces, lambda c: c["to_word"] > c["from_word"])
    empty = F.array().cast("array<struct<shard:int,lap:int,from_word:bigint,to_word:bigint>>")
    return F.coalesce(F.when(F.col("size") > 0, met), empty)


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    ceiling: float = 2.0,
    block_words: int = 8,
    shards: int = 16,
    seed: int = 7,
) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for each lap in which the mix takes words of a document.

    A document that a lap takes whole keeps its text; else the text is its taken
    words with what stands between them, and n_chars, where there is such a column, is counted again.
    """
    numbered = materialised(
        docs.select(F.monotonically_increasing_id().alias("_row"), n_words(F.col("text")).alias("size"), F.struct("*").alias("_doc")),
        "numbered",
    )
    sizes = numbered.select("_row", "_doc.doc_id", "_doc.source", "size")
    taken = mixed_sizes(sizes, weights, share, ceiling, block_words, shards, seed).where("taken > 0")
    laps = taken.select("_row", "size", "cuts", F.explode(F.array_distinct(F.transform("cuts", lambda c: c["lap"]))).alias("_lap")).select(
        "_row",
        F.col("size").alias("_words"),
        F.sort_array(
            F.transform(
                F.filter("cuts", lambda c: c["lap"] == F.col("_lap")), lambda c: F.struct(c["from_word"].alias("low"), c["to_word"].alias("high"))
            )
        ).alias("_cuts"),
    )
    words = F.aggregate("_cuts", F.lit(0).cast("long"), lambda a, c: a + c["high"] - c["low"])
    text = F.col("_doc.text")
    parts = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    some = F.array_join(
        F.flatten(F.transform("_cuts", lambda c: F.slice(parts, (c["low"] + 1).cast("int"), (c["high"] - c["low"]).cast("int")))), ""
    )
    taken_text = F.when(words == F.col("_words"), text).otherwise(F.btrim(some, F.lit(SPACES)))
    # The same join at every size: sent to all tasks, the laps would grow with the table.
    joined = numbered.join(laps.hint("merge"), "_row").select("_doc", taken_text.alias("_text"))
    counted = joined.select(F.col("_doc").withField("text", F.col("_text")).alias("_doc"), "_text")
    if "n_chars" in docs.columns:
        n_chars = F.length("_text").cast(docs.schema["n_chars"].dataType)
        counted = counted.withColumn("_doc", F.col("_doc").withField("n_chars", n_chars))
    return counted.select("_doc.*")
