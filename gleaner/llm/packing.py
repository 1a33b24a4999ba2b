"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

The work is split in three. Spark encodes and cuts every document. The packer
needs nothing of the pieces but how many there are of each length, at most
``capacity`` counts, and returns patterns with the number of sequences that follow
each. Spark then numbers the pieces of a length and deals them to the patterns.
So packing is as tight over the whole table as over one list, and no task or
driver ever holds the pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import running_total, unit
from gleaner.llm.tokens import encoder, vocabulary_path
from gleaner.session import materialised

CAPACITY = 1024
END_ID = 2
BYTE_BPE = "byte_bpe_50k.json"


def cut_pieces(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every document encoded, ended with ``end_id`` and cut.

    A document of at most ``capacity`` ids is one piece. A longer one is cut so
    that all pieces but the first are full and only the first may be shorter. A
    null text is an empty one, whose only id is the end id. ``ids`` holds
    little-endian unsigned 32-bit ids. Rows with equal doc_id are documents of
    their own. Reads doc_id and text only.
    """
    path = path or vocabulary_path(BYTE_BPE)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                source, pieces = [], []
                for row, ids in enumerate(encode(x.as_py() for x in rows.column(1))):
                    ids += end
                    total = len(ids) // 4
                    low, n, high = 0, 0, (total - 1) % capacity + 1
                    while low < total:
                        own = ids[4 * low : 4 * high]
                        source.append(row)
                        pieces.append((n, low, high - low, zlib.crc32(own), own))
                        low, n, high = high, n + 1, high + capacity
                columns = list(zip(*pieces, strict=True))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 4 + keep_ids]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(source)), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=False))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids],
                )

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """(number of sequences, lengths in each) for pieces given as counts by length.

    A sequence is filled greedily: the longest piece that is left, then again and
    again the longest that still fits. Then its shortest piece is taken out where
    two pieces that are left fill the gap it leaves more tightly than it did. A
    filled sequence is repeated as often as the counts allow, so the work depends
    on the number of lengths and not on the number of pieces.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"piece of {length} ids; a sequence has {capacity}")
        left[length] += n
    plan: list[tuple[int, tuple[int, ...]]] = []

    def longest(limit: int) -> int:
        found = np.flatnonzero(left[: limit + 1])
        return int(found[-1]) if len(found) else 0

    while piece := longest(capacity):
        filled, gap = [], capacity
        while piece:
            left[piece] -= 1
            filled.append(piece)
            gap -= piece
            piece = longest(gap) if gap else 0
        if gap and len(filled) > 1:
            least = filled[-1]
            pair = _tightest_pair(left, gap + least)
            if pair and sum(pair) > least:
                left[least] += 1
                left[list(pair)] -= 1 if pair[0] != pair[1] else 2
                filled[-1:] = pair
        lengths, uses = np.unique(filled, return_counts=True)
        more = int(np.min(left[lengths] // uses))
        left[lengths] -= more * uses
        plan.append((1 + more, tuple(filled)))
    return plan


def _tightest_pair(left: np.ndarray, gap: int) -> tuple[int, int] | None:
    """The two left lengths with the largest sum up to ``gap``, the longest first."""
    there = np.flatnonzero(left[:gap])
    best = None
    for a in there[::-1]:
        low = gap - a
        fit = there[(there <= low) & (there <= a)]
        if len(fit) and fit[-1] == a and left[a] < 2:
            fit = fit[:-1]
        if len(fit) and (best is None or a + fit[-1] > sum(best)):
            best = (int(a), int(fit[-1]))
            if sum(best) == gap:
                break
        if best and 2 * a <= sum(best):
            break
    return best


def deal(plan: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """Rows (length, first, base, repeats, offset): numbered pieces ``first`` and on go to sequences ``base`` and on.

    Sorted by (length, first). One row stands for one place in one pattern.
    """
    rows, taken, base = [], {}, 0
    for repeats, lengths in plan:
        offset = 0
        for length in lengths:
            rows.append((length, taken.get(length, 0), base, repeats, offset))
            taken[length] = taken.get(length, 0) + repeats
            offset += length
        base += repeats
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "base", "repeats", "offset"), table.T, strict=True))


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset: its sequence, and its place in it, gapless from 0.

    ``pieces`` has doc_id, piece, length and any other columns; it is read three
    times, so give it materialised. Equal pieces may swap places between reruns.
    No pieces give no sequences.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = deal(best_two_fit(counts, capacity))
    table["key"] = table["length"] * (1 << 44) + table["first"]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(table["key"], length.to_numpy() * (1 << 44) + number.to_numpy(), side="right") - 1
        sequence = table["base"][at] + number.to_numpy() - table["first"][at]
        return pd.DataFrame({"sequence_id": sequence, "offset": table["offset"][at]})

    lined = pieces.withColumn("_line", unit(F.col("doc_id"), F.col("piece"), seed=3)).withColumn("_one", F.lit(1))
    numbered = running_total(lined, "length", "_line", "_one", "_number", ["doc_id", "piece"], few_keys=True)
    return (
        numbered.withColumn("_place", place("length", "_number"))
        .select(*pieces.columns, "_place.sequence_id", "_place.offset")
    )


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, lengths): the packed sequences; a sequence has at most ``capacity`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id",
        F.aggregate("_parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("_parts", lambda p: p["length"]).alias("lengths"),
    )


def pack_documents(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Cuts and packs all documents; see ``cut_pieces`` and ``packed``."""
    return packed(materialised(cut_pieces(docs, path, keep_ids=keep_ids), "pieces"))
