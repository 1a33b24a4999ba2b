"""SimHash near duplicates by a hierarchical index over fingerprints in Gray order.

The index is a tree of shared masked bit patterns. Its upper nodes are built by
Spark: fingerprints that differ in at most ``bits`` bits agree on one of
``bits`` + 1 blocks of bits, so a node is a mask with the pattern that its
fingerprints share under it. A node with too many fingerprints is divided by
further blocks of its free bits, as often as needed; with 11 free bits left a node
is small whatever the data, so this ends, and no pair is lost on the way. Inside a
node the fingerprints are sorted by Gray rank, where neighbours share most bits;
runs of them are folded into lower nodes that carry the bits all of them share,
and two nodes are left out as a whole once the differences of their patterns
exceed the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.components import components
from gleaner.session import materialised

#: Fingerprints that one task compares at once.
NODE_LIMIT = 2048
LEAF, FANOUT = 16, 8
#: Node pairs that are held at once.
FRONTIER = 1 << 15
SEED = 42

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_COLUMN = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str | None, words: int = 3) -> int:
    """The unsigned 64-bit fingerprint; zero without words."""
    from xxhash import xxh64_intdigest

    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return 0
    joined = b" ".join(found)
    width = min(words, len(found))
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes) + np.arange(len(found))
    starts = (ends - sizes)[: len(found) - width + 1].tolist()
    counts = np.zeros(64, np.int64)
    ends = ends[width - 1 :].tolist()
    for at in range(0, len(starts), 8192):
        pairs = zip(starts[at : at + 8192], ends[at : at + 8192], strict=True)
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in pairs], "<u8")
        by_byte = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _COLUMN).ravel(), minlength=2048)
        counts += (by_byte.reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, words: int = 3) -> Column:
    """The fingerprint as a long: A to Z lower-cased, shingles of ``words`` words with repeats, majority of their XXH64."""

    @F.pandas_udf("long")
    def computed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return computed(text)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def close_pairs(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of all pairs of codes that differ in at most ``bits`` bits; ``codes`` in Gray order."""
    n = len(codes)
    levels = []
    starts = np.arange(0, n, LEAF)
    shared = ~np.bitwise_or.reduceat(codes ^ np.repeat(codes[starts], np.diff(np.append(starts, n))), starts)
    levels.append((codes[starts] & shared, shared))
    while len(levels[-1][0]) > 1:
        pattern, shared = levels[-1]
        starts = np.arange(0, len(pattern), FANOUT)
        firsts = np.repeat(pattern[starts], np.diff(np.append(starts, len(pattern))))
        above = np.bitwise_and.reduceat(shared & ~(pattern ^ firsts), starts)
        levels.append((pattern[starts] & above, above))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    zero = np.zeros(1, np.int64)
    stack = [(len(levels) - 1, zero, zero)]
    while stack:
        level, a, b = stack.pop()
        if len(a) > FRONTIER:
            stack.append((level, a[FRONTIER:], b[FRONTIER:]))
            a, b = a[:FRONTIER], b[:FRONTIER]
        width, count = (LEAF, n) if level == 0 else (FANOUT, len(levels[level - 1][0]))
        step = np.arange(width)
        low = np.broadcast_to((a[:, None] * width + step)[:, :, None], (len(a), width, width)).ravel()
        high = np.broadcast_to((b[:, None] * width + step)[:, None, :], (len(a), width, width)).ravel()
        there = (high < count) & (low < high if level == 0 else low <= high)
        low, high = low[there], high[there]
        if level == 0:
            near = np.bitwise_count(codes[low] ^ codes[high]) <= bits
            found.append((low[near], high[near]))
        else:
            pattern, shared = levels[level - 1]
            near = np.bitwise_count((pattern[low] ^ pattern[high]) & shared[low] & shared[high]) <= bits
            if near.any():
                stack.append((level - 1, low[near], high[near]))
    if not found:
        return zero[:0], zero[:0]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position that each of ``n`` positions reaches over the pairs (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def child_masks(mask: int, bits: int) -> list[int]:
    """``mask`` with each of ``bits`` + 1 blocks of its free bits added."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * k // (bits + 1) for k in range(bits + 2)]
    return [mask | sum(1 << b for b in free[low:high]) for low, high in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def fingerprint_links(codes: DataFrame, bits: int = 2, limit: int = NODE_LIMIT) -> DataFrame:
    """(a, b): links that join all ``rep`` whose ``fp`` differ in at most ``bits`` bits.

    ``codes`` holds distinct longs ``fp``, each with the id ``rep`` that stands for
    it, and is read several times. Every node gives each of its ids at most one
    link, to the smallest id it reaches in the node; with the links of all nodes
    the same ids are joined as with a link per pair.
    """
    level = codes.select("fp", "rep", F.lit(0).cast("long").alias("mask"))
    masks, found = [0], []
    while masks:
        children = {m: child_masks(m, bits) for m in masks}
        table = F.create_map(
            *[x for m, kids in children.items() for x in (F.lit(_signed(m)).cast("long"), F.array(*[F.lit(_signed(k)).cast("long") for k in kids]))]
        )
        nodes = level.select("fp", "rep", F.explode(table[F.col("mask")]).alias("mask")).withColumn(
            "pattern", F.col("fp").bitwiseAND(F.col("mask"))
        )
        counted = nodes.groupBy("mask", "pattern").agg(F.count("*").alias("_n"))
        large = materialised(counted.where(F.col("_n") > limit).select("mask", "pattern"), "nodes")
        divided = large.groupBy("mask").count().collect()  # as many rows as masks at most
        if divided:
            small = nodes.join(large, ["mask", "pattern"], "left_anti")
        else:
            small = nodes
        found.append(_links_of_nodes(small, bits))
        if not divided:
            break
        level = materialised(nodes.join(large, ["mask", "pattern"], "left_semi").select("fp", "rep", "mask").distinct(), "level")
        masks = [r["mask"] & ((1 << 64) - 1) for r in divided]
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def _links_of_nodes(nodes: DataFrame, bits: int) -> DataFrame:
    id_type = nodes.schema["rep"].dataType.simpleString()
    parts = max(1, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            if rest is not None:
                rows = [np.concatenate(x) for x in zip(rest, rows, strict=True)]
            new = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
            last = int(new[-1]) if len(new) else 0
            rest = [x[last:] for x in rows]
            if last:
                yield from solved([x[:last] for x in rows], np.concatenate([[0], new]))
        if rest is not None and len(rest[0]):
            yield from solved(rest, np.array([0, len(rest[0])]))

    def solved(rows: list[np.ndarray], bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []
        for k in np.flatnonzero(np.diff(bounds) > 1):
            low, high = bounds[k], bounds[k + 1]
            codes, first = np.unique(rows[2][low:high].view(np.uint64), return_index=True)
            order = np.argsort(gray_rank(codes), kind="stable")
            i, j = close_pairs(codes[order], bits)
            if len(i):
                ids = rows[3][low:high][first][order]
                by_id = np.argsort(ids, kind="stable")
                place = np.argsort(by_id)
                root = local_roots(len(ids), place[i], place[j])
                ids = ids[by_id]
                moved = np.flatnonzero(root != np.arange(len(root)))
                out_a.append(ids[moved])
                out_b.append(ids[root[moved]])
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    return (
        nodes.select("mask", "pattern", "fp", "rep")
        .repartition(parts, "mask", "pattern")
        .sortWithinPartitions("mask", "pattern")
        .mapInArrow(linked, f"a {id_type}, b {id_type}")
    )


def fingerprint_groups(prints: DataFrame, bits: int = 2, limit: int = NODE_LIMIT) -> DataFrame:
    """(fp, component_id): the component of every fingerprint of ``prints`` (doc_id, fp).

    component_id is the smallest doc_id that any chain of fingerprints of at most
    ``bits`` differing bits leads to. Null doc_ids count for nothing there; a
    fingerprint that only they have joins no other and has a null component.
    """
    codes = materialised(
        prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "codes"
    )
    roots = components(fingerprint_links(codes.where("rep IS NOT NULL"), bits, limit))
    joined = codes.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    return materialised(joined.select("fp", F.coalesce("root", "rep").alias("component_id")), "groups")


def near_copies(docs: DataFrame, words: int = 3, bits: int = 2, limit: int = NODE_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Texts without words, null ones among them, have fingerprint zero and link like
    any other. Equal rows give equal rows. Reads doc_id and text only; doc_id is an integer.
    """
    prints = materialised(docs.select("doc_id", fingerprint_of(F.col("text"), words).alias("fp")), "prints")
    return prints.join(fingerprint_groups(prints, bits, limit), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, words: int = 3, bits: int = 2, limit: int = NODE_LIMIT) -> DataFrame:
    """One row of every group of near copies, with all its columns: that with the smallest doc_id, null last.

    Repeated rows and rows without a doc_id are documents like any other, as rows
    are told apart by a number of their own that is written with them.
    """
    numbered = materialised(
        docs.select(
            F.monotonically_increasing_id().alias("_row"), fingerprint_of(F.col("text"), words).alias("fp"), F.struct("*").alias("_doc")
        ),
        "numbered",
    )
    rows = numbered.select("_row", F.col("_doc.doc_id").alias("doc_id"), "fp")
    groups = fingerprint_groups(rows.select(F.col("_row").alias("doc_id"), "fp"), bits, limit)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    kept = rows.join(groups, "fp").groupBy("component_id").agg(first.alias("first")).select("first._row")
    # The same join at every size: sent to all tasks, the kept rows would grow with the table.
    return numbered.join(kept.hint("merge"), "_row", "left_semi").select("_doc.*")
