"""Prefix trie of conversations, from the common prefixes of sorted neighbours.

Distinct conversations, as strings of turn digests, are sorted over the cluster.
Within a run of neighbours the edges between them carry the length of their
common prefix. A union-find takes the edges in descending depth: each merge of two
components makes the branching node at that depth, and what the components hold
below it has got all its members, so it is closed. What lies on the first and on
the last string of a run may go on in the neighbouring runs; it stays open, and
the run is contracted to these two strings with what hangs on their nodes. Such
strings are sorted neighbours again, so the same function merges the runs of many
partitions, until one run is left. No task holds more than one run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.session import materialised

#: Bytes of a turn's digest.
WIDTH = 16
#: Strings that a task merges at once, and partitions whose contracted runs are merged at once.
RUN, FAN = 16_384, 64
#: Conversation numbers of a chunk of a node's list.
CHUNK = 8_192
#: Characters of a text that order turns of the same number and role before their digests do.
HEAD = 32
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PATH = (
    "key binary, sizes array<long>, members array<long>, low array<long>, children array<long>, leaves array<long>, "
    "saved array<long>, ends array<string>"
)
FOLDED = f"part long, place long, is_path boolean, node binary, parent_node binary, {NODE}, path struct<{PATH}>"


def turn_digest(role: Column, text: Column) -> Column:
    """A digest that is equal where role and text are."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): the digests of a conversation's turns in order, joined, and the bytes of each text.

    Turns go by number, null first; equal numbers by role, the first characters
    of the text, and digest; repeated rows are turns of their own. Rows without a
    conv_id belong to no conversation. A conversation is one row of 24 bytes a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("numbered"),
            "turn",
            role.alias("role"),
            F.substring(text, 1, HEAD).alias("head"),
            turn_digest(role, text).alias("digest"),
            F.octet_length(text).cast("long").alias("size"),
        ).alias("t"),
    )
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.col("t.digest").alias("digests"), F.col("t.size").alias("sizes"))


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base: crc32 of its number as text, modulo 9."""
    return (F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % 9).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, key, sizes) of every conversation after it has taken its first turns from its base.

    The base of conversation c is c - c % 5, by the remainder that has the sign
    of c; a base that is absent gives no turns.
    """
    lists = materialised(turn_lists(turns), "turns").withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    bases = lists.where("conv_id = base").select(
        "base", F.slice("digests", 1, 8).alias("base_digests"), F.slice("sizes", 1, 8).alias("base_sizes")
    )
    h = shared_turns(F.col("conv_id"))

    def taken(of_base: str, own: str) -> Column:
        first = F.when(F.col(of_base).isNotNull(), F.slice(of_base, F.lit(1), h)).otherwise(F.slice(own, 1, 0))
        return F.concat(first, F.slice(own, h + 1, F.greatest(F.size(own), F.lit(1))))

    joined = lists.join(bases, "base", "left")
    key = F.array_join(F.transform(taken("base_digests", "digests"), lambda d: F.hex(d)), "")
    return joined.select("conv_id", F.unhex(key).alias("key"), taken("base_sizes", "sizes").alias("sizes"))


def strings(convs: DataFrame) -> DataFrame:
    """The distinct strings of ``convs`` (conv_id, key, sizes): key, sizes, n, low, ends.

    ``n`` counts the conversations that are this string, ``low`` is the smallest
    of them, ``ends`` the hash of all their numbers in order. The numbers are
    sorted over the cluster and joined in chunks; one hash after another takes a
    string's chunks, each a row, without holding more than one.
    """
    named = materialised(convs.withColumn("seq", F.unhex(F.md5("key"))), "strings")
    parts = max(1, int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held, row = None, [], None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("seq", "conv_id", "key", "sizes")]
            out = []
            for own, conv, key, sizes in zip(*columns, strict=True):
                if own != seq or len(held) >= CHUNK:
                    if held:
                        out.append(_chunk(seq, held, row))
                    row = (key, sizes) if own != seq else (None, None)
                    seq, held = own, []
                held.append(conv)
            if out:
                yield pa.RecordBatch.from_pylist(out, _CHUNKS)
        if held:
            yield pa.RecordBatch.from_pylist([_chunk(seq, held, row)], _CHUNKS)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for batch in batches:
            out = []
            for chunk in batch.to_pylist():
                if held is None or chunk["seq"] != held["seq"]:
                    if held:
                        out.append(_string(held))
                    held = {**chunk, "hash": hashlib.sha256(chunk["listed"].encode())}
                else:
                    held["hash"].update(b"," + chunk["listed"].encode())
                    held["n"] += chunk["n"]
            if out:
                yield pa.RecordBatch.from_pylist(out, _STRINGS)
        if held:
            yield pa.RecordBatch.from_pylist([_string(held)], _STRINGS)

    chunks = (
        named.select("seq", "conv_id", "key", "sizes")
        .repartitionByRange(parts, "seq", "conv_id")
        .sortWithinPartitions("seq", "conv_id")
        .mapInArrow(chunked, "seq binary, low long, n long, listed string, key binary, sizes array<long>")
    )
    return (
        chunks.repartition(parts, "seq")
        .sortWithinPartitions("seq", "low")
        .mapInArrow(hashed, "key binary, sizes array<long>, n long, low long, ends string")
    )


_LONGS = pa.list_(pa.int64())
_CHUNKS = pa.schema(
    [("seq", pa.binary()), ("low", pa.int64()), ("n", pa.int64()), ("listed", pa.string()), ("key", pa.binary()), ("sizes", _LONGS)]
)
_STRINGS = pa.schema([("key", pa.binary()), ("sizes", _LONGS), ("n", pa.int64()), ("low", pa.int64()), ("ends", pa.string())])


def _chunk(seq: bytes, convs: list[int], row: tuple) -> dict:
    return {"seq": seq, "low": convs[0], "n": len(convs), "listed": ",".join(map(str, convs)), "key": row[0], "sizes": row[1]}


def _string(held: dict) -> dict:
    return {k: held[k] for k in ("key", "sizes", "n", "low")} | {"ends": held["hash"].hexdigest()}


@dataclass
class Node:
    """What is known of a node so far; ``waiting`` are the rows of closed children that lack its smallest member."""

    members: int = 0
    low: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None
    waiting: list[dict] = field(default_factory=list)

    def add(self, other: Node) -> None:
        self.members += other.members
        self.low = other.low if self.low is None else self.low if other.low is None else min(self.low, other.low)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends
        if len(other.waiting) > len(self.waiting):
            self.waiting, other.waiting = other.waiting, self.waiting
        self.waiting += other.waiting


@dataclass
class Path:
    """A string with the nodes on it, of depth 0 to its length."""

    key: bytes
    sizes: list[int]
    nodes: list[Node]


def common_turns(a: bytes, b: bytes) -> int:
    """The number of turns that two strings begin with alike."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def fold(paths: list[Path], whole: bool = False, named: bool = False) -> tuple[list[dict], list[Path]]:
    """(rows of closed nodes, the contracted run) of strings in ascending order.

    A contracted run is its first and its last string with their open nodes; a
    node that both share counts on the first. ``whole`` says that no neighbours
    follow, so that all nodes are closed. ``named`` gives rows the digest of
    their prefix, by which children that were closed in earlier runs know them.
    """
    rows: list[dict] = []
    n = len(paths)
    lengths = [common_turns(paths[k].key, paths[k + 1].key) for k in range(n - 1)]
    up = list(range(n))
    #: For the component of a root: the string whose prefix it is, and whether it holds the run's first or last string.
    edge = [(k == 0, k == n - 1) for k in range(n)]
    tails: tuple[list[Node], list[Node]] = ([], [])

    def root(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    def close(path: Path, depth: int) -> None:
        """Closes the nodes of ``path`` below ``depth``, the deepest first."""
        for at in range(len(path.nodes) - 1, depth, -1):
            node = path.nodes.pop()
            node.saved += (node.members - 1) * path.sizes[at - 1]
            node.leaves = node.leaves or 1
            rows.append(_row(node, at, path.key, named))
            for child in node.waiting:
                child["parent_conv_id"] = node.low
            above = path.nodes[-1]
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
            above.waiting.append(rows[-1])

    def cut(k: int, depth: int) -> None:
        first, last = edge[k]
        if whole or not (first or last):
            close(paths[k], depth)
        else:
            tails[0 if first else 1][:0] = paths[k].nodes[depth + 1 :]
            del paths[k].nodes[depth + 1 :]

    for k in sorted(range(n - 1), key=lambda k: -lengths[k]):
        a, b, depth = root(k), root(k + 1), lengths[k]
        cut(a, depth)
        cut(b, depth)
        for mine, other in zip(paths[a].nodes, paths[b].nodes, strict=True):
            mine.add(other)
        paths[b].nodes = []
        up[b] = a
        edge[a] = (edge[a][0] or edge[b][0], edge[a][1] or edge[b][1])
    if not paths:
        return rows, []
    top = paths[root(0)]
    if whole:
        close(top, 0)
        node = top.nodes[0]
        node.leaves = node.leaves or 1
        rows.append(_row(node, 0, top.key, named))
        for child in node.waiting:
            child["parent_conv_id"] = node.low
        return rows, []
    shared = top.nodes
    open_paths = [Path(paths[0].key, paths[0].sizes, shared + tails[0])]
    if n > 1:
        last = paths[-1]
        open_paths.append(Path(last.key, last.sizes, [Node() for _ in shared] + tails[1]))
    for path in open_paths:
        for depth, node in enumerate(path.nodes):
            if node.waiting:
                name = hashlib.md5(path.key[: depth * WIDTH]).digest()
                for child in node.waiting:
                    child["parent_node"] = name
                node.waiting = []
    return rows, open_paths


def _row(node: Node, depth: int, key: bytes, named: bool) -> dict:
    return {
        "node": hashlib.md5(key[: depth * WIDTH]).digest() if named else None,
        "conv_id": node.low,
        "depth": depth,
        "n_convs": node.members,
        "n_children": node.children,
        "n_leaves": node.leaves,
        "saved_tokens": node.saved,
        "ends_sha256": node.ends or NO_ENDS,
    }


_PATH_TYPE = pa.struct(
    [("key", pa.binary()), ("sizes", _LONGS), *((c, _LONGS) for c in ("members", "low", "children", "leaves", "saved")), ("ends", pa.list_(pa.string()))]
)
_FOLDED = pa.schema(
    [("part", pa.int64()), ("place", pa.int64()), ("is_path", pa.bool_()), ("node", pa.binary()), ("parent_node", pa.binary())]
    + [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("path", _PATH_TYPE)]
)
_PARTS = ("members", "low", "children", "leaves", "saved", "ends")


def _folded(paths: list[Path], part: int, place: int, whole: bool, named: bool) -> Iterator[pa.RecordBatch]:
    rows, open_paths = fold(paths, whole, named)
    out = [{"part": part, "place": place, "is_path": False, **row} for row in rows]
    for k, path in enumerate(open_paths):
        held = {c: [getattr(node, c) for node in path.nodes] for c in _PARTS}
        out.append({"part": part, "place": place + k, "is_path": True, "path": {"key": path.key, "sizes": path.sizes, **held}})
    for at in range(0, len(out), RUN):
        yield pa.RecordBatch.from_pylist(out[at : at + RUN], _FOLDED)


def _first_fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most RUN distinct strings of a partition."""
    part = TaskContext.get().partitionId()
    paths: list[Path] = []
    place = 0
    for batch in batches:
        for row in batch.to_pylist():
            nodes = [Node(row["n"], row["low"]) for _ in range(len(row["sizes"]) + 1)]
            nodes[-1].ends = row["ends"]
            paths.append(Path(row["key"], row["sizes"], nodes))
            if len(paths) >= RUN:
                yield from _folded(paths, part, place, False, False)
                paths, place = [], place + 2
    if paths:
        yield from _folded(paths, part, place, False, False)


def _next_fold(whole: bool):
    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contracted runs of FAN partitions; ``group`` numbers these."""
        group, paths, place = None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != group or len(paths) >= RUN:
                    if paths:
                        yield from _folded(paths, group, place, False, True)
                    place = place + 2 if row["group"] == group else 0
                    group, paths = row["group"], []
                held = row["path"]
                nodes = [Node(*values) for values in zip(*(held[c] for c in _PARTS), strict=True)]
                paths.append(Path(held["key"], held["sizes"], nodes))
        if paths:
            # Where there is one group and it fits one run, nothing follows.
            yield from _folded(paths, group, place, whole and place == 0, True)

    return folded


def trie_of(texts: DataFrame) -> DataFrame:
    """The nodes of the trie of ``texts`` (key, sizes, n, low, ends; see ``strings``), with the columns of NODE.

    The node of a prefix has the smallest member as ``conv_id``; its parent is
    named alike, null for the root. No strings give no node.
    """
    spark = texts.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sorted_texts = materialised(texts, "texts").repartitionByRange(parts, "key").sortWithinPartitions("key")
    level = materialised(sorted_texts.mapInArrow(_first_fold, FOLDED), "runs")
    levels = [level]
    while (left := _left(level))[0]:
        groups = left[1] // FAN + 1
        paths = level.where("is_path").select(F.floor(F.col("part") / FAN).cast("long").alias("group"), "part", "place", "path")
        dealt = paths.repartition(groups, "group").sortWithinPartitions("group", "part", "place")
        level = materialised(dealt.select("group", "path").mapInArrow(_next_fold(groups == 1), FOLDED), "runs")
        levels.append(level)
    nodes = levels[0].where("NOT is_path")
    for other in levels[1:]:
        nodes = nodes.unionByName(other.where("NOT is_path"))
    names = nodes.where("node IS NOT NULL").select(F.col("node").alias("parent_node"), F.col("conv_id").alias("found"))
    # Children that wait for a parent of a later run: few names a partition, so no name is hot.
    lacking = nodes.where("parent_node IS NOT NULL").select("part", "parent_node").distinct()
    found = lacking.join(names, "parent_node")
    columns = [c.split(" ")[0] for c in NODE.split(", ")]
    late = nodes.where("parent_node IS NOT NULL").drop("parent_conv_id").withColumnRenamed("parent_node", "_parent")
    told = late.join(found.withColumnRenamed("parent_node", "_parent"), ["part", "_parent"]).withColumnRenamed("found", "parent_conv_id")
    return nodes.where("parent_node IS NULL").select(*columns).unionByName(told.select(*columns))


def _left(level: DataFrame) -> tuple[int, int]:
    """(number of contracted strings, largest partition number) of a level."""
    row = level.where("is_path").agg(F.count("*").alias("n"), F.max("part").alias("part")).first()
    return row["n"], row["part"] or 0


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations of ``turns`` (conv_id, turn, role, text), one row per node.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. Null roles and texts are empty. Reads
    these four columns only; an empty table has no node.
    """
    return trie_of(strings(rebuilt(turns.select("conv_id", "turn", "role", "text"))))
