"""Near-duplicate vectors by an epsilon grid order join.

Two unit vectors have cosine >= t exactly where their distance is at most
epsilon = sqrt(2 - 2 t). Vectors are turned onto their leading principal axes,
which shortens no distance by accident: a distance between projections is never
above the true one. They are sorted by their cells of a grid of width epsilon,
axis by axis, and the sorted sequence is cut into intervals of bounded length.
Intervals whose boxes on the leading axes lie more than epsilon apart never meet;
two that may meet are halved again and again, halves that are provably apart
are skipped, and what is left is multiplied out.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import file_system, publish
from gleaner.llm.components import components
from gleaner.llm.simhash import local_roots
from gleaner.session import materialised, scratch_dir

AXES = 6
INTERVAL = 4096
LEAF = 512
#: Room for rounding: far above the error of a single-precision product, far below what separates real data.
SLACK = 1e-5


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision; scaled first, so that no square over- or underflows."""
    wide = values.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


def principal_axes(distinct: DataFrame, dims: int, axes: int = AXES) -> np.ndarray:
    """The leading principal axes (dims x axes) of all unit vectors of that length.

    Every task sends one matrix of dims x dims second moments, added up batch by
    batch; Spark adds those of all tasks by entry.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims))
        n = 0
        for batch in batches:
            if batch.num_rows:
                x = unit_rows(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
                total[:dims] += x.T @ x
                total[dims] += x.sum(axis=0)
                n += len(x)
        if n:
            flat = np.append(total.ravel(), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["k", "v"])

    rows = (
        distinct.where(F.col("dims") == dims).select("vector").mapInArrow(moments, "k long, v double")
        .groupBy("k").agg(F.sum("v").alias("v")).collect()
    )  # dims * (dims + 1) + 1 numbers
    flat = np.zeros(dims * (dims + 1) + 1)
    for row in rows:
        flat[row["k"]] = row["v"]
    second, mean = flat[: dims * dims].reshape(dims, dims) / flat[-1], flat[dims * dims : -1] / flat[-1]
    _, found = np.linalg.eigh(second - np.outer(mean, mean))
    return np.ascontiguousarray(found[:, ::-1][:, :axes])


def _sorted_cells(distinct: DataFrame, dims: int, axes: np.ndarray, epsilon: float) -> DataFrame:
    """(rep, copies, vector, cell): cell numbers on the axes, as an array that sorts in epsilon grid order."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit_rows(batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)) @ axes
                grid = np.floor(x / epsilon).astype(np.int64)
                # Inside a cell the first coordinate orders on, so that intervals stay narrow.
                keys = [(*g, float(c)) for g, c in zip(grid.tolist(), x[:, 0].tolist(), strict=True)]
                names = [f"g{k}" for k in range(grid.shape[1])] + ["c"]
                arrays = [pa.array(k) for k in zip(*keys, strict=True)]
                cell = pa.StructArray.from_arrays(arrays, names=names)
                yield pa.RecordBatch.from_arrays([*batch.columns, cell], names=["rep", "copies", "vector", "cell"])

    columns = distinct.where(F.col("dims") == dims).select("rep", "copies", "vector")
    grid = ", ".join(f"g{k}: bigint" for k in range(axes.shape[1]))
    kinds = dict(columns.dtypes)
    return columns.mapInArrow(
        cells, f"rep {kinds['rep']}, copies long, vector {kinds['vector']}, cell struct<{grid}, c: double>"
    )


def _intervals(ordered: DataFrame, dims: int, axes: np.ndarray, interval: int, folder: str) -> DataFrame:
    """One row per interval of the sorted sequence: block, path, low, high (its box). The vectors go to the file at ``path``.

    Intervals are read as often as there are others near them; as files in the
    shared folder they need not be shuffled for that.
    """
    parts = max(1, int(ordered.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), flat))
            size += batch.num_rows
            if size >= interval:
                whole = [np.concatenate(x) for x in zip(*held, strict=True)]
                for at in range(0, size - interval + 1, interval):
                    yield block(*[x[at : at + interval] for x in whole])
                held = [tuple(x[size - size % interval :] for x in whole)]
                size %= interval
        if size:
            yield block(*[np.concatenate(x) for x in zip(*held, strict=True)])

    def block(reps: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        place = unit_rows(vectors) @ axes
        name = int(reps.min())
        path = f"{folder}/{name}.npz"

        def save(stream):
            whole = io.BytesIO()
            np.savez(whole, reps=reps, copies=copies, vectors=vectors)
            stream.write(whole.getbuffer())

        publish(path, save)
        box = [pa.array([place.min(axis=0).tolist()]), pa.array([place.max(axis=0).tolist()])]
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([path]), *box], names=["block", "path", "low", "high"])

    return (
        ordered.repartitionByRange(parts, "cell")
        .sortWithinPartitions("cell", "rep")
        .select("rep", "copies", "vector")
        .mapInArrow(cut, "block long, path string, low array<double>, high array<double>")
    )


def _apart(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray, epsilon: float) -> bool:
    gap = np.maximum(0.0, np.maximum(low - other_high, other_low - high))
    return float(gap @ gap) > epsilon * epsilon


def _meeting(blocks: DataFrame, epsilon: float) -> DataFrame:
    """(a_path, b_path): intervals whose boxes come within epsilon, each two once, found by the cells of the first axis."""
    boxes = blocks.select(
        "block",
        "path",
        "low",
        "high",
        F.floor(F.col("low")[0] / epsilon).cast("long").alias("from"),
        F.floor(F.col("high")[0] / epsilon).cast("long").alias("to"),
    )
    # The lower start of two meeting ranges lies at most one cell below the other's start.
    left = boxes.select(
        F.col("block").alias("a"),
        F.col("path").alias("a_path"),
        F.col("low").alias("a_low"),
        F.col("high").alias("a_high"),
        F.col("from").alias("a_from"),
        F.explode(F.sequence(F.col("from"), F.col("to") + 1)).alias("cell"),
    )
    right = boxes.select(
        F.col("block").alias("b"), F.col("path").alias("b_path"), F.col("low").alias("b_low"), F.col("high").alias("b_high"), F.col("from").alias("cell")
    )
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("a_low", "b_high", lambda x, y: x - y),
            F.zip_with("b_low", "a_high", lambda x, y: x - y),
            lambda x, y: F.greatest(x, y, F.lit(0.0)),
        ),
        F.lit(0.0),
        lambda s, g: s + g * g,
    )
    once = (F.col("a_from") < F.col("cell")) | (F.col("a") <= F.col("b"))
    return (
        left.join(right, "cell")
        .where(once & (gap <= epsilon * epsilon))
        .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .agg(F.min(F.struct("a_path", "b_path")).alias("paths"))
        .select("paths.*")
    )


def _joined(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, same: bool, epsilon: float, threshold: float):
    """Positions of pairs (i in x, j in y) with cosine >= threshold; i < j where both are the same interval."""
    single_x, single_y = x.astype(np.float32), x.astype(np.float32) if same else y.astype(np.float32)
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def meet(a: int, b: int, c: int, d: int) -> None:
        if same and d <= a:
            return
        boxes = (px[a:b].min(axis=0), px[a:b].max(axis=0), py[c:d].min(axis=0), py[c:d].max(axis=0))
        if _apart(*boxes, epsilon):
            return
        if b - a > LEAF or d - c > LEAF:
            ab = (a + b) // 2 if b - a > LEAF else b
            cd = (c + d) // 2 if d - c > LEAF else d
            for p, q in ((a, ab), (ab, b)):
                for r, s in ((c, cd), (cd, d)):
                    if p < q and r < s:
                        meet(p, q, r, s)
            return
        i, j = np.nonzero(single_x[a:b] @ single_y[c:d].T >= threshold - SLACK)
        i, j = i + a, j + c
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 1 << 15):
            p, q = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
            sure = np.einsum("ij,ij->i", x[p], y[q]) >= threshold
            found_i.append(p[sure])
            found_j.append(q[sure])

    meet(0, len(x), 0, len(y))
    return np.concatenate(found_i), np.concatenate(found_j)


def _links(pairs: DataFrame, axes: np.ndarray, epsilon: float, threshold: float) -> DataFrame:
    """(rep, n, root): for each pair of intervals and vector with links there, copies linked and the smallest id it reaches."""
    parts = max(1, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def load(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        store, place = file_system(path)
        with store.open_input_file(place) as f:
            found = np.load(io.BytesIO(f.read()))
        return found["reps"], found["copies"], unit_rows(found["vectors"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (None, None)
        for batch in batches:
            for a_path, b_path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held[0] != a_path:
                    held = (a_path, load(a_path))
                same = a_path == b_path
                ids, copies, x = held[1]
                other_ids, other_copies, y = held[1] if same else load(b_path)
                i, j = _joined(x, y, x @ axes, y @ axes, same, epsilon, threshold)
                if not len(i):
                    continue
                if not same:
                    j += len(ids)
                    ids, copies = np.append(ids, other_ids), np.append(copies, other_copies)
                n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
                order = np.argsort(ids)
                place = np.argsort(order)
                root = ids[order][local_roots(len(order), place[i], place[j])[place]]
                met = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[met]), pa.array(n[met].astype(np.int64)), pa.array(root[met])], names=["rep", "n", "root"]
                )

    dealt = pairs.repartition(parts, "a_path", "b_path").sortWithinPartitions("a_path")
    return dealt.mapInArrow(compare, "rep long, n long, root long")


def vector_links(
    vectors: DataFrame, threshold: float = 0.9, column: str = "embedding", axes: int = AXES, interval: int = INTERVAL
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Two rows are linked where the cosine of their vectors, in double precision, is
    at least ``threshold``, which must be above 0. A vector that is null, empty, zero or holds a
    null or non-finite number links with nothing, and vectors of different length
    do not link. Equal vectors are compared once and counted as often as they
    occur. Repeated vec_ids are rows of their own that share a class only where
    their vectors do; component_id is the smallest vec_id reachable, itself included,
    and ``kept`` is vec_id = component_id. Null vec_ids count as rows but name no
    class: a vector that only they have joins none. Reads vec_id and the vector only.
    """
    epsilon = float(np.sqrt(2 - 2 * threshold)) + SLACK
    vector = F.col(column)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    text = F.array_join(F.transform(vector, lambda x: x.cast("string")), ",")
    rows = materialised(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            vector.alias("vector"),
            F.when(finite & F.exists(vector, lambda x: x != 0), F.sha2(text, 256)).alias("code"),
        ),
        "vectors",
    )
    distinct = materialised(
        rows.where("code IS NOT NULL")
        .groupBy("code")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("dims", F.size("vector")),
        "distinct",
    )
    named = distinct.where("rep IS NOT NULL")
    found = named.select("rep", F.lit(0).cast("long").alias("n"), F.col("rep").alias("root")).where("false")
    for row in sorted(named.groupBy("dims").count().collect()):  # lengths of vectors, few
        dims = row["dims"]
        turned = principal_axes(named, dims, min(axes, dims))
        cells = _sorted_cells(named, dims, turned, epsilon)
        folder = scratch_dir(vectors.sparkSession, "intervals")
        blocks = materialised(_intervals(cells, dims, turned, interval, folder), "boxes")
        found = found.unionByName(_links(_meeting(blocks, epsilon), turned, epsilon, threshold))
    found = materialised(found, "found")
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    classes = (
        distinct.join(counts, "rep", "left")
        .join(roots.withColumnRenamed("id", "rep"), "rep", "left")
        .select("code", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    )
    # Written, so that Spark may split the join where one vector has many rows.
    return (
        rows.select("vec_id", "code")
        .join(materialised(classes, "classes"), "code", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
