"""Embedding near-deduplication by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned into the principal axes of all of
them, largest variance first, so that the leading dimensions tell most pairs
apart. Vectors of one label are cut into tiles of near vectors (by repeated
halving along the widest axis of a bounded sample of the label), and tiles are
compared in pairs. A pair of tiles whose boxes are farther apart than the
threshold allows is never sent. In the others products are accumulated over
blocks of dimensions; what the remaining dimensions can add is at most the
product of the two remaining lengths, so a pair whose bound falls below the
threshold is left out, and a tile pair without any left is given up. What is left
after the last block is decided by the cosine of the original vectors in double precision.

A tile pair yields counts of links and as many links as connect its vectors,
never all of them.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and vectors of a null label, link with nothing; vectors of
different lengths are not compared; rows that repeat a vec_id are vectors of
their own, with links and a component of their own; rows with a null vec_id link
with nothing and have a null component and kept; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import in_arrow, table, written
from kpiloom.llm.components import components

THRESHOLD = 0.98
TILE = 1024  # vectors in a tile, about
DIMENSIONS = 16  # of a block
SAMPLE = 20_000  # vectors of a label that the cuts are taken from, at most
SLACK = 1e-6  # of bounds, so that rounding never leaves out a link


def matrix_of(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the usable vectors of this length, and these vectors in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(size == width)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(rows), width)
    good = np.isfinite(flat).all(axis=1) & (flat != 0).any(axis=1)
    return rows[good], flat[good]


def scaled(vectors: np.ndarray) -> np.ndarray:
    # Scaled twice, as the squares of very large or small components would overflow.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def widths(vectors: DataFrame) -> list[int]:
    """The lengths that occur (few: a table holds the output of one model, or of some)."""
    return sorted(r[0] for r in vectors.where("size(embedding) > 0").select(F.size("embedding")).distinct().collect())


def axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Principal axes of all scaled vectors, as columns, largest second moment first."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            _, got = matrix_of(batch.column("embedding"), width)
            got = scaled(got)
            total += got.T @ got
        yield pa.record_batch({"moments": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    rows = vectors.select("embedding").mapInArrow(each, "moments array<double>")
    # Summed by the executors; one matrix of width * width numbers reaches the driver.
    summed = rows.select(F.posexplode("moments").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value")).orderBy("at")
    total = np.array([r.value for r in summed.collect()] or [0.0] * width * width).reshape(width, width)
    return np.linalg.eigh((total + total.T) / 2)[1][:, ::-1]


def cuts_of(sample: np.ndarray, leaves: int) -> list:
    """A tree of (axis, place, lower, upper) that halves the sample along its widest axes; None is a leaf."""
    if leaves < 2 or len(sample) < 2:
        return None
    axis = int(np.argmax(sample.var(axis=0)))
    place = float(np.median(sample[:, axis]))
    low = sample[:, axis] < place
    if not low.any() or low.all():
        return None
    return [axis, place, cuts_of(sample[low], leaves // 2), cuts_of(sample[~low], leaves - leaves // 2)]


def leaves_of(tree: list | None, vectors: np.ndarray) -> np.ndarray:
    """The number of the leaf of each vector, from 1 as in a binary heap."""
    out = np.ones(len(vectors), np.int64)
    todo = [(tree, np.arange(len(vectors)), 1)]
    while todo:
        node, rows, name = todo.pop()
        out[rows] = name
        if node is not None and len(rows):
            low = vectors[rows, node[0]] < node[1]
            todo += [(node[2], rows[low], 2 * name), (node[3], rows[~low], 2 * name + 1)]
    return out


def tiles(vectors: DataFrame, width: int, rotation: np.ndarray) -> DataFrame:
    """label, tile, n, ids, data (rows of original vectors), low, high (the box in the principal axes)."""
    leading = rotation[:, :DIMENSIONS]
    counts = vectors.groupBy("label").count()
    salt = F.xxhash64(F.lit("tile"), "vec_id")
    sample = vectors.join(counts, "label").where(F.pmod(salt, F.greatest(F.lit(1), F.ceil(F.col("count") / SAMPLE))) == 0).where("count > %d" % TILE)

    def learn(key: tuple, rows: pa.Table) -> pa.Table:
        _, got = matrix_of(rows.column("embedding"), width)
        tree = cuts_of(scaled(got) @ leading, -(-rows.column("count")[0].as_py() // TILE))
        return pa.table({"label": pa.array([key[0].as_py()], pa.int64()), "tree": pa.array([repr(tree)])})

    # One group is a sample of about SAMPLE vectors at most; its tree has one node for each TILE vectors of the label.
    trees = sample.groupBy("label").applyInArrow(learn, "label long, tree string")

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        import ast

        rows, got = matrix_of(batch.column("embedding"), width)
        turned, tile = scaled(got) @ leading, np.ones(len(rows), np.int64)
        names = batch.column("tree").take(pa.array(rows)).dictionary_encode()
        index = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        for k, tree in enumerate(names.dictionary.to_pylist()):
            tile[index == k] = leaves_of(ast.literal_eval(tree), turned[index == k])
        return pa.record_batch({"label": batch.column("label").take(pa.array(rows)), "vec_id": batch.column("vec_id").take(pa.array(rows)), "tile": pa.array(tile),
                                "data": pa.array([x.tobytes() for x in got], pa.binary())})

    put = written(in_arrow(vectors.join(trees, "label", "left").select("label", "vec_id", "embedding", "tree"), placed, "label long, vec_id long, tile long, data binary"), "embeddings-placed")
    # Leaves are about TILE large; where equal vectors fill one, it is dealt into parts, which have the same box.
    size = put.groupBy("label", "tile").agg(F.ceil(F.count(F.lit(1)) / (2 * TILE)).cast("int").alias("parts"))
    dealt = put.join(size, ["label", "tile"]).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "vec_id", "data"), F.col("parts")).cast("int"))
    packs = dealt.groupBy("label", "tile", "part").agg(F.collect_list("vec_id").alias("ids"), F.collect_list("data").alias("rows"))

    def boxed(batch: pa.RecordBatch) -> pa.RecordBatch:
        low, high, data = [], [], []
        for rows in batch.column("rows"):
            got = np.frombuffer(b"".join(rows.as_py()), np.float64).reshape(-1, width)
            turned = scaled(got) @ leading
            low.append(turned.min(axis=0).tolist())
            high.append(turned.max(axis=0).tolist())
            data.append(got.tobytes())
        return pa.record_batch({"label": batch.column("label"), "tile": batch.column("tile"), "part": batch.column("part"), "ids": batch.column("ids"),
                                "data": pa.array(data, pa.binary()), "low": pa.array(low, pa.list_(pa.float64())), "high": pa.array(high, pa.list_(pa.float64()))})

    return in_arrow(packs, boxed, "label long, tile long, part int, ids array<long>, data binary, low array<double>, high array<double>")


def close_pairs(one: np.ndarray, other: np.ndarray, rotation: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two blocks of vectors whose cosine is at least the threshold."""
    a, b = scaled(one), scaled(other)
    turned, turned_b = a @ rotation, b @ rotation
    rest, rest_b = (np.sqrt(np.maximum(0, np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1])) for x in (turned, turned_b))
    width = turned.shape[1]
    product = turned[:, :DIMENSIONS] @ turned_b[:, :DIMENSIONS].T
    at = min(DIMENSIONS, width)
    bound = product + (np.outer(rest[:, at], rest_b[:, at]) if at < width else 0)
    i, j = np.nonzero(bound >= threshold - SLACK)
    product = product[i, j]
    while at < width and len(i):
        end = min(at + DIMENSIONS, width)
        product = product + np.einsum("ij,ij->i", turned[i, at:end], turned_b[j, at:end])
        at = end
        left = product + (rest[i, at] * rest_b[j, at] if at < width else 0) >= threshold - SLACK
        i, j, product = i[left], j[left], product[left]
    same = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
    return i[same], j[same]


def connecting(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Places in the links (i, j) among n nodes of a subset that connects the same nodes."""
    label, kept = np.arange(n), []
    order = np.lexsort((j, i))
    cut = np.flatnonzero(np.diff(i[order])) + 1
    for run in np.split(order, cut) if len(order) else ():
        names, first = np.unique(label[j[run]], return_index=True)
        mine = label[i[run[0]]]
        new = names != mine
        kept += run[first[new]].tolist()
        label[np.isin(label, names)] = mine
    return np.array(kept, np.int64)


def near_tiles(tiled: DataFrame, threshold: float) -> DataFrame:
    """Pairs of tiles of a label (one, other, both as label, tile and part) whose boxes are near enough for a link."""
    boxes = tiled.select("label", F.struct("tile", "part").alias("at"), "low", "high")
    other = boxes.select("label", F.col("at").alias("to"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    # Squared distance between unit vectors is 2 - 2 cosine; axes are orthogonal, so gaps between boxes add up.
    gap = F.zip_with(F.zip_with("low2", "high", lambda x, y: F.greatest(x - y, F.lit(0.0))), F.zip_with("low", "high2", lambda x, y: F.greatest(x - y, F.lit(0.0))), lambda x, y: (x + y) * (x + y))
    distance = F.aggregate(gap, F.lit(0.0), lambda x, y: x + y)
    return boxes.join(other, "label").where((F.col("at") <= F.col("to")) & (distance <= 2 - 2 * threshold + SLACK)).select("label", "at", "to")


def links(vectors: DataFrame, width: int, threshold: float) -> DataFrame:
    """node, n, a, b: counts of links of a vector within a tile pair (node, n), and links that connect (a, b)."""
    rotation = axes(vectors, width)
    tiled = written(tiles(vectors, width, rotation), "embeddings-tiles")
    pairs = written(near_tiles(tiled, threshold), "embeddings-tile-pairs")
    body = tiled.select("label", F.struct("tile", "part").alias("at"), "ids", "data")
    joined = (pairs.join(body.withColumnsRenamed({"ids": "ids_a", "data": "data_a"}), ["label", "at"])
              .join(body.withColumnsRenamed({"at": "to", "ids": "ids_b", "data": "data_b"}), ["label", "to"]))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = {k: [np.zeros(0, np.int64)] for k in ("node", "n", "a", "b")}
        for own, ids_a, ids_b, one, other in zip(*(batch.column(c) for c in ("own", "ids_a", "ids_b", "data_a", "data_b")), strict=True):
            a, b = ids_a.values.to_numpy(), ids_b.values.to_numpy()
            i, j = close_pairs(*(np.frombuffer(x.as_py(), np.float64).reshape(-1, width) for x in (one, other)), rotation, threshold)
            if own.as_py():
                i, j = i[i < j], j[i < j]
            ids = a if own.as_py() else np.concatenate([a, b])
            j = j if own.as_py() else j + len(a)
            count = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
            some = np.flatnonzero(count)
            kept = connecting(i, j, len(ids))
            for k, x in (("node", ids[some]), ("n", count[some]), ("a", np.full(len(some), -1)), ("b", np.full(len(some), -1))):
                out[k].append(x.astype(np.int64))
            for k, x in (("node", np.full(len(kept), -1)), ("n", np.zeros(len(kept))), ("a", ids[i[kept]]), ("b", ids[j[kept]])):
                out[k].append(x.astype(np.int64))
        return pa.record_batch({k: pa.array(np.concatenate(x)) for k, x in out.items()})

    rows = joined.select((F.col("at") == F.col("to")).alias("own"), "ids_a", "ids_b", "data_a", "data_b")
    return in_arrow(rows, each, "node long, n long, a long, b long")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    # A number of its own for every usable row: repeated vec_ids are vectors of their own.
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "embeddings-rows")
    usable = rows.where("label is not null and vec_id is not null").select(F.col("row").alias("vec_id"), "embedding", "label")
    found = spark.createDataFrame([], "node long, n long, a long, b long")
    for width in widths(usable):
        found = found.union(links(usable.where(F.size("embedding") == width), width, threshold))
    found = written(found, "embeddings-links")
    counts = found.where("n > 0").groupBy("node").agg(F.sum("n").alias("n_links"))
    joined = components(found.where("n = 0"), "a", "b").withColumnRenamed("node", "linked")
    known = counts.join(joined, F.col("node") == F.col("linked"), "left").select("node", "n_links", "component")
    out = rows.select("vec_id", "row").join(known, F.col("row") == F.col("node"), "left").withColumn("component", F.coalesce("component", "row"))
    smallest = out.groupBy("component").agg(F.min("vec_id").alias("least"))
    own = out.join(smallest, "component").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("least").alias("component_id"))
    return own.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
