"""Approximate nearest neighbours by vantage-point trees, one per shard.

The largest inner product is turned into the smallest distance: with one more
component, the root of the largest squared length minus its own, all vectors
are equally long, and queries get 0 there. Every shard (a hash range of all
rows) has a tree: a node keeps a vantage point and the ranges of distances to
it in its nearer and its farther half. A half is left out for a query if, by
the triangle inequality, nothing in it can be nearer than the k-th result so
far; that lower bound is multiplied by ``factor`` before. Factor 1 is the exact
search; larger ones leave out more. In README.md: the recall by factor.

Trees are built and written once. A block of queries first searches one shard;
what it finds there bounds its search of every other one, where only better
candidates are returned. Products select candidates, and every returned score
is computed anew on the original vectors, in one order of summation, so that
equal vectors tie.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part; queries are compared with vectors of their own length
only; a repeated vec_id is two rows, which find each other; a null vec_id is no
candidate; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import in_arrow, table, written
from kpiloom.llm.embeddings import matrix_of, widths

K = 20
FACTOR = 5.0
EVERY = 20  # queries: every row whose vec_id is divisible by it
SHARD = 8192  # rows of a tree, about
BLOCK = 512  # queries searched together
LEAF = 256
SLACK = 1e-9  # of products that select candidates


def lengthened(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Vectors with the component that makes them all as long as the longest one."""
    return np.column_stack([vectors, np.sqrt(np.maximum(0.0, largest - np.einsum("ij,ij->i", vectors, vectors)))])


def tree_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the points by leaf; nodes (begin, middle, end, vantage point), -1 for the point of a leaf; ranges (near low, high, far low, high).

    Children of node i are those that begin at its begin and at its middle; nodes are in depth-first order.
    """
    order, nodes, ranges = np.arange(len(points)), [], []
    todo = [(0, len(points))]
    while todo:
        begin, end = todo.pop()
        if end - begin <= LEAF:
            nodes.append((begin, end, end, -1))
            ranges.append((0.0,) * 4)
            continue
        mine = order[begin:end]
        # Of a few points, the one whose distances differ most tells most apart.
        few, some = mine[:: max(1, len(mine) // 5)][:5], mine[:: max(1, len(mine) // 100)]
        spread = [np.linalg.norm(points[some] - points[v], axis=1).std() for v in few]
        vantage = int(few[int(np.argmax(spread))])
        distance = np.linalg.norm(points[mine] - points[vantage], axis=1)
        by = np.argsort(distance, kind="stable")
        order[begin:end], distance = mine[by], distance[by]
        half = (end - begin) // 2
        nodes.append((begin, begin + half, end, vantage))
        ranges.append((distance[0], distance[half - 1], distance[half], distance[-1]))
        todo += [(begin + half, end), (begin, begin + half)]
    return order, np.array(nodes, np.int64), np.array(ranges)


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


class Results:
    """The best k candidates of each query so far, by score and then by id."""

    def __init__(self, queries: int, k: int, bound: np.ndarray):
        self.k, self.bound = k, bound
        self.score = np.full((queries, k), -np.inf)
        self.place = np.full((queries, k), -1)

    def least(self) -> np.ndarray:
        return np.maximum(self.score[:, -1], self.bound)

    def add(self, query: np.ndarray, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        rows = np.unique(query)
        at = np.searchsorted(rows, query)
        old = np.repeat(np.arange(len(rows)), self.k)
        q = np.concatenate([old, at])
        p = np.concatenate([self.place[rows].ravel(), place])
        s = np.concatenate([self.score[rows].ravel(), score])
        order = np.lexsort((np.where(p >= 0, ids[p], 0), -s, q))
        q, p, s = q[order], p[order], s[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        best = rank < self.k
        self.score[rows[q[best]], rank[best]], self.place[rows[q[best]], rank[best]] = s[best], p[best]


def searched(tree: dict, queries: np.ndarray, rows: np.ndarray, bound: np.ndarray, k: int, factor: float, largest: float) -> Results:
    """The best candidates of a shard for queries (vectors and their rows), none below ``bound``."""
    vectors, nodes, ranges = tree["vectors"], tree["nodes"], tree["ranges"]
    points = lengthened(vectors, largest)
    own = np.column_stack([queries, np.zeros(len(queries))])
    squares = np.einsum("ij,ij->i", queries, queries)
    found = Results(len(queries), k, bound)
    at = {int(n[0]) if n[3] < 0 else (int(n[0]), int(n[2])): i for i, n in enumerate(nodes)}
    children = {}
    for i, (begin, middle, end, vantage) in enumerate(nodes.tolist()):
        if vantage >= 0:
            children[i] = tuple(at.get((a, b), at.get(a)) for a, b in ((begin, middle), (middle, end)))

    def leaf(i: int, active: np.ndarray) -> None:
        begin, _, end, _ = nodes[i]
        product = queries[active] @ vectors[begin:end].T
        least = found.least()[active]
        scale = SLACK * (1 + np.sqrt(squares[active] * largest))
        q, p = np.nonzero(product >= (least - scale)[:, None])
        q, p = active[q], p + begin
        other = rows[q] != tree["rows"][p]
        q, p = q[other], p[other]
        score = np.einsum("ij,ij->i", queries[q], vectors[p])
        if len(q):
            keep = score >= found.bound[q]
            found.add(q[keep], p[keep], score[keep], tree["ids"])

    def distances(i: int, active: np.ndarray) -> np.ndarray:
        return np.linalg.norm(own[active] - points[nodes[i][3]], axis=1)

    # Every query first goes down to the leaf of its own side, which gives it a bound.
    visited, home = np.full(len(queries), -1), [(0, np.arange(len(queries)))]
    while home:
        i, active = home.pop()
        if not len(active):
            continue
        if i not in children:
            leaf(i, active)
            visited[active] = i
            continue
        d = distances(i, active)
        near = np.abs(d - ranges[i, 1]) < np.abs(d - ranges[i, 2])
        near = np.where(d <= ranges[i, 1], True, np.where(d >= ranges[i, 2], False, near))
        home += [(children[i][0], active[near]), (children[i][1], active[~near])]
    todo = [(0, np.arange(len(queries)))]
    while todo:
        i, active = todo.pop()
        if i not in children:
            if len(active := active[visited[active] != i]):
                leaf(i, active)
            continue
        d = distances(i, active)
        reach = np.sqrt(np.maximum(0.0, squares[active] + largest - 2 * np.maximum(found.least()[active], -1e300))) * (1 + SLACK) + SLACK
        for child, low, high in ((1, ranges[i, 2], ranges[i, 3]), (0, ranges[i, 0], ranges[i, 1])):
            gap = np.maximum(np.maximum(low - d, d - high), 0.0)
            if len(stay := active[gap * factor <= reach]):
                todo.append((children[i][child], stay))
    return found


def neighbours(vectors: DataFrame, is_query: Column, k: int = K, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query. vectors: vec_id, embedding."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("asks"))
    rows = written(rows.where("vec_id is not null").withColumn("row", F.monotonically_increasing_id()), "search-rows")
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for width in widths(rows):
        out = out.union(_neighbours(rows.where(F.size("embedding") == width), width, k, factor))
    return out


def _neighbours(rows: DataFrame, width: int, k: int, factor: float) -> DataFrame:
    def plain(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, got = matrix_of(batch.column("embedding"), width)
        at = pa.array(keep)
        return pa.record_batch({"vec_id": batch.column("vec_id").take(at), "row": batch.column("row").take(at), "asks": batch.column("asks").take(at),
                                "data": pa.array([x.tobytes() for x in got], pa.binary()), "square": pa.array(np.einsum("ij,ij->i", got, got))})

    usable = written(in_arrow(rows, plain, "vec_id long, row long, asks boolean, data binary, square double"), "search-vectors")
    n, largest = usable.agg(F.count(F.lit(1)), F.max("square")).first()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = -(-n // SHARD)
    place = F.pmod(F.xxhash64(F.lit("shard"), "row"), F.lit(shards))

    def grow(batch: pa.RecordBatch) -> pa.RecordBatch:
        trees = []
        for ids, of, data in zip(batch.column("ids"), batch.column("rows"), batch.column("data"), strict=True):
            got = np.frombuffer(b"".join(data.as_py()), np.float64).reshape(-1, width)
            order, nodes, ranges = tree_of(lengthened(got, largest))
            where = np.argsort(order)  # vantage points by their place in the new order
            nodes[:, 3] = np.where(nodes[:, 3] >= 0, where[nodes[:, 3]], -1)
            trees.append(packed(ids=ids.values.to_numpy()[order], rows=of.values.to_numpy()[order], vectors=got[order], nodes=nodes, ranges=ranges))
        return pa.record_batch({"shard": batch.column("shard"), "tree": pa.array(trees, pa.binary())})

    packs = usable.groupBy(place.alias("shard")).agg(F.collect_list("vec_id").alias("ids"), F.collect_list("row").alias("rows"), F.collect_list("data").alias("data"))
    trees = written(in_arrow(packs, grow, "shard long, tree binary"), "search-trees")
    asked = usable.where("asks")
    blocks = -(-asked.count() // BLOCK)
    if not blocks:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # A block's queries all start in one shard.
    start = F.pmod(F.xxhash64(F.lit("block"), "row"), F.lit(blocks))

    def search(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = {name: [] for name in ("query", "query_id", "found", "scores")}
        tree_of_shard: tuple[int | None, dict] = (None, {})
        for shard, blob, ids, of, data, bounds in zip(*(batch.column(c) for c in ("shard", "tree", "ids", "rows", "data", "bounds")), strict=True):
            if shard.as_py() != tree_of_shard[0]:
                tree_of_shard = (shard.as_py(), dict(np.load(io.BytesIO(blob.as_py()))))
            tree = tree_of_shard[1]
            queries = np.frombuffer(b"".join(data.as_py()), np.float64).reshape(-1, width)
            got = searched(tree, queries, of.values.to_numpy(), bounds.values.to_numpy(), k, factor, largest)
            for q, (query, name) in enumerate(zip(of.as_py(), ids.as_py(), strict=True)):
                some = got.place[q] >= 0
                if some.any():
                    out["query"].append(query)
                    out["query_id"].append(name)
                    out["found"].append(tree["ids"][got.place[q][some]].tolist())
                    out["scores"].append(got.score[q][some].tolist())
        return pa.record_batch({"query": pa.array(out["query"], pa.int64()), "query_id": pa.array(out["query_id"], pa.int64()),
                                "found": pa.array(out["found"], pa.list_(pa.int64())), "scores": pa.array(out["scores"], pa.list_(pa.float64()))})

    def run(requests: DataFrame, name: str) -> DataFrame:
        """requests: shard, block, ids, rows, data, bounds."""
        joined = trees.join(requests, "shard").select("shard", "tree", "ids", "rows", "data", "bounds")
        return written(in_arrow(joined, search, "query long, query_id long, found array<long>, scores array<double>"), name)

    def requests(queries: DataFrame, to: Column) -> DataFrame:
        packs = queries.groupBy("block").agg(F.collect_list("vec_id").alias("ids"), F.collect_list("row").alias("rows"), F.collect_list("data").alias("data"), F.collect_list("bound").alias("bounds"))
        return packs.withColumn("shard", to)

    queries = written(asked.withColumn("block", start).select("vec_id", "row", "data", "block"), "search-queries")
    first_shard = F.pmod("block", F.lit(shards))
    first = run(requests(queries.withColumn("bound", F.lit(float("-inf"))), first_shard), "search-first")
    bounds = first.select(F.col("query").alias("row"), F.when(F.size("scores") == k, F.array_min("scores")).alias("bound"))
    bounded = queries.join(bounds, "row", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    # The stated queries meet every other shard, block by block.
    others = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")), lambda s: s != first_shard))
    rest = run(requests(bounded, others), "search-rest")
    every = first.union(rest).select("query", "query_id", F.explode(F.arrays_zip("found", "scores")).alias("one"))
    order = Window.partitionBy("query").orderBy(F.desc("one.scores"), "one.found")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("one.found").alias("vec_id"), F.col("one.scores").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
