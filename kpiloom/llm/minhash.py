"""MinHash near-deduplication by min-max hashing.

Each permutation is evaluated once a shingle and gives two signature values,
the smallest and the largest; both agree between two sets with probability
equal to their Jaccard similarity, so half the evaluations band as many
values. ``BANDS`` bands of ``ROWS`` values miss a pair of similarity 0.8 with
probability (1 - 0.8**4)**32, about 5e-8.

The work, none of which lists all pairs of a group:

1. texts with one word sequence are collapsed;
2. of the rest, band keys that two texts or more share are kept as buckets;
3. in each bucket the text that shares most buckets with others leads, and the
   others are compared with it on the full shingle sets;
4. two texts of a bucket that are both linked with its leader are connected
   already. For the others, every text that has this leader is described by its
   symmetric difference from the leader's set. The differences of two texts
   give the exact size of their intersection, and a text that is not linked
   with the leader can only be linked with one whose difference shares a
   shingle with its own. Blocks of differences are multiplied as incidence
   matrices, and a block pair yields no more links than connect its texts.

Defined results: null and empty texts and texts without words have an empty
set and link with nothing; each row has the component of its own text, also
where rows repeat a doc_id; rows with a null doc_id link nothing, have the
component of an equal text or null, and a null kept; an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import in_arrow, table, written
from kpiloom.llm.components import components
from kpiloom.llm.words import mixed, shingle_sets

WIDTH = 4
THRESHOLD = 80  # per cent
PERMUTATIONS, ROWS = 64, 4
BANDS = 2 * PERMUTATIONS // ROWS
_RANDOM = np.random.Generator(np.random.PCG64(64))
_XOR = _RANDOM.integers(1, 2**64, PERMUTATIONS, np.uint64, endpoint=False)
_TIMES = _RANDOM.integers(1, 2**64, PERMUTATIONS, np.uint64, endpoint=False) | np.uint64(1)
_SALTS = _RANDOM.integers(1, 2**64, ROWS + BANDS, np.uint64, endpoint=False) | np.uint64(1)
SPREAD = 256  # members compared with one copy of a leader's text
SALTS = 16  # parts that the pairs of one leader are counted and joined in
BLOCK_BYTES = 1 << 19  # of differences that are compared with another block's


def min_max(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of non-empty sets, (2, documents, permutations): the minima and the maxima."""
    out = np.empty((2, len(sets), PERMUTATIONS), np.uint64)
    begin = np.cumsum([0, *map(len, sets)][:-1])
    values = np.concatenate(sets)
    for k in range(PERMUTATIONS):
        hashed = (values ^ _XOR[k]) * _TIMES[k]
        hashed ^= hashed >> np.uint64(32)
        out[0, :, k] = np.minimum.reduceat(hashed, begin)
        out[1, :, k] = np.maximum.reduceat(hashed, begin)
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit key for each document and band; a band holds minima only or maxima only."""
    values = min_max(sets).reshape(2, len(sets), PERMUTATIONS // ROWS, ROWS)
    keys = (values * _SALTS[:ROWS]).sum(axis=3, dtype=np.uint64)
    keys = np.concatenate([keys[0], keys[1]], axis=1)
    return mixed(keys + _SALTS[ROWS:])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_shingles, digest of the word sequence, band keys (both null without words).

    A row is told by its doc_id and a hash of its text.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        whole, sizes, keys = [], [], [np.zeros((0, BANDS), np.uint64)]
        for _, block, sets in shingle_sets(batch.column("text"), width):
            whole.append(block)
            sizes += map(len, sets)
            if some := [s for s in sets if len(s)]:
                keys.append(band_keys(some))
        count = np.array(sizes, np.int64)
        flat = np.concatenate(keys).view(np.int64).ravel()
        ends = np.concatenate([[0], np.cumsum((count > 0) * BANDS)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(count == 0, False)), flat)
        return pa.record_batch({"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "n_shingles": pa.array(count),
                                "digest": pa.array(np.concatenate(whole).view(np.int64), mask=count == 0), "keys": lists})

    return in_arrow(docs.select(*_named(docs), "text"), each, "doc_id long, text_key long, n_shingles long, digest long, keys array<long>")


def _named(docs: DataFrame) -> list[Column]:
    return [docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("text_key")]


def _same(one: DataFrame, other: DataFrame) -> Column:
    return one["doc_id"].eqNullSafe(other["__id"]) & (one["text_key"] == other["__key"])


def texts_of(docs: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """node, text for each (doc_id, text_key, node) of ``chosen``."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        whole = np.concatenate([block for _, block, _ in shingle_sets(batch.column("text"), width)]).view(np.int64)
        return batch.filter(pa.array(whole == batch.column("node").to_numpy()))

    given, wanted = docs.select(*_named(docs), "text"), chosen.withColumnsRenamed({"doc_id": "__id", "text_key": "__key"})
    return in_arrow(given.join(wanted, _same(given, wanted)).select("node", "text"), each, "node long, text string")


def paired(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b and others) with text_a and text_b. texts: node, text.

    A leader that many pairs name is sent in one copy for every ``SPREAD`` of them. They are counted and joined
    in ``SALTS`` parts, so that no task gets all pairs of a leader.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "b"), F.lit(SALTS)).cast("int"))
    counted = salted.groupBy("a", "salt").agg(F.ceil(F.count(F.lit(1)) / SPREAD).cast("int").alias("copies"))
    spread = salted.join(counted, ["a", "salt"]).withColumn("copy", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int")).drop("copies")
    copies = (counted.join(texts, F.col("a") == F.col("node")).drop("node")
              .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies").withColumnRenamed("text", "text_a"))
    return (spread.join(texts, F.col("b") == F.col("node")).drop("node").withColumnRenamed("text", "text_b")
            .join(copies.hint("merge"), ["a", "salt", "copy"]).drop("salt", "copy"))


def _both_sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row, the leader's and the other's shingles; a leader's are kept for the next rows."""
    left = batch.column("text_a")

    @lru_cache(64)
    def leader(text: str) -> np.ndarray:
        return next(shingle_sets(pa.array([text]), width))[2][0]

    for row, _, sets in shingle_sets(batch.column("text_b"), width):
        for i, mine in enumerate(sets, row):
            yield i, leader(left[i].as_py()), mine


def similar(same: np.ndarray | int, sizes: np.ndarray | int, threshold: int) -> np.ndarray | bool:
    """Whether sets with so many common shingles and this sum of sizes are similar enough."""
    return 100 * same >= threshold * (sizes - same)


def compared(pairs: DataFrame, texts: DataFrame, width: int, threshold: int) -> DataFrame:
    """a, b, near: whether the full shingle sets of the pair are similar enough."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = np.zeros(batch.num_rows, bool)
        for i, theirs, mine in _both_sets(batch, width):
            at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
            near[i] = similar(int((theirs[at] == mine).sum()), len(mine) + len(theirs), threshold)
        return pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "near": pa.array(near)})

    return in_arrow(paired(pairs, texts).select("a", "b", "text_a", "text_b"), each, "a long, b long, near boolean")


def differences(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """a, b, near, size (of b's set), apart: the shingles that only one of the two has, as packed numbers."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        size, apart = [], []
        for _, theirs, mine in _both_sets(batch, width):
            size.append(len(mine))
            apart.append(np.setxor1d(theirs, mine, assume_unique=True).tobytes())
        return pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "near": batch.column("near"), "size": pa.array(size, pa.int64()), "apart": pa.array(apart, pa.binary())})

    return in_arrow(paired(pairs, texts).select("a", "b", "near", "text_a", "text_b"), each, "a long, b long, near boolean, size long, apart binary")


def common(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of one block shares with each of another."""
    out = np.zeros((len(one), len(other)), np.float32)
    values = [np.concatenate([np.zeros(0, np.uint64), *x]) for x in (one, other)]
    both = np.intersect1d(np.unique(values[0]), np.unique(values[1]), assume_unique=True)
    cells = []
    for sets, value in zip((one, other), values, strict=True):
        of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(both, value), max(len(both) - 1, 0))
        shared = both[at] == value if len(both) else np.zeros(len(value), bool)
        cells.append((of[shared], at[shared]))
    for begin in range(0, len(both), 2048):
        matrices = []
        for sets, (of, at) in zip((one, other), cells, strict=True):
            here = (at >= begin) & (at < begin + 2048)
            matrix = np.zeros((len(sets), min(2048, len(both) - begin)), np.float32)
            matrix[of[here], at[here] - begin] = 1
            matrices.append(matrix)
        out += matrices[0] @ matrices[1].T
    return out


def block_links(one: dict, other: dict, threshold: int) -> list[tuple[int, int]]:
    """Links that connect what is similar between the texts of one block that are not near the leader, and those of another."""
    far = [i for i, near in enumerate(one["near"]) if not near]
    left, right = ([np.frombuffer(x, np.uint64) for x in some] for some in ([one["apart"][i] for i in far], other["apart"]))
    ids, others = np.array([one["b"][i] for i in far]), np.array(other["b"])
    size, sizes = np.array([one["size"][i] for i in far]), np.array(other["size"])
    apart = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right]) - 2 * common(left, right).astype(np.int64)
    total = size[:, None] + sizes
    links = similar((total - apart) // 2, total, threshold) & (ids[:, None] != others)
    found, label = [], {i: i for i in (*ids.tolist(), *others.tolist())}
    members = {i: [i] for i in label}
    for i in np.flatnonzero(links.any(axis=1)).tolist():
        mine = int(ids[i])
        for theirs in others[links[i]].tolist():
            if (low := label[mine]) != (high := label[theirs]):
                found.append((mine, theirs))
                if len(members[low]) < len(members[high]):
                    low, high = high, low
                for x in members.pop(high):
                    label[x] = low
                    members[low].append(x)
    return found


def far_links(flags: DataFrame, texts: DataFrame, width: int, threshold: int) -> DataFrame:
    """a, b: what connects the texts that are not near a leader with others that have it. flags: a (the leader), b, near."""
    some = flags.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("near")).alias("far")).where("n > 1 and far > 0").select("a")
    told = written(differences(flags.join(some, "a"), texts, width), "minhash-differences")
    bounds = told.groupBy("a").agg(F.ceil(F.sum(F.octet_length("apart") + 64) / BLOCK_BYTES).cast("int").alias("blocks"))
    dealt = told.join(bounds, "a").withColumn("block", F.pmod(F.xxhash64(F.lit(1), "b"), F.col("blocks")).cast("int"))
    # A block holds about BLOCK_BYTES, whatever the size of its group.
    packs = written(dealt.groupBy("a", "block").agg(*[F.collect_list(c).alias(c) for c in ("b", "near", "size", "apart")]), "minhash-blocks")
    left = packs.where(F.exists("near", lambda x: ~x)).select("a", F.struct("b", "near", "size", "apart").alias("one"))
    rows = left.join(packs.select("a", F.struct("b", "size", "apart").alias("other")).hint("merge"), "a").select("one", "other")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [link for one, other in zip(batch.column("one"), batch.column("other"), strict=True) for link in block_links(one.as_py(), other.as_py(), threshold)]
        return pa.record_batch({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    return in_arrow(rows, each, "a long, b long")


def near_links(docs: DataFrame, nodes: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """node, component of linked nodes. nodes: one row for each distinct text, with node, doc_id, text_key and keys."""
    hashed = nodes.select("node", F.explode("keys").alias("key"))
    shared = hashed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = written(hashed.join(shared, "key").distinct(), "minhash-buckets")
    # The member whose buckets hold most others leads them all: the text that the others vary, as a rule.
    ranks = written(buckets.groupBy("node").agg(F.sum("size").alias("rank")), "minhash-ranks")
    chosen = nodes.join(ranks, "node").select("doc_id", "text_key", "node")
    texts = written(texts_of(docs, chosen, width), "minhash-texts")
    first = buckets.join(ranks, "node").groupBy("key").agg(F.max_by("node", F.struct("rank", "node")).alias("a"))
    pairs = buckets.join(first, "key").where("node != a").select("a", F.col("node").alias("b")).distinct()
    flags = written(compared(pairs, texts, width, threshold), "minhash-compared")
    links = flags.where("near").select("a", "b").union(far_links(flags, texts, width, threshold))
    return written(components(links, "a", "b"), "minhash-components")


def classes(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, text_key, n_shingles, digest, component_id, stays: one row for each row of ``docs``.

    stays is the (last, doc_id, text_key) of the one row of the component that
    a deduplication leaves: the smallest, rows with a null doc_id after all others. It and the digest are null without words.
    """
    rows = written(signatures(docs, width), "minhash-signatures")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = rows.where("digest is not null").groupBy("digest").agg(F.min(place).alias("first"))
    nodes = rows.join(first, "digest").where(place == F.col("first")).select(F.col("digest").alias("node"), "doc_id", "text_key", "keys")
    nodes = written(nodes, "minhash-nodes")
    found = near_links(docs, nodes, width, threshold)
    least = first.join(found, F.col("digest") == F.col("node"), "left").select("digest", "first", F.coalesce("component", "digest").alias("component"))
    least = written(least, "minhash-classes")
    smallest = least.groupBy("component").agg(F.min("first").alias("stays"))
    known = least.join(smallest, "component").select("digest", "stays")
    out = rows.select("doc_id", "text_key", "n_shingles", "digest").join(known, "digest", "left")
    # Without words a document is alone; a component of null ids alone has no doc_id to be named by.
    return out.withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("stays.doc_id")))


def near_duplicates(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``."""
    return classes(docs, width, threshold).select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def without_copies(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with exactly one row of each group of near-copies, that of the smallest doc_id; null ids come last.

    Rows are judged by their doc_id and text, so a text stays if only another
    row of its doc_id is a copy. Of rows equal in both, one stays.
    """
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    judged = classes(docs, width, threshold).where("digest is not null").groupBy("doc_id", "text_key").agg(
        F.first(place != F.col("stays")).alias("gone"), F.count(F.lit(1)).alias("rows"))  # rows equal in both share their component
    judged = written(judged.where("gone or rows > 1").withColumnsRenamed({"doc_id": "__id", "text_key": "__key"}), "minhash-judged")
    mine = docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__key"))
    left = docs.join(judged, mine, "left_anti")
    again = docs.join(judged.where("not gone"), mine)
    one = Window.partitionBy("__id", "__key").orderBy(F.xxhash64(*[F.col(c).cast("string") for c in docs.columns]))
    return left.unionByName(again.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
