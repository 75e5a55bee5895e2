"""How far the sources of a language differ in their words: in-mapper stripes.

Every partition folds whole documents into stripes, a stripe being a term of a
language with its document frequency and its occurrences by source. A
partition's stripes are spilled as rows when ``SPILL_ENTRIES`` are held, dealt by
(language, term), sorted and merged. The empty term, which no text has, carries the
documents of every source, so that sources without terms are known, too.
Merged stripes of terms in fewer than ``LEAST_DOCUMENTS`` documents go; the
others are written once, and their totals taken.

Every merged stripe then gives its share of all divergences itself: a source
without the term has the same smoothed probability for every such term, so a
pair of sources starts from the number of terms times that pair's base value, and a
stripe only adds, for each source that has the term, the differences to it. Stripes are dealt by
(language, bucket of terms, tile of sources) together with the totals of the
language, and a task holds one tile's sums at a time, ``CELLS`` at most, however many sources there are. The pairs of sources
themselves are the result asked for.

All numbers are exact: shares of 1,000,000,000 are taken by long division in
64 bits, which holds for 9 * 10**15 occurrences a language; beyond, the job ends with an error.

Defined results: null texts, languages and sources are ''; texts without terms
count for their group alone; rows are documents, repeated ones and those of one id too; a language of one source has no
pairs; without kept terms all pairs have 0; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import release, slices, table, written

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SPILL_ENTRIES = 1_000_000  # (language, source, term) counts that a partition holds before it spills
BUCKET_STRIPES = 4096  # about so many, or as many as there are sources, are dealt together
CELLS = 1 << 22  # of a tile's sums
UNIT = 1_000_000_000
_DIGITS = 1000  # UNIT is its third power
_SLICE = 1 << 22  # of a text that is split at once

# Letters stay, A-Z as a-z, and every byte of a character beyond ASCII; all else is a space.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
STRIPE = "lang string, term binary, documents long, sources array<string>, counts array<long>"
_STRIPE = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("documents", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, a slice at a time, cut between terms."""
    text = text.translate(_TERMS)
    begin = 0
    while begin < len(text):
        end = text.find(b" ", begin + _SLICE) if begin + _SLICE < len(text) else -1
        end = len(text) if end < 0 else end
        yield text[begin:end].split()
        begin = end


class Fold:
    """The stripes of the documents seen since the last spill."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.documents: dict[str, Counter] = defaultdict(Counter)

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, seen = self.counts[lang, source], {b""}
        counts[b""] += 1
        for some in terms(text):
            counts.update(some)
            seen.update(some)
        self.documents[lang].update(seen)

    def entries(self) -> int:
        return sum(map(len, self.counts.values()))

    def spilled(self) -> Iterator[pa.RecordBatch]:
        """All stripes, a language at a time; the fold is empty then."""
        by_lang = defaultdict(list)
        for lang, source in self.counts:
            by_lang[lang].append(source)
        for lang, sources in by_lang.items():
            stripes: dict[bytes, tuple[list[str], list[int]]] = {}
            for source in sources:
                for term, n in self.counts.pop((lang, source)).items():
                    own = stripes.get(term)
                    if own is None:
                        own = stripes[term] = ([], [])
                    own[0].append(source)
                    own[1].append(n)
            documents, names = self.documents.pop(lang), list(stripes)
            for begin in range(0, len(names), 1 << 16):
                some = names[begin:begin + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.binary()), pa.array([documents[t] for t in some], pa.int64()),
                                                  pa.array([stripes[t][0] for t in some], pa.list_(pa.string())), pa.array([stripes[t][1] for t in some], pa.list_(pa.int64()))], schema=_STRIPE)


def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fold = Fold()
    for batch in batches:
        for part in slices(batch):
            for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                fold.add(lang, source, text)
            if fold.entries() > SPILL_ENTRIES:
                yield from fold.spilled()
    yield from fold.spilled()
    release()


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """For every count of the batch: its row, the code of its source, the sources by code, and the count."""
    lengths = pc.list_value_length(batch.column("sources")).to_numpy(zero_copy_only=False)
    coded = batch.column("sources").flatten().dictionary_encode()
    return np.repeat(np.arange(batch.num_rows), lengths), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, batch.column("counts").flatten().to_numpy(zero_copy_only=False)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sums of their values (rows of them, or numbers)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values[order], first, axis=0)


def merged_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Neighbouring rows of one (lang, term) as one stripe."""
    n, new = batch.num_rows, np.ones(batch.num_rows, bool)
    if n > 1:
        differs = lambda c: pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[1:] = differs("lang") | differs("term")
    first = np.flatnonzero(new)
    row, code, names, counts = _entries(batch)
    own = (np.cumsum(new) - 1)[row]
    keys, sums = _sums(own * len(names) + code, counts)
    offsets = pa.array(np.searchsorted(keys // len(names), np.arange(len(first) + 1)).astype(np.int32))
    head = batch.take(pa.array(first))
    return pa.RecordBatch.from_arrays([head.column("lang"), head.column("term"), pa.array(np.add.reduceat(batch.column("documents").to_numpy(), first)),
                                       pa.ListArray.from_arrays(offsets, names.take(pa.array(keys % len(names)))), pa.ListArray.from_arrays(offsets, pa.array(sums))], schema=_STRIPE)


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stripes of sorted rows; only the last one, merged so far, is carried from batch to batch."""

    def chosen(batch: pa.RecordBatch) -> pa.RecordBatch:
        enough = batch.column("documents").to_numpy() >= LEAST_DOCUMENTS
        return batch.filter(pa.array(enough | (pc.binary_length(batch.column("term")).to_numpy(zero_copy_only=False) == 0)))

    held = None
    for batch in batches:
        if batch.num_rows:
            batch = batch.cast(_STRIPE)
            done = merged_rows(batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0])
            yield chosen(done.slice(0, done.num_rows - 1))
            held = done.slice(done.num_rows - 1)
    if held is not None:
        yield chosen(held)
    release()


def stripes(docs: DataFrame) -> DataFrame:
    """lang, term, documents, sources, counts: the merged stripe of every kept term, and of '' for the documents."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))
    dealt = own.mapInArrow(folded, STRIPE).repartition("lang", "term").sortWithinPartitions("lang", "term")
    return written(dealt.mapInArrow(merged, STRIPE), "divergence-stripes")


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * count / total), by long division; 0 <= count <= total."""
    out = np.zeros(np.broadcast(count, total).shape, np.int64)
    rest = np.array(np.broadcast_to(count, out.shape), np.int64)
    for _ in range(3):
        rest *= _DIGITS
        digits = rest // total
        out = out * _DIGITS + digits
        rest -= digits * total
    return out + 1


def between(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Tile:
    """Sums of the divergences between the sources of one tile and all of their language, over a bucket of terms."""

    def __init__(self, lang: str, bucket: int, totals: list[tuple[str, int, int, bool]]) -> None:
        self.lang, self.bucket, self.sources = lang, bucket, [t[0] for t in totals]
        self.index = {s: k for k, s in enumerate(self.sources)}
        self.vocabulary = totals[0][2]
        occurrences = [t[1] for t in totals]
        if sum(occurrences) + 2 * self.vocabulary >= 2**63 // _DIGITS:
            raise OverflowError(f"{lang!r} has more term occurrences than 64 bits allow")
        self.total = np.array(occurrences, np.int64) + 2 * self.vocabulary
        self.all_total = sum(occurrences) + 2 * self.vocabulary
        self.own = np.flatnonzero([t[3] for t in totals])
        self.place = np.full(len(totals), -1)
        self.place[self.own] = np.arange(len(self.own))
        # Of a term that a source does not have.
        self.zero = share(np.full(len(totals), 2), self.total) if self.vocabulary else np.ones(len(totals), np.int64)
        self.base = between(self.zero[self.own, None], self.zero[None, :])
        self.sums = np.zeros(self.base.shape, np.int64)
        self.best: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        self.least = np.zeros(len(totals), np.int64)  # value that a source's best terms have, once there are enough

    def add(self, batch: pa.RecordBatch) -> None:
        row, code, names, counts = _entries(batch)
        source = np.array([self.index[s] for s in names.to_pylist()])[code]
        term = batch.column("term")
        step = max(1, (1 << 20) // len(self.sources))
        cuts = [0]
        ends = np.searchsorted(row, np.arange(1, batch.num_rows + 1))
        while cuts[-1] < batch.num_rows:  # whole stripes, about ``step`` counts of them
            begin = ends[cuts[-1] - 1] if cuts[-1] else 0
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, begin + step, "right"))))
        for a, b in zip(cuts, cuts[1:]):
            b = min(b, batch.num_rows)
            some = slice(ends[a - 1] if a else 0, ends[b - 1])
            self._block(row[some] - a, source[some], counts[some], b - a, term.slice(a, b - a))

    def _block(self, row: np.ndarray, source: np.ndarray, counts: np.ndarray, n: int, term: pa.Array) -> None:
        p = share(counts + 2, self.total[source])
        all_p = np.tile(self.zero, (n, 1))
        all_p[row, source] = p
        has = np.zeros(all_p.shape, bool)
        has[row, source] = True
        whole = np.zeros(n, np.int64)
        np.add.at(whole, row, counts)
        mine = np.flatnonzero(self.place[source] >= 0)
        if not len(mine):
            return
        row, source, p = row[mine], source[mine], p[mine]
        at = self.place[source]
        more = between(p[:, None], all_p[row]) - self.base[at]
        more[has[row] & (np.arange(len(self.sources)) <= source[:, None])] = 0  # where both have the term, the first adds it
        places, sums = _sums(at, more)
        self.sums[places] += sums
        q = share(whole + 2, np.int64(self.all_total))[row]
        value = np.where(p > q, between(p, q), -1)
        for k in np.flatnonzero((value >= 0) & (value >= self.least[source])).tolist():
            own = self.best[source[k]]
            own.append((-int(value[k]), term[int(row[k])].as_py()))
            if len(own) >= 8 * TOP_TERMS:
                self._cut(source[k])

    def _cut(self, source: int) -> None:
        own = self.best[source] = heapq.nsmallest(TOP_TERMS, self.best[source])
        if len(own) == TOP_TERMS:
            self.least[source] = -own[-1][0]

    def rows(self) -> Iterator[tuple[str, str, str, bytes, int]]:
        for at, a in enumerate(self.own.tolist()):
            for b, other in enumerate(self.sources):
                if a == b:
                    continue
                here, value = self.sources[a], int(self.sums[at, b])
                base = self.vocabulary * int(self.base[at, b]) if self.bucket == 0 else 0
                if value + base or self.bucket == 0:
                    yield self.lang, here, "pair", other.encode(), value + base
                if value:
                    yield self.lang, other, "pair", here.encode(), value
        for source in list(self.best):
            self._cut(source)
            for value, term in self.best[source]:
                yield self.lang, self.sources[source], "term", term, -value


_PART = "lang string, source string, part string, item binary, value long"


def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Divergences of rows sorted by (lang, bucket, tile), of each the totals first and then the stripes."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.binary()), ("value", pa.int64())])

    def results(tile: Tile) -> Iterator[pa.RecordBatch]:
        some = []
        for one in tile.rows():
            some.append(one)
            if len(some) == 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)
                some = []
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)

    key, totals, tile = None, [], None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "bucket", "tile", "is_stripe")), strict=True))
        begin = 0
        while begin < len(keys):
            end = begin + 1
            while end < len(keys) and keys[end] == keys[begin]:
                end += 1
            part, (*own, is_stripe) = batch.slice(begin, end - begin), keys[begin]
            if own != key:
                if key is not None:
                    yield from results(tile or Tile(*key[:2], totals))
                key, totals, tile = own, [], None
            if is_stripe:
                tile = tile or Tile(*key[:2], totals)
                tile.add(part)
            else:
                totals += zip(*(part.column(c).to_pylist() for c in ("source", "occurrences", "vocabulary", "own")), strict=True)
            begin = end
    if key is not None:
        yield from results(tile or Tile(*key[:2], totals))
    release()


def divergences(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` for every other source, ``term`` for a source's most telling terms."""
    every = stripes(docs)
    kept, groups = every.where("octet_length(term) > 0"), every.where("octet_length(term) = 0")
    vocabulary, most = kept.count(), groups.agg(F.max(F.size("sources"))).first()[0] or 1
    buckets, tiles = max(1, -(-vocabulary // max(BUCKET_STRIPES, most))), -(-most * most // CELLS)
    tile = lambda s: F.pmod(F.xxhash64(s), F.lit(tiles)).cast("int")

    counted = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("occurrences"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    totals = (groups.select("lang", F.explode("sources").alias("source")).join(counted, ["lang", "source"], "left").join(sizes, "lang", "left")
              .select("lang", "source", F.coalesce("occurrences", F.lit(0)).alias("occurrences"), F.coalesce("vocabulary", F.lit(0)).alias("vocabulary")))
    sent = totals.select("lang", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), F.lit(False).alias("is_stripe"), "source", "occurrences", "vocabulary", tile("source").alias("of"))
    sent = sent.select("*", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile")).withColumn("own", F.expr("tile = of")).drop("of")
    given = kept.select("lang", F.pmod(F.xxhash64("lang", "term"), F.lit(buckets)).cast("int").alias("bucket"), F.lit(True).alias("is_stripe"), "term", "sources", "counts",
                        F.explode(F.array_distinct(F.transform("sources", tile))).alias("tile"))
    dealt = sent.unionByName(given, allowMissingColumns=True).repartition("lang", "bucket", "tile").sortWithinPartitions("lang", "bucket", "tile", "is_stripe", "source")
    summed = dealt.mapInArrow(emitted, _PART).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item")))
    return summed.withColumn("rank", rank).where(f"part = 'pair' or rank <= {TOP_TERMS}").select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value", "rank")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {LEAST_DOCUMENTS}),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, CAST(coalesce(sum(c), 0) AS HUGEINT) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(c, 0) AS c, 1 + {UNIT} * (coalesce(c, 0) + 2) // (n + 2 * v) AS p FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
l AS (SELECT lang, sum(n) AS n FROM g GROUP BY lang),
q AS (SELECT lang, term, 1 + {UNIT} * (sum(c) + 2) // (any_value(n) + 2 * any_value(v)) AS q FROM p JOIN l USING (lang) JOIN v USING (lang) GROUP BY lang, term),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS one, y.source AS two, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s ON s.lang = a.lang AND s.one = a.source AND s.two = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM r QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
